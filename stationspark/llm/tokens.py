"""Token ids of texts, by the tokenizers library, for Arrow batches.

A byte-level BPE first cuts a text into pre-tokens.  A blank that is followed
by another character than white space always begins one, and white space
before it is cut the same way with or without what follows.  So a text may be
encoded in parts cut before such blanks, and the ids of a part (a word and
what clings to it) are kept, for words recur.  The tokenizer's own
pre-tokenizer and model encode a part that is not known.  A text that holds
the string of a special token is encoded whole.

Texts come in Arrow batches.  A batch is cut at its blanks, its different words
are looked up in the known ones at once, those not known are encoded, and the
ids of all words are gathered by number into one buffer; all of it is Arrow's
but the encoding.  A text in which white space follows a blank, or that ends in
one, goes the careful way by itself.

A worker's memory is bounded: the known words lie in segments that are never
copied as a whole, words and ids together have ``KEPT_BYTES`` at most, and all
else is held for ``TOGETHER`` bytes of text at a time.
"""

from __future__ import annotations

import os
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words whose ids a worker keeps, and the bytes of both; beyond, those not met lately go.
KEPT_WORDS = 1_500_000
KEPT_BYTES = 96 << 20
#: Known words of a segment, more where one run of texts brings more.
SEGMENT = 1 << 16
#: Pieces of words that are kept, twice: those met lately and those before.
KEPT_PIECES = 20_000
#: A piece of more characters is not kept.
LONG_PART = 64
#: Bytes of text that are cut into words together; a longer text is alone.
TOGETHER = 2 << 20

# A byte-level vocabulary writes visible bytes as themselves and numbers the
# others from 256 (fixed values of the file format).
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_HIDDEN = [b for b in range(256) if b not in _VISIBLE]
_AS_WRITTEN = {b: chr(256 + i) for i, b in enumerate(_HIDDEN)}
_CLOSING = ".,;:!?"


class Encoder:
    """``ids_bytes(text)``: the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if not os.path.isabs(file):
            import public_tokenizers
            file = public_tokenizers.path(file)
        self._tokenizer = Tokenizer.from_file(file)
        self._model = self._tokenizer.model
        self._cut = self._tokenizer.pre_tokenizer.pre_tokenize_str
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        # a special token that a plain word can hold
        self._plain_special = any(t.isascii() and t.isalpha() for t in self._special)
        self._lately: dict[str, bytes] = {}
        self._before: dict[str, bytes] = {}
        self._forget()

    def _of_pretoken(self, written: str) -> bytes:
        return array("I", [t.id for t in self._model.tokenize(written)]).tobytes()

    def _of_word(self, word: str) -> bytes:
        """A word of letters, a blank before it, or one closing mark."""
        got = self._known(word)
        if got is None:
            if word.isascii():
                written = word.replace(" ", _AS_WRITTEN[32])
            else:
                written = word.encode().decode("latin-1").translate(_AS_WRITTEN)
            got = self._of_pretoken(written)
            self._keep(word, got)
        return got

    def _of_part(self, part: str) -> bytes:
        body = part[1:] if part[:1] == " " else part
        if body.isalpha():
            return self._of_word(part)
        got = self._known(part)
        if got is not None:
            return got
        lines = part.split("\n")
        if body[-1:] in _CLOSING and body[:-1].isalpha():
            got = self._of_word(part[:-1]) + self._of_word(part[-1])
        elif len(lines) == 2 and lines[1].isalpha() and lines[0] and not lines[0][-1].isspace():
            # one line end between other characters is a pre-token of its own
            got = self._of_part(lines[0]) + self._of_pretoken(_AS_WRITTEN[10]) + self._of_word(lines[1])
        else:
            got = b"".join([self._of_pretoken(written) for written, _ in self._cut(part)])
        self._keep(part, got)
        return got

    def _known(self, part: str) -> bytes | None:
        got = self._lately.get(part)
        if got is None:
            got = self._before.get(part)
            if got is not None:
                self._keep(part, got)
        return got

    def _keep(self, part: str, ids: bytes) -> None:
        if len(part) <= LONG_PART:
            if len(self._lately) >= KEPT_PIECES:
                self._before, self._lately = self._lately, {}
            self._lately[part] = ids

    @staticmethod
    def parts(text: str) -> list[str]:
        words = text.split(" ")
        out = [words[0]]
        for word in words[1:]:
            if word and not word[0].isspace():
                out.append(" " + word)
            else:
                out[-1] += " " + word
        return out

    def ids_bytes(self, text: str) -> bytes:
        if any(s in text for s in self._special):
            ids = self._tokenizer.encode(text, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        return b"".join([self._of_part(p) for p in self.parts(text)])

    def _forget(self) -> None:
        # segments of known words, those that begin a text with a blank before
        # them; their ids, null where the text has to go the careful way; when
        # last met
        self._words: list[pa.Array] = []
        self._ids: list[pa.Array] = []
        self._met: list[np.ndarray] = []
        self._now = 0

    def _made_of(self, word: str) -> tuple[str, bytes, str | None] | None:
        """A word that is known by others: one before a closing mark, or two
        with a line end between them (a pre-token of its own)."""
        begins = word[:1] == " "                        # it begins a text
        body = word[1:] if begins else word
        if body.isalpha() or not begins and (not body or body[0].isspace()) or any(s in word for s in self._special):
            return None
        if body[-1:] in _CLOSING and body[:-1].isalpha():
            return word[:-1], self._of_word(word[-1]), None
        lines = body.split("\n")
        if len(lines) == 2 and lines[1].isalpha() and lines[0] and not lines[0][0].isspace() and not lines[0][-1].isspace():
            return word[:-len(lines[1]) - 1], self._of_pretoken(_AS_WRITTEN[10]), " " + lines[1]
        return None

    def _of_new(self, word: str) -> bytes | None:
        """Ids of a word by itself; ``None`` where a text has to go the careful way."""
        begins = word[:1] == " "
        body = word[1:] if begins else word
        if any(s in word for s in self._special):
            return None
        if body.isalpha():
            written = body if body.isascii() else body.encode().decode("latin-1").translate(_AS_WRITTEN)
            return self._of_pretoken(written if begins else _AS_WRITTEN[32] + written)
        if begins or (body and not body[0].isspace()):
            return self._of_part(body if begins else " " + body)
        return None

    def _encoded_words(self, words: list[str]) -> dict[str, bytes | None]:
        """Ids of new words, in their order, and of further new words that some are made of."""
        out: dict[str, bytes | None] = dict.fromkeys(words)
        made: dict[str, tuple] = {}
        others: dict[str, None] = {}
        todo = words
        while todo:
            first = len(others)
            for word in todo:
                parts = self._made_of(word)
                if parts is not None:
                    made[word] = parts
                    others.update((p, None) for p in (parts[0], parts[2]) if p is not None and p not in out)
            todo = list(islice(others, first, None))
        known: dict[str, bytes] = {}
        if others:
            listed = pa.array(list(others), pa.large_string())
            at = self._looked_up(listed)
            found = np.flatnonzero(at >= 0)
            ids, rank = self._ids_at(at[found])
            known = dict(zip(listed.take(pa.array(found)).to_pylist(), ids.take(pa.array(rank)).to_pylist()))
            out.update((word, None) for word in others if word not in known)
        for word in out:
            if word not in made:
                out[word] = known[word] = self._of_new(word)
        # a word is longer than those it is made of
        for word in sorted(made, key=len):
            if word in out:
                first, mark, last = made[word]
                out[word] = known[word] = known[first] + mark + (known[last] if last else b"")
        return out

    def _make_room(self) -> None:
        """Drops words not met lately, once there are too many."""
        self._now += 1
        if self._is_room():
            return
        late_from = np.median(np.concatenate(self._met))
        held = list(zip(self._words, self._ids, self._met))
        now = self._now
        self._forget()
        self._now = now
        while held:
            words, ids, met = held.pop(0)
            late = met > late_from
            if late.any():
                self._add(words.filter(pa.array(late)), ids.filter(pa.array(late)), met[late])
        if not self._is_room():
            self._forget()

    def _is_room(self) -> bool:
        return (sum(map(len, self._words)) <= KEPT_WORDS
                and sum(a.nbytes for some in (self._words, self._ids) for a in some) <= KEPT_BYTES)

    def _add(self, words: pa.Array, ids: pa.Array, met: np.ndarray) -> None:
        """Adds known words behind the others, to the last segment while it is short."""
        if self._words and len(self._words[-1]) < SEGMENT:
            words = pa.concat_arrays([self._words.pop(), words])
            ids = pa.concat_arrays([self._ids.pop(), ids])
            met = np.concatenate([self._met.pop(), met])
        self._words.append(words)
        self._ids.append(ids)
        self._met.append(met)

    def _looked_up(self, words: pa.Array) -> np.ndarray:
        """Places of different words among the known ones, -1 for the others."""
        at, before = np.full(len(words), -1), 0
        if self._words:
            # the table of the fewer ones is made, the known words are looked up in it
            for found in pc.index_in(pa.chunked_array(self._words), value_set=words).chunks:
                found = pc.fill_null(found, -1).to_numpy()
                here = np.flatnonzero(found >= 0)
                at[found[here]] = before + here
                before += len(found)
        return at

    def _segments(self, places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The segments of ascending places, with the places inside."""
        ends = np.cumsum([len(w) for w in self._words], dtype=np.int64)
        cuts = np.searchsorted(places, ends).tolist()
        for k, (a, b) in enumerate(zip([0, *cuts], cuts)):
            if b > a:
                yield k, places[a:b] - (ends[k] - len(self._words[k]))

    def _ids_at(self, places: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The ids of the known words at different places, and the number of each among them."""
        order = np.argsort(places)
        rank = np.empty(len(places), dtype=np.int64)
        rank[order] = np.arange(len(places))
        some = [self._ids[k].take(pa.array(inside)) for k, inside in self._segments(places[order])]
        return pa.concat_arrays(some) if some else pa.array([], pa.large_binary()), rank

    def _places(self, words: pa.Array) -> np.ndarray:
        """Places of different words among the known ones, new ones added."""
        at = self._looked_up(words)
        new = at < 0
        if new.any():
            encoded = self._encoded_words(words.filter(pa.array(new)).to_pylist())
            at[new] = sum(map(len, self._words)) + np.arange(np.count_nonzero(new))
            self._add(pa.array(list(encoded), pa.large_string()), pa.array(list(encoded.values()), pa.large_binary()),
                      np.full(len(encoded), self._now, dtype=np.int32))
        for k, inside in self._segments(np.sort(at)):
            self._met[k][inside] = self._now
        return at

    def _ids_of(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, one text after the other with ``end`` after
        each, and where each text's ids end."""
        self._make_room()
        cut = pc.split_pattern(texts, " ")
        offsets = cut.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        starts, words = offsets[:-1], cut.flatten()
        numbered, first = words.dictionary_encode(), words.take(pa.array(starts)).dictionary_encode()
        different = numbered.dictionary.cast(pa.large_string())
        nothing, blank = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        begins = pc.binary_join_element_wise(nothing, first.dictionary.cast(pa.large_string()), blank)
        known, rank = self._ids_at(self._places(pa.concat_arrays([different, begins])))
        codes = rank[numbered.indices.to_numpy()]
        codes[starts] = rank[len(different) + first.indices.to_numpy()]

        alone = np.zeros(len(texts), dtype=bool)
        if known.null_count:
            careful = pc.is_null(known).to_numpy(zero_copy_only=False)[codes]
            if careful.any():
                alone = np.logical_or.reduceat(careful, starts)
        for special in self._special:
            if " " in special:
                alone |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        own = [self.ids_bytes(t.as_py()) for t in texts.filter(pa.array(alone))] if alone.any() else []
        # what follows the known words: the end, and the texts by themselves
        more = pa.array([struct.pack("<I", end), *own], pa.large_binary())
        known, last = pa.concat_arrays([known, more]), len(known)
        if own:
            each = np.diff(offsets)
            each_alone = np.repeat(alone, each)
            counts = np.where(alone, 1, each)
            kept = np.ones(len(codes), dtype=bool)
            kept[each_alone] = False
            kept[starts[alone]] = True
            codes[starts[alone]] = last + 1 + np.arange(len(own))
            codes, offsets = codes[kept], np.concatenate([[0], np.cumsum(counts)])
        codes = np.insert(codes, offsets[1:], last)
        taken = known.take(pa.array(codes))
        bounds = np.frombuffer(taken.buffers()[1], dtype=np.int64)[taken.offset:taken.offset + len(taken) + 1] // 4
        ends = bounds[offsets[1:] + np.arange(1, len(texts) + 1)]
        return np.frombuffer(taken.buffers()[2], dtype="<u4")[bounds[0]:bounds[-1]], ends - bounds[0]

    def encoded(self, texts: pa.Array, end: int) -> Iterator[tuple[int, np.ndarray, list[int]]]:
        """Runs of texts: the number of the first one, their ids, ``end`` after
        each text, and where the ids of each text end."""
        if not len(texts):
            return
        held = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // TOGETHER
        for at, n in zip(*(x.tolist() for x in np.unique(held, return_index=True, return_counts=True)[1:])):
            ids, ends = self._ids_of(texts.slice(at, n), end)
            yield at, ids, ends.tolist()


@lru_cache(maxsize=2)
def encoder(file: str) -> Encoder:
    return Encoder(file)
