"""Language identification by fusing evidence with Bayes' rule.

An item has a text and may have a declared language, a host and an address
suffix (the last label of the host name).

1. ``text_model``: letter trigrams (of bytes, in ``BUCKETS`` hash buckets) are
   counted over all texts by declared language; smoothed towards equal odds
   and towards the whole corpus, they give the likelihood of a text in each
   language.  Every declared code is a language, however rare.
2. ``read_texts``: every whole text's log likelihoods, tempered, because
   overlapping trigrams are not independent.  A text's own trigrams are taken
   out of those of its declared language, so it does not vouch for its code by
   itself.  Kept with a text are the languages within ``KEPT_EVIDENCE`` of the
   best one: a few, however many codes are declared.
3. ``host_priors``: grouped sums of these posteriors, smoothed down a
   hierarchy: all items, the suffix, the host.  A group of n items weighs n
   against ``STRENGTH`` items of the group above.  An item's own posterior is
   taken out of its host's sum, so a text does not vouch for itself.
4. ``declared_odds``: how often each code is declared in each language, from
   the same posteriors; a wrong or missing declaration is thus no more than
   weak evidence.
5. ``identify``: prior times declared odds times text likelihood.

An item is accepted when the best language has ``LEAST_PROBABILITY`` and its
text reads like a language: some letters, and not less likely under the best
language than under equal odds of all buckets, with ``READABLE`` in its favour.
Both tests count by the trust in the declared code, which grows smoothly with
the trigrams of its other texts: a code that no other text has can reject none.

Only tables with a row for each language and bucket or code are brought to the
driver (a code has two or three letters, so there are 18,252 at most; its model
is 64 KB); hosts are joined, suffixes too unless there are few.

Defined results: a null or letterless text has language ``und`` and is not
accepted; a null or unknown declaration is a code of its own; a null host is a
host; a repeated row is an item like any other; with no declared language at
all everything is ``und``.  An empty table gives no rows.  Extra columns are
kept by ``accepted_rows`` and ignored elsewhere.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationspark.llm.shared import free_names, stored, whole_text

BUCKETS = 8192
#: Trigrams of a declared code's other texts that give it half of full trust.
HALF_TRUST = float(BUCKETS)
#: Share of a text's log likelihood that counts as independent evidence.
TEMPER = 1 / 3
#: Items of the group above that a group is smoothed with.
STRENGTH = 20.0
#: Added to the counts of trigrams (as much again is dealt out like the whole
#: corpus), and of declared codes.
TRIGRAM_START = 0.1
CODE_START = 0.5
LEAST_PROBABILITY = 0.5
#: Log odds for a text's being in some language, before it is read: so much
#: less likely than chance it may be, as a sentence around a key or an address is.
READABLE = 120.0
#: Tempered log likelihood that a language may lack to the best one; those that
#: lack more (a factor of 1e-13) are not kept with a text.
KEPT_EVIDENCE = 30.0
#: Suffixes up to which their table is broadcast.
MOST_SUFFIXES = 10_000
#: Bytes of texts that a task works on at a time.
CHUNK_BYTES = 1 << 18
#: Languages whose counts a task holds before it hands them on.
HELD_LANGUAGES = 256

_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def code(column: Column) -> Column:
    """A declared language without region, lower case."""
    return F.nullif(F.regexp_extract(F.lower(column), "^([a-z]{2,3})(?![a-z])", 1), F.lit(""))


def from_documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), whole_text().alias("text"),
                       code(F.col("lang").cast("string")).alias("declared"),
                       F.col("source").cast("string").alias("host"), F.lit(None).cast("string").alias("suffix"))


_REFERENCE = re.compile(r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);?")


def _character(found: re.Match) -> str:
    """What a character reference stands for; a blank for signs and unknown
    names."""
    decoded = markup.unescape(found[0])
    if decoded == found[0] or decoded.isspace():
        return " "
    return decoded if decoded.isalnum() or not decoded.isascii() else " "


def _limits(texts: pa.Array) -> np.ndarray:
    """Where each text begins in the column's bytes, and where the last ends."""
    return np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)


def _chunks(limits: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and end row of some rows at a time, of ``CHUNK_BYTES`` or a single text."""
    row, rows = 0, len(limits) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(limits, limits[row] + CHUNK_BYTES, side="right")) - 1)
        end = min(end, rows)
        yield row, end
        row = end


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's texts are Python's strings a chunk at a time, never all."""
    for batch in batches:
        if not batch.num_rows:
            continue
        for row, end in _chunks(_limits(batch.column("text"))):
            some = batch.slice(row, end - row)
            texts = [_REFERENCE.sub(_character, t) if "&" in t else t for t in some.column("text").to_pylist()]
            yield some.set_column(some.schema.get_field_index("text"), "text", pa.array(texts, some.schema.field("text").type))


def from_pages(pages: DataFrame) -> DataFrame:
    """Text and evidence of raw pages; a malformed address has no host."""
    html, host = F.coalesce(F.col("html"), F.lit("")), F.lower(F.try_parse_url("url", F.lit("HOST")))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    declared = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z-]+)", 1)
    rows = pages.select(F.col("page_id").cast("long").alias("id"), text.alias("text"), code(declared).alias("declared"),
                        host.alias("host"), F.element_at(F.split(host, r"\."), -1).alias("suffix"))
    # after the tags are gone: a reference to "<" opens none
    return rows.mapInArrow(_decoded, rows.schema)


def _trigrams(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, buckets, owner)``: the letter trigrams of some
    rows, and the row of each from the first on."""
    if not len(texts):
        return
    limits = _limits(texts)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    for row, end in _chunks(limits):
        some = _FOLD[data[limits[row]:limits[end]]].astype(np.uint32)
        owner = np.repeat(np.arange(end - row), np.diff(limits[row:end + 1]))
        if len(some) < 3:
            yield row, end, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        else:
            three = (some[:-2] << np.uint32(16)) | (some[1:-1] << np.uint32(8)) | some[2:]
            # a letter in the middle, and one text only
            use = (some[1:-1] != 32) & (owner[:-2] == owner[2:])
            three = three[use] * np.uint32(0x9E3779B1)
            yield row, end, (three >> np.uint32(19)).astype(np.int64), owner[:-2][use]


def languages(items: DataFrame) -> list[str]:
    rows = items.filter("declared is not null").select("declared").distinct().collect()
    return sorted(r["declared"] for r in rows)


def text_model(items: DataFrame, names: list[str]) -> np.ndarray:
    """Smoothed counts, a row for each language and a column for each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, place = {}, {n: i for i, n in enumerate(names)}

        def handed_on() -> pa.RecordBatch:
            language = np.fromiter(sums, dtype=np.int32, count=len(sums))
            table = np.stack(list(sums.values())) if sums else np.zeros((0, BUCKETS), dtype=np.int64)
            at, bucket = np.nonzero(table)
            return pa.RecordBatch.from_pydict({"language": pa.array(language[at], pa.int32()),
                                               "bucket": pa.array(bucket, pa.int32()), "n": pa.array(table[at, bucket], pa.int64())})

        for batch in batches:
            of = np.array([place.get(d, -1) for d in batch.column("declared").to_pylist()], dtype=np.int64)
            for row, end, buckets, owner in _trigrams(batch.column("text")):
                there, local = np.unique(of[row:end], return_inverse=True)
                for i in range(0, len(there), HELD_LANGUAGES):
                    some = there[i:i + HELD_LANGUAGES]
                    at = local[owner] - i
                    inside = (at >= 0) & (at < len(some))
                    table = np.bincount(at[inside] * BUCKETS + buckets[inside], minlength=len(some) * BUCKETS)
                    for language, counts in zip(some.tolist(), table.reshape(len(some), BUCKETS)):
                        if language >= 0:
                            sums[language] = sums[language] + counts if language in sums else counts
                    if len(sums) >= HELD_LANGUAGES:
                        yield handed_on()
                        sums.clear()
        yield handed_on()

    counts = items.select("text", "declared").mapInArrow(count, "language int, bucket int, n long")
    rows = counts.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((len(names), BUCKETS))
    table[rows.column("language").to_numpy(), rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    corpus = table.sum(axis=0)
    return table + TRIGRAM_START * (1 + BUCKETS * corpus / max(1.0, corpus.sum()))


def _alone(logs: np.ndarray, model: np.ndarray, own: np.ndarray, buckets: np.ndarray, owner: np.ndarray) -> None:
    """Sets the rows' log likelihoods in their own languages to those without
    their own trigrams."""
    keys, k = np.unique(owner * BUCKETS + buckets, return_counts=True)
    row, bucket = np.divmod(keys, BUCKETS)
    left = np.maximum(model[own[row], bucket] - k, TRIGRAM_START)
    counts = np.bincount(row, weights=k, minlength=len(own))
    here = np.flatnonzero(counts)
    total = np.maximum(model[own[here]].sum(axis=1) - counts[here], TRIGRAM_START * BUCKETS)
    logs[here, own[here]] = np.bincount(row, weights=k * np.log(left), minlength=len(own))[here] - counts[here] * np.log(total)


def trust(known: np.ndarray) -> np.ndarray:
    """Weight of a code's model against what is unlike it, from 0 to 1 with
    the trigrams of its other texts."""
    return known / (known + HALF_TRUST)


def read_texts(items: DataFrame, names: list[str], model: np.ndarray) -> DataFrame:
    """``id, declared, host, suffix, evidence, readable, trust``; the items
    are among those that the model is fitted on.  ``evidence`` has a language
    and its tempered log likelihood below the best one's, for the few that are
    near the best, however many languages there are."""
    best_chance = float(-np.log(BUCKETS))
    place = {n: i for i, n in enumerate(names)}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = model.sum(axis=1)
        known = totals - 2 * TRIGRAM_START * BUCKETS
        chances = (np.log(model) - np.log(totals)[:, None]).astype(np.float32)
        for batch in batches:
            of = np.array([place.get(d, -1) for d in batch.column("declared").to_pylist()], dtype=np.int64)
            for row, end, buckets, owner in _trigrams(batch.column("text")):
                own, counts = of[row:end], np.bincount(owner, minlength=end - row)
                logs = np.stack([np.bincount(owner, weights=m[buckets], minlength=end - row) for m in chances], axis=1)
                mine = (own >= 0)[owner]
                if mine.any():
                    _alone(logs, model, own, buckets[mine], owner[mine])
                trusted = np.where(own >= 0, trust(np.maximum(known[own] - counts, 0.0)), 1.0)
                # without any trust twice the chance's log is allowed, as much as unknown trigrams cost
                likely = logs.max(axis=1) > (2 - trusted) * best_chance * counts - READABLE
                evidence = TEMPER * (logs - logs.max(axis=1, keepdims=True))
                at, language = np.nonzero(evidence >= -KEPT_EVIDENCE)
                offsets = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=end - row))]).astype(np.int32)
                pairs = pa.StructArray.from_arrays(
                    [pa.array(language.astype(np.int32)), pa.array(evidence[at, language].astype(np.float32))], ["language", "e"])
                rows = batch.slice(row, end - row)
                letters = pc.match_substring_regex(rows.column("text"), r"[A-Za-z]|[^\x00-\x7F]").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pydict({c: rows.column(c) for c in ("id", "declared", "host", "suffix")} | {
                    "evidence": pa.ListArray.from_arrays(offsets, pairs), "readable": pa.array(letters & likely),
                    "trust": pa.array(trusted)})

    return items.mapInArrow(read, "id long, declared string, host string, suffix string, "
                                  "evidence array<struct<language int, e float>>, readable boolean, trust double")


def _pairs(column: pa.Array, value: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, language and value of every pair of a column of lists."""
    owner = np.repeat(np.arange(len(column)), pc.fill_null(column.value_lengths(), 0).to_numpy())
    pairs = column.flatten()
    return (owner, pairs.field("language").to_numpy().astype(np.int64),
            pairs.field(value).to_numpy(zero_copy_only=False).astype(np.float64))


def _by_text(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, language, evidence and posterior by text alone of every pair."""
    row, language, evidence = _pairs(batch.column("evidence"), "e")
    weights = np.exp(evidence)
    return row, language, evidence, weights / np.bincount(row, weights=weights, minlength=batch.num_rows)[row]


def posterior_sums(read: DataFrame, n: int) -> DataFrame:
    """``(host, suffix, declared, language, s)``: the sums of each language's
    posteriors, of readable texts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = pd.DataFrame({c: batch.column(c).to_pandas() for c in ("host", "suffix", "declared")})
            group = keys.groupby(["host", "suffix", "declared"], dropna=False, sort=False).ngroup().to_numpy()
            row, language, _, posteriors = _by_text(batch)
            key, inverse = np.unique(group[row] * n + language, return_inverse=True)
            # any row of a group has its keys
            member = np.zeros(int(group.max(initial=-1)) + 1, dtype=np.int64)
            member[group] = np.arange(len(group))
            first = pa.array(member[key // n])
            yield pa.RecordBatch.from_pydict({c: batch.column(c).take(first) for c in ("host", "suffix", "declared")} | {
                "language": pa.array(key % n, pa.int32()), "s": pa.array(np.bincount(inverse, weights=posteriors, minlength=len(key)))})

    parts = read.filter("readable").select("host", "suffix", "declared", "evidence").mapInArrow(
        add, "host string, suffix string, declared string, language int, s double")
    return stored(parts.groupBy("host", "suffix", "declared", "language").agg(F.sum("s").alias("s")), "posterior-sums")


def host_priors(sums: DataFrame, n: int) -> tuple[DataFrame, DataFrame, np.ndarray]:
    """``(of_host, of_suffix, sums)`` for the hosts and ``(suffix_of, above)``
    for the suffixes with readable texts, as lists of languages' sums; the
    smoothed shares of all items."""
    listed = F.collect_list(F.struct("language", "s"))
    hosts = sums.groupBy("host", "suffix", "language").agg(F.sum("s").alias("s"))
    suffixes = hosts.groupBy("suffix", "language").agg(F.sum("s").alias("s"))
    every = np.ones(n)
    for r in suffixes.groupBy("language").agg(F.sum("s").alias("s")).collect():
        every[r["language"]] += r["s"]
    return (hosts.groupBy(F.col("host").alias("of_host"), F.col("suffix").alias("of_suffix")).agg(listed.alias("sums")),
            suffixes.groupBy(F.col("suffix").alias("suffix_of")).agg(listed.alias("above")), every / every.sum())


def declared_odds(sums: DataFrame, names: list[str]) -> np.ndarray:
    """For each code, and last for none, the log probability that a text of
    each language declares it."""
    place = {c: i for i, c in enumerate(names)}
    table = np.full((len(names) + 1, len(names)), CODE_START)
    rows = sums.groupBy("declared", "language").agg(F.sum("s").alias("s")).toArrow()
    code_of = np.array([place.get(d, len(names)) for d in rows.column("declared").to_pylist()], dtype=np.int64)
    np.add.at(table, (code_of, rows.column("language").to_numpy()), rows.column("s").to_numpy())
    return np.log(table) - np.log(table.sum(axis=0, keepdims=True))


def _of_pairs(keys: np.ndarray, own: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The values of those ``keys`` that are among ``own`` (ascending), else 0."""
    if not len(own):
        return np.zeros(len(keys))
    at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
    return np.where(own[at] == keys, values[at], 0.0)


def _sorted_pairs(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    row, language, s = _pairs(column, "s")
    keys = row * n + language
    order = np.argsort(keys)
    return keys[order], s[order]


def fused_priors(row: np.ndarray, language: np.ndarray, mine: np.ndarray, sums: pa.Array, above: pa.Array,
                 every: np.ndarray) -> np.ndarray:
    """For every pair of row and language the host's share of the language,
    without the row's own part ``mine``, smoothed with the suffix's share, and
    that with the share of all."""
    n, rows = len(every), len(sums)
    keys = row * n + language
    own_keys, own = _sorted_pairs(above, n)
    of_suffix = np.bincount(own_keys // n, weights=own, minlength=rows)
    suffix_share = (_of_pairs(keys, own_keys, own) + STRENGTH * every[language]) / (of_suffix[row] + STRENGTH)
    own_keys, own = _sorted_pairs(sums, n)
    order = np.argsort(keys)
    others = np.maximum(own - _of_pairs(own_keys, keys[order], mine[order]), 0.0)
    of_host = np.bincount(own_keys // n, weights=others, minlength=rows)
    return (_of_pairs(keys, own_keys, others) + STRENGTH * suffix_share) / (of_host[row] + STRENGTH)


def identify(items: DataFrame, model_items: DataFrame | None = None) -> DataFrame:
    """``(id, language, probability, text_language, declared, accepted)`` of
    every item; the text model may be fitted on more items."""
    names = languages(model_items or items)
    if not names:
        return items.select("id", F.lit("und").alias("language"), F.lit(0.0).alias("probability"),
                            F.lit("und").alias("text_language"), "declared", F.lit(False).alias("accepted"))
    n, place = len(names), {c: i for i, c in enumerate(names)}
    read = stored(read_texts(items, names, text_model(model_items or items, names)), "read-texts")
    sums = posterior_sums(read, n)
    odds, (hosts, suffixes, every) = declared_odds(sums, names), host_priors(sums, n)
    rows = read.join(hosts, read["host"].eqNullSafe(hosts["of_host"]) & read["suffix"].eqNullSafe(hosts["of_suffix"]), "left")
    side = F.broadcast(suffixes) if suffixes.count() <= MOST_SUFFIXES else suffixes
    rows = rows.join(side, rows["suffix"].eqNullSafe(suffixes["suffix_of"]), "left")

    def fuse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = np.array([*names, "und"], dtype=object)
        for batch in batches:
            if not batch.num_rows:
                continue
            row, language, evidence, by_text = _by_text(batch)
            readable = batch.column("readable").to_numpy(zero_copy_only=False)
            prior = fused_priors(row, language, by_text * readable[row], batch.column("sums"), batch.column("above"), every)
            said = np.array([place.get(d, n) for d in batch.column("declared").to_pylist()], dtype=np.int64)
            logs = np.log(prior) + odds[said[row], language] + evidence
            # every text has its best language's pair; pairs lie row by row
            starts = np.searchsorted(row, np.arange(batch.num_rows))
            top = np.maximum.reduceat(logs, starts)
            weights = np.exp(logs - top[row])
            best = 1 / np.add.reduceat(weights, starts)
            first = lambda hit: language[np.flatnonzero(hit)[np.searchsorted(row[hit], np.arange(batch.num_rows))]]
            named, by_words = first(logs == top[row]), first(by_text == np.maximum.reduceat(by_text, starts)[row])
            trusted = batch.column("trust").to_numpy()
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"),
                "language": pa.array(codes[np.where(readable, named, n)], pa.string()),
                "probability": pa.array(np.where(readable, best, 0.0)),
                "text_language": pa.array(codes[np.where(readable, by_words, n)], pa.string()),
                "declared": batch.column("declared"),
                "accepted": pa.array(readable & (best >= LEAST_PROBABILITY * trusted))})

    return rows.select("id", "declared", "evidence", "readable", "trust", "sums", "above").mapInArrow(
        fuse, "id long, language string, probability double, text_language string, declared string, accepted boolean")


def accepted_rows(docs: DataFrame) -> DataFrame:
    """The documents with an accepted language, all their columns kept."""
    own = free_names(docs, "__id")[0]
    named = identify(from_documents(docs)).filter("accepted").select(F.col("id").alias(own)).distinct()
    return docs.join(named, docs["doc_id"].cast("long").eqNullSafe(named[own]), "left_semi")
