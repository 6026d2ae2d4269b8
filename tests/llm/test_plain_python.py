"""Fingerprints, languages and toxicity against plain Python and the given labels."""

import collections
import math
import re
import struct
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F

from stationspark.llm import fingerprints, language_id, toxicity
from stationspark.llm.shared import read_table

SMALL = "/root/testdata/sf0.001"


# ---------------------------------------------------------- fingerprints ---

def hash_of(text):
    return signed(xxhash.xxh64_intdigest(text.encode(), 42))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(*longs):
    seed = 42
    for v in longs:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return signed(seed)


def plain_anchors(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    units = []
    for w in words:
        units += re.findall("(?s)^[^\u4e00-\u9fff\u3040-\u30ff\u0e00-\u0e7f]{1,32}|.", w)
    h = [hash_of(u) for u in units]
    top = lambda v: (v & (1 << 64) - 1) >> 32
    if len(h) < 5:
        return [top(chained(*h))] if h else []
    s = [chained(a, b) for a, b in zip(h, h[1:])]
    places = range(len(h) - 4)
    value = {i: top(chained(s[i], s[i + 2], h[i + 4])) for i in places}
    chosen = [i for i in places if min(s[i + 1], s[i + 2]) >= min(s[i], s[i + 3])]
    if not chosen:
        chosen = [min(places, key=lambda i: (value[i], i))]
    return [i << 32 | value[i] for i in chosen]


def likeness(a, b):
    a, b = set(a), set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_anchors_and_likenesses_in_plain_python(spark, small):
    docs, plain = small
    extra = [(100_000, "日本語 の文章 と words"), (100_001, "x" * 500 + " y"), (100_002, "a b c"), (100_003, ""), (100_004, "z" * 33), (100_005, "ab日cd" * 20 + "e" * 60)]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    texts = dict(zip(plain.doc_id, plain.text)) | dict(extra)
    got = {r["doc_id"]: r for r in fingerprints.compare_with_edits(docs).collect()}
    ids = sorted(texts, reverse=True)
    for i, nxt in zip(ids, ids[1:] + ids[:1]):
        own, n = plain_anchors(texts[i]), len(texts[i])
        edited = plain_anchors(texts[i][:n - n // 3] + texts[nxt][:n // 3])
        low = lambda found: [a & 0xFFFFFFFF for a in found]
        row = got[i]
        assert row["fingerprint"] == "".join(f"{v:08x}" for v in low(own))
        assert row["edited_fingerprint"] == "".join(f"{v:08x}" for v in low(edited))
        assert row["near_edited"] == likeness(low(own), low(edited))
        assert row["near_next"] == likeness(low(own), low(plain_anchors(texts[nxt])))
        assert row["same_place"] == (len(set(own) & set(edited)) / len(own) if own else 1.0)


# ------------------------------------------------------------- languages ---

B = language_id.BUCKETS


def plain_trigrams(text):
    data = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in text.encode()]
    return [((a << 16 | b << 8 | c) * 0x9E3779B1 % (1 << 32)) >> 19 for a, b, c in zip(data, data[1:], data[2:]) if b != 32]


def plain_languages(items):
    """``items``: id -> (text, declared, host, suffix).  Bayes' rule, item by item."""
    names = sorted({d for _, d, _, _ in items.values() if d})
    grams = {i: collections.Counter(plain_trigrams(t)) for i, (t, *_) in items.items()}
    count = {n: collections.Counter() for n in names}
    corpus = collections.Counter()
    for i, (_, d, _, _) in items.items():
        if d:
            count[d] += grams[i]
            corpus += grams[i]
    start, total = language_id.TRIGRAM_START, sum(corpus.values())
    model = {n: [count[n][b] + start * (1 + B * corpus[b] / max(1, total)) for b in range(B)] for n in names}
    sums = {n: sum(model[n]) for n in names}
    evidence = {}
    for i, (_, d, _, _) in items.items():
        k = sum(grams[i].values())
        logs = {}
        for n in names:
            if n == d and k:
                whole = max(sums[n] - k, start * B)
                logs[n] = sum(c * math.log(max(model[n][b] - c, start)) for b, c in grams[i].items()) - k * math.log(whole)
            else:
                logs[n] = sum(c * math.log(model[n][b] / sums[n]) for b, c in grams[i].items())
        top = max(logs.values())
        evidence[i] = {n: language_id.TEMPER * (v - top) for n, v in logs.items()}
    text = {}
    for i, e in evidence.items():
        whole = sum(map(math.exp, e.values()))
        text[i] = {n: math.exp(v) / whole for n, v in e.items()}
    every = {n: 1 + sum(t[n] for t in text.values()) for n in names}
    every = {n: v / sum(every.values()) for n, v in every.items()}
    odds = {d: {n: language_id.CODE_START for n in names} for d in [*names, None]}
    for i, (_, d, _, _) in items.items():
        for n in names:
            odds[d][n] += text[i][n]
    column = {n: sum(o[n] for o in odds.values()) for n in names}
    s = language_id.STRENGTH
    out = {}
    for i, (_, d, host, suffix) in items.items():
        above = {n: sum(text[j][n] for j, x in items.items() if x[3] == suffix) for n in names}
        own = {n: sum(text[j][n] for j, x in items.items() if x[2:] == (host, suffix) and j != i) for n in names}
        share = {n: (above[n] + s * every[n]) / (sum(above.values()) + s) for n in names}
        prior = {n: (own[n] + s * share[n]) / (sum(own.values()) + s) for n in names}
        weight = {n: prior[n] * odds[d][n] / column[n] * math.exp(evidence[i][n]) for n in names}
        best = max(weight, key=weight.get)
        out[i] = (best, weight[best] / sum(weight.values()))
    return out


def test_languages_by_bayes_rule_in_plain_python(spark, small):
    docs, plain = small
    items = {r.doc_id: (r.text or "", r.lang, r.source, None) for r in plain.itertuples()}
    got = {r["id"]: r for r in language_id.identify(language_id.from_documents(docs)).collect()}
    want = plain_languages(items)
    assert len(got) == len(want)
    for i, (language, probability) in want.items():
        assert got[i]["language"] == language
        assert got[i]["probability"] == pytest.approx(probability, abs=1e-4)


def test_stored_evidence_does_not_grow_with_the_codes(spark, small):
    """Two thousand declared codes, a text each, beside the four languages."""
    docs, _ = small
    items = language_id.from_documents(docs)
    letters = "abcdefghijklm"
    codes = [a + b + c for a in letters for b in letters for c in letters][:2000]
    rare = spark.createDataFrame([(10_000 + i, f"{c * 40} {c[::-1] * 40}", c, "h", None) for i, c in enumerate(codes)],
                                 "id long, text string, declared string, host string, suffix string")
    long = items.filter("length(text) > 1000")

    def mean(all_items):
        names = language_id.languages(all_items)
        read = language_id.read_texts(long, names, language_id.text_model(all_items, names))
        return read.agg(F.avg(F.size("evidence"))).first()[0]

    few, many = mean(items), mean(items.unionByName(rare))
    assert few <= 4 and many <= few + 1


# -------------------------------------------------------------- toxicity ---

@pytest.mark.parametrize("sf,least_recall,least_precision", [("sf0.01", 0.6, 1.0), ("sf0.1", 0.9, 0.95)])
def test_held_out_labels(spark, sf, least_recall, least_precision):
    docs, labels = (read_table(spark, f"/root/testdata/{sf}", t) for t in ("documents", "labels"))
    got = {r["doc_id"]: r for r in toxicity.classify(docs, labels).collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    assert toxic and all(got[i]["held_out"] for i in toxic if i in got)
    caught = sum(got[i]["predicted"] for i, t in toxic.items() if t)
    false = sum(got[i]["predicted"] for i, t in toxic.items() if not t)
    assert caught >= least_recall * sum(toxic.values()) and caught >= least_precision * (caught + false)


def test_evidence_of_a_cue_in_plain_python(spark):
    rows = [("a", 10, 10), ("b", 10, 1), ("c", 5, 0), ("d", 1, 1)]
    got = toxicity.evidence(spark.createDataFrame(rows, "cue string, n long, toxic long"), 0.1).collect()
    for (_, n, k), r in zip(rows, sorted(got, key=lambda r: r["cue"])):
        parts = [(k, k / n, 0.1), (n - k, 1 - k / n, 0.9)]
        assert r["evidence"] == pytest.approx(2 * sum(m * math.log(p / q) for m, p, q in parts if m))
        assert r["share"] == pytest.approx((k + 0.1) / (n + 1))
