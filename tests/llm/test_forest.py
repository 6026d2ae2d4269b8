"""The LSH forest of the Jaccard join: sorted tries, prefixes shortened for those not settled."""

import random

import numpy as np
from pyspark.sql import functions as F

from stationspark.llm import jaccard_join as jj
from stationspark.llm.shared import read_table, stored


def signs_of(sets):
    factors = jj._factors()
    return np.stack([jj.minima(np.array(sorted(s), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), factors) for s in sets])


def in_trie_order(signs, tree=0):
    own = signs[:, tree * jj.DEPTH:(tree + 1) * jj.DEPTH]
    order = np.lexsort(own.T[::-1])
    return own[order], signs[order], order


def test_a_prefix_is_shortened_only_for_those_not_settled():
    """Twins share whole prefixes; a pair less alike shares a shorter one."""
    rng = random.Random(4)
    lengths = []
    for _ in range(200):
        base = rng.sample(range(1 << 40), 300)
        far = [base[i] if i >= 24 else rng.randrange(1 << 40) for i in range(300)]
        sets = [set(base), set(base) | {1}, set(far), set(rng.sample(range(1 << 40), 300))]
        own, signs, order = in_trie_order(signs_of(sets))
        root, settled = jj.settle(own, signs, order.astype(np.int64), 0)
        by = dict(zip(order.tolist(), zip(root.tolist(), settled.tolist())))
        assert by[0][0] == by[1][0] == by[2][0] == 0 and by[3] == (3, 0)
        lengths.append([by[i][1] for i in range(3)])
    lengths = np.array(lengths)
    assert (lengths[:, 1] >= lengths[:, 2]).mean() > 0.9
    assert (lengths[:, 1] == jj.DEPTH).mean() > 0.8 and 0 < lengths[:, 2].mean() < lengths[:, 1].mean()


def test_walk_joins_what_comparing_all_pairs_joins():
    rng = np.random.default_rng(2)
    for seed in range(30):
        pool = rng.integers(0, 1 << 40, 400)
        sets = []
        for k in range(40):
            centre = pool[:120] if k % 3 else pool[140:260]
            keep = rng.random(120) < rng.uniform(0.7, 1)
            sets.append(set(centre[keep].tolist()) | set(rng.integers(0, 1 << 40, 8).tolist()))
        own, signs, order = in_trie_order(signs_of(sets), seed % jj.TREES)
        ids = order.astype(np.int64) + 1000
        linked = (signs[:, None] == signs[None]).sum(-1) >= jj.SURELY_FAR * signs.shape[1]
        root, settled = jj.settle(own, signs, ids, 0)
        assert (root == jj._roots(linked, ids)).all()
        # members of one root and the lengths: only the joined have one... down to no prefix at all
        assert (settled[(linked.sum(1) == 1)] == 0).all()


def test_every_link_is_a_candidate(spark):
    """Recall of the forest on sf0.01, against all pairs of documents that share a 5-gram."""
    docs = read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    rows = []
    for k in range(40):         # near copies of all degrees down to the threshold
        words = [f"f{k}x{i}" for i in range(200)]
        rows += [(100_000 + 2 * k, " ".join(words)),
                 (100_001 + 2 * k, " ".join(words[:50] + [f"g{k}x{i}" for i in range(k % 18)] + words[50 + k % 18:]))]
    docs = docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    signed = stored(jj.signatures(docs), "signatures").filter("n > 0")
    sets = jj._numbered(signed.groupBy("s1", "s2").agg(
        F.min("doc_id").alias("doc_id"), F.min("th").alias("th"), F.first("signature").alias("signature"),
        F.count(F.lit(1)).alias("n_equal")).withColumn("none", F.lit(False)))
    edges = stored(jj.near_edges(sets, jj.prefix_length()), "edges")
    lengths = {r["prefix"]: r["count"] for r in edges.groupBy("prefix").count().collect()}
    assert set(lengths) <= {4, 5, 6} and len(lengths) >= 2 and lengths[6] == max(lengths.values())
    root = {r["node"]: r["root"] for r in jj.components(edges).collect()}
    number = {r["doc_id"]: r["node"] for r in sets.select("doc_id", "node").collect()}
    texts = {r["doc_id"]: r["text"].split() for r in docs.filter(F.col("doc_id").isin(list(number))).collect()}
    grams = {i: {tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))} for i, w in texts.items()}
    having = {}
    for i, g in grams.items():
        for x in g:
            having.setdefault(x, []).append(i)
    pairs = {(a, b) for of in having.values() if len(of) > 1 for a in of for b in of if a < b}
    links = [(a, b) for a, b in pairs if len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b])]
    assert len(links) >= 40
    missed = [(a, b) for a, b in links if root.get(number[a], -1) != root.get(number[b], -2)]
    assert not missed
