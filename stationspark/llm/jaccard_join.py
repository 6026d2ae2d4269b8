"""N-gram Jaccard self-join through a MinHash LSH forest, verified exactly.

Two documents are linked when the Jaccard likeness of their sets of word
5-grams is 0.8 or more.

1. ``signatures``: a document's set is hashed to ``TREES * DEPTH`` minima.
   Documents of equal sets are one class from here on; only one goes on.
2. The forest: each of the ``TREES`` trees orders the documents by ``DEPTH``
   minima of its own, a prefix trie written as a sorted list.  Documents that
   share a prefix of minima share a node of the trie.
3. ``near_edges``: a trie is walked from its longest prefixes up.  Inside a node
   the whole signatures are compared, and what is not surely far (an estimate
   of ``SURELY_FAR`` or more) is joined.  Documents that are joined are settled
   in this node; the prefix is shortened for the others, and in the larger node
   that they share then, only those not yet joined with each other are compared.
   The walk ends at ``prefix_length``, the greatest length up to ``DEPTH`` at
   which a pair at the threshold shares a node of some tree with the target
   recall.  What was joined is given as an edge to the smallest member, with
   the length of the prefix that settled it.  A shortest-prefix node with many
   members is cut into blocks, and pairs of blocks are walked by different
   tasks; no pairs are written out.
4. ``components`` of the edges are the candidates: small groups in which
   links can be.
5. ``verified``: in each candidate group the sets themselves are compared,
   again in pairs of blocks.  A row for each member and pair of blocks says
   how many documents it is linked to, and the smallest member that it is
   connected with.
6. Components of these are the classes.

The result has a row for each document: ``class_id``, the smallest id of its
class; ``n_links``, the number of other documents at 0.8 or more (copies
count, without being expanded); ``n_equal``, the documents of an equal set.

Missed links: at the threshold a pair shares no node with probability
``(1 - 0.8 ** r) ** TREES``, 3e-6 for the chosen r = 4, less above it.

Defined results: a text of fewer than five words has one n-gram, all its
words; a text without words (null too) is linked to none and is its own
class; a repeated row is a document of an equal set; rows of one id are
documents of their own, each in the class of its own set; a null id is never
a class's smallest unless all are null, and then the class's id is null; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationspark.llm.shared import free_names, stored, whole_text
from stationspark.llm.shingles import Runs, hashed, mixed

NGRAM = 5
THRESHOLD = 0.8
TREES = 24
DEPTH = 6
RECALL = 0.99999
#: Estimates below come from pairs at the threshold with a chance under 1e-8.
SURELY_FAR = 0.6
#: Members of a node, and of a candidate group, that one task compares.
NODE_BLOCK = 1024
GROUP_BLOCK = 256
SEED = 7

SIGNED = "doc_id long, s1 long, s2 long, n int, signature binary, th long"


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH,
                  recall: float = RECALL) -> int:
    """The longest prefix at which the forest has the recall."""
    length = depth
    while length > 1 and 1 - (1 - threshold ** length) ** trees < recall:
        length -= 1
    return length


def ngrams(words: np.ndarray) -> np.ndarray:
    """The sorted set of a document's n-grams."""
    if not len(words):
        return words
    return np.unique(Runs(words).all(min(NGRAM, len(words))))


def _factors() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Smallest value of each hash function over the set."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(grams), 4096):
        least = np.minimum(least, (grams[i:i + 4096, None] * factors).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    factors = _factors()
    for batch in batches:
        s1, s2, n, signature = [], [], [], []
        for _, words in hashed(batch.column("text")):
            grams = ngrams(words)
            s1.append(int(grams.sum(dtype=np.uint64)) if len(grams) else 0)
            s2.append(int(mixed(grams ^ np.uint64(SEED)).sum(dtype=np.uint64)) if len(grams) else 0)
            n.append(len(grams))
            signature.append(minima(grams, factors).tobytes() if len(grams) else None)
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "s1": pa.array(np.array(s1, np.uint64).view(np.int64)),
            "s2": pa.array(np.array(s2, np.uint64).view(np.int64)), "n": pa.array(n, pa.int32()),
            "signature": pa.array(signature, pa.binary()), "th": batch.column("th")})


def _texts(docs: DataFrame) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return rows.withColumn("th", F.xxhash64("text"))


def signatures(docs: DataFrame) -> DataFrame:
    return _texts(docs).mapInArrow(_signed, SIGNED)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal keys, from sorted batches."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            here = tuple(c[a] for c in columns)
            if here != key and held:
                yield key, pa.Table.from_batches(held)
                held = []
            key = here
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def _roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each member the smallest id that it is connected with."""
    root = ids.copy()
    while True:
        least = np.where(linked, root[None, :], np.iinfo(np.int64).max).min(axis=1)
        least = np.minimum(root, least)
        if (least == root).all():
            return root
        root = least


def _blocks(rows: DataFrame, keys: list[str], size: str, order: str, per: int) -> DataFrame:
    """Rows in pairs of blocks: with ``b`` blocks in a group, a member goes to
    the ``b`` pairs ``(low, high)`` that hold its own."""
    count = F.ceil(F.col(size) / per).cast("int")
    rows = rows.withColumn("own", F.pmod(F.xxhash64(order), count).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), count - 1), lambda j: F.struct(
        F.least(j, F.col("own")).alias("low"), F.greatest(j, F.col("own")).alias("high")))
    return rows.withColumn("pair", F.explode(pair)).select(
        "*", "pair.low", "pair.high").drop("pair")


def settle(minima_of_tree: np.ndarray, signs: np.ndarray, ids: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """For each member of a node, in trie order, the smallest id that it is
    joined with, and the length of the prefix at which it first was (0: never)."""
    least, depth = SURELY_FAR * signs.shape[1], minima_of_tree.shape[1]
    if len(ids) == 2:
        near = (signs[0] == signs[1]).sum() >= least
        shared = int(np.append(minima_of_tree[0] == minima_of_tree[1], False).argmin())
        return (np.full(2, ids.min()), np.full(2, shared)) if near else (ids, np.zeros(2, dtype=np.int64))
    root, settled = ids.copy(), np.zeros(len(ids), dtype=np.int32)
    for length in range(depth, shortest - 1, -1):
        new_node = (minima_of_tree[1:, :length] != minima_of_tree[:-1, :length]).any(axis=1)
        cuts = [0, *(np.flatnonzero(new_node) + 1).tolist(), len(ids)]
        for a, b in zip(cuts, cuts[1:]):
            own = root[a:b]
            if (own == own[0]).all():
                continue
            here = signs[a:b]
            linked = own[:, None] == own[None, :]
            for i in range(b - a):
                # only with those that it is not yet joined with
                other = np.flatnonzero(~linked[i, i + 1:]) + i + 1
                if other.size:
                    hit = other[(here[other] == here[i]).sum(axis=1) >= least]
                    linked[i, hit] = linked[hit, i] = True
            joined = _roots(linked, ids[a:b])
            grown = (linked.sum(axis=1) > 1) & (settled[a:b] == 0)
            settled[a:b][grown] = length
            # whatever carries a root that was joined takes the new one
            for old, now in {(o, n) for o, n in zip(own.tolist(), joined.tolist()) if o != n}:
                root[root == old] = min(old, now)
    return root, settled


def _node_edges(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, *_), rows in _grouped(batches, ["tree", "prefix", "low", "high"]):
            ids = rows.column("node").to_numpy()
            if len(ids) < 2:
                continue
            signs = np.frombuffer(b"".join(rows.column("signature").to_pylist()), dtype=np.uint32).reshape(len(ids), -1)
            root, settled = settle(signs[:, tree * DEPTH:(tree + 1) * DEPTH], signs, ids, shortest)
            keep = root != ids
            if keep.any():
                yield pa.RecordBatch.from_pydict({"a": pa.array(ids[keep]), "b": pa.array(root[keep]),
                                                  "prefix": pa.array(settled[keep].astype(np.int32))})

    return run


def near_edges(sets: DataFrame, length: int) -> DataFrame:
    """``(a, b, prefix)``: edges inside shared nodes of the tries, and the
    length of the prefix at which ``a`` was settled.

    ``sets`` has ``node`` (the number of a class of equal sets) and its
    ``signature``.
    """
    starts = F.sequence(F.lit(0), F.lit(TREES - 1))
    prefixes = F.transform(starts, lambda t: F.xxhash64(F.substring("signature", t * (4 * DEPTH) + 1, F.lit(4 * length))))
    members = sets.select("node", F.posexplode(prefixes).alias("tree", "prefix"))
    shared = members.groupBy("tree", "prefix").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    members = stored(members.join(shared, ["tree", "prefix"]), "trie-members")
    rows = _blocks(members.join(sets.select("node", "signature"), "node"), ["tree", "prefix"], "members", "node", NODE_BLOCK)
    # the rest of the tree's minima: rows of a node lie in the order of the trie
    rest = F.substring(F.col("signature"), F.col("tree") * (4 * DEPTH) + (4 * length + 1), F.lit(4 * (DEPTH - length)))
    keys = ["tree", "prefix", "low", "high"]
    rows = rows.withColumn("rest", rest).repartition(*keys).sortWithinPartitions(*keys, "rest", "node")
    return rows.select(*keys, "node", "signature").mapInArrow(_node_edges(length), "a long, b long, prefix int")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge: the smallest connected id.

    Each round a node takes the smallest root among its neighbours, then the
    root of that root; rounds go with the logarithm of a chain's length.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                  "edges")
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "roots")
    while True:
        near = (both.join(roots, both["b"] == roots["node"]).groupBy("a").agg(F.min("root").alias("near")))
        step = roots.join(near, roots["node"] == near["a"]).select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        above = roots.select(F.col("node").alias("up"), F.col("root").alias("top"))
        step = stored(step.join(above, step["root"] == above["up"]).select(
            "node", "old", F.least("root", "top").alias("root")), "roots")
        if step.filter("root <> old").isEmpty():
            return step.select("node", "root")
        roots = step.select("node", "root")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams = [ngrams(words).view(np.int64) for _, words in hashed(batch.column("text"))]
        rest = [c for c in batch.schema.names if c != "text"]
        yield pa.RecordBatch.from_pydict({c: batch.column(c) for c in rest} | {
            "grams": pa.array(grams, pa.list_(pa.int64()))})


def common(sets: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all intersections, ``columns`` different members at a time."""
    sizes = [len(s) for s in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    different, at = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for i in range(0, len(different), columns):
        a, b = np.searchsorted(at, [i, i + columns])
        has = np.zeros((len(sets), min(columns, len(different) - i)), dtype=np.float32)
        has[owner[a:b], at[a:b] - i] = 1
        out += has @ has.T
    return out


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for (_, low, high), rows in _grouped(batches, ["root", "low", "high"]):
        ids = rows.column("node").to_numpy()
        if len(ids) < 2:
            continue
        grams = [np.asarray(g.values) for g in rows.column("grams").combine_chunks()]
        weight, own = rows.column("n_equal").to_numpy(), rows.column("own").to_numpy()
        inside = common(grams)
        sizes = np.diag(inside)
        linked = inside / (sizes[:, None] + sizes[None, :] - inside) >= THRESHOLD
        np.fill_diagonal(linked, False)
        counted = linked if low == high else linked & (own[:, None] != own[None, :])
        yield pa.RecordBatch.from_pydict({
            "node": pa.array(ids), "links": pa.array((counted * weight[None, :]).sum(axis=1)),
            "near": pa.array(_roots(linked, ids))})


def verified(docs: DataFrame, sets: DataFrame, candidates: DataFrame) -> DataFrame:
    """``(node, links, near)`` for every candidate and pair of blocks."""
    size = candidates.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    wanted = (candidates.join(size, "root").join(sets.select("node", "doc_id", "th", "n_equal"), "node"))
    wanted = wanted.withColumnRenamed("doc_id", "of")
    texts = _texts(docs)
    # one row of those that are alike in id and text
    found = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["of"]) & (texts["th"] == wanted["th"])).select(
        "node", "root", "members", "n_equal", "text")
    rows = found.mapInArrow(_sets, "node long, root long, members long, n_equal long, grams array<long>").dropDuplicates(["node"])
    rows = _blocks(rows, ["root"], "members", "node", GROUP_BLOCK)
    rows = rows.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high", "node")
    return rows.select("root", "low", "high", "node", "own", "n_equal", "grams").mapInArrow(
        _links, "node long, links long, near long")


def _numbered(sets: DataFrame) -> DataFrame:
    """``node``: a number of each set's own, in the order of the smallest ids,
    null ones last; so the smallest node of a class has its smallest id."""
    order = ["none", "doc_id", "th", "s1", "s2"]
    rows = sets.repartitionByRange(*order).sortWithinPartitions(*order)
    # written at once: the numbers hold for this order of partitions
    return stored(rows.withColumn("node", F.monotonically_increasing_id()), "gram-sets")


def _classes(docs: DataFrame) -> DataFrame:
    """Every document with ``class_id, n_links, n_equal``, and whether it is
    the first of its class by id and text (``stays``)."""
    signed = stored(signatures(docs), "signatures")
    narrow = signed.select("doc_id", "s1", "s2", "n", "th")
    # the smallest id of a set, with its text, stands for all
    sets = (signed.filter("n > 0").groupBy("s1", "s2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("first"),
        F.first("signature").alias("signature"), F.count(F.lit(1)).alias("n_equal")))
    sets = _numbered(sets.select("s1", "s2", "first.none", "first.doc_id", "first.th", "signature", "n_equal"))
    candidates = stored(components(near_edges(sets, prefix_length())), "candidates")
    links = stored(verified(docs, sets, candidates), "links")
    classes = components(links.filter("node <> near").select(F.col("node").alias("a"), F.col("near").alias("b")))
    roots = sets.select(F.col("node").alias("root"), F.col("doc_id").alias("root_id"))
    classes = classes.join(roots, "root")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    sets = (sets.select("s1", "s2", "node", F.col("doc_id").alias("first_id"), F.col("th").alias("first_th"), "n_equal")
            .join(classes, "node", "left").join(counts, "node", "left"))
    alone = F.col("root").isNull()
    sets = sets.select("s1", "s2", "n_equal", "first_id", "first_th", (alone | (F.col("root") == F.col("node"))).alias("leads"),
                       F.when(alone, F.col("first_id")).otherwise(F.col("root_id")).alias("class_of"),
                       (F.coalesce("links", F.lit(0)) + F.col("n_equal") - 1).alias("links"))
    out = narrow.join(sets, ["s1", "s2"], "left")
    blank = F.col("n") == 0
    first = F.col("leads") & F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("th") == F.col("first_th"))
    return out.select("doc_id", "th", blank.alias("blank"), F.when(blank, F.col("doc_id")).otherwise(F.col("class_of")).alias("class_id"),
                      F.when(blank, F.lit(0)).otherwise(F.col("links")).cast("long").alias("n_links"),
                      F.when(blank, F.lit(1)).otherwise(F.col("n_equal")).cast("long").alias("n_equal"),
                      (blank | first).alias("stays"))


def join(docs: DataFrame) -> DataFrame:
    """``(doc_id, class_id, n_links, n_equal)`` of every document."""
    return _classes(docs).select("doc_id", "class_id", "n_links", "n_equal")


def survivors(docs: DataFrame) -> DataFrame:
    """The smallest id of each class, with all columns; one row of those alike
    in id and text, but all texts without words."""
    own_id, own_hash, is_many, is_blank, own = free_names(docs, "__id", "__th", "__many", "__blank", "__own")
    stay = stored(_classes(docs).filter("stays").groupBy(F.col("doc_id").alias(own_id), F.col("th").alias(own_hash))
                  .agg((F.count(F.lit(1)) > 1).alias(is_many), F.first("blank").alias(is_blank)), "near-stay")
    rows = docs.withColumn(own, F.xxhash64(whole_text()))

    def kept(some: DataFrame) -> DataFrame:
        return rows.join(some, rows["doc_id"].cast("long").eqNullSafe(some[own_id]) & (rows[own] == some[own_hash]), "left_semi")

    # few texts, if any, go through the shuffle of dropDuplicates
    twice = F.col(is_many) & ~F.col(is_blank)
    repeated = stay.filter(twice)
    out = kept(stay.filter(~twice))
    if not repeated.isEmpty():
        out = out.unionByName(kept(repeated).dropDuplicates(["doc_id", own]))
    return out.select(*docs.columns)
