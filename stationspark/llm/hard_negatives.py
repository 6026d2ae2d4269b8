"""Hard negatives of anchors, by a best-first walk over an STR-packed R-tree.

The tree is packed by sort-tile-recursive: rows are cut into slabs of equal
counts along one coordinate, each slab along a second, each of those is
ordered along a third, and this order is cut into lanes and blocks; inside a
block the same is done with the coordinates that follow, down to leaves of
``LEAF`` rows.  Leaves, groups of ``FANOUT`` leaves, and lanes have the
minimum bounding box of their rows, and the least and greatest label.

A box gives an interval for the inner product with an anchor, coordinate by
coordinate: x * low and x * high, the greater of them towards the upper end.
The walk takes boxes from a queue by their upper end.  A box is left out

* when no row of it can have a wanted label;
* when its interval lies outside of every score window of the anchor;
* when its upper end is strictly below the k-th score found in every window.

First each anchor's positives are searched (its best rows of the same label),
then, with the window that each positive's score sets, its negatives.  The
walks over blocks run in different tasks; what they find meets in a window
that keeps the best of each anchor, and of each anchor and positive.

Defined results: rows without a label take no part, nor those whose vector is
null or holds a null or non-finite component; an anchor meets rows of its own
vector length; a row without an id is no anchor, keeps its label and comes
last among ties; a positive without rows in its window gives no row, so does
an anchor without positives; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationspark.llm import vectors as vec
from stationspark.llm.shared import stored

SCALE = 256
ANCHOR_EVERY = 100
POSITIVES = 5
NEGATIVES = 10
#: A negative's score, in hundredths of the positive's.
LOW, HIGH = 30, 90
#: Every such id gets the label after its own, of ``LABELS``.
MOVED_EVERY, LABELS = 7, 10

LEAF = 64
FANOUT = 8
#: Rows from which the coordinates to tile by are chosen.
SAMPLE = 2048

LEAVES = ("lane int, block int, dim int, leaf int, low array<long>, high array<long>, least long, most long, "
          "numbers array<long>, ids array<long>, labels array<long>, vectors array<long>")
LANES = "lane int, dim int, first int, last int, low array<long>, high array<long>, least long, most long"
#: An anchor that asks a block; ``low`` and ``high`` are its score windows.
ASKED = ("anchor long, label long, dim int, vector array<long>, low array<long>, high array<long>, "
         "lane int, block int, page int")
FOUND = "anchor long, window int, score long, id long, number long"
LONG = (1 << 63) - 1


# --------------------------------------------------------------- tree ------

def tile_axes(rows: DataFrame, sample: int = SAMPLE) -> list[int]:
    """Coordinates by falling spread, from a sample of at most ``sample`` rows."""
    drawn = rows.select("vector").orderBy(F.xxhash64("row_id"), "row_id").limit(sample).collect()
    width = max((len(r["vector"]) for r in drawn), default=0)
    whole = [r["vector"] for r in drawn if len(r["vector"]) == width]
    spread = np.array(whole, dtype=np.float64).reshape(len(whole), width).std(0)
    return np.argsort(-spread, kind="stable").tolist()


def _slab(value: Column, cuts: Column) -> Column:
    """In how many of the ascending cuts ``value`` is not below."""
    return F.size(F.filter(cuts, lambda c: value >= c))


def in_tiles(rows: DataFrame, axes: list[int], n_rows: int, block: int) -> DataFrame:
    """Rows in lanes and blocks, tiled along the first three coordinates."""
    at = [F.get("vector", F.lit(a)) for a in (axes + [0, 0, 0])[:3]]
    slabs = max(1, round(min(vec.MOST_LANES, -(-n_rows // block)) ** (1 / 3)))
    shares = [i / slabs for i in range(1, slabs)]
    if not shares:
        return vec.in_lanes(rows, ["dim", at[0], "row_id"], n_rows, block)
    cuts = lambda c: F.percentile_approx(c, shares, 10_000)
    first = rows.agg(cuts(at[0]).alias("cuts")).first()["cuts"] or []
    rows = rows.withColumn("slab", _slab(at[0], F.array(*[F.lit(c) for c in first])) if first else F.lit(0))
    # a row for each slab: as many as there are cuts
    second = {r["slab"]: r["cuts"] for r in rows.groupBy("slab").agg(cuts(at[1]).alias("cuts")).collect()}
    tile = F.lit(0)
    for slab, of in second.items():
        if of:
            tile = F.when(F.col("slab") == slab, _slab(at[1], F.array(*[F.lit(c) for c in of]))).otherwise(tile)
    return vec.in_lanes(rows.withColumn("tile", tile), ["dim", "slab", "tile", at[2], "row_id"], n_rows, block) \
        .drop("slab", "tile")


def pack(values: np.ndarray, leaf: int, axes: list[int]) -> list[np.ndarray]:
    """Rows of each leaf: slabs along one axis, each packed along the next."""
    def cut(rows: np.ndarray, depth: int) -> list[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1:
            return [rows]
        ordered = rows[np.argsort(values[rows, axes[depth % len(axes)]], kind="stable")] if axes else rows
        slabs = leaves if depth == 2 else max(2, round(leaves ** (1 / (3 - depth))))
        size = -(-leaves // slabs) * leaf
        return [x for i in range(0, len(ordered), size) for x in cut(ordered[i:i + size], min(depth + 1, 2))]

    return cut(np.arange(len(values)), 0)


def _leaves(axes: list[int], leaf: int):
    def run(block: pa.Table) -> pa.Table:
        out = {name: [] for name in vec.arrow_schema(LEAVES).names}
        dims = block["dim"].to_numpy()
        for dim in np.unique(dims).tolist():
            part = block.filter(pa.array(dims == dim)).combine_chunks()
            values, ids = vec.table_of(part["vector"]), part["vec_id"].to_pylist()
            labels, numbers = part["label"].to_numpy(), part["row_id"].to_numpy()
            own = [a for a in axes[3:] + axes[:3] if a < dim]
            for i, rows in enumerate(pack(values, leaf, own)):
                of = values[rows]
                for name, value in (("lane", part["lane"][0].as_py()), ("block", part["block"][0].as_py()),
                                    ("dim", dim), ("leaf", i), ("low", of.min(0)), ("high", of.max(0)),
                                    ("least", labels[rows].min()), ("most", labels[rows].max()),
                                    ("numbers", numbers[rows]), ("ids", [ids[r] for r in rows.tolist()]),
                                    ("labels", labels[rows]), ("vectors", of.reshape(-1))):
                    out[name].append(value)
        return pa.table(out, schema=vec.arrow_schema(LEAVES))

    return run


def _lane_boxes(leaves: pa.Table) -> pa.Table:
    """Boxes of a lane, one for each vector length."""
    out = []
    for dim in np.unique(leaves["dim"].to_numpy()).tolist():
        of = leaves.filter(pa.array(leaves["dim"].to_numpy() == dim))
        blocks = of["block"].to_numpy()
        out.append((of["lane"][0].as_py(), dim, int(blocks.min()), int(blocks.max()),
                    vec.table_of(of["low"]).min(0), vec.table_of(of["high"]).max(0),
                    int(of["least"].to_numpy().min()), int(of["most"].to_numpy().max())))
    return pa.table([list(c) for c in zip(*out)], schema=vec.arrow_schema(LANES))


def build(rows: DataFrame, n_rows: int, block: int = vec.BLOCK, leaf: int = LEAF) -> tuple[DataFrame, DataFrame]:
    """The stored leaves of the tree, and the boxes of its lanes."""
    axes = tile_axes(rows)
    laid = in_tiles(rows, axes, n_rows, block)
    leaves = stored(laid.groupBy("lane", "block").applyInArrow(_leaves(axes, leaf), LEAVES), "tree")
    boxes = leaves.select("lane", "block", "dim", "low", "high", "least", "most")
    return leaves, boxes.groupBy("lane").applyInArrow(_lane_boxes, LANES)


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product of each anchor with a row of each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    both = lambda a, b: vec.products(np.concatenate([up, down], 1), np.concatenate([a, b], 1))
    return both(low, high), both(high, low)


# --------------------------------------------------------------- walk ------

class Tree:
    """The leaves of one block, and groups of them."""

    def __init__(self, table: pa.Table):
        self.low, self.high = vec.table_of(table["low"]), vec.table_of(table["high"])
        self.least, self.most = table["least"].to_numpy(), table["most"].to_numpy()
        flat = lambda name: table[name].combine_chunks().flatten()
        sizes = np.array([len(n) for n in table["numbers"]])
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.numbers, self.labels = flat("numbers").to_numpy(), flat("labels").to_numpy()
        self.ids = flat("ids")
        self.known = self.ids.is_valid().to_numpy(zero_copy_only=False)
        self.id_values = self.ids.fill_null(0).to_numpy()
        self.vectors = flat("vectors").to_numpy().reshape(len(self.numbers), -1)
        self.groups = [range(i, min(i + FANOUT, len(sizes))) for i in range(0, len(sizes), FANOUT)]
        of = lambda values, f: np.stack([f(values[g.start:g.stop], 0) for g in self.groups])
        self.group_low, self.group_high = of(self.low, np.min), of(self.high, np.max)
        self.group_least, self.group_most = of(self.least, np.min), of(self.most, np.max)


def usable(least, most, label: int, same: bool) -> np.ndarray:
    """Whether a box may hold a row of the anchor's label, or of another."""
    return (least <= label) & (most >= label) if same else ~((least == label) & (most == label))


def walk(tree: Tree, values: np.ndarray, query: np.ndarray, number: int, label: int, windows: list[tuple[int, int]],
         k: int, same: bool, leaf_box: tuple, group_box: tuple) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Places and scores of the best ``k`` rows in each window, and the leaves opened.

    ``leaf_box`` and ``group_box``: the intervals of this anchor.
    """
    floors, tops = [low for low, _ in windows], [high for _, high in windows]
    over = range(len(windows))
    kth: list[list[int]] = [[] for _ in over]  # the k best scores, the least first
    found: list[list[tuple[int, int]]] = [[] for _ in over]

    def wanted(least: int, most: int) -> bool:
        for w in over:
            if most >= floors[w] and least <= tops[w]:
                return True
        return False

    leaf_least, leaf_most = (b.tolist() for b in leaf_box)
    group_least, group_most = (b.tolist() for b in group_box)
    ok_group = usable(tree.group_least, tree.group_most, label, same).tolist()
    ok_leaf = usable(tree.least, tree.most, label, same).tolist()
    queue = [(-group_most[g], 0, g) for g in range(len(tree.groups))
             if ok_group[g] and wanted(group_least[g], group_most[g])]
    heapq.heapify(queue)
    opened, lowest = 0, min(floors)
    while queue:
        most, is_leaf, i = heapq.heappop(queue)
        if -most < lowest:
            break
        if not is_leaf:
            for j in tree.groups[i]:
                if ok_leaf[j] and wanted(leaf_least[j], leaf_most[j]):
                    heapq.heappush(queue, (-leaf_most[j], 1, j))
            continue
        if not wanted(leaf_least[i], -most):
            continue
        opened += 1
        start, end = tree.starts[i], tree.ends[i]
        product = values[start:end] @ query
        hit = np.flatnonzero(product >= lowest)
        if not hit.size:
            continue
        alike = tree.labels[start + hit] == label
        hit = hit[alike & (tree.numbers[start + hit] != number) if same else ~alike]
        for at, score in zip((start + hit).tolist(), clipped(product[hit]).tolist()):
            for w in over:
                if floors[w] <= score <= tops[w]:
                    found[w].append((at, score))
                    if len(kth[w]) < k:
                        heapq.heappush(kth[w], score)
                    else:
                        heapq.heappushpop(kth[w], score)
                    if len(kth[w]) == k and kth[w][0] > floors[w]:
                        floors[w] = kth[w][0]
        lowest = min(floors)
    best = []
    for w in over:
        at, scores = (np.array([f[i] for f in found[w] if f[1] >= floors[w]], dtype=np.int64) for i in (0, 1))
        order = np.lexsort((tree.numbers[at], tree.id_values[at], ~tree.known[at], -scores))[:k]
        best.append((at[order], scores[order]))
    return best, opened


def clipped(scores: np.ndarray) -> np.ndarray:
    return np.clip(scores, -LONG - 1, LONG).astype(np.int64) if scores.dtype == object else scores.astype(np.int64)


def _search(k: int, same: bool):
    def run(page: pa.Table, leaves: pa.Table) -> pa.Table:
        schema = vec.arrow_schema(FOUND)
        out = [schema.empty_table()]
        for dim in np.unique(page["dim"].to_numpy()).tolist() if len(leaves) else ():
            asks = page.filter(pa.array(page["dim"].to_numpy() == dim))
            of = leaves.filter(pa.array(leaves["dim"].to_numpy() == dim))
            if not len(of):
                continue
            tree, queries = Tree(of), vec.table_of(asks["vector"])
            wide = dim * vec.largest(queries) * vec.largest(tree.vectors) >= vec.EXACT
            values = tree.vectors.astype(object if wide else np.float64)
            leaf_box = intervals(queries, tree.low, tree.high)
            group_box = intervals(queries, tree.group_low, tree.group_high)
            windows = zip(asks["low"].to_pylist(), asks["high"].to_pylist())
            numbers, labels = asks["anchor"].to_pylist(), asks["label"].to_pylist()
            for i, (low, high) in enumerate(windows):
                best, _ = walk(tree, values, queries[i].astype(values.dtype), numbers[i], labels[i],
                               list(zip(low, high)), k, same, tuple(b[i] for b in leaf_box), tuple(b[i] for b in group_box))
                for w, (at, scores) in enumerate(best):
                    if len(at):
                        n = len(at)
                        out.append(pa.table([pa.array([numbers[i]] * n), pa.array([w] * n, pa.int32()), pa.array(scores),
                                             tree.ids.take(pa.array(at)), pa.array(tree.numbers[at])], schema=schema))
        return pa.concat_tables(out)

    return run


def _asked(lanes: dict[int, tuple], same: bool, n_pages: int):
    """Anchors for every block of the lanes whose box may hold a row in a window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "label", "dim", "vector", "low", "high"]
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                dim, label = row.column("dim")[0].as_py(), row.column("label")[0].as_py()
                lane, first, last, low, high, least, most = lanes[dim]
                box_low, box_high = (b[0] for b in intervals(vec.table_of(row.column("vector")), low, high))
                windows = list(zip(row.column("low")[0].as_py(), row.column("high")[0].as_py()))
                reach = np.zeros(len(lane), bool)
                for a, b in windows:
                    reach |= (box_high >= a) & (box_low <= b)
                reach &= usable(least, most, label, same)
                to = np.flatnonzero(reach)
                n = last[to] - first[to] + 1
                lanes_to = np.repeat(lane[to], n)
                block = np.repeat(first[to] - np.cumsum(n) + n, n) + np.arange(n.sum())
                took = row.select(names).take(pa.array(np.zeros(len(block), np.int64)))
                page = row.column("anchor")[0].as_py() * 2_654_435_761 % (1 << 32) * n_pages >> 32
                yield pa.RecordBatch.from_arrays(
                    [*took.columns, pa.array(lanes_to.astype(np.int32)), pa.array(block.astype(np.int32)),
                     pa.array(np.full(len(block), page, np.int32))], schema=vec.arrow_schema(ASKED))

    return run


def _best(anchors: DataFrame, leaves: DataFrame, lanes: dict, n_pages: int, k: int, same: bool) -> DataFrame:
    """``anchor, window, rank, score, id``: the best ``k`` of each window."""
    asked = anchors.mapInArrow(_asked(lanes, same, n_pages), ASKED)
    found = vec.meet(asked, leaves, n_pages, _search(k, same), FOUND)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"), "number")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mined(table: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = ANCHOR_EVERY,
          low: int = LOW, high: int = HIGH, scale: int = SCALE, moved_every: int = MOVED_EVERY, n_labels: int = LABELS,
          block: int = vec.BLOCK, leaf: int = LEAF) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``."""
    moved = F.when(F.col("vec_id") % moved_every == 0, (F.col("label") + 1) % n_labels).otherwise(F.col("label"))
    rows = stored(vec.integer_rows(table.filter("label IS NOT NULL"), scale).withColumn("label", moved), "vectors")
    n = table.count()
    leaves, boxes = build(rows, n, block, leaf)
    by_length: dict[int, list] = {}
    for r in boxes.collect():  # a row for each lane (MOST_LANES at most) and vector length
        by_length.setdefault(r["dim"], []).append(tuple(r)[:1] + tuple(r)[2:])
    lanes = {dim: tuple(np.array(c, dtype=np.int64) for c in zip(*of)) for dim, of in by_length.items()}
    anchors = stored(rows.filter(F.col("vec_id") % every == 0).select(
        F.col("row_id").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "dim", "vector"), "anchors")
    n_pages = vec.pages(anchors.count())

    whole = anchors.withColumns({"low": F.array(F.lit(-LONG - 1)), "high": F.array(F.lit(LONG))})
    found = _best(whole, leaves, lanes, n_pages, positives, same=True)
    own = found.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score", "id"))).alias("of"))
    own = stored(anchors.join(own, "anchor").withColumn("scores", F.col("of.score")).withColumn("ids", F.col("of.id")).drop("of"),
                 "positives")

    wide = lambda s: s.cast("decimal(38,0)")
    windows = own.withColumns({
        "low": F.transform("scores", lambda s: F.ceil(wide(s) * low / 100).cast("long")),
        "high": F.transform("scores", lambda s: F.floor(wide(s) * high / 100).cast("long"))})
    found = _best(windows, leaves, lanes, n_pages, negatives, same=False)
    joined = found.select("anchor", "window", "rank", "score", "id").join(own.select("anchor", "anchor_id", "scores", "ids"), "anchor")
    return joined.select(
        "anchor_id", F.get("ids", "window").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        F.get("scores", "window").alias("positive_score"), F.col("score").alias("negative_score"))
