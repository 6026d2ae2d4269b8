"""The operators over embeddings against plain Python, with hostile rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationspark.llm import exact_search, hard_negatives, vector_codes
from stationspark.llm import vectors as vec

SCHEMA = "vec_id long, embedding array<float>, label int, lane string, block string, score string, rank string, error string"
BIG = 3.0e38


def table(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA)


def some_rows(n=260, dim=8, seed=3):
    """Clusters, a third of all rows alike, repeated ids, nulls of every kind."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim)) / 3
    rows = []
    for i in range(n):
        label = int(rng.integers(0, 10))
        v = centres[label % 5] + rng.normal(size=dim) / 9
        rows.append((i, [float(np.float32(x)) for x in v], label))
    for i in range(n, n + n // 3):
        rows.append((i, rows[0][1], int(i % 4)))
    rows += [(20, rows[1][1], 3), (20, rows[1][1], 3), (100, rows[2][1], None), (None, rows[3][1], 4),
             (None, rows[3][1], 4), (7, None, 1), (8, [0.5] * (dim - 1) + [None], 1),
             (9, [0.5] * (dim - 1) + [float("nan")], 1), (10, [float("inf")] + [0.1] * (dim - 1), 2),
             (-20, [0.0] * dim, 0), (-100, rows[4][1], 5), (40, [0.25] * 3, 1), (60, [0.5] * 3, 1), (61, [0.5] * 3, 2),
             (80, [], 1), (81, [], 2)]
    return rows


def kept(rows, scale, labelled=False):
    out = []
    for vec_id, v, label in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v) and not (labelled and label is None):
            out.append((vec_id, [int(np.floor(scale * np.float64(np.float32(x)))) for x in v], label))
    return out


def order(vec_id, score):
    return -score, vec_id is None, vec_id or 0


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def nearest(rows, k=20, every=20):
    own = kept(rows, 64)
    out = []
    for i, (q, v, _) in enumerate(own):
        if q is None or q % every:
            continue
        found = sorted(order(c, dot(v, w)) for j, (c, w, _) in enumerate(own) if j != i and len(w) == len(v))[:k]
        out += [(q, r, None if null else c, -s) for r, (s, null, c) in enumerate(found, 1)]
    return out


def hard(rows):
    own = [(i, v, (label + 1) % 10 if i is not None and i % 7 == 0 else label) for i, v, label in kept(rows, 256, True)]
    out = []
    for i, (a, v, label) in enumerate(own):
        if a is None or a % 100:
            continue
        scored = sorted((*order(c, dot(v, w)), other == label) for j, (c, w, other) in enumerate(own)
                        if j != i and len(w) == len(v))
        for p in [x for x in scored if x[3]][:5]:
            of = [x for x in scored if not x[3] and 30 * -p[0] <= 100 * -x[0] <= 90 * -p[0]][:10]
            out += [(a, None if p[1] else p[2], r, None if x[1] else x[2], -p[0], -x[0]) for r, x in enumerate(of, 1)]
    return out


def sorted_rows(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("block", [16, 4096])
def test_search_is_exact(spark, block):
    rows = some_rows()
    got = exact_search.top_k(table(spark, rows), block=block).select("query_id", "rank", "vec_id", "score")
    assert sorted_rows(map(tuple, got.collect())) == sorted_rows(nearest(rows))


@pytest.mark.parametrize("block,leaf", [(16, 4), (4096, 16)])
def test_hard_negatives_are_exact(spark, block, leaf):
    rows = some_rows()
    got = hard_negatives.mined(table(spark, rows), block=block, leaf=leaf).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    want = hard(rows)
    assert want and sorted_rows(map(tuple, got.collect())) == sorted_rows(want)


def test_few_lanes_of_many_blocks(spark, monkeypatch):
    """Past the greatest number of lanes a lane has several blocks; queries are cut into pages."""
    monkeypatch.setattr(vec, "PAGE", 3)
    monkeypatch.setattr(vec.in_lanes, "__defaults__", (vec.BLOCK, 2))
    monkeypatch.setattr(vec.pages, "__defaults__", (3,))
    rows = some_rows(120)
    got = exact_search.top_k(table(spark, rows), block=16).select("query_id", "rank", "vec_id", "score")
    assert sorted_rows(map(tuple, got.collect())) == sorted_rows(nearest(rows))
    got = hard_negatives.mined(table(spark, rows), block=16, leaf=4).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert sorted_rows(map(tuple, got.collect())) == sorted_rows(hard(rows))


def test_components_beyond_a_long(spark):
    rows = [(20 * i, [BIG if i % 3 else -BIG, float(i)], i % 2) for i in range(8)]
    got = exact_search.top_k(table(spark, rows)).collect()
    assert len(got) == 8 * 7 and max(r["score"] for r in got) == (1 << 63) - 1
    assert hard_negatives.mined(table(spark, rows)).count() >= 0
    assert vector_codes.encode(table(spark, rows)).count() == 8


def test_empty_tables(spark):
    empty = table(spark, some_rows(30)).limit(0)
    assert exact_search.top_k(empty).count() == 0
    assert hard_negatives.mined(empty).count() == 0
    assert vector_codes.encode(empty).count() == 0


def test_elimination_leaves_rows_out():
    """Of far clusters only the nearest is evaluated; a bound never lies below its product."""
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.integers(-9, 9, (500, 6)) + c for c in (0, 400, 800, 1600)]).astype(np.int64)
    pivots = exact_search.farthest_first(values, 8)
    far = np.sqrt(((values[:, None, :] - pivots) ** 2).sum(-1))
    norm = (values ** 2).sum(1).astype(float)
    flat = np.ascontiguousarray(far.T, dtype=np.float32)
    bound = exact_search.bounds(far[:50], norm[:50], flat, flat, norm)
    exact = values[:50] @ values.T
    assert (bound >= exact).all()
    query = values[-1].astype(float)
    own = exact_search.bounds(far[-1:], norm[-1:], flat, flat, norm)[0]
    at, scores, evaluated = exact_search.eliminate(own, query, values.astype(float), 20, -np.inf)
    assert evaluated <= 512 and set(np.sort(values @ values[-1])[-20:]) <= set(scores)


def test_box_intervals_hold():
    rng = np.random.default_rng(6)
    values, anchors = rng.integers(-300, 300, (40, 7)), rng.integers(-300, 300, (9, 7))
    low, high = hard_negatives.intervals(anchors, values.min(0)[None], values.max(0)[None])
    products = anchors @ values.T
    assert (low[:, 0] <= products.min(1)).all() and (high[:, 0] >= products.max(1)).all()


def test_packing_keeps_every_row_and_leaf_size():
    values = np.random.default_rng(7).integers(-99, 99, (1000, 5))
    leaves = hard_negatives.pack(values, 64, [3, 1, 0])
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000))
    assert max(map(len, leaves)) <= 64 and len(leaves) <= 32


def test_walk_prunes_boxes():
    """Leaves whose intervals miss the window, or lie below the k-th, stay closed."""
    import pyarrow as pa

    rng = np.random.default_rng(8)
    values = np.concatenate([rng.integers(0, 5, (64, 4)) + c for c in range(0, 6400, 100)])
    n = len(values)
    table = pa.table({"row_id": range(n), "vec_id": range(n), "label": [1] * n, "dim": pa.array([4] * n, pa.int32()),
                      "lane": pa.array([0] * n, pa.int32()), "block": pa.array([0] * n, pa.int32()),
                      "vector": vec.lists(values.astype(np.int64))})
    tree = hard_negatives.Tree(hard_negatives._leaves([0, 1, 2, 3], 64)(table))
    query = np.array([[1, 1, 1, 1]])
    boxes = [hard_negatives.intervals(query, a, b) for a, b in ((tree.low, tree.high), (tree.group_low, tree.group_high))]
    own = [tuple(x[0] for x in b) for b in boxes]
    best, opened = hard_negatives.walk(tree, tree.vectors.astype(float), query[0].astype(float), -1, 0, [(0, 8000)], 10,
                                       False, *own)
    products = values @ query[0]
    assert best[0][1].tolist() == sorted((p for p in products.tolist() if p <= 8000), reverse=True)[:10]
    assert opened <= 4


@pytest.mark.parametrize("n", [5, 300])
def test_codes_are_exact(spark, n):
    rows = some_rows(n)
    got = {(r["vec_id"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"])
           for r in vector_codes.encode(table(spark, rows), block=16).collect()}
    own = sorted(kept(rows, 4096), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    own = [r for r in own if len(r[1]) == len(own[0][1])]
    values = np.array([r[1] for r in own])
    codes, error, book = [], np.zeros(len(own), np.int64), []
    for a, b in vector_codes.cuts(values.shape[1]):
        x = values[:, a:b]
        entries = x[:16].copy()
        far = lambda: ((x[:, None] - entries) ** 2).sum(-1)  # noqa: B023, E731
        for _ in range(6):
            nearest = far().argmin(1)
            for e in range(len(entries)):
                if (nearest == e).any():
                    entries[e] = x[nearest == e].sum(0) // (nearest == e).sum()
        codes.append(far().argmin(1))
        error += far().min(1)
        book.append(entries)
    by_label = {}
    for r, e in zip(own, error.tolist()):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    digest = vector_codes.book_sha256(book)
    want = {(r[0], "".join(f"{c:02x}" for c in code), e, by_label[r[2]], digest)
            for r, code, e in zip(own, np.stack(codes, 1).tolist(), error.tolist())}
    assert got == want


def test_curve_steps_to_a_neighbour():
    for n, bits in ((2, 4), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * n, indexing="ij"), -1).reshape(-1, n)
        place = vector_codes.hilbert_place(cells, bits)
        path = cells[np.argsort(place)]
        assert sorted(place.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shortlists_lose_no_nearest_entry():
    rng = np.random.default_rng(9)
    rows, entries = rng.integers(-50, 50, (200, 4)), rng.integers(-50, 50, (16, 4))
    single = 0
    for at in range(0, 200, 10):
        block = rows[at:at + 10] // 4
        short = np.flatnonzero(vector_codes.shortlists(block.min(0)[None], block.max(0)[None], entries)[0])
        assert set(vector_codes.distances(block, entries).argmin(1).tolist()) <= set(short.tolist())
        single += len(short) < 16
    assert single


def test_extra_columns_do_not_matter(spark):
    rows = some_rows(60)
    plain = table(spark, rows).select("vec_id", "embedding", "label")
    assert sorted_rows(exact_search.top_k(plain).collect()) == sorted_rows(exact_search.top_k(table(spark, rows)).collect())
    codes = vector_codes.encode(plain.withColumn("label", F.col("label").cast("long")))
    assert sorted_rows(codes.collect()) == sorted_rows(vector_codes.encode(table(spark, rows)).collect())
