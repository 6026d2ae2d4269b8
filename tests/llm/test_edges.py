"""Every operator and stage over nulls, empty and long texts, ties, repeated
rows, clashing names and empty tables."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stationspark.llm import (
    exact_dedup,
    fingerprints,
    jaccard_join,
    language_id,
    mixing,
    packing,
    secret_scan,
    substring_dedup,
    token_output,
    toxicity,
)


def labels(spark):
    return spark.createDataFrame([(1, 1, 1), (2, 0, 0), (None, 0, 1), (7, 0, None), (1, 0, 0)],
                                 "doc_id long, quality int, toxic int")


ROWS = {
    "language_id": lambda s, d: language_id.identify(language_id.from_documents(d)),
    "fingerprints": lambda s, d: fingerprints.compare_with_edits(d),
    "mixing": lambda s, d: mixing.taken_words(d),
    "substring_dedup": lambda s, d: substring_dedup.digest(substring_dedup.remove(d)),
    "exact_dedup": lambda s, d: exact_dedup.find(d),
    "toxicity": lambda s, d: toxicity.classify(d, labels(s)),
    "token_output": lambda s, d: token_output.round_trip(d),
    "jaccard_join": lambda s, d: jaccard_join.join(d),
    "secret_scan": lambda s, d: secret_scan.digest(secret_scan.scan(d)),
}


@pytest.mark.parametrize("name", ROWS)
def test_a_row_for_each_document(spark, edge_docs, name):
    assert ROWS[name](spark, edge_docs).count() == edge_docs.count()


@pytest.mark.parametrize("name", ROWS)
def test_empty_table(spark, edge_docs, name):
    assert ROWS[name](spark, edge_docs.limit(0)).count() == 0


def test_packing_edges(spark, edge_docs):
    pieces = packing.pack(edge_docs)
    assert pieces.select("doc_id").distinct().count() == edge_docs.select("doc_id").distinct().count()
    empty = pieces.filter("doc_id = 4").first()
    assert (empty["length"], empty["doc_tokens"]) == (1, 1)
    assert packing.pack(edge_docs.limit(0)).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=lambda f: f.__name__)
def test_stages_keep_the_columns(spark, edge_docs, stage):
    out = stage(spark, edge_docs, "")
    assert out.columns == edge_docs.columns
    assert out.count() <= 3 * edge_docs.count()
    assert stage(spark, edge_docs.limit(0), "").count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:-1]], ids=lambda f: f.__name__)
def test_stages_keep_the_values_of_columns_called_like_their_own(spark, edge_docs, stage):
    names = ("__key", "__own", "__nth", "__draws", "__draw", "__id", "__ID_", "__h", "__th", "__many", "__blank", "_row")
    tagged = edge_docs.withColumn("tag", F.sha2(F.to_json(F.struct("doc_id", "text", "lang", "source")), 256))
    out = stage(spark, tagged.withColumns({n: F.concat(F.col("tag"), F.lit(n)) for n in names}), "")
    assert out.columns == [*tagged.columns, *names]
    rows = out.collect()
    assert rows and all(r[n] == r["tag"] + n for r in rows for n in names)
    assert {r["tag"] for r in rows} <= {r["tag"] for r in tagged.collect()}


def test_repeated_rows_cost_no_more_than_one(spark):
    """Twelve hundred rows of one id and text, whose words another document has."""
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(5, text)] * 1200 + [(2, "before " + text), (9, "x " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    copies = substring_dedup.whole_copies(docs)
    spans = substring_dedup.repeated_spans(docs, copies)
    once = spark.createDataFrame([rows[0], *rows[-2:]], "doc_id long, text string")
    assert spans.count() == substring_dedup.repeated_spans(once, substring_dedup.whole_copies(once)).count()
    got = substring_dedup.remove(docs).groupBy("doc_id", "n_words", "n_removed", "kept").count().collect()
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["count"]) for r in got) == [
        (2, 401, 0, 1), (5, 400, 400, 1200), (9, 60, 0, 1)]


def test_stage_results(spark, edge_docs):
    exact = {(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_exact_copies(spark, edge_docs, "").collect()}
    ids = [i for i, _ in exact]
    # of the blank texts the longest stays; of equal ones the smallest id; a null id loses
    assert 6 in ids and 5 not in ids and 4 not in ids and 2 not in ids and 8 not in ids and 10 in ids and None not in ids
    near = corpus_pipeline.drop_near_copies(spark, edge_docs, "")
    kept = [r["doc_id"] for r in near.collect()]
    assert 1 in kept and 2 not in kept and 3 not in kept and 7 in kept and 8 not in kept
    named = corpus_pipeline.identify_languages(spark, edge_docs, "")
    gone = {r["doc_id"] for r in edge_docs.join(named, "doc_id", "left_anti").collect()}
    assert {4, 5, 6, 13} <= gone and not {1, 2, 3, 7} & gone


def test_mixing_fills_the_gap_before_a_long_document(spark):
    """A document of 100,000 words that crosses its source's cut leaves a gap
    that short ones fill."""
    rows = [(0, "w " * 100_000, "a")] + [(i, "w " * 500, "a") for i in range(1, 101)]
    rows += [(1000 + i, "w " * 600, "b") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.taken_words(docs).toPandas()
    a = got[got["source_size"] == 150_000]
    assert a.target.iloc[0] == 90_000 and abs(a.taken.sum() - 90_000) <= 250
    assert (a.copies <= 3).all()


def test_mix_spreads_rows_without_an_id(spark):
    """No window or list over all rows of one id."""
    rows = [(None, f"{i} " + "w " * (50 + i % 7), "ab"[i % 2]) for i in range(120)] + [(7, "same text", "a")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(docs)
    plan = out._jdf.queryExecution().analyzed().toString()
    assert "windowspecdefinition(doc_id" not in plan and "eqnullsafe" not in plan.lower() and "<=>" not in plan
    sizes = mixing.word_counts(docs)
    assert mixing.permuted(sizes, mixing.source_targets(sizes)).select("turn").distinct().count() == 123
    want = {r["size"]: r["n"] for r in mixing.taken_words(docs).groupBy("size").agg(F.sum("copies").alias("n")).collect()}
    got = {r["size"]: r["count"] for r in out.groupBy(F.size(F.split(F.trim("text"), " +")).alias("size")).count().collect()}
    assert got == {k: n for k, n in want.items() if n}


def near(k, i):
    """The i-th near copy of a text."""
    words = [f"v{k}x{j}" for j in range(200)]
    return " ".join([*words, f"end{i}"])


def test_near_copies_without_an_id(spark):
    """Classes of a null id and a real one, of null ids alone, and rows of one
    id with different texts."""
    rows = [(1000 + k, near(k, 0)) for k in range(10)] + [(None, near(k, 1)) for k in range(10)]
    rows += [(None, near(20 + k, i)) for k in range(4) for i in range(3)] + [(None, near(20, 0))]
    rows += [(50, near(30, 0)), (50, near(31, 0)), (60, near(31, 1)), (61, near(30, 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.join(docs).collect()
    assert len(got) == len(rows)
    assert sorted(r["class_id"] for r in got if r["class_id"] is not None) == sorted(
        [1000 + k for k in range(10)] * 2 + [50] * 4)
    assert sorted(r["n_links"] for r in got if r["doc_id"] in (50, 60, 61)) == [1] * 4
    kept = jaccard_join.survivors(docs).collect()
    classes = sorted(r["text"].split()[0] for r in kept)
    assert classes == sorted(f"v{k}x0" for k in [*range(10), *range(20, 24), 30, 31])
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == [50, 50, *range(1000, 1010)]


def test_every_text_with_words_has_a_fingerprint(spark):
    """Texts of five and six words, and texts without blanks."""
    rows = [(i, " ".join(f"u{i}x{j}" for j in range(5 + i % 2))) for i in range(60)]
    han = "".join(chr(0x4E00 + i * i % 5000) for i in range(400))
    rows += [(100, han), (101, "".join(chr(97 + i * i * i % 23) + str(i) for i in range(300))), (102, "😀" * 3 + han), (103, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.compare_with_edits(docs).collect()}
    assert all(got[i]["fingerprint"] for i in range(60)) and got[103]["fingerprint"] == ""
    assert len({got[i]["fingerprint"] for i in range(60)}) == 60
    assert all(got[i]["near_next"] == 0 for i in range(1, 60))
    assert all(got[i]["near_edited"] > 0.3 for i in (100, 101, 102))


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    sums = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert out.count() and not sums.filter("n > 1024 or n <> end").count()


def test_pages_are_decoded_some_at_a_time():
    """A large batch is handed on in chunks; no chunk but of one text is larger."""
    texts = ["a&amp;b " * n for n in (3, 0, 1, 90_000)] + ["caf&eacute; " * 2_000] * 200 + [""]
    whole = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    got = list(language_id._decoded(iter([whole.slice(1), whole.slice(0, 0), whole.slice(0, 1)])))
    rows = [(r["id"], r["text"]) for b in got for r in b.to_pylist()]
    want = [(i, t.replace("&amp;", " ").replace("&eacute;", "\u00e9")) for i, t in enumerate(texts)]
    assert rows == want[1:] + want[:1]
    assert len(got) > 10 and all(
        b.num_rows == 1 or sum(len(t) for t in b.column("text").to_pylist()) <= language_id.CHUNK_BYTES for b in got)
    assert language_id.CHUNK_BYTES <= 1 << 18


def test_packing_a_large_batch_takes_little_memory(monkeypatch):
    texts = pa.array([" ".join(f"w{(i * j * j) % 20_011:x}{j % 7}" for j in range(300)) for i in range(1, 9001)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), texts], names=["doc_id", "text"])
    monkeypatch.setattr(packing, "TaskContext", type("Task", (), {"get": classmethod(lambda c: c), "partitionId": lambda: 0}))
    pool = pa.default_memory_pool()
    watched = pa.proxy_memory_pool(pool)
    pa.set_memory_pool(watched)
    try:
        length = sum(sum(out.column("length").to_pylist()) for out in packing._packed(packing.TOKENIZER, False)(iter([batch])))
    finally:
        pa.set_memory_pool(pool)
    assert texts.nbytes > 16 << 20 and length > texts.nbytes // 8
    assert watched.max_memory() < 32 << 20
