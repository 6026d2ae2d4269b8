"""Learned operators against held-out labels."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from stationspark.llm import language_id, tokens, toxicity
from stationspark.llm.tokens import Encoder

from .conftest import prose


def test_language_of_documents_without_their_declaration(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hidden = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    got = language_id.identify(language_id.from_documents(hidden)).withColumnRenamed("id", "doc_id")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (rows.language == rows.lang).mean() > 0.99 and rows.accepted.mean() > 0.99


def test_wrong_declarations_lose_against_the_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter(F.length("text") > 500)
    wrong = docs.withColumn("told", F.when(F.col("doc_id") % 10 == 0, F.lit("de")).otherwise(F.col("lang")))
    items = language_id.from_documents(wrong.withColumn("lang", F.col("told")))
    got = language_id.identify(items).withColumnRenamed("id", "doc_id")
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (rows.language == rows.lang).mean() > 0.99


def test_host_priors_decide_where_the_text_cannot(spark):
    rows = [(i, "the cat and the dog of the house " * 3, "en", "a.org") for i in range(30)]
    rows += [(100 + i, "der hund und die katze von dem haus " * 3, "de", "b.org") for i in range(30)]
    rows += [(200, "xz", None, "a.org"), (201, "xz", None, "b.org")]
    items = spark.createDataFrame(rows, "id long, text string, declared string, host string").withColumn("suffix", F.lit("org"))
    got = {r["id"]: r["language"] for r in language_id.identify(items).collect()}
    assert got[200] == "en" and got[201] == "de"


def test_rare_declared_languages_are_kept(spark):
    """Two codes of three texts each, and Japanese and Greek of one: none is
    'und', and the Japanese text is not taken for a known language."""
    rows = [(i, f"the cat and the dog of house {i} went over the hill and far away " * 20, "en") for i in range(3)]
    rows += [(10 + i, f"der hund und die katze von dem haus {i} gingen weit weg in den wald " * 20, "de") for i in range(3)]
    rows += [(20, "日本語の文章はここにあります 猫と犬 " * 30, "ja"), (21, "η γάτα και ο σκύλος του σπιτιού " * 30, "el"),
             (30, "the dog of house 1 went over the hill and the cat went far away " * 20, "xx")]
    items = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s"))
    got = {r["id"]: r for r in language_id.identify(language_id.from_documents(items)).collect()}
    assert all(r["accepted"] for r in got.values())
    assert {i: r["language"] for i, r in got.items()} == {i: lang for i, _, lang in rows} | {30: "en"}
    assert language_id.accepted_rows(items).count() == len(rows)


def test_more_languages_than_were_once_modelled(spark):
    """90 languages of six texts in words of their own; the rarest are kept."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    codes = [a + b for a in letters[:9] for b in letters[:10]]
    rng = np.random.default_rng(5)
    rows = []
    for k, c in enumerate(codes):
        words = ["".join(rng.choice(list(letters), 6)) for _ in range(40)]
        rows += [(6 * k + i, " ".join(rng.choice(words, 120)), c) for i in range(6)]
    items = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit("s"))
    got = {r["id"]: r for r in language_id.identify(language_id.from_documents(items)).collect()}
    assert all(got[i]["language"] == c and got[i]["accepted"] for i, _, c in rows)


def test_evidence_of_pages(spark):
    pages = spark.createDataFrame([
        (1, "https://www.Example.org:8080/a?b", "<!DOCTYPE html><html class='x' LANG=\"fr-CA\"><head><style>p{}</style></head><body>un <b>mot</b> &amp; <!-- no --></body></html>"),
        (2, None, None), (3, "not a url", "<p>plain")], "page_id long, url string, html string")
    rows = {r["id"]: r for r in language_id.from_pages(pages.withColumn("url", F.when(F.col("page_id") != 3, F.col("url")))).collect()}
    assert rows[1]["declared"] == "fr" and rows[1]["host"] == "www.example.org" and rows[1]["suffix"] == "org"
    assert rows[1]["text"].split() == ["un", "mot"]
    assert rows[2]["text"] == "" and rows[2]["host"] is None and rows[3]["text"].strip() == "plain"


def test_malformed_addresses_and_character_references(spark):
    greek = "η γάτα και ο σκύλος"
    written = "".join(f"&#{ord(c)};" if c != " " else " " for c in greek)
    pages = spark.createDataFrame([
        (1, "not a url", "<p>plain"), (2, "http://[bad", f"<html lang=el><p>{written}</p>"),
        (3, "https://a.fr/x", "caf&eacute; &#xe9;t&#XE9; &lt;b&gt; &nosuch; &nbsp;a"), (4, "https://a.fr/y", "&#1114112; &#0; x")],
        "page_id long, url string, html string")
    rows = {r["id"]: r for r in language_id.from_pages(pages).collect()}
    assert len(rows) == 4 and rows[1]["host"] is None and rows[2]["host"] is None and rows[3]["host"] == "a.fr"
    assert rows[2]["text"].split() == greek.split()
    assert rows[3]["text"].split() == ["café", "été", "b", "a"]
    assert language_id.identify(language_id.from_pages(pages)).filter("language = 'el' and accepted").count() >= 1


def test_toxicity_on_held_out_rows(spark):
    docs = spark.createDataFrame([(i, prose(i, 80) + (" vilewort slurish" if i % 7 == 0 else " kindly")) for i in range(1200)],
                                 "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 7 == 0).cast("int").alias("toxic"))
    rows = toxicity.classify(docs, labels).join(labels, "doc_id").toPandas()
    assert (rows.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in rows.doc_id]).all()
    away = rows[rows.held_out]
    assert (away.predicted == away.toxic).mean() > 0.99 and rows.score.between(0, 1).all()
    # held-out labels change nothing
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    other = toxicity.classify(docs, labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))).toPandas()
    a, b = (x.set_index("doc_id").score.sort_index() for x in (rows, other))
    assert np.allclose(a, b)


def test_label_model_finds_the_better_voters():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.2
    good = [np.where(truth, rng.random(4000) < 0.8, rng.random(4000) < 0.02) for _ in range(5)]
    bad = [rng.random(4000) < 0.2 for _ in range(2)]
    copy = good[0]                                   # says what another says
    votes = np.stack([*good, *bad, copy], axis=1).astype(np.uint8)
    model = toxicity.LabelModel(0.2, np.full(votes.shape[1], 0.6))
    p = model.fit(votes)
    assert ((p > 0.5) == truth).mean() > 0.97
    assert model.voice[0] < 0.6 and model.voice[1] > 0.8
    ratio = model.toxic / model.clean
    assert ratio[:5].min() > 10 * ratio[5:7].max()


def test_encoder_equals_the_library():
    encoder = Encoder("byte_bpe_50k.json")
    texts = ["", " ", "a  b", "  a b ", "a\n b\n\n c  \n d \t e", "x <|endoftext|> y", "it's  'll \n\n\nfoo   bar",
             "日本 語 \n テスト  .", "end.\nNext line.\n Then", "a b  c\x1cd\x85e", "one.\nTwo.\nThree", "naïve café.\nÉté"]
    for text in texts * 2:
        want = np.asarray(encoder._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        assert encoder.ids_bytes(text) == want, text


def token_runs(encoder, texts):
    """The ids of each text, with 0 at the end, from all runs."""
    out = {}
    for first, ids, ends in encoder.encoded(pa.array(texts), 0):
        for i, (start, end) in enumerate(zip([0, *ends], ends)):
            out[first + i] = ids[start:end].tolist()
    return [out[i] for i in range(len(texts))]


def test_known_words_are_bounded_and_there_once(monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_WORDS", 900)
    monkeypatch.setattr(tokens, "KEPT_BYTES", 40_000)
    monkeypatch.setattr(tokens, "SEGMENT", 100, raising=False)
    monkeypatch.setattr(tokens, "TOGETHER", 2_000)
    encoder, rng = Encoder("byte_bpe_50k.json"), np.random.default_rng(5)
    made = ["".join(rng.choice(list("aeinrstöé"), rng.integers(2, 9))) for _ in range(3000)]
    words = [w + m for w in made for m in ("", ".", ",", ".\nUnd", "&&&", "\nso,")]
    texts = [" ".join(rng.choice(words, 120)) for _ in range(60)]
    texts += ["", " ", "a  b", "  a b ", "x <|endoftext|> y", "end.\nNext line.\n Then", "z" * 5000, *texts[:9]]
    want = [[*encoder._tokenizer.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert token_runs(encoder, texts) == want
    assert token_runs(encoder, texts[::-1]) == want[::-1]
    encoder._make_room()
    known = [w for some in encoder._words for w in some.to_pylist()]
    assert 0 < len(known) <= 900 and len(known) == len(set(known))
    assert sum(a.nbytes for some in (encoder._words, encoder._ids) for a in some) <= 40_000


def test_encoding_a_large_batch_takes_little_memory():
    rng = np.random.default_rng(6)
    words = np.array([f"w{i:x}" for i in rng.integers(0, 1 << 30, 20_000)], dtype=object)
    texts = pa.array([" ".join(words[rng.integers(0, len(words), 250)]) for _ in range(9000)])
    encoder, pool = Encoder("byte_bpe_50k.json"), pa.default_memory_pool()
    watched = pa.proxy_memory_pool(pool)
    pa.set_memory_pool(watched)
    try:
        n = sum(len(ids) for _, ids, _ in encoder.encoded(texts, 0))
    finally:
        pa.set_memory_pool(pool)
    assert texts.nbytes > 16 << 20 and n > texts.nbytes // 8
    assert watched.max_memory() < 32 << 20
