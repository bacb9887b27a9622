"""Corpus pipeline: stages against brute force on a small corpus."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from conftest import SF001


@pytest.fixture
def corpus(spark, tmp_path):
    def words(tag, n):
        return " ".join(f"{tag}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n))

    shared = words("shared", 12)
    leak = words("leak", 30)
    rows = [(i, f"{words('doc' + chr(97 + i), 40)}\n{words('end' + chr(97 + i), 9)}", "en") for i in range(12)]
    near = words("near", 80)
    rows += [(20, near, "en"), (21, near.replace("nearka", "other"), "en"), (22, "x " + near, "en"), (30, f"{words('own', 20)} {leak} tail", "en"),
             (31, f"{words('line', 20)}\n{shared}", "en"), (32, f"{words('next', 20)}\n{shared}", "en"), (33, shared, "en"), (40, None, "en"),
             (41, "", "de"), (42, "123 456 !!", None), (43, words("doca", 40), None), (None, words("anon", 25), "en"), (44, words("again", 30), None),
             (44, words("again", 30), None)]
    docs = spark.createDataFrame([(d, t, g, "s", len(t) if t is not None else None) for d, t, g in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("score", F.lit("kept")).withColumn("row", F.lit(7))
    spark.createDataFrame([(1, leak), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return str(tmp_path), spark.read.parquet(str(tmp_path / "documents.parquet"))


def test_stages(spark, corpus):
    sf, docs = corpus
    columns = docs.columns
    spoken = cp.identify_language(spark, docs, sf)
    assert spoken.columns == columns
    ids = [r.doc_id for r in spoken.collect()]
    assert set(ids) == {*range(12), 20, 21, 22, 30, 31, 32, 33, 43, 44, None} and len(ids) == 23
    assert {r.score for r in spoken.collect()} == {"kept"}

    lines = cp.drop_repeated_lines(spark, docs, sf)
    text = {r.doc_id: r.text for r in lines.collect()}
    assert lines.columns == columns and 33 not in text and "shared" in text[31] and "shared" not in text[32]
    assert text[40] is None and text[41] == "" and 43 not in text and [r.doc_id for r in lines.collect()].count(44) == 2
    assert all(r.n_chars == len(r.text) for r in lines.collect() if r.text is not None)

    single = cp.drop_near_duplicates(spark, docs, sf)
    kept = [r.doc_id for r in single.collect()]
    assert single.columns == columns and 20 in kept and not {21, 22, 43} & set(kept) and kept.count(44) == 1
    assert {40, 41, 42, None, *range(12)} <= set(kept)

    clean = cp.drop_benchmark_passages(spark, docs, sf)
    assert clean.columns == columns and sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r.doc_id) for r in docs.collect() if r.doc_id != 30)


def test_short_texts_in_related_languages_stay(spark):
    rows = [(4 * i + k, f"hus dag vann {own}", lang) for i in range(5) for k, (lang, own) in enumerate(
        [("da", "hvad"), ("nb", "hva"), ("nn", "kva"), ("sv", "vad")])]
    rows += [(100, "hus", None), (101, "hus dag", None), (102, "vann", "nn"), (103, "123", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {r.doc_id for r in cp.identify_language(spark, docs, "").collect()} == {r[0] for r in rows} - {103}


def test_run_and_empty(spark, corpus, tmp_path):
    sf, docs = corpus
    out = cp.run(spark, sf)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(out.columns)
    assert {r.doc_id for r in out.collect()} == {*range(12), 20, 31, 32, 44, None}
    nothing = docs.limit(0)
    for _, stage in cp.STAGES:
        assert stage(spark, nothing, sf).collect() == []


def test_run_on_given_tables(spark):
    assert cp.run(spark, SF001).count() > 0 and os.path.isdir(SF001)
