"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``docs``.  ``run`` writes every stage's result as
Parquet to the shared folder and reads it again for the next stage.

Defined results: a null or empty text, or one without a letter, has no
language and goes in the first stage; repeated rows of a document keep their
lines alike, and one of them stays in the near-duplicate stage; documents left
without a line go; rows with a null doc_id are never merged with others; tables without rows give no rows; further columns
are carried along whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecov.llm import language, line_dedup, near_dedup, packing, tiling
from routecov.llm.common import read_table
from routecov.session import scratch_path


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not use."""
    used = {c.lower() for c in docs.columns}
    while name in used:
        name = "_" + name
    return name


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in a learnt language; those without a letter go."""
    lang, score = _free(docs, "predicted_language"), _free(docs, "language_score")
    model = language.train(docs)
    out = language.predicted(docs, model, docs.columns, (lang, score))
    return out.where(F.col(lang) != language.UNKNOWN).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that occur earlier, and documents of which nothing is left; n_chars follows the text."""
    names = {n: _free(docs, n) for n in ("n_lines", "n_dropped")}
    out = line_dedup.without_repeats(docs, names=names).where((F.col(names["n_dropped"]) == 0) | (F.length("text") > 0))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of smallest id of each near-duplicate group, and one of its repeated rows."""
    groups = near_dedup.near_duplicates(docs.select("doc_id", "text"))
    out = docs.join(groups.where("not kept").select("doc_id").distinct(), "doc_id", "leftanti").select(*docs.columns)
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return out
    return out.join(again, "doc_id", "leftanti").select(*docs.columns).union(
        out.join(again, "doc_id", "leftsemi").select(*docs.columns).dropDuplicates(["doc_id", "text"]))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    row = _free(docs, "row")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    found = tiling.contaminated(numbered.select(F.col(row).alias("doc_id"), "text"), read_table(spark, sf_dir, "benchmark"))
    hit = found.select(F.col("doc_id").alias(row)).distinct()
    return numbered.join(hit, row, "leftanti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, with their token ids, in sequences of 2,048 tokens."""
    import public_tokenizers
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("packing", pack),
]

#: Languages, edit distances and tilings have no SQL twin; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
