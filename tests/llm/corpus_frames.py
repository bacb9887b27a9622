import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang) rows, with an extra column named like inner ones."""
    from pyspark.sql import functions as F

    def make(rows, parts=3):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(rows, DOCS).repartition(parts).withColumn("size", F.lit("x")).withColumn("id", F.lit(1))
    return make
