"""Tables bucketed by their keys: later joins and groupings on these keys read
them in place, without a shuffle.

The rows are dealt to one task a bucket before the write, so each bucket is
one file.  The tables are external, under a folder of the caller, and entered
in the session's catalog, which is where Spark keeps the bucketing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecov.operators.skew import shuffle_tasks
from routecov.session import delete_path, scratch_path

# Folders of a trip table written by ``write_bucketed_trips``.
PAIRS, HOT = "pairs", "hot_pairs"
PU, DO = "pu_location_id", "do_location_id"


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int | None = None, table: str | None = None,
                   dealt: bool = False) -> str:
    """Write ``df`` under ``path`` in ``buckets`` (default: the session's
    shuffle partitions) by ``keys``; returns the name in the catalog.
    ``dealt``: the rows already lie in tasks by these keys."""
    buckets = buckets or shuffle_tasks(df)
    table = table or f"routecov_{uuid.uuid4().hex[:16]}"
    rows = df if dealt else df.repartition(buckets, *keys)
    (rows.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).option("path", path).saveAsTable(table))
    return table


class Rounds:
    """The state of an iterative job as a bucketed table, one version a round.

    Each round joins the state in place with what is new and writes the next
    version from the same tasks; the version before is deleted once the next
    one is complete, so a lost executor repeats part of one round only."""

    def __init__(self, spark: SparkSession, name: str, keys: list[str], buckets: int | None = None):
        self.spark, self.name, self.keys, self.buckets = spark, name, keys, buckets
        self.table = self.path = None

    def put(self, df: DataFrame, dealt: bool = True) -> DataFrame:
        path = scratch_path(self.spark, self.name)
        table = write_bucketed(df, path, self.keys, self.buckets, dealt=dealt)
        if self.table:
            self.spark.sql(f"DROP TABLE {self.table}")
            delete_path(self.spark, self.path)
        self.table, self.path = table, path
        return self.spark.table(table)

    def last(self) -> DataFrame:
        """The last version as plain files: the name goes, the rows stay."""
        schema = self.spark.table(self.table).schema
        self.spark.sql(f"DROP TABLE {self.table}")
        return self.spark.read.schema(schema).parquet(self.path)


def write_bucketed_trips(trips: DataFrame, path: str, name: str, buckets: int | None = None) -> dict:
    """K4/K5: clean trips in place for A1: bucketed by (pick-up, drop-off).

    A bucket is one task of any later grouping, so pairs that hold more than
    one bucket's share of the trips (counted exactly, fewer than buckets) go to
    a plain table of their own, whose many files are counted by a partial
    aggregate.  Trips with a null end lie there as well.  Tables ``name_pairs``
    and ``name_hot_pairs`` under ``path``; returns their row counts."""
    spark = trips.sparkSession
    buckets = buckets or shuffle_tasks(trips)
    from routecov.operators.skew import heavy_keys
    heavy = F.broadcast(heavy_keys(trips, [PU, DO], buckets).withColumnsRenamed({PU: "_pu", DO: "_do"}).drop("_copies"))
    same = (F.col(PU) == F.col("_pu")) & (F.col(DO) == F.col("_do"))
    known = F.col(PU).isNotNull() & F.col(DO).isNotNull()
    for t in (f"{name}_{PAIRS}", f"{name}_{HOT}"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")
    write_bucketed(trips.where(known).join(heavy, same, "left_anti"), f"{path}/{PAIRS}", [PU, DO], buckets, f"{name}_{PAIRS}")
    hot = trips.where(known).join(heavy, same, "left_semi").unionByName(trips.where(~known))
    hot.write.mode("overwrite").format("parquet").option("path", f"{path}/{HOT}").saveAsTable(f"{name}_{HOT}")
    return {k: spark.table(f"{name}_{k}").count() for k in (PAIRS, HOT)}


def read_bucketed_trips(spark: SparkSession, name: str) -> DataFrame:
    """All trips of ``write_bucketed_trips``."""
    return spark.table(f"{name}_{PAIRS}").unionByName(spark.table(f"{name}_{HOT}"))


def bucketed_trip_frequency(spark: SparkSession, name: str, **kw) -> DataFrame:
    """A1 over ``write_bucketed_trips``: the bucketed pairs are counted where
    they lie, without an exchange; only the hot pairs' partial counts move.
    Keywords as in ``frequency.trip_frequency``."""
    from routecov.operators.frequency import trip_frequency
    return trip_frequency(spark.table(f"{name}_{PAIRS}"), **kw).unionByName(trip_frequency(spark.table(f"{name}_{HOT}"), **kw))
