"""Profiles of clean trips: summaries, value counts, distinct values and
service-area set checks.  All are grouped aggregations (partial + final)
that read their input once; where a share of the total is needed, the
grouped result is materialised and the total is a scalar subquery over it."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from routecov.functions.paths import undirected_pair
from routecov.operators.sizing import broadcast_if_small
from routecov.session import cut_lineage


def row_count(df: DataFrame) -> DataFrame:
    """One-row count."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def mean_stddev(df: DataFrame, col: str) -> DataFrame:
    """Mean and sample standard deviation."""
    return df.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("stddev"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of a column."""
    return df.select(col).distinct().orderBy(col)


def column_summary(df: DataFrame, col: str) -> DataFrame:
    """A12 (exact part): count, mean, sample stddev, min, max of one column."""
    x = F.col(col)
    return df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("stddev"),
                  F.min(x).alias("min"), F.max(x).alias("max"))


def column_percentiles(df: DataFrame, col: str, accuracy: int = 10000) -> DataFrame:
    """A12 (quartiles): 25/50/75 % by ``percentile_approx``, as in
    ``DataFrame.summary``.  The sketch keeps per-task memory bounded; its rank
    error is at most N / accuracy.  Exact percentiles would buffer every
    distinct value of the column in one aggregation task."""
    x = F.col(col)
    return df.agg(F.percentile_approx(x, 0.25, accuracy).alias("p25"),
                  F.percentile_approx(x, 0.5, accuracy).alias("p50"),
                  F.percentile_approx(x, 0.75, accuracy).alias("p75"))


def exact_percentiles(df: DataFrame, col: str, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """A12 (quartiles, exact): one row p25, p50, p75: the least value that at
    least that share of the non-null values do not exceed; nulls without values.

    Value counts are range-partitioned once; the totals of the partitions (one
    number each, on the driver) say which of them holds each rank, and only
    there counts are added up.  No task holds more than a range of values."""
    names = [f"p{round(100 * q)}" for q in shares]
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    parts = cut_lineage(counts.repartitionByRange("value").withColumn("part", F.spark_partition_id()))
    totals = parts.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    total = sum(r["n"] for r in totals)
    ranks = [max(1, math.ceil(q * total)) for q in shares]
    places, before = [], 0  # (name, partition, rank in it)
    for r in totals:
        places += [(name, r["part"], rank - before) for name, rank in zip(names, ranks) if before < rank <= before + r["n"]]
        before += r["n"]
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("value"))
    inside = parts.where(F.col("part").isin([p for _, p, _ in places])).withColumn("upto", upto)

    def at(part: int, rank: int) -> Column:
        hit = (F.col("part") == part) & (F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank)
        return F.max(F.when(hit, F.col("value")))

    found = {name: at(part, rank) for name, part, rank in places}
    return inside.agg(*[found.get(name, F.max(F.when(F.lit(False), F.col("value")))).alias(name) for name in names])


def top_value_counts(df: DataFrame, col: str, n: int = 5) -> DataFrame:
    """The n most frequent values with their share of all rows, in
    percent rounded to 2 places.  ``count(col)`` skips NULLs while the
    denominator counts every row (Q21).  One pass over the input: the grouped
    counts are materialised and the row total is summed from them."""
    grouped = cut_lineage(df.groupBy(col).agg(F.count(col).alias("trips"),
                                              F.count(F.lit(1)).alias("_rows")))
    total = grouped.select(F.sum("_rows")).scalar()
    return (grouped.select(col, "trips",
                           F.round(F.try_divide(F.col("trips"), total) * 100.0, 2).alias("percentage"))
            .orderBy(F.desc("trips"), F.asc(col))
            .limit(n))


def top_undirected_routes(df: DataFrame, pu: str = "pulocationID", do: str = "dolocationID",
                          n: int = 1) -> DataFrame:
    """Most frequent unordered zone pairs with their (unrounded) share;
    one pass over the input, total summed from the materialised groups."""
    grouped = cut_lineage(df.withColumn("trip_route", undirected_pair(pu, do))
                          .groupBy("trip_route").agg(F.count(F.lit(1)).alias("counts")))
    total = grouped.select(F.sum("counts")).scalar()
    return (grouped.withColumn("percentage", F.col("counts") / total * 100)
            .orderBy(F.desc("counts"), F.asc("trip_route"))
            .limit(n))


def served_zones(trips: DataFrame, pu: str, do: str) -> tuple[DataFrame, DataFrame]:
    """Distinct pick-up zones and distinct drop-off zones."""
    return (trips.select(F.col(pu).alias("location_id")).distinct(),
            trips.select(F.col(do).alias("location_id")).distinct())


def excluded_areas(areas: DataFrame, allowed: DataFrame) -> DataFrame:
    """U4: areas not allowed; duplicates in ``areas`` are kept (like
    ``filterNot``): an anti join, not a set difference."""
    return areas.join(allowed, "location_id", "left_anti")


def service_area_violations(trips: DataFrame, areas: DataFrame, allowed: DataFrame,
                            pu: str = "pulocationID", do: str = "dolocationID") -> DataFrame:
    """Zones served (as pick-up or drop-off) that lie in ``areas`` but not
    in ``allowed``: (pick-ups ∩ excluded) ∪ (drop-offs ∩ excluded) (U3-U5).

    One pass over the trips: both ends are exploded into one column and
    de-duplicated with a partial aggregate before the (small) semi join."""
    excluded = excluded_areas(areas, allowed).select("location_id").distinct()
    served = trips.select(F.explode(F.array(F.col(pu), F.col(do))).alias("location_id")).distinct()
    return served.join(broadcast_if_small(excluded), "location_id", "left_semi")
