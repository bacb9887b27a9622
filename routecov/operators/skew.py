"""Joins whose one side has hot keys.

Keys that hold more than one task's share of the rows are counted exactly.
Their rows are split over several tasks by a salt, and the rows that they meet
are copied once for each salt; all other keys join as usual.  No row is
dropped or gathered, and the counted keys are at most as many as tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecov.session import cut_lineage


#: Parts that a task's share of a hot key is split into: parts fall on tasks by
#: hash, and several small ones on each come out more even than one large one.
PARTS = 8


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, on: list[str], tasks: int | None = None) -> DataFrame:
    """(keys, _copies): keys of more than rows / ``tasks`` rows and the number
    of parts to split each into; fewer than ``tasks`` rows.  Null keys meet
    nothing and are left out.  Reads ``df`` once, with a partial aggregate."""
    tasks = tasks or shuffle_tasks(df)
    present = df.dropna(how="any", subset=on)
    counts = cut_lineage(present.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.select(F.sum("_n")).scalar()
    return cut_lineage(counts.where(F.col("_n") * tasks > total)
                       .select(*on, F.ceil(F.col("_n") * F.lit(tasks * PARTS) / total).cast("int").alias("_copies")))


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
              tasks: int | None = None, heavy: DataFrame | None = None) -> DataFrame:
    """``left`` joined to ``right`` on columns of both, hot keys of ``left`` split.

    ``how`` is inner, left, left_semi or left_anti; ``heavy`` (of
    ``heavy_keys``) spares the count where one left side meets several right
    ones.  The salt is a hash of the whole left row, so a task that runs again
    deals its rows alike; only equal left rows stay together."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join cannot do a {how} join")
    heavy = heavy_keys(left, on, tasks) if heavy is None else heavy
    if heavy.isEmpty():
        return left.join(right, on, how)
    few = F.broadcast(heavy)  # fewer rows than tasks
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.col("_copies")).cast("int")
    split = left.join(few, on).withColumn("_salt", salt).drop("_copies")
    copied = (right.join(few, on)
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies"))
    hot = split.join(copied, [*on, "_salt"], how).drop("_salt")
    cold = left.join(few.drop("_copies"), on, "left_anti").join(right, on, how)
    return cold.unionByName(hot)
