"""Count, mean and squared deviation of a column per file, kept in a side table.

Three-sigma bounds come from the raw rows of each file.  Files do not change
once they are there, so their moments are computed once, when a file is new,
and appended to a small table; cleaning then reads the raw rows only for the
rows themselves.  A file that was replaced (other size or time) counts as new,
and the moments of its old version no longer meet it.  Moments of parts of a
group (several files of a month) merge exactly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from routecov.operators.sizing import broadcast_materialised
from routecov.session import cut_lineage

VERSION = ["file_path", "file_size", "file_modified"]


def moments(raw: DataFrame, value_col: str, by: list[str]) -> DataFrame:
    """(by, n, mean, m2): non-null values, their mean (null without any) and
    summed squared deviation from it; one partial and final aggregation."""
    x = F.col(value_col).cast("double")
    return raw.groupBy(*by).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("_var")).select(
        *by, "n", "mean", (F.col("_var") * F.col("n")).alias("m2"))


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    """Moments of groups (at least one column) from the moments (n, mean, m2) of
    their disjoint parts: deviations of the parts' means from the common mean
    come on top; parts without values change nothing."""
    common = cut_lineage(parts.groupBy(*by).agg(
        F.sum("n").alias("_n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("_mean")))
    same = [F.col(f"_k{i}").eqNullSafe(F.col(c)) for i, c in enumerate(by)]
    keyed = common.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "_n", "_mean")
    joined = parts.join(keyed, same)
    off = F.col("mean") - F.col("_mean")
    return joined.groupBy(*by, F.col("_n").alias("n"), F.col("_mean").alias("_m")).agg(
        F.sum(F.col("m2") + F.col("n") * off * off).alias("m2")).select(*by, "n", F.col("_m").alias("mean"), "m2")


def sigma_bounds(m: DataFrame, k: float = 3.0) -> DataFrame:
    """``m`` with stddev (sample), lower_bound and upper_bound; null for fewer than two values."""
    sd = F.sqrt(F.try_divide(F.col("m2"), F.col("n") - 1))
    return (m.withColumn("stddev", F.when(F.col("n") > 1, sd))
            .withColumn("lower_bound", F.col("mean") - k * F.col("stddev"))
            .withColumn("upper_bound", F.col("mean") + k * F.col("stddev")))


def listing(spark: SparkSession, paths: str | list[str], pattern: str = "*.parquet") -> DataFrame:
    """(file_path, file_size, file_modified) of the files below ``paths``; contents are not read."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
             .load([paths] if isinstance(paths, str) else paths))
    return files.select("_metadata.file_path", "_metadata.file_size", F.col("_metadata.file_modification_time").alias("file_modified"))


def _table(spark: SparkSession, path: str) -> DataFrame:
    schema = "file_path string, file_size bigint, file_modified timestamp, n bigint, mean double, m2 double"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def update(spark: SparkSession, files: DataFrame, table: str, value_col: str,
           read: Callable[[list[str]], DataFrame]) -> tuple[DataFrame, int]:
    """Append the moments of the files (``listing``) that ``table`` does not
    hold; returns the moments (file_path, n, mean, m2) of all listed files and
    the number of new ones.

    ``read`` reads a list of files, rows tagged with ``file_path``; it is called
    once, with the new files.  The driver sees the names of new files only.
    Appending twice after a failed run does no harm: versions are read once."""
    files = cut_lineage(files.select(*VERSION))
    new = cut_lineage(files.join(_table(spark, table), VERSION, "left_anti"))
    paths = [r["file_path"] for r in new.select("file_path").toLocalIterator()]
    if paths:
        # a file without rows has moments too: none
        found = new.join(moments(read(paths), value_col, ["file_path"]), "file_path", "left")
        (found.select(*VERSION, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "mean", "m2")
         .coalesce(1).write.mode("append").parquet(table))
    known = _table(spark, table).join(files, VERSION, "left_semi").dropDuplicates(VERSION)
    return known.select("file_path", "n", "mean", "m2"), len(paths)


def bounds_of_files(known: DataFrame, k: float = 3.0) -> DataFrame:
    """(file_path, lower_bound, upper_bound) from ``update``, with a broadcast
    hint once its size (a row a file) is proven."""
    return broadcast_materialised(sigma_bounds(known, k).select("file_path", "lower_bound", "upper_bound"))
