"""Writers (K1-K8).

Sorted single-file outputs are only for small, already aggregated results
(profiles, top-k): one shuffle into one partition, sorted there.  Large
outputs keep their parallelism: hash-partitioned by the join keys a reader
will use, or laid out in ``key=value`` folders for partition pruning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Output partition counts of the clean-trip table.
DEFAULT_TOTAL_PARTITIONS = 100
DEFAULT_PER_PROVIDER_PARTITIONS = 10


def write_sorted_csv(df: DataFrame, path: str, order: list, sep: str = ",",
                     header: bool = True, empty_value: str | None = None) -> None:
    """K1/K2/K3: one sorted delimited file, overwrite.  ``empty_value=''``
    writes empty strings unquoted (the default quotes them)."""
    w = (df.repartition(1).sortWithinPartitions(*order)
         .write.mode("overwrite").option("header", header).option("sep", sep))
    if empty_value is not None:
        w = w.option("emptyValue", empty_value)
    w.csv(path)


def write_sorted_parts(df: DataFrame, path: str, order: list, sep: str = "\t", header: bool = True) -> None:
    """Sorted part files for results that are too large for one task: a range
    sort, so reading the parts by name gives the whole order."""
    df.orderBy(*order).write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def observed(df: DataFrame, name: str = "source") -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is taken while it is written (K8)."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def verify_written(spark: SparkSession, source_rows: int, path: str, fmt: str = "parquet", **options) -> dict:
    """K8 for a write under ``observed``: the source is not read again."""
    written = spark.read.format(fmt).options(**options).load(path).count()
    return {"source_count": source_rows, "written_count": written, "counts_match": source_rows == written}


def write_sorted_tsv(df: DataFrame, path: str, order: list, **kw) -> None:
    """K2: TSV variant."""
    write_sorted_csv(df, path, order, sep="\t", **kw)


def _cluster(df: DataFrame, keys: list[str], partitions: int | None) -> DataFrame:
    """Cluster rows by ``keys`` before a write by the REBALANCE hint: AQE sizes
    the output partitions from the data and splits a hot key over several tasks
    by map output, so a task that runs again gets the same rows.  ``partitions``
    sets the number of partitions that it starts from (e.g. 100)."""
    return df.hint("rebalance", *keys) if partitions is None else df.hint("rebalance", partitions, *keys)


def write_clean_trips(df: DataFrame, path: str, by_provider: bool = False,
                      partitions: int | None = None) -> None:
    """K4/K5: clean trips clustered on (pu, do) (plus tlc_type folders with
    ``by_provider``).  ``partitions=DEFAULT_TOTAL_PARTITIONS`` (or
    ``DEFAULT_PER_PROVIDER_PARTITIONS`` by provider) starts from the
    reference's file counts."""
    keys = (["tlc_type"] if by_provider else []) + ["pu_location_id", "do_location_id"]
    out = _cluster(df, keys, partitions).write.mode("overwrite")
    if by_provider:
        out = out.partitionBy("tlc_type")
    out.parquet(path)


def write_partitioned(df: DataFrame, path: str, keys: list[str], partitions: int | None = None) -> None:
    """K6/K7: one job writing a ``key=value`` folder per key combination
    (provider/year, borough) instead of a loop of filtered writes; rows are
    clustered by the keys first so each task writes few folders."""
    _cluster(df, keys, partitions).write.mode("overwrite").partitionBy(*keys).parquet(path)


def write_month_folders(df: DataFrame, path: str, year_col: str, month_col: str) -> None:
    """One job writing plain ``path/YYYY/MM`` folders: written as ``key=value``
    folders beside it, whose files are then renamed into place."""
    spark = df.sparkSession
    staged = f"{path}/_staged"
    df.withColumnsRenamed({year_col: "year", month_col: "month"}).hint("rebalance", "year", "month") \
        .write.mode("overwrite").partitionBy("year", "month").parquet(staged)
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(staged)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{staged}/year=*/month=*")) or []:
        source = found.getPath()
        year, month = (part.split("=")[1] for part in source.toString().rstrip("/").split("/")[-2:])
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/{int(year):04d}/{int(month):02d}")
        fs.mkdirs(target.getParent())
        fs.delete(target, True)
        fs.rename(source, target)
    fs.delete(root, True)


def verify_roundtrip(spark: SparkSession, df: DataFrame, path: str, fmt: str = "parquet",
                     **options) -> DataFrame:
    """K8: one row (source_count, written_count, counts_match) comparing a
    source frame with what was written at ``path``."""
    written = spark.read.format(fmt).options(**options).load(path)
    src = df.select(F.count(F.lit(1))).scalar()
    dst = written.select(F.count(F.lit(1))).scalar()
    return spark.range(1).select(src.alias("source_count"), dst.alias("written_count"),
                                 (src == dst).alias("counts_match"))
