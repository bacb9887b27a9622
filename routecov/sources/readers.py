"""Readers (S1-S8).  Every reader is lazy and schema-first: a declared
``StructType`` skips inference passes and keeps types stable across files;
partitioned layouts (``key=value`` folders) give partition pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from routecov import schemas
from routecov.operators.clean import union_all


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
             header: bool = True, sep: str = ",", infer_schema: bool = False) -> DataFrame:
    """Delimited text with header.  Pass ``schema`` in production;
    ``infer_schema=True`` costs an extra pass over the data."""
    r = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        r = r.schema(schema)
    elif infer_schema:
        r = r.option("inferSchema", True)
    return r.csv(path)


def month_paths(base: str, provider: str, start: str, end: str) -> list[str]:
    """``base/provider/YYYY/MM`` folders for every month in [start, end]
    (``'2020-10'`` ... ``'2023-09'``)."""
    y, m = map(int, start.split("-"))
    ey, em = map(int, end.split("-"))
    out = []
    while (y, m) <= (ey, em):
        out.append(f"{base}/{provider}/{y:04d}/{m:02d}")
        m += 1
        if m == 13:
            y, m = y + 1, 1
    return out


def missing_months(spark: SparkSession, base: str, provider: str, start: str, end: str) -> list[str]:
    """Folders of months in [start, end] that ``base/provider`` does not have."""
    there = {month for month, _ in existing_months(spark, base, provider)}
    return [p for p in month_paths(base, provider, start, end) if "-".join(p.split("/")[-2:]) not in there]


def existing_months(spark: SparkSession, base: str, provider: str) -> list[tuple[str, str]]:
    """(``'YYYY-MM'``, folder) of every ``base/provider/YYYY/MM`` folder, by month.

    Listed through Hadoop's file system, so any store that Spark reads will do."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(f"{base}/{provider}/[0-9][0-9][0-9][0-9]/[0-9][0-9]")
    found = pattern.getFileSystem(conf).globStatus(pattern) or []
    paths = [f.getPath().toString() for f in found if f.isDirectory()]
    return sorted(("-".join(p.rstrip("/").split("/")[-2:]), p) for p in paths)


def read_months(spark: SparkSession, base: str, provider: str, start: str, end: str,
                schema: StructType | None = None, layout: str = "hive") -> DataFrame:
    """A month range of one provider as one scan.

    ``layout='hive'``: ``base/tlc_type=P/year=Y/month=M`` folders, selected by
    a partition filter (pruned at planning time).  ``layout='folders'``: the
    plain ``base/P/YYYY/MM`` layout, selected by listing the month folders;
    ``missing_months`` names those of the range that are not there."""
    if layout == "folders":
        r = spark.read.option("pathGlobFilter", "*.parquet")
        if schema is not None:
            r = r.schema(schema)
        there = [path for month, path in existing_months(spark, base, provider) if start <= month <= end]
        if not there:
            raise ValueError(f"no month folder of {provider} between {start} and {end} under {base}")
        return r.parquet(*there)
    sy, sm = map(int, start.split("-"))
    ey, em = map(int, end.split("-"))
    ym = F.col("year") * 100 + F.col("month")
    return (spark.read.parquet(base)
            .where((F.col("tlc_type") == provider) & ym.between(sy * 100 + sm, ey * 100 + em)))


def read_partitioned(spark: SparkSession, path: str, schema: StructType | None = None,
                     **partition_values) -> DataFrame:
    """Read a ``key=value`` partitioned Parquet layout and filter on
    partition keys (provider, year, borough, ...): Spark prunes the folders."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    for k, v in partition_values.items():
        df = df.where(F.col(k) == F.lit(v))
    return df


def read_groups(spark: SparkSession, groups: list[list[str]], clean) -> DataFrame:
    """Schema-drift-safe read: each path group is read and cleaned on its
    own (its own schema), then all groups are unioned by name."""
    return union_all([clean(spark.read.parquet(*paths)) for paths in groups])


def read_tagged(spark: SparkSession, path: str | list[str], fmt: str = "parquet",
                tag: str = "file_path") -> DataFrame:
    """Read files and tag each row with the file it came from (hidden
    ``_metadata`` column, no per-file loop)."""
    paths = [path] if isinstance(path, str) else path
    df = spark.read.format(fmt).load(paths)
    return df.withColumn(tag, F.col("_metadata.file_path"))


def read_clean_trips(spark: SparkSession, path: str) -> DataFrame:
    """Reload clean trips with the declared schema."""
    return spark.read.schema(schemas.TRIP).parquet(path)


def seed_isolated(spark: SparkSession, borough: str | None = None) -> DataFrame:
    """The constant isolated-zone lists as a DataFrame."""
    from routecov import seed
    return seed.isolated_zones(spark, borough)
