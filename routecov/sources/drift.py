"""Files grouped by the schema that stands in their footers.

Monthly files of one provider change column types and spelling at dates of
their own.  Reading files of different types as one scan fails or turns values
to null, so files are grouped by what their footers say, each group is read
and cleaned by itself, and the groups are unioned.  Only footers are read for
that, several at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from routecov.operators.clean import union_all

#: Footers that are read at a time.
READERS = 16


def files_below(spark: SparkSession, folder: str, suffix: str = ".parquet") -> list[str]:
    """Data files anywhere below a folder (or the file itself), by name; hidden ones are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    if not fs.exists(root):
        return []
    found, each = [], fs.listFiles(root, True)
    while each.hasNext():
        path = each.next().getPath()
        if path.getName().endswith(suffix) and not path.getName().startswith(("_", ".")):
            found.append(path.toString())
    return sorted(found)


def _key(schema: StructType, columns: Iterable[str] | None) -> tuple:
    fields = {f.name.lower(): f.dataType.simpleString() for f in schema.fields}
    wanted = sorted(fields) if columns is None else [c.lower() for c in columns]
    return tuple((c, fields.get(c)) for c in wanted)


def schema_groups(spark: SparkSession, files: list[str], columns: Iterable[str] | None = None) -> list[tuple[list[str], StructType]]:
    """Files of one schema each, in the order of their first file, with that
    schema.  Names compare without case, as Spark reads them; with ``columns``
    only these count, and further columns may differ within a group."""
    columns = None if columns is None else list(columns)
    if not files:
        return []
    with ThreadPoolExecutor(min(READERS, len(files))) as pool:
        schemas = list(pool.map(lambda f: spark.read.parquet(f).schema, files))
    groups: dict[tuple, tuple[list[str], StructType]] = {}
    for path, schema in zip(files, schemas):
        groups.setdefault(_key(schema, columns), ([], schema))[0].append(path)
    return list(groups.values())


def read_by_schema(spark: SparkSession, files: list[str], clean: Callable[[DataFrame], DataFrame],
                   columns: Iterable[str] | None = None) -> DataFrame:
    """Every group read with its own schema and cleaned by itself, then one union."""
    groups = schema_groups(spark, files, columns)
    if not groups:
        raise ValueError("no files to read")
    return union_all([clean(spark.read.schema(schema).parquet(*paths)) for paths, schema in groups])
