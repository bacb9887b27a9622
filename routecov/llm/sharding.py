"""Shards along a Hilbert curve through several metadata dimensions.

Each dimension is scaled to the same number of cells between its least and
greatest value (texts by their first bytes, sizes by their logarithm), a row's
cells give its index on the Hilbert curve, and the order by that index is cut
into runs of equal row counts.  Neighbours on the curve are neighbours in
every dimension, so each shard spans a narrow range of all of them and a
reader that filters on any can skip files by their statistics.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, text_of
from .ordering import positions

BITS = 12


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Index on the Hilbert curve of cells (one row of coordinates per dimension).

    The coordinates are turned into the curve's transposed index bit by bit
    from the top (Skilling, "Programming the Hilbert curve"), then interleaved."""
    x = cells.astype(np.int64).copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    index = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> b) & 1)
    return index


def prefix_number(text: Column) -> Column:
    """The first six bytes as a number that sorts as they do; null as 0."""
    padded = F.rpad(F.hex(F.substring(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 1, 6)), 12, "0")
    return F.conv(padded, 16, 10).cast("double")


def _indexed(dims: list[str], low: dict, high: dict, bits: int):
    @F.pandas_udf("long")
    def run(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in parts:
            cells = []
            for name, c in zip(dims, columns):
                span = (high[name] - low[name]) or 1.0
                cells.append(np.clip((c.to_numpy(np.float64) - low[name]) / span * (1 << bits), 0, (1 << bits) - 1))
            yield pd.Series(hilbert_index(np.stack(cells), bits))
    return run


def curve_order(df: DataFrame, dims: dict[str, Column], bits: int = BITS) -> DataFrame:
    """``df`` with ``curve``, the Hilbert index of numeric ``dims`` (nulls count as the least value)."""
    if bits * len(dims) > 62:
        raise ValueError("bits times dimensions must fit a long")
    names = list(dims)
    scaled = df.withColumns({f"_{n}": c.cast("double") for n, c in dims.items()})
    r = scaled.agg(*[f(f"_{n}").alias(f"{k}{n}") for n in names for k, f in (("lo", F.min), ("hi", F.max))]).first()
    low, high = {n: r[f"lo{n}"] or 0.0 for n in names}, {n: r[f"hi{n}"] or 0.0 for n in names}
    index = _indexed(names, low, high, bits)(*[F.coalesce(F.col(f"_{n}"), F.lit(low[n])) for n in names])
    return scaled.withColumn("curve", index).drop(*[f"_{n}" for n in names])


def sharded(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Every row in a run of the curve order: doc_id, size (UTF-8 bytes plus 1),
    text_crc32, law (``rows``: shard counts at most one apart), shard, slot
    (gapless from 0 in a shard), grown_shard (null under this law), curve.

    Dimensions: lang, source, size, doc_id.  Null text has no bytes; nulls in
    the dimensions sort first; ties on the curve go by doc_id and checksum;
    repeated rows each have a slot; other columns are ignored; an empty table
    gives no rows, fewer rows than shards leave shards empty.
    """
    text = text_of()
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       prefix_number(F.col("lang")).alias("lang"), prefix_number(F.col("source")).alias("source"))
    curve = curve_order(rows, {"lang": F.col("lang"), "source": F.col("source"), "size": F.log2("size"), "doc_id": F.col("doc_id")})
    placed, n, _ = positions(curve.drop("lang", "source"), ["curve", "doc_id", "text_crc32"], "size")
    shard = F.expr(f"position * {shards} div {max(n, 1)}")
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard.cast("int")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("position") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "curve")


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """Write whole rows of ``docs`` under ``path``, one folder a shard, in curve order.

    Rows meet their place by doc_id and checksum, so repeated rows may trade places."""
    keyed = docs.withColumn("_crc", F.crc32(text_of()))
    place = sharded(docs, shards).groupBy("doc_id", "text_crc32").agg(F.min("shard").alias("_shard"), F.min("curve").alias("_curve"))
    joined = keyed.join(place, keyed["doc_id"].eqNullSafe(place["doc_id"]) & (keyed["_crc"] == place["text_crc32"])).drop(
        place["doc_id"], place["text_crc32"], "_crc")
    (joined.repartitionByRange("_shard", "_curve").sortWithinPartitions("_shard", "_curve").drop("_curve")
     .withColumnRenamed("_shard", "shard").write.partitionBy("shard").parquet(path))


def op10_sharding(spark, sf_dir: str) -> DataFrame:
    """All ``documents`` in 16 shards along the curve."""
    return sharded(read_table(spark, sf_dir, "documents"))
