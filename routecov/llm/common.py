"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from routecov.session import cut_lineage

__all__ = ["read_table", "text_of", "remainder", "cut_lineage", "binary_rows", "slabs"]

#: Bytes of text that one vectorised step works on (arrays take about 40 times this).
SLAB_BYTES = 1 << 18


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id written as text, modulo ``mod``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string")) % mod


def binary_rows(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow binary column without nulls, not copied."""
    kind = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    offsets = np.frombuffer(col.buffers()[1], kind)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def slabs(offsets: np.ndarray, size: int = SLAB_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
