"""Size-checked broadcast for dimension-sized join sides.

Zone lists, centroids and lookups are bounded by the number of zones, but
Catalyst cannot see that through explodes and joins and would shuffle the
large side.  ``broadcast_if_small`` proves a row bound with one early-stopping
job and, where a row can be wide, a byte bound; only then it writes the side
to the checkpoint folder and adds the broadcast hint.  Beyond either bound the
join is left to the planner (shuffle join; AQE may still convert).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routecov.session import cut_lineage

# A side that may be broadcast: rows, and bytes where rows have no fixed width
# (far under the 8 GB broadcast limit and the driver's result size).
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20

_VARIABLE = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    ``offset(max_rows).isEmpty()`` runs through Spark's incremental take
    (CollectLimit with offset): it scans a few partitions, widens only when
    needed, stops as soon as row max_rows + 1 is seen, and returns at most one
    row -- cheap even when ``df`` is a very large table."""
    return df.offset(max_rows).isEmpty()


def text_bytes(df: DataFrame) -> int:
    """Bytes of all rows written as JSON: above their size as a relation."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, _VARIABLE)]
    if not wide:
        return 0
    return df.agg(F.sum(F.octet_length(F.to_json(F.struct(*[f"`{c}`" for c in wide]))).cast("bigint"))).first()[0] or 0


def broadcast_materialised(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Like ``broadcast_if_small`` for an aggregate or other result far smaller
    than what it is computed from: it is computed once, into the checkpoint
    folder, and its size is read from there."""
    kept = cut_lineage(df)
    return F.broadcast(kept) if is_small(kept, max_rows) and text_bytes(kept) <= max_bytes else kept


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint on ``df`` once it is proven to hold at most ``max_rows``
    rows and, of texts, lists and structs, at most ``max_bytes``.

    A side of few rows is written once to the checkpoint folder, so the size
    that was proven is the size that is sent, each call sees the data of its
    own time, and nothing stays cached.  A larger side comes back as it was."""
    if not is_small(df, max_rows):
        return df
    kept = cut_lineage(df)
    return F.broadcast(kept) if text_bytes(kept) <= max_bytes else kept
