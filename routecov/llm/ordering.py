"""Exact positions and running sums along a global order.

A global sort alone does not say where a row stands.  Here the sorted rows are
written once (so that range bounds drawn by sampling are drawn once), the
totals of the sorted partitions are added up, and each partition then counts
on from the totals before it.  Only one small row for each partition is
gathered; the result does not depend on where the partitions were cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_lineage


def _counted(starts: dict[int, tuple[int, int]], total: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if at is None:
                at = list(starts[batch.column("part")[0].as_py()])
            sizes = batch.column(total).to_numpy()
            before = at[1] + np.cumsum(sizes) - sizes
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(at[0] + np.arange(len(sizes))), pa.array(before)],
                [*batch.schema.names[:-1], "position", "before"])
            at[0] += len(sizes)
            at[1] += int(sizes.sum())
    return run


def positions(df: DataFrame, order: list[str], total: str) -> tuple[DataFrame, int, int]:
    """``df`` sorted by ``order``, with ``position`` (from 0) and ``before``
    (sum of the long column ``total`` over all earlier rows), and the number of
    rows and the sum over all of them.

    Rows that agree in all of ``order`` follow each other in any order.  The
    driver keeps two numbers for each partition of the sort."""
    ordered = cut_lineage(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()))
    totals = ordered.groupBy("part").agg(F.count("*").alias("rows"), F.sum(total).alias("total")).orderBy("part").collect()
    starts, rows, amount = {}, 0, 0
    for r in totals:
        starts[r["part"]] = (rows, amount)
        rows, amount = rows + r["rows"], amount + r["total"]
    schema = T.StructType([*df.schema.fields, T.StructField("position", T.LongType()), T.StructField("before", T.LongType())])
    return ordered.mapInArrow(_counted(starts, total), schema), rows, amount
