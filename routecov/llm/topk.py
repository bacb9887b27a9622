"""Exact top-k by inner product over norm buckets.

Candidates are ranked by length and cut into buckets of like length; queries
are cut into blocks.  Every query first meets the longest candidates, whose
k-th best product is a floor for its final scores.  Then each block of queries
meets each bucket: candidates too short for every query of the block are not
sent at all.  Inside, a bucket is taken in runs; a query's floor divided by
its own and the run's greatest length is the least cosine that still counts
there.  Above 1 the run is skipped.  A high cosine bounds single coordinates,
so the query's largest coordinates select candidates from sorted lists; a low
one only bounds the length, which selects a prefix.  What is left is verified
by the whole integer product, which raises the floor for the next run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, read_table
from .ordering import positions

#: Candidates that go to a task together, and queries.
BUCKET, BLOCK = 16_384, 4_096
#: Longest candidates that set the first floors.
SEED = 2_048
#: Candidates of a run, and coordinates that prune one.
RUN, FOCUS = 1_024, 4
#: From this local cosine on, coordinates prune better than lengths.
STEEP = 0.6
_SLACK = 1e-9


def _vectors(scale: float):
    """Whole-number vectors as bytes of doubles, their length, and the greatest component."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, data, length, dim, top = [], [], [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                if i is None or not v.is_valid:
                    continue
                x = v.values
                if x.null_count:
                    continue
                x = np.floor(scale * x.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(x).all():
                    continue
                x = x + 0.0  # no negative zero
                ids.append(i), data.append(x.tobytes()), length.append(float(np.sqrt(x @ x))), dim.append(len(x))
                top.append(float(np.abs(x).max(initial=0)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(data, pa.binary()), pa.array(length, pa.float64()), pa.array(dim, pa.int32()),
                 pa.array(top, pa.float64())], ["vec_id", "vector", "length", "dim", "top"])
    return run


def _matrix(column) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float64) for x in column])


def _products(rows: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    """Integer products; beyond 2**53 by Python integers."""
    if exact:
        return rows @ q
    return np.array([sum(int(a) * int(b) for a, b in zip(r, q)) for r in rows], object)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > 4 * k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
        return at[np.lexsort((ids[at], -scores[at]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search(ids: np.ndarray, rows: np.ndarray, lengths: np.ndarray, qids: np.ndarray, queries: np.ndarray,
           floors: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, vec_id, score) of every query's k best of these candidates, but for those surely under its floor."""
    order = np.argsort(-lengths, kind="stable")
    ids, rows, lengths = ids[order], rows[order], lengths[order]
    qlengths = np.sqrt((queries * queries).sum(1))
    top = max(np.abs(rows).max(initial=0), np.abs(queries).max(initial=0))
    exact = bool(top * top * max(1, rows.shape[1]) < 2**53)
    floors = floors.copy()
    found: list[list] = [[np.zeros(0, np.int64), np.zeros(0, np.float64 if exact else object)] for _ in qids]
    for start in range(0, len(ids), RUN):
        part, plen, pids = rows[start:start + RUN], lengths[start:start + RUN], ids[start:start + RUN]
        longest = plen[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(floors > 0, floors * (1 - _SLACK) / (qlengths * longest), -1.0)
        alive = np.flatnonzero(~(cosine > 1))
        unit = sorted_lists = None
        for j in alive:
            q, t = queries[j], cosine[j]
            n = len(pids)
            if t > 0:  # length: a prefix, as lengths fall
                n = int(np.searchsorted(-plen, -(floors[j] * (1 - _SLACK) / qlengths[j]), "right"))
            at = None
            if t >= STEEP and n and rows.shape[1]:
                if unit is None:
                    unit = part / np.where(plen > 0, plen, 1)[:, None]
                    sorted_lists = {}
                direction = q / qlengths[j]
                hits = np.zeros(len(pids), np.int8)
                focus = np.argsort(-np.abs(direction))[:FOCUS]
                for f in focus:
                    if f not in sorted_lists:
                        by = np.argsort(unit[:, f], kind="stable")
                        sorted_lists[f] = by, unit[by, f]
                    by, values = sorted_lists[f]
                    reach = np.sqrt(max(0.0, (1 - t * t) * (1 - direction[f] ** 2)))
                    low = direction[f] * t - reach if direction[f] * 1.0 > -t else -1.0
                    high = direction[f] * t + reach if direction[f] * 1.0 < t else 1.0
                    a, b = np.searchsorted(values, low - 1e-7), np.searchsorted(values, high + 1e-7, "right")
                    hits[by[a:b]] += 1
                at = np.flatnonzero(hits[:n] == len(focus))
            scores = _products(part[:n] if at is None else part[at], q, exact)
            cids = pids[:n] if at is None else pids[at]
            keep = np.flatnonzero((scores >= floors[j]) & (cids != qids[j])) if len(cids) else []
            if not len(keep):
                continue
            own_ids, own = np.r_[found[j][0], cids[keep]], np.r_[found[j][1], scores[keep]]
            best = _best(own, own_ids, k)
            found[j] = [own_ids[best], own[best]]
            if len(best) == k:
                floors[j] = max(floors[j], float(own[best[-1]]))
    return [(int(q), int(v), int(s)) for q, (vs, ss) in zip(qids, found) for v, s in zip(vs, ss)]


def _meet(k: int):
    def run(left, right):
        import pandas as pd
        out = []
        if len(left) and len(right):
            out = search(left["vec_id"].to_numpy(), _matrix(left["vector"]), left["length"].to_numpy(), right["query_id"].to_numpy(),
                         _matrix(right["query"]), right["floor"].to_numpy(), k)
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, column: str = "embedding",
          bucket: int = BUCKET, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The k candidates of highest inner product for every query: query_id, rank, vec_id, score.

    Components are floor(scale * x).  Queries are the rows where ``is_query``
    (on vec_id) holds; candidates all rows but those of the query's vec_id;
    ties go to the smaller vec_id.  Rows with a null vec_id, a null vector or a
    null or non-finite component take no part; only vectors of the same
    number of components meet.  Repeated rows count once.  Other columns are
    ignored; no queries or no candidates give no rows.
    """
    clean = vectors.select("vec_id", F.col(column).alias("v")).mapInArrow(
        _vectors(scale), "vec_id long, vector binary, length double, dim int, top double").distinct()
    ranked, n, _ = positions(clean.withColumns({"one": F.lit(1).cast("long"), "down": -F.col("length")}), ["dim", "down", "vec_id"], "one")
    ranked = cut_lineage(ranked.select("vec_id", "vector", "length", "dim", F.expr(f"position div {bucket}").alias("bucket"), "position"))
    heads = ranked.groupBy("dim").agg(F.min("position").alias("first"), F.max("bucket").alias("last"), F.min("bucket").alias("low"))
    ranked = ranked.join(heads, "dim").withColumn("place", F.col("position") - F.col("first"))
    queries = ranked.where(is_query).select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.col("length").alias("qlength"), "dim", "low", "last",
        F.pmod(F.xxhash64("vec_id"), F.lit(max(1, -(-n // (50 * block))))).cast("int").alias("block"))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(max(1, -(-n // (50 * block))) - 1))).alias("block")
    seeds = ranked.where(F.col("place") < seed).select("vec_id", "vector", "length", F.col("dim").alias("cdim"), blocks.alias("cblock"))
    first = seeds.groupBy("cdim", "cblock").cogroup(
        queries.withColumn("floor", F.lit(float("-inf"))).groupBy("dim", "block")).applyInPandas(
        _meet(k), "query_id long, vec_id long, score long")
    floors = first.groupBy("query_id").agg(F.min("score").cast("double").alias("floor"), F.count("*").alias("found"))
    queries = cut_lineage(queries.join(floors, "query_id", "left").withColumn(
        "floor", F.when(F.col("found") >= k, F.col("floor")).otherwise(F.lit(float("-inf")))).drop("found"))
    needs = queries.groupBy(F.col("dim").alias("qdim"), F.col("block").alias("qblock")).agg(F.min(
        F.when((F.col("floor") > 0) & (F.col("qlength") > 0), F.col("floor") / F.col("qlength")).otherwise(0.0)).alias("need"))
    sent = ranked.select("vec_id", "vector", "length", "dim", "bucket", blocks).join(
        needs, (F.col("dim") == F.col("qdim")) & (F.col("block") == F.col("qblock"))).where(
        F.col("length") * (1 + 2 * _SLACK) >= F.col("need")).select(
        "vec_id", "vector", "length", F.col("dim").alias("cdim"), F.col("bucket").alias("cbucket"), F.col("block").alias("cblock"))
    asked = queries.withColumn("bucket", F.explode(F.sequence("low", "last")))
    met = sent.groupBy("cdim", "cbucket", "cblock").cogroup(asked.groupBy("dim", "bucket", "block")).applyInPandas(
        _meet(k), "query_id long, vec_id long, score long")
    from pyspark.sql import Window
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.distinct().withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_topk(spark, sf_dir: str) -> DataFrame:
    """Five best of all ``embeddings`` for every vector whose id is divisible by 50."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
