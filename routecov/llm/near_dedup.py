"""MinHash near-duplicate groups of documents.

1. One pass over the texts gives each document's set of word shingles, its
   size, a 128-bit digest of the set and a signature of universal-hash minima.
2. Documents with equal sets form a class; its smallest id stands for it.
3. Signatures are cut into bands; classes that agree in a band are candidates.
   Every bucket first proposes only pairs with its smallest member, so a large
   bucket costs as many rows as it has members.
4. Candidates pass if their signatures agree well enough and then, on the
   full sets, intersection / union reaches the similarity.
5. Components of those links settle most buckets.  Where a bucket still spans
   several components, its members go with their full sets, in blocks, to tasks
   that compare all pairs across components (in the first band that a pair
   shares) and return one link for each two components; so no link between
   components is missed for having been left out in step 3, and a large bucket
   is never spelled out as rows of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_rows, cut_lineage, read_table, text_of
from .components import star_components
from .words import hashed_words, mix, runs

HASHES = 128
ROWS_PER_BAND = 4
#: A signature may understate a similarity by five standard deviations before a pair is given up.
SLACK = 5
#: Members of a bucket compared with each other in one go.
BLOCK = 2048

_rng = np.random.default_rng(5)
_A = _rng.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of HASHES multiply-shift hashes over the set."""
    low = np.full(HASHES, 0xFFFFFFFF, np.uint64)
    for i in range(0, len(shingles), 1024):
        part = shingles[i:i + 1024]
        low = np.minimum(low, ((_A[:, None] * part + _B[:, None]) >> np.uint64(32)).min(1))
    return low.astype("<u4")


def _band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(-1, ROWS_PER_BAND).astype(np.uint64)
    key = np.arange(len(rows), dtype=np.uint64)
    for i in range(ROWS_PER_BAND):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return key.view(np.int64)


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[np.ndarray]:
    data, offsets = binary_rows(batch.column(batch.schema.get_field_index("bytes")))
    for _, hashes, bounds in hashed_words(data, offsets):
        for i, j in zip(bounds[:-1], bounds[1:]):
            yield np.unique(runs(hashes[i:j], words))


def _sign(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, d1, d2, signs = [], [], [], []
            for s in _sets(batch, words):
                size.append(len(s))
                if len(s):
                    total = np.add.reduce(np.stack([mix(s + np.uint64(1)), mix(s ^ np.uint64(0x5851F42D4C957F2D))]), 1).view(np.int64)
                    d1.append(int(total[0])), d2.append(int(total[1]))
                    signs.append(minima(s).tobytes())
                else:
                    d1.append(0), d2.append(0), signs.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                 pa.array(signs, pa.binary())], ["doc_id", "n_shingles", "d1", "d2", "signature"])
    return run


def _shingle_sets(words: int, signed: bool = False):
    def run(batches):
        for batch in batches:
            sets, signs = [], []
            for s in _sets(batch, words):
                sets.append(s.tobytes())
                if signed:
                    signs.append(minima(s).tobytes())
            columns = [batch.column(0), pa.array(sets, pa.binary())] + ([pa.array(signs, pa.binary())] if signed else [])
            yield pa.RecordBatch.from_arrays(columns, ["id", "shingles", "signature"][:len(columns)])
    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = HASHES // ROWS_PER_BAND
    for batch in batches:
        ids = batch.column(0).to_numpy()
        signs = [np.frombuffer(x, "<u4") for x in batch.column(1).to_pylist()]
        for i in range(0, len(ids), 1000):
            keys = [_band_keys(s) for s in signs[i:i + 1000]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys)), pa.array(np.tile(np.arange(n, dtype=np.int32), len(keys))),
                 pa.array(np.repeat(ids[i:i + 1000], n))], ["bucket", "band", "id"])


def _overlap(numerator: int, denominator: int):
    def run(batches):
        for batch in batches:
            a, b, keep = batch.column(2).to_pylist(), batch.column(3).to_pylist(), []
            for x, y in zip(a, b):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(denominator * common >= numerator * (len(x) + len(y) - common))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _links_across(floor: float, percent: int):
    """Links between members of two blocks of a bucket that lie in different
    components, one for each member and component it is linked with."""
    def run(rows):
        import pandas as pd
        left, right = rows[rows["side"] != 1], rows[rows["side"] != 0]
        out_a, out_b = [], []
        if len(left) and len(right):
            band, same = int(rows["band"].iloc[0]), bool((left["side"] == 2).all())
            sets = [np.frombuffer(x, np.uint64) for x in right["shingles"]]
            signs = np.stack([np.frombuffer(x, "<u4") for x in right["signature"]])
            ids, comp, size = right["id"].to_numpy(), right["component"].to_numpy(), np.array([len(x) for x in sets])
            for i, c, own, sign in zip(left["id"], left["component"], left["shingles"], left["signature"]):
                own, sign = np.frombuffer(own, np.uint64), np.frombuffer(sign, "<u4")
                ok = (comp != c) & (100 * np.minimum(size, len(own)) >= percent * np.maximum(size, len(own)))
                if same:
                    ok &= ids > i
                at = np.flatnonzero(ok)
                equal = signs[at] == sign
                fit = equal.mean(1) >= floor
                at, equal = at[fit], equal[fit]
                first = equal.reshape(len(at), HASHES // ROWS_PER_BAND, ROWS_PER_BAND).all(2).argmax(1)
                at = at[first == band]
                if not len(at):
                    continue
                n = size[at]
                other = np.concatenate([sets[j] for j in at])
                near = own[np.minimum(np.searchsorted(own, other), len(own) - 1)] == other
                common = np.add.reduceat(near, np.r_[0, np.cumsum(n)[:-1]], dtype=np.int64)
                at = at[100 * common >= percent * (n + len(own) - common)]
                at = at[np.unique(comp[at], return_index=True)[1]]
                out_a.extend([i] * len(at)), out_b.extend(ids[at])
        return pd.DataFrame({"a": np.array(out_a, np.int64), "b": np.array(out_b, np.int64)})
    return run


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 75) -> DataFrame:
    """Components of documents whose word-shingle sets have a Jaccard similarity
    of at least ``percent`` / 100.

    Input: doc_id and text; other columns are ignored.  Output per row:
    doc_id, n_shingles, component_id (smallest doc_id reachable), kept.
    Null or empty text, or one without words, has no shingles and stays alone;
    fewer than ``words`` words are one shingle.  Repeated rows count as one
    document; a null doc_id is linked with nothing (component_id null, kept).
    An empty table gives an empty result.  Banding misses a pair at exactly
    0.75 with a probability of 5e-6, less above.
    """
    share = percent / 100
    floor = share - SLACK * (share * (1 - share) / HASHES) ** 0.5
    docs = docs.select("doc_id", text_of().cast("binary").alias("bytes"))
    signed = cut_lineage(docs.mapInArrow(_sign(words), "doc_id long, n_shingles long, d1 long, d2 long, signature binary"))
    whole = signed.where("n_shingles > 0 and doc_id is not null")
    classes = whole.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"))
    classes = cut_lineage(classes)
    signs = whole.join(classes.select("rep"), F.col("doc_id") == F.col("rep"), "leftsemi").select(
        F.col("doc_id").alias("id"), "signature")

    banded = signs.mapInArrow(_bands, "bucket long, band int, id long")
    crowded = banded.groupBy("bucket").agg(F.min("id").alias("pivot"), F.max("id").alias("top"), F.count("*").alias("n"))
    banded = cut_lineage(banded.join(crowded.where("pivot != top"), "bucket"))  # one rep per bucket is no candidate

    def shingle_sets(ids: DataFrame, signed: bool = False) -> DataFrame:
        own = docs.join(ids.distinct(), "doc_id", "leftsemi").dropDuplicates(["doc_id"]).select("doc_id", "bytes")
        return cut_lineage(own.mapInArrow(_shingle_sets(words, signed), "id long, shingles binary" + ", signature binary" * signed))

    stars = banded.where("id != pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    stars = stars.join(signs.select(F.col("id").alias("a"), F.col("signature").alias("sa")), "a").join(
        signs.select(F.col("id").alias("b"), F.col("signature").alias("sb")), "b")
    stars = cut_lineage(stars.mapInArrow(_alike(floor), "a long, b long"))
    sets = shingle_sets(stars.select(F.col("a").alias("doc_id")).union(stars.select("b")))
    links = cut_lineage(
        stars.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
        .join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b").select("a", "b", "sa", "sb")
        .mapInArrow(_overlap(percent, 100), "a long, b long"))
    parts = cut_lineage(star_components(links))

    placed = banded.join(parts.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    spanning = placed.groupBy("bucket").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 != c1")
    placed = cut_lineage(placed.join(spanning.select("bucket"), "bucket", "leftsemi").select("bucket", "band", "n", "id", "component"))
    sets = shingle_sets(placed.select(F.col("id").alias("doc_id")), signed=True)
    blocked = placed.withColumn("k", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("id"), F.col("k")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    blocked = blocked.select(
        "bucket", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        "band", "id", "component").join(sets, "id")
    across = cut_lineage(blocked.groupBy("bucket", "p", "q").applyInPandas(_links_across(floor, percent), "a long, b long"))
    parts = cut_lineage(star_components(links.union(across)))

    keyed = signed.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["n_shingles", "d1", "d2"], "left").join(
        parts.withColumnRenamed("node", "rep"), "rep", "left")
    linked = F.when(F.col("n_shingles") > 0, F.coalesce("component", "rep"))
    return keyed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce(linked, "doc_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _alike(floor: float):
    def run(batches):
        for batch in batches:
            keep = [bool((np.frombuffer(x, "<u4") == np.frombuffer(y, "<u4")).mean() >= floor)
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def op6_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
