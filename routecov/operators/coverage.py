"""Path containment and coverage counts.

The reference compares every path with every other path on the driver
(n·(n-1) tests, one thread).  A contained child must have its first and last
zone, in order, inside the parent; so each parent emits its distinct ordered
end-point pairs (P[i], P[j]), i <= j, and joins the children on (first, last): an
equi-join whose output is only the candidate pairs that can match, checked
exactly by the subsequence (or contiguous) test.  Cost is Σ|P|² rows instead
of n² pairs, with no cross join.  The child table (one row per distinct
path) is broadcast when proven small, so a hot end-point key costs no
shuffle skew; beyond the bound hot keys are counted and split.

Contiguous containment needs no candidates: a rolling hash gives the
fingerprint of every slice of a parent in constant time, and children meet the
slices of their own length and fingerprint; a comparison of the ids confirms.
The same fingerprints count sub-paths (R4) as two longs each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecov.functions.paths import is_subsequence, prefix_hashes, slice_hash
from routecov.operators.sizing import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, is_small, text_bytes
from routecov.operators.skew import skew_join
from routecov.session import cut_lineage

SUBSEQUENCE, CONTIGUOUS = "subsequence", "contiguous"


def unique_paths(path_freq: DataFrame) -> DataFrame:
    """Q2: one row per path, frequencies of duplicate rows summed."""
    return (path_freq.where(F.col("trip_path").isNotNull() & (F.size("trip_path") > 0))
            .groupBy("trip_path").agg(F.sum("frequency").cast("bigint").alias("frequency")))


def endpoint_pairs(parents: DataFrame) -> DataFrame:
    """(parent, first, last) for every ordered element pair i <= j of parent, each once.

    One explode takes the distinct first zones, one the distinct zones from a
    first zone's first place on: rows stream out without a list of all pairs
    in memory and without a shuffle."""
    firsts = parents.where(F.size("parent") > 0).select("parent", F.explode(F.array_distinct("parent")).alias("first"))
    rest = F.expr("slice(parent, cast(array_position(parent, first) as int), size(parent))")
    return firsts.select("parent", "first", F.explode(F.array_distinct(rest)).alias("last"))


def slices(paths: DataFrame, col: str, lanes: int = 2, least: int = 1) -> DataFrame:
    """``paths`` with a row for every slice of ``col`` of at least ``least``
    elements, equal slices of one path once (where they first stand): the
    columns, ``_h``, n (size), i (start from 0) and fp (fingerprint).

    Slices of one size are sorted by fingerprint, which brings equal ones
    together; a row holds the slices of one size of one path at a time."""
    hashed = paths.where(F.size(col) >= least).withColumn("_h", prefix_hashes(f"`{col}`", lanes))
    sized = hashed.withColumn("n", F.explode(F.expr(f"sequence({least}, size(`{col}`))")))
    here = f"transform(sequence(0, size(`{col}`) - n), i -> named_struct('fp', {slice_hash('_h', 'i', 'n')}, 'i', i))"
    same = f"_s[k - 1].fp = x.fp and slice(`{col}`, _s[k - 1].i + 1, n) = slice(`{col}`, x.i + 1, n)"
    return (sized.withColumn("_s", F.expr(f"array_sort({here})"))
            .withColumn("_f", F.explode(F.expr(f"filter(_s, (x, k) -> k = 0 or not ({same}))")))
            .select(*paths.columns, "_h", "n", F.col("_f.i").alias("i"), F.col("_f.fp").alias("fp")))


def contained_pairs(path_freq: DataFrame, containment: str = SUBSEQUENCE, parents: DataFrame | None = None) -> DataFrame:
    """(parent, child, frequency) for each child path contained in parent,
    the parent itself included; ``frequency`` is the child's.  ``parents``
    (trip_path, distinct) restricts the parents before their pairs are made."""
    if containment not in (SUBSEQUENCE, CONTIGUOUS):
        raise ValueError(f"containment must be {SUBSEQUENCE!r} or {CONTIGUOUS!r}")
    paths = unique_paths(path_freq)
    wanted = paths if parents is None else paths.join(parents.select("trip_path"), "trip_path", "left_semi")
    wanted = wanted.select(F.col("trip_path").alias("parent"))
    children = paths.select(F.col("trip_path").alias("child"), "frequency")
    if containment == CONTIGUOUS:
        keys = slices(wanted, "parent").drop("_h")
        children = children.withColumn("_h", prefix_hashes("child")).selectExpr(
            "child", "frequency", "size(child) as n", f"{slice_hash('_h', '0', 'size(child)')} as fp")
        on, test = ["n", "fp"], F.expr("slice(parent, i + 1, n) = child")
    else:
        keys = endpoint_pairs(wanted)
        children = children.selectExpr("child", "frequency", "child[0] as first", "element_at(child, -1) as last")
        on, test = ["first", "last"], is_subsequence(F.col("child"), F.col("parent"))
    # children are one row per distinct path: broadcast them once proven small,
    # so the side of the parents is never shuffled; else split its hot keys
    children = cut_lineage(children)
    if is_small(children, BROADCAST_MAX_ROWS) and text_bytes(children) <= BROADCAST_MAX_BYTES:
        joined = keys.join(F.broadcast(children), on)
    else:
        joined = skew_join(keys, children, on)
    return joined.where(test).select("parent", "child", "frequency")


def coverage_count(path_freq: DataFrame, containment: str = SUBSEQUENCE) -> DataFrame:
    """(trip_path, coverage_count) = own frequency + frequencies of every
    other path contained in it."""
    return (contained_pairs(path_freq, containment)
            .groupBy(F.col("parent").alias("trip_path"))
            .agg(F.sum("frequency").cast("bigint").alias("coverage_count")))


def covered_sub_paths(path_freq: DataFrame, containment: str = SUBSEQUENCE) -> DataFrame:
    """A10: (trip_path, sub_paths) where sub_paths lists the path itself first,
    then the other contained paths in ascending order."""
    pairs = contained_pairs(path_freq, containment)
    return (pairs.groupBy(F.col("parent").alias("trip_path"))
            .agg(F.array_sort(F.collect_list(
                F.when(F.col("child") != F.col("parent"), F.col("child")))).alias("_others"))
            .select("trip_path",
                    F.concat(F.array(F.col("trip_path")), F.col("_others")).alias("sub_paths")))


def sub_path_frequency(path_freq: DataFrame, min_len: int = 2) -> DataFrame:
    """Every contiguous sub-path (length >= min_len) of every path with the
    summed frequency of the paths that contain it, once per containing path.

    Slices are grouped by their size and two fingerprints of 62 bits from four
    independent rolling hashes; only for each distinct one is the sub-path
    itself cut out of one path that holds it."""
    paths = cut_lineage(unique_paths(path_freq).withColumn("id", F.monotonically_increasing_id()))
    each = slices(paths, "trip_path", lanes=4, least=min_len)
    found = (each.select("id", "frequency", "n", "i", "fp", F.expr(slice_hash("_h", "i", "n", 1)).alias("fp2"))
             .groupBy("n", "fp", "fp2").agg(F.sum("frequency").cast("bigint").alias("frequency"),
                                            F.min_by("i", "id").alias("i"), F.min("id").alias("id")))
    return (found.join(paths.select("id", "trip_path"), "id")
            .select(F.slice("trip_path", F.col("i") + 1, F.col("n")).alias("sub_path"), "frequency"))
