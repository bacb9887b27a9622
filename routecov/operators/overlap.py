"""Exact similarity join of sets by their rarest elements.

Two sets of Jaccard similarity at least t share at least ceil(t * n) elements,
n being the size of either.  Put in one order, rarest first, the first two
elements that they share then lie among the first n - ceil(t * n) + 2 of each.
So a set is indexed by the pairs of elements of that beginning, and two sets
are compared where they share such a pair.  Frequent elements stand at the end
and are in no beginning unless a set has hardly others, so an element that is
in every set pairs nothing by itself.

A pair of sets is compared once only, at the first two elements that they
share; no pair is produced twice and nothing has to be made distinct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecov.operators.sizing import BROADCAST_MAX_ROWS, is_small
from routecov.operators.skew import skew_join
from routecov.session import cut_lineage


def rarest_first(sets: DataFrame) -> DataFrame:
    """(id, items, n): the sets (id, items array of distinct values) with
    their elements by the number of sets they are in, then by value."""
    places = sets.select("id", F.explode("items").alias("item"))
    counts = cut_lineage(places.groupBy("item").agg(F.count(F.lit(1)).alias("_sets")))
    if is_small(counts, BROADCAST_MAX_ROWS):
        counted = places.join(F.broadcast(counts), "item")
    else:
        counted = skew_join(places, counts, ["item"])
    return (counted.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("_sets", "item"))).alias("_p"))
            .select("id", F.transform("_p", lambda p: p["item"]).alias("items"), F.size("_p").alias("n")))


def similar_sets(sets: DataFrame, percent: int = 75) -> DataFrame:
    """(a, b, shared): pairs a < b of ids of the sets (id, items) with
    100 * |A and B| >= percent * |A or B|, and the size of what they share.

    ``id`` is unique, ``items`` hold distinct values, no two sets are equal
    (group equal ones first); ``percent`` is above 50, so that any pair shares
    two elements or more.  Empty sets and sets of one element pair with none."""
    if not 50 < percent <= 100:
        raise ValueError("percent must be above 50 and at most 100")
    ordered = cut_lineage(rarest_first(sets)).where("n >= 2")
    reach = F.expr(f"slice(items, 1, n - cast(ceil({percent} * n / 100D) as int) + 2)")
    keyed = (ordered.withColumn("head", reach)
             .select("id", "items", "n", "head", F.posexplode("head").alias("_i", "k1"))
             .select("id", "items", "n", "head", "k1", F.explode(F.expr("slice(head, _i + 2, size(head))")).alias("k2")))
    a = keyed.select(*[F.col(c).alias(f"a_{c}") for c in ("id", "items", "n", "head")], "k1", "k2")
    b = keyed.select(*[F.col(c).alias(f"b_{c}") for c in ("id", "items", "n", "head")], "k1", "k2")
    fits = ((F.col("a_id") < F.col("b_id")) & (F.col("a_n") * 100 >= F.col("b_n") * percent)
            & (F.col("b_n") * 100 >= F.col("a_n") * percent))
    first_shared = F.slice(F.array_intersect("a_head", "b_head"), 1, 2) == F.array("k1", "k2")
    shared = F.size(F.array_intersect("a_items", "b_items"))
    return (a.join(b, ["k1", "k2"]).where(fits).where(first_shared)
            .select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), shared.alias("shared"),
                    (F.col("a_n") + F.col("b_n") - shared).alias("_either"))
            .where(F.col("shared") * 100 >= F.col("_either") * percent).drop("_either"))
