"""Trip frequency per (pick-up, drop-off) pair and its distribution profiles.

At scale the trip table is the only large input: every operator here is a
partial + final hash aggregation (map-side combine), so a pair that holds a
third of all trips collapses to one row per map task before the shuffle.
Zone lists are dimension-sized: they are joined as broadcast semi/anti joins
once their size is proven (``broadcast_if_small``), so the trip side is never
shuffled for them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecov.operators.sizing import broadcast_if_small
from routecov.session import cut_lineage

PU, DO = "pu_location_id", "do_location_id"


def _ids(zones: DataFrame, col: str = "location_id") -> DataFrame:
    return zones.select(F.col(col).cast("bigint").alias("_zone")).distinct()


def keep_zones(trips: DataFrame, zones: DataFrame, col: str = "location_id") -> DataFrame:
    """Both ends in the zone list (two broadcast left-semi joins when
    the list is proven small; the trip side is never shuffled for it)."""
    z = broadcast_if_small(_ids(zones, col))
    return (trips.join(z, trips[PU] == z["_zone"], "left_semi")
            .join(z, trips[DO] == z["_zone"], "left_semi"))


def drop_zones(trips: DataFrame, zones: DataFrame, col: str = "location_id") -> DataFrame:
    """Neither end in the zone list (two left-anti joins)."""
    z = broadcast_if_small(_ids(zones, col))
    return (trips.join(z, trips[PU] == z["_zone"], "left_anti")
            .join(z, trips[DO] == z["_zone"], "left_anti"))


def drop_same_zone(df: DataFrame) -> DataFrame:
    """pick-up and drop-off differ (NULL ids drop too)."""
    return df.where(F.col(PU) != F.col(DO))


def only_same_zone(df: DataFrame) -> DataFrame:
    """pick-up equals drop-off."""
    return df.where(F.col(PU) == F.col(DO))


def trip_frequency(trips: DataFrame, zones: DataFrame | None = None,
                   isolated: DataFrame | None = None,
                   exclude_same_zone: bool = False) -> DataFrame:
    """A1: (pu_location_id, do_location_id, frequency).

    ``zones``: keep pairs whose both ends are listed (target borough);
    ``isolated``: drop pairs touching a listed zone; rows with a NULL end
    never match a zone list and are dropped by the grouping filter below.
    """
    t = trips.select(F.col(PU).cast("bigint").alias(PU), F.col(DO).cast("bigint").alias(DO))
    t = t.where(F.col(PU).isNotNull() & F.col(DO).isNotNull())
    if exclude_same_zone:
        t = drop_same_zone(t)
    if zones is not None and isolated is not None:
        # one allow-list (zones minus isolated) -> two semi joins instead of four
        allowed = _ids(zones).join(_ids(isolated), "_zone", "left_anti")
        t = keep_zones(t, allowed, "_zone")
    elif zones is not None:
        t = keep_zones(t, zones)
    elif isolated is not None:
        t = drop_zones(t, isolated)
    return t.groupBy(PU, DO).agg(F.count(F.lit(1)).alias("frequency"))


def _share(df: DataFrame, keys: list[str]) -> DataFrame:
    """Grouped sum with its percent of the total.  The grouped result is
    materialised once and the total is summed from it, so the input (the
    trip aggregation) is computed once, not again for the total."""
    agg = cut_lineage(df.groupBy(*keys).agg(F.sum("frequency").alias("frequency")))
    total = agg.select(F.sum("frequency")).scalar()
    return agg.withColumn("percentage", F.col("frequency") * 100 / total)


def same_zone_distribution(freq: DataFrame) -> DataFrame:
    """A2: same-zone trips per pair with percent of all same-zone trips."""
    return _share(only_same_zone(freq), [PU, DO])


def from_zone_distribution(freq: DataFrame) -> DataFrame:
    """A3: cross-zone trips per pick-up zone with percent of all cross-zone trips."""
    return _share(drop_same_zone(freq), [PU])


def to_zone_distribution(freq: DataFrame) -> DataFrame:
    """A4: cross-zone trips per drop-off zone with percent."""
    return _share(drop_same_zone(freq), [DO])


def total_trips(freq: DataFrame) -> DataFrame:
    """One-row grand total of trips."""
    return freq.agg(F.coalesce(F.sum("frequency"), F.lit(0)).cast("bigint").alias("total_trips"))


def pair_frequency_struct(pairs: DataFrame, zones: DataFrame | None = None,
                          isolated: DataFrame | None = None,
                          pu: str = "pulocationID", do: str = "dolocationID") -> DataFrame:
    """P6 + A1 variant over reduced trips (pulocationID, dolocationID):
    different zones, both in ``zones``, none isolated; one row per pair as
    ``PUDOPair struct<pulocationID, dolocationID>`` with ``Frequency``."""
    t = pairs.select(F.col(pu).cast("bigint").alias(PU), F.col(do).cast("bigint").alias(DO))
    freq = trip_frequency(t, zones=zones, isolated=isolated, exclude_same_zone=True)
    return freq.select(F.struct(F.col(PU).alias("pulocationID"), F.col(DO).alias("dolocationID")).alias("PUDOPair"),
                       F.col("frequency").alias("Frequency"))
