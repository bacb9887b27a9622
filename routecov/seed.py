"""Constant relations (S8) for runs on the real zone data.

Only short lists live here.  A borough's connected zones are derived by rule
from the zone lookup (its zones minus its isolated zones, see
``connected_zones``); the neighbour relation itself is an input table (or
derived from polygons), not a constant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Zones without a land neighbour, per borough.
ISOLATED_ZONES = {
    "Bronx": [46, 199],
    "Brooklyn": [],
    "EWR": [1],
    "Manhattan": [103, 104, 105, 153, 194, 202],
    "Queens": [2, 27, 30, 86, 117, 201],
    "Staten Island": [],
}

# Manhattan zones (with the repeated 103 as listed) and the
# zones green taxis may serve there (above W 110 St / E 96 St).
MANHATTAN_AREAS = [
    4, 24, 12, 13, 41, 45, 42, 43, 48, 50, 68, 79, 74, 75, 87, 88, 90, 125, 100, 103, 103, 103,
    107, 113, 114, 116, 120, 127, 128, 151, 140, 137, 141, 142, 152, 143, 144, 148, 153, 158,
    161, 162, 163, 164, 170, 166, 186, 194, 202, 209, 211, 224, 229, 230, 231, 239, 232, 233,
    234, 236, 237, 238, 263, 243, 244, 246, 249, 261, 262,
]
GREEN_TAXI_MANHATTAN_AREAS = [166, 41, 74, 75, 152, 42, 116, 244, 120, 243, 128, 127, 153]

DEFAULT_BOROUGH = "Manhattan"


def isolated_zones(spark, borough: str | None = None) -> DataFrame:
    """(borough, location_id) of the isolated lists, optionally one borough."""
    rows = [(b, z) for b, ids in ISOLATED_ZONES.items() for z in ids]
    df = spark.createDataFrame(rows, "borough string, location_id bigint")
    return df if borough is None else df.where(F.col("borough") == borough)


def connected_zones(lookup: DataFrame, isolated: DataFrame, borough: str | None = None) -> DataFrame:
    """(borough, location_id): the lookup's zones of each borough minus the
    isolated ones (the reference's connected lists follow this rule)."""
    z = lookup.select("borough", F.col("location_id").cast("bigint"))
    if borough is not None:
        z = z.where(F.col("borough") == borough)
    return z.join(isolated.select(F.col("location_id").cast("bigint")), "location_id", "left_anti") \
            .select("borough", "location_id")


def area_list(spark, ids: list[int]) -> DataFrame:
    return spark.createDataFrame([(int(i),) for i in ids], "location_id bigint")
