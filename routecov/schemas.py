"""Declared schemas of every table the library reads or produces."""

from __future__ import annotations

from pyspark.sql import types as T

LONG = T.LongType()
INT = T.IntegerType()
DOUBLE = T.DoubleType()
STRING = T.StringType()
# Trip times are local wall-clock times without a zone: TIMESTAMP_NTZ keeps
# them independent of the session time zone.
TS = T.TimestampNTZType()

# Clean, unified trips (one row per trip).
TRIP = T.StructType([
    T.StructField("tlc_type", STRING),
    T.StructField("pu_datetime", TS),
    T.StructField("do_datetime", TS),
    T.StructField("pu_location_id", LONG),
    T.StructField("do_location_id", LONG),
])

# Trip frequency per ordered (pick-up, drop-off) pair.
TRIP_FREQUENCY = T.StructType([
    T.StructField("pu_location_id", LONG),
    T.StructField("do_location_id", LONG),
    T.StructField("frequency", LONG),
])

# Raw zone polygons (CSV with WKT text).
RAW_ZONE = T.StructType([
    T.StructField("the_geom", STRING),
    T.StructField("LocationID", INT),
    T.StructField("borough", STRING),
])

POINT = T.StructType([T.StructField("x", DOUBLE), T.StructField("y", DOUBLE)])

# Parsed zone boundaries: sub-regions sorted by point count, largest first.
ZONE_BOUNDARY = T.StructType([
    T.StructField("borough", STRING),
    T.StructField("location_id", LONG),
    T.StructField("boundary", T.ArrayType(T.ArrayType(POINT))),
])

ZONE_CENTROID = T.StructType([
    T.StructField("location_id", LONG),
    T.StructField("avg_lat", DOUBLE),
    T.StructField("avg_lon", DOUBLE),
])

RAW_ZONE_LOOKUP = T.StructType([
    T.StructField("LocationID", INT),
    T.StructField("Borough", STRING),
    T.StructField("Zone", STRING),
    T.StructField("service_zone", STRING),
])

ZONE_LOOKUP = T.StructType([
    T.StructField("location_id", LONG),
    T.StructField("zone", STRING),
    T.StructField("borough", STRING),
])

# Weighted neighbour relation = edge table of the zone graph (metres).
NEIGHBOR_DISTANCE = T.StructType([
    T.StructField("location_id", LONG),
    T.StructField("neighbor_location_id", LONG),
    T.StructField("distance", INT),
])

EDGE = T.StructType([
    T.StructField("src", LONG),
    T.StructField("dst", LONG),
    T.StructField("weight", LONG),
])

NODE = T.StructType([T.StructField("node", LONG)])

PATH = T.ArrayType(LONG)

PATH_FREQUENCY = T.StructType([
    T.StructField("trip_path", PATH),
    T.StructField("frequency", LONG),
])

PATH_COVERAGE = T.StructType([
    T.StructField("trip_path", PATH),
    T.StructField("coverage_count", LONG),
])

# Raw trip column names per provider, in the order
# (pick-up time, drop-off time, pick-up zone, drop-off zone).
PROVIDER_COLUMNS = {
    "fhv": ("pickup_datetime", "dropOff_datetime", "PUlocationID", "DOlocationID"),
    "fhvhv": ("pickup_datetime", "dropoff_datetime", "PULocationID", "DOLocationID"),
    "green": ("lpep_pickup_datetime", "lpep_dropoff_datetime", "PUlocationID", "DOlocationID"),
    "yellow": ("tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID"),
}

UNIFIED_TRIP_COLUMNS = ("pu_datetime", "do_datetime", "pu_location_id", "do_location_id")
