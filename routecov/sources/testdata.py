"""Reference-shaped input tables derived from the driver's test tables.

The reference reads taxi trips, zone polygons, zone names and a neighbour
relation.  The test tables are a TPC-H-like star schema, so each reference
input is defined here as a Spark plan over them (see FIXTURES.md §3).  The
trip views grow with the scale factor; the zone views (25 nations) are
dimension-sized, like the reference's ~265 zones.

All builders are lazy: nothing is collected, Catalyst prunes columns and
pushes filters into the Parquet scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixture parameters (documented in FIXTURES.md §3).
EDGE_OFFSETS = (1, 5, 20, 24)   # zone n neighbours (n + k) mod ring size
RING_SIZE = 25                  # number of zones (nations)
ISOLATED_MOD, ISOLATED_REM = 11, 3
LAT0, LON0 = 40.0, -73.0
MICRO = 1_000_000               # WKT coordinates in micro-degrees (exact sums)


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one test table.  Its schema is inferred once per path and then
    declared, so later reads skip the footer-inference pass."""
    path = f"{sf_dir}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        schema = _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(schema).parquet(path)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: (location_id, zone, borough). Zone text is 'name/region'."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").cast("bigint").alias("location_id"),
                    F.concat_ws("/", "n_name", "r_name").alias("zone"),
                    F.col("r_name").alias("borough")))


def raw_zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup in the raw CSV shape (LocationID, Borough, Zone, service_zone)."""
    z = zones(spark, sf_dir)
    return z.select(F.col("location_id").cast("int").alias("LocationID"),
                    F.col("borough").alias("Borough"),
                    F.col("zone").alias("Zone"),
                    F.lit("Boro Zone").alias("service_zone"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean trips: one row per line item; pick-up zone = supplier nation,
    drop-off zone = customer nation."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    su = table(spark, sf_dir, "supplier")
    cu = table(spark, sf_dir, "customer")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .join(su, li.l_suppkey == su.s_suppkey)
            .join(cu, od.o_custkey == cu.c_custkey)
            .select(F.col("l_returnflag").alias("tlc_type"),
                    F.col("o_orderdate").alias("pu_datetime"),
                    F.col("l_shipdate").alias("do_datetime"),
                    F.col("s_nationkey").cast("bigint").alias("pu_location_id"),
                    F.col("c_nationkey").cast("bigint").alias("do_location_id")))


def metered_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw metered trips in the yellow-taxi shape, tagged with a source file.

    The file month comes from the ship date while the pick-up time is the
    order date, so the month-matches-file rule has real mismatches.
    """
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    su = table(spark, sf_dir, "supplier")
    cu = table(spark, sf_dir, "customer")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .join(su, li.l_suppkey == su.s_suppkey)
            .join(cu, od.o_custkey == cu.c_custkey)
            .select(F.col("o_orderdate").alias("tpep_pickup_datetime"),
                    F.col("l_shipdate").alias("tpep_dropoff_datetime"),
                    F.col("s_nationkey").alias("PULocationID"),
                    F.col("c_nationkey").alias("DOLocationID"),
                    F.col("l_quantity").alias("passenger_count"),
                    F.col("l_discount").alias("fare_amount"),
                    F.col("l_extendedprice").alias("total_amount"),
                    F.col("l_linenumber").cast("bigint").alias("payment_type"),
                    (F.col("o_custkey") % 7).alias("RatecodeID"),
                    F.concat(F.lit("/trips/yellow_tripdata_"),
                             F.date_format("l_shipdate", "yyyy-MM"),
                             F.lit(".parquet")).alias("file_path")))


def green_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metered trips in the green-taxi shape."""
    return (metered_trips(spark, sf_dir)
            .withColumnsRenamed({"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime",
                                 "PULocationID": "PUlocationID", "DOLocationID": "DOlocationID"})
            .withColumn("file_path", F.replace("file_path", F.lit("yellow"), F.lit("green"))))


def isolated_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones without neighbours in the fixture: n_nationkey % 11 = 3."""
    return (table(spark, sf_dir, "nation")
            .where(F.col("n_nationkey") % ISOLATED_MOD == ISOLATED_REM)
            .select(F.col("n_nationkey").cast("bigint").alias("location_id")))


def centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone centroids (location_id, avg_lat, avg_lon) from the embedding of
    the zone's id."""
    nation = table(spark, sf_dir, "nation")
    emb = table(spark, sf_dir, "embeddings")
    return (nation.join(emb, emb.vec_id == nation.n_nationkey)
            .select(F.col("n_nationkey").cast("bigint").alias("location_id"),
                    (F.lit(LAT0) + F.col("embedding")[0].cast("double")).alias("avg_lat"),
                    (F.lit(LON0) + F.col("embedding")[1].cast("double")).alias("avg_lon")))


def neighbor_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed neighbour relation (location_id, neighbor_location_id):
    zone n touches (n + k) mod 25 for k in EDGE_OFFSETS (symmetric)."""
    nation = table(spark, sf_dir, "nation")
    offsets = F.array(*[F.lit(k) for k in EDGE_OFFSETS])
    return (nation
            .select(F.col("n_nationkey").cast("bigint").alias("location_id"),
                    F.explode(offsets).alias("k"))
            .select("location_id",
                    ((F.col("location_id") + F.col("k")) % RING_SIZE)
                    .alias("neighbor_location_id")))


def _coord(emb: Column, idx: Column, offset: int) -> Column:
    return (F.floor(F.get(emb, idx.cast("int")).cast("double") * MICRO)
            + F.lit(offset * MICRO)).cast("bigint")


def raw_zone_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw zone polygons in the CSV shape (the_geom, LocationID, borough).

    One zone per embedding row; ``label % 3 + 1`` sub-regions; sub-region j
    has ``3 + (vec_id + j) % 4`` vertices plus the closing vertex, taken from
    embedding values 20*j onwards.  Coordinates are integers (micro-degrees),
    so means are exact in any summation order.
    """
    emb = table(spark, sf_dir, "embeddings")
    region = table(spark, sf_dir, "region")
    e = F.col("embedding")

    def ring(j: Column) -> Column:
        n = F.lit(3) + (F.col("vec_id") + j) % 4
        return F.array_join(
            F.transform(
                F.sequence(F.lit(0), n),
                lambda t: F.concat_ws(
                    " ",
                    _coord(e, j * 20 + (t % n) * 2, int(LON0)).cast("string"),
                    _coord(e, j * 20 + (t % n) * 2 + 1, int(LAT0)).cast("string"))),
            ", ")

    subregions = F.transform(F.sequence(F.lit(0), F.col("label") % 3), ring)
    geom = F.concat(F.lit("MULTIPOLYGON ((("), F.array_join(subregions, ")), (("), F.lit(")))"))
    return (emb.join(region, (emb.vec_id % 5) == region.r_regionkey)
            .select(geom.alias("the_geom"),
                    F.col("vec_id").cast("int").alias("LocationID"),
                    F.col("r_name").alias("borough")))


GRID_WIDTH = 25                 # cells in a row of the grid of zones
HUB_MOD = 3                     # every third zone also touches one common point


def grid_zone_polygons(spark: SparkSession, sf_dir: str, width: int = GRID_WIDTH) -> DataFrame:
    """Raw zone polygons on a grid (the_geom, LocationID, borough), one for each
    embedding row: zone n is the unit square at cell (n % width, n / width), so
    side neighbours share two corners, diagonal ones one, and inner corners
    belong to four zones.  Every third zone has a second sub-region, a triangle
    of two points of its own and one point that all these zones share."""
    emb = table(spark, sf_dir, "embeddings")
    region = table(spark, sf_dir, "region")
    x, y = F.col("vec_id") % width, F.expr(f"vec_id div {width}")

    def ring(points) -> Column:
        return F.concat_ws(", ", *[F.concat_ws(" ", cx.cast("string"), cy.cast("string")) for cx, cy in points])

    square = ring([(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)])
    hub, far = (F.lit(-9), F.lit(-9)), -100 - F.col("vec_id")
    triangle = ring([hub, (far, F.lit(-100)), (far, F.lit(-101)), hub])
    body = F.when(F.col("vec_id") % HUB_MOD == 0, F.concat(square, F.lit(")), (("), triangle)).otherwise(square)
    return (emb.join(region, (emb.vec_id % 5) == region.r_regionkey)
            .select(F.concat(F.lit("MULTIPOLYGON ((("), body, F.lit(")))")).alias("the_geom"),
                    F.col("vec_id").cast("int").alias("LocationID"), F.col("r_name").alias("borough")))


def outlier_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A numeric column with outliers: events.value."""
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value")


__all__ = [
    "EDGE_OFFSETS", "RING_SIZE", "ISOLATED_MOD", "ISOLATED_REM", "table", "zones",
    "raw_zone_lookup", "trips", "metered_trips", "isolated_zones", "centroids",
    "neighbor_pairs", "raw_zone_polygons", "outlier_values",
]
