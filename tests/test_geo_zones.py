"""Polygon parsing, centroids, distances."""


from conftest import rows
from routecov.functions.geo import haversine_m
from routecov.operators import zones as zn

A = "0 0, 1 0, 0 0"
B = "5 5, 6 5, 6 6, 5 5"
C = "9 9, 8 9, 8 8, 9 9"


def raw(spark, data):
    return spark.createDataFrame(data, "the_geom string, LocationID int, borough string")


def test_multipolygon_sorted_by_size_stably(spark):
    df = zn.parse_zones(raw(spark, [(f"MULTIPOLYGON ((({A})), (({B})), (({C})))", 7, "Manhattan")]))
    b = df.collect()[0]["boundary"]
    assert [len(r) for r in b] == [4, 4, 3]
    assert (b[0][1]["x"], b[0][1]["y"]) == (6.0, 5.0)  # B kept before C


def test_rejects_bad_rows(spark):
    data = [("POINT (1 2)", 5, "Queens"), (f"MULTIPOLYGON ((({B})))", 0, "Queens"),
            (f"MULTIPOLYGON ((({B})))", 3, "Queens 2"), ("MULTIPOLYGON (((1 x, 2 2)))", 4, "Bronx"),
            (f"MULTIPOLYGON ((({B})))", 6, "Staten Island")]
    r = raw(spark, data)
    assert rows(zn.parse_zones(r).select("location_id")) == [(6,)]
    assert rows(zn.rejected_zones(r).select("LocationID")) == [(0,), (3,), (4,), (5,)]


def test_holes_keep_outer_ring(spark):
    df = zn.parse_zones(raw(spark, [(f"MULTIPOLYGON ((({B}), ({A})))", 2, "Bronx")]))
    assert [len(r) for r in df.collect()[0]["boundary"]] == [4]


def test_centroid_axis_order_and_stats(spark):
    z = zn.parse_zones(raw(spark, [(f"MULTIPOLYGON ((({B})), (({A})))", 2, "Bronx")]))
    xy = zn.zone_centroids(z).collect()[0]
    assert (xy["avg_lon"], xy["avg_lat"]) == ((5 + 6 + 6 + 5) / 4, (5 + 5 + 6 + 5) / 4)
    yx = zn.zone_centroids(z, axis_order="yx").collect()[0]
    assert yx["avg_lat"] == xy["avg_lon"]
    s = zn.boundary_stats(z).collect()[0]
    assert (s["total_coordinate_count"], s["total_sub_region_count"],
            s["max_sub_region_coordinate_count"], s["sub_region_coordinate_counts"]) == (7, 2, 4, "4 3")


def test_haversine(spark):
    df = spark.createDataFrame([(40.75, -73.99, 40.75, -73.99), (40.0, -73.0, 41.0, -73.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_m("a", "b", "c", "d")).collect()]
    assert got[0] == 0
    assert got[1] == 111319  # one degree of latitude on the 6378137 m sphere, truncated


def test_zone_lookup_clean_and_lists(spark):
    raw_l = spark.createDataFrame([(1, "EWR", "Newark Airport", "EWR"), (264, "Unknown", "NV", "N/A"),
                                   (4, "Manhattan", "Alphabet City", "Yellow Zone")],
                                  "LocationID int, Borough string, Zone string, service_zone string")
    clean = zn.clean_zone_lookup(raw_l)
    assert rows(clean, "location_id") == [(1,), (4,)]
    iso = spark.createDataFrame([("EWR", 1)], "borough string, location_id bigint")
    lists = rows(zn.borough_zone_lists(iso, clean))
    assert lists == [("EWR", "1"), ("Manhattan", "")]


def _grid(spark, width, n):
    rows_ = []
    for z in range(1, n + 1):
        x, y = z % width, z // width
        ring = f"{x} {y}, {x+1} {y}, {x+1} {y+1}, {x} {y+1}, {x} {y}"
        rows_.append((f"MULTIPOLYGON ((({ring})))", z, "Grid"))
    return zn.parse_zones(raw(spark, rows_))


def _brute_neighbours(zones_df, k=2):
    pts = {}
    for r in zones_df.collect():
        pts[r["location_id"]] = {(p["x"], p["y"]) for ring in r["boundary"] for p in ring}
    return sorted((a, b) for a in pts for b in pts if a != b and len(pts[a] & pts[b]) >= k)


def test_shared_point_neighbours_normal_and_hot_paths(spark):
    z = _grid(spark, 4, 15)
    for k in (1, 2, 3, 4):
        assert rows(zn.shared_point_neighbours(z, min_shared=k)) == _brute_neighbours(z, k), k


def test_shared_point_neighbours_star_point(spark):
    # ten triangles around one centre point: each shares only the centre with most
    # others and the centre + one rim point with its two rim neighbours
    import math
    data = []
    for i in range(10):
        a0, a1 = 2 * math.pi * i / 10, 2 * math.pi * (i + 1) / 10
        p0 = (round(100 * math.cos(a0)), round(100 * math.sin(a0)))
        p1 = (round(100 * math.cos(a1)), round(100 * math.sin(a1)))
        data.append((f"MULTIPOLYGON (((0 0, {p0[0]} {p0[1]}, {p1[0]} {p1[1]}, 0 0)))", i + 1, "Star"))
    z = zn.parse_zones(raw(spark, data))
    want = _brute_neighbours(z)
    assert len(want) == 20
    assert rows(zn.shared_point_neighbours(z)) == want
    assert rows(zn.shared_point_neighbours(z, min_shared=1)) == _brute_neighbours(z, 1)


def test_shared_point_neighbours_without_ansi(spark):
    from routecov.sources import testdata as td
    from conftest import SF001
    zones = zn.parse_zones(td.grid_zone_polygons(spark, SF001))
    want = sorted(tuple(r) for r in zn.shared_point_neighbours(zones).collect())
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert want and sorted(tuple(r) for r in zn.shared_point_neighbours(zones).collect()) == want
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_point_of_thousands_of_zones_pairs_nobody(spark):
    """One point in every zone: the join over points makes only rows of points that few zones share."""
    n = 3000
    rows_ = [(f"MULTIPOLYGON (((-9 -9, {10 * i} 0, {10 * i} 1, {10 * (i // 2)} 5, {10 * (i // 2)} 6, -9 -9)))", i + 1, "Hub") for i in range(n)]
    z = zn.parse_zones(raw(spark, rows_))
    got = rows(zn.shared_point_neighbours(z, min_shared=3))
    assert got == sorted((a, b) for i in range(0, n, 2) for a, b in ((i + 1, i + 2), (i + 2, i + 1)))
