"""Geospatial column expressions (JVM-side, codegen-friendly; no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: equatorial radius of the WGS84 ellipsoid, metres.
EARTH_RADIUS_M = 6378137.0

_MULTIPOLYGON = r"^MULTIPOLYGON \(\(\((.*)\)\)\)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def haversine_m(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in whole metres (truncated toward zero, as an int)."""
    lat1, lon1, lat2, lon2 = map(_c, (lat1, lon1, lat2, lon2))
    dlat = F.radians(lat2 - lat1)
    dlon = F.radians(lon2 - lon1)
    a = (F.sin(dlat / 2) * F.sin(dlat / 2)
         + F.sin(dlon / 2) * F.sin(dlon / 2) * F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)))
    c = 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))
    return (F.lit(EARTH_RADIUS_M) * c).cast("int")


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Distance in kilometres derived from the truncated metre value."""
    return haversine_m(lat1, lon1, lat2, lon2) / 1000.0


def multipolygon_body(geom) -> Column:
    """Text between the outer ``MULTIPOLYGON (((`` and ``)))``; '' if malformed."""
    return F.regexp_extract(_c(geom), _MULTIPOLYGON, 1)


def _point(pt: Column) -> Column:
    xy = F.split(F.trim(pt), " ")
    return F.struct(F.get(xy, 0).try_cast("double").alias("x"),
                    F.get(xy, 1).try_cast("double").alias("y"))


def parse_multipolygon(geom) -> Column:
    """WKT MULTIPOLYGON text -> array<array<struct<x,y>>>: one outer ring per
    polygon, polygons sorted by vertex count descending (stable sort, so equal
    sizes keep text order).

    Inner rings (holes, ``), (``) are dropped; a coordinate that does not parse
    becomes NULL and ``boundary_is_valid`` turns false.
    """
    body = multipolygon_body(geom)
    polygons = F.split(body, r"\)\), \(\(")
    outer = F.transform(polygons, lambda p: F.split(p, r"\), \(")[0])
    rings = F.transform(outer, lambda r: F.transform(F.split(r, ", "), _point))
    return F.array_sort(rings, lambda left, right: F.size(right) - F.size(left))


def boundary_is_valid(boundary) -> Column:
    """True when every vertex has both coordinates."""
    b = _c(boundary)
    return ~F.exists(b, lambda ring: F.exists(ring, lambda p: p.x.isNull() | p.y.isNull()))


def ring_mean(ring, axis: str) -> Column:
    """Mean of one coordinate over a ring's vertices (closing vertex included)."""
    r = _c(ring)
    total = F.aggregate(r, F.lit(0.0), lambda s, p: s + p[axis])
    return total / F.size(r)
