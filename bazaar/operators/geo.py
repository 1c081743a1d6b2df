"""Geo radius search (D1): points within a radius of a centre, nearest first.

A lat/lon bounding box is applied first. It is a plain range predicate on the coordinate columns,
so it reaches the Parquet reader (min/max pruning) and drops most rows before any trigonometry.
The exact great-circle (haversine) distance is then computed with built-in functions only.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

C = F.col

# Fixed value: the sphere radius used for spherical geo queries (metres, equatorial).
EARTH_RADIUS_M = 6378100.0


def haversine_m(lon1, lat1, lon2, lat2, radius: float = EARTH_RADIUS_M) -> Column:
    """Great-circle distance in metres between (lon1, lat1) and (lon2, lat2) in degrees."""
    def c(x):
        return x if isinstance(x, Column) else F.lit(float(x))
    p1, p2 = F.radians(c(lat1)), F.radians(c(lat2))
    dp, dl = p2 - p1, F.radians(c(lon2) - c(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2.0 * radius) * F.asin(F.sqrt(a))


def bounding_box(lon: float, lat: float, radius_m: float, radius: float = EARTH_RADIUS_M):
    """([(min_lon, max_lon), ...], min_lat, max_lat) enclosing the circle on the sphere.

    One longitude range, two if the circle crosses the date line (+-180 degrees), and all longitudes if it
    holds a pole."""
    angle = radius_m / radius
    lo, hi = lat - math.degrees(angle), lat + math.degrees(angle)
    if lo <= -90 or hi >= 90 or angle >= math.pi / 2:
        return [(-180.0, 180.0)], max(lo, -90.0), min(hi, 90.0)
    # the meridians that touch the circle; a little wider, against rounding
    dlon = math.degrees(math.asin(min(1.0, math.sin(angle) / math.cos(math.radians(lat))))) + 1e-9
    if lon - dlon < -180:
        return [(-180.0, lon + dlon), (lon - dlon + 360, 180.0)], lo, hi
    if lon + dlon > 180:
        return [(lon - dlon, 180.0), (-180.0, lon + dlon - 360)], lo, hi
    return [(lon - dlon, lon + dlon)], lo, hi


def within_radius(points: DataFrame, lon: float, lat: float, max_distance_m: float, lon_col: str = "lon",
                  lat_col: str = "lat", query: Column | None = None) -> DataFrame:
    """$geoNear: rows within ``max_distance_m`` of (lon, lat) with ``distance_meters``, nearest first.
    ``query`` is the extra document filter (e.g. pickup_available)."""
    ranges, lo_y, hi_y = bounding_box(lon, lat, max_distance_m)
    inside = reduce(or_, [C(lon_col).between(a, b) for a, b in ranges])
    box = inside & C(lat_col).between(lo_y - 1e-9, hi_y + 1e-9)
    df = points.filter(box if query is None else (box & query))
    d = haversine_m(C(lon_col), C(lat_col), lon, lat)
    return (df.withColumn("distance_meters", d).filter(C("distance_meters") <= max_distance_m)
            .orderBy("distance_meters"))
