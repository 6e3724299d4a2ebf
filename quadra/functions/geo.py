"""Geo column functions: haversine and nearest-point search over a bounded POI list.

The POI list is a *bounded dimension*: it travels with the plan, as an array
literal or inside an Arrow function, so the nearest search is a narrow projection
with no shuffle and no join.  ``MAX_INLINE_POIS`` is the checked bound; larger
point sets are rejected rather than silently truncated.
"""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
UNKNOWN_DIST = 999.0      # unknown listing point
EMPTY_CATEGORY_DIST = 99.9
MAX_INLINE_POIS = 10_000
BATCH_CELLS = 100_000     # (row, point) pairs held at once by a task: such arrays stay in the cache
ROUNDING = 1e-12          # far above the rounding of a product of unit vectors
FULL_TURN = 2 * math.pi


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """G1: great-circle km (arcsin form)."""
    la1, lo1, la2, lo2 = (F.radians(_c(x) if not isinstance(x, (int, float)) else F.lit(float(x)))
                          for x in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def poi_array(points: list[tuple[int, str, float, float]]) -> Column:
    """array<struct<ord,name,lat,lon>> literal of one category (one parsed SQL literal, not N calls)."""
    if len(points) > MAX_INLINE_POIS:
        raise ValueError(f"{len(points)} POIs exceed the inline bound {MAX_INLINE_POIS}")
    items = ", ".join(f"named_struct('ord', {int(o)}, 'name', {_sql_str(n)}, 'lat', CAST({float(la)!r} AS DOUBLE), "
                      f"'lon', CAST({float(lo)!r} AS DOUBLE))" for o, n, la, lo in points)
    return F.expr(f"array({items})")


def ranked_distances(lat, lon, points) -> Column:
    """array<struct<dist, ord, name>> for every POI (unrounded km)."""
    la, lo = _c(lat), _c(lon)
    return F.transform(poi_array(points), lambda p: F.struct(
        haversine(la, lo, p["lat"], p["lon"]).alias("dist"), p["ord"].alias("ord"), p["name"].alias("name")))


def nearest_each(lat: Column, lon: Column, categories: dict[str, list]) -> Column:
    """:func:`nearest` of many categories at once: struct<category: struct<a, i>> with the least haversine and its point's place.

    Rows are compared with a category's points by the product of their unit vectors, a batch in one array operation; the haversine
    follows for the best point, and for all points where another one is as good within the products' rounding.  Ties go to the
    first point.  Rows of unknown points, and categories without points, are null.  :func:`nearest_found` reads the result.
    """
    if any(len(points) > MAX_INLINE_POIS for points in categories.values()):
        raise ValueError(f"a category exceeds the inline bound of {MAX_INLINE_POIS} POIs")
    places = [[(math.radians(la), math.radians(lo), math.cos(math.radians(la))) for _, _, la, lo in sorted(points)] for points in categories.values()]
    names = list(categories)
    fields = ", ".join(f"`{c}`: struct<a: double, i: int>" for c in names)

    @F.arrow_udf(f"struct<{fields}>")
    def search(lats: pa.Array, lons: pa.Array) -> pa.Array:
        la, lo = (x.to_numpy(zero_copy_only=False).astype("float64") for x in (lats, lons))
        known = pc.fill_null(pc.and_(pc.is_valid(lats), pc.is_valid(lons)), False).to_numpy(zero_copy_only=False) & (la != 0) & (lo != 0)
        out = []
        with np.errstate(invalid="ignore"):
            la, lo = np.radians(la), np.radians(lo)
            cos = np.cos(la)
            unit = [cos * np.cos(lo), cos * np.sin(lo), np.sin(la)]
            plain = (np.abs(la) <= FULL_TURN) & (np.abs(lo) <= FULL_TURN)  # no NaN, nor so large that differences lose digits
            for points in places:
                a, at = np.zeros(len(la)), np.zeros(len(la), "int64")
                p = np.array(points).reshape(-1, 3)
                spots = [p[:, 2] * np.cos(p[:, 1]), p[:, 2] * np.sin(p[:, 1]), np.sin(p[:, 0])]
                step = max(1, BATCH_CELLS // max(1, len(p)))
                for s in range(0, len(la) if len(p) else 0, step):
                    some = slice(s, s + step)
                    close = sum(u[some, None] * v for u, v in zip(unit, spots))
                    at[some] = close.argmax(axis=1)
                    best = close[np.arange(len(close)), at[some]]
                    alone = plain[some] & ((close >= best[:, None] - ROUNDING).sum(axis=1) == 1)
                    x, y = np.sin((p[at[some], 0] - la[some]) / 2), np.sin((p[at[some], 1] - lo[some]) / 2)
                    a[some] = x * x + cos[some] * p[at[some], 2] * (y * y)
                    rest = s + np.flatnonzero(~alone)
                    x, y = np.sin((p[:, 0] - la[rest, None]) / 2), np.sin((p[:, 1] - lo[rest, None]) / 2)
                    away = x * x + cos[rest, None] * p[:, 2] * (y * y)
                    at[rest] = away.argmin(axis=1)
                    a[rest] = away[np.arange(len(away)), at[rest]]
                none = ~known if len(p) else np.ones(len(la), bool)
                out.append(pa.StructArray.from_arrays([pa.array(a, mask=none), pa.array(at.astype("int32"), mask=none)], ["a", "i"]))
        return pa.StructArray.from_arrays(out, names)

    return search(lat.cast("double"), lon.cast("double"))


def nearest_found(best: Column, points) -> Column:
    """struct<dist(2 dp), name> of one category of :func:`nearest_each`, as :func:`nearest` gives it."""
    if not points:
        return F.struct(F.lit(EMPTY_CATEGORY_DIST).alias("dist"), F.lit("N/A").alias("name"))
    names = F.expr(f"array({', '.join(_sql_str(n) for _, n, _, _ in sorted(points))})")
    dist = F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(best["a"]))
    return F.struct(F.coalesce(F.bround(dist, 2), F.lit(UNKNOWN_DIST)).alias("dist"), F.coalesce(F.get(names, best["i"]), F.lit("N/A")).alias("name"))


def nearest(lat, lon, points) -> Column:
    """struct<dist(2 dp), name> of the nearest POI; first POI wins ties.

    Unknown point (lat or lon 0/NULL) -> (999.0, 'N/A'); empty category -> (99.9, 'N/A').
    """
    if not points:
        return F.struct(F.lit(EMPTY_CATEGORY_DIST).alias("dist"), F.lit("N/A").alias("name"))
    la, lo = _c(lat), _c(lon)
    valid = la.isNotNull() & lo.isNotNull() & (la != 0) & (lo != 0)
    # the array is scanned once; unknown points get an empty candidate list
    best = F.array_min(F.when(valid, ranked_distances(la, lo, points)).otherwise(F.array()))
    return F.struct(F.coalesce(F.bround(best["dist"], 2), F.lit(UNKNOWN_DIST)).alias("dist"),
                    F.coalesce(best["name"], F.lit("N/A")).alias("name"))


def k_nearest(lat, lon, points, k: int) -> Column:
    """First k POIs by (distance, order) as array<struct<dist(2 dp), name>>; none for an unknown point.

    A batch of rows goes against all points in one array operation; equal distances keep the points' order.
    """
    points = sorted(points)
    if len(points) > MAX_INLINE_POIS:
        raise ValueError(f"{len(points)} POIs exceed the inline bound {MAX_INLINE_POIS}")
    if not points:
        return F.expr("CAST(array() AS array<struct<dist: double, name: string>>)")
    p = np.radians(np.array([(la, lo) for _, _, la, lo in points], float))
    most = min(k, len(points))

    @F.arrow_udf("array<struct<a: double, i: int>>")
    def search(lats: pa.Array, lons: pa.Array) -> pa.Array:
        la, lo = (x.to_numpy(zero_copy_only=False).astype("float64") for x in (lats, lons))
        known = pc.fill_null(pc.and_(pc.is_valid(lats), pc.is_valid(lons)), False).to_numpy(zero_copy_only=False) & (la != 0) & (lo != 0)
        rows = np.flatnonzero(known)
        la, lo = np.radians(la[rows]), np.radians(lo[rows])
        a, at = np.zeros((len(rows), most)), np.zeros((len(rows), most), "int32")
        step = max(1, BATCH_CELLS // len(p))
        with np.errstate(invalid="ignore"):
            for s in range(0, len(rows), step):
                some = slice(s, s + step)
                x, y = np.sin((p[:, 0] - la[some, None]) / 2), np.sin((p[:, 1] - lo[some, None]) / 2)
                away = x * x + np.cos(la[some, None]) * np.cos(p[:, 0]) * (y * y)
                at[some] = away.argsort(axis=1, kind="stable")[:, :most]
                a[some] = np.take_along_axis(away, at[some].astype("int64"), axis=1)
        offsets = np.concatenate([[0], np.cumsum(np.where(known, most, 0))]).astype("int32")
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(a.ravel()), pa.array(at.ravel())], ["a", "i"]))

    names = F.expr(f"array({', '.join(_sql_str(n) for _, n, _, _ in points)})")
    dist = lambda f: F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(f["a"]))
    return F.transform(search(_c(lat).cast("double"), _c(lon).cast("double")), lambda f: F.struct(F.bround(dist(f), 2).alias("dist"), F.get(names, f["i"]).alias("name")))
