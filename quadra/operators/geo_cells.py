"""Nearest points for point sets of any size (J8, J9): a grid of cells, searched ring by ring.

The inline way (``functions.geo``) compares every row with every point of a bounded list.  Here points stand in a grid;
a place looks into its own cell and the eight around it.  A point outside that block is at least one cell width away, so
what was found counts as soon as the k-th distance is within that width.  Places that found too little go on to cells
four times as wide, and only those.  Equal coordinates are searched once, whatever the number of rows that have them.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadra.functions.geo import EARTH_RADIUS_KM, haversine
from quadra.session import stored

#: Width of the finest cells in degrees (about 1.1 km), and by how much the next ones are wider.
FINEST, WIDER = 0.01, 4
WHOLE = 1440.0


def _reach(width: float) -> Column:
    """Kilometres that surely lie within the block around a place: to the next parallel, and to the next meridian."""
    across = EARTH_RADIUS_KM * F.asin(F.cos(F.radians("lat")) * F.sin(F.radians(F.lit(min(width, 90.0)))))
    return F.least(F.lit(EARTH_RADIUS_KM) * F.radians(F.lit(width)), across)


def nearest(places: DataFrame, points: DataFrame, k: int = 1, finest: float = FINEST) -> DataFrame:
    """(category, lat, lon, near): for every different (lat, lon) of ``places`` and every category of ``points``, the first k points
    by (distance, ord) as an array of (dist in km, ord, name); fewer only where the category has fewer.

    ``points``: category, ord, name, lat, lon.  Places without a coordinate take no part.
    """
    seats = places.select("lat", "lon").where("lat is not null and lon is not null").distinct()
    held = points.groupBy("category").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("k"))
    todo = stored(seats.crossJoin(F.broadcast(held)), "places")  # a row per category: a handful
    # copies one turn east and west, so that cells need not wrap
    around = points.select("category", "ord", "name", F.col("lat").alias("plat"), F.explode(F.array(F.col("lon") - 360, F.col("lon"), F.col("lon") + 360)).alias("plon"))
    done, width = None, finest
    while True:
        last = width >= WHOLE
        cell = lambda c, w=width: F.floor(F.col(c) / F.lit(w))
        near = F.sequence(F.lit(-1), F.lit(1))
        blocks = around.withColumn("dx", F.explode(near)).withColumn("dy", F.explode(near)).select("category", "ord", "name", "plat", "plon", (cell("plat") + F.col("dx")).alias("cx"), (cell("plon") + F.col("dy")).alias("cy"))
        found = todo.withColumns({"cx": cell("lat"), "cy": cell("lon")}).join(blocks, ["category", "cx", "cy"])
        found = found.withColumn("dist", haversine("lat", "lon", "plat", "plon"))
        # at the widest a point may come from several turns: one of it
        found = found.groupBy("category", "lat", "lon", "k", "ord", "name").agg(F.min("dist").alias("dist")) if width >= 90 else found
        rank = F.row_number().over(Window.partitionBy("category", "lat", "lon").orderBy("dist", "ord"))
        best = found.withColumn("r", rank).where(F.col("r") <= F.col("k")).groupBy("category", "lat", "lon", "k").agg(F.array_sort(F.collect_list(F.struct("dist", "ord", "name"))).alias("near"))
        sure = F.lit(True) if last else (F.size("near") == F.col("k")) & (F.element_at("near", -1)["dist"] <= _reach(width))
        best = stored(best.where(sure), "near")
        done = best if done is None else done.unionByName(best)
        if last:
            break
        todo = stored(todo.join(best.select("category", "lat", "lon"), ["category", "lat", "lon"], "left_anti"), "places")
        if todo.isEmpty():
            break
        width *= WIDER
    return done.select("category", "lat", "lon", "near")
