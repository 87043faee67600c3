"""Points and polygons. A zone is (zone_id, ring ARRAY<STRUCT<x, y>>), the ring not closed.

Joins go through a grid: a zone is listed under every grid cell that its bounding box (widened by the snapping distance) touches, a
point looks only at its own cell.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def edges(ring: Column) -> Column:
    after = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda a, b: F.struct(a.x.alias("x1"), a.y.alias("y1"), b.x.alias("x2"), b.y.alias("y2")))


def contains(edges_: Column, x: Column, y: Column) -> Column:
    """By the number of edges to the right of the point. The product comes before the division: rounding decides for points on an edge."""
    crossing = F.filter(edges_, lambda e: ((e.y1 > y) != (e.y2 > y)) & (x < F.try_divide((e.x2 - e.x1) * (y - e.y1), e.y2 - e.y1) + e.x1))
    return F.size(crossing) % 2 == 1


def distance(edges_: Column, x: Column, y: Column) -> Column:
    """To the nearest edge."""

    def to_edge(e: Column) -> Column:
        dx, dy = e.x2 - e.x1, e.y2 - e.y1
        t = F.coalesce(F.try_divide((x - e.x1) * dx + (y - e.y1) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.least(F.greatest(t, F.lit(0.0)), F.lit(1.0))
        return F.hypot(x - (e.x1 + t * dx), y - (e.y1 + t * dy))

    return F.array_min(F.transform(edges_, to_edge))


def area(ring: Column) -> Column:
    e = edges(ring)
    return F.abs(F.aggregate(e, F.lit(0.0), lambda s, x: s + x.x1 * x.y2 - x.x2 * x.y1)) / 2


def centroid(ring: Column) -> tuple[Column, Column]:
    e = edges(ring)
    twice = F.aggregate(e, F.lit(0.0), lambda s, x: s + x.x1 * x.y2 - x.x2 * x.y1)
    cx = F.aggregate(e, F.lit(0.0), lambda s, x: s + (x.x1 + x.x2) * (x.x1 * x.y2 - x.x2 * x.y1))
    cy = F.aggregate(e, F.lit(0.0), lambda s, x: s + (x.y1 + x.y2) * (x.x1 * x.y2 - x.x2 * x.y1))
    return F.try_divide(cx, 3 * twice), F.try_divide(cy, 3 * twice)


def bounds(ring: Column) -> dict[str, Column]:
    xs, ys = F.transform(ring, lambda p: p.x), F.transform(ring, lambda p: p.y)
    return {"x_min": F.array_min(xs), "x_max": F.array_max(xs), "y_min": F.array_min(ys), "y_max": F.array_max(ys)}


#: Grid cells under all zones' bounding boxes together, about.
CELLS = 100_000


def _cell_size(zones: DataFrame, most: float) -> float:
    """The width of a grid cell at which the zones' widened bounding boxes cover about ``CELLS`` cells, whatever their units."""
    b = bounds(F.col("ring"))
    widths = [b[f"{k}_max"] - b[f"{k}_min"] + 2 * most for k in ("x", "y")]
    one = zones.agg(F.sum(widths[0] * widths[1]).alias("area"), F.max(F.greatest(*widths)).alias("widest")).first()
    return max(math.sqrt((one.area or 0.0) / CELLS), (one.widest or 1.0) / 1000, 1e-9)


def locate(points: DataFrame, zones: DataFrame, most: float = 0.0, cell: float | None = None) -> DataFrame:
    """Points (id, x, y) with zone_id, outside (0 within a zone) and snapped: the containing zone of smallest id, else the nearest
    zone (of equals the smallest id) at most ``most`` away, else NULL. ``cell``: the width of a grid cell, from the zones' extents if not given."""
    cell = cell or _cell_size(zones, most)

    def at(c: Column) -> Column:
        return F.floor(c / cell).cast("bigint")

    z = zones.select("zone_id", edges(F.col("ring")).alias("edges"), *(c.alias(k) for k, c in bounds(F.col("ring")).items()))
    z = z.withColumn("gx", F.explode(F.sequence(at(F.col("x_min") - most), at(F.col("x_max") + most)))).withColumn("gy", F.explode(F.sequence(at(F.col("y_min") - most), at(F.col("y_max") + most))))
    p = points.withColumns({"gx": at(F.col("x")), "gy": at(F.col("y"))})
    j = p.join(z.select("zone_id", "edges", "gx", "gy"), ["gx", "gy"])
    j = j.withColumn("inside", contains(F.col("edges"), F.col("x"), F.col("y")))
    j = j.withColumn("d", F.when(F.col("inside"), 0.0).otherwise(distance(F.col("edges"), F.col("x"), F.col("y")))).where(F.col("inside") | (F.col("d") <= most) if most else F.col("inside"))
    best = j.groupBy("id").agg(F.min(F.struct((~F.col("inside")).alias("out"), "d", "zone_id")).alias("best"))
    found = best.select("id", "best.zone_id", F.col("best.d").alias("outside"), F.col("best.out").alias("snapped"))
    return points.join(found, "id", "left")


def rasterise(rows: int, cols: int, zones: DataFrame) -> DataFrame:
    """(row, col, zone_id) of the cells whose centre lies in a zone, in units of cells."""
    spark = zones.sparkSession
    cells = spark.range(rows).select(F.col("id").cast("int").alias("row"), F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("col"))
    cells = cells.select((F.col("row") * cols + F.col("col")).alias("id"), "row", "col", (F.col("col") + 0.5).alias("x"), (F.col("row") + 0.5).alias("y"))
    return locate(cells, zones).where("zone_id is not null").select("row", "col", "zone_id")


def snapped_extent(low: float, high: float, step: float, buffer: float) -> tuple[float, float]:
    """An interval widened by a buffer and then outward to whole steps."""
    return math.floor((low - buffer) / step) * step, math.ceil((high + buffer) / step) * step
