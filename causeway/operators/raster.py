"""Rasters as long tables of cells (day, row, col, v), zones as sparse weights (zone, row, col, w)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows up to which a table of weights or offsets is sent to all executors; larger ones are joined by a shuffle.
SMALL = 200_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(SMALL + 1).count() <= SMALL else df


def zonal_stats(cells: DataFrame, weights: DataFrame, by: str = "day") -> DataFrame:
    """Weighted mean and population deviation (two passes), extremes, cells and share of the weight with a value."""
    j = cells.join(_small(weights.where("w > 0")), ["row", "col"])
    has = F.col("v").isNotNull()
    sums = j.groupBy(by, "zone").agg(
        F.try_divide(F.sum(F.col("w") * F.col("v")), F.sum(F.when(has, F.col("w")))).alias("mean"), F.min("v").alias("min"), F.max("v").alias("max"),
        F.count("v").alias("n_valid_cells"), F.coalesce(F.try_divide(F.sum(F.when(has, F.col("w"))), F.sum("w")), F.lit(0.0)).alias("valid_fraction"),
    )
    spread = j.join(sums.select(by, "zone", "mean"), [by, "zone"]).groupBy(by, "zone")
    spread = spread.agg(F.sqrt(F.try_divide(F.sum(F.col("w") * F.pow(F.col("v") - F.col("mean"), 2)), F.sum(F.when(has, F.col("w"))))).alias("std"))
    return sums.join(spread, [by, "zone"])


def zonal_series(cells: DataFrame, weights: DataFrame, extra: str | None = None, by: str = "day") -> DataFrame:
    """Weighted mean and deviation in one pass (mean of squares less square of the mean, not below 0), with an extra weight of cells."""
    w = F.col("w") * F.coalesce(F.col(extra), F.lit(0.0)) if extra else F.col("w")
    j = cells.join(_small(weights.where("w > 0")), ["row", "col"]).withColumn("w", w)
    weight = F.sum(F.when(F.col("v").isNotNull(), F.col("w")))
    mean = F.try_divide(F.sum(F.col("w") * F.col("v")), weight)
    square = F.try_divide(F.sum(F.col("w") * F.col("v") * F.col("v")), weight)
    out = j.groupBy(by, "zone").agg(mean.alias("mean"), square.alias("sq"), F.coalesce(F.try_divide(weight, F.sum("w")), F.lit(0.0)).alias("valid_fraction"))
    return out.withColumn("std", F.when(F.col("mean").isNotNull(), F.sqrt(F.greatest(F.col("sq") - F.col("mean") * F.col("mean"), F.lit(0.0))))).drop("sq")


def flag_fractions(cells: DataFrame, weights: DataFrame, flags: dict[str, int], by: str = "day") -> DataFrame:
    """Share of each zone's weight whose cells have each flag."""
    j = cells.join(_small(weights.where("w > 0")), ["row", "col"])
    return j.groupBy(by, "zone").agg(*(F.try_divide(F.sum(F.when(F.col("flag") == k, F.col("w")).otherwise(0.0)), F.sum("w")).alias(name) for name, k in flags.items()))


def block_mean(cells: DataFrame, size: int, by: str = "day") -> DataFrame:
    """Mean of the values in blocks of size x size cells."""
    return cells.groupBy(by, F.floor(F.col("row") / size).cast("int").alias("row"), F.floor(F.col("col") / size).cast("int").alias("col")).agg(F.avg("v").alias("v"))


def majority_zone(weights: DataFrame, least: float = 0.5) -> DataFrame:
    """Per cell the zone that covers most of it (the smaller of equals), 0 unless more than ``least``."""
    best = weights.groupBy("row", "col").agg(F.max(F.struct("w", (-F.col("zone")).alias("z"))).alias("best"))
    return best.select("row", "col", F.when(F.col("best.w") > least, -F.col("best.z")).otherwise(0).alias("zone"))


def offsets(spark, radius: float, resolution: float = 1.0) -> DataFrame:
    """(dr, dc, d2) of the cells nearer than ``radius``; as many as fit the radius, whatever the data."""
    r = int(radius / resolution) + 1
    span = spark.range(-r, r + 1).select(F.col("id").cast("int").alias("dr"))
    grid = span.select("dr", F.explode(F.sequence(F.lit(-r), F.lit(r))).alias("dc"))
    grid = grid.withColumn("d2", (F.pow("dr", F.lit(2)) + F.pow("dc", F.lit(2))) * resolution * resolution)
    return grid.where((F.col("d2") > 0) & (F.col("d2") < radius * radius))


def idw_fill(cells: DataFrame, radius: float, resolution: float = 1.0, k: int = 8, least: int = 3, power: float = 2.0, by: str = "day") -> DataFrame:
    """Inverse-distance means of the k nearest donors (ties by row, then column) for empty cells, on days with enough values.

    An empty cell looks for donors at a bounded set of offsets, so the join is by cell, not by all pairs of cells.
    """
    spark = cells.sparkSession
    enough = cells.groupBy(by).agg(F.count("v").alias("n")).where(F.col("n") >= least).select(by)
    holes = cells.where("v is null").join(enough, by, "left_semi").select(by, "row", "col")
    wanted = holes.join(F.broadcast(offsets(spark, radius, resolution)))
    wanted = wanted.select(by, "row", "col", (F.col("row") + F.col("dr")).alias("r"), (F.col("col") + F.col("dc")).alias("c"), "d2")
    donors = cells.where("v is not null").select(by, F.col("row").alias("r"), F.col("col").alias("c"), "v")
    near = wanted.join(donors, [by, "r", "c"])
    near = near.withColumn("nth", F.row_number().over(Window.partitionBy(by, "row", "col").orderBy("d2", "r", "c"))).where(F.col("nth") <= k)
    weight = 1.0 / F.pow(F.greatest(F.sqrt("d2"), F.lit(1e-6)), F.lit(power))
    out = near.groupBy(by, "row", "col").agg(F.count(F.lit(1)).alias("n"), (F.sum(weight * F.col("v")) / F.sum(weight)).alias("idw"))
    return out.where(F.col("n") >= least).drop("n")


def gap_fill(cells: DataFrame, inside: DataFrame, radius: float, window: int = 3, mode: str = "backward", by: str = "day") -> DataFrame:
    """Filled values and flags: 0 seen, 1 from neighbours, 2 median of near days' seen or neighbour-filled values, 3 missing, 9 outside.

    Backward takes days t-window+1 .. t-1; centered the same number around t without t. Days must be dense.
    """
    idw = idw_fill(cells, radius, by=by)
    j = cells.join(idw, [by, "row", "col"], "left").join(_small(inside.select("row", "col").distinct().withColumn("inside", F.lit(True))), ["row", "col"], "left")
    j = j.withColumn("spatial", F.coalesce("v", F.when(F.col("inside"), F.col("idw"))))
    w = Window.partitionBy("row", "col").orderBy(by)
    if mode == "backward":
        past = F.percentile("spatial", 0.5).over(w.rowsBetween(1 - window, -1))
    else:
        half = window // 2
        around = [F.lag("spatial", d).over(w) for d in range(1, half + 1)] + [F.lead("spatial", d).over(w) for d in range(1, half + 1)]
        known = F.sort_array(F.filter(F.array(*around), lambda x: x.isNotNull()))
        n = F.size(known)
        past = F.when(n > 0, (F.element_at(known, F.floor((n + 1) / 2).cast("int")) + F.element_at(known, F.floor((n + 2) / 2).cast("int"))) / 2)
    j = j.withColumn("past", past)
    filled = F.when(F.col("inside"), F.coalesce("spatial", "past")).otherwise(F.col("v"))
    flag = F.when(F.col("inside").isNull(), 9).when(F.col("v").isNotNull(), 0).when(F.col("spatial").isNotNull(), 1).when(F.col("past").isNotNull(), 2).otherwise(3)
    return j.select(by, "row", "col", filled.alias("v"), flag.alias("flag"))


def bilinear(cells: DataFrame, points: DataFrame, by: str = "day") -> DataFrame:
    """Values at points (id, y, x in cell units) from their four corners; NULL outside the grid or next to a missing corner."""
    corners = points.select("id", "y", "x", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    r0, c0 = F.floor("y").cast("int"), F.floor("x").cast("int")
    fy, fx = F.col("y") - F.floor("y"), F.col("x") - F.floor("x")
    dr, dc = F.floor(F.col("k") / 2).cast("int"), F.col("k") % 2
    corners = corners.select("id", (r0 + dr).alias("row"), (c0 + dc).alias("col"), (F.when(dr == 1, fy).otherwise(1 - fy) * F.when(dc == 1, fx).otherwise(1 - fx)).alias("share"))
    need = corners.where("share > 0").groupBy("id").agg(F.count(F.lit(1)).alias("need"))
    days = cells.select(by).distinct()
    j = cells.join(_small(corners.where("share > 0")), ["row", "col"]).groupBy(by, "id").agg(F.sum(F.col("share") * F.col("v")).alias("value"), F.count("v").alias("have"))
    out = days.join(_small(need)).join(j, [by, "id"], "left")
    return out.select(by, "id", F.when(F.col("have") == F.col("need"), F.col("value")).alias("value"))


def cell_centres(cells: DataFrame, x0: float, y_top: float, step: float) -> DataFrame:
    """Coordinates of the middle of each cell of a north-up grid."""
    return cells.withColumns({"x": x0 + (F.col("col") + 0.5) * step, "y": y_top - (F.col("row") + 0.5) * step})


def reference_weight(months: DataFrame, first, last, before=None) -> DataFrame:
    """Mean of a percentage over a reference period as a weight in 0 to 1; missing counts as 0. The period must end before ``before``,
    where the data begins that the weights are used on."""
    if before is not None and not last < before:
        raise ValueError("the reference period must end before the data it weighs")
    return months.where(F.col("month").between(first, last)).groupBy("row", "col").agg(F.coalesce(F.avg("v") / 100, F.lit(0.0)).alias("weight"))


def median_composite(cells: DataFrame, values: list[str], indicator: str, clear: str, by: str = "month") -> DataFrame:
    """Per month and cell the medians of the clear values, the share of an indicator in per cent, and the number of clear looks."""
    medians = [F.median(F.when(F.col(clear) == 1, F.col(v))).alias(v) for v in values]
    share = (100 * F.avg(F.col(indicator).cast("int"))).alias(f"{indicator}_pct")
    return cells.groupBy(by, "row", "col").agg(*medians, share, F.sum(F.col(clear).cast("bigint")).alias("clear_obs"))


def regrid(cells: DataFrame, rows: int, cols: int, scale: float, row0: float = 0.0, col0: float = 0.0, method: str = "average", by: str = "day") -> DataFrame:
    """A raster on another grid of the same projection, whose cells are ``scale`` source cells wide and begin at (row0, col0).

    ``nearest``: the source cell that holds the target cell's centre. ``bilinear``: from the four source cells around that centre, NULL next
    to a missing one. ``average``: the mean of the source cells whose centres lie in the target cell, missing ones left out.
    """
    spark = cells.sparkSession
    if method == "average":
        row, col = (F.floor((F.col(c) + 0.5 - o) / scale).cast("int") for c, o in (("row", row0), ("col", col0)))
        out = cells.withColumns({"r": row, "c": col}).where(F.col("r").between(0, rows - 1) & F.col("c").between(0, cols - 1))
        return out.groupBy(by, F.col("r").alias("row"), F.col("c").alias("col")).agg(F.avg("v").alias("v"))
    target = spark.range(rows).select(F.col("id").cast("int").alias("r"), F.explode(F.sequence(F.lit(0), F.lit(cols - 1))).alias("c"))
    target = target.withColumns({"y": row0 + (F.col("r") + 0.5) * scale, "x": col0 + (F.col("c") + 0.5) * scale})
    if method == "nearest":
        places = target.select("r", "c", F.floor("y").cast("int").alias("row"), F.floor("x").cast("int").alias("col"))
        return cells.join(_small(places), ["row", "col"]).select(by, F.col("r").alias("row"), F.col("c").alias("col"), "v")
    if method != "bilinear":
        raise ValueError(method)
    points = target.select((F.col("r") * cols + F.col("c")).alias("id"), (F.col("y") - 0.5).alias("y"), (F.col("x") - 0.5).alias("x"))
    out = bilinear(cells, points, by)
    return out.select(by, F.floor(F.col("id") / cols).cast("int").alias("row"), (F.col("id") % cols).cast("int").alias("col"), F.col("value").alias("v"))


def area_check(cells: DataFrame, weights: DataFrame, areas: DataFrame, cell_area: float) -> DataFrame:
    """Per zone the area of its cells (row, col, zone_id) against that of its polygon (zone_id, area): difference in per cent; and how many
    weighted cells it touches and fills, and their area."""
    raster_ = cells.groupBy("zone_id").agg((F.count(F.lit(1)) * F.lit(cell_area)).alias("raster_area"))
    touched = weights.groupBy(F.col("zone").alias("zone_id")).agg(F.count_if(F.col("w") > 0).alias("touched"), F.count_if(F.col("w") == 1).alias("full"), F.sum("w").alias("weighted"))
    out = areas.join(raster_, "zone_id", "left").join(touched, "zone_id", "left").withColumn("raster_area", F.coalesce("raster_area", F.lit(0.0)))
    return out.withColumn("diff_pct", 100 * F.try_divide(F.col("raster_area") - F.col("area"), F.col("area")))
