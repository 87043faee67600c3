"""Views of the driver's tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import causal
from ..sources.files import read_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet")


#: Zones are event types, numbered by name.
TYPES = ["click", "error", "purchase", "signup", "view"]


def zone_of(column: str = "event_type"):
    out = F.lit(None).cast("int")
    for i, t in enumerate(TYPES, 1):
        out = F.when(F.col(column) == t, i).otherwise(out)
    return out


def events(spark, d) -> DataFrame:
    return table(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value", "props", F.to_date("ts").alias("date"), zone_of().alias("zone_id"))


def panel(spark, d) -> DataFrame:
    return events(spark, d).groupBy("date", "zone_id").agg(F.avg("value").alias("value"))


def gappy(spark, d) -> DataFrame:
    missing = (F.dayofmonth("date") * 7 + F.col("zone_id") * 3) % 5 == 0
    return panel(spark, d).withColumn("value", F.when(~missing, F.col("value")))


def hourly(spark, d) -> DataFrame:
    return events(spark, d).groupBy("zone_id", F.date_trunc("hour", "ts").alias("hour")).agg(F.floor(F.avg("value") / 20).cast("double").alias("value"))


def sensor_day(spark, d) -> DataFrame:
    e = events(spark, d).withColumn("sensor", (F.col("user_id") % 12).cast("int"))
    return e.groupBy("sensor", "date").agg(F.avg(F.col("value") * (1 + F.col("sensor") % 4)).alias("value"))


def runs(spark, d) -> DataFrame:
    """Forecast runs (init, lead, target, zone_id, v): some values missing, some runs missing whole."""
    p = panel(spark, d).select(F.col("date").alias("target"), "zone_id", F.col("value").alias("v"))
    r = p.select("target", "zone_id", "v", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("lead"))
    r = r.withColumn("init", F.date_sub("target", F.col("lead") + 1)).where(F.dayofmonth("init") % 11 != 0)
    missing = (F.dayofmonth("init") * 3 + F.col("zone_id")) % 7 == 0
    return r.select("init", "lead", "target", "zone_id", F.when(~missing, F.col("v") + F.col("lead")).alias("v"))


def prio_day(spark, d) -> DataFrame:
    """Orders by priority on a dense calendar: value and the number of orders, the stand-in for valid area."""
    o = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date"), F.substring("o_orderpriority", 1, 1).cast("int").alias("zone_id"), "o_totalprice")
    o = o.groupBy("date", "zone_id").agg(F.avg("o_totalprice").alias("value"), F.count(F.lit(1)).alias("n"))
    return causal.densify(o).withColumn("valid", F.coalesce(F.col("n") / 4.0, F.lit(0.0)))


def prio_month(spark, d) -> DataFrame:
    """Monthly values by priority on dense months, without those of March to June."""
    o = table(spark, d, "orders").select(F.trunc(F.to_date("o_orderdate"), "MM").alias("month"), F.substring("o_orderpriority", 1, 1).cast("int").alias("zone_id"), "o_totalprice")
    o = o.where(~F.month("month").between(3, 6)).groupBy("month", "zone_id").agg(F.avg("o_totalprice").alias("value"))
    return causal.densify(o, date="month", step="1 month")


def raster(spark, d) -> DataFrame:
    """Embeddings as rasters of 8 x 8 cells; negative cells are missing."""
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("day"), F.posexplode("embedding").alias("i", "x"))
    return e.select("day", F.floor(F.col("i") / 8).cast("int").alias("row"), (F.col("i") % 8).alias("col"), F.when(F.col("x") >= 0, F.col("x").cast("double")).alias("v"))


def weights(spark) -> DataFrame:
    """Two zones of an 8 x 8 grid, left and right, that share columns 3 and 4; the last row is outside."""
    cells = spark.range(56).select(F.floor(F.col("id") / 8).cast("int").alias("row"), (F.col("id") % 8).cast("int").alias("col"))
    left = F.when(F.col("col") < 3, 1.0).when(F.col("col") < 5, 0.5).otherwise(0.0)
    return cells.select("row", "col", F.explode(F.array(F.struct(F.lit(1).alias("zone"), left.alias("w")), F.struct(F.lit(2).alias("zone"), (1.0 - left).alias("w")))).alias("z")).select("z.zone", "row", "col", "z.w")


def points(spark, d) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("id"), ((k * 7919 % 1000) / 10.0).alias("x"), ((k * 104729 % 1009) / 10.0).alias("y"))


#: Convex zones in [0, 100] squared: two share an edge, one is apart, one far away.
ZONES = {1: [(10, 10), (40, 10), (40, 40), (10, 40)], 2: [(40, 10), (70, 15), (60, 45), (40, 40)], 3: [(20, 60), (50, 60), (35, 90)], 4: [(300, 300), (310, 300), (305, 320)]}


def zones(spark) -> DataFrame:
    rows = [(k, [(float(x), float(y)) for x, y in ring]) for k, ring in ZONES.items()]
    return spark.createDataFrame(rows, "zone_id int, ring array<struct<x: double, y: double>>")


def forecasts(spark, d) -> DataFrame:
    """Truth and three forecasts of the panel for horizons 0 to 2."""
    p = causal.trailing(causal.lags(panel(spark, d), "value", (1,)), "value", (3, 7), std=False)
    p = p.select("date", "zone_id", F.col("value").alias("truth"), F.col("value_lag1").alias("persistence"), F.col("value_roll3_mean").alias("roll3"), F.col("value_roll7_mean").alias("roll7"))
    return p.select("*", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("horizon")).withColumn("truth", F.col("truth") + F.col("horizon"))
