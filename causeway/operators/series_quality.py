"""Quality control of hourly and daily sensor series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def runs(df: DataFrame, key: str, hour: str, value: str) -> DataFrame:
    """Runs of equal consecutive values: ``run_id``, ``run_length`` and whether the run's hours are contiguous. A null starts a run."""
    w = Window.partitionBy(key).orderBy(hour)
    new = F.coalesce((F.col(value) != F.lag(value).over(w)), F.lit(True)).cast("int")
    df = df.withColumn("run_id", F.sum(new).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    run = Window.partitionBy(key, "run_id")
    seconds = F.unix_timestamp(F.max(hour).over(run).cast("timestamp")) - F.unix_timestamp(F.min(hour).over(run).cast("timestamp"))
    length = F.count(F.lit(1)).over(run)
    return df.withColumn("run_length", length).withColumn("contiguous", (seconds / 3600).cast("bigint") + 1 == F.col("run_length"))


def hour_rules(df: DataFrame, key: str, hour: str, value: str, most: float, flagged: str | None = None, flat: int = 12) -> DataFrame:
    """Hours with each rule they break (flagged, negative, too_high, flat_line) and ``valid``: they break none and have a value."""
    df = runs(df, key, hour, value)
    rules = {
        "flagged": F.coalesce(F.col(flagged), F.lit(False)) if flagged else F.lit(False), "negative": F.coalesce(F.col(value) < 0, F.lit(False)),
        "too_high": F.coalesce(F.col(value) > most, F.lit(False)), "flat_line": F.col(value).isNotNull() & (F.col("run_length") >= flat) & F.col("contiguous"),
    }
    df = df.withColumns(rules)
    return df.withColumn("valid", F.col(value).isNotNull() & ~(F.col("flagged") | F.col("negative") | F.col("too_high") | F.col("flat_line")))


def daily(df: DataFrame, key: list[str], day, value: str, least: int) -> DataFrame:
    """Daily mean and number of valid hours, days with at least ``least`` of them."""
    return df.where("valid").groupBy(*key, day.alias("date")).agg(F.avg(value).alias("value"), F.count(value).alias("n_hours")).where(F.col("n_hours") >= least)


def others_median(df: DataFrame, sensor: str, value: str, by: list[str]) -> DataFrame:
    """Per row, the exact median of the other sensors' values in its group.

    The sorted values of a group are one array per (date, pollutant); leaving one out needs no self-join. The groups are bounded by
    the number of sensors.
    """
    array = F.sort_array(F.collect_list(F.struct(F.col(value).alias("v"), F.col(sensor).alias("s"))))
    all_ = df.where(F.col(value).isNotNull()).groupBy(*by).agg(array.alias("all"))
    rest = F.transform(F.filter("all", lambda x: x.s != F.col(sensor)), lambda x: x.v)
    n = F.size("rest")
    middle = (F.element_at("rest", F.floor((n + 1) / 2).cast("int")) + F.element_at("rest", F.floor((n + 2) / 2).cast("int"))) / 2
    return df.join(all_, by, "left").withColumn("rest", rest).withColumn("others", F.when(n > 0, middle)).drop("all", "rest")


def sensor_ratios(df: DataFrame, sensor: str, value: str, by: list[str], low: float = 0.4, high: float = 2.5, least: int = 20) -> DataFrame:
    """Per sensor: shared days, median ratio to the others, and whether it is excluded (enough days, and the ratio outside or unknown)."""
    rows = others_median(df, sensor, value, by).where("others is not null")
    out = rows.groupBy(sensor).agg(F.count(F.lit(1)).alias("days"), F.median(F.try_divide(F.col(value), F.col("others"))).alias("ratio"))
    return out.withColumn("excluded", (F.col("days") >= least) & F.coalesce(~F.col("ratio").between(low, high), F.lit(True)))


def zone_day(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean, median, least, greatest, sample deviation and number of stations."""
    return df.groupBy(*by).agg(
        F.avg(value).alias("mean"), F.median(value).alias("median"), F.min(value).alias("min"), F.max(value).alias("max"), F.stddev_samp(value).alias("std"), F.count(value).alias("n_stations")
    )


def only_complete(df: DataFrame, values: list[str], count: str, least: int) -> DataFrame:
    """All statistics of an incomplete day or run as NULL; its row stays."""
    whole = F.coalesce(F.col(count) >= least, F.lit(False))
    return df.withColumns({v: F.when(whole, F.col(v)) for v in values})


def of_known_stations(sensors: DataFrame, stations: DataFrame, station: str, zone: str = "zone_id") -> DataFrame:
    """Only sensors of stations that lie in a zone."""
    return sensors.join(stations.where(F.col(zone).isNotNull()).select(station).distinct(), station, "left_semi")
