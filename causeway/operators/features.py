"""The feature table: one row per issue date, zone and horizon."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import cyclical
from . import causal, runs


def one_hot(df: DataFrame, column: str, values: list) -> DataFrame:
    """A 0/1 column for each of a fixed list of values, those that never occur included."""
    return df.withColumns({f"{column}_{v}": (F.col(column) == v).cast("double") for v in values})


def build(sat: DataFrame, met: DataFrame, forecasts: DataFrame, horizons: tuple[int, ...] = (0, 1, 2), zone: str = "zone_id") -> DataFrame:
    """Lags and trailing statistics of ``sat`` (value; a window needs all its days), target-day meteorology (value), the newest usable run (v), the calendar of the
    target day and interactions; rows of an issue day without target-day meteorology are left out.

    The history block is computed once and joined to each horizon's; all windows are by zone and date.
    """
    history = causal.lags(sat.select(zone, "date", F.col("value").alias("sat")), "sat", (1, 2, 3), zone)
    history = causal.trailing(history, "sat", (3, 7), least=1.0, zone=zone).drop("sat")
    blocks = []
    for h in horizons:
        m = causal.target_day(met.select(zone, "date", F.col("value").alias("met")), "met", h, zone).drop("met")
        c = runs.newest_usable_run(forecasts, m.select("date", zone), h, "v", zone=zone).select("date", zone, F.col("v").alias("run_v"), "run_age")
        b = history.join(m.where("met_target is not null"), [zone, "date"]).join(c, [zone, "date"], "left")
        b = b.withColumns({"horizon": F.lit(h), "target_date": F.date_add("date", h)})
        b = b.withColumns(cyclical(F.col("target_date")))
        blocks.append(b.withColumn("run_x_met", F.col("run_v") * F.col("met_target") / 100))
    return reduce(DataFrame.unionByName, blocks).withColumnRenamed("date", "issue_date")


def live(features: DataFrame, ground: DataFrame, issue, zone: str = "zone_id") -> DataFrame:
    """The features of one issue day with the ground history known on it, joined by zone alone: ``ground`` has a row per zone and
    issue day, and only that day's rows serve."""
    from .upsert import left_join_one

    day = F.lit(issue).cast("date")
    own = ground.where(F.col("date") == day).drop("date")
    return left_join_one(features.where(F.col("issue_date") == day), own, [zone])


def with_targets(features: DataFrame, truth: DataFrame, zone: str = "zone_id") -> DataFrame:
    """The truth of each row's target day; the truth's keys must be unique."""
    from .upsert import left_join_one

    return left_join_one(features, truth.select(F.col("date").alias("target_date"), zone, F.col("value").alias("truth")), ["target_date", zone])
