"""Look-ups in time: forecast runs (bitemporal) and completed months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_usable_run(runs: DataFrame, issues: DataFrame, horizon: int, test: str, oldest: int = 4, zone: str = "zone_id") -> DataFrame:
    """Per issue day and zone the newest run (init, lead) that has a value for the target day, as a whole row.

    A run of age a (issue day less init) covers the target at lead horizon + a - 1. Ages 1 to ``oldest`` are tried in order; the first
    whose ``test`` column is there wins. If none is, the row of the oldest age tried counts, all NULL if there is no such row.
    One equi-join and one aggregation, whatever the number of ages.
    """
    values = [c for c in runs.columns if c not in ("lead", zone)]
    ages = F.explode(F.sequence(F.lit(1), F.lit(oldest))).alias("age")
    wanted = issues.select("date", zone, ages).withColumns({"init": F.date_sub("date", F.col("age")), "lead": F.col("age") + horizon - 1})
    j = wanted.join(runs.withColumn("__there", F.lit(True)), ["init", "lead", zone], "left")
    row = F.struct("age", *values)
    usable = F.min(F.when(F.col(test).isNotNull(), F.struct("age", row.alias("row"))))
    last = F.max(F.when((F.col("age") == oldest) & F.col("__there"), F.struct("age", row.alias("row"))))
    out = j.groupBy("date", zone).agg(F.coalesce(usable, last).alias("best"))
    return out.select("date", zone, *(F.col(f"best.row.{c}").alias(c) for c in values), F.when(F.col("best").isNotNull(), F.col("best.age").cast("double")).alias("run_age"))


def run_history(runs: DataFrame, value: str, zone: str = "zone_id") -> DataFrame:
    """The lead-0 values by target day: the history that lags of a forecast are taken from."""
    return runs.where("lead = 0").select(F.col("target").alias("date"), zone, value)


def month_before(days: DataFrame, months: DataFrame, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """Each day with the values of the month completed before it; NULL where that month is missing."""
    return days.withColumn("month", F.add_months(F.trunc(date, "MM"), -1)).join(months, ["month", zone], "left")
