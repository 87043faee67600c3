"""Descriptive aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shares(df: DataFrame, by: list[str]) -> DataFrame:
    """Counts and shares of the values of some columns."""
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return out.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def crosstab(df: DataFrame, row: str, column: str, values: list) -> DataFrame:
    return df.groupBy(row).agg(*(F.count_if(F.col(column) == v).alias(str(v)) for v in values))


def pivot_mean(df: DataFrame, row: str, column: str, values: list, value: str) -> DataFrame:
    return df.groupBy(row).pivot(column, values).agg(F.avg(value))


def coverage_by_month(df: DataFrame, value: str, observed: str, date: str = "date") -> DataFrame:
    """Mean observed share and per cent of days without a value, by calendar month."""
    return df.groupBy(F.month(date).alias("month")).agg(F.avg(observed).alias("observed"), (100 * F.avg(F.col(value).isNull().cast("int"))).alias("pct_missing"))


def distinct_text(df: DataFrame, by: str, value: str) -> DataFrame:
    return df.groupBy(by).agg(F.array_join(F.sort_array(F.collect_set(value)), ",").alias("values"))


def null_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """A row per column with its share of NULLs, in one pass."""
    one = df.agg(*(F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns))
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("null_share")) for c in columns))).alias("x")).select("x.*")


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Correlation, mean absolute difference and number of the pairs that are there."""
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return both.agg(F.corr(a, b).alias("corr"), F.avg(F.abs(F.col(a) - F.col(b))).alias("mad"), F.max(F.abs(F.col(a) - F.col(b))).alias("max_diff"), F.count(F.lit(1)).alias("n"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    parts = [F.struct(F.lit(c).alias("column"), F.min(c).cast("double").alias("min"), F.avg(c).alias("mean"), F.max(c).cast("double").alias("max"), F.stddev_samp(c).alias("std"), F.count(c).alias("n")) for c in columns]
    return df.agg(F.array(*parts).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def quantiles(df: DataFrame, value: str, at: list[float]) -> DataFrame:
    return df.agg(*(F.percentile(value, q).alias(f"p{round(100 * q):02d}") for q in at))


def mode_first(df: DataFrame, value: str, order: str, by: list[str]) -> DataFrame:
    """The most frequent value; of equals the one that is seen first."""
    seen = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return seen.groupBy(*by).agg(F.max_by(F.col(value), F.struct("n", -F.col("first"))).alias("mode"))


def js_round(x: Column) -> Column:
    """Halves upwards, as a whole number."""
    return F.floor(x + 0.5).cast("bigint")


def ranked(df: DataFrame, value: str, tie: str) -> DataFrame:
    """Rank by value, highest first, and the width of its bar in per cent of the largest (of 100 at least)."""
    top = F.greatest(F.max(value).over(Window.partitionBy()), F.lit(100.0))
    return df.withColumns({"rank": F.row_number().over(Window.orderBy(F.desc(value), tie)), "width": F.least(F.lit(100.0), F.col(value) / top * 100)})


def payload(df: DataFrame, by: str, order: str, fields: list[str]) -> DataFrame:
    """Per key its rows, in order, as a JSON array."""
    rows = F.sort_array(F.collect_list(F.struct(order, *(f for f in fields if f != order))))
    return df.groupBy(by).agg(F.to_json(rows).alias("rows"))


def zone_coverage(df: DataFrame, value: str, fractions: list[str], zone: str = "zone_id") -> DataFrame:
    """Per zone the mean of some fractions and the number of days with a value."""
    return df.groupBy(zone).agg(*(F.avg(c).alias(c) for c in fractions), F.count(value).alias("days_with_value"))


def filled_share(cells: DataFrame, by: str = "day") -> DataFrame:
    """Per day the share of the inside cells (flag not 9) that were filled from neighbours or near days (1, 2)."""
    return cells.where("flag <> 9").groupBy(by).agg(F.avg(F.col("flag").isin(1, 2).cast("int")).alias("filled"))


def most_filled(cells: DataFrame, by: str = "day") -> DataFrame:
    """The day of the largest such share; of equals the first."""
    return filled_share(cells, by).agg(F.max(F.struct("filled", (-F.unix_date(by) if dict(cells.dtypes)[by] == "date" else -F.col(by)).alias("o"), by)).alias("x")).select(f"x.{by}", "x.filled")


def by_year(df: DataFrame, date: str, stations: str, zone: str = "zone_id") -> DataFrame:
    """Per zone and year the rows, the distinct days and the median number of stations."""
    return df.groupBy(zone, F.year(date).alias("year")).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(date).alias("days"), F.median(stations).alias("median_stations"))


def year_table(df: DataFrame, date: str, stations: str, years: list[int], zone: str = "zone_id") -> DataFrame:
    """The same with columns ``days_<year>`` (0 if none) and ``stations_<year>`` for a fixed list of years."""
    long = by_year(df, date, stations, zone)
    columns = []
    for y in years:
        own = F.col("year") == y
        columns += [F.coalesce(F.max(F.when(own, F.col("days"))), F.lit(0)).alias(f"days_{y}"), F.max(F.when(own, F.col("median_stations"))).alias(f"stations_{y}")]
    return long.groupBy(zone).agg(*columns)


def median_int(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """The median, cut to a whole number towards zero."""
    return df.groupBy(*by).agg(F.median(value).cast("int").alias("median"))


def filled_fraction(valid: Column, clear: Column) -> Column:
    """What was filled of a zone: valid less clear area, not below 0; NULL if either is."""
    return F.when(valid.isNotNull() & clear.isNotNull(), F.greatest(valid - clear, F.lit(0.0)))
