"""Causal time-series operators on (zone, date) panels: nothing known on a day depends on that day or later.

Lags, trailing windows and target days count days of the calendar (frames by range), so a day without a row shifts nothing.
``complete``, ``carry_forward``, ``smooth`` and ``newest_before`` count rows: their panels are densified first (``densify``). All columns
of one call share a window, hence one sort.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spine(df: DataFrame, date: str = "date", step: str = "1 day", until=None) -> DataFrame:
    """Every date from the first to the last of ``df`` (or ``until``)."""
    ends = df.agg(F.min(date).alias("low"), F.max(date).alias("high"))
    high = F.greatest("high", F.lit(until).cast("date")) if until is not None else F.col("high")
    return ends.where("low is not null").select(F.explode(F.sequence("low", high, F.expr(f"interval {step}"))).alias(date))


def densify(df: DataFrame, zone: str = "zone_id", date: str = "date", step: str = "1 day", until=None) -> DataFrame:
    """A row for every zone on every date; missing values are NULL. The spine has one row per date and is broadcast by size."""
    zones = df.select(zone).distinct()
    return zones.join(spine(df, date, step, until)).join(df, [zone, date], "left")


def _order(zone: str, date: str):
    return Window.partitionBy(zone).orderBy(date)


def _days(zone: str, date: str):
    """Windows whose frames are numbers of days."""
    return Window.partitionBy(zone).orderBy(F.unix_date(date))


def lags(df: DataFrame, value: str, days: tuple[int, ...], zone: str = "zone_id", date: str = "date") -> DataFrame:
    """The values ``k`` days before each day; NULL where that day has no row."""
    w = _days(zone, date)
    return df.withColumns({f"{value}_lag{k}": F.first(value).over(w.rangeBetween(-k, -k)) for k in days})


def _guarded(fn, value: Column, frame, need: int) -> Column:
    return F.when(F.count(value).over(frame) >= need, fn(value).over(frame))


def trailing(df: DataFrame, value: str, windows: tuple[int, ...], least: float = 0.0, std: bool = True, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """Mean and sample deviation of the ``w`` days before each day, where at least ``least`` of them (2 for a deviation) have values."""
    out = {}
    for w in windows:
        frame = _days(zone, date).rangeBetween(-w, -1)
        need = max(1, math.ceil(w * least))
        out[f"{value}_roll{w}_mean"] = _guarded(F.avg, F.col(value), frame, need)
        if std:
            out[f"{value}_roll{w}_std"] = _guarded(F.stddev_samp, F.col(value), frame, max(2, need))
    return df.withColumns(out)


def target_day(df: DataFrame, value: str, horizon: int, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """The value on the target day (issue day plus horizon), its change from the day before, its mean and sum over three days
    that end there and the sum of the three days before the issue day; windows need all their days."""
    w = _days(zone, date)
    ahead, before = (F.first(value).over(w.rangeBetween(h, h)) for h in (horizon, horizon - 1))
    three, prior = w.rangeBetween(horizon - 2, horizon), w.rangeBetween(-3, -1)
    return df.withColumns(
        {
            f"{value}_target": ahead, f"{value}_change": ahead - before, f"{value}_mean3": _guarded(F.avg, F.col(value), three, 3),
            f"{value}_sum3": _guarded(F.sum, F.col(value), three, 3), f"{value}_prior3": _guarded(F.sum, F.col(value), prior, 3),
        }
    )


def complete(df: DataFrame, value: str, valid: str, least: float = 0.5, windows: tuple[int, ...] = (30, 90), zone: str = "zone_id", date: str = "date") -> DataFrame:
    """Direct values (enough valid area), else the median of the direct values in the first trailing window that has one.

    Adds ``complete``, ``level`` (0 direct, 1, 2, ... the window, one more than the windows if none) and ``age_days`` since
    the last direct value."""
    w = _order(zone, date)
    df = df.withColumn("__direct", F.when(F.col(valid) >= least, F.col(value)))
    medians = [F.percentile("__direct", 0.5).over(w.rowsBetween(-k, -1)) for k in windows]
    df = df.withColumns({f"__m{i}": m for i, m in enumerate(medians)} | {"__row": F.row_number().over(w)})
    level = F.lit(len(windows) + 1)
    for i in reversed(range(len(windows))):
        level = F.when(F.col(f"__m{i}").isNotNull(), i + 1).otherwise(level)
    last = F.last(F.when(F.col("__direct").isNotNull(), F.col("__row")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = df.withColumns(
        {
            "complete": F.coalesce("__direct", *(f"__m{i}" for i in range(len(windows)))),
            "level": F.when(F.col("__direct").isNotNull(), 0).otherwise(level), "age_days": (F.col("__row") - last).cast("int"),
        }
    )
    return out.drop("__direct", "__row", *(f"__m{i}" for i in range(len(windows))))


def carry_forward(df: DataFrame, value: str, most: int, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """Last value at most ``most`` rows old, its age, and whether it is real (``<value>_filled``, ``_age``, ``_real``)."""
    w = _order(zone, date)
    df = df.withColumn("__row", F.row_number().over(w))
    frame = w.rowsBetween(-most, 0)
    last = F.last(F.when(F.col(value).isNotNull(), F.col("__row")), ignorenulls=True).over(frame)
    return df.withColumns({f"{value}_filled": F.last(value, ignorenulls=True).over(frame), f"{value}_age": (F.col("__row") - last).cast("int"), f"{value}_real": F.col(value).isNotNull()}).drop("__row")


def smooth(df: DataFrame, value: str, rows: int = 7, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """Mean of the last ``rows`` rows, for display."""
    return df.withColumn(f"{value}_smooth", F.avg(value).over(_order(zone, date).rowsBetween(1 - rows, 0)))


def newest_before(df: DataFrame, value: str, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """Forward fill without a limit."""
    return df.withColumn(f"{value}_ffill", F.last(value, ignorenulls=True).over(_order(zone, date).rowsBetween(Window.unboundedPreceding, 0)))


def is_monotone(df: DataFrame, x: str, y: str, by: str) -> DataFrame:
    """Per group: does y never fall as x rises?"""
    step = F.col(y) - F.lag(y).over(Window.partitionBy(by).orderBy(x))
    return df.withColumn("__step", step).groupBy(by).agg((F.coalesce(F.min("__step"), F.lit(0)) >= 0).alias("monotone"))


def city_lag(df: DataFrame, value: str, zone: str = "zone_id", date: str = "date") -> DataFrame:
    """The mean over all zones on the day before, for every zone; the daily series is small and joins by date."""
    city = df.groupBy(date).agg(F.avg(value).alias(f"city_{value}_lag1")).withColumn(date, F.date_add(date, 1))
    return df.join(city, date, "left")


def padded(df: DataFrame, build, start, end, before: int, after: int = 0, date: str = "date") -> DataFrame:
    """``build`` of the days from start to end, given ``before`` more days of warm-up (and ``after`` more, where it looks both ways)."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return build(df.where(F.col(date).between(F.date_sub(first, before), F.date_add(last, after)))).where(F.col(date).between(first, last))


def require_calendar(df: DataFrame, date: str = "date", zone: str = "zone_id") -> DataFrame:
    """The panel itself, if every zone has every day from the first to the last once; else an error."""
    w = F.datediff(F.max(date), F.min(date)) + 1
    one = df.groupBy(zone).agg(F.count(F.lit(1)).alias("n"), F.countDistinct(date).alias("d"), F.min(date).alias("a"), F.max(date).alias("b"))
    all_ = df.agg(w.alias("span"), F.min(date).alias("low"), F.max(date).alias("high"))
    bad = one.join(F.broadcast(all_)).where((F.col("n") != F.col("span")) | (F.col("d") != F.col("n")) | (F.col("a") != F.col("low")) | (F.col("b") != F.col("high")))
    if (found := bad.select(zone).first()) is not None:
        raise ValueError(f"the calendar of {zone} {found[0]} has gaps or repeated days")
    return df


def scrambled(df: DataFrame, values: list[str], cut: Column) -> DataFrame:
    """The panel with every value where ``cut`` holds replaced, for tests of causality."""
    noise = F.xxhash64(*df.columns) % 1000
    return df.withColumns({v: F.when(cut, F.col(v) * 3 + noise.cast("double")).otherwise(F.col(v)) for v in values})
