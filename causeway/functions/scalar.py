"""Scalar expressions. Missing values are NULL throughout: ``nan_to_null`` belongs at every source."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nan_to_null(df: DataFrame, sentinel: float | None = None) -> DataFrame:
    """NaN, infinities and the sentinel of every floating column as NULL."""
    out = {}
    for name, kind in df.dtypes:
        if kind in ("double", "float"):
            c = F.col(f"`{name}`")
            bad = F.isnan(c) | (F.abs(c) == float("inf"))
            out[name] = F.when(~(bad | (c == sentinel) if sentinel is not None else bad), c)
    return df.withColumns(out)


def is_finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def at_least(x: Column, low: float = 0.0) -> Column:
    """Clipped from below; NULL stays NULL."""
    return F.when(x.isNotNull(), F.greatest(x, F.lit(low)))


def within(x: Column, low: float, high: float) -> Column:
    """The value where it lies in [low, high], else NULL."""
    return F.when(x.between(low, high), x)


def masked(x: Column, cloud: Column, most: float) -> Column:
    """The value where cloud does not exceed ``most``."""
    return F.when(cloud <= most, x)


def keep_classes(x: Column, kind: Column, classes: list[int]) -> Column:
    return F.when(kind.isin(classes), x)


def bits(flags: Column, start: int, width: int) -> Column:
    return F.shiftright(flags, start).bitwiseAND(F.lit((1 << width) - 1))


def bits_match(flags: Column, groups: list[tuple[int, int, int]]) -> Column:
    """Every group of (start, width, wanted) holds its wanted value."""
    out = F.lit(True)
    for start, width, wanted in groups:
        out = out & (bits(flags, start, width) == wanted)
    return out


def truncated(x: Column, digits: int) -> Column:
    f = 10.0**digits
    return F.floor(x * f + 1e-9).cast("double") / f


def significant(x: Column, digits: int) -> Column:
    """Rounded to so many significant digits."""
    size = F.floor(F.log10(F.abs(x)))
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - size)
    return F.when(x == 0, x).otherwise(F.rint(x * scale) / scale)


def normalised_difference(a: Column, b: Column) -> Column:
    return F.try_divide(a - b, a + b)


def relative_humidity(t: Column, td: Column) -> Column:
    """Per cent from temperature and dew point in Celsius, by the Magnus formula, held in 0 to 100."""

    def pressure(x: Column) -> Column:
        return F.exp(17.625 * x / (243.04 + x))

    rh = 100.0 * pressure(td) / pressure(t)
    return F.when(rh.isNotNull(), F.least(F.greatest(rh, F.lit(0.0)), F.lit(100.0)))


def wind(speed: Column, direction: Column) -> tuple[Column, Column]:
    """Components towards east and north of a wind that comes from ``direction`` degrees."""
    return -speed * F.sin(F.radians(direction)), -speed * F.cos(F.radians(direction))


def wind_from(u: Column, v: Column, mean_speed: Column) -> dict[str, Column]:
    """Speed of the mean vector, sine and cosine of where it comes from (NULL in a calm), and steadiness."""
    speed = F.hypot(u, v)
    moving = speed > 1e-6
    return {"speed": speed, "from_sin": F.when(moving, -u / speed), "from_cos": F.when(moving, -v / speed), "steadiness": F.try_divide(speed, mean_speed)}


def local_day(ts: Column, hours: int = 5) -> Column:
    """The date at a fixed offset from UTC."""
    return F.to_date(ts + F.expr(f"INTERVAL {hours} HOURS"))


def cyclical(day: Column) -> dict[str, Column]:
    """Position in the year and week on circles; weeks start on Monday."""
    year, week = F.dayofyear(day) * (2 * math.pi / 365.25), F.weekday(day) * (2 * math.pi / 7)
    return {"doy_sin": F.sin(year), "doy_cos": F.cos(year), "dow_sin": F.sin(week), "dow_cos": F.cos(week), "is_sunday": (F.weekday(day) == 6).cast("int")}


def previous_month(day: Column) -> Column:
    return F.add_months(F.trunc(day, "MM"), -1)


def days_since_month_end(day: Column, month: Column) -> Column:
    return F.datediff(day, F.last_day(month))


def improvement(base: Column, best: Column) -> Column:
    """Whole per cent by which ``best`` is below ``base``, halves upwards."""
    return F.floor(F.try_divide(base - best, base) * 100 + 0.5).cast("int")


def ventilation(boundary_layer: Column, speed: Column) -> Column:
    """Of one hour; days are means of the hours' products, not products of means."""
    return boundary_layer * speed


def inversion(surface: Column, aloft: Column) -> Column:
    """Temperature near the ground less that aloft."""
    return surface - aloft


#: Factor and offset of unit conversions.
UNITS = {
    "mol_to_umol": (1e6, 0.0), "mol_to_mmol": (1e3, 0.0), "mol_to_dobson": (2241.15, 0.0), "packed_aod": (0.001, 0.0), "kelvin_to_celsius": (1.0, -273.15),
    "pascal_to_hectopascal": (0.01, 0.0), "metre_to_millimetre": (1e3, 0.0), "kilogram_to_microgram": (1e9, 0.0), "none": (1.0, 0.0),
}


def converted(x: Column, unit: str) -> Column:
    factor, offset = UNITS[unit]
    return x * F.lit(factor) + F.lit(offset)


def last_complete_local_day(last_hour: Column, hours: int = 5) -> Column:
    """The last local day all of whose hours there are, from the start of the last hour in UTC."""
    return F.to_date(last_hour + F.expr("INTERVAL 1 HOURS") - F.expr(f"INTERVAL {24 - hours} HOURS"))


def is_mature(month: Column, today, days: int = 21) -> Column:
    """Whether a month ended at least ``days`` days before ``today`` (a parameter), so that it may be cached for good."""
    return F.date_add(F.last_day(month), days) < F.lit(today).cast("date")
