"""The US EPA's piecewise linear air quality index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import at_least, truncated

# The EPA's breakpoints (C_low, C_high, I_low, I_high).
BREAKPOINTS = {
    ("pm25", "epa_2024"): [(0.0, 9.0, 0, 50), (9.1, 35.4, 51, 100), (35.5, 55.4, 101, 150), (55.5, 125.4, 151, 200), (125.5, 225.4, 201, 300), (225.5, 325.4, 301, 500)],
    ("pm25", "epa_2012"): [(0.0, 12.0, 0, 50), (12.1, 35.4, 51, 100), (35.5, 55.4, 101, 150), (55.5, 150.4, 151, 200), (150.5, 250.4, 201, 300), (250.5, 350.4, 301, 400), (350.5, 500.4, 401, 500)],
    ("pm10", "any"): [(0, 54, 0, 50), (55, 154, 51, 100), (155, 254, 101, 150), (255, 354, 151, 200), (355, 424, 201, 300), (425, 504, 301, 400), (505, 604, 401, 500)],
    ("no2", "any"): [(0, 53, 0, 50), (54, 100, 51, 100), (101, 360, 101, 150), (361, 649, 151, 200), (650, 1249, 201, 300), (1250, 1649, 301, 400), (1650, 2049, 401, 500)],
    ("o3", "any"): [(0.000, 0.054, 0, 50), (0.055, 0.070, 51, 100), (0.071, 0.085, 101, 150), (0.086, 0.105, 151, 200), (0.106, 0.200, 201, 300)],
}
# Decimals to which concentrations are truncated, and the upper ends and names of the bands.
DECIMALS = {"pm25": 1, "pm10": 0, "no2": 0, "o3": 3}
BANDS = [(50, "Good"), (100, "Moderate"), (150, "Unhealthy for Sensitive Groups"), (200, "Unhealthy"), (300, "Very Unhealthy"), (501, "Hazardous")]


def sub_index(pollutant: str, concentration: Column, standard: str = "epa_2024") -> Column:
    """Index of one pollutant: truncate, interpolate in the last bin that starts at or below, round half to even, at most 500."""
    table = BREAKPOINTS.get((pollutant, standard)) or BREAKPOINTS[pollutant, "any"]
    c = truncated(concentration, DECIMALS[pollutant])
    steps = [(F.lit((ih - il) / (ch - cl)) * (c - cl) + il, cl) for cl, ch, il, ih in table]
    value = reduce(lambda rest, step: F.when(c >= step[1], step[0]).otherwise(rest), steps[1:], steps[0][0])
    return F.when(c >= 0, F.least(F.rint(value), F.lit(500.0)))


def overall(indices: dict[str, Column]) -> tuple[Column, Column]:
    """The highest index that is there, and the first pollutant that reaches it."""
    top = F.greatest(*indices.values()) if len(indices) > 1 else next(iter(indices.values()))
    name = reduce(lambda rest, kv: F.when(kv[1] == top, F.lit(kv[0])).otherwise(rest), reversed(list(indices.items())), F.lit(None).cast("string"))
    return top, F.when(top.isNotNull(), name)


def category(aqi: Column) -> Column:
    """Band of an index, the upper end included."""
    out = F.lit(None).cast("string")
    for high, name in reversed(BANDS):
        out = F.when(aqi <= high, F.lit(name)).otherwise(out)
    return F.when(aqi > -1, out)


def to_aqi(pm25: Column) -> Column:
    return sub_index("pm25", at_least(pm25))


def pollutants_used(indices: dict[str, Column]) -> Column:
    """Names of the pollutants that are there, joined by +; empty if none."""
    return F.concat_ws("+", *(F.when(c.isNotNull(), F.lit(k)) for k, c in indices.items()))


def with_aqi(df, columns: list[str]):
    """``<c>_aqi`` and ``<c>_category`` of predicted concentrations."""
    return df.withColumns({f"{c}_aqi": to_aqi(F.col(c)) for c in columns}).withColumns({f"{c}_category": category(to_aqi(F.col(c))) for c in columns})
