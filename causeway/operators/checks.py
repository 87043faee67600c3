"""Validation as rows (check, status, detail)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .causal import scrambled


def results(df: DataFrame, rules: dict[str, tuple[Column, str]]) -> DataFrame:
    """One row per rule: an aggregate over ``df`` that must be true, and the level (FAIL or WARN) it takes if not; one pass for all."""
    one = df.agg(*(F.coalesce(rule, F.lit(False)).alias(f"c{i}") for i, (rule, _) in enumerate(rules.values())))
    rows = [F.struct(F.lit(name).alias("check"), F.when(F.col(f"c{i}"), "PASS").otherwise(level).alias("status")) for i, (name, (_, level)) in enumerate(rules.items())]
    return one.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def every(rule: Column) -> Column:
    return F.every(F.coalesce(rule, F.lit(True)))


def table_contract(df: DataFrame, keys: list[str], ranges: dict[str, tuple[float, float]], mean: str, fraction: str, date: str = "date") -> DataFrame:
    """Unique keys, a complete calendar, values in range and finite, and a mean exactly where there is valid area."""
    distinct = F.countDistinct(*keys)
    rules = {
        "keys are unique": (distinct == F.count(F.lit(1)), "FAIL"),
        "calendar is complete": (F.countDistinct(date) == F.datediff(F.max(date), F.min(date)) + 1, "FAIL"),
        "mean is missing exactly where nothing is valid": (every(F.col(mean).isNull() == (F.col(fraction) == 0)), "FAIL"),
    }
    for c, (low, high) in ranges.items():
        rules[f"{c} in [{low:g}, {high:g}]"] = (every(F.col(c).between(low, high)), "FAIL")
    return results(df, rules)


def reconcile(a: DataFrame, b: DataFrame, keys: list[str], value: str, tolerance: float = 1e-4) -> DataFrame:
    """Keys whose values differ by more than the tolerance, relatively, or that only one side has."""
    j = a.select(*keys, F.col(value).alias("a")).join(b.select(*keys, F.col(value).alias("b")), keys, "full")
    near = F.abs(F.col("a") - F.col("b")) <= tolerance * F.greatest(F.abs("a"), F.abs("b"), F.lit(1.0))
    return j.where(~F.coalesce(near, F.col("a").isNull() & F.col("b").isNull()))


def changed_before(panel: DataFrame, build: Callable[[DataFrame], DataFrame], values: list[str], day, date: str = "date", keys: tuple[str, ...] = ("zone_id",)) -> DataFrame:
    """Rows of ``build(panel)`` up to ``day`` that change when everything dated ``day`` or later is replaced: must be none."""
    cut = F.lit(day).cast("date")
    kept = [c for c in build(panel).columns if c not in values]
    a = build(panel).where(F.col(date) <= cut).select(kept)
    b = build(scrambled(panel, values, F.col(date) >= cut)).where(F.col(date) <= cut).select(kept)
    return a.exceptAll(b).select(date, *keys)


def truncation_differs(panel: DataFrame, build: Callable[[DataFrame], DataFrame], day, date: str = "date") -> DataFrame:
    """Rows of ``build`` up to ``day`` that differ when the panel ends there: must be none."""
    cut = F.lit(day).cast("date")
    return build(panel).where(F.col(date) <= cut).exceptAll(build(panel.where(F.col(date) <= cut)))
