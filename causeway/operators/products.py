"""A registry of measured products: how each one's raw cells become values."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import bits_match, converted, masked, within


@dataclass(frozen=True)
class Product:
    """Raw band, conversion of units (a key of ``scalar.UNITS``), largest cloud fraction, bit groups of a quality flag that must match,
    valid range after conversion, and the radius in which gaps are filled."""

    band: str
    unit: str = "none"
    cloud_max: float | None = None
    bits: tuple[tuple[int, int, int], ...] = ()
    valid: tuple[float, float] | None = None
    radius_km: float = 12.0
    priority: Callable[[], Column] | None = None

    def value(self, cloud: str = "cloud_fraction", quality: str = "qa") -> Column:
        """The value of one look at a cell; NULL if it is cloudy, of bad quality or out of range."""
        v = converted(F.col(self.band), self.unit)
        if self.cloud_max is not None:
            v = masked(v, F.col(cloud), self.cloud_max)
        if self.bits:
            v = F.when(bits_match(F.col(quality), list(self.bits)), v)
        return within(v, *self.valid) if self.valid else v


class Registry:
    """Products by key. ``build_day`` averages the looks of a day, each by the product's own rules."""

    def __init__(self, products: dict[str, Product] | None = None):
        self.products = dict(products or {})

    def add(self, key: str, product: Product) -> None:
        if key in self.products:
            raise ValueError(f"{key} is registered")
        self.products[key] = product

    def build_day(self, key: str, looks: DataFrame, by: list[str], cloud: str = "cloud_fraction", quality: str = "qa") -> DataFrame:
        """One value per cell and day out of all looks at it; a cell without a good look is NULL, not missing."""
        product = self.products[key]
        return looks.groupBy(*by).agg(F.avg(product.value(cloud, quality)).alias("v"))

    def build_all(self, looks: dict[str, DataFrame], by: list[str]) -> DataFrame:
        """All products in one long table, with their keys."""
        out = None
        for key, df in looks.items():
            one = self.build_day(key, df, by).withColumn("product", F.lit(key))
            out = one if out is None else out.unionByName(one)
        return out
