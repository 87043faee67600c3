"""Keys, revisions and calendars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of each key in a total order; with one column per key and partial aggregation, so a hot key is no burden."""
    row = F.struct(*(F.col(c) for c in df.columns))
    rank = F.struct(*order)
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max_by(row, rank).alias("row")).select("row.*")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    row = F.struct(*(F.col(c) for c in df.columns))
    return df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.min_by(row, F.struct(*order)).alias("row")).select("row.*")


def upsert(old: DataFrame, new: DataFrame, key: list[str], unique: list[str] | None = None) -> DataFrame:
    """Old rows whose key is not re-supplied, and all new rows. ``unique``: columns that must tell the rows of the result apart."""
    if unique:
        require_unique(new, unique)
    return old.join(new.select(*key).distinct(), key, "left_anti").unionByName(new)


def full_join(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """All keys of all tables."""
    return reduce(lambda a, b: a.join(b, keys, "full"), frames)


def prefixed(df: DataFrame, prefix: str, keys: list[str]) -> DataFrame:
    return df.select(*keys, *(F.col(c).alias(f"{prefix}_{c}") for c in df.columns if c not in keys))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).count().where("count > 1")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    if not duplicates(df, keys).isEmpty():
        raise ValueError(f"repeated keys {keys}")
    return df


def left_join_one(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A left join that keeps the number of rows: the right keys must be unique."""
    return left.join(require_unique(right, keys), keys, "left")


def missing_days(df: DataFrame, by: list[str], date: str = "date") -> DataFrame:
    """Days between the first and the last of the whole table that a key lacks."""
    from .causal import spine

    wanted = df.select(*by).distinct().join(spine(df, date))
    return wanted.join(df.select(*by, date).distinct(), [*by, date], "left_anti")


def from_best_source(df: DataFrame, keys: list[str], priority: Column) -> DataFrame:
    """Only the rows of each key's best source (least priority)."""
    return df.withColumn("__p", F.dense_rank().over(Window.partitionBy(*keys).orderBy(priority))).where("__p = 1").drop("__p")


def with_fallback(main: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """All of ``main``, and of ``other`` what has no such key in it."""
    return main.unionByName(other.join(main.select(*keys).distinct(), keys, "left_anti"))


def sample(df: DataFrame, n: int, keys: list[str], seed: int = 0) -> DataFrame:
    """n rows chosen by a hash of their keys: the same on any cluster."""
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)


def require_schema(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """The table with just the columns of a contract, which must be there with their types."""
    found = dict(df.dtypes)
    wrong = {c: (t, found.get(c)) for c, t in schema.items() if found.get(c) != t}
    if wrong:
        raise ValueError(f"columns (wanted, found): {wrong}")
    return df.select(*schema)


def lead_first(df: DataFrame, lead: list[str]) -> DataFrame:
    """The same columns, ``lead`` before the others."""
    return df.select(*lead, *(c for c in df.columns if c not in lead))


def all_but(df: DataFrame, denied: list[str]) -> DataFrame:
    """Every column that is not denied; denied ones need not be there."""
    return df.select(*(c for c in df.columns if c not in denied))


def numeric(df: DataFrame) -> DataFrame:
    """The columns of numbers only."""
    return df.select(*(f.name for f in df.schema if isinstance(f.dataType, T.NumericType)))


def mapped(column: Column, names: dict) -> Column:
    """A code's entry in a table; NULL if it has none."""
    return F.create_map(*(F.lit(x) for kv in names.items() for x in kv))[column]


def join_one_to_one(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """An inner join that must use every row of both sides once."""
    require_unique(a, keys)
    require_unique(b, keys)
    apart = a.select(*keys).join(b.select(*keys).withColumn("__b", F.lit(True)), keys, "left_anti").limit(1).count() or b.select(*keys).join(a.select(*keys), keys, "left_anti").limit(1).count()
    if apart:
        raise ValueError(f"rows without a partner by {keys}")
    return a.join(b, keys)


def column_sets(spark, a: list[str], b: list[str]) -> DataFrame:
    """Names of columns and where they are: both, or only one of two lists. Shared names are what must not leak; the rest is how
    two tables differ."""
    rows = [(c, "both" if c in set(a) & set(b) else "first" if c in a else "second") for c in sorted(set(a) | set(b))]
    return spark.createDataFrame(rows, "name string, place string")


def reseeded(stored: DataFrame, fresh: DataFrame, issue: str = "issue_date") -> DataFrame:
    """What a serving table holds after a new forecast came: all of the fresh rows if their issue date is another than the stored one
    (or nothing is stored), else what is stored. Each side has one issue date."""
    now = fresh.agg(F.max(issue).alias("fresh"))
    before = stored.agg(F.max(issue).alias("stored"))
    same = now.join(before).select(F.coalesce(F.col("fresh").eqNullSafe(F.col("stored")), F.lit(False)).alias("same"))
    return stored.join(F.broadcast(same.where("same"))).drop("same").unionByName(fresh.join(F.broadcast(same.where("not same"))).drop("same"))
