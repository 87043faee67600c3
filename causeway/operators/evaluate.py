"""Cross-validation, forecast metrics and the gate in front of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.aqi import BANDS, category, to_aqi


def folds(df: DataFrame, date: str, n: int = 5) -> DataFrame:
    """Blocks of dates with about equal numbers of rows: the fold is how many of the n - 1 edges the running count has reached.

    The running count is over the per-date counts, a short series; the rows themselves are not sorted.
    """
    per_date = df.groupBy(date).agg(F.count(F.lit(1)).alias("rows"))
    w = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    counted = per_date.withColumn("__cum", F.sum("rows").over(w)).withColumn("__all", F.sum("rows").over(Window.partitionBy()))
    edge = [(F.col("__cum") >= F.col("__all") * F.lit(k / n)).cast("int") for k in range(1, n)]
    fold = sum(edge[1:], edge[0])
    return counted.select(date, fold.alias("fold"))


def fold_summary(df: DataFrame, date: str, zone: str) -> DataFrame:
    return df.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows"), F.min(date).alias("first"), F.max(date).alias("last"), F.countDistinct(date).alias("days"), F.array_join(F.sort_array(F.collect_set(F.col(zone).cast("string"))), ",").alias("zones")
    )


def inner_split(df: DataFrame, order: list[str], share: float = 0.85) -> DataFrame:
    """``train``: the first int(n * share) rows in order.

    The boundary date comes from counts per date; only rows of that date are ranked, so no task sorts the whole table.
    """
    date = order[0]
    n = F.sum("rows").over(Window.partitionBy())
    w = Window.orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    counts = df.groupBy(date).agg(F.count(F.lit(1)).alias("rows"))
    counts = counts.select(date, F.coalesce(F.sum("rows").over(w), F.lit(0)).alias("__before"), F.floor(n * F.lit(share)).alias("__cut"))
    ranked = df.join(counts, date).withColumn("__nth", F.row_number().over(Window.partitionBy(date).orderBy(*order[1:])))
    return ranked.withColumn("train", F.col("__before") + F.col("__nth") <= F.col("__cut")).drop("__before", "__nth", "__cut")


def long_predictions(df: DataFrame, models: list[str], keep: list[str]) -> DataFrame:
    """A row per model and prediction that is there."""
    pairs = F.explode(F.array(*(F.struct(F.lit(m).alias("model"), F.col(m).alias("pred")) for m in models))).alias("p")
    return df.select(*keep, pairs).select(*keep, "p.model", "p.pred").where("pred is not null")


def errors(truth: Column, pred: Column) -> dict[str, Column]:
    """n, rmse, mae and r2 (NULL unless n > 1) as aggregates."""
    n = F.count(truth)
    square = F.sum(F.pow(truth - pred, 2))
    total = F.var_pop(truth) * n
    return {"n": n, "rmse": F.sqrt(F.avg(F.pow(truth - pred, 2))), "mae": F.avg(F.abs(truth - pred)), "r2": F.when(n > 1, 1 - F.try_divide(square, total))}


def metrics(df: DataFrame, models: list[str], truth: str = "truth", horizon: str = "horizon") -> DataFrame:
    """Metrics per model and horizon, and overall (horizon NULL), in one pass by grouping sets."""
    long = long_predictions(df, models, [horizon, truth])
    aqi_t, aqi_p = to_aqi(F.col(truth)), to_aqi(F.col("pred"))
    more = {"aqi_mae": F.avg(F.abs(aqi_t - aqi_p)), "category_accuracy": F.avg((category(aqi_t) == category(aqi_p)).cast("int"))}
    aggs = [c.alias(k) for k, c in {**errors(F.col(truth), F.col("pred")), **more}.items()]
    return long.groupingSets([[horizon, "model"], ["model"]], horizon, "model").agg(*aggs)


def zone_metrics(df: DataFrame, models: list[str], truth: str = "truth", zone: str = "zone_id", least: int = 10) -> DataFrame:
    """Metrics per zone and model, of zones with ``least`` rows or more, those without a prediction counted."""
    enough = df.groupBy(zone).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least)
    long = long_predictions(df, models, [zone, truth]).join(enough.select(zone), zone, "left_semi")
    return long.groupBy(zone, "model").agg(*(c.alias(k) for k, c in errors(F.col(truth), F.col("pred")).items()))


def macro_f1(df: DataFrame, truth: str, pred: str, by: list[str], labels: list[str] | None = None) -> DataFrame:
    """Mean F1 over a fixed list of labels; those that never occur count 0."""
    labels = labels or [name for _, name in BANDS]
    f1 = []
    aggs = []
    for i, label in enumerate(labels):
        t, p = F.col(truth) == label, F.col(pred) == label
        aggs += [F.sum((t & p).cast("int")).alias(f"tp{i}"), F.sum((t | p).cast("int")).alias(f"any{i}")]
        f1.append(F.coalesce(F.try_divide(2 * F.col(f"tp{i}"), F.col(f"tp{i}") + F.col(f"any{i}")), F.lit(0.0)))
    return df.groupBy(*by).agg(*aggs).select(*by, (sum(f1[1:], f1[0]) / len(labels)).alias("macro_f1"))


def best_models(table: DataFrame, priority: dict[str, int], horizon: str = "horizon") -> DataFrame:
    """Per horizon the model of least rmse; of equals that of least priority."""
    rank = F.create_map(*(x for m, p in priority.items() for x in (F.lit(m), F.lit(p))))
    rows = table.where(F.col(horizon).isNotNull() & F.col("model").isin(list(priority)))
    return rows.groupBy(horizon).agg(F.min_by("model", F.struct("rmse", rank[F.col("model")])).alias("best"))


def chosen(df: DataFrame, best: DataFrame, models: list[str], horizon: str = "horizon") -> DataFrame:
    """``pred_final``: the prediction of the horizon's best model."""
    out = F.lit(None).cast("double")
    for m in models:
        out = F.when(F.col("best") == m, F.col(m)).otherwise(out)
    return df.join(F.broadcast(best), horizon, "left").withColumn("pred_final", out)


def importance(scores: DataFrame, k: int) -> DataFrame:
    """The k features of highest mean share over all models; a feature a model lacks counts 0 there."""
    share = F.try_divide(F.col("gain"), F.sum("gain").over(Window.partitionBy("model")))
    models = scores.select("model").distinct().agg(F.count(F.lit(1)).alias("models"))
    out = scores.withColumn("share", share).groupBy("feature").agg(F.sum("share").alias("sum")).join(F.broadcast(models))
    return out.select("feature", (F.col("sum") / F.col("models")).alias("importance")).orderBy(F.desc("importance"), "feature").limit(k)


def gate(table: DataFrame, models: list[str], baseline: str, horizon: str = "horizon") -> DataFrame:
    """Check rows: every model must beat the baseline overall on rmse and mae (FAIL), and should at each horizon (WARN)."""
    base = table.where(F.col("model") == baseline).select(F.col(horizon).alias("__h"), F.col("rmse").alias("b_rmse"), F.col("mae").alias("b_mae"))
    rows = table.where(F.col("model").isin(models)).join(F.broadcast(base), F.col(horizon).eqNullSafe(F.col("__h")))
    better = (F.col("rmse") < F.col("b_rmse")) & (F.col("mae") < F.col("b_mae"))
    status = F.when(better, "PASS").otherwise(F.when(F.col(horizon).isNull(), "FAIL").otherwise("WARN"))
    name = F.concat(F.lit("beats the baseline: "), "model", F.coalesce(F.concat(F.lit(" T+"), F.col(horizon).cast("string")), F.lit(" overall")))
    return rows.select(name.alias("check"), status.alias("status"), F.concat(F.round("rmse", 3).cast("string"), F.lit(" against "), F.round("b_rmse", 3).cast("string")).alias("detail"))


def persistence(lag: Column) -> Column:
    """The baseline of every horizon: the last known value, not below 0."""
    return F.when(lag.isNotNull(), F.greatest(lag, F.lit(0.0)))


def agreement(df: DataFrame, a: str, b: str) -> DataFrame:
    """Mean and largest absolute difference of two models' predictions."""
    gap = F.abs(F.col(a) - F.col(b))
    return df.agg(F.avg(gap).alias("mean_diff"), F.max(gap).alias("max_diff"), F.count(gap).alias("n"))


#: Parts of the names of features that physics expects among the most important.
PHYSICAL = ("aod", "blh", "vent", "rh_", "humid", "g_pm25", "g_aqi", "cams_pm25", "no2", "inversion")


def full_gate(
    predictions: DataFrame, expected: DataFrame, assigned: DataFrame, models: list[str], baseline: str, features: list[str], forbidden: list[str], top: DataFrame,
    keys: list[str], physical: tuple[str, ...] = PHYSICAL, least: int = 3, truth: str = "truth", horizon: str = "horizon",
) -> DataFrame:
    """Check rows (check, status). FAIL: a row of ``expected`` without predictions of all models; a forbidden column among the features; a
    key with several folds or none; a model that does not beat the baseline overall. WARN: one that does not beat it at every
    horizon; fewer than ``least`` physical features among ``top`` (a column feature)."""

    def status(ok: Column, level: str) -> Column:
        return F.when(F.coalesce(ok, F.lit(False)), "PASS").otherwise(level)

    there = F.lit(True)
    for m in models:
        there = there & F.col(m).isNotNull()
    complete = predictions.where(there).select(*keys)
    spark = predictions.sparkSession
    lacking = expected.select(*keys).exceptAll(complete).unionByName(complete.exceptAll(expected.select(*keys)))
    rows = [lacking.agg(status(F.count(F.lit(1)) == 0, "FAIL").alias("status")).select(F.lit("coverage").alias("check"), "status")]
    rows.append(spark.range(1).select(F.lit("no target or identifier among the features").alias("check"), F.lit("FAIL" if set(features) & set(forbidden) else "PASS").alias("status")))
    folds_ = expected.select(*keys).join(assigned.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys, "full")
    rows.append(folds_.agg(status(F.every(F.coalesce(F.col("n"), F.lit(0)) == 1), "FAIL").alias("status")).select(F.lit("one fold per row").alias("check"), "status"))
    table = metrics(predictions, [*models, baseline], truth, horizon)
    base = table.where(F.col("model") == baseline).select(F.col(horizon).alias("__h"), F.col("rmse").alias("b_rmse"), F.col("mae").alias("b_mae"))
    both = table.where(F.col("model").isin(models)).join(F.broadcast(base), F.col(horizon).eqNullSafe(F.col("__h")))
    overall, each = both.where(F.col(horizon).isNull()), both.where(F.col(horizon).isNotNull())
    rows.append(overall.select(F.concat("model", F.lit(" beats the baseline overall")).alias("check"), status((F.col("rmse") < F.col("b_rmse")) & (F.col("mae") < F.col("b_mae")), "FAIL").alias("status")))
    rows.append(each.groupBy("model").agg(status(F.every(F.col("rmse") < F.col("b_rmse")), "WARN").alias("status")).select(F.concat("model", F.lit(" beats the baseline at every horizon")).alias("check"), "status"))
    hit = F.lit(False)
    for part in physical:
        hit = hit | F.contains(F.lower("feature"), F.lit(part))
    rows.append(top.agg(status(F.count_if(hit) >= least, "WARN").alias("status")).select(F.lit("physical features among the most important").alias("check"), "status"))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def write_if_passed(df: DataFrame, checks: DataFrame, path: str) -> bool:
    """Writes only where no check failed."""
    if not checks.where("status = 'FAIL'").isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True
