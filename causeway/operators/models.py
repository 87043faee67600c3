"""Boosted regression per horizon and fold with pyspark.ml: early stopping on the newest part of each training set, sample weights, and a
final model of the folds' median number of rounds."""

from __future__ import annotations

from functools import reduce
from statistics import median

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .evaluate import inner_split


def _pipeline(columns: list[str], truth: str, rounds: int, weight: str | None, held: str | None, seed: int) -> Pipeline:
    """Missing values become medians, with a column that says so; then boosted trees."""
    missing = ", ".join(f"CAST(`{c}` IS NULL AS DOUBLE) AS `{c}__missing`, CAST(`{c}` AS DOUBLE) AS `{c}__number`" for c in columns)
    flags = SQLTransformer(statement=f"SELECT *, {missing} FROM __THIS__")
    imputer = Imputer(inputCols=[f"{c}__number" for c in columns], outputCols=[f"{c}__filled" for c in columns], strategy="median")
    assembler = VectorAssembler(inputCols=[f"{c}__{k}" for c in columns for k in ("filled", "missing")], outputCol="features", handleInvalid="keep")
    more = {"weightCol": weight} if weight else {}
    if held:
        more["validationIndicatorCol"] = held
    return Pipeline(stages=[flags, imputer, assembler, GBTRegressor(labelCol=truth, maxIter=rounds, maxDepth=4, seed=seed, predictionCol="raw", **more)])


def rounds_of(model: PipelineModel) -> int:
    return model.stages[-1].getNumTrees


def predict(model: PipelineModel, df: DataFrame, name: str = "pred_gbt") -> DataFrame:
    """The rows with their prediction, at least 0."""
    return model.transform(df).withColumn(name, F.greatest("raw", F.lit(0.0))).select(*df.columns, name)


def fit_folds(
    df: DataFrame, columns: list[str], truth: str, fold: str = "fold", horizon: str = "horizon", weight: str | None = None, rounds: int = 20, order: list[str] | None = None, share: float = 0.85, seed: int = 42
) -> tuple[DataFrame, dict]:
    """Each row's prediction by a model that has not seen its fold, and the rounds of each (horizon, fold).

    With ``order`` (date first), a model is fitted to the first ``share`` of its training rows, and boosting stops where it no longer
    gets better on the rest, which is newer.
    """
    keys = sorted(tuple(r) for r in df.select(horizon, fold).distinct().collect())  # horizons times folds: a handful
    parts, used = [], {}
    for h, f in keys:
        own = df.where(F.col(horizon) == h)
        train, held = own.where((F.col(fold) != f) & F.col(truth).isNotNull()), None
        if order:
            held = "__held"
            train = inner_split(train, order, share).withColumn(held, ~F.col("train")).drop("train")
        model = _pipeline(columns, truth, rounds, weight, held, seed).fit(train)
        used[h, f] = rounds_of(model)
        parts.append(predict(model, own.where(F.col(fold) == f)))
    return reduce(DataFrame.unionByName, parts), used


def out_of_fold(df: DataFrame, columns: list[str], truth: str, **more) -> DataFrame:
    return fit_folds(df, columns, truth, **more)[0]


def median_rounds(used: dict) -> dict:
    """Per horizon the median of its folds' rounds, cut to a whole number."""
    by: dict = {}
    for (h, _), n in used.items():
        by.setdefault(h, []).append(n)
    return {h: int(median(ns)) for h, ns in by.items()}


def refit(df: DataFrame, columns: list[str], truth: str, rounds: dict, horizon: str = "horizon", weight: str | None = None, seed: int = 42) -> dict:
    """A model per horizon, fitted to all its rows with a fixed number of rounds."""
    rows = df.where(F.col(truth).isNotNull())
    return {h: _pipeline(columns, truth, n, weight, None, seed).fit(rows.where(F.col(horizon) == h)) for h, n in sorted(rounds.items())}


def predict_live(models: dict, df: DataFrame, horizon: str = "horizon", name: str = "pred_gbt") -> DataFrame:
    """Each row's prediction by its horizon's model."""
    return reduce(DataFrame.unionByName, [predict(m, df.where(F.col(horizon) == h), name) for h, m in sorted(models.items())])


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    """Each feature's gain; of a value and the flag that it is missing the sum."""
    names = model.stages[-2].getInputCols()
    out: dict[str, float] = {}
    for name, gain in zip(names, model.stages[-1].featureImportances.toArray().tolist()):
        key = name.rsplit("__", 1)[0]
        out[key] = out.get(key, 0.0) + gain
    return sorted(out.items(), key=lambda kv: (-kv[1], kv[0]))
