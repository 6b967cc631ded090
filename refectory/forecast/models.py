"""Forecast models and ensembles (M10-M23). Grouped fits run in tasks by key; everything else is frames."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import windows as W
from ..session import staged
from .backtest import backtest_moving_average, cutoffs, resumed  # noqa: F401  M12, T7
from .regression import seasonal_regression, weekday_autoregression  # noqa: F401  M15, M16
from .weights import least_error


def moving_average(history: DataFrame, keys: list[str], day: str, date: str, value: str, n: int = 8) -> DataFrame:
    """By key and weekday the mean of the last n positive values, else the weekday's mean, else the mean of all cells' means."""
    recent = W.recent_positive_mean(history, [*keys, day], date, value, n, "recent")
    cell = history.groupBy(*keys, day).agg(F.avg(value).alias("cell"))
    overall = cell.agg(F.avg("cell").alias("overall"))
    return cell.join(recent, [*keys, day], "left").crossJoin(F.broadcast(overall)).select(*keys, day, F.coalesce("recent", "cell", "overall").alias("prediction"))


def fill_known(future: DataFrame, history: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows to be forecast whose day is already in the history get its summed value, which goes before their own."""
    known = history.groupBy(*keys).agg(F.sum(value).alias("__known"))
    return future.join(known, keys, "left").withColumn(value, F.coalesce("__known", value)).drop("__known")


def route_by_tenant(forecasts: DataFrame, sites: DataFrame, site: str, tenant: str, path: str) -> None:
    """Forecasts of a model over all tenants, written by tenant (sites: site, tenant); a site without a tenant goes nowhere."""
    forecasts.join(sites.select(site, tenant).distinct(), site).write.mode("overwrite").partitionBy(tenant).parquet(path)


def out_of_fold_means(train: DataFrame, group: list[str], row: list[str], label: str, name: str, folds: int = 5) -> DataFrame:
    """Train with the mean label of each row's group over the other folds, so that no row's own label is in its feature.

    row: columns that tell a group's rows apart, by whose hash rows are dealt to folds; rows that repeat one stay in its fold. A group
    without rows in other folds has the mean over all rows of other folds.
    """
    dealt = train.withColumn("__fold", F.pmod(F.xxhash64(*group, *row), F.lit(folds)))
    sums = dealt.where(F.col(label).isNotNull()).groupBy(*group, "__fold").agg(F.sum(label).alias("__s"), F.count("*").alias("__n"))
    own = sums.groupBy(*group).agg(F.sum("__s").alias("__gs"), F.sum("__n").alias("__gn"))
    fold = sums.groupBy("__fold").agg(F.sum("__s").alias("__fs"), F.sum("__n").alias("__fn"))
    every = fold.agg(F.sum("__fs").alias("__as"), F.sum("__fn").alias("__an"))
    rest = fold.crossJoin(F.broadcast(every)).select("__fold", F.try_divide(F.col("__as") - F.col("__fs"), F.col("__an") - F.col("__fn")).alias("__others"))
    out = dealt.join(own, group, "left").join(sums, [*group, "__fold"], "left").join(F.broadcast(rest), "__fold", "left")
    less = lambda a, b: F.col(a) - F.coalesce(b, F.lit(0))
    mean = F.coalesce(F.try_divide(less("__gs", "__s"), less("__gn", "__n")), "__others", F.lit(0.0))
    return out.withColumn(name, mean.cast("double")).select(*train.columns, name)


def group_means(train: DataFrame, future: DataFrame, group: list[str], label: str, name: str) -> DataFrame:
    """Future with the mean label of each row's group in train, or over all of train."""
    own = train.groupBy(*group).agg(F.avg(label).alias("__own"))
    overall = train.agg(F.avg(label).alias("__all"))
    return future.join(own, group, "left").crossJoin(F.broadcast(overall)).withColumn(name, F.coalesce("__own", "__all", F.lit(0.0))).select(*future.columns, name)


def gbt_forecast(train: DataFrame, future: DataFrame, numeric: list[str], category: str | list[str], site: str | list[str], label: str, date: str = "d", seed: int = 42) -> DataFrame:
    """One boosted-tree model over all sites: numeric features, one-hot categories, the site as the mean of its labels; floor 0.

    The site's mean is taken out of fold for rows that the model learns from. site: one column, or several, as tenant and site.
    """
    kinds, group = [category] if isinstance(category, str) else category, [site] if isinstance(site, str) else site
    stages = [
        *(StringIndexer(inputCol=c, outputCol=f"__i_{c}", handleInvalid="keep") for c in kinds), OneHotEncoder(inputCols=[f"__i_{c}" for c in kinds], outputCols=[f"__h_{c}" for c in kinds]),
        VectorAssembler(inputCols=[*numeric, "__site", *(f"__h_{c}" for c in kinds)], outputCol="__features", handleInvalid="keep"),
        GBTRegressor(featuresCol="__features", labelCol=label, predictionCol="prediction", maxIter=20, maxDepth=4, stepSize=0.2, seed=seed),
    ]
    # the trees pass over the rows many times
    rows = staged(out_of_fold_means(train, group, [date], label, "__site").na.fill(0.0, numeric).select(*numeric, *kinds, "__site", label), "train")
    model = Pipeline(stages=stages).fit(rows)
    out = model.transform(group_means(train, future, group, label, "__site").na.fill(0.0, numeric))
    return out.select(*future.columns, F.greatest(F.col("prediction"), F.lit(0.0)).alias("prediction"))


def long_form(wide: DataFrame, keys: list[str], models: list[str]) -> DataFrame:
    """A row a model."""
    return wide.unpivot(keys, models, "model", "prediction").where("prediction is not null")


def fit_weights_by_sums(df: DataFrame, scope: list[str], y: str, models: list[str], least_rows: int = 20, scale: Column | None = None, naive: str | None = None) -> DataFrame:
    """M18 for scopes of any number of rows: weights that minimise the mean absolute error, scaled or not; see weights.least_error."""
    return least_error(df, scope, y, models, scale, naive, least_rows).select(*scope, "model", "weight")


def fit_weights(df: DataFrame, scope: list[str], y: str, models: list[str], least_rows: int = 20, steps: int = 300) -> DataFrame:
    """By scope the weights on the simplex that minimise the mean absolute error, by exponentiated subgradient steps; else equal ones.

    Rows of a cell lacking some model don't count. The number of steps is fixed, so results repeat. Each scope is fitted in one task, so
    it should be a cell, like a site's; for all rows or large groups there is fit_weights_by_sums, which an empty scope takes.
    """
    if not scope:
        return fit_weights_by_sums(df, scope, y, models, least_rows)
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in scope)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf.dropna(subset=[y, *models])
        k = len(models)
        w = np.full(k, 1 / k)
        if len(own) >= least_rows:
            p, t = own[models].to_numpy(float), own[y].to_numpy(float)
            size = max(np.abs(p).mean(), 1e-9)
            best, best_mae = w, np.abs(p @ w - t).mean()
            for i in range(k):
                e = np.eye(k)[i]
                if (m := np.abs(p @ e - t).mean()) < best_mae:
                    best, best_mae = e, m
            for s in range(steps):
                g = (np.sign(p @ w - t)[:, None] * p).mean(0) / size
                w = w * np.exp(-(0.5 / np.sqrt(s + 1)) * (g - g.mean()))
                w = w / w.sum()
                if (m := np.abs(p @ w - t).mean()) < best_mae:
                    best, best_mae = w.copy(), m
            w = best
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] * k for c in scope}, "model": models, "weight": w})

    return df.groupBy(*scope).applyInPandas(fit, f"{fields}, model string, weight double")


def shrunk(weights: DataFrame, towards: DataFrame, keys: list[str], share: float = 0.3) -> DataFrame:
    """Weights of cells drawn towards those of a wider scope, the more the fewer rows: share / n."""
    part = F.lit(share) / F.greatest(F.col("n"), F.lit(1))
    return weights.join(towards.withColumnRenamed("weight", "__wide"), keys).withColumn("weight", (1 - part) * F.col("weight") + part * F.col("__wide")).drop("__wide")


def apply_weights(long: DataFrame, keys: list[str], chain: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """By keys the weighted mean of the models that are there; a model's weight is that of the first scope in the chain that has one.

    long (keys, model, prediction); chain: (weights (scope, model, weight), scope columns), the narrowest first; models without any count equally.
    """
    out, names = long.where(F.col("prediction").isNotNull()), []
    for i, (w, scope) in enumerate(chain):
        out = out.join(w.select(*scope, "model", F.col("weight").alias(f"__w{i}")), [*scope, "model"], "left")
        names.append(f"__w{i}")
    out = out.withColumn("__w", F.coalesce(*names, F.lit(1.0)))
    total = F.sum("__w")
    return out.groupBy(*keys).agg(F.when(total > 0, F.sum(F.col("__w") * F.col("prediction")) / F.when(total > 0, total)).otherwise(F.avg("prediction")).alias("prediction"))


def stretches(df: DataFrame, date: str, splits: int = 4, days: int = 30) -> DataFrame:
    """Rows of the last stretches of days, with __split: 0 for the last one, and so on."""
    last = df.agg(F.max(F.to_date(date)).alias("__last"))
    nth = F.floor(F.datediff("__last", F.to_date(date)) / days).cast("int")
    return df.crossJoin(F.broadcast(last)).withColumn("__split", nth).where(F.col("__split") < splits).drop("__last")


def cross_validated_weights(df: DataFrame, date: str, scope: list[str], y: str, models: list[str], splits: int = 4, days: int = 30, by_sums: bool = False, scale: Column | None = None, naive: str | None = None) -> DataFrame:
    """Weights fitted on each of several past stretches of days and averaged.

    by_sums: see fit_weights_by_sums, which also takes a scale (sMAE) or a naive forecast (MASE); else each scope and stretch must be a
    cell of few rows, fitted in one task.
    """
    cut = stretches(df, date, splits, days)
    if by_sums or not scope or scale is not None or naive is not None:
        fitted = fit_weights_by_sums(cut, [*scope, "__split"], y, models, 20, scale, naive)
    else:
        fitted = fit_weights(cut, [*scope, "__split"], y, models)
    return fitted.groupBy(*scope, "model").agg(F.avg("weight").alias("weight"))


def dominant(weights: DataFrame, scope: list[str]) -> DataFrame:
    """The model of the largest weight, ties by name."""
    return weights.groupBy(*scope).agg(F.max_by("model", F.struct("weight", "model")).alias("model"), F.max("weight").alias("weight"))


def evaluation_frame(store: DataFrame, keys: list[str], models: list[str]) -> DataFrame:
    """Of stored forecasts (keys, model, horizon, prediction, actual) those of the shortest horizon with a positive actual, a column a model."""
    best = W.latest(store.where("actual > 0"), [*keys, "model"], [F.col("horizon"), F.col("prediction")])
    wide = best.groupBy(*keys).pivot("model", models).agg(F.first("prediction"))
    actual = best.groupBy(*keys).agg(F.max("actual").alias("actual"))
    return reduce(lambda a, b: a.join(b, keys), [wide, actual])
