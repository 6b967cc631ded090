"""Least squares by group (M15, M16, X2): Spark sums the normal equations, one small solve on one row a group gives the weights."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def products(x: list[Column], y: Column, known: Column | None = None) -> dict[str, Column]:
    """What is to be summed up for the fit of y by x: products of features, of features and y; known: rows that count."""
    own = (lambda c: F.when(known, c)) if known is not None else (lambda c: c)
    out = {f"xx_{i}_{j}": own(a * x[j]) for i, a in enumerate(x) for j in range(i, len(x))}
    return out | {f"xy_{i}": own(a * y) for i, a in enumerate(x)}


def sums(x: list[Column], y: Column, known: Column | None = None) -> list[Column]:
    """Aggregates of products(), by name; 0 over no rows."""
    return [F.coalesce(F.sum(c.cast("double")), F.lit(0.0)).alias(name) for name, c in products(x, y, known).items()]


def sum_names(k: int) -> list[str]:
    return [f"xx_{i}_{j}" for i in range(k) for j in range(i, k)] + [f"xy_{i}" for i in range(k)]


def solved(k: int, scale: list[Column], penalty: list[Column]) -> Column:
    """Weights of k features from the columns of sum_names(k): features are divided by scale, penalty is added to the diagonal.

    Rows are solved a batch at a time; each is one group.
    """
    upper = np.triu_indices(k)

    @F.pandas_udf("array<double>")
    def solve(xx: pd.Series, xy: pd.Series, scale: pd.Series, penalty: pd.Series) -> pd.Series:
        s = np.stack(scale.to_numpy()).astype(float)
        a = np.zeros((len(xx), k, k))
        a[:, upper[0], upper[1]] = np.stack(xx.to_numpy())
        a[:, upper[1], upper[0]] = a[:, upper[0], upper[1]]
        a = a / (s[:, :, None] * s[:, None, :])
        a[:, np.arange(k), np.arange(k)] += np.stack(penalty.to_numpy()).astype(float)
        w = np.linalg.solve(a, (np.stack(xy.to_numpy()) / s)[:, :, None])[:, :, 0]
        return pd.Series(list(w / s))

    names = sum_names(k)
    cut = k * (k + 1) // 2
    return solve(F.array(*names[:cut]), F.array(*names[cut:]), F.array(*scale), F.array(*penalty))


def dot(weights: Column, x: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, [weights[i] * c for i, c in enumerate(x)])


# By site and weekday, on the values of that weekday before


def lagged(history: DataFrame, site: str, date: str, value: str, lags: int) -> DataFrame:
    """site, d, day, v, nth (place within site and weekday), lag_1, ...: each value with those of the same weekday before it."""
    h = history.select(site, F.to_date(date).alias("d"), F.weekday(F.to_date(date)).alias("day"), F.col(value).cast("double").alias("v")).where("v is not null")
    w = Window.partitionBy(site, "day").orderBy("d", "v")
    return h.select("*", F.row_number().over(w).alias("nth"), *(F.lag("v", i).over(w).alias(f"lag_{i}") for i in range(1, lags + 1)))


def ar_terms(lags: int) -> list[Column]:
    return [F.lit(1.0), *(F.col(f"lag_{i}") for i in range(1, lags + 1))]


def ar_sums(lags: int) -> list[Column]:
    """Aggregates of a cell: rows, total, largest value, its last `lags` values (the latest first), and the sums of the fit."""
    last = F.max_by(F.array("v", *(f"lag_{i}" for i in range(1, lags))), "nth")
    return [F.count("*").alias("n"), F.sum("v").alias("total"), F.max("v").alias("top"), last.alias("last"), *sums(ar_terms(lags), F.col("v"), F.col(f"lag_{lags}").isNotNull())]


def ar_predictions(cells: DataFrame, keys: list[str], lags: int, steps: int, ridge: float) -> DataFrame:
    """cells (keys, ar_sums(), site_mean) -> keys, step, prediction: `steps` values on, each from the ones before, 0 to 3 times the largest.

    Cells of fewer than 2 * lags + 2 rows take their mean, those of one row the site's; floor 0.
    """
    k, own = lags + 1, F.col("n") - lags
    fitted = cells.withColumn("w", solved(k, [F.lit(1.0)] * k, [F.greatest(own, F.lit(1)) * ridge] * k))
    enough = F.col("n") >= 2 * lags + 2
    few = F.when(F.col("n") >= 2, F.col("total") / F.col("n")).otherwise(F.col("site_mean"))
    before = [F.col("last")[i] for i in range(lags)]
    for s in range(steps):
        p = F.least(F.greatest(dot(F.col("w"), [F.lit(1.0), *before[:lags]]), F.lit(0.0)), F.col("top") * 3)
        fitted = fitted.withColumn(f"p_{s}", F.when(enough, p).otherwise(F.greatest(few, F.lit(0.0))))
        before = [F.col(f"p_{s}"), *before]
    each = F.array(*(F.struct(F.lit(s + 1).alias("step"), F.greatest(F.col(f"p_{s}"), F.lit(0.0)).alias("prediction")) for s in range(steps)))
    return fitted.select(*keys, F.inline(each))


def weekday_autoregression(history: DataFrame, site: str, date: str, value: str, lags: int = 3, steps: int = 3, ridge: float = 1e-3) -> DataFrame:
    """By site and weekday an autoregression on the last `lags` values of that weekday, `steps` values on; see ar_predictions()."""
    cells = lagged(history, site, date, value, lags).groupBy(site, "day").agg(*ar_sums(lags))
    every = Window.partitionBy(site)
    return ar_predictions(cells.withColumn("site_mean", F.sum("total").over(every) / F.sum("n").over(every)), [site, "day"], lags, steps, ridge)


# By site, on the calendar and regressors


def seasonal_terms(date: str, regressors: list[str]) -> list[Column]:
    """A constant, a flag for each weekday, a yearly Fourier pair, and the regressors, null as 0."""
    day, angle = F.weekday(F.to_date(date)), F.dayofyear(F.to_date(date)) * (2 * np.pi / 365.25)
    return [F.lit(1.0), *((day == i).cast("double") for i in range(7)), F.sin(angle), F.cos(angle), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in regressors)]


def seasonal_sums(date: str, value: str, regressors: list[str]) -> list[Column]:
    """Aggregates of a site: rows, total, largest size of each feature, and the sums of the fit."""
    x = seasonal_terms(date, regressors)
    y = F.col(value).cast("double")
    return [F.count("*").alias("n"), F.sum(y).alias("total"), *(F.max(F.abs(c)).alias(f"top_{i}") for i, c in enumerate(x)), *sums(x, y)]


def seasonal_weights(groups: DataFrame, keys: list[str], n_regressors: int, ridge: float) -> DataFrame:
    """groups (keys, seasonal_sums()) -> keys, n, total, w."""
    k = 10 + n_regressors
    scale = [F.greatest(F.col(f"top_{i}"), F.lit(1e-9)) for i in range(k)]
    return groups.select(*keys, "n", "total", solved(k, scale, [F.lit(1e-6), *[F.lit(ridge)] * (k - 1)]).alias("w"))


def seasonal_prediction(date: str, regressors: list[str], least_rows: int) -> Column:
    """Of rows that have the weights of their group; floor 0, the group's mean where it has few rows, 0 where it has none."""
    p = F.when(F.col("n") >= least_rows, dot(F.col("w"), seasonal_terms(date, regressors))).otherwise(F.col("total") / F.col("n"))
    return F.greatest(F.coalesce(p, F.lit(0.0)), F.lit(0.0))


def seasonal_regression(history: DataFrame, future: DataFrame, site: str, date: str, value: str, regressors: list[str], least_rows: int = 10, ridge: float = 1.0) -> DataFrame:
    """By site a ridge regression on seasonal_terms(); see seasonal_prediction()."""
    groups = history.where(F.col(value).isNotNull()).groupBy(site).agg(*seasonal_sums(date, value, regressors))
    out = future.select(site, date, *regressors).join(seasonal_weights(groups, [site], len(regressors), ridge), site, "left")
    return out.select(site, date, seasonal_prediction(date, regressors, least_rows).alias("prediction"))
