"""Weights on the simplex against grids and against sums formed by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from refectory.forecast import models as M
from refectory.forecast.weights import PASSES, least_error, simplex_grid


@pytest.fixture(scope="module")
def forecasts(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(3000):
        site = "abc"[i % 3] if i % 40 else None
        y = float(rng.gamma(4, 30) * (1 + "abc".index(site or "a")))
        m = [y * 0.8 + rng.normal() * 9 + 8, y * 1.25 + rng.normal() * 14 - 6, 60 + y * 0.5 + rng.normal() * 5, y + rng.normal() * 40]
        rows.append((site, i % 4, y if i % 97 else None, *(float(x) for x in m[:2]), float(m[2]) if i % 13 else None, float(m[3]), float(y + rng.normal() * 30) if i % 3 else None))
    return spark.createDataFrame(rows, "site string, b int, y double, m1 double, m2 double, m3 double, m4 double, plain double").repartition(3).cache()


def by_scope(df, scope):
    out = {}
    for r in df.collect():
        out.setdefault(tuple(r[c] for c in scope), {})[r.model] = r
    return out


def brute(own, models, scale=None, step=0.005):
    own = own.dropna(subset=["y", *models])
    p, y = own[models].to_numpy(float), own.y.to_numpy(float)
    c = np.ones(len(y)) if scale is None else 1 / own[scale].to_numpy(float)
    grid = simplex_grid(len(models), step)
    return own, min(float((np.abs(p @ w - y) * c).mean()) for w in grid), lambda w: float((np.abs(p @ w - y) * c).mean())


@pytest.mark.parametrize("scope", [["site"], ["site", "b"], []])
def test_the_best_of_a_fine_grid(forecasts, scope):
    models = ["m1", "m2", "m3"]
    got = by_scope(least_error(forecasts, scope, "y", models), scope)
    pdf = forecasts.fillna("none", "site").toPandas()
    groups = pdf.groupby(scope) if scope else [((), pdf)]
    assert len(got) == len(list(groups))
    for key, own in groups:
        key = tuple(None if x == "none" else x for x in key)
        rows = got[key]
        own, least, error = brute(own, models)
        first = rows["m1"]
        assert first.n == len(own) and first.passes <= PASSES
        w = np.array([rows[m].weight for m in models])
        assert abs(w.sum() - 1) < 1e-9 and (w >= 0).all()
        if len(own) < 20:
            assert first.error is None and np.allclose(w, 1 / 3)
        else:
            assert abs(error(w) - first.error) < 1e-9 and first.error <= least + 1e-9 and first.gap < 1e-9


def test_scaled_errors(forecasts):
    sized = forecasts.withColumn("size", F.when(F.col("site") == "a", 5.0).when(F.col("site") == "b", 500.0).otherwise(50.0))
    small = F.col("site").eqNullSafe("a")  # the first model is good where the scale is small, the second one elsewhere
    sized = sized.withColumns({"m1": F.col("y") + F.when(small, 1).otherwise(40), "m2": F.col("y") + F.when(small, 30).otherwise(2)})
    models = ["m1", "m2", "m3"]
    got = by_scope(least_error(sized, [], "y", models, F.col("size")), [])[()]
    _, least, error = brute(sized.toPandas(), models, "size")
    assert abs(got["m1"].error - least) < 1e-9 and abs(error(np.array([got[m].weight for m in models])) - least) < 1e-9
    plain = by_scope(least_error(sized, [], "y", models), [])[()]
    assert got["m1"].weight > plain["m1"].weight + 0.1


def test_against_a_naive_forecast(forecasts):
    models = ["m1", "m2"]
    got = by_scope(least_error(forecasts, ["site"], "y", models, naive="plain"), ["site"])
    for site, own in forecasts.fillna("none", "site").toPandas().groupby("site"):
        own, least, _ = brute(own, models)
        naive = np.abs(own.plain.fillna(own.y.mean()) - own.y).mean()
        rows = got[(None if site == "none" else site,)]
        assert abs(rows["m1"].error - least / naive) < 1e-9


def test_more_models_than_a_fine_grid_allows(forecasts):
    """Four models: no point of a grid of 0.02, nor of many random ones, is better by more than a little."""
    models = ["m1", "m2", "m3", "m4"]
    rows = by_scope(least_error(forecasts, [], "y", models), [])[()]
    _, least, error = brute(forecasts.toPandas(), models, step=0.025)
    w = np.array([rows[m].weight for m in models])
    assert abs(error(w) - rows["m1"].error) < 1e-9 and rows["m1"].error <= least * 1.001
    assert all(error(x) >= rows["m1"].error * 0.999 for x in np.random.default_rng(1).dirichlet(np.ones(4) / 2, 300))


def test_grid():
    assert len(simplex_grid(3, 0.02)) == 51 * 52 // 2 and np.allclose(simplex_grid(4).sum(1), 1) and len(simplex_grid(7)) <= 21_000
    assert simplex_grid(1).tolist() == [[1.0]] and sorted(simplex_grid(2, 0.5).tolist()) == [[0.0, 1.0], [0.5, 0.5], [1.0, 0.0]]


def test_stretches_with_a_scale(forecasts):
    df = forecasts.withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("b") * 30))
    w = M.cross_validated_weights(df, "d", ["site"], "y", ["m1", "m2"], 3, 30, scale=F.lit(10.0))
    assert all(abs(r.s - 1) < 1e-9 for r in w.groupBy("site").agg(F.sum("weight").alias("s")).collect()) and w.count() == 6  # rows without a site are all older
