"""Forecast models against reference fits in numpy, and their accuracy on a small fixture of two sites with a weekly rhythm."""

import datetime as dt
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from refectory.forecast import models as M
from refectory.operators import aggregates as A

START = dt.date(2023, 9, 4)


@pytest.fixture(scope="module")
def history(spark):
    """200 days of two sites: a weekday level, a slow yearly wave and noise."""
    rng = np.random.default_rng(42)
    rows = []
    for site, base in (("a", 150.0), ("b", 320.0)):
        for i in range(200):
            d = START + dt.timedelta(days=i)
            level = base * (1 + 0.15 * np.cos(2 * np.pi * d.weekday() / 7) + 0.05 * np.sin(2 * np.pi * i / 365))
            rows.append((site, d, float(max(1.0, level + rng.normal() * 8)), float(d.weekday()), float(d.month), base, "kind"))
    return spark.createDataFrame(rows, "site string, d date, v double, day double, month double, ips double, kind string").cache()


def accurate(df):
    r = A.error_metrics(df, [], "v", "prediction").first()
    return r.n > 0 and r.mae < 25 and r.mape < 30


def test_boosted_trees(history):
    cut = START + dt.timedelta(days=165)
    out = M.gbt_forecast(history.where(F.col("d") < F.lit(cut)), history.where(F.col("d") >= F.lit(cut)), ["day", "month", "ips"], "kind", "site", "v")
    assert out.count() == 70 and out.where("prediction < 0").count() == 0 and accurate(out)


def test_seasonal_regression(history):
    cut = START + dt.timedelta(days=165)
    train, test = history.where(F.col("d") < F.lit(cut)), history.where(F.col("d") >= F.lit(cut))
    out = M.seasonal_regression(train, test, "site", "d", "v", ["ips"])
    assert accurate(out.join(test.select("site", "d", "v"), ["site", "d"]))
    # the same ridge by stacked least squares
    known = sorted((r.d, r.v) for r in train.where("site = 'a'").collect())
    row = lambda d: [1.0, *(float(d.weekday() == i) for i in range(7)), np.sin(2 * np.pi * d.timetuple().tm_yday / 365.25), np.cos(2 * np.pi * d.timetuple().tm_yday / 365.25), 150.0]
    x, y = np.array([row(d) for d, _ in known]), np.array([v for _, v in known])
    scale = np.maximum(np.abs(x).max(0), 1e-9)
    penalty = np.sqrt(np.r_[1e-6, np.ones(x.shape[1] - 1)])
    w = np.linalg.lstsq(np.vstack([x / scale, np.diag(penalty)]), np.r_[y, np.zeros(x.shape[1])], rcond=None)[0]
    got = {r.d: r.prediction for r in out.where("site = 'a'").collect()}
    assert len(got) == 35 and all(abs(p - np.array(row(d)) / scale @ w) < 1e-6 * max(p, 1) for d, p in got.items())
    few = M.seasonal_regression(train.where(F.col("d") < F.lit(START + dt.timedelta(days=5))), test.limit(3), "site", "d", "v", [])
    assert few.count() == 3 and few.where("prediction is null").count() == 0


def test_weekday_autoregression(history):
    out = M.weekday_autoregression(history, "site", "d", "v")
    got = {(r.site, r.day, r.step): r.prediction for r in out.collect()}
    assert len(got) == 2 * 7 * 3
    rows = history.collect()
    for site, day in itertools.product("ab", range(7)):
        v = [r.v for r in sorted(rows, key=lambda r: r.d) if r.site == site and r.d.weekday() == day]
        x = np.array([[1.0, v[i - 1], v[i - 2], v[i - 3]] for i in range(3, len(v))])
        w = np.linalg.lstsq(np.vstack([x, np.sqrt(1e-3 * len(x)) * np.eye(4)]), np.r_[v[3:], np.zeros(4)], rcond=None)[0]
        last = v[-3:]
        for step in (1, 2, 3):
            p = float(np.clip(w @ [1.0, last[-1], last[-2], last[-3]], 0, 3 * max(v)))
            assert abs(got[site, day, step] - p) < 1e-6 * max(p, 1)
            last.append(p)
    nxt = [(r.site, START + dt.timedelta(days=r.d_), r.prediction) for r in out.where("step = 1").select("site", ((F.col("day") - 200 % 7 - START.weekday()) % 7 + 200).alias("d_"), "prediction").collect()]
    assert len(nxt) == 14 and all(0 < p < 700 for _, _, p in nxt)


@pytest.mark.parametrize("scope", [["site"], []])
def test_weights_against_a_grid(history, scope):
    """Both fits against the best of a grid on the simplex."""
    f = history.select("site", "d", "v", (F.col("v") * 0.8 + 10).alias("m1"), (F.col("v") * 1.3 - F.col("day") * 4).alias("m2"), (F.col("v") * 0.5 + 90).alias("m3"))
    models, rows = ["m1", "m2", "m3"], f.toPandas()
    grid = [np.array([a, b, 20 - a - b]) / 20 for a in range(21) for b in range(21 - a)]
    for fit in (M.fit_weights, M.fit_weights_by_sums):
        got = fit(f, scope, "v", models).toPandas()
        for key, own in rows.groupby("site") if scope else [(None, rows)]:
            w = got[got.site == key] if scope else got
            w = w.set_index("model").weight.reindex(models).to_numpy()
            mae = lambda x, own=own: np.abs(own[models].to_numpy() @ x - own.v.to_numpy()).mean()
            assert abs(w.sum() - 1) < 1e-9 and (w >= 0).all() and mae(w) <= 1.15 * min(map(mae, grid)) + 0.5
    few = M.fit_weights_by_sums(f.limit(5), scope, "v", models)
    assert {round(r.weight, 6) for r in few.collect()} == {round(1 / 3, 6)}


def test_cross_validated_weights(history):
    f = history.select("site", "d", "v", (F.col("v") + 1).alias("m1"), (F.col("v") * 2).alias("m2"))
    for by_sums in (False, True):
        w = {(r.site, r.model): r.weight for r in M.cross_validated_weights(f, "d", ["site"], "v", ["m1", "m2"], 3, 40, by_sums=by_sums).collect()}
        assert all(abs(w[s, "m1"] + w[s, "m2"] - 1) < 1e-9 and w[s, "m1"] > 0.9 for s in "ab")


def test_no_row_meets_its_own_label(spark):
    """Out-of-fold means of groups of one row, of a few, and of rows that repeat; without a value elsewhere the mean of other folds."""
    rng = np.random.default_rng(1)
    rows = [(f"one{i}", i, float(rng.integers(1, 1000))) for i in range(60)] + [("few", i, float(i * i)) for i in range(9)] + [("twice", 1, 7.0)] * 4 + [("null", 1, None)]
    df = spark.createDataFrame(rows, "s string, t int, v double")
    own = {(r.s, r.t): r for r in M.out_of_fold_means(df, ["s"], ["t"], "v", "e").withColumn("fold", F.pmod(F.xxhash64("s", "t"), F.lit(5))).collect()}
    assert len(own) == 60 + 9 + 2
    every = [(own[s, t].fold, s, v) for s, t, v in rows if v is not None]
    for (s, _), r in own.items():
        others = [v for f, k, v in every if f != r.fold and k == s] or [v for f, _, v in every if f != r.fold]
        assert abs(r.e - np.mean(others)) < 1e-9
    ones = [(r.v, r.e) for (s, _), r in own.items() if s.startswith("one")]
    assert abs(np.corrcoef(*zip(*ones, strict=True))[0, 1]) < 0.5  # with their own labels it would be 1
    back = {r.s: r.e for r in M.group_means(df, spark.createDataFrame([("few",), ("new",)], "s string"), ["s"], "v", "e").collect()}
    assert back["few"] == np.mean([i * i for i in range(9)]) and abs(back["new"] - np.mean([v for *_, v in every])) < 1e-9


def test_one_model_over_tenants(history, spark, tmp_path):
    own = history.withColumn("tenant", F.when(F.col("site") == "a", "t1").otherwise("t2")).withColumn("site", F.lit("s"))
    cut = START + dt.timedelta(days=165)
    out = M.gbt_forecast(own.where(F.col("d") < F.lit(cut)), own.where(F.col("d") >= F.lit(cut)), ["day", "month", "ips"], ["kind", "tenant"], ["tenant", "site"], "v")
    assert out.count() == 70 and accurate(out)
    assert all(abs(r.p - r.v) < 60 for r in out.groupBy("tenant").agg(F.avg("prediction").alias("p"), F.avg("v").alias("v")).collect())
