"""Rolling backtests against a refit of every cut-off on a copy of the history."""

import datetime as dt

import numpy as np
import pytest

from refectory.forecast import backtest as B
from refectory.forecast import regression as R
from refectory.operators import aggregates as A

START = dt.date(2023, 9, 4)


@pytest.fixture(scope="module")
def rows():
    """Two sites, one with gaps and an odd day of two rows, one that begins late; a third has few rows; some values are null."""
    rng = np.random.default_rng(3)
    out = []
    for site, base, first, open_ in (("a", 150.0, 0, lambda i: i % 11 != 3), ("b", 80.0, 45, lambda i: (START + dt.timedelta(i)).weekday() < 5), ("c", 30.0, 0, lambda i: i % 9 == 0)):
        for i in range(first, 150):
            if open_(i):
                d = START + dt.timedelta(days=i)
                out.append((site, d, float(base * (1 + 0.1 * d.weekday()) + rng.normal() * 5), float(i % 4)))
    out += [("a", START + dt.timedelta(days=60), 99.0, 1.0), ("b", START + dt.timedelta(days=61), None, 1.0), ("b", START + dt.timedelta(days=80), 70.0, None)]
    return out


@pytest.fixture(scope="module")
def history(spark, rows):
    return spark.createDataFrame(rows, "site string, d date, v double, r double").repartition(3).cache()


CUTS = {"regular": [70 + 7 * i for i in range(11)], "irregular": [71, 74, 90, 91, 140], "one": [100], "none": []}


def days(kind):
    return [START + dt.timedelta(days=i) for i in CUTS[kind]]


def cuts_of(spark, kind):
    return spark.createDataFrame([(d,) for d in days(kind)], "cutoff date")


def seasonal_row(d, r):
    angle = 2 * np.pi * d.timetuple().tm_yday / 365.25
    return [1.0, *(float(d.weekday() == i) for i in range(7)), np.sin(angle), np.cos(angle), r or 0.0]


def seasonal_refit(known, targets):
    y = np.array([v for _, _, v, _ in known])
    if len(known) < 10:
        return [max(y.mean(), 0.0)] * len(targets)
    x = np.array([seasonal_row(d, r) for _, d, _, r in known])
    scale = np.maximum(np.abs(x).max(0), 1e-9)
    a = x / scale
    w = np.linalg.solve(a.T @ a + np.diag([1e-6, *[1.0] * (x.shape[1] - 1)]), a.T @ y)
    return [max(float(np.array(seasonal_row(d, r)) / scale @ w), 0.0) for d, r in targets]


@pytest.mark.parametrize("kind", sorted(CUTS))
@pytest.mark.parametrize(("least", "fit"), [(50, 10), (1, 10)])
def test_seasonal(spark, rows, history, kind, least, fit):
    got = B.backtest_seasonal(history, "site", "d", "v", cuts_of(spark, kind), ["r"], (1, 10), least_rows=least, least_fit=fit)
    want = []
    for cut in days(kind):
        for site in "abc":
            own = [x for x in rows if x[0] == site and x[2] is not None]
            known = [x for x in own if x[1] <= cut]
            ahead = [x for x in own if 1 <= (x[1] - cut).days <= 10]
            if len(known) >= least:
                want += [(site, cut, x[1], (x[1] - cut).days, x[2], p) for x, p in zip(ahead, seasonal_refit(known, [(x[1], x[3]) for x in ahead]), strict=True)]
    got = sorted(tuple(r) for r in got.collect())
    assert [x[:5] for x in got] == [x[:5] for x in sorted(want)]
    assert all(abs(a[5] - b[5]) <= 1e-7 * max(1, b[5]) for a, b in zip(got, sorted(want), strict=True))


def ar_refit(v, site_mean, lags, steps, ridge=1e-3):
    if len(v) < 2 * lags + 2:
        return [float(np.mean(v)) if len(v) >= 2 else site_mean] * steps
    x = np.array([[1.0, *(v[i - k] for k in range(1, lags + 1))] for i in range(lags, len(v))])
    w = np.linalg.solve(x.T @ x + ridge * len(x) * np.eye(lags + 1), x.T @ np.array(v[lags:]))
    last, out = list(v), []
    for _ in range(steps):
        out.append(float(np.clip(w @ [1.0, *(last[-k] for k in range(1, lags + 1))], 0, 3 * max(v))))
        last.append(out[-1])
    return out


@pytest.mark.parametrize("kind", sorted(CUTS))
@pytest.mark.parametrize(("least", "lags", "horizon"), [(50, 3, (1, 21)), (1, 2, (3, 17))])
def test_weekday_ar(spark, rows, history, kind, least, lags, horizon):
    got = B.backtest_weekday_ar(history, "site", "d", "v", cuts_of(spark, kind), horizon, lags, least_rows=least)
    want = []
    for cut in days(kind):
        for site in "abc":
            own = sorted(x[1:3] for x in rows if x[0] == site and x[2] is not None)
            known = [x for x in own if x[0] <= cut]
            for day in range(7) if len(known) >= least else ():
                v = [x for d, x in known if d.weekday() == day]
                if v:
                    p = ar_refit(v, float(np.mean([x for _, x in known])), lags, 3)
                    want += [(site, cut, d, (d - cut).days, x, p[((d - cut).days - 1) // 7]) for d, x in own if d.weekday() == day and horizon[0] <= (d - cut).days <= horizon[1]]
    got = sorted(tuple(r) for r in got.collect())
    assert [x[:5] for x in got] == [x[:5] for x in sorted(want)]
    assert all(abs(a[5] - b[5]) <= 1e-7 * max(1, b[5]) for a, b in zip(got, sorted(want), strict=True))


def test_moving_average(spark, rows, history):
    for kind in CUTS:
        got = sorted(tuple(r) for r in B.backtest_moving_average(history.where("v is not null"), "site", "d", "v", cuts_of(spark, kind), (1, 9), 4).collect())
        want = []
        for cut in days(kind):
            for site in "abc":
                own = sorted(x[1:3] for x in rows if x[0] == site and x[2] is not None)
                known = [x for x in own if x[0] <= cut]
                for d, x in own if len(known) >= 50 else ():
                    last = [v for e, v in known if e.weekday() == d.weekday() and v > 0][-4:]
                    if 1 <= (d - cut).days <= 9 and last:
                        want.append((site, cut, d, (d - cut).days, x, float(np.mean(last))))
        assert [x[:5] for x in got] == [x[:5] for x in sorted(want)]
        assert all(abs(a[5] - b[5]) < 1e-9 * max(1, b[5]) for a, b in zip(got, sorted(want), strict=True))


def test_accuracy(spark):
    """Two sites over 200 days, the fixture that the accuracy limits are stated for."""
    rng = np.random.default_rng(42)
    own = []
    for site, base in (("a", 150.0), ("b", 320.0)):
        for i in range(200):
            d = START + dt.timedelta(days=i)
            own.append((site, d, float(max(1.0, base * (1 + 0.15 * np.cos(2 * np.pi * d.weekday() / 7) + 0.05 * np.sin(2 * np.pi * i / 365)) + rng.normal() * 8)), base))
    h = spark.createDataFrame(own, "site string, d date, v double, ips double").cache()
    cuts = B.cutoffs(h, "d")
    for df in (B.backtest_moving_average(h, "site", "d", "v", cuts), B.backtest_weekday_ar(h, "site", "d", "v", cuts), B.backtest_seasonal(h, "site", "d", "v", cuts, ["ips"])):
        r = A.error_metrics(df, [], "actual", "prediction").first()
        assert r.n > 700 and r.mae < 25 and r.mape < 30
    e = B.backtest_errors({"ma": B.backtest_moving_average(h, "site", "d", "v", cuts)}, ["site"]).collect()
    assert {(r.model, r.site) for r in e} == {("ma", "a"), ("ma", "b")} and all(r.mae < 25 and abs(r.bias) <= r.mae for r in e)


def test_sums_of_nothing(history):
    none = history.limit(0)
    assert R.weekday_autoregression(none, "site", "d", "v").count() == 0
    assert R.seasonal_regression(none, history.limit(3), "site", "d", "v", ["r"]).where("prediction = 0").count() == 3
