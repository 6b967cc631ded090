"""Features and forecasts on the driver's tables: quantities by supplier and day stand for attendance by site."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..forecast import backtest as B
from ..forecast import features as X
from ..forecast import models as M
from ..forecast.weights import least_error
from ..functions import calendar as C
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import windows as W
from ..session import staged, work_path
from .base import SQL, query, table
from .catering import OFF

COLS = X.Columns("site", "d", "v")
_ATT = "(SELECT l_suppkey % 20 AS site, CAST(l_shipdate AS DATE) AS d, sum(l_quantity) AS v FROM lineitem GROUP BY ALL)"
_WD = "CAST((dayofweek(d) + 6) % 7 AS INTEGER)"


def attendance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 20).alias("site"), F.to_date("l_shipdate").alias("d")).agg(F.sum("l_quantity").alias("v"))


@query(f"SELECT site, d, v, CASE WHEN count(v) OVER w = 42 THEN avg(v) OVER w END AS mean_42, CASE WHEN count(v) OVER x = 8 THEN avg(v) OVER x END AS day_mean_8 FROM {_ATT} WINDOW w AS (PARTITION BY site ORDER BY d ROWS 41 PRECEDING), x AS (PARTITION BY site, {_WD} ORDER BY d ROWS 7 PRECEDING)")
def rolling_mean_full_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rolling means in rows, null before the window is full."""
    a = W.full_window_mean(attendance(spark, sf_dir), ["site"], ["d"], "v", 42, "mean_42").withColumn("day", F.weekday("d"))
    return W.full_window_mean(a, ["site", "day"], ["d"], "v", 8, "day_mean_8").drop("day")


@query(f"""WITH l AS (SELECT site, d, v, lag(v, 21) OVER (PARTITION BY site ORDER BY d) AS s FROM {_ATT} WHERE site <> 3 UNION ALL SELECT 3, d, v, NULL FROM {_ATT} WHERE site = 3)
SELECT site, d, coalesce(s, first_value(s IGNORE NULLS) OVER (PARTITION BY site ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), (SELECT avg(s) FROM l)) AS shifted, avg(v) OVER (PARTITION BY site) AS site_mean FROM l""")
def lag_rows_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifts by rows, leading nulls filled from the group, else from all."""
    a = W.shifted(attendance(spark, sf_dir), ["site"], ["d"], "v", 21, "shifted").withColumn("shifted", F.when(F.col("site") == 3, None).otherwise(F.col("shifted")))
    return W.group_mean(W.back_filled(a, ["d"], {"shifted": ["site"]}), ["site"], "v", "site_mean").drop("v")


_IQR = f"SELECT site, {_WD} AS day, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3, stddev_samp(v) AS std FROM {_ATT} GROUP BY ALL"


@query(f"SELECT site, day, q1, median, q3, std, greatest(0, q1 - 1.5 * (q3 - q1)) AS lower, q3 + 1.5 * (q3 - q1) AS upper, (SELECT count(*) FROM {_ATT} a WHERE a.site = b.site AND {_WD} = b.day AND v BETWEEN greatest(0, q1 - 1.5 * (q3 - q1)) AND q3 + 1.5 * (q3 - q1)) AS kept FROM ({_IQR}) b")
def iqr_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles, bounds and how many rows are within."""
    a = attendance(spark, sf_dir).withColumn("day", F.weekday("d"))
    kept = X.without_outliers(a, COLS, factor=1.5).groupBy("site", "day").agg(F.count("*").alias("kept"))
    return A.iqr_bounds(a, ["site", "day"], "v", 1.5).join(kept, ["site", "day"], "left")


@query(f"WITH m AS (SELECT site, avg(v) AS mean_value FROM {_ATT} GROUP BY ALL), q AS (SELECT quantile_cont(mean_value, 0.25) AS a, quantile_cont(mean_value, 0.5) AS b, quantile_cont(mean_value, 0.75) AS c FROM m) SELECT site, mean_value, CASE WHEN mean_value <= a THEN 'XS' WHEN mean_value <= b THEN 'S' WHEN mean_value <= c THEN 'M' ELSE 'L' END AS group_size FROM m, q")
def size_quartiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A15."""
    return A.size_groups(attendance(spark, sf_dir), "site", "v")


@query(f"""WITH a AS (SELECT DISTINCT l_suppkey AS site, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE NOT (l_suppkey % 2 = 0 AND isodow(l_shipdate) > 5)),
y AS (SELECT site, d, CASE WHEN month(d) >= 8 THEN year(d) || '-' || (year(d) + 1) ELSE (year(d) - 1) || '-' || year(d) END AS school_year FROM a),
g AS (SELECT site, school_year, greatest(1.0, (max(d) - min(d) + 1) / 7) AS w, {", ".join(f"count(*) FILTER (isodow(d) = {i + 1}) AS c{i}" for i in range(7))} FROM y GROUP BY ALL)
SELECT site, school_year, {" || ".join(f"CASE WHEN c{i} / w >= 0.3 THEN '1' ELSE '0' END" for i in range(7))} AS opening_days FROM g""")
def opening_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M8, F16: weekdays on which a site is usually open, by school year from August."""
    from ..functions.scalars import school_year

    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("site"), F.to_date("l_shipdate").alias("d")).where(~((F.col("site") % 2 == 0) & (F.weekday("d") > 4)))
    return X.opening_pattern(li.withColumn("school_year", school_year(F.col("d"), 8)), COLS)


def zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(z, a, b) for z in (0, 1) for a, b in (OFF if z else OFF[:3])], "zone long, a string, b string").select("zone", F.to_date("a").alias("date_debut"), F.to_date("b").alias("date_fin"))


_ZONES = "(VALUES " + ", ".join(f"({z}, DATE '{a}', DATE '{b}')" for z in (0, 1) for a, b in (OFF if z else OFF[:3])) + ") AS p(zone, a, b)"


@query(f"""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, o_custkey % 3 AS zone FROM orders), j AS (SELECT d.d, d.zone, a, b, d BETWEEN a AND b AS i, a - d AS n, d - b AS m FROM d LEFT JOIN {_ZONES} ON d.zone = p.zone)
SELECT d, zone, coalesce(max(CAST(i AS INTEGER)), 0) AS is_holiday, CASE WHEN bool_or(i) THEN 0 ELSE least(30, coalesce(min(CASE WHEN n > 0 THEN n END), 30)) END AS days_before, CASE WHEN bool_or(i) THEN 0 ELSE least(30, coalesce(min(CASE WHEN m > 0 THEN m END), 30)) END AS days_after FROM j GROUP BY ALL""")
def holiday_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3, M4: days to and since holidays of a zone, 30 at most."""
    d = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d"), (F.col("o_custkey") % 3).alias("zone"))
    return C.holiday_distance(d, "d", "zone", zones(spark), "date_debut", "date_fin")


HOLIDAYS = ("1996-05-01", "1996-05-16", "1996-07-14", "1996-12-24", "1997-11-11", "1998-01-01")
_HOL = "(VALUES " + ", ".join(f"(DATE '{d}')" for d in HOLIDAYS) + ") AS h(day)"


@query(f"""WITH d AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY ALL), b AS (SELECT CASE isodow(day) WHEN 2 THEN day - 1 WHEN 4 THEN day + 1 END AS x FROM {_HOL})
SELECT d, n, CASE WHEN d IN (SELECT day FROM {_HOL}) THEN 1 ELSE 0 END AS is_public_holiday, CASE WHEN d IN (SELECT x FROM b WHERE x IS NOT NULL) THEN 1 ELSE 0 END AS is_bridge FROM d""")
def bridge_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: public holidays and the days that bridge them to a week-end."""
    d = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    h = spark.createDataFrame([(x,) for x in HOLIDAYS], "day string").select(F.to_date("day").alias("day"))
    return C.holiday_flags(d, "d", h, "day")


_N8 = f"SELECT site, {_WD} AS day, v, row_number() OVER (PARTITION BY site, {_WD} ORDER BY d DESC, v DESC) AS n FROM {_ATT} WHERE v > 0"


@query(f"""WITH c AS (SELECT site, {_WD} AS day, avg(v) AS cell FROM {_ATT} GROUP BY ALL), r AS (SELECT site, day, avg(v) AS recent FROM ({_N8}) WHERE n <= 8 GROUP BY ALL)
SELECT site, day, coalesce(recent, cell, (SELECT avg(cell) FROM c)) AS prediction FROM c LEFT JOIN r USING (site, day)""")
def moving_average_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11, W10."""
    return M.moving_average(attendance(spark, sf_dir).withColumn("day", F.weekday("d")), ["site"], "day", "d", "v")


@query(f"""WITH a AS (SELECT *, {_WD} AS day FROM {_ATT}), k AS (SELECT unnest(generate_series(min(d) + 70, max(d), INTERVAL 28 DAY))::DATE AS cutoff FROM a),
f AS (SELECT site, cutoff, day, v, row_number() OVER (PARTITION BY site, cutoff, day ORDER BY d DESC, v DESC) AS n FROM a JOIN k ON d <= cutoff WHERE v > 0),
p AS (SELECT site, cutoff, day, avg(v) AS prediction FROM f WHERE n <= 8 GROUP BY ALL), e AS (SELECT site, cutoff FROM a JOIN k ON d <= cutoff GROUP BY ALL HAVING count(*) >= 50)
SELECT site, cutoff, d AS target, CAST(d - cutoff AS INTEGER) AS horizon, v AS actual, prediction FROM a JOIN k ON d - cutoff BETWEEN 1 AND 21 JOIN e USING (site, cutoff) JOIN p USING (site, cutoff, day)""")
def backtest_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts at every fourth week's cut-off."""
    a = attendance(spark, sf_dir)
    return M.backtest_moving_average(a, "site", "d", "v", M.cutoffs(a, "d", 70, 28))


_CUTS = f"SELECT unnest(generate_series((SELECT min(d) FROM {_ATT}) + 70, (SELECT max(d) FROM {_ATT}), INTERVAL 28 DAY))::DATE AS cutoff"
_AR = f"(SELECT *, {_WD} AS day, lag(v, 1) OVER w AS lag_1, lag(v, 2) OVER w AS lag_2, lag(v, 3) OVER w AS lag_3 FROM {_ATT} WINDOW w AS (PARTITION BY site, {_WD} ORDER BY d))"


def _sql_sums(x: list[str], y: str) -> str:
    """The sums, to three places: they depend on the order of addition in the last digits."""
    pairs = [f"round(coalesce(sum(CAST({a} AS DOUBLE) * CAST({b} AS DOUBLE)), 0), 3) AS xx_{i}_{j}" for i, a in enumerate(x) for j, b in enumerate(x) if i <= j]
    return ", ".join([*pairs, *(f"round(coalesce(sum(CAST({a} AS DOUBLE) * CAST({y} AS DOUBLE)), 0), 3) AS xy_{i}" for i, a in enumerate(x))])


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 3) for c in df.columns if c.startswith(("xx_", "xy_"))})


_AR_FIT = [f"CASE WHEN lag_3 IS NOT NULL THEN {c} END" for c in ("1", "lag_1", "lag_2", "lag_3")]


@query(f"""WITH k AS ({_CUTS}) SELECT site, day, cutoff, count(*) AS n, sum(v) AS total, max(v) AS top, {_sql_sums(_AR_FIT, "v")} FROM {_AR} JOIN k ON d <= cutoff GROUP BY site, day, cutoff""")
def weekday_ar_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the autoregression's normal equations as of every fourth week's cut-off."""
    a = attendance(spark, sf_dir)
    return _rounded(B.weekday_ar_fits(a, "site", "d", "v", B.cutoffs(a, "d", 70, 28)).drop("last"))


REGRESSORS = ["mobile_mean_42_shifted_21", "month", "is_holiday"]
_SEASON = ["1", *(f"CASE WHEN {_WD} = {i} THEN 1 ELSE 0 END" for i in range(7)), "sin(2 * pi() * dayofyear(d) / 365.25)", "cos(2 * pi() * dayofyear(d) / 365.25)", "coalesce(s21, 0)", "month(d)", "is_holiday"]


def regressors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attendance with what is known of a day three weeks before: a mean of then, the month, and whether there are holidays."""
    a = W.full_window_mean(attendance(spark, sf_dir), ["site"], ["d"], "v", 42, "m")
    a = W.shifted(a, ["site"], ["d"], "m", 21, "mobile_mean_42_shifted_21").withColumn("month", F.month("d")).withColumn("zone", F.col("site") % 2)
    off = C.holiday_distance(a.select("d", "zone"), "d", "zone", zones(spark), "date_debut", "date_fin").select("d", "zone", "is_holiday")
    return a.join(off, ["d", "zone"]).select("site", "d", "v", *REGRESSORS)


_REG = f"""(WITH r AS (SELECT *, CASE WHEN count(v) OVER w = 42 THEN avg(v) OVER w END AS m FROM {_ATT} WINDOW w AS (PARTITION BY site ORDER BY d ROWS 41 PRECEDING))
SELECT site, d, v, lag(m, 21) OVER (PARTITION BY site ORDER BY d) AS s21, CASE WHEN EXISTS (SELECT 1 FROM {_ZONES} WHERE p.zone = site % 2 AND d BETWEEN a AND b) THEN 1 ELSE 0 END AS is_holiday FROM r)"""


@query(f"""WITH k AS ({_CUTS}) SELECT site, cutoff, count(*) AS n, sum(v) AS total, {", ".join(f"max(abs(CAST({x} AS DOUBLE))) AS top_{i}" for i, x in enumerate(_SEASON))}, {_sql_sums(_SEASON, "v")} FROM {_REG} JOIN k ON d <= cutoff GROUP BY site, cutoff""")
def seasonal_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of the seasonal regression's normal equations as of every fourth week's cut-off."""
    a = regressors(spark, sf_dir)
    return _rounded(B.seasonal_fits(a, "site", "d", "v", B.cutoffs(a, "d", 70, 28), REGRESSORS))


def backtests(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Every week's cut-off and forecasts of three weeks, by model."""
    a = staged(regressors(spark, sf_dir), "regressors")
    cuts = staged(B.cutoffs(a, "d"), "cutoffs")
    own = ("site", "d", "v", cuts)
    return {"moving_average": B.backtest_moving_average(a, *own), "weekday_ar": B.backtest_weekday_ar(a, *own), "seasonal": B.backtest_seasonal(a, *own, REGRESSORS)}


@query()
def backtest_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M12 for M11, M15 and M16: weekly cut-offs, three weeks ahead, forecasts a row."""
    return reduce(DataFrame.unionByName, [df.withColumn("model", F.lit(m)) for m, df in backtests(spark, sf_dir).items()])


@query(f"""WITH k AS (SELECT unnest(generate_series((SELECT min(d) FROM {_ATT}) + 70, (SELECT max(d) FROM {_ATT}), INTERVAL 7 DAY))::DATE AS cutoff), e AS (SELECT site, cutoff FROM {_ATT} JOIN k ON d <= cutoff GROUP BY ALL HAVING count(*) >= 50),
m AS (SELECT * FROM (VALUES ('moving_average', 0), ('weekday_ar', 1), ('seasonal', 2)) AS m(model, i)), t AS (SELECT site, d, v, d - cutoff AS h, cutoff FROM {_ATT} JOIN k ON d - cutoff BETWEEN 1 AND 21 JOIN e USING (site, cutoff)),
c AS (SELECT site AS own, {_WD} AS day, min(d) AS first, min(d) FILTER (v > 0) AS positive FROM {_ATT} GROUP BY ALL)
SELECT model, CAST(ceil(h / 7.0) AS INTEGER) AS week, count(*) AS n, count(DISTINCT (site, cutoff)) AS fits, avg(v) AS actual FROM t JOIN c ON site = own AND {_WD} = day CROSS JOIN m
WHERE CASE i WHEN 0 THEN positive <= cutoff WHEN 1 THEN first <= cutoff ELSE true END GROUP BY ALL""")
def backtest_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many days each model forecasts by week ahead, from how many fits, and what came; SQL can tell that without the fits."""
    every = reduce(DataFrame.unionByName, [df.withColumn("model", F.lit(m)) for m, df in backtests(spark, sf_dir).items()])
    return every.where("prediction is not null").groupBy("model", F.ceil(F.col("horizon") / 7).cast("int").alias("week")).agg(F.count("*").alias("n"), F.countDistinct("site", "cutoff").alias("fits"), F.avg("actual").alias("actual"))


def stored_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four made-up models' forecasts of each line's quantity, by site and horizon; some are missing."""
    li = table(spark, sf_dir, "lineitem")
    h = F.col("l_orderkey") % 28
    return li.select(
        (F.col("l_suppkey") % 20).alias("site"), F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("l"), h.alias("h"), F.col("l_quantity").alias("y"), F.to_date("l_shipdate").alias("d"),
        (F.col("l_quantity") + h * 0.25).alias("m1"), F.when(F.col("l_partkey") % 5 != 0, F.col("l_quantity") * 0.9).alias("m2"), (F.col("l_quantity") * 0.5 + 12.5).alias("m3"),
    )


_FC = "(SELECT l_suppkey % 20 AS site, l_orderkey AS k, l_linenumber AS l, l_orderkey % 28 AS h, l_quantity AS y, CAST(l_shipdate AS DATE) AS d, l_quantity + (l_orderkey % 28) * CAST(0.25 AS DOUBLE) AS m1, CASE WHEN l_partkey % 5 <> 0 THEN l_quantity * 0.9 END AS m2, l_quantity * 0.5 + 12.5 AS m3 FROM lineitem)"
_LONG = f"(SELECT site, k, l, h, y, d, model, prediction FROM (UNPIVOT {_FC} ON m1, m2, m3 INTO NAME model VALUE prediction))"


@query(f"""WITH w AS (SELECT * FROM (VALUES ('m1', 0.5), ('m2', 0.3), ('m3', 0.2)) AS g(model, weight)), s AS (SELECT * FROM (VALUES (4, 'm1', 0.1), (4, 'm3', 0.9)) AS x(site, model, weight)),
j AS (SELECT f.*, CAST(coalesce(s.weight, w.weight, 1) AS DOUBLE) AS wt FROM {_LONG} f LEFT JOIN s ON f.site = s.site AND f.model = s.model LEFT JOIN w ON f.model = w.model),
p AS (SELECT site, k, l, h, sum(wt * prediction) / sum(wt) AS prediction FROM j GROUP BY ALL) SELECT site, h, count(*) AS n, avg(prediction) AS prediction FROM p GROUP BY ALL""")
def ensemble_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of the site, else of all, over the models that are there."""
    long = M.long_form(stored_forecasts(spark, sf_dir), ["site", "k", "l", "h", "y", "d"], ["m1", "m2", "m3"])
    wide = spark.createDataFrame([("m1", 0.5), ("m2", 0.3), ("m3", 0.2)], "model string, weight double")
    own = spark.createDataFrame([(4, "m1", 0.1), (4, "m3", 0.9)], "site long, model string, weight double")
    p = M.apply_weights(long, ["site", "k", "l", "h"], [(own, ["site"]), (wide, [])])
    return p.groupBy("site", "h").agg(F.count("*").alias("n"), F.avg("prediction").alias("prediction"))


@query(f"SELECT site, model, avg(abs(prediction - y)) AS mae, sqrt(avg((prediction - y) ^ 2)) AS rmse, avg(CASE WHEN y <> 0 THEN abs((prediction - y) / y) * 100 END) AS mape, avg(prediction - y) AS bias, count(*) AS n, avg(abs(prediction - y)) / greatest(avg(y), 1.0) AS smae FROM {_LONG} GROUP BY ALL")
def error_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by site and model."""
    return A.error_metrics(M.long_form(stored_forecasts(spark, sf_dir), ["site", "k", "l", "h", "y", "d"], ["m1", "m2", "m3"]), ["site", "model"], "y", "prediction")


@query(f"SELECT coalesce(CAST(site AS VARCHAR), '(all)') AS site, coalesce(model, '(all)') AS model, coalesce(b, '(all)') AS b, avg(abs(prediction - y)) AS mae, sqrt(avg((prediction - y) ^ 2)) AS rmse, count(*) AS n FROM (SELECT *, CASE WHEN h <= 7 THEN '<=7' WHEN h <= 14 THEN '<=14' WHEN h <= 21 THEN '<=21' ELSE '>21' END AS b FROM {_LONG}) GROUP BY GROUPING SETS ((model), (model, b), (site, model), (site, model, b))")
def metrics_grouping_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by model, bin, site and all of them in one pass."""
    from ..functions.scalars import horizon_bin

    f = M.long_form(stored_forecasts(spark, sf_dir), ["site", "k", "l", "h", "y", "d"], ["m1", "m2", "m3"]).withColumn("b", horizon_bin(F.col("h")))
    return A.metrics_by_sets(f, ["site", "model", "b"], [["model"], ["model", "b"], ["site", "model"], ["site", "model", "b"]], "y", "prediction")


@query(f"""WITH m AS (SELECT site, {_WD} AS day, model, avg(abs(prediction - y)) AS mae FROM {_LONG} GROUP BY ALL), b AS (SELECT site, day, arg_min(model, (mae, model)) AS best_model, min(mae) AS mae FROM m GROUP BY ALL)
SELECT day, best_model, count(*) AS wins, avg(mae) AS mae FROM b GROUP BY ALL""")
def best_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each model is the best, by weekday."""
    f = M.long_form(stored_forecasts(spark, sf_dir), ["site", "k", "l", "h", "y", "d"], ["m1", "m2", "m3"]).withColumn("day", F.weekday("d"))
    m = A.error_metrics(f, ["site", "day", "model"], "y", "prediction")
    best = m.groupBy("site", "day").agg(F.min_by("model", F.struct("mae", "model")).alias("best_model"), F.min("mae").alias("mae"))
    return best.groupBy("day", "best_model").agg(F.count("*").alias("wins"), F.avg("mae").alias("mae"))


@query(f"SELECT site, sum(abs(m1 - y)) / greatest(sum(abs(m3 - y)), 1e-9) AS mase FROM {_FC} GROUP BY ALL")
def scaled_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error scaled by a naive forecast's."""
    return A.mase(stored_forecasts(spark, sf_dir), ["site"], "y", "m1", "m3")


@query(f"""WITH s AS (SELECT site, l, model, h, prediction, y, row_number() OVER (PARTITION BY site, l, model ORDER BY h, prediction, k) AS n FROM {_LONG} WHERE y > 0)
SELECT site, l, max(CASE WHEN model = 'm1' THEN prediction END) AS m1, max(CASE WHEN model = 'm2' THEN prediction END) AS m2, max(CASE WHEN model = 'm3' THEN prediction END) AS m3 FROM s WHERE n = 1 GROUP BY ALL""")
def evaluation_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts of the shortest horizon, a column a model."""
    f = M.long_form(stored_forecasts(spark, sf_dir), ["site", "k", "l", "h", "y", "d"], ["m1", "m2", "m3"]).select("site", "l", "model", F.col("h").alias("horizon"), "prediction", F.col("y").alias("actual"))
    return M.evaluation_frame(f, ["site", "l"], ["m1", "m2", "m3"]).drop("actual")


@query()
def ensemble_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights fitted by site over past stretches, and the dominant model."""
    w = M.cross_validated_weights(stored_forecasts(spark, sf_dir), "d", ["site"], "y", ["m1", "m2", "m3"], 3, 200, by_sums=True)
    return w.join(M.dominant(w, ["site"]).select("site", F.col("model").alias("dominant")), "site")


@query()
def ensemble_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights by size group over past stretches, formed from sums, and the dominant model."""
    f = stored_forecasts(spark, sf_dir)
    f = f.join(A.size_groups(f, "site", "y").select("site", "group_size"), "site")
    w = M.cross_validated_weights(f, "d", ["group_size"], "y", ["m1", "m2", "m3"], 2, 400, by_sums=True)
    return w.join(M.dominant(w, ["group_size"]).select("group_size", F.col("model").alias("dominant")), "group_size")


_GRID = "(SELECT a.range / 50.0 AS w1, b.range / 50.0 AS w2, (50 - a.range - b.range) / 50.0 AS w3 FROM range(51) a, range(51) b WHERE a.range + b.range <= 50)"


def _best_of_grid(scope: str, rows: str, error: str) -> str:
    """DuckDB: the least error by scope that any weights of the grid of 0.02 give."""
    return f"SELECT {scope}, n, round(min(error), 6) AS error, true AS best FROM (SELECT {scope}, w1, w2, count(*) AS n, {error} AS error FROM ({rows}), {_GRID} WHERE m2 IS NOT NULL GROUP BY ALL) GROUP BY ALL"


_MISS = "abs(w1 * m1 + w2 * m2 + w3 * m3 - y)"


def _errors(w: DataFrame, scope: str) -> DataFrame:
    """best: no vector of the grid is better."""
    return w.groupBy(scope, "n").agg(F.round(F.min("error"), 6).alias("error"), (F.max("gap") < 1e-7).alias("best"))


@query(_best_of_grid("site", f"SELECT *, greatest(avg(y) OVER (PARTITION BY site), 1.0) AS size FROM {_FC}", f"avg({_MISS} / size)"))
def ensemble_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The error, scaled by the site's mean, that the weights found for each site reach."""
    f = W.group_mean(stored_forecasts(spark, sf_dir), ["site"], "y", "size")
    return _errors(least_error(f, ["site"], "y", ["m1", "m2", "m3"], F.greatest("size", F.lit(1.0)), step=0.02), "site")


@query(_best_of_grid("bin", f"SELECT *, h // 7 AS bin, avg(y) FILTER (m2 IS NOT NULL) OVER (PARTITION BY h // 7) AS mean FROM {_FC}", f"avg({_MISS}) / avg(abs(coalesce(CASE WHEN k % 3 <> 0 THEN m1 END, mean) - y))"))
def ensemble_naive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by horizon bin, scaled by a naive forecast's error, where missing ones are the bin's mean."""
    f = stored_forecasts(spark, sf_dir).withColumn("bin", F.floor(F.col("h") / 7)).withColumn("plain", F.when(F.col("k") % 3 != 0, F.col("m1")))
    return _errors(least_error(f, ["bin"], "y", ["m1", "m2", "m3"], naive="plain", step=0.02), "bin")


@query(SQL["backtest_cutoffs"])
def backtest_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backtest that goes on after the last cut-off of an earlier run gives what one run gives."""
    a = attendance(spark, sf_dir)
    cuts = M.cutoffs(a, "d", 70, 28)
    middle = a.agg(F.date_add(F.min("d"), F.floor(F.datediff(F.max("d"), F.min("d")) / 2).cast("int")).alias("middle"))
    store = staged(M.backtest_moving_average(a, "site", "d", "v", cuts.crossJoin(middle).where("cutoff <= middle").drop("middle")), "store")
    return store.unionByName(M.backtest_moving_average(a, "site", "d", "v", M.resumed(cuts, store)))


@query(f"""WITH k AS (SELECT site, arg_max(v, d) AS v FROM {_ATT} GROUP BY ALL), f AS (SELECT site, v, unnest(generate_series(DATE '1998-06-01', DATE '1998-06-14', INTERVAL 1 DAY))::DATE AS d FROM k)
SELECT f.site, f.d, coalesce(a.v, CASE WHEN f.site % 2 = 0 THEN f.v END) AS v FROM f LEFT JOIN {_ATT} a ON a.site = f.site AND a.d = f.d""")
def known_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days to be forecast that the history already knows."""
    a = attendance(spark, sf_dir)
    future = X.future_frame(a, COLS, "1998-06-01", 14, ["v"]).select("site", "d", F.when(F.col("site") % 2 == 0, F.col("v")).alias("v"))
    return M.fill_known(future, a, ["site", "d"], "v")


@query(f"""WITH c AS (SELECT site, {_WD} AS day, avg(v) AS cell FROM {_ATT} GROUP BY ALL), r AS (SELECT site, day, avg(v) AS recent FROM ({_N8}) WHERE n <= 8 GROUP BY ALL)
SELECT 't' || site % 3 AS tenant, site, day, coalesce(recent, cell, (SELECT avg(cell) FROM c)) AS prediction FROM c LEFT JOIN r USING (site, day)""")
def tenant_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts over all tenants' sites, written by tenant and read back."""
    p = M.moving_average(attendance(spark, sf_dir).withColumn("day", F.weekday("d")), ["site"], "day", "d", "v")
    sites = p.select("site", F.concat(F.lit("t"), (F.col("site") % 3).cast("string")).alias("tenant")).distinct()
    at = work_path(spark, "tenants")
    M.route_by_tenant(p, sites, "site", "tenant", at)
    return spark.read.parquet(at)


def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = spark.createDataFrame([(x,) for x in HOLIDAYS], "date string").select(F.to_date("date").alias("date"))
    return X.prepare(attendance(spark, sf_dir).withColumn("zone", F.col("site") % 2), COLS, "1998-07-01", "zone", zones(spark), h)


_BACK = lambda c, g: f"coalesce({c}, first_value({c} IGNORE NULLS) OVER (PARTITION BY {g} ORDER BY d ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), (SELECT avg({c}) FROM l)) AS {c}"


@query(f"""WITH c AS (SELECT *, {_WD} AS day FROM {_ATT} WHERE d <= DATE '1998-07-01' AND v > 1),
r AS (SELECT *, CASE WHEN count(v) OVER w = 42 THEN avg(v) OVER w END AS mobile_mean_42, CASE WHEN count(v) OVER x = 8 THEN avg(v) OVER x END AS daily_mobile_mean_8, avg(v) OVER (PARTITION BY site, day) AS weekday_mean FROM c
  WINDOW w AS (PARTITION BY site ORDER BY d ROWS 41 PRECEDING), x AS (PARTITION BY site, day ORDER BY d ROWS 7 PRECEDING)),
l AS (SELECT *, lag(mobile_mean_42, 21) OVER s AS mobile_mean_42_shifted_21, lag(mobile_mean_42, 35) OVER s AS mobile_mean_42_shifted_35, lag(daily_mobile_mean_8, 4) OVER t AS daily_mobile_mean_8_shifted_4, lag(daily_mobile_mean_8, 6) OVER t AS daily_mobile_mean_8_shifted_6 FROM r
  WINDOW s AS (PARTITION BY site ORDER BY d), t AS (PARTITION BY site, day ORDER BY d)),
f AS (SELECT site, d, v, day, mobile_mean_42, daily_mobile_mean_8, weekday_mean, {_BACK('mobile_mean_42_shifted_21', 'site')}, {_BACK('mobile_mean_42_shifted_35', 'site')}, {_BACK('daily_mobile_mean_8_shifted_4', 'site, day')}, {_BACK('daily_mobile_mean_8_shifted_6', 'site, day')} FROM l),
p AS (SELECT *, site % 2 AS zone, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, CASE WHEN month(d) >= 8 THEN year(d) || '-' || (year(d) + 1) ELSE (year(d) - 1) || '-' || year(d) END AS school_year FROM f),
j AS (SELECT k.d, k.zone, a, b, k.d BETWEEN a AND b AS i, a - k.d AS n, k.d - b AS m FROM (SELECT DISTINCT d, zone FROM p) k LEFT JOIN {_ZONES} ON k.zone = p.zone),
h AS (SELECT d, zone, coalesce(max(CAST(i AS INTEGER)), 0) AS is_holiday, CASE WHEN bool_or(i) THEN 0 ELSE least(30, coalesce(min(CASE WHEN n > 0 THEN n END), 30)) END AS days_before, CASE WHEN bool_or(i) THEN 0 ELSE least(30, coalesce(min(CASE WHEN m > 0 THEN m END), 30)) END AS days_after FROM j GROUP BY ALL),
q AS (SELECT p.*, is_holiday, CAST(days_before AS INTEGER) AS days_before, CAST(days_after AS INTEGER) AS days_after, CASE WHEN p.d IN (SELECT day FROM {_HOL}) THEN 1 ELSE 0 END AS is_public_holiday,
  CASE WHEN p.d IN (SELECT CASE isodow(day) WHEN 2 THEN day - 1 WHEN 4 THEN day + 1 END FROM {_HOL} WHERE isodow(day) IN (2, 4)) THEN 1 ELSE 0 END AS is_bridge FROM p JOIN h ON p.d = h.d AND p.zone = h.zone),
e AS (SELECT site, day FROM (SELECT *, avg(n) OVER (PARTITION BY site) AS mean FROM (SELECT site, day, count(*) AS n FROM q GROUP BY site, day)) WHERE n >= mean / 4),
g AS (SELECT q.* FROM q SEMI JOIN e USING (site, day)),
b AS (SELECT site, day, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM g GROUP BY ALL),
o AS (SELECT g.* FROM g JOIN b USING (site, day) WHERE v BETWEEN greatest(0, q1 - 2.5 * (q3 - q1)) AND q3 + 2.5 * (q3 - q1)),
w AS (SELECT site, school_year, greatest(1.0, (max(d) - min(d) + 1) / 7) AS w, {", ".join(f"count(*) FILTER (isodow(d) = {i + 1}) AS c{i}" for i in range(7))} FROM o GROUP BY ALL),
u AS (SELECT site, school_year, {" || ".join(f"CASE WHEN c{i} / w >= 0.3 THEN '1' ELSE '0' END" for i in range(7))} AS opening_days FROM w),
m AS (SELECT site, avg(v) AS mean_value FROM o GROUP BY ALL), z AS (SELECT quantile_cont(mean_value, 0.25) AS a, quantile_cont(mean_value, 0.5) AS b, quantile_cont(mean_value, 0.75) AS c FROM m)
SELECT o.*, opening_days, CASE WHEN is_holiday = 1 OR is_public_holiday = 1 THEN 0 ELSE CAST(substr(opening_days, day + 1, 1) AS INTEGER) END AS is_day_usually_open, CASE WHEN mean_value <= z.a THEN 'XS' WHEN mean_value <= z.b THEN 'S' WHEN mean_value <= z.c THEN 'M' ELSE 'L' END AS group_size
FROM o JOIN u USING (site, school_year) JOIN m USING (site), z""")
def prepared_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1, M2, M6: the whole feature frame."""
    return prepared(spark, sf_dir)


#: Features of the boosted trees: the rolling means as known 21 or 35 days before.
NUMERIC = ["year", "month", "day", "weekday_mean", "is_holiday", "is_public_holiday", "is_bridge", "days_before", "days_after", "ips", "is_day_usually_open"]
VARIANTS = {21: ["mobile_mean_42_shifted_21", "daily_mobile_mean_8_shifted_4"], 35: ["mobile_mean_42_shifted_35", "daily_mobile_mean_8_shifted_6"]}
SCHOOLS = ("nursery", "primary", "college")


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature frame with the index of each site's year, its school type, and a tenant."""
    index = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 20).alias("site"), (1995 + F.col("s_suppkey") % 3).cast("int").alias("year"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("ips"))
    p = J.by_year_or_latest(prepared(spark, sf_dir), index, "site", "year", "ips", 100.0)
    kind = F.element_at(F.array(*(F.lit(x) for x in SCHOOLS)), (F.col("site") % 3 + 1).cast("int"))
    return staged(p.withColumn("kind", kind).withColumn("tenant", F.concat(F.lit("t"), (F.col("site") % 4).cast("string"))), "prepared")


def _forecast(spark: SparkSession, sf_dir: str, variant: int) -> DataFrame:
    from ..operators.rows import split_by_date

    train, test = split_by_date(indexed(spark, sf_dir), "d", variant)
    return M.gbt_forecast(train, test, [*NUMERIC, *VARIANTS[variant]], "kind", "site", "v").select("site", "d", "v", "prediction")


@query()
def gbt_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees over all sites, for the last 35 days, from what is known 35 days before."""
    return _forecast(spark, sf_dir, 35)


@query()
def gbt_forecast_21(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the last 21 days."""
    return _forecast(spark, sf_dir, 21)


@query(f"SELECT site, count(*) AS n, sum(v) AS total, true AS apart FROM {_ATT} GROUP BY ALL")
def target_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each site's out-of-fold means are what is left of its labels without a fold of five, none with its own fold."""
    a = attendance(spark, sf_dir).withColumn("v", F.col("v").cast("double"))
    e = M.out_of_fold_means(a, ["site"], ["d"], "v", "mean").withColumn("fold", F.pmod(F.xxhash64("site", "d"), F.lit(5)))
    folds = e.groupBy("site", "fold").agg(F.count("*").alias("n"), F.sum("v").alias("total"), F.min("mean").alias("lo"), F.max("mean").alias("hi"))
    every = folds.groupBy("site").agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.collect_list(F.struct("n", "total", "lo", "hi")).alias("folds"))
    right = F.forall("folds", lambda f: F.abs(f["lo"] * (F.col("n") - f["n"]) - (F.col("total") - f["total"])) + F.abs(f["hi"] - f["lo"]) * F.col("n") < 1e-6 * F.col("total"))
    return every.select("site", "n", "total", right.alias("apart"))


@query(f"""WITH c AS (SELECT *, CAST((SELECT max(d) FROM ({SQL["prepared_features"]})) - d AS INTEGER) AS back FROM ({SQL["prepared_features"]}))
SELECT 't' || site % 4 AS tenant, count(*) AS n, count(DISTINCT site) AS sites, sum(v) AS actual, true AS whole FROM c WHERE back < 35 GROUP BY ALL""")
def tenant_gbt_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One boosted model over all tenants, sites encoded within their tenant, forecasts written and read by tenant."""
    from ..operators.rows import split_by_date

    own = indexed(spark, sf_dir)
    train, test = split_by_date(own, "d", 35)
    p = M.gbt_forecast(train, test, [*NUMERIC, *VARIANTS[35]], ["kind", "tenant"], ["tenant", "site"], "v").select("site", "d", "v", "prediction")
    at = work_path(spark, "tenants")
    M.route_by_tenant(p, own.select("site", "tenant"), "site", "tenant", at)
    back = spark.read.parquet(at).groupBy("tenant")
    return back.agg(F.count("*").alias("n"), F.countDistinct("site").alias("sites"), F.sum("v").alias("actual"), F.min(F.coalesce(F.col("prediction") >= 0, F.lit(False))).alias("whole"))


@query()
def weekday_ar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M15, X2."""
    return M.weekday_autoregression(attendance(spark, sf_dir), "site", "d", "v")


@query()
def seasonal_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 35 days from those before."""
    from ..operators.rows import split_by_date

    train, test = split_by_date(staged(prepared(spark, sf_dir), "prepared"), "d", 35)
    return M.seasonal_regression(train, test, "site", "d", "v", ["mobile_mean_42_shifted_21", "weekday_mean", "is_holiday", "is_public_holiday"])


@query(f"""WITH k AS (SELECT site, arg_max(v, d) AS v FROM {_ATT} GROUP BY ALL), f AS (SELECT site, v, unnest(generate_series(DATE '1998-08-01', DATE '1998-08-14', INTERVAL 1 DAY))::DATE AS d FROM k)
SELECT site, v, d, {_WD} AS day, CAST(d - DATE '1998-08-01' + 1 AS INTEGER) AS horizon FROM f""")
def future_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each site's next fortnight with its last known value."""
    return X.future_frame(attendance(spark, sf_dir), COLS, "1998-08-01", 14, ["v"])


@query("""WITH e AS (SELECT s_nationkey AS site, 1995 + s_suppkey % 3 AS y, max(CASE WHEN s_acctbal > 0 THEN s_acctbal END) AS ips FROM supplier WHERE s_nationkey < 15 GROUP BY ALL),
l AS (SELECT site, arg_max(ips, y) AS latest FROM e WHERE ips IS NOT NULL GROUP BY ALL)
SELECT n_nationkey AS site, y.y AS y, coalesce(e.ips, latest, 100.0) AS ips FROM nation CROSS JOIN (VALUES (1995), (1996), (1997), (1998)) AS y(y) LEFT JOIN e ON e.site = n_nationkey AND e.y = y.y LEFT JOIN l ON l.site = n_nationkey""")
def index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of a site and year, else its latest, else a constant."""
    s = table(spark, sf_dir, "supplier").where("s_nationkey < 15").select(F.col("s_nationkey").alias("site"), (1995 + F.col("s_suppkey") % 3).cast("int").alias("y"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("ips"))
    years = spark.createDataFrame([(y,) for y in range(1995, 1999)], "y int")
    all_ = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("site")).crossJoin(F.broadcast(years))
    return J.by_year_or_latest(all_, s, "site", "y", "ips", 100.0)
