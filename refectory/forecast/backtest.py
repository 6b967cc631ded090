"""Rolling backtests (M12, T7): every cut-off's forecasts from what was known by then, without a copy of the history for each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import regression as R


def cutoffs(history: DataFrame, date: str, first_after_days: int = 70, every: int = 7) -> DataFrame:
    """Cut-off days from the first day plus ten weeks to the last, weekly."""
    span = history.agg(F.date_add(F.min(F.to_date(date)), first_after_days).alias("a"), F.max(F.to_date(date)).alias("b")).where("a <= b")
    return span.select(F.explode(F.sequence("a", "b", F.expr(f"interval {every} days"))).alias("cutoff"))


def resumed(cuts: DataFrame, store: DataFrame | None) -> DataFrame:
    """The cut-offs after the last one that the store has; all where it has none."""
    if store is None:
        return cuts
    done = store.agg(F.max("cutoff").alias("__done"))
    return cuts.crossJoin(done).where(F.col("__done").isNull() | (F.col("cutoff") > F.col("__done"))).drop("__done")


def grid(cuts: DataFrame) -> DataFrame:
    """One row: first and last cut-off, and the days between two, 1 if they aren't regular."""
    gaps = cuts.groupBy().agg(F.array_sort(F.collect_set("cutoff")).alias("c"))
    apart = gaps.select(F.get("c", F.lit(0)).alias("__a"), F.get("c", F.size("c") - 1).alias("__b"), F.transform("c", lambda x: F.datediff(x, F.col("c")[0])).alias("at"))
    step = F.coalesce(F.get("at", F.lit(1)), F.lit(1))
    return apart.select("__a", "__b", F.when(F.forall("at", lambda x: x % step == 0), step).otherwise(1).alias("__step"))


def at_or_after(day: Column) -> Column:
    """The first day of the grid (columns of grid()) from `day` on."""
    return F.date_add(F.col("__a"), (F.ceil(F.greatest(F.datediff(day, F.col("__a")), F.lit(0)) / F.col("__step")) * F.col("__step")).cast("int"))


def with_cutoffs(df: DataFrame, first: Column, last: Column, cuts: DataFrame) -> DataFrame:
    """df with column cutoff: a row for each cut-off from first to last (null: no end). They are counted out on the grid, not compared."""
    on = df.crossJoin(F.broadcast(grid(cuts))).withColumn("__from", at_or_after(first)).withColumn("__to", F.least(F.coalesce(last, F.col("__b")), F.col("__b")))
    own = on.where("__from <= __to").withColumn("cutoff", F.explode(F.sequence("__from", "__to", F.make_interval(days=F.col("__step")))))
    return own.drop("__from", "__to", "__a", "__b", "__step").join(cuts, "cutoff", "left_semi")


def running(df: DataFrame, keys: list[str], cuts: DataFrame, total: list[str], top: list[str], last: list[str]) -> DataFrame:
    """df (keys, __at: a day of the grid, ...) with a row for each group and day that has anything -> a row for each group and cut-off since.

    Columns of total are summed up, of top their maximum and of last their latest value kept, from the group's first day to the cut-off.
    """
    span = df.groupBy(*keys).agg(F.min("__at").alias("__first"))
    every = span.crossJoin(F.broadcast(grid(cuts))).where("__first <= __b").select(*keys, F.explode(F.sequence("__first", "__b", F.make_interval(days=F.col("__step")))).alias("__at"))
    w = Window.partitionBy(*keys).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    cols = [*(F.sum(c).over(w).alias(c) for c in total), *(F.max(c).over(w).alias(c) for c in top), *(F.last(c, True).over(w).alias(c) for c in last)]
    return every.join(df, [*keys, "__at"], "left").select(*keys, F.col("__at").alias("cutoff"), *cols).join(cuts, "cutoff", "left_semi").select(*keys, "cutoff", *total, *top, *last)


def on_grid(rows: DataFrame, day: str, cuts: DataFrame) -> DataFrame:
    """rows that some cut-off knows, with __at: the first day of the grid that does."""
    on = rows.crossJoin(F.broadcast(grid(cuts)))
    return on.withColumn("__at", at_or_after(F.col(day))).where("__at <= __b").drop("__a", "__b", "__step")


def scored(forecasts: DataFrame, history: DataFrame, site: str, date: str, value: str) -> DataFrame:
    """forecasts (site, cutoff, target, prediction) with the target's actual value, one row for each of the history's."""
    actual = history.select(site, F.to_date(date).alias("target"), F.col(value).alias("actual")).where("actual is not null")
    return forecasts.join(actual, [site, "target"]).select(site, "cutoff", "target", F.datediff("target", "cutoff").alias("horizon"), "actual", "prediction")


def backtest_moving_average(history: DataFrame, site: str, date: str, value: str, cuts: DataFrame, horizon: tuple[int, int] = (1, 21), n: int = 8, least_rows: int = 50) -> DataFrame:
    """M12 with M11: for every cut-off, forecasts of the days in the horizon from what was known by then.

    Only the last n positive values of each weekday matter, so each row is dealt to the cut-offs it serves: from its day until the day
    before the n-th later value. Sites with fewer rows than least_rows by then are left out.
    """
    h = history.select(site, F.to_date(date).alias("d"), F.col(value).alias("v")).withColumn("day", F.weekday("d"))
    w = Window.partitionBy(site, "day").orderBy("d", "v")
    serving = h.where("v > 0").withColumn("until", F.date_sub(F.lead("d", n).over(w), 1))
    fit = with_cutoffs(serving, F.col("d"), F.col("until"), cuts).groupBy(site, "cutoff", "day").agg(F.avg("v").alias("prediction"))
    seen = on_grid(h, "d", cuts).groupBy(site, "__at").agg(F.count("*").alias("seen"))
    enough = running(seen, [site], cuts, ["seen"], [], []).where(F.col("seen") >= least_rows)
    actual = with_cutoffs(h, F.date_sub("d", horizon[1]), F.date_sub("d", horizon[0]), cuts)
    out = actual.join(enough.select(site, "cutoff"), [site, "cutoff"], "left_semi").join(fit, [site, "cutoff", "day"])
    return out.select(site, "cutoff", F.col("d").alias("target"), F.datediff("d", "cutoff").alias("horizon"), F.col("v").alias("actual"), "prediction")


def weekday_ar_fits(history: DataFrame, site: str, date: str, value: str, cuts: DataFrame, lags: int = 3) -> DataFrame:
    """M12 with M15: by site, weekday and cut-off the sums of the fit (regression.ar_sums) over all values up to the cut-off.

    They are summed up once between two cut-offs and then run on from cut-off to cut-off.
    """
    names = R.sum_names(lags + 1)
    own = on_grid(R.lagged(history, site, date, value, lags), "d", cuts).groupBy(site, "day", "__at").agg(*R.ar_sums(lags))
    return running(own, [site, "day"], cuts, ["n", "total", *names], ["top"], ["last"])


def backtest_weekday_ar(history: DataFrame, site: str, date: str, value: str, cuts: DataFrame, horizon: tuple[int, int] = (1, 21), lags: int = 3, ridge: float = 1e-3, least_rows: int = 50) -> DataFrame:
    """M12 with M15: for every cut-off, forecasts of the next days of each weekday, from the fit as of the cut-off."""
    fits = weekday_ar_fits(history, site, date, value, cuts, lags)
    whole = Window.partitionBy(site, "cutoff")
    cells = fits.withColumn("__rows", F.sum("n").over(whole)).withColumn("site_mean", F.sum("total").over(whole) / F.col("__rows")).where(F.col("__rows") >= least_rows)
    p = R.ar_predictions(cells, [site, "day", "cutoff"], lags, -(-horizon[1] // 7), ridge)
    ahead = F.pmod(F.col("day") - F.weekday("cutoff") - 1, F.lit(7)) + 1 + 7 * (F.col("step") - 1)
    p = p.where(ahead.between(*horizon)).select(site, "cutoff", F.date_add("cutoff", ahead.cast("int")).alias("target"), "prediction")
    return scored(p, history, site, date, value)


def seasonal_fits(history: DataFrame, site: str, date: str, value: str, cuts: DataFrame, regressors: list[str]) -> DataFrame:
    """M12 with M16: by site and cut-off the sums of the fit (regression.seasonal_sums) over all rows up to the cut-off."""
    k = 10 + len(regressors)
    own = on_grid(history.where(F.col(value).isNotNull()).withColumn("__d", F.to_date(date)), "__d", cuts).groupBy(site, "__at").agg(*R.seasonal_sums(date, value, regressors))
    return running(own, [site], cuts, ["n", "total", *R.sum_names(k)], [f"top_{i}" for i in range(k)], [])


def backtest_seasonal(history: DataFrame, site: str, date: str, value: str, cuts: DataFrame, regressors: list[str], horizon: tuple[int, int] = (1, 21), ridge: float = 1.0, least_rows: int = 50, least_fit: int = 10) -> DataFrame:
    """M12 with M16: for every cut-off, forecasts of the days in the horizon, by their regressors and the fit as of the cut-off."""
    fits = seasonal_fits(history, site, date, value, cuts, regressors).where(F.col("n") >= least_rows)
    weights = R.seasonal_weights(fits, [site, "cutoff"], len(regressors), ridge)
    rows = history.where(F.col(value).isNotNull()).select(site, F.to_date(date).alias("target"), F.col(value).alias("actual"), *(F.col(c).alias(f"__r{i}") for i, c in enumerate(regressors)))
    ahead = with_cutoffs(rows, F.date_sub("target", horizon[1]), F.date_sub("target", horizon[0]), cuts)
    p = ahead.join(weights, [site, "cutoff"]).withColumn("prediction", R.seasonal_prediction("target", [f"__r{i}" for i in range(len(regressors))], least_fit))
    return p.select(site, "cutoff", "target", F.datediff("target", "cutoff").alias("horizon"), "actual", "prediction")


def backtest_errors(results: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Errors of several models' backtests, side by side: model, keys, n, mae, bias."""
    every = reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("model"), *keys, F.col("actual").cast("double").alias("actual"), "prediction") for name, df in results.items()])
    return every.groupBy("model", *keys).agg(F.count("*").alias("n"), F.avg(F.abs(F.col("prediction") - F.col("actual"))).alias("mae"), F.avg(F.col("prediction") - F.col("actual")).alias("bias"))
