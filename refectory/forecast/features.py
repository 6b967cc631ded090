"""Attendance features (M1-M10). Rolling features are made before rows are filtered, so that they see raw values."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions.scalars import school_year
from ..operators import aggregates as A
from ..operators import windows as W
from ..session import staged


@dataclass(frozen=True)
class Columns:
    """Names in the attendance table."""

    site: str = "login_site"
    date: str = "efdate"
    value: str = "efreel"


def clean(df: DataFrame, c: Columns, as_of: str, least: float = 1.0, demo: tuple[str, ...] = ()) -> DataFrame:
    """M2: no future days, demo sites or values up to `least`; several rows of a day are summed."""
    own = df.where((F.to_date(c.date) <= F.lit(as_of).cast("date")) & (F.col(c.value) > least))
    if demo:
        own = own.where(~F.col(c.site).isin(list(demo)))
    return own.groupBy(c.site, F.to_date(c.date).alias(c.date)).agg(F.sum(c.value).alias(c.value))


def rolling(df: DataFrame, c: Columns) -> DataFrame:
    """Mean of 42 rows and its shifts by 21 and 35, mean of 8 rows of a weekday and its shifts by 4 and 6, the weekday's mean."""
    out = df.withColumn("day", F.weekday(c.date))
    out = W.full_window_mean(out, [c.site], [c.date], c.value, 42, "mobile_mean_42")
    out = W.full_window_mean(out, [c.site, "day"], [c.date], c.value, 8, "daily_mobile_mean_8")
    filled = {}
    for keys, source, steps in (([c.site], "mobile_mean_42", (21, 35)), ([c.site, "day"], "daily_mobile_mean_8", (4, 6))):
        for k in steps:
            filled[name := f"{source}_shifted_{k}"] = keys
            out = W.shifted(out, keys, [c.date], source, k, name)
    out = W.back_filled(out, [c.date], filled)
    return W.group_mean(out, [c.site, "day"], c.value, "weekday_mean")


def calendar(df: DataFrame, c: Columns, zone: str, periods: DataFrame, holidays: DataFrame, starts_in: int = 8) -> DataFrame:
    """Year, month, school year, holidays of the zone, distances to them, public holidays and bridge days."""
    out = df.withColumns({"year": F.year(c.date), "month": F.month(c.date), "school_year": school_year(F.col(c.date), starts_in)})
    out = out.join(C.holiday_distance(out, c.date, zone, periods, "date_debut", "date_fin"), [c.date, zone], "left")
    return C.holiday_flags(out, c.date, holidays, "date")


def dense_weekdays(df: DataFrame, c: Columns, day: str = "day") -> DataFrame:
    """M6: rows of weekdays that a site has at least a quarter as often as its weekdays on average."""
    n = df.groupBy(c.site, day).agg(F.count("*").alias("__n"))
    keep = n.withColumn("__mean", F.avg("__n").over(Window.partitionBy(c.site))).where(F.col("__n") >= F.col("__mean") / 4)
    return df.join(keep.select(c.site, day), [c.site, day], "left_semi")


def without_outliers(df: DataFrame, c: Columns, day: str = "day", factor: float = 2.5) -> DataFrame:
    """M7."""
    b = A.iqr_bounds(df, [c.site, day], c.value, factor).select(c.site, day, "lower", "upper")
    return df.join(b, [c.site, day]).where(F.col(c.value).between(F.col("lower"), F.col("upper"))).select(*df.columns)


def opening_pattern(df: DataFrame, c: Columns, year: str = "school_year", least: float = 0.3) -> DataFrame:
    """M8: by site and school year seven flags from Monday: whether a weekday was met in `least` of the weeks or more."""
    days = df.select(c.site, year, F.to_date(c.date).alias("__d")).distinct()
    counts = [F.count_if(F.weekday("__d") == i).alias(f"__{i}") for i in range(7)]
    g = days.groupBy(c.site, year).agg(F.greatest(F.lit(1.0), (F.datediff(F.max("__d"), F.min("__d")) + 1) / 7).alias("__w"), *counts)
    return g.select(c.site, year, F.concat(*(F.when(F.col(f"__{i}") / F.col("__w") >= least, "1").otherwise("0") for i in range(7))).alias("opening_days"))


def with_opening(df: DataFrame, pattern: DataFrame, c: Columns, year: str = "school_year", closed_on: tuple[str, ...] = ("is_holiday", "is_public_holiday")) -> DataFrame:
    """M8: whether the site is usually open that day; closed on holidays of the kinds given."""
    flag = F.coalesce(F.substr("opening_days", F.weekday(c.date) + 1, F.lit(1)).cast("int"), F.lit(0))
    for k in closed_on:
        flag = F.when(F.coalesce(F.col(k), F.lit(0)) == 1, 0).otherwise(flag)
    return df.join(pattern, [c.site, year], "left").withColumn("is_day_usually_open", flag)


def future_frame(df: DataFrame, c: Columns, first_day: str, days: int, last_known: list[str]) -> DataFrame:
    """M9: each site's next days with its last known features."""
    known = W.last_known(df, [c.site], c.date, last_known)
    horizon = F.sequence(F.lit(first_day).cast("date"), F.date_add(F.lit(first_day).cast("date"), days - 1))
    return known.withColumn(c.date, F.explode(horizon)).withColumn("day", F.weekday(c.date)).withColumn("horizon", F.datediff(c.date, F.lit(first_day).cast("date")) + 1)


def prepare(df: DataFrame, c: Columns, as_of: str, zone: str, periods: DataFrame, holidays: DataFrame) -> DataFrame:
    """M1: all of it: clean, rolling features, calendar, then sparse weekdays and outliers go, opening pattern, size group.

    Steps that several aggregates read again are written as tables in between.
    """
    zones = df.groupBy(c.site).agg(F.max(zone).alias(zone))
    out = staged(rolling(staged(clean(df, c, as_of), "clean"), c).join(zones, c.site), "rolling")
    out = calendar(out, c, zone, periods, holidays)
    out = staged(without_outliers(staged(dense_weekdays(out, c), "dense"), c), "features")
    out = with_opening(out, opening_pattern(out, c), c)
    return out.join(A.size_groups(out, c.site, c.value).select(c.site, "group_size"), c.site)
