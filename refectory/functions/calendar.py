"""Calendars: iCalendar files, holidays, working days, distances to holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scalars import school_year


def ical_periods(texts: DataFrame, text: str, zone: Column, kinds: dict[str, str], excluded: tuple[str, ...] = (), starts_in: int = 9) -> DataFrame:
    """(zone, school_year, kind, start, end) of the all-day events of iCalendar texts.

    End dates are exclusive there and inclusive here, never before the start. kinds: what a summary holds -> kind; events of no kind
    and those whose summary holds an excluded word are left out.
    """
    unfolded = F.regexp_replace(F.col(text), "\r?\n[ \t]", "")
    events = texts.select(zone.alias("zone"), F.explode(F.regexp_extract_all(unfolded, F.lit(r"(?s)BEGIN:VEVENT(.*?)END:VEVENT"), 1)).alias("e"))
    day = lambda k: F.try_to_timestamp(F.regexp_extract("e", rf"{k}(?:;[^:\n]*)?:(\d{{8}})", 1), F.lit("yyyyMMdd")).cast("date")
    e = events.select("zone", day("DTSTART").alias("start"), day("DTEND").alias("stop"), F.trim(F.regexp_extract("e", r"SUMMARY[^:\n]*:([^\r\n]*)", 1)).alias("summary")).where("start is not null")
    kind = F.when(F.lit(False), F.lit(None).cast("string"))
    for word, name in kinds.items():
        kind = kind.when(F.contains(F.lower("summary"), F.lit(word.lower())), F.lit(name))
    for word in excluded:
        e = e.where(~F.contains(F.lower("summary"), F.lit(word.lower())))
    end = F.greatest(F.col("start"), F.date_sub(F.coalesce("stop", F.date_add("start", 1)), 1))
    return e.select("zone", school_year(F.col("start"), starts_in).alias("school_year"), kind.alias("kind"), "start", end.alias("end")).where("kind is not null")


def read_icals(spark: SparkSession, path: str, kinds: dict[str, str], excluded: tuple[str, ...] = ()) -> DataFrame:
    """S4 over files named ...Zone-<letter>.ics."""
    raw = spark.read.text(path, wholetext=True).withColumn("zone", F.regexp_extract(F.input_file_name(), r"Zone-(\w)\.ics", 1))
    return ical_periods(raw, "value", F.col("zone"), kinds, excluded)


def public_holidays(spark: SparkSession, path: str) -> DataFrame:
    """S5."""
    return spark.read.schema("date date, annee int, zone string, nom_jour_ferie string").csv(path, header=True)


def days_of(periods: DataFrame, start: str, end: str, *keys: str) -> DataFrame:
    """A row for each day of each period."""
    return periods.where(F.col(start) <= F.col(end)).select(*keys, F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias("day")).distinct()


def working_days(spans: DataFrame, key: str, start: str, end: str, days_off: DataFrame) -> DataFrame:
    """by key, the days from start to end, both in, that are no weekend and not in days_off (day)."""
    days = spans.where(F.col(start) <= F.col(end)).select(key, F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias("day")).where(F.weekday("day") < 5)
    counted = days.join(days_off.select("day").distinct(), "day", "left_anti").groupBy(key).agg(F.count("*").alias("n"))
    return spans.select(key).distinct().join(counted, key, "left").select(key, F.coalesce("n", F.lit(0)).cast("long").alias("working_days"))


def holiday_distance(dates: DataFrame, date: str, zone: str, periods: DataFrame, start: str, end: str, cap: int = 30) -> DataFrame:
    """M3, M4: whether a day is in a holiday of its zone, and the days to the next one and since the last one, cap at most, 0 inside.

    Distinct (day, zone) pairs are matched with the zone's periods by an equi-join on zone.
    """
    d = dates.select(F.to_date(date).alias("__day"), F.col(zone).alias("__zone")).distinct()
    p = periods.select(F.col(zone).alias("__zone"), F.to_date(start).alias("__s"), F.to_date(end).alias("__e"))
    j = d.join(p, "__zone", "left")
    inside = (F.col("__day") >= F.col("__s")) & (F.col("__day") <= F.col("__e"))
    before, after = F.datediff("__s", "__day"), F.datediff("__day", "__e")
    out = j.groupBy("__day", "__zone").agg(
        F.coalesce(F.max(inside.cast("int")), F.lit(0)).alias("is_holiday"),
        F.least(F.lit(cap), F.coalesce(F.min(F.when(inside, 0).when(before > 0, before)), F.lit(cap))).alias("days_before"),
        F.least(F.lit(cap), F.coalesce(F.min(F.when(inside, 0).when(after > 0, after)), F.lit(cap))).alias("days_after"),
    )
    inside_any = F.col("is_holiday") == 1
    return out.select(F.col("__day").alias(date), F.col("__zone").alias(zone), "is_holiday", F.when(inside_any, 0).otherwise(F.col("days_before")).alias("days_before"), F.when(inside_any, 0).otherwise(F.col("days_after")).alias("days_after"))


def holiday_flags(dates: DataFrame, date: str, holidays: DataFrame, day: str) -> DataFrame:
    """M5: whether a day is a public holiday, and whether it bridges one: the Monday before a Tuesday, the Friday after a Thursday."""
    off = holidays.select(F.to_date(day).alias("__off")).distinct()
    bridge = off.select(F.when(F.weekday("__off") == 1, F.date_sub("__off", 1)).when(F.weekday("__off") == 3, F.date_add("__off", 1)).alias("__bridge")).where("__bridge is not null").distinct()
    j = dates.withColumn("__day", F.to_date(date)).join(off.withColumn("__h", F.lit(1)), F.col("__day") == F.col("__off"), "left")
    j = j.join(bridge.withColumn("__b", F.lit(1)), F.col("__day") == F.col("__bridge"), "left")
    return j.select(*dates.columns, F.coalesce("__h", F.lit(0)).alias("is_public_holiday"), F.coalesce("__b", F.lit(0)).alias("is_bridge"))
