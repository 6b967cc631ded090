"""Streams, fuzzy matching and calendar texts on the driver's tables."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions.scalars import school_year
from ..operators import joins as J
from ..operators.parts import KeyedTable
from ..session import staged, work_path
from ..streaming import sync as T
from .base import query, table


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts by day as a stream over landed files, each batch's counts under its number."""
    return T.counted_by_day(T.landed(spark, f"{sf_dir}/events.parquet"), "ts", "event_type", work_path(spark, "daily"))


@query("SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts FROM events GROUP BY ALL")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event, merged batch by batch into a table in parts by user."""
    at = work_path(spark, "latest")
    held = KeyedTable(spark, f"{at}/table", ["user_id"], [F.desc("ts"), F.desc("event_id")], buckets=16)
    stream = T.landed(spark, f"{sf_dir}/events.parquet").select("user_id", "event_type", "ts", "event_id")
    T.sync(stream, T.upsert_batches(held, newest=True), f"{at}/stream")
    return held.read().select("user_id", "event_type", "ts")


def _timed(df: DataFrame) -> DataFrame:
    """Watermarks are for times with a zone."""
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def landed_in_turn(spark: SparkSession, sf_dir: str, at: str, parts: int, again: int = 0) -> Iterator[int]:
    """The events land in parts one after the other, by time; again: days before each part that land once more with it.

    Gives each part's number once it is there, for the stream to take it in one batch: files of later times in a batch before would move
    the watermark past the others. So each task writes a file of its own.
    """
    e = table(spark, sf_dir, "events")
    span = staged(e.agg(F.min("ts").alias("a"), F.max("ts").alias("b")), "span")
    at_ = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    nth = F.least(F.floor((at_("ts") - at_("a")) * parts / (at_("b") - at_("a"))), F.lit(parts - 1)).cast("int")
    own = e.crossJoin(F.broadcast(span)).withColumn("part", nth)
    first = staged(own.groupBy("part").agg(F.min("ts").alias("start")), "starts")
    for i in range(parts):
        from_ = first.where(F.col("part") == i).select((F.col("start") - F.make_interval(days=F.lit(again))).alias("start"))
        own.where(F.col("part") <= i).crossJoin(F.broadcast(from_)).where("ts >= start").select(*e.columns).write.mode("append").parquet(at)
        yield i


@query("WITH m AS (SELECT max(ts) AS last FROM events) SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events, m WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= last - INTERVAL 1 DAY GROUP BY ALL")
def stream_complete_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: tumbling windows with a watermark of a day in append mode: each day's counts come out once, when it is complete."""
    at = work_path(spark, "days")
    for _ in landed_in_turn(spark, sf_dir, f"{at}/landed", 3):
        days = T.appended(T.daily_counts(_timed(T.landed(spark, f"{at}/landed", None)), "ts", "event_type"), at)
    return days


@query("SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS events, min(ts) AS first_ts, max(ts) AS last_ts FROM events GROUP BY ALL")
def stream_rereads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: each of four loads reads the last 7 days before it once more; rows seen within the look-back are dropped in the stream."""
    at = work_path(spark, "rereads")
    for _ in landed_in_turn(spark, sf_dir, f"{at}/landed", 4, again=7):
        rows = T.appended(T.without_repeats(_timed(T.landed(spark, f"{at}/landed", None)), "ts", ["event_id"], "7 days"), at)
    rows = rows.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


@query("SELECT event_type, CASE WHEN month(ts) >= 8 THEN year(ts) || '-' || (year(ts) + 1) ELSE (year(ts) - 1) || '-' || year(ts) END AS school_year, max(ts) AS ts FROM events GROUP BY ALL")
def stream_latest_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event of each kind and school year, kept up to date by a stream."""
    at = work_path(spark, "times")
    held = KeyedTable(spark, f"{at}/table", ["event_type", "school_year"], [F.desc("ts")], buckets=8)
    stream = T.landed(spark, f"{sf_dir}/events.parquet").withColumn("school_year", school_year(F.col("ts"), 8))
    T.sync(stream, T.latest_batches(held, ["event_type", "school_year"], "ts"), f"{at}/stream")
    return held.read()


@query("""WITH q AS (SELECT c_custkey AS query_id, c_nationkey AS org, upper(substr(c_name, 10)) AS f, upper(c_mktsegment) AS l, CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 5 END AS b FROM customer WHERE c_custkey % 20 = 0),
p AS (SELECT c_custkey AS person_id, c_nationkey AS org, upper(substr(c_name, 10)) AS f, upper(c_mktsegment) AS l, c_custkey % 5 AS b FROM customer),
s AS (SELECT query_id, person_id, q.b AS qb, coalesce(q.b = p.b, false) AS date_valid, 0.4::DOUBLE * jaro_winkler_similarity(q.f, p.f) + 0.6::DOUBLE * jaro_winkler_similarity(q.l, p.l) AS score FROM q JOIN p USING (org)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id, date_valid ORDER BY round(score, 9) DESC, person_id) AS rank FROM s)
SELECT query_id, person_id, date_valid, round(score, 9) AS score, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= CASE WHEN qb IS NULL THEN 10 ELSE 5 END""")
def fuzzy_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The likeliest people of an organisation for each query, by names and birth date."""
    return J.fuzzy_candidates(*_people(spark, sf_dir), "org", "first", "last", "birth")


def _people(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c = table(spark, sf_dir, "customer")
    p = c.select(F.col("c_custkey").alias("person_id"), F.col("c_nationkey").alias("org"), F.substring("c_name", 10, 100).alias("first"), F.col("c_mktsegment").alias("last"), (F.col("c_custkey") % 5).alias("birth"))
    return p.where("person_id % 20 = 0").withColumnRenamed("person_id", "query_id").withColumn("birth", F.when(F.col("query_id") % 2 == 0, F.col("birth"))), p


@query("SELECT count(*) AS pairs, true AS pruned FROM customer q JOIN customer p USING (c_nationkey) WHERE q.c_custkey % 20 = 0")
def fuzzy_pruning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a query and a person of one organisation, and whether fuzzy_candidates scores less than a fifth of them.

    With organisations of a few dozen people the five or ten best that every query keeps are more than that already.
    """
    n = J.fuzzy_pruning(*_people(spark, sf_dir), "org", "first", "last", "birth")
    return n.select("pairs", ((F.col("pairs") < 100_000) | (F.col("scored") * 5 < F.col("pairs"))).alias("pruned"))


@query("""WITH e AS (SELECT n_regionkey AS z, n_nationkey AS n, DATE '1996-02-01' + 31 * CAST(n_nationkey AS INTEGER) AS a, CAST(n_nationkey % 4 AS INTEGER) AS len FROM nation WHERE n_nationkey % 5 <> 4)
SELECT CAST(z AS VARCHAR) AS zone, CASE WHEN month(a) >= 9 THEN year(a) || '-' || (year(a) + 1) ELSE (year(a) - 1) || '-' || year(a) END AS school_year, CASE WHEN n % 5 < 2 THEN 'winter' ELSE 'spring' END AS kind, a AS start, greatest(a, a + len - 1) AS "end" FROM e""")
def ical_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holiday periods from iCalendar texts, one for each zone, made of the nations' numbers; exclusive end dates."""
    n = table(spark, sf_dir, "nation")
    a = F.date_add(F.lit("1996-02-01").cast("date"), (F.col("n_nationkey") * 31).cast("int"))
    day = lambda d: F.date_format(d, "yyyyMMdd")
    kind = F.when(F.col("n_nationkey") % 5 < 2, "Vacances d'Hiver").when(F.col("n_nationkey") % 5 < 4, "Vacances de Printemps").otherwise("Rentree")
    event = F.concat(F.lit("BEGIN:VEVENT\r\nDTSTART;VALUE=DATE:"), day(a), F.lit("\r\nDTEND;VALUE=DATE:"), day(F.date_add(a, (F.col("n_nationkey") % 4).cast("int"))), F.lit("\r\nSUMMARY:"), kind, F.lit("\r\nEND:VEVENT\r\n"))
    texts = n.groupBy(F.col("n_regionkey").cast("string").alias("z")).agg(F.concat_ws("", F.collect_list(event)).alias("t"))
    return C.ical_periods(texts, "t", F.col("z"), {"hiver": "winter", "printemps": "spring"}, ("rentree",))
