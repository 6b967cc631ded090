"""Registrations and their tracking: status counts, event streams, dense cumulative curves, period joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import windows as W
from .base import query, table

STATUSES = {"approved": ["F"], "open": ["O"], "pending": ["P"]}


@query("""
SELECT r_name AS region, CASE lower(trim(c_mktsegment)) WHEN 'building' THEN 'intern' WHEN 'machinery' THEN 'ticket' ELSE 'autre' END AS billing,
  o_orderpriority AS tranche, count(*) AS total, count(*) FILTER (o_orderstatus IN ('F')) AS approved, count(*) FILTER (o_orderstatus IN ('O')) AS open,
  count(*) FILTER (o_orderstatus IN ('P')) AS pending, count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) AS other
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL""")
def registration_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations by region, billing class and tranche."""
    t = lambda n: table(spark, sf_dir, n)
    star = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    own = star.select(F.col("r_name").alias("region"), S.billing_class(F.col("c_mktsegment"), {"building": "intern", "machinery": "ticket"}).alias("billing"), F.col("o_orderpriority").alias("tranche"), "o_orderstatus")
    return A.counts_by(own, ["region", "billing", "tranche"], "o_orderstatus", STATUSES, {"other": ["F", "O"]})


def event_union(e: DataFrame) -> DataFrame:
    """One stream of creations, first deposits and approvals with 0/1 columns; dimensions are joined once, afterwards."""
    zero = F.lit(0)
    created = e.where("event_type = 'view'").select("user_id", F.to_date("ts").alias("day"), F.lit(1).alias("created"), zero.alias("deposited"), zero.alias("approved"))
    first = e.where("event_type = 'click'").groupBy("user_id").agg(F.min("ts").alias("ts"))
    deposited = first.select("user_id", F.to_date("ts").alias("day"), zero.alias("created"), F.lit(1).alias("deposited"), zero.alias("approved"))
    approved = e.where("event_type = 'purchase'").select("user_id", F.to_date("ts").alias("day"), zero.alias("created"), zero.alias("deposited"), F.lit(1).alias("approved"))
    return created.unionByName(deposited).unionByName(approved)


_UNION = """WITH u AS (
  SELECT user_id, CAST(ts AS DATE) AS day, 1 AS created, 0 AS deposited, 0 AS approved FROM events WHERE event_type = 'view'
  UNION ALL SELECT user_id, CAST(min(ts) AS DATE), 0, 1, 0 FROM events WHERE event_type = 'click' GROUP BY user_id
  UNION ALL SELECT user_id, CAST(ts AS DATE), 0, 0, 1 FROM events WHERE event_type = 'purchase'),
v AS (SELECT user_id % 5 AS wave, user_id % 40 AS org, day, created, deposited, approved FROM u)"""


@query(_UNION + " SELECT day, CAST(sum(created) AS BIGINT) AS created, CAST(sum(deposited) AS BIGINT) AS deposited, CAST(sum(approved) AS BIGINT) AS approved FROM v GROUP BY day")
def events_union_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of each kind by day."""
    return event_union(table(spark, sf_dir, "events")).groupBy("day").agg(*(F.sum(c).alias(c) for c in ("created", "deposited", "approved")))


@query(_UNION + """, s AS (SELECT wave, org, day, sum(created) AS created, sum(deposited) AS deposited, sum(approved) AS approved FROM v GROUP BY ALL),
g AS (SELECT * FROM (SELECT DISTINCT wave, day FROM s) JOIN (SELECT DISTINCT wave, org FROM s) USING (wave)),
d AS (SELECT wave, day, org, coalesce(created, 0) AS c, coalesce(deposited, 0) AS p, coalesce(approved, 0) AS a FROM g LEFT JOIN s USING (wave, day, org))
SELECT wave, day, org, CAST(c AS BIGINT) AS created, CAST(sum(c) OVER w AS BIGINT) AS created_total, CAST(sum(p) OVER w AS BIGINT) AS deposited_total, CAST(sum(a) OVER w AS BIGINT) AS approved_total
FROM d WINDOW w AS (PARTITION BY wave, org ORDER BY day ROWS UNBOUNDED PRECEDING)""")
def dense_cumulative_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each wave, every day for every organisation, with running totals."""
    v = event_union(table(spark, sf_dir, "events")).select((F.col("user_id") % 5).alias("wave"), (F.col("user_id") % 40).alias("org"), "day", "created", "deposited", "approved")
    dense = J.densify(v, "day", "wave", "org", ["created", "deposited", "approved"])
    out = W.running(dense, ["wave", "org"], ["day"], {f"{c}_total": c for c in ("created", "deposited", "approved")})
    return out.select("wave", "day", "org", "created", "created_total", "deposited_total", "approved_total")


WAVES = [(1, "1994-12-01", "A"), (2, "1995-09-01", "B"), (3, "1996-09-01", "C"), (4, "1996-09-01", "D"), (5, "1999-01-15", "E")]
YEARS = [("1995-1996", "1995-09-01", "1996-08-31"), ("1996-1997", "1996-09-01", "1997-08-31"), ("1997-1998", "1997-09-01", "1998-08-31")]
_WAVES = "(VALUES " + ", ".join(f"({i}, DATE '{d}', '{n}')" for i, d, n in WAVES) + ") AS p(id_vague, start_date, name)"
_YEARS = "(VALUES " + ", ".join(f"('{i}', DATE '{a}', DATE '{b}')" for i, a, b in YEARS) + ") AS y(school_year, year_start, year_end)"


def waves(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WAVES, "id_vague int, start string, name string").select("id_vague", F.to_date("start").alias("start_date"), "name")


def years(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(YEARS, "school_year string, a string, b string").select("school_year", F.to_date("a").alias("year_start"), F.to_date("b").alias("year_end"))


_BEST = f"""WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), p AS (SELECT * FROM {_WAVES}),
b AS (SELECT day, id_vague, name FROM (SELECT day, id_vague, name, row_number() OVER (PARTITION BY day ORDER BY start_date DESC, id_vague DESC) AS n FROM d JOIN p ON start_date <= day) WHERE n = 1)"""


@query(_BEST + """ SELECT id_vague, name, o_orderstatus, count(*) AS n, sum(o_totalprice) AS amount
FROM orders LEFT JOIN b ON CAST(o_orderdate AS DATE) = day GROUP BY ALL""")
def asof_latest_wave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each registration in the wave that started last before it."""
    o = J.latest_started(table(spark, sf_dir, "orders"), "o_orderdate", waves(spark), "start_date", ["id_vague", "name"], "id_vague")
    return o.groupBy("id_vague", "name", "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("amount"))


@query(f"SELECT school_year, count(*) AS n, count(DISTINCT o_custkey) AS users, max(CAST(o_orderdate AS DATE)) AS last_day FROM orders JOIN {_YEARS} ON CAST(o_orderdate AS DATE) BETWEEN year_start AND year_end GROUP BY ALL")
def interval_join_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registrations by school year, days compared so that the last day counts whole."""
    o = J.within_period(table(spark, sf_dir, "orders"), "o_orderdate", years(spark), "year_start", "year_end")
    return o.groupBy("school_year").agg(F.count("*").alias("n"), F.count_distinct("o_custkey").alias("users"), F.max(F.to_date("o_orderdate")).alias("last_day"))


@query("""WITH p AS (SELECT o_custkey, o_orderdate, 1 AS nb, o_orderpriority AS tranche FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL SELECT o_custkey, o_orderdate, CAST(count(*) AS INTEGER), 'partner' FROM orders WHERE o_orderstatus = 'P' GROUP BY o_custkey, o_orderdate),
w AS (SELECT * FROM """ + _WAVES + """), x AS (SELECT day, arg_max(name, (start_date, id_vague)) AS name FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders) JOIN w ON start_date <= day GROUP BY day)
SELECT coalesce(name, 'none') AS wave, CAST(sum(nb) AS BIGINT) AS total, CAST(sum(CASE WHEN tranche = '1-URGENT' THEN nb ELSE 0 END) AS BIGINT) AS urgent,
  CAST(sum(CASE WHEN tranche = 'partner' THEN nb ELSE 0 END) AS BIGINT) AS partner, CAST(sum(CASE WHEN tranche NOT IN ('1-URGENT', 'partner') THEN nb ELSE 0 END) AS BIGINT) AS rest
FROM p LEFT JOIN x ON CAST(o_orderdate AS DATE) = day GROUP BY ALL""")
def passages_by_wave_tranche(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal passages and a partner's counted ones as weights, by wave."""
    o = table(spark, sf_dir, "orders")
    own = o.where("o_orderstatus <> 'P'").select("o_custkey", "o_orderdate", F.lit(1).alias("nb"), F.col("o_orderpriority").alias("tranche"))
    partner = o.where("o_orderstatus = 'P'").groupBy("o_custkey", "o_orderdate").agg(F.count("*").cast("int").alias("nb")).withColumn("tranche", F.lit("partner"))
    p = J.latest_started(own.unionByName(partner), "o_orderdate", waves(spark), "start_date", ["name"], "id_vague")
    t = F.col("tranche")
    return p.groupBy(F.coalesce("name", F.lit("none")).alias("wave")).agg(F.sum("nb").alias("total"), A.sum_if(t == "1-URGENT", F.col("nb")).alias("urgent"), A.sum_if(t == "partner", F.col("nb")).alias("partner"), A.sum_if(~t.isin("1-URGENT", "partner"), F.col("nb")).alias("rest"))


@query("""WITH t AS (SELECT DISTINCT o_orderpriority AS tranche FROM orders WHERE o_orderstatus = 'P' AND o_custkey % 7 <> 0),
k AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0)
SELECT o_custkey, count(*) AS n, max(o_orderdate) AS last_at FROM orders
WHERE o_custkey IN (SELECT k FROM k) AND o_orderpriority IN (SELECT tranche FROM t) GROUP BY ALL""")
def semi_join_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose keys are among those of other tables, with each key's last time."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    t = o.where("o_orderstatus = 'P' AND o_custkey % 7 <> 0").select("o_orderpriority")
    out = o.join(c.where("c_custkey % 3 = 0"), F.col("o_custkey") == F.col("c_custkey"), "left_semi").join(t, "o_orderpriority", "left_semi")
    return out.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("last_at"))


@query("""WITH k AS (SELECT c_nationkey AS org, count(*) AS users FROM customer GROUP BY ALL),
l AS (SELECT c_nationkey AS org, max(o_orderdate) AS last_at FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderdate < TIMESTAMP '1995-02-01' GROUP BY ALL
  UNION ALL SELECT s_nationkey, max(l_shipdate) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_shipdate < TIMESTAMP '1995-02-01' AND s_nationkey < 12 GROUP BY ALL)
SELECT n_name AS name, max(last_at) AS last_passage FROM nation LEFT JOIN l ON n_nationkey = org GROUP BY ALL""")
def last_passage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each organisation's last passage over two facts; organisations without any stay, with null."""
    t = lambda n: table(spark, sf_dir, n)
    before = "1995-02-01"
    a = t("orders").where(F.col("o_orderdate") < F.lit(before).cast("timestamp")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("org")).agg(F.max("o_orderdate").alias("at"))
    b = t("lineitem").where(F.col("l_shipdate") < F.lit(before).cast("timestamp")).join(t("supplier").where("s_nationkey < 12"), F.col("l_suppkey") == F.col("s_suppkey")).groupBy(F.col("s_nationkey").alias("org")).agg(F.max("l_shipdate").alias("at"))
    last = a.unionByName(b).groupBy("org").agg(F.max("at").alias("last_passage"))
    return t("nation").join(last, F.col("n_nationkey") == F.col("org"), "left").select(F.col("n_name").alias("name"), "last_passage")


@query("""SELECT 'segment' AS filter, c_mktsegment AS value FROM customer WHERE c_mktsegment IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'nation', n_name FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY ALL
UNION ALL SELECT 'priority', o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ALL""")
def filter_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that filters can take."""
    t = lambda n: table(spark, sf_dir, n)
    one = lambda df, name, c: df.select(F.lit(name).alias("filter"), F.col(c).alias("value")).where("value is not null").distinct()
    named = t("nation").join(t("customer"), F.col("n_nationkey") == F.col("c_nationkey"), "left_semi")
    return one(t("customer"), "segment", "c_mktsegment").unionByName(one(named, "nation", "n_name")).unionByName(one(t("orders"), "priority", "o_orderpriority"))
