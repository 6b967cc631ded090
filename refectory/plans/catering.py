"""Deliveries, meals and dashboards on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import windows as W
from .base import query, table

_STATUS = "(SELECT n_nationkey AS grp, CASE WHEN n_regionkey < 2 THEN 2 ELSE 1 END AS status FROM nation)"
_DIM = "(SELECT s_suppkey AS k, s_name AS name, s_acctbal AS bal FROM supplier UNION ALL SELECT 100000 + n_nationkey, n_name, 0 FROM nation)"


@query(f"""WITH f AS (SELECT l_suppkey AS site, 100000 + s_nationkey AS grp, l_quantity AS q FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT d.name, count(*) AS n, sum(q) AS qty FROM f LEFT JOIN (SELECT 100000 + grp AS grp, status FROM {_STATUS}) s ON f.grp = s.grp LEFT JOIN {_DIM} d ON d.k = CASE WHEN status = 2 THEN f.site ELSE f.grp END GROUP BY ALL""")
def routed_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names come from the site or from its group, as the group's status says."""
    t = lambda n: table(spark, sf_dir, n)
    f = t("lineitem").join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(F.col("l_suppkey").alias("site"), (F.col("s_nationkey") + 100000).cast("long").alias("grp"), F.col("l_quantity").alias("q"))
    status = t("nation").select((F.col("n_nationkey") + 100000).cast("long").alias("grp"), F.when(F.col("n_regionkey") < 2, 2).otherwise(1).alias("status"))
    dim = t("supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")).unionByName(t("nation").select((F.col("n_nationkey") + 100000).cast("long").alias("k"), F.col("n_name").alias("name")))
    return J.routed(f, status, dim, "site", "grp", "k").groupBy("name").agg(F.count("*").alias("n"), F.sum("q").alias("qty"))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Movements with week, family, flags of origin and amounts."""
    t = lambda n: table(spark, sf_dir, n)
    li = t("lineitem").where("l_quantity > 0").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    local = S.origin_flags(F.col("p_size") % 7 == 0, F.when(F.col("l_linenumber") == 1, None).when(F.col("l_linenumber") == 2, True).otherwise(F.lit(None).cast("boolean")), F.col("s_nationkey") % 5 == 0)
    bio = S.origin_flags(F.col("p_size") % 5 == 0, F.when(F.col("l_returnflag") == "R", False), F.lit(None).cast("boolean"))
    d = F.to_date("l_shipdate")
    return li.select(
        S.iso_year(d).alias("iso_year"), S.iso_week(d).alias("week"), F.year(d).alias("y"), F.month(d).alias("m"), d.alias("day"), F.col("l_suppkey").alias("site"), F.col("p_type").alias("family"), F.col("p_brand").alias("subfamily"),
        local.alias("local"), bio.alias("bio"), (F.col("p_size") % 3 == 0).alias("label"), F.col("l_quantity").alias("qty"),
        S.amount(F.col("l_quantity"), F.col("p_retailprice")).alias("net"), S.amount(F.col("l_quantity"), F.col("p_retailprice"), F.col("l_tax") * 100).alias("gross"),
    )


_DEL = """WITH d AS (SELECT CAST(isoyear(l_shipdate) AS INTEGER) AS iso_year, lpad(CAST(weekofyear(l_shipdate) AS VARCHAR), 2, '0') AS week, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m, CAST(l_shipdate AS DATE) AS day,
 l_suppkey AS site, p_type AS family, p_brand AS subfamily, coalesce(CASE WHEN l_linenumber = 2 THEN true END, p_size % 7 = 0 OR s_nationkey % 5 = 0) AS local,
 coalesce(CASE WHEN l_returnflag = 'R' THEN false END, p_size % 5 = 0) AS bio, p_size % 3 = 0 AS label, l_quantity AS qty, l_quantity * p_retailprice AS net, l_quantity * p_retailprice * (1 + l_tax * 100 / 100) AS gross
 FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE l_quantity > 0)"""


@query(_DEL + " SELECT iso_year, week, family, local, bio, sum(qty) AS qty, round(sum(net), 2) AS net, round(sum(gross), 2) AS gross FROM d GROUP BY ALL")
def deliveries_by_iso_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities and amounts by ISO week, family and origin."""
    return deliveries(spark, sf_dir).groupBy("iso_year", "week", "family", "local", "bio").agg(F.sum("qty").alias("qty"), F.round(F.sum("net"), 2).alias("net"), F.round(F.sum("gross"), 2).alias("gross"))


@query(_DEL + " SELECT y, m, family, subfamily, sum(qty) AS qty, round(sum(net), 2) AS net FROM d GROUP BY ALL")
def deliveries_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By month and family."""
    return deliveries(spark, sf_dir).groupBy("y", "m", "family", "subfamily").agg(F.sum("qty").alias("qty"), F.round(F.sum("net"), 2).alias("net"))


@query(_DEL + """ SELECT y, family, round(sum(net), 2) AS net, round(100 * sum(CASE WHEN local THEN net ELSE 0 END) / sum(net), 2) AS local_pct, round(100 * sum(CASE WHEN bio THEN net ELSE 0 END) / sum(net), 2) AS bio_pct,
 round(100 * sum(CASE WHEN bio AND local THEN net ELSE 0 END) / sum(net), 2) AS bio_local_pct, round(100 * sum(CASE WHEN label THEN net ELSE 0 END) / sum(net), 2) AS label_pct FROM d GROUP BY ALL""")
def deliveries_share_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of local, organic and labelled goods, 0 where nothing was delivered."""
    net = F.col("net")
    part = lambda c: S.ratio(A.sum_if(c, net), F.sum("net"), 100)
    return deliveries(spark, sf_dir).groupBy("y", "family").agg(F.round(F.sum("net"), 2).alias("net"), part(F.col("local")).alias("local_pct"), part(F.col("bio")).alias("bio_pct"), part(F.col("bio") & F.col("local")).alias("bio_local_pct"), part(F.col("label")).alias("label_pct"))


@query(_DEL + " SELECT y, CASE WHEN family LIKE '%BRASS' THEN 'meat' WHEN family LIKE '%STEEL' THEN 'fish' ELSE 'other' END AS product, local, bio, label, round(sum(net), 2) AS net, count(DISTINCT site) AS sites FROM d GROUP BY ALL")
def dashboard_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts and sites by product kind, local, organic, label."""
    kind = F.when(F.col("family").endswith("BRASS"), "meat").when(F.col("family").endswith("STEEL"), "fish").otherwise("other")
    return deliveries(spark, sf_dir).groupBy("y", kind.alias("product"), "local", "bio", "label").agg(F.round(F.sum("net"), 2).alias("net"), F.count_distinct("site").alias("sites"))


@query("""WITH a AS (SELECT CASE WHEN s_nationkey % 6 = 0 THEN NULL ELSE s_nationkey END AS grp, sum(s_acctbal) AS bal FROM supplier WHERE s_nationkey < 20 GROUP BY ALL),
b AS (SELECT CASE WHEN c_nationkey % 6 = 0 THEN NULL ELSE c_nationkey END AS grp, sum(CASE WHEN c_nationkey = 21 THEN 0 ELSE c_acctbal END) AS spent FROM customer WHERE c_nationkey > 3 GROUP BY ALL)
SELECT coalesce(a.grp, b.grp) AS grp, round(coalesce(bal, 0), 2) AS bal, round(coalesce(spent, 0), 2) AS spent FROM a FULL OUTER JOIN b ON a.grp IS NOT DISTINCT FROM b.grp WHERE coalesce(bal, 0) <> 0 OR coalesce(spent, 0) <> 0""")
def full_outer_zero_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts side by side, null keys meeting null keys, rows of zeros only left out."""
    grp = lambda c: F.when(F.col(c) % 6 == 0, None).otherwise(F.col(c)).alias("grp")
    a = table(spark, sf_dir, "supplier").where("s_nationkey < 20").groupBy(grp("s_nationkey")).agg(F.sum("s_acctbal").alias("bal"))
    b = table(spark, sf_dir, "customer").where("c_nationkey > 3").groupBy(grp("c_nationkey")).agg(F.sum(F.when(F.col("c_nationkey") == 21, 0).otherwise(F.col("c_acctbal"))).alias("spent"))
    out = J.full_outer_zero(a, b, ["grp"], ["bal", "spent"])
    return out.select("grp", F.round("bal", 2).alias("bal"), F.round("spent", 2).alias("spent"))


@query("""WITH m AS (SELECT l_suppkey AS site, CAST(l_shipdate AS DATE) AS day, CAST(l_linenumber AS VARCHAR) AS code, sum(l_quantity) AS v FROM lineitem WHERE l_linenumber < 4 GROUP BY ALL),
x AS (SELECT l_suppkey AS site, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS extra FROM lineitem WHERE l_linenumber >= 6 GROUP BY ALL),
o AS (SELECT site, day, code, v + CASE WHEN code = '1' THEN coalesce(extra, 0) ELSE 0 END AS v FROM m LEFT JOIN x USING (site, day)
 UNION ALL SELECT site, day, '1', extra FROM x WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.site = x.site AND m.day = x.day AND code = '1'))
SELECT site, code, count(*) AS n, sum(v) AS v FROM o GROUP BY ALL""")
def consolidate_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums of special rows join the main code's rows, or make new ones."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("site"), F.to_date("l_shipdate").alias("day"), F.col("l_linenumber"), F.col("l_quantity").alias("v"))
    rows = li.where("l_linenumber < 4").groupBy("site", "day", F.col("l_linenumber").cast("string").alias("code")).agg(F.sum("v").alias("v"))
    out = A.consolidated(rows, li.where("l_linenumber >= 6"), ["site", "day"], "code", "1", "v")
    return out.groupBy("site", "code").agg(F.count("*").alias("n"), F.sum("v").alias("v"))


@query("""WITH d AS (SELECT l_suppkey % 10 AS site, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(l_shipdate AS DATE) AS day, sum(CASE WHEN l_linenumber = 1 THEN l_quantity ELSE 0 END) AS s1, sum(CASE WHEN l_linenumber = 2 THEN l_quantity ELSE 0 END) AS s2, sum(l_extendedprice) AS amount FROM lineitem GROUP BY ALL)
SELECT site, day, sum(s1) OVER w AS neff_1, sum(s2) OVER w AS neff_2, round(sum(amount) OVER w, 2) AS total, round(CASE WHEN sum(s1) OVER w + sum(s2) OVER w = 0 THEN 0 ELSE sum(amount) OVER w / (sum(s1) OVER w + sum(s2) OVER w) END, 4) AS cost FROM d WINDOW w AS (PARTITION BY site, y ORDER BY day ROWS UNBOUNDED PRECEDING)""")
def ytd_cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums from the year's start by site, and the cost of a meal."""
    li = table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 10).alias("site"), F.year("l_shipdate").alias("y"), F.to_date("l_shipdate").alias("day"), "l_linenumber", "l_quantity", "l_extendedprice").na.drop(subset=["site", "y"])
    wide = A.wide_sums(li, ["site", "y", "day"], "l_linenumber", [1, 2], {"s": "l_quantity"}).join(li.groupBy("site", "y", "day").agg(F.sum("l_extendedprice").alias("amount")), ["site", "y", "day"])
    out = W.running(wide, ["site", "y"], ["day"], {"neff_1": "s_1", "neff_2": "s_2", "total_raw": "amount"})
    return out.select("site", "day", "neff_1", "neff_2", F.round("total_raw", 2).alias("total"), S.ratio(F.col("total_raw"), F.col("neff_1") + F.col("neff_2"), 1, 4).alias("cost"))


OFF = [("1996-02-10", "1996-02-25"), ("1996-04-06", "1996-04-21"), ("1996-05-01", "1996-05-01"), ("1997-12-20", "1998-01-04")]
_OFF = "(VALUES " + ", ".join(f"(DATE '{a}', DATE '{b}')" for a, b in OFF) + ") AS h(a, b)"


def days_off(spark: SparkSession) -> DataFrame:
    p = spark.createDataFrame(OFF, "a string, b string").select(F.to_date("a").alias("a"), F.to_date("b").alias("b"))
    return C.days_of(p, "a", "b")


@query(f"""WITH s AS (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(min(o_orderdate) AS DATE) + 40 AS b FROM orders GROUP BY ALL),
d AS (SELECT o_custkey, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM s), o AS (SELECT DISTINCT unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM {_OFF})
SELECT o_custkey, count(*) FILTER (isodow(day) < 6 AND day NOT IN (SELECT day FROM o)) AS working_days FROM d GROUP BY ALL""")
def working_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days between two dates that are no weekend and no holiday."""
    s = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a")).withColumn("b", F.date_add("a", 40))
    return C.working_days(s, "o_custkey", "a", "b", days_off(spark))


@query("""WITH q AS (SELECT * FROM (VALUES (0, DATE '1996-01-01', DATE '1996-03-31', 1), (0, DATE '1996-04-01', DATE '1996-12-31', 2), (1, DATE '1996-01-01', DATE '1996-06-30', 1)) AS v(grp, a, b, quarter)),
f AS (SELECT o_custkey % 3 AS grp, CAST(o_orderdate AS DATE) AS day, o_orderkey % 4 AS k FROM orders WHERE year(o_orderdate) = 1996),
j AS (SELECT f.*, quarter, q.grp IS NULL AS none FROM f LEFT JOIN q ON f.grp = q.grp WHERE q.grp IS NULL OR day BETWEEN a AND b)
SELECT grp, quarter, count(*) AS n, sum(CASE WHEN quarter IS NOT NULL AND 3 * k + quarter BETWEEN 1 AND 6 THEN CAST((3 * k + quarter) * 1.5 AS DOUBLE) ELSE 0 END) AS tariff FROM j GROUP BY ALL""")
def tariff_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarter's entry of a list of tariffs; groups without quarters stay."""
    q = spark.createDataFrame([(0, "1996-01-01", "1996-03-31", 1), (0, "1996-04-01", "1996-12-31", 2), (1, "1996-01-01", "1996-06-30", 1)], "grp long, a string, b string, quarter int").withColumns({"a": F.to_date("a"), "b": F.to_date("b")})
    f = table(spark, sf_dir, "orders").where(F.year("o_orderdate") == 1996).select((F.col("o_custkey") % 3).alias("grp"), F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") % 4).alias("k"))
    j = J.period_or_none(f, ["grp"], "day", q, "a", "b")
    tariffs = F.lit("[" + ", ".join(str(1.5 * i) for i in range(1, 7)) + "]")
    v = F.coalesce(S.json_kth(tariffs, 3 * F.col("k") + F.col("quarter")), F.lit(0.0))
    return j.select("grp", "quarter", v.alias("v")).groupBy("grp", "quarter").agg(F.count("*").alias("n"), F.sum("v").alias("tariff"))


@query("""SELECT o_orderpriority AS tranche, count(*) AS files, count(*) FILTER (o_orderstatus = 'F') AS approved, round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 2) AS approved_pct, round(sum(o_totalprice) / count(DISTINCT o_custkey), 2) AS per_user FROM orders GROUP BY ALL""")
def kpi_by_tranche(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key figures by tranche."""
    done = F.count_if(F.col("o_orderstatus") == "F")
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("tranche")).agg(F.count("*").alias("files"), done.alias("approved"), S.ratio(done, F.count("*"), 100).alias("approved_pct"), S.ratio(F.sum("o_totalprice"), F.count_distinct("o_custkey")).alias("per_user"))


@query("""SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'purchase') AS purchase FROM events GROUP BY ALL""")
def pivot_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column for each kind, from a given list."""
    kinds = ["click", "view", "purchase"]
    p = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).pivot("event_type", kinds).agg(F.count(F.lit(1)))
    return p.na.fill(0, kinds)


@query("""SELECT n_name AS "Organisation", count(*) AS "Dossiers", round(100.0 * count(*) FILTER (o_orderstatus <> 'P') / count(*), 2) AS "Taux" FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def export_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export under its labels."""
    from ..operators.tables import export

    t = lambda n: table(spark, sf_dir, n)
    star = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    own = star.groupBy("n_name").agg(F.count("*").alias("files"), S.ratio(F.count_if(F.col("o_orderstatus") != "P"), F.count("*"), 100).alias("rate"))
    return export(own, {"n_name": "Organisation", "files": "Dossiers", "rate": "Taux"})


@query("""SELECT day, model, horizon, value FROM (SELECT CAST(l_shipdate AS DATE) AS day, l_linestatus || l_linenumber AS model, l_orderkey % 28 AS horizon, l_quantity AS value,
 row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE) ORDER BY CASE l_linestatus || l_linenumber WHEN 'O3' THEN 1 WHEN 'F2' THEN 2 WHEN 'O1' THEN 3 ELSE 4 END, l_orderkey % 28, l_linestatus || l_linenumber, l_quantity) AS n FROM lineitem) WHERE n = 1""")
def best_forecast_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a day's forecasts that of the first model in a list, then of the shortest horizon."""
    li = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"), F.concat("l_linestatus", F.col("l_linenumber").cast("string")).alias("model"), (F.col("l_orderkey") % 28).alias("horizon"), F.col("l_quantity").alias("value"))
    rank = F.coalesce(F.element_at(F.create_map(F.lit("O3"), F.lit(1), F.lit("F2"), F.lit(2), F.lit("O1"), F.lit(3)), F.col("model")), F.lit(4))
    return W.latest(li, ["day"], [rank, F.col("horizon"), F.col("model"), F.col("value")])
