"""Row normalisation, filters and scalar functions on the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import rows as R
from ..spec import TableSpec
from .base import query, table

LINE = TableSpec(
    "mvtart",
    {"pk": "string", "login_site": "string", "id_article": "long", "qteart": "double", "dtemvt": "timestamp", "valide": "boolean", "etat": "string"},
    keys=("pk",), watermark="dtemvt", renames={"l_partkey": "id_article", "l_quantity": "qteart", "l_shipdate": "dtemvt", "l_returnflag": "etat", "l_linestatus": "valide"},
    pk_from=("login_site", "id_article"), site_column="login_site",
)


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as an API hands them over: all text, with blanks, nan and yes/no."""
    li = table(spark, sf_dir, "lineitem")
    text = lambda c: F.col(c).cast("string")
    return li.select(
        F.when(F.col("l_partkey") % 11 == 0, F.lit(" nan ")).otherwise(F.concat(F.lit(" "), text("l_partkey"), F.lit(" "))).alias("lPartkey"),
        F.when(F.col("l_suppkey") % 13 == 0, F.lit("x1")).otherwise(text("l_quantity")).alias("lQuantity"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("lShipdate"),
        F.when(F.col("l_returnflag") == "R", F.lit("  ")).otherwise(F.col("l_returnflag")).alias("lReturnflag"),
        F.when(F.col("l_linestatus") == "O", "Oui").when(F.col("l_linenumber") == 1, "?").otherwise("0").alias("lLinestatus"), "l_suppkey",
    )


_RAW = """WITH r AS (SELECT CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_partkey END AS id_article, CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_quantity END AS qteart,
 l_shipdate AS dtemvt, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END AS etat, CASE WHEN l_linestatus = 'O' THEN true WHEN l_linenumber = 1 THEN NULL ELSE false END AS valide,
 CAST(l_suppkey % 4 AS VARCHAR) AS login_site FROM lineitem)"""


@query(_RAW + """ SELECT login_site, login_site || '_' || coalesce(CAST(id_article AS VARCHAR), 'nan') AS pk, etat, valide, count(*) AS n, sum(qteart) AS qty, max(dtemvt) AS last_at FROM r GROUP BY ALL""")
def normalize_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows by a declared schema."""
    raw = raw_lines(spark, sf_dir)
    n = R.normalize(raw, LINE, (F.col("l_suppkey") % 4).cast("string"))
    return n.groupBy("login_site", "pk", "etat", "valide").agg(F.count("*").alias("n"), F.sum("qteart").alias("qty"), F.max("dtemvt").cast("timestamp").alias("last_at"))


@query("""SELECT CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 7 AS INTEGER) WHEN c_custkey % 4 = 1 THEN NULL ELSE CAST(c_custkey % 7 AS INTEGER) END AS i,
 count(*) AS n, sum(CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE round(c_acctbal, 2) END) AS amount FROM customer GROUP BY ALL""")
def try_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient numbers, codes with leading zeros, decimal commas."""
    c = table(spark, sf_dir, "customer")
    k = (F.col("c_custkey") % 7).cast("string")
    raw = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit(" 0"), k)).when(F.col("c_custkey") % 4 == 1, F.concat(k, F.lit("a"))).when(F.col("c_custkey") % 4 == 2, F.concat(k, F.lit(".0"))).otherwise(k)
    comma = F.when(F.col("c_custkey") % 5 == 0, F.lit("n/a")).otherwise(F.replace(F.round("c_acctbal", 2).cast("string"), F.lit("."), F.lit(",")))
    own = c.select(S.to_type(raw, "int").alias("i"), S.decimal_comma(comma).alias("v"))
    return own.groupBy("i").agg(F.count("*").alias("n"), F.sum("v").alias("amount"))


@query("""SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n, sum(value) AS amount FROM events GROUP BY ALL""")
def nested_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON object's field; rows lacking it would be set apart."""
    e = table(spark, sf_dir, "events").withColumn("p", F.from_json("props", "struct<k: bigint>"))
    good, _ = R.rejected(e, ["p.k"])
    return good.groupBy("event_type", F.col("p.k").alias("k")).agg(F.count("*").alias("n"), F.sum("value").alias("amount"))


@query("""SELECT user_id % 3 AS g, event_id % 5 AS a, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS b, CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id % 6 END AS c, NULL::BIGINT AS d, count(*) AS n FROM events GROUP BY ALL""")
def json_list_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the first elements of text lists, Python's booleans tolerated."""
    e = table(spark, sf_dir, "events")
    items = F.concat(F.lit("["), (F.col("event_id") % 5).cast("string"), F.when(F.col("event_id") % 2 == 0, ", True").otherwise(", False"), F.lit(", "), F.when(F.col("event_id") % 4 == 0, "null").otherwise((F.col("user_id") % 6).cast("string")), F.lit("]"))
    a, b, c, d = S.json_columns(F.col("l"), 4)
    own = e.withColumn("l", items).select((F.col("user_id") % 3).alias("g"), a.alias("a"), b.alias("b"), c.alias("c"), d.alias("d"))
    return own.groupBy("g", "a", "b", "c", "d").agg(F.count("*").alias("n"))


@query("""SELECT user_id % 20 AS k, count(*) AS n, sum(CASE WHEN user_id % 20 BETWEEN 1 AND 4 THEN CAST(event_id % 3 + (user_id % 20) * 0.5 AS DOUBLE) ELSE 0 END) AS amount FROM events GROUP BY ALL""")
def json_kth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the k-th number of a text list of four, 0 outside 1 to 15 or beyond the list."""
    e = table(spark, sf_dir, "events")
    base = F.col("event_id") % 3
    items = F.concat(F.lit("["), F.concat_ws(",", *((base + i * 0.5).cast("string") for i in range(1, 5))), F.lit("]"))
    k = F.col("user_id") % 20
    return e.select(k.alias("k"), S.json_kth(items, k).alias("v")).groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("amount"))


@query("""SELECT o_orderpriority, count(*) AS n, sum(o_totalprice) AS amount FROM orders WHERE (o_custkey IN (1, 2, 3) OR o_orderstatus IN ('F')) AND o_orderpriority IN ('1-URGENT', '2-HIGH')
AND o_totalprice BETWEEN 1000 AND 200000 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY ALL""")
def filter_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Criteria on ids or names, lists, ranges and dates; those on columns that aren't there are ignored."""
    o = table(spark, sf_dir, "orders")
    cond = R.matches(o.columns, ids=("o_custkey", [1, 2, 3]), names=("o_orderstatus", ["F"]), equals={"o_orderpriority": ["1-URGENT", "2-HIGH"], "software": ["x"]}, between={"o_totalprice": (1000, 200000)}, dates=("o_orderdate", "1996-01-01", "1998-01-01"))
    return o.where(cond).groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("amount"))


@query("""SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_custkey NOT IN (5, 7, 11) AND NOT (c_custkey % 17 = 0) AND c_nationkey % 3 = 2 GROUP BY ALL""")
def active_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No excluded, fictitious or demo sites, of profile 2."""
    c = table(spark, sf_dir, "customer").withColumn("nometabs", F.when(F.col("c_custkey") % 34 == 0, F.concat(F.lit("[DEMO] "), "c_name")).otherwise(F.col("c_name")))
    c = c.withColumn("fictif", F.when(F.col("c_custkey") % 34 == 17, True).when(F.col("c_custkey") % 2 == 0, None).otherwise(False)).withColumn("profil", F.col("c_nationkey") % 3)
    return R.active_sites(R.excluded(c, "c_custkey", (5, 7, 11))).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query("""SELECT p_brand, count(*) AS n FROM part WHERE p_size % 5 <> 0 AND p_size % 5 <> 1 GROUP BY ALL""")
def automatic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: rows without origin or entered by hand go."""
    p = table(spark, sf_dir, "part").withColumn("origine", F.when(F.col("p_size") % 5 == 0, None).when(F.col("p_size") % 5 == 1, "Manuel-x").otherwise("AUTO"))
    return R.automatic(p).groupBy("p_brand").agg(F.count("*").alias("n"))


@query("""SELECT CAST(p_size AS VARCHAR) AS code FROM part WHERE false UNION ALL SELECT DISTINCT p_size || 'x' FROM part WHERE p_size % 10 = 0""")
def bad_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes that aren't digits only."""
    p = table(spark, sf_dir, "part")
    return R.bad_codes(p.select(F.when(F.col("p_size") % 10 == 0, F.concat(F.col("p_size").cast("string"), F.lit("x"))).otherwise(F.col("p_size").cast("string")).alias("code")), "code")


@query("""WITH m AS (SELECT max(CAST(ts AS DATE)) AS d FROM events) SELECT CAST(ts AS DATE) <= d - 7 AS train, count(*) AS n, min(CAST(ts AS DATE)) AS first_day, max(CAST(ts AS DATE)) AS last_day FROM events, m GROUP BY ALL""")
def split_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P11."""
    train, test = R.split_by_date(table(spark, sf_dir, "events"), "ts", 7)
    both = train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))
    return both.groupBy("train").agg(F.count("*").alias("n"), F.min(F.to_date("ts")).alias("first_day"), F.max(F.to_date("ts")).alias("last_day"))


@query("""SELECT CAST(o_orderdate AS DATE) AS day, lpad(CAST(weekofyear(o_orderdate) AS VARCHAR), 2, '0') AS week, CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year,
CASE WHEN month(o_orderdate) >= 9 THEN year(o_orderdate) || '-' || (year(o_orderdate) + 1) ELSE (year(o_orderdate) - 1) || '-' || year(o_orderdate) END AS school_year,
CAST((dayofweek(o_orderdate) + 6) % 7 AS INTEGER) AS weekday, count(*) AS n FROM orders GROUP BY ALL""")
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO weeks and their years, school years, weekdays from Monday."""
    d = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").groupBy(d.alias("day")).agg(F.count("*").alias("n")).select("day", S.iso_week(F.col("day")).alias("week"), S.iso_year(F.col("day")).alias("iso_year"), S.school_year(F.col("day")).alias("school_year"), F.weekday("day").alias("weekday"), "n")


@query("""SELECT s_suppkey, upper(s_name) AS name, replace(s_name, '#', '') AS stripped, split_part(s_name, '#', 2) AS tail, s_nationkey || '_' || coalesce(CAST(nullif(s_suppkey % 3, 0) AS VARCHAR), 'nan') AS pk,
 CASE s_nationkey % 3 WHEN 0 THEN 'dejeuner' WHEN 1 THEN 'diner' ELSE 'autre' END AS service, CASE WHEN s_acctbal > 0 AND s_suppkey % 3 <> 0 THEN greatest(s_acctbal, 500.0) END AS top, substr('ABCDEFGHIJ', CAST(s_suppkey % 10 + 1 AS INTEGER), 1) AS tranche FROM supplier""")
def text_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, keys, labels, guarded maximum, letters."""
    s = table(spark, sf_dir, "supplier")
    some = F.when((F.col("s_acctbal") > 0) & (F.col("s_suppkey") % 3 != 0), F.col("s_acctbal"))
    return s.select("s_suppkey", S.normal_name(F.col("s_name")).alias("name"), F.replace("s_name", F.lit("#"), F.lit("")).alias("stripped"), S.after_last(F.col("s_name"), "#").alias("tail"), S.key_of(F.col("s_nationkey"), F.nullif(F.col("s_suppkey") % 3, F.lit(0))).alias("pk"), S.labelled(F.col("s_nationkey") % 3, {0: "dejeuner", 1: "diner"}, "autre").alias("service"), S.greatest_or_null(some, F.lit(500.0)).alias("top"), S.letter(F.col("s_suppkey") % 10 + 1, "ABCDEFGHIJ").alias("tranche"))


@query("""SELECT h, CASE WHEN h <= 7 THEN '<=7' WHEN h <= 14 THEN '<=14' WHEN h <= 21 THEN '<=21' ELSE '>21' END AS bin_right, CASE WHEN h < 7 THEN '<7' WHEN h < 14 THEN '<14' WHEN h < 21 THEN '<21' ELSE '>=21' END AS bin_left, n
FROM (SELECT date_diff('day', DATE '1998-06-01', CAST(o_orderdate AS DATE)) AS h, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1998-06-01' AND o_orderdate < TIMESTAMP '1998-07-01' GROUP BY ALL)""")
def horizon_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """horizons and their bins by both conventions."""
    from ..sources.files import date_slice

    o = date_slice(table(spark, sf_dir, "orders"), "o_orderdate", "1998-06-01", "1998-07-01")
    h = F.datediff(F.to_date("o_orderdate"), F.lit("1998-06-01").cast("date")).cast("long")
    d = o.groupBy(h.alias("h")).agg(F.count("*").alias("n"))
    return d.select("h", S.horizon_bin(F.col("h")).alias("bin_right"), S.horizon_bin(F.col("h"), closed="left").alias("bin_left"), "n")
