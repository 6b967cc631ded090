"""Table maintenance on the driver's tables: merges, replacements, reconciliation, de-duplication, audits, scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables as K
from ..operators import windows as W
from ..operators.parts import PartedTable, slices
from ..session import work_path
from ..sources import files
from .base import SQL, query, table

AS_OF = "1998-06-15"
KEYS = ["l_orderkey", "l_linenumber"]


def _changes(li: DataFrame) -> DataFrame:
    """Later versions of some lines, and lines that are new."""
    return li.where("l_orderkey % 5 = 0").select(F.when(F.col("l_orderkey") % 10 == 0, F.col("l_orderkey")).otherwise(-F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber", (F.col("l_quantity") + 1).alias("l_quantity"), "l_shipdate", "l_partkey", "l_suppkey")


_CHANGES = "(SELECT CASE WHEN l_orderkey % 10 = 0 THEN l_orderkey ELSE -l_orderkey END AS l_orderkey, l_linenumber, l_quantity + 1 AS l_quantity, l_shipdate, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey % 5 = 0)"
_PICK = "row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC)"
ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity"]


@query(f"""WITH s AS (SELECT * FROM (SELECT *, {_PICK} AS n FROM {_CHANGES}) WHERE n = 1),
m AS (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber)
  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity FROM s)
SELECT l_linenumber, l_orderkey < 0 AS is_new, count(*) AS n, sum(l_quantity) AS qty FROM m GROUP BY ALL""")
def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed and new lines merged by key."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate", "l_partkey", "l_suppkey")
    m = K.merge_upsert(li, _changes(li), KEYS, [F.desc_nulls_last(c) for c in ORDER])
    return m.groupBy("l_linenumber", (F.col("l_orderkey") < 0).alias("is_new")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query("""WITH t AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS pri FROM orders),
s AS (SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS latest FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY ALL)
SELECT coalesce(pri, latest) AS pri, count(*) AS n FROM t LEFT JOIN s USING (o_custkey) GROUP BY ALL""")
def merge_update_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls of matched rows are filled."""
    o = table(spark, sf_dir, "orders")
    t = o.select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(F.col("o_orderpriority")).alias("pri"))
    s = o.where("o_orderkey % 3 <> 0").select("o_custkey", F.col("o_orderpriority").alias("pri"), "o_orderdate", "o_orderkey")
    return K.merge_update_only(t, s, ["o_custkey"], ["pri"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).groupBy("pri").agg(F.count("*").alias("n"))


@query("""WITH n AS (SELECT l_suppkey, l_shipdate, l_quantity * 2 AS l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_suppkey % 2 = 0),
f AS (SELECT l_suppkey, min(l_shipdate) AS first_at FROM n GROUP BY ALL),
m AS (SELECT l_suppkey, l_shipdate, l_quantity FROM lineitem LEFT JOIN f USING (l_suppkey) WHERE first_at IS NULL OR l_shipdate < first_at UNION ALL SELECT * FROM n)
SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS qty FROM m GROUP BY ALL""")
def rewind_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5: per site, rows from the first new one on are replaced."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity")
    new = li.where((F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp")) & (F.col("l_suppkey") % 2 == 0)).withColumn("l_quantity", F.col("l_quantity") * 2)
    return K.rewind_replace(li, new, "l_suppkey", "l_shipdate").groupBy("l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))


@query("""WITH t AS (SELECT year(o_orderdate) AS y, o_totalprice AS v FROM orders), n AS (SELECT y, v / 2 AS v FROM t WHERE y IN (1996, 1998))
SELECT y, count(*) AS n, sum(v) AS amount FROM (SELECT * FROM t WHERE y NOT IN (SELECT y FROM n) UNION ALL SELECT * FROM n) GROUP BY ALL""")
def replace_year_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6, K7: the years that new rows hold are replaced."""
    t = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), F.col("o_totalprice").alias("v"))
    new = t.where("y IN (1996, 1998)").withColumn("v", F.col("v") / 2)
    return K.replace_slice(t, new, ["y"]).groupBy("y").agg(F.count("*").alias("n"), F.sum("v").alias("amount"))


@query(SQL["replace_year_slice"])
def replace_year_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6, K7: the same on disk: only the years that new rows hold are written, the others stay where they are."""
    t = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("y"), F.col("o_totalprice").alias("v"))
    held = PartedTable(spark, work_path(spark, "years"), slices(["y"]))
    held.write(t)
    held.replace(t.where("y IN (1996, 1998)").withColumn("v", F.col("v") / 2))
    held.replace(t.limit(0))
    return held.read().groupBy("y").agg(F.count("*").alias("n"), F.sum("v").alias("amount"))


@query("""WITH r AS (SELECT * FROM orders WHERE o_orderkey % 4 = 0),
m AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM r) UNION ALL SELECT * FROM r WHERE o_orderstatus <> 'P')
SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS amount FROM m GROUP BY ALL""")
def purge_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received ids leave, the active ones come back."""
    o = table(spark, sf_dir, "orders")
    m = K.purge_insert(o, o.where("o_orderkey % 4 = 0"), "o_orderkey", F.col("o_orderstatus") != "P")
    return m.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("amount"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderkey % 9 = 0 GROUP BY ALL")
def reconcile_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a window that the source no longer has."""
    o = table(spark, sf_dir, "orders")
    return K.stale_ids(o, o.where("o_orderkey % 9 <> 0"), "o_orderkey", F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp"))


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM (SELECT *, {_PICK} AS n FROM lineitem) WHERE n = 1")
def dedup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line a key, the latest."""
    li = table(spark, sf_dir, "lineitem")
    return W.latest(li, KEYS, [F.desc(c) for c in ORDER]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


@query("SELECT count(*) AS duplicated, CAST(sum(n - 1) AS BIGINT) AS surplus, max(n) AS most FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def duplicate_surplus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many keys have several lines, and how many lines are too many."""
    return K.duplicate_surplus(table(spark, sf_dir, "lineitem"), KEYS).agg(F.count("*").alias("duplicated"), F.sum("surplus").alias("surplus"), F.max("n").alias("most"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL ORDER BY n DESC, l_orderkey, l_linenumber LIMIT 20")
def top_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2, O1: the 20 keys with the most lines."""
    return table(spark, sf_dir, "lineitem").groupBy(*KEYS).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *KEYS).limit(20)


@query(f"SELECT year(l_shipdate) AS y, count(*) AS n FROM lineitem WHERE l_shipdate <= DATE '{AS_OF}' + INTERVAL 1 MONTH GROUP BY ALL")
def drop_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows beyond a month after the given day go."""
    return K.drop_future(table(spark, sf_dir, "lineitem"), "l_shipdate", AS_OF, 1).groupBy(F.year("l_shipdate").alias("y")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderstatus, count(*) AS n FROM orders WHERE NOT (o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND o_orderdate >= TIMESTAMP '1998-01-01') GROUP BY ALL""")
def orphan_not_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the latest period without a parent go."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_acctbal > 0")
    return K.without_orphans(o, "o_custkey", c, "c_custkey", F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp")).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("""SELECT l_suppkey, least(max(CAST(l_shipdate AS DATE)), DATE '1998-06-15' - 45) AS read_from FROM lineitem WHERE l_suppkey % 3 = 0 GROUP BY ALL
UNION ALL SELECT s_suppkey, DATE '1990-01-01' FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_suppkey % 3 = 0)""")
def high_water_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From where each site is to be read on."""
    li = table(spark, sf_dir, "lineitem").where("l_suppkey % 3 = 0")
    sites = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"))
    return files.high_water_marks(li, "l_suppkey", "l_shipdate", AS_OF, 45, sites, "1990-01-01")


@query("SELECT min(y) AS first_year, max(y) AS last_year FROM (SELECT year(o_orderdate) AS y FROM orders UNION ALL SELECT year(l_shipdate) FROM lineitem)")
def year_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10."""
    return files.year_range((table(spark, sf_dir, "orders"), "o_orderdate"), (table(spark, sf_dir, "lineitem"), "l_shipdate"))


@query("SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS amount FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' GROUP BY ALL")
def date_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A half-open slice of dates, pushed to the scan."""
    return files.date_slice(table(spark, sf_dir, "orders"), "o_orderdate", "1996-01-01", "1997-01-01").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("amount"))


@query("""SELECT source_id, count(*) AS n, count(DISTINCT source_id || '_' || o_orderkey) AS keys, sum(o_totalprice) AS amount
FROM (SELECT 'group_' || (o_orderkey % 3) AS source_id, * FROM orders) GROUP BY ALL""")
def consolidate_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of one layout as one."""
    o = table(spark, sf_dir, "orders")
    all_ = files.consolidated({f"group_{i}": o.where(F.col("o_orderkey") % 3 == i) for i in range(3)}, "o_orderkey")
    return all_.groupBy("source_id").agg(F.count("*").alias("n"), F.count_distinct("pk").alias("keys"), F.sum("o_totalprice").alias("amount"))


@query("SELECT 'orders' AS table_name, count(*) AS rows, min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts, 'complete' AS status FROM orders")
def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K16."""
    return K.load_audit(table(spark, sf_dir, "orders"), "orders", "o_orderdate")


@query("""WITH t AS (SELECT *, year(o_orderdate) AS y FROM orders) SELECT o_orderkey, y FROM t WHERE y = (SELECT max(y) - 1 FROM t)""")
def school_year_backup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The past year's rows, when a new one has begun."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    last = o.agg(F.max("y") - 1).first()[0]
    return K.year_changed(o, "y", last)


@query("""SELECT * FROM (SELECT o_custkey, o_orderkey, o_totalprice, max(o_orderkey) OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE o_orderkey = m""".replace("SELECT * FROM", "SELECT DISTINCT o_custkey, o_orderkey, o_totalprice FROM", 1))
def latest_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row of the largest index by key."""
    best = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max_by(F.struct("o_orderkey", "o_totalprice"), "o_orderkey").alias("b"))
    return best.select("o_custkey", "b.o_orderkey", "b.o_totalprice")
