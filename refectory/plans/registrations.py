"""The registration, billing and school reports (R1, R2, R8, R11, R13, R27) on the driver's tables: orders stand for registrations, customers
for users, nations for organisations, lines for bills, suppliers for schools."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from . import reports as R
from .base import query, table


def domain(spark: SparkSession, sf_dir: str) -> R.Tables:
    """The tables of registrations. Some sessions lack an organisation or a wave, some waves a school year, some users a snapshot."""
    f, o, c = spark.createDataFrame, table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key, user = F.col("o_orderkey"), F.col("o_custkey")
    status = F.when(F.col("o_orderstatus") == "F", "approved").when(F.col("o_orderstatus") == "O", "pending").when(key % 4 != 0, "rejected")
    registration = o.select(
        key.alias("id"), status.alias("status"), (user % 40).alias("id_session"), user.alias("id_user"), F.when(key % 5 != 0, user % 4 + 1).alias("tranche_id"), F.when(key % 7 != 0, user % 3 + 1).alias("subgroup_id"),
        F.when(key % 2 == 0, F.col("o_orderpriority")).alias("choice_bank_detail"), F.col("o_orderdate").alias("created_at"), F.when(key % 11 != 0, F.col("o_orderdate") + F.make_interval(days=(key % 30).cast("int"))).alias("updated_at"),
    )
    year = F.explode(F.when(F.col("c_custkey") % 6 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    snapshots = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id_user"), year.alias("school_year_id"))
    snapshots = snapshots.select("*", F.substring(F.lit("ABCD"), (F.col("id_user") % 4 + 1).cast("int"), F.lit(1)).alias("label_tranche"), F.when(F.col("id_user") % 2 == 0, "own").alias("label_subgroup"), F.lit("g").alias("label_group"), F.when(F.col("id_user") % 9 == 0, "debit").alias("choice_bank_details"))
    n = table(spark, sf_dir, "nation")
    return {
        "registration": registration, "user_info_school_year": snapshots,
        "session": spark.range(40).select("id", (F.col("id") % 27).alias("id_organization"), (F.col("id") % 4 + 1).alias("id_vague")),
        "vague": f([(1, "w1", 1), (2, "w2", 2), (3, "w3", 9)], "id_vague long, name string, id_school_year long"),
        "school_year": f([(1, "1995-1996"), (2, "1996-1997")], "school_year_id long, label string"),
        "organization": n.select(F.col("n_nationkey").alias("id_organization"), F.col("n_name").alias("name"), F.lit("c").alias("city"), F.lit("t").alias("type"), F.lit("d").alias("department"), F.lit(1.0).alias("ips")),
        "tranche": f([(i, f"T{i}") for i in range(1, 5)], "id_tranche long, label string"),
        "subgroup": f([(1, "S1", "fixed"), (2, "S2", None), (3, "S3", "meal")], "id_subgroup long, label string, facturation_type string"),
    }


_STAR = """(WITH r AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'approved' WHEN o_orderstatus = 'O' THEN 'pending' WHEN o_orderkey % 4 <> 0 THEN 'rejected' END AS status, o_custkey % 40 AS ses, o_custkey AS id_user,
  CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey % 4 + 1 END AS tr, CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey % 3 + 1 END AS sg, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS pay,
  CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) END AS changed_at FROM orders),
u AS (SELECT c_custkey AS k, y, substr('ABCD', CAST(c_custkey % 4 + 1 AS INTEGER), 1) AS ut, CASE WHEN c_custkey % 2 = 0 THEN 'own' END AS us, CASE WHEN c_custkey % 9 = 0 THEN 'debit' END AS up FROM customer, (VALUES (1), (2)) AS y(y) WHERE c_custkey % 3 = 0 AND (y = 1 OR c_custkey % 6 = 0))
SELECT r.id, status, id_user, changed_at, n_name AS organization, w.name AS wave, w.id_school_year, CASE w.id_school_year WHEN 1 THEN '1995-1996' WHEN 2 THEN '1996-1997' END AS school_year,
  coalesce(ut, 'T' || tr, 'none') AS tranche, coalesce(us, 'S' || sg) AS subgroup, CASE sg WHEN 1 THEN 'fixed' WHEN 3 THEN 'meal' ELSE 'autre' END AS billing, coalesce(up, pay) AS choice
FROM r JOIN nation ON n_nationkey = ses % 27 JOIN (VALUES (1, 'w1', 1), (2, 'w2', 2), (3, 'w3', 9)) AS w(v, name, id_school_year) ON w.v = ses % 4 + 1 LEFT JOIN u ON u.k = id_user AND u.y = w.id_school_year)"""
_STATUS = ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ("approved", "pending", "rejected", "draft"))
_T1 = f"SELECT id_school_year, school_year, organization, wave, tranche, billing, count(*) AS total, {_STATUS}, count(*) FILTER (status NOT IN ('approved', 'rejected')) AS unfinished FROM {_STAR} GROUP BY ALL"
_T2 = f"SELECT id_school_year, organization, wave, subgroup, choice, count(*) AS total, {_STATUS} FROM {_STAR} GROUP BY ALL"


@query(_T1)
def report_tarification_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by organisation, wave, tranche and billing class."""
    return R.tarification_1(domain(spark, sf_dir))


@query(_T2)
def report_tarification_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2: files by status, subgroup and way of payment."""
    return R.tarification_2(domain(spark, sf_dir))


@query(f"""SELECT 'tarification_1' AS report, id_school_year, count(*) AS rows, CAST(sum(total) AS BIGINT) AS files FROM ({_T1}) GROUP BY ALL
UNION ALL SELECT 'tarification_2', id_school_year, count(*), CAST(sum(total) AS BIGINT) FROM ({_T2}) GROUP BY ALL""")
def report_by_school_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two reports written by school year, and what is read back of each year."""
    t, at = domain(spark, sf_dir), work_path(spark, "years")
    R.by_school_year({"tarification_1": R.tarification_1(t), "tarification_2": R.tarification_2(t)}, at)
    own = lambda n: spark.read.parquet(f"{at}/{n}").groupBy(F.lit(n).alias("report"), F.col("id_school_year").cast("long").alias("id_school_year")).agg(F.count("*").alias("rows"), F.sum("total").alias("files"))
    return own("tarification_1").unionByName(own("tarification_2"))


@query(f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY id_user, id_school_year ORDER BY changed_at DESC NULLS LAST, id DESC) AS n FROM {_STAR})
SELECT id_user, id_school_year, tranche, subgroup, choice, changed_at FROM k WHERE n = 1""")
def report_user_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's snapshot of a school year, from the latest registration."""
    return R.user_info_school_year(domain(spark, sf_dir))


@query("""SELECT 'g' || l_suppkey % 5 AS label_group, 's' || l_linenumber % 3 AS subgroup, l_returnflag AS tranche_label, l_linestatus AS billing_type, quarter(l_shipdate) AS trimestre_id, round(sum(l_extendedprice), 2) AS billed,
  round(sum(CASE WHEN l_discount > 0.02 THEN l_extendedprice * l_discount END), 2) AS aid, round(sum(l_tax), 2) AS adjusted, count(*) AS bills FROM lineitem WHERE l_orderkey % 10 <> 0 GROUP BY ALL""")
def report_bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts by group, tranche, billing type and trimester; simulated bills don't count, those not marked do."""
    li, key = table(spark, sf_dir, "lineitem"), F.col("l_orderkey") % 10
    bills = li.select(
        F.concat(F.lit("g"), (F.col("l_suppkey") % 5).cast("string")).alias("label_group"), F.concat(F.lit("s"), (F.col("l_linenumber") % 3).cast("string")).alias("subgroup"), F.col("l_returnflag").alias("tranche_label"), F.col("l_linestatus").alias("billing_type"),
        F.quarter("l_shipdate").alias("trimestre_id"), F.col("l_extendedprice").alias("bill_amount"), F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice") * F.col("l_discount")).alias("aid_amount"), F.col("l_tax").alias("fee_adjustment_amount"), F.when(key != 1, key == 0).alias("is_simulation"),
    )
    return R.constatation_reporting({"constatation": bills}).withColumns({c: F.round(c, 2) for c in ("billed", "aid", "adjusted")})


_ZONES = {0: "A", 1: "B", 2: "C"}


@query("""WITH d AS (SELECT 'u' || s_suppkey AS uai, s_name AS nom_etablissement, CASE WHEN s_suppkey % 6 = 0 THEN 'x' ELSE CAST(s_nationkey % 4 AS VARCHAR) END AS code_academie FROM supplier
  UNION ALL SELECT 'u' || s_suppkey, 'AAA', '1' FROM supplier WHERE s_suppkey % 10 = 0),
k AS (SELECT uai, min(nom_etablissement) AS nom_etablissement, arg_min(code_academie, nom_etablissement) AS code_academie FROM d GROUP BY uai),
i AS (SELECT 'u' || s_suppkey AS uai, CAST(1995 + s_suppkey % 2 + y AS VARCHAR) AS school_year, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS ips FROM supplier, (VALUES (0), (2)) AS y(y) WHERE s_suppkey % 3 <> 0)
SELECT k.uai, nom_etablissement, code_academie, coalesce(i.school_year, n.y) AS school_year, ips, CASE code_academie WHEN '0' THEN 'A' WHEN '1' THEN 'B' WHEN '2' THEN 'C' END AS vacances_zone
FROM k LEFT JOIN i USING (uai) LEFT JOIN (VALUES ('1995'), ('1996'), ('1997')) AS n(y) ON i.uai IS NULL""")
def report_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schools of a directory with double entries, the largest index of each year, a row a year where there is none, the zone."""
    s, f = table(spark, sf_dir, "supplier"), spark.createDataFrame
    uai, k = F.concat(F.lit("u"), F.col("s_suppkey").cast("string")).alias("uai"), F.col("s_suppkey")
    directory = s.select(uai, F.col("s_name").alias("nom_etablissement"), F.when(k % 6 == 0, "x").otherwise((F.col("s_nationkey") % 4).cast("string")).alias("code_academie"))
    directory = directory.unionByName(s.where("s_suppkey % 10 = 0").select(uai, F.lit("AAA").alias("nom_etablissement"), F.lit("1").alias("code_academie")))
    ips = F.when(F.col("s_acctbal") > 0, F.col("s_acctbal"))
    twice = f([(0, 1.0), (0, 0.5), (2, 1.0), (2, 0.5)], "y int, part double")  # two years, two values a year
    index = s.where("s_suppkey % 3 <> 0").select(uai, k.alias("k"), ips.alias("ips")).crossJoin(F.broadcast(twice))
    index = index.select("uai", (1995 + F.col("k") % 2 + F.col("y")).cast("string").alias("school_year"), (F.col("ips") * F.col("part")).alias("ips"))
    return R.etablissement_detail(directory, index, _ZONES, f([("1995",), ("1996",), ("1997",)], "school_year string"))
