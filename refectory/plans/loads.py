"""Loads of landed files and lookups on the driver's tables: the tables are written as such files by Spark first."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import calendar as C
from ..functions import scalars as S
from ..operators import joins as J
from ..operators import tables as K
from ..operators.parts import KeyedTable
from ..session import work_path
from ..sources import files
from ..streaming import sync as T
from .base import query, table


@dataclass(frozen=True)
class CsvLoad:
    """A table loaded whole from a CSV file: its columns' types, renames of the file's columns, and the column that marks deleted rows."""

    columns: dict[str, str]
    renames: dict[str, str] = field(default_factory=dict)
    deleted: str | None = None
    sep: str = ","


#: Fixed names of columns in the files and in the tables.
CSV_LOADS = {
    "school_year": CsvLoad({"school_year_id": "long", "label": "string", "start_date": "date", "end_date": "date"}, {"schoolYearId": "school_year_id", "startDate": "start_date", "endDate": "end_date"}),
    "service": CsvLoad({"id_organization": "long", "id_service": "long", "label": "string"}, {"serviceId": "id_service", "organizationId": "id_organization"}),
    "group": CsvLoad({"id_group": "long", "label": "string", "acronym": "string", "id_organization": "long"}, {"groupId": "id_group", "organizationId": "id_organization"}, "deletedAt"),
    "tranche": CsvLoad({"id_tranche": "long", "label": "string", "indice": "long", "id_organization": "long", "quotient": "double"}, {"trancheId": "id_tranche", "organizationId": "id_organization"}, "deletedAt"),
    "booking": CsvLoad({"id_booking": "long", "id_organization": "long", "id_user": "long", "id_service": "long", "date": "date", "created_at": "timestamp", "updated_at": "timestamp"}, {"bookingId": "id_booking", "organizationId": "id_organization", "userId": "id_user", "serviceId": "id_service", "createdAt": "created_at", "updatedAt": "updated_at"}),
    "transaction": CsvLoad({"transaction_id": "long", "user_id": "long", "amount": "double", "status": "string", "created_at": "timestamp", "updated_at": "timestamp"}, {"transactionId": "transaction_id", "userId": "user_id", "createdAt": "created_at", "updatedAt": "updated_at"}, "deletedAt"),
    "trimester": CsvLoad({"trimester_id": "long", "organization_id": "long", "label": "string", "start_date": "date", "end_date": "date", "created_at": "timestamp", "updated_at": "timestamp"}, {"trimesterId": "trimester_id", "organizationId": "organization_id", "startDate": "start_date", "endDate": "end_date", "createdAt": "created_at", "updatedAt": "updated_at"}),
    "organization_enrollment": CsvLoad({"enrollment_id": "long", "organization_id": "long", "school_year_id": "long", "total_enrollment": "long"}, {"enrollmentId": "enrollment_id", "organizationId": "organization_id", "schoolYearId": "school_year_id", "totalEnrollment": "total_enrollment"}),
}


def load_csv(held: K.SnapshotTable, path: str, load: CsvLoad) -> str:
    """The file's rows, less deleted ones, under the table's names and types, as the table's new version. An empty file is refused."""
    df = files.scan_csv(held.spark, path, load.sep)
    if load.deleted in df.columns:
        df = df.where(S.clean_text(F.col(load.deleted)).isNull())
    df = df.select(*(F.col(c).alias(load.renames.get(c, c)) for c in df.columns if c != load.deleted))
    return held.reload(df.select(*(S.to_type(F.col(c), t).alias(c) for c, t in load.columns.items())))


def identity_backfill(users: DataFrame, links: DataFrame, contacts: DataFrame, students: DataFrame) -> DataFrame:
    """Users with names, birth date and organisation of their own contact, where there is one.

    links (userId, contactDetailId, link, deletedAt), contacts (contactDetailId, firstname, lastname, dateBirth, deletedAt), students
    (userId, registerToOrganization, updatedAt, deletedAt); of a user's contacts the smallest id counts, of registrations the latest.
    """
    from ..operators import windows as W

    alive = lambda df: df.where(F.col("deletedAt").isNull())
    own = alive(links).where("link = 'me'").select("userId", "contactDetailId").join(alive(contacts), "contactDetailId")
    own = W.latest(own, ["userId"], [F.col("contactDetailId")])
    last = W.latest(alive(students), ["userId"], [F.desc_nulls_last("updatedAt"), F.col("registerToOrganization")]).select("userId", "registerToOrganization")
    new = own.join(last, "userId", "left").select(F.col("userId").alias("id_user"), F.col("firstname").alias("__first_name"), F.col("lastname").alias("__last_name"), F.col("dateBirth").try_cast("date").alias("__date_birth"), F.col("registerToOrganization").alias("__id_organization"), F.lit(True).alias("__met"))
    j = users.join(new, "id_user", "left")
    return j.select(*(F.when(F.col("__met"), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if f"__{c}" in new.columns else F.col(c) for c in users.columns))


def _csv(df: DataFrame, spark: SparkSession, name: str, sep: str = ",") -> str:
    at = work_path(spark, name)
    df.write.csv(at, header=True, sep=sep)
    return at


@query("SELECT c_custkey AS id_booking, c_nationkey AS id_organization, c_custkey % 7 AS id_user, NULL::BIGINT AS id_service, DATE '1996-01-01' + CAST(c_custkey % 300 AS INTEGER) AS date, TIMESTAMP '1996-01-01 10:00:00' AS created_at, NULL::TIMESTAMP AS updated_at FROM customer WHERE c_custkey % 9 <> 0")
def csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file, deleted rows left out, as the new version of a table."""
    k = F.col("c_custkey")
    raw = table(spark, sf_dir, "customer").select(k.alias("bookingId"), F.col("c_nationkey").alias("organizationId"), (k % 7).alias("userId"), F.lit("nan").alias("serviceId"), F.date_add(F.lit("1996-01-01").cast("date"), (k % 300).cast("int")).alias("date"), F.lit("1996-01-01 10:00:00").alias("createdAt"), F.lit(" ").alias("updatedAt"), F.when(k % 9 == 0, "1996-02-02").alias("deletedAt"))
    held = K.SnapshotTable(spark, work_path(spark, "booking"))
    base = CSV_LOADS["booking"]
    load_csv(held, _csv(raw, spark, "landed"), CsvLoad(base.columns, base.renames, "deletedAt"))
    return held.read()


@query("""SELECT 'a' AS source, c_custkey AS id, c_acctbal AS amount FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'b', c_custkey, c_acctbal FROM customer WHERE c_custkey % 2 = 1""")
def mapped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of unlike columns and separators under one layout, numbers with commas; a missing file is skipped."""
    c = table(spark, sf_dir, "customer")
    comma = F.replace(F.col("c_acctbal").cast("string"), F.lit("."), F.lit(","))
    a = _csv(c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("Numéro"), comma.alias("Montant")), spark, "a", ";")
    b = _csv(c.where("c_custkey % 2 = 1").select(comma.alias("amount eur"), F.col("c_custkey").alias("key")), spark, "b")
    out = files.scan_mapped(spark, {"a": (a, ";", {"Numéro": "id", "Montant": "amount"}), "b": (b, ",", {"key": "id", "amount eur": "amount"}), "c": (f"{a}-none", ",", {"x": "id", "y": "amount"})}, ("amount",))
    return out.select("source", F.col("id").cast("long").alias("id"), "amount")


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, CAST(year(o_orderdate) AS INTEGER) AS annee, 'metropole' AS zone, 'j' || dayofyear(o_orderdate) AS nom_jour_ferie FROM orders WHERE day(o_orderdate) = 1")
def public_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file of public holidays, typed."""
    d = F.to_date("o_orderdate")
    days = table(spark, sf_dir, "orders").where(F.day("o_orderdate") == 1).select(d.alias("date"), F.year(d).alias("annee"), F.lit("metropole").alias("zone"), F.concat(F.lit("j"), F.dayofyear(d).cast("string")).alias("nom_jour_ferie")).distinct()
    return C.public_holidays(spark, _csv(days, spark, "holidays"))


@query("""SELECT 'known' AS part, count(*) AS n, sum(l_quantity) AS qty FROM lineitem WHERE l_returnflag <> 'N' AND l_shipdate >= TIMESTAMP '1998-06-15' - INTERVAL 1500 DAY
UNION ALL SELECT 'future', count(*), sum(l_quantity) FROM lineitem WHERE l_returnflag = 'N'""")
def known_and_future(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last days with a label, and rows without one."""
    li = table(spark, sf_dir, "lineitem").withColumn("label", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    known, future = files.known_and_future(li, "l_shipdate", "label", ["l_shipdate", "label", "l_quantity"], "1998-06-15", 1500)
    part = lambda df, n: df.agg(F.lit(n).alias("part"), F.count("*").alias("n"), F.sum("l_quantity").alias("qty"))
    return part(known, "known").unionByName(part(future, "future"))


@query("SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS amount FROM orders WHERE NOT (o_orderkey % 10 = 0) GROUP BY ALL")
def delete_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose keys came as deleted leave the table; a key given twice or not there changes nothing."""
    o = table(spark, sf_dir, "orders")
    gone = o.where("o_orderkey % 10 = 0").select("o_orderkey")
    return K.delete_keys(o, gone.unionByName(gone).unionByName(gone.select((-F.col("o_orderkey") - 1).alias("o_orderkey"))), ["o_orderkey"]).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("amount"))


@query("""WITH e AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type, max(ts) AS ts, count(*) AS n FROM events GROUP BY ALL)
SELECT user_id, event_type, ts FROM e WHERE user_id % 5 <> 0 OR (user_id % 15 = 0 AND n > 1)""")
def stream_soft_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change batches from a stream, live and deleted rows mixed in the same files, in no order of time.

    Of every fifth user all is deleted at the last event, but of every fifteenth at the first one, so that later events count.
    """
    at = work_path(spark, "changes")
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id", F.lit(None).cast("timestamp").alias("deleted_at"))
    early = F.col("user_id") % 15 == 0
    own = events.where("user_id % 5 = 0").groupBy("user_id").agg(*(f(c).alias(f"{c}_{n}") for n, f in (("a", F.min), ("b", F.max)) for c in ("ts", "event_id")))
    gone = own.select("user_id", F.lit("gone").alias("event_type"), F.when(early, F.col("ts_a")).otherwise(F.col("ts_b")).alias("ts"), F.when(early, F.col("event_id_a")).otherwise(F.col("event_id_b")).alias("event_id")).withColumn("deleted_at", F.col("ts"))
    both = events.unionByName(gone.select(*events.columns))
    both.repartition(6, F.xxhash64("ts", "event_type")).write.parquet(f"{at}/landed")
    held = KeyedTable(spark, f"{at}/table", ["user_id"], [F.desc("ts"), F.desc("event_id")], "deleted_at", 16)
    T.sync(T.landed(spark, f"{at}/landed", 2), T.upsert_batches(held, newest=True), f"{at}/stream")
    return held.read().select("user_id", "event_type", "ts")


@query("SELECT CAST(year(o_orderdate) AS VARCHAR) AS chunk, count(*) AS rows, 'complete' AS status FROM orders GROUP BY ALL UNION ALL SELECT 'none', 0, 'failed'")
def reload_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full reload by year that goes on after a chunk that can't be read, and the audit of it."""
    at = work_path(spark, "reload")
    o = table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate"))
    o.write.partitionBy("y").parquet(f"{at}/landed")
    years = [str(r.y) for r in o.select("y").distinct().orderBy("y").collect()]
    held = K.SnapshotTable(spark, f"{at}/table")
    audit = T.reload_chunks(held, [*years, "none"], lambda y: spark.read.parquet(f"{at}/landed/y={y}"), f"{at}/stage")
    in_table = held.read().groupBy(F.year("o_orderdate").cast("string").alias("chunk")).agg(F.count("*").alias("n"))
    return audit.join(in_table, "chunk", "left").select("chunk", F.coalesce("n", "rows").alias("rows"), "status")


@query("SELECT n_regionkey AS region, count(*) AS n, sum(CASE WHEN c_nationkey % 4 = 0 THEN -1.0 ELSE c_acctbal END) AS amount FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def lookup_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections of some keys go before the own value."""
    c = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    fix = table(spark, sf_dir, "nation").where("n_nationkey % 4 = 0").select(F.col("n_nationkey").alias("c_nationkey"), F.lit(-1.0).alias("c_acctbal"))
    return J.overlay(c, "c_nationkey", fix, "c_acctbal").groupBy(F.col("n_regionkey").alias("region")).agg(F.count("*").alias("n"), F.sum("c_acctbal").alias("amount"))


@query("SELECT CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_regionkey END AS school_year, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def id_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An id followed through two maps, null where the chain breaks."""
    t = lambda n: table(spark, sf_dir, n)
    out = J.id_chain(t("orders"), "o_custkey", [(t("customer"), "c_custkey", "c_nationkey"), (t("nation").where("n_nationkey % 3 <> 0"), "n_nationkey", "n_regionkey")])
    return out.groupBy(F.col("n_regionkey").alias("school_year")).agg(F.count("*").alias("n"))


@query("SELECT n_nationkey AS id, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
def resolve_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of labels, every one of which must be known."""
    t = lambda n: table(spark, sf_dir, n)
    labels = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("label"))
    return J.resolve_ids(labels, "label", t("nation"), "n_name", "n_nationkey").groupBy(F.col("n_nationkey").alias("id")).agg(F.count("*").alias("n"))


@query("SELECT s_nationkey AS uai FROM supplier WHERE s_suppkey % 3 = 0 UNION SELECT c_nationkey FROM customer WHERE c_nationkey > 20")
def key_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of two sources."""
    return J.key_union([(table(spark, sf_dir, "supplier").where("s_suppkey % 3 = 0"), "s_nationkey"), (table(spark, sf_dir, "customer").where("c_nationkey > 20"), "c_nationkey")], "uai")


@query("""WITH s AS (SELECT s_nationkey AS uai, CAST(1995 + s_suppkey % 3 AS INTEGER) AS y, max(s_acctbal) AS ips FROM supplier WHERE s_nationkey < 15 GROUP BY ALL)
SELECT * FROM s UNION ALL SELECT n_nationkey, y, NULL FROM nation CROSS JOIN (VALUES (1995), (1996)) AS v(y) WHERE n_nationkey NOT IN (SELECT uai FROM s)""")
def filled_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities without any row get an empty one for each year."""
    s = table(spark, sf_dir, "supplier").where("s_nationkey < 15").groupBy(F.col("s_nationkey").alias("uai"), (1995 + F.col("s_suppkey") % 3).cast("int").alias("y")).agg(F.max("s_acctbal").alias("ips"))
    years = spark.createDataFrame([(1995,), (1996,)], "y int")
    return J.filled_years(s, table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("uai")), "uai", years, "y", "ips")


@query("""SELECT o_custkey AS constatation_id, o_orderkey AS user_id, l_quantity AS quantity FROM (SELECT *, max(o_orderkey) OVER (PARTITION BY o_custkey) AS m FROM (SELECT DISTINCT o_custkey, o_orderkey FROM orders)) JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey = m""")
def constatation_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest payload's bills as rows, personal fields left out."""
    from . import reports

    t = lambda n: table(spark, sf_dir, n)
    bills = t("lineitem").groupBy("l_orderkey").agg(F.to_json(F.collect_list(F.struct(F.col("l_orderkey").alias("user"), F.lit("secret").alias("name"), F.col("l_quantity").alias("quantity")))).alias("payload"))
    p = t("orders").select("o_custkey", "o_orderkey").distinct().join(bills, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(F.col("o_custkey").alias("constatation_id"), F.col("o_orderkey").alias("payload_index"), "payload", F.lit(False).alias("is_simulation"))
    return reports.constatation_load(p, "struct<user: bigint, name: string, quantity: double>", {"user": "user_id", "quantity": "quantity"})


@query("SELECT s_suppkey AS site, CASE WHEN s_nationkey % 3 = 0 THEN 'A' WHEN s_nationkey % 3 = 1 AND s_nationkey < 20 THEN 'B' END AS zone FROM supplier")
def academy_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zero-padded codes to holiday zones; unknown codes and texts have none."""
    code = F.when(F.col("s_nationkey") < 20, F.lpad(F.col("s_nationkey").cast("string"), 2, "0")).otherwise(F.when(F.col("s_nationkey") % 3 == 0, F.col("s_nationkey").cast("string")).otherwise("n/a"))
    zones = {i: "A" if i % 3 == 0 else "B" for i in range(25) if i % 3 < 2}
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("site"), S.labelled(code.try_cast("int"), zones).alias("zone"))


@query("SELECT l_linenumber, count(*) AS n, count(CASE WHEN l_tax <> 0 THEN 1 END) AS valid, sum(CASE WHEN l_tax <> 0 THEN l_discount / l_tax END) AS total FROM lineitem GROUP BY ALL")
def finite_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and infinities are null in what is given out."""
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    r = F.when(F.col("l_tax") != 0, F.col("l_discount") / F.col("l_tax")).when(F.col("l_linenumber") % 2 == 0, inf).otherwise(nan)
    li = table(spark, sf_dir, "lineitem").select("l_linenumber", S.finite(r).alias("r"))
    return li.groupBy("l_linenumber").agg(F.count("*").alias("n"), F.count("r").alias("valid"), F.sum("r").alias("total"))


@query("""SELECT c_custkey AS id_user, CASE WHEN c_custkey % 3 = 0 THEN 'f' || c_custkey ELSE 'old' END AS first_name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE 'old' END AS last_name,
CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN DATE '1990-01-02' END AS date_birth, CASE WHEN c_custkey % 3 = 0 THEN last ELSE 0 END AS id_organization
FROM customer LEFT JOIN (SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, -o_orderkey)) AS last FROM orders GROUP BY ALL) ON o_custkey = c_custkey""")
def user_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names and birth dates from the users' own contacts, organisations from their latest registration."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    users = c.select(k.alias("id_user"), F.lit("old").alias("first_name"), F.lit("old").alias("last_name"), F.lit(None).cast("date").alias("date_birth"), F.lit(0).cast("long").alias("id_organization"))
    null = F.lit(None).cast("string")
    me = c.where("c_custkey % 3 = 0").select(k.alias("userId"), (k + 7).alias("contactDetailId"), F.lit("me").alias("link"), null.alias("deletedAt"))
    links = me.unionByName(me.withColumns({"link": F.lit("father"), "contactDetailId": F.col("contactDetailId") - 7})).unionByName(me.withColumns({"deletedAt": F.lit("x"), "contactDetailId": F.lit(1).cast("long")}))
    contacts = c.select((k + 7).alias("contactDetailId"), F.concat(F.lit("f"), k.cast("string")).alias("firstname"), F.col("c_mktsegment").alias("lastname"), F.when(k % 2 == 0, "1990-01-02").otherwise("soon").alias("dateBirth"), null.alias("deletedAt"))
    students = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("userId"), F.col("o_orderkey").alias("registerToOrganization"), F.col("o_orderdate").alias("updatedAt"), null.alias("deletedAt"))
    return identity_backfill(users, links, contacts, students)
