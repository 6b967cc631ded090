"""Secret scans with an incremental blob ledger [DataFrame and SQL functions only].

Every version of every path is addressed by the SHA-256 of its content. A ledger on disk lists the (blob, rule version) pairs that were
scanned, with what was found; a call scans only the pairs that it lacks, one copy of each blob, adds them, and joins the findings back
to all rows. A rule whose pattern changes gets a new version, so its pairs are scanned again, and those of other rules are not.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_hot, maybe_in, staged, work_path

#: Matches that are laid end to end at a time.
RUN = 256
SPAN = "struct<rule: string, start: int, end: int>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of pattern; those whose group has fewer than `least` code points are dropped afterwards."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        return f"{self.kind}@{hashlib.sha256(f'{self.group}:{self.least}:{self.pattern}'.encode()).hexdigest()[:12]}"


def either_case(word: str) -> str:
    """A pattern for word with each ASCII letter in either case (regex flags would take other alphabets' letters too)."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


#: Fixed patterns. In the second and third a match that is long enough is what the same pattern without a least length would give.
ASSIGN = f"({'|'.join(map(either_case, ('password', 'passwd', 'secret', 'token', 'api_?key')))})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE = (Rule("assign", ASSIGN, 2, 12), Rule("access", "AKIA[A-Z0-9]{14,}"), Rule("hex", "[0-9a-f]{16,}"))
#: Base rules and two more that need no context: headers of private keys, tokens of a code host.
RULES = (*BASE, Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"), Rule("host_token", "gh[pousr]_[A-Za-z0-9]{36,}"))


def _laid(matches: Column) -> Column:
    """matches: array of (gap, whole, part) lengths, in order -> array of (start, end, part).

    Positions add up within runs of RUN matches, and then over the runs, so that a text of very many matches takes linear time.
    """
    place = "struct<start: int, end: int, part: int>"
    runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / RUN).cast("int")), lambda i: F.slice(matches, i * RUN + 1, RUN))

    def add(at: Column, x: Column) -> Column:
        start = at["at"] + x["gap"]
        end = start + x["whole"]
        return F.struct(end.alias("at"), F.concat(at["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["part"].alias("part")))).alias("out"))

    def empty(kind: str) -> Column:
        return F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def join(at: Column, x: Column) -> Column:
        moved = F.transform(x["out"], lambda s: F.struct((s["start"] + at["at"]).alias("start"), (s["end"] + at["at"]).alias("end"), s["part"].alias("part")))
        return F.struct((at["at"] + x["at"]).alias("at"), F.concat(at["out"], F.array(moved)).alias("out"))

    own = F.transform(runs, lambda run: F.aggregate(run, empty(f"array<{place}>"), add))
    return F.flatten(F.aggregate(own, empty(f"array<array<{place}>>"), join)["out"])


def spans(text: Column, rule: Rule) -> Column:
    """Array of (rule version, start, end) in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    gaps = F.split(text, rule.pattern, -1)  # one more than matches
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    lengths = [F.transform(x, F.length) for x in (F.slice(gaps, 1, F.size(whole)), whole, part)]
    zipped = F.transform(F.arrays_zip(*(x.alias(n) for x, n in zip(lengths, ("gap", "whole", "part"), strict=True))), lambda x: F.struct(x["gap"].alias("gap"), x["whole"].alias("whole"), x["part"].alias("part")))
    kept = F.filter(_laid(zipped), lambda s: s["part"] >= rule.least)
    named = F.transform(kept, lambda s: F.struct(F.lit(rule.version).alias("rule"), s["start"].alias("start"), s["end"].alias("end")))
    return F.when(F.rlike(text, pattern), named.cast(f"array<{SPAN}>")).otherwise(F.array().cast(f"array<{SPAN}>"))


def _exists(spark: SparkSession, at: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def _read_ledger(spark: SparkSession, at: str) -> DataFrame:
    return spark.read.schema(f"blob binary, rules array<string>, spans array<{SPAN}>").parquet(at)


def update_ledger(spark: SparkSession, path: str, ledger: str, rules: tuple[Rule, ...], blobs: DataFrame) -> None:
    """Scan the (blob, rule version) pairs of the table at path that the ledger lacks, and add them to it.

    blobs: (blob, first, key, n) of the table: the first place (file, row), 64 bits of the content, the number of rows. A blob found once that
    no earlier call has seen is scanned where it is read; of the others one copy's text is shuffled, if there is anything left to scan.
    """
    versions = F.array(*(F.lit(r.version) for r in rules))
    blobs = blobs.withColumn("seen", F.array().cast("array<string>"))
    if _exists(spark, ledger):
        seen = _read_ledger(spark, ledger).select("blob", F.explode("rules").alias("rule")).groupBy("blob").agg(F.collect_set("rule").alias("before"))
        blobs = blobs.drop("seen").join(seen, "blob", "left").withColumn("seen", F.coalesce("before", F.array().cast("array<string>"))).drop("before")
    blobs = staged(blobs.withColumn("rules", F.array_except(versions, "seen")), "blobs")
    # blobs that can't be scanned where they are, and all that their filter takes for such
    shared = staged(blobs.where("n > 1 or size(seen) > 0").select("key"), "shared")
    leads = staged(blobs.where(maybe_in(shared, F.col("key")) & (F.size("rules") > 0)).select("blob", "rules", F.col("first.file").alias("file"), F.col("first.row").alias("row")), "leads")
    content = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), _content().alias("text")).withColumn("key", F.xxhash64("text"))
    alone = content.where(~maybe_in(shared, F.col("key"))).select(_blob("text").alias("blob"), versions.alias("rules"), "text")
    place = F.xxhash64("file", "row")
    copies = content.where(maybe_in(shared, F.col("key")) & maybe_in(leads.select(place.alias("key")), place)).drop("key").join(leads, ["file", "row"]).select("blob", "rules", "text")
    every = [F.when(F.array_contains("rules", r.version), spans(F.col("text"), r)).otherwise(F.array().cast(f"array<{SPAN}>")) for r in rules]
    out = alone.unionByName(copies).select("blob", "rules", F.concat(*every).alias("spans"))
    out.write.mode("append").parquet(ledger)


def _content() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _blob(text: str) -> Column:
    return F.unhex(F.sha2(F.col(text).cast("binary"), 256))


def scan_secrets(spark: SparkSession, path: str, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row for each row of the Parquet table at path: keys, blob (hex), spans: array of (kind, start, end) by start, then rule as listed.

    keys: columns that name a path and its version, of any names but blob and spans; other columns but text aren't read. ledger: a folder
    that keeps what was scanned between calls (without one, this call's own). Null texts count as empty, an empty text has no spans, an
    empty table gives no rows, repeated rows each get their own. Very long texts are scanned whole. If a call is broken off before its
    pairs are added, the next one scans them again; pairs that two calls add at once count once.
    """
    if {"blob", "spans"} & {k.lower() for k in keys}:
        raise ValueError("scan_secrets: blob and spans are columns of the result")
    ledger = ledger or work_path(spark, "ledger")
    source = spark.read.parquet(path).select(F.struct(*keys).alias("id"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), _content().alias("text"))
    rows = staged(source.select("id", "file", "row", F.xxhash64("text").alias("key"), _blob("text").alias("blob")), "paths")
    blobs = rows.groupBy("blob").agg(F.min(F.struct("file", "row")).alias("first"), F.first("key").alias("key"), F.count("*").alias("n"))
    update_ledger(spark, path, ledger, rules, blobs)
    versions = {r.version: i for i, r in enumerate(rules)}
    nth = F.create_map(*(F.lit(x) for v, i in versions.items() for x in (v, i)))
    kind = F.create_map(*(F.lit(x) for r in rules for x in (r.version, r.kind)))
    known = F.filter("spans", lambda s: s["rule"].isin(*versions))
    found = _read_ledger(spark, ledger).where(F.size(known) > 0).groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list(known))).alias("spans"))
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), nth[s["rule"]].alias("nth"), s["end"].alias("end"), kind[s["rule"]].alias("kind"))))
    listed = F.transform(ordered, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    found = found.select("blob", listed.alias("spans"))
    none = F.array().cast("array<struct<kind: string, start: int, end: int>>")
    told = staged(rows.groupBy("blob").agg(F.count("*").alias("n")).join(found, "blob", "left").select("blob", "n", F.coalesce("spans", none).alias("spans")), "found")
    return join_hot(rows.select("id", "blob"), told, ["blob"], "n", most=4096).select("id.*", F.lower(F.hex("blob")).alias("blob"), "spans")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, kinds = scan_secrets(spark, f"{sf_dir}/documents.parquet"), [r.kind for r in BASE]

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return out.select("doc_id", *counts, F.sha2(joined(of(*kinds)), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def _sql_spans(rule: Rule, nth: int) -> str:
    """DuckDB: one row (doc_id, row, kind, nth, start, end) for each span; matches are laid end to end with the pieces between."""
    p = rule.pattern.replace("'", "''")
    part = f"regexp_extract_all(t, '{p}', {rule.group})"
    return f"""
SELECT r, '{rule.kind}' AS kind, {nth} AS nth, e - w AS s, e FROM (
  SELECT r, w, part, sum(g + w) OVER (PARTITION BY r ORDER BY i) AS e FROM (
    SELECT r, unnest(list_transform(regexp_extract_all(t, '{p}', 0), lambda x: length(x))) AS w, unnest(list_transform({part}, lambda x: length(x))) AS part,
           unnest(list_transform(string_split_regex(t, '{p}')[1:len(regexp_extract_all(t, '{p}', 0))], lambda x: length(x))) AS g, unnest(range(len(regexp_extract_all(t, '{p}', 0)))) AS i
    FROM d)) WHERE part >= {rule.least}"""


OP13_SQL = f"""
WITH d AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
s AS ({" UNION ALL ".join(_sql_spans(rule, i) for i, rule in enumerate(RULES))}),
j AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, nth) FILTER (nth < 3) AS base,
             string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, nth) AS spans FROM s GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN j USING (r)
"""
