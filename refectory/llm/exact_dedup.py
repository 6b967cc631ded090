"""Exact de-duplication by a stream whose keyed state never expires [DataFrame and SQL functions only].

The state, kept on disk by RocksDB, holds per digest the smallest identifier seen, where that row's content is (file and row
number) and how many rows had it. It holds no text. Rows that hit an earlier digest are afterwards compared byte by byte with the
content at that place; where texts of one digest differ, they are told apart by the text itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, join_hot, maybe_in, staged, work_path

#: Rows of one digest that are compared with one copy of its first content.
COPIES = 500


def normalised(text: str = "text") -> Column:
    """Each run of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), SPACE + "+", " ")


def sha256(col: Column) -> Column:
    return F.sha2(col.cast("binary"), 256)


def _located(df: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    text = normalised()
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), *place, text.alias("norm")).withColumn("digest", digest(F.col("norm")))


def _first() -> Column:
    """Rows by identifier, nulls last; equal ones by place."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "file", "row")


def digest_state(spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256, checkpoint: str | None = None, max_files: int = 10_000) -> DataFrame:
    """Run the stream over the files of path that it has not read yet; returns (digest, first, group_size).

    checkpoint: a folder that keeps the state between calls; given again, only new files are read. Each micro-batch writes the
    digests that it changed, under its own number, so a repeated batch replaces its own output.
    """
    schema = spark.read.parquet(path).schema
    at = checkpoint or work_path(spark, "digests")
    own = {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        # many small stores: no megabytes set aside for each
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    }
    held = {k: spark.conf.get(k, None) for k in own}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        # the stream source takes a single file only as a glob; this one matches path alone
        path = path.rstrip("/")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(f"{path[:-1]}[{path[-1]}]")
        state = _located(stream, digest).groupBy("digest").agg(F.min(_first()).alias("first"), F.count("*").alias("group_size"))

        def keep(batch: DataFrame, n: int) -> None:
            batch.write.mode("overwrite").parquet(f"{at}/changed/batch={n}")

        q = state.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{at}/stream").trigger(availableNow=True).start()
        q.awaitTermination()
    finally:
        for k, v in held.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    changed = spark.read.schema("digest string, first struct<none boolean, doc_id bigint, file string, row bigint>, group_size bigint").parquet(f"{at}/changed")
    # the smallest first row and the largest count are the latest ones
    return changed.groupBy("digest").agg(F.min("first").alias("first"), F.max("group_size").alias("group_size"))


def exact_dedup(spark: SparkSession, path: str, digest: Callable[[Column], Column] = sha256, checkpoint: str | None = None) -> DataFrame:
    """One row for each row of the documents at path: doc_id, file, row, digest, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after normalised(). Null and empty texts are equal. Of equal texts the row with the smallest
    doc_id is kept (null ids last); of rows that also share the doc_id, the first by file and row number. An empty table gives no
    rows. Columns other than doc_id and text are not read. Text is shuffled only for rows whose digest was seen more than once; a digest
    with many rows is dealt over several keys, each with a copy of the first content.
    """
    out = "doc_id bigint, file string, row bigint, digest string, keep_id bigint, group_size bigint, kept boolean, text_sha256 string"
    if spark.read.parquet(path).isEmpty():
        return spark.createDataFrame([], out)
    state = staged(digest_state(spark, path, digest, checkpoint), "state")
    rows = _located(spark.read.parquet(path), digest)
    narrow = staged(rows.select("doc_id", "file", "row", "digest", sha256(F.col("norm")).alias("text_sha256")), "digests")
    # hits: rows of digests seen more than once, each compared with the content at its digest's place
    many = state.where("group_size > 1").select("digest", F.col("first.file").alias("first_file"), F.col("first.row").alias("first_row"), "group_size")
    leads = (F.col("file") == F.col("first_file")) & (F.col("row") == F.col("first_row"))
    salts = F.ceil(F.col("group_size") / COPIES)
    hits = staged(join_hot(narrow, many, ["digest"], "group_size").select("doc_id", "file", "row", "digest", leads.alias("leads"), salts.alias("salts")), "hits")
    key = F.xxhash64("file", "row")
    source = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), "text")
    content = source.where(maybe_in(hits.select(key.alias("key")), key)).join(hits, ["file", "row"]).withColumn("norm", normalised())
    first = content.where("leads").select("digest", F.col("norm").alias("first_norm"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"))
    others = content.where("not leads").withColumn("salt", F.pmod(F.xxhash64("file", "row"), "salts"))
    unlike = others.join(first, ["digest", "salt"]).where("norm != first_norm").select("digest").distinct()
    unlike = staged(unlike, "unlike")
    joined = join_hot(narrow, state, ["digest"], "group_size")
    if unlike.isEmpty():
        joined = joined.select("*", F.col("first").alias("lead"), F.col("group_size").alias("n"))
    else:  # a digest of unlike texts (never met with SHA-256): told apart by the text itself
        apart = content.join(unlike, "digest", "left_semi")
        groups = apart.groupBy("digest", "norm").agg(F.min(_first()).alias("first2"), F.count("*").alias("size2"))
        apart = apart.join(groups, ["digest", "norm"]).select("file", "row", "first2", "size2")
        joined = joined.join(apart, ["file", "row"], "left").select("*", F.coalesce("first2", "first").alias("lead"), F.coalesce("size2", "group_size").alias("n"))
    kept = (F.col("lead.file") == F.col("file")) & (F.col("lead.row") == F.col("row"))
    return joined.select("doc_id", "file", "row", "digest", F.col("lead.doc_id").alias("keep_id"), F.col("n").alias("group_size"), kept.alias("kept"), "text_sha256")


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup(spark, f"{sf_dir}/documents.parquet")
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP6_SQL = """
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
