"""Incremental loads (T) as Structured Streaming over landed files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.parts import KeyedTable
from ..operators.tables import SnapshotTable


def one_path(path: str) -> str:
    """The stream source takes a single file only as a glob; this one matches path alone."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def landed(spark: SparkSession, path: str, max_files: int | None = 100) -> DataFrame:
    """A stream of the Parquet files at path, at most max_files of them in a batch; None: all that are there."""
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    return (stream if max_files is None else stream.option("maxFilesPerTrigger", max_files)).parquet(one_path(path))


def sync(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Every landed file not read yet goes to `apply` in batches, with progress kept after each; stops at the first failure."""
    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def upsert_batches(table: KeyedTable, newest: bool = False) -> Callable[[DataFrame, int], None]:
    """Each batch's live and soft-deleted rows are merged at once (see KeyedTable.merge). The last two versions are kept."""

    def apply(batch: DataFrame, _: int) -> None:
        table.merge(batch, newest)
        table.prune()

    return apply


def counted_by_day(stream: DataFrame, ts: str, kind: str, at: str) -> DataFrame:
    """T5: events by day and kind over all files landed so far, however late and in whatever order they come.

    Each batch's counts are written under its number, so that a repeated batch replaces its own; the sum over batches is the result.
    """

    def keep(batch: DataFrame, n: int) -> None:
        batch.groupBy(F.to_date(ts).alias("day"), kind).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{at}/out/batch={n}")

    sync(stream, keep, f"{at}/stream")
    return stream.sparkSession.read.parquet(f"{at}/out").groupBy("day", kind).agg(F.sum("n").alias("n"))


def reload_chunks(table: SnapshotTable, chunks: list[str], read: Callable[[str], DataFrame], stage: str) -> DataFrame:
    """A full reload chunk by chunk that goes on after errors; returns a row on each chunk (chunk, rows, status, error).

    Each chunk is written on its own first, its rows counted as they pass; those that could be read make the new version. If none could, the table stays as it is.
    """
    spark, rows, good = table.spark, [], []
    for i, name in enumerate(chunks):
        try:
            at, seen = f"{stage}/chunk-{i}", Observation()
            read(name).observe(seen, F.count("*").alias("rows")).write.mode("overwrite").parquet(at)
            rows.append((name, seen.get["rows"], "complete", None))
            good.append(at)
        except Exception as e:  # noqa: BLE001  whatever a source fails with goes into the audit
            rows.append((name, 0, "failed", str(e).splitlines()[0][:300]))
    if good:
        table.write(spark.read.parquet(*good))
    return spark.createDataFrame(rows, "chunk string, rows long, status string, error string")


def daily_counts(stream: DataFrame, ts: str, kind: str, late: str = "1 day") -> DataFrame:
    """T5: events by day and kind, with a watermark; in append mode a day comes out once it is complete.

    For a stream that runs on; rows that come later than the watermark are dropped, see counted_by_day where none may be.
    """
    return stream.withWatermark(ts, late).groupBy(F.window(ts, "1 day"), kind).agg(F.count("*").alias("n")).select(F.to_date("window.start").alias("day"), kind, "n")


def appended(stream: DataFrame, at: str) -> DataFrame:
    """What a stream in append mode puts out over all files landed so far; called again it goes on where it ended."""
    stream.writeStream.format("parquet").outputMode("append").option("path", f"{at}/out").option("checkpointLocation", f"{at}/stream").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{at}/out")


def without_repeats(stream: DataFrame, ts: str, keys: list[str], late: str = "45 days") -> DataFrame:
    """T4: rows read again within the look-back are dropped. A key's state goes once the watermark has passed its first row by `late`."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def latest_batches(table: KeyedTable, group: list[str], ts: str) -> Callable[[DataFrame, int], None]:
    """Each group's latest time, kept up to date: a batch's maxima are merged, so late rows and repeated batches change nothing.

    table: keyed by group, ordered by the descending time.
    """

    def apply(batch: DataFrame, _: int) -> None:
        table.merge(batch.groupBy(*group).agg(F.max(ts).alias(ts)))
        table.prune()

    return apply
