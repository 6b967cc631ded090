"""Sinks and table maintenance (K) over plain Parquet.

Changes are pure functions from frames to frames; SnapshotTable keeps each result as a new version and moves a pointer to it, so a
reader never sees half a change and no job overwrites what it reads.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _on(keys: list[str], a: str = "t", b: str = "s") -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}"))
    return cond


def last_per_key(src: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*src.columns))
    return src.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def merge_upsert(target: DataFrame, src: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """K2: source rows replace target rows of the same key (nulls equal) or are added; of a key's source rows the first in order counts."""
    new = last_per_key(src, keys, order)
    kept = target.alias("t").join(new.select(*keys).alias("s"), _on(keys), "left_anti")
    return kept.unionByName(new.select(*target.columns))


def merge_update_only(target: DataFrame, src: DataFrame, keys: list[str], cols: list[str], order: list[Column]) -> DataFrame:
    """K3: nulls of matched target rows are filled from the source; nothing is added."""
    new = last_per_key(src, keys, order).select(*keys, *(F.col(c).alias(f"__{c}") for c in cols)).alias("s")
    j = target.alias("t").join(new, _on(keys), "left")
    return j.select(*(F.coalesce(F.col(f"t.{c}"), F.col(f"s.__{c}")).alias(c) if c in cols else F.col(f"t.{c}") for c in target.columns))


def delete_keys(target: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """K4."""
    return target.alias("t").join(gone.select(*keys).distinct().alias("s"), _on(keys), "left_anti")


def rewind_replace(target: DataFrame, new: DataFrame, site: str, ts: str) -> DataFrame:
    """K5: per site, target rows from the new rows' first time on are replaced by the new rows."""
    first = new.groupBy(site).agg(F.min(ts).alias("__first"))
    kept = target.join(first, site, "left").where(F.col("__first").isNull() | (F.col(ts) < F.col("__first"))).select(*target.columns)
    return kept.unionByName(new.select(*target.columns))


def replace_slice(target: DataFrame, new: DataFrame, slice_cols: list[str], empty_keeps: bool = True) -> DataFrame:
    """K6, K7: slices that the new rows hold are replaced; with no new row the target stays."""
    return target.alias("t").join(new.select(*slice_cols).distinct().alias("s"), _on(slice_cols), "left_anti").unionByName(new.select(*target.columns))


def purge_insert(target: DataFrame, received: DataFrame, key: str, active: Column) -> DataFrame:
    """K9: all received ids leave the target, the active received rows enter."""
    return target.join(received.select(key).distinct(), key, "left_anti").select(*target.columns).unionByName(received.where(active).select(*target.columns))


def stale_ids(target: DataFrame, source: DataFrame, key: str, window: Column) -> DataFrame:
    """Ids of the target in the window that the source lacks; none if the source has nothing in the window."""
    have = source.where(window).select(key).distinct()
    some = have.limit(1).agg(F.count("*").alias("__some"))
    return target.where(window).select(key).distinct().join(have, key, "left_anti").crossJoin(F.broadcast(some)).where("__some > 0").drop("__some")


def duplicate_surplus(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with several rows, their number, and one row of totals is agg(sum(surplus))."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").withColumn("surplus", F.col("n") - 1)


def drop_future(df: DataFrame, ts: str, as_of: str, months: int) -> DataFrame:
    """Rows up to as_of plus so many months; null times go."""
    return df.where(F.col(ts) <= F.add_months(F.lit(as_of).cast("date"), months).cast("timestamp"))


def without_orphans(df: DataFrame, key: str, parents: DataFrame, parent_key: str, scope: Column) -> DataFrame:
    """Rows in scope whose key is NOT IN parents go; as in SQL a null among the parents makes nothing go, nor does a null key."""
    null_parent = parents.agg(F.coalesce(F.max(F.col(parent_key).isNull().cast("int")), F.lit(0)).alias("__nulls"), F.count("*").alias("__rows"))
    known = parents.select(F.col(parent_key).alias("__p")).where("__p is not null").distinct().withColumn("__known", F.lit(1))
    j = df.join(known, df[key] == F.col("__p"), "left").crossJoin(F.broadcast(null_parent))
    missing = F.col("__known").isNull() & (F.col("__nulls") == 0) & (F.col(key).isNotNull() | (F.col("__rows") == 0))
    return j.where(~F.coalesce(missing & scope, F.lit(False))).select(*df.columns)


def year_changed(df: DataFrame, year: str, current: str | int) -> DataFrame:
    """Rows of the past year, to back up, if the table's latest year isn't the current one's any more; else none."""
    last = df.agg(F.max(year).alias("__last"))
    return df.crossJoin(F.broadcast(last)).where((F.col("__last") > F.lit(current)) & (F.col(year) == F.lit(current))).drop("__last")


def load_audit(df: DataFrame, name: str, ts: str, failed: int = 0) -> DataFrame:
    """One row on a load: rows, first and last time, status."""
    status = F.when(F.lit(failed) == 0, "complete").when(F.count("*") > 0, "partial").otherwise("failed")
    return df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), status.alias("status"))


def export(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Columns in the order of labels under their labels, for write.csv(header=True) or write.json."""
    return df.select(*(F.col(c).alias(v) for c, v in labels.items()))


class SnapshotTable:
    """Versions of a table as Parquet folders, and numbered pointer files, of which the highest names the current version.

    A pointer comes by one rename under a number that isn't there yet, and no pointer goes before a higher one is there: a reader finds
    the old version or the new one, also when a writer stops anywhere. Of two writers of one number the second fails.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> str | None:
        return self._current().get("version")

    def _current(self) -> dict:
        return self._named(numbers[-1]) if (numbers := self._pointers()) else {}

    def _named(self, n: int) -> dict:
        """What a pointer says."""
        return json.loads(self.spark.read.text(self._pointer(n)).first()[0])

    def _pointer(self, n: int) -> str:
        return f"{self.path}/pointer-{n:012d}"

    def _pointers(self) -> list[int]:
        if not self._fs.exists(self._path(self.path)):
            return []
        names = [x.getPath().getName() for x in self._fs.listStatus(self._path(self.path))]
        return sorted(int(x.removeprefix("pointer-")) for x in names if x.startswith("pointer-"))

    def read(self) -> DataFrame:
        if (v := self.version()) is None:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self.spark.read.parquet(f"{self.path}/{v}")

    def write(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> str:
        """K1, K8: df as the new current version."""
        v = f"v-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{self.path}/{v}") if partition_by else df.write.parquet(f"{self.path}/{v}")
        return self._point_to({"version": v})

    def _point_to(self, content: dict) -> str:
        v, n = content["version"], (self._pointers() or [0])[-1] + 1
        new = self._path(f"{self.path}/.pointer-{v}")
        out = self._fs.create(new)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        at = self._path(self._pointer(n))
        if self._fs.exists(at) or not self._fs.rename(new, at):
            raise RuntimeError(f"{self.path}: version {n} was written meanwhile")
        return v

    def prune(self, keep: int = 2) -> None:
        """Versions before the last `keep` go, their pointers first."""
        numbers = self._pointers()
        old = [(n, self._named(n)["version"]) for n in numbers[: max(len(numbers) - keep, 0)]]
        for n, v in old:
            self._fs.delete(self._path(self._pointer(n)), False)
            self._fs.delete(self._path(f"{self.path}/{v}"), True)

    def reload(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> str:
        """K1: a full reload; an empty source is refused."""
        if df.isEmpty():
            raise ValueError("reload: the source is empty, the table stays")
        return self.write(df, partition_by)

    def upsert(self, src: DataFrame, keys: list[str], order: list[Column], newest: bool = False) -> str:
        """K2; newest: a row of the table stays where it goes before the source's in the order, so that late rows change nothing."""
        if self.version() is None:
            return self.write(last_per_key(src, keys, order))
        held = self.read()
        if newest:
            met = held.alias("t").join(src.select(*keys).distinct().alias("s"), _on(keys), "left_semi")
            src = src.select(*held.columns).unionByName(met)
        return self.write(merge_upsert(held, src, keys, order))
