"""Tables in parts (K2, K4, K6 on disk): a change writes the parts it touches, and the new version takes the others as they are."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import SnapshotTable

_PART = "__part"


class PartedTable(SnapshotTable):
    """A snapshot table whose pointer names for each part the version whose folder holds it. part: a column that tells a row's part.

    The pointer holds a name for each part, so there should be thousands of them, not millions.
    """

    def __init__(self, spark: SparkSession, path: str, part: Column):
        super().__init__(spark, path)
        self.part = part.cast("string")

    def parts(self) -> dict[str, str]:
        return self._current().get("parts", {})

    def read(self) -> DataFrame:
        if (out := self.read_parts()) is None:
            raise FileNotFoundError(f"{self.path} has no rows yet")
        return out

    def read_parts(self, names: list[str] | None = None) -> DataFrame | None:
        """The rows of some parts, or of all; None if there are none."""
        held = self.parts()
        at = [f"{self.path}/{held[p]}/{_PART}={p}" for p in sorted(held if names is None else set(names) & held.keys())]
        return self.spark.read.parquet(*at) if at else None

    def write(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> str:
        """K1: df instead of all parts."""
        return self._replace(df, list(self.parts()))

    def replace(self, df: DataFrame) -> str | None:
        """K6, K7: the parts that df has rows of are replaced by these; without any row nothing changes."""
        return self._replace(df, [])

    def _replace(self, df: DataFrame, gone: list[str]) -> str | None:
        """Parts of df replace those of the table, parts that are in `gone` alone disappear, all others stay where they are."""
        v = f"v-{uuid.uuid4().hex}"
        # the rows of a part come together, so that it has a file and not one for each task
        df.withColumn(_PART, self.part).repartition(_PART).write.partitionBy(_PART).parquet(f"{self.path}/{v}")
        names = [x.getPath().getName() for x in self._fs.listStatus(self._path(f"{self.path}/{v}"))]
        new = [x.removeprefix(f"{_PART}=") for x in names if x.startswith(f"{_PART}=")]
        if not new and not gone:
            return self.version()
        kept = {p: at for p, at in self.parts().items() if p not in set(gone)}
        return self._point_to({"version": v, "parts": kept | dict.fromkeys(new, v)})

    def prune(self, keep: int = 2) -> None:
        """Pointers before the last `keep` go, and then the parts that no pointer left names."""
        numbers = self._pointers()
        old, kept = numbers[: max(len(numbers) - keep, 0)], numbers[max(len(numbers) - keep, 0) :]
        was = {(v, p) for n in old for p, v in self._named(n).get("parts", {}).items()}
        still = {(v, p) for n in kept for p, v in self._named(n).get("parts", {}).items()}
        for n in old:
            self._fs.delete(self._path(self._pointer(n)), False)
        for v, p in sorted(was - still):
            self._fs.delete(self._path(f"{self.path}/{v}/{_PART}={p}"), True)
        for v in {v for v, _ in was} - {v for v, _ in still}:
            self._fs.delete(self._path(f"{self.path}/{v}"), True)


def slices(cols: list[str]) -> Column:
    """K6: the part of a row whose parts are the values of some columns."""
    return F.md5(F.to_json(F.struct(*cols)).cast("binary"))


class KeyedTable(PartedTable):
    """A table with a row for each key, in parts by the key's hash. A batch of changes rewrites the parts that hold its keys.

    order: which of a key's rows counts, the first; of rows that are equal in it a deleted one, else one by a hash of the row, so that
    what counts depends on the rows alone. deleted: a column that is not null in soft-deleted rows.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[Column], deleted: str | None = None, buckets: int = 64):
        super().__init__(spark, path, F.pmod(F.xxhash64(*keys), F.lit(buckets)))
        self.keys, self.order, self.deleted, self.buckets = keys, order, deleted, buckets

    def _first(self, df: DataFrame, before: list[Column] | None = None) -> DataFrame:
        """Each key's row that counts. Rows of a part meet in one task already when they are read or written by part."""
        gone = [] if self.deleted is None else [F.col(self.deleted).isNull()]
        w = Window.partitionBy(_PART, *self.keys).orderBy(*(before or []), *self.order, *gone, F.xxhash64(*sorted(c for c in df.columns if not c.startswith("__"))))
        return df.withColumn(_PART, self.part).repartition(_PART).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", _PART)

    def read(self) -> DataFrame:
        """The rows that aren't deleted."""
        held = super().read()
        return held if self.deleted is None else held.where(F.col(self.deleted).isNull())

    def merge(self, batch: DataFrame, newest: bool = True) -> str | None:
        """One new version for live and deleted rows of the batch together; repeating a batch changes nothing.

        newest: of the batch's row and the table's the first in order counts; deleted rows stay in the table unseen, so that rows that
        come later in time but are older don't revive a key. Any split of the changes into batches, in any order, gives the same table.
        Otherwise the batch's row counts, and a key that it deletes leaves the table.
        """
        at = f"{self.path}/.changes-{uuid.uuid4().hex}"  # read twice, and a batch may be costly
        first = self._first(batch)
        first.write.parquet(at)
        try:
            return self._merged(self.spark.read.schema(first.schema).parquet(at), newest)
        finally:
            self._fs.delete(self._path(at), True)

    def _merged(self, new: DataFrame, newest: bool) -> str | None:
        touched = [r[0] for r in new.select(self.part).distinct().collect()]  # at most `buckets`
        if not touched:
            return self.version()
        held = self.read_parts(touched)
        if held is not None:
            both = held.withColumn("__old", F.lit(1)).unionByName(new.select(*held.columns).withColumn("__old", F.lit(0)))
            new = self._first(both, None if newest else [F.col("__old")]).drop("__old")
        if not newest and self.deleted is not None:
            new = new.where(F.col(self.deleted).isNull())
        return self._replace(new, touched)

    def forget(self, deleted_before: Column) -> str | None:
        """Deleted rows for which the condition holds leave the table for good; changes older than these must not come any more."""
        held = self.read_parts()
        return None if held is None else self._replace(held.where(~F.coalesce(F.col(self.deleted).isNotNull() & deleted_before, F.lit(False))), list(self.parts()))
