"""Window operators (W)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running(df: DataFrame, keys: list[str], order: list, measures: dict[str, str]) -> DataFrame:
    """Running totals; measures: new name -> column."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({new: F.sum(c).over(w) for new, c in measures.items()})


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row a key, the first in the order; ties go by the whole row's hash, so the choice is always the same."""
    w = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*df.columns))
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def by_priority(df: DataFrame, keys: list[str], model: str, priority: dict[str, int], horizon: str) -> DataFrame:
    """One row a key: the model that comes first, then the shortest horizon; models not listed come last."""
    rank = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in priority.items() for x in kv)), F.col(model)), F.lit(max(priority.values()) + 1))
    return latest(df, keys, [rank, F.col(horizon), F.col(model)])


def full_window_mean(df: DataFrame, keys: list[str], order: list, value: str, n: int, name: str) -> DataFrame:
    """Mean of the last n rows, null before there are n."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(1 - n, 0)
    return df.withColumn(name, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))


def shifted(df: DataFrame, keys: list[str], order: list, value: str, k: int, name: str) -> DataFrame:
    """The value k rows earlier."""
    return df.withColumn(name, F.lag(value, k).over(Window.partitionBy(*keys).orderBy(*order)))


def back_filled(df: DataFrame, order: list, columns: dict[str, list[str]]) -> DataFrame:
    """Nulls of each column take the first value that is there in its group, else the mean over all rows; columns: name -> group keys.

    All columns at once: the means are one aggregate row, so df is read twice, however many columns there are.
    """
    means = df.agg(*(F.avg(c).alias(f"__mean_{c}") for c in columns))
    first = {c: F.first(c, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) for c, keys in columns.items()}
    out = df.withColumns({f"__first_{c}": f for c, f in first.items()}).crossJoin(F.broadcast(means))
    return out.withColumns({c: F.coalesce(c, f"__first_{c}", f"__mean_{c}") for c in columns}).drop(*(f"__{k}_{c}" for c in columns for k in ("first", "mean")))


def group_mean(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """W9."""
    return df.withColumn(name, F.avg(value).over(Window.partitionBy(*keys)))


def recent_positive_mean(df: DataFrame, keys: list[str], order: str, value: str, n: int, name: str) -> DataFrame:
    """Mean of a key's last n positive values; n rows a key are kept before the mean."""
    w = Window.partitionBy(*keys).orderBy(F.desc(order), F.desc(value))
    return df.where(F.col(value) > 0).withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= n).groupBy(*keys).agg(F.avg(value).alias(name))


def last_known(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Each value's latest that is there, by key."""
    return df.groupBy(*keys).agg(*(F.max_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values))


def top_per_class(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    """O3."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("__n") <= k).drop("__n")
