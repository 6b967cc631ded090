"""Aggregations (A): conditional counts and sums, quantiles, error metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_by(df: DataFrame, keys: list, status: str, values: dict[str, list], not_in: dict[str, list] | None = None) -> DataFrame:
    """A2: by keys, how many rows have a status of each list; in not_in, how many have another one (null counts nowhere)."""
    own = [F.count_if(F.col(status).isin(v)).alias(n) for n, v in values.items()]
    own += [F.count_if(~F.col(status).isin(v)).alias(n) for n, v in (not_in or {}).items()]
    return df.groupBy(*keys).agg(F.count("*").alias("total"), *own)


def sum_if(cond: Column, value: Column) -> Column:
    """A3."""
    return F.sum(F.when(cond, value).otherwise(0))


def wide_sums(df: DataFrame, keys: list[str], code: str, codes: list, measures: dict[str, str]) -> DataFrame:
    """For each measure and code a column of sums: <new name>_<code>."""
    return df.groupBy(*keys).agg(*(F.coalesce(F.sum(F.when(F.col(code) == c, F.col(m))), F.lit(0.0)).alias(f"{n}_{c}") for n, m in measures.items() for c in codes))


def iqr_bounds(df: DataFrame, keys: list[str], value: str, factor: float = 2.5) -> DataFrame:
    """Quartiles, exact, and the bounds outside which a value is an outlier; the lower one is 0 at least."""
    q = df.groupBy(*keys).agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.stddev_samp(value).alias("std"))
    q = q.select(*keys, *(F.get("q", F.lit(i)).alias(n) for i, n in enumerate(("q1", "median", "q3"))), "std")
    spread = F.col("q3") - F.col("q1")
    return q.withColumns({"lower": F.greatest(F.lit(0.0), F.col("q1") - factor * spread), "upper": F.col("q3") + factor * spread})


def size_groups(df: DataFrame, site: str, value: str) -> DataFrame:
    """Sites in four groups by the quartiles of their means."""
    means = df.groupBy(site).agg(F.avg(value).alias("mean_value"))
    q = means.agg(F.percentile("mean_value", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"))
    cut = lambda i: F.col("mean_value") <= F.get("q", F.lit(i))
    return means.crossJoin(F.broadcast(q)).select(site, "mean_value", F.when(cut(0), "XS").when(cut(1), "S").when(cut(2), "M").otherwise("L").alias("group_size"))


def error_metrics(df: DataFrame, keys: list[str], y: str, p: str, floor: float = 1.0) -> DataFrame:
    """MAE, RMSE, MAPE (where the actual isn't 0), bias, n and sMAE by keys; rows lacking either value don't count."""
    e = F.col(p) - F.col(y)
    return df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(*keys).agg(
        F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.when(F.col(y) != 0, F.abs(e / F.when(F.col(y) != 0, F.col(y))) * 100)).alias("mape"),
        F.avg(e).alias("bias"), F.count("*").alias("n"), (F.avg(F.abs(e)) / F.greatest(F.avg(y), F.lit(floor))).alias("smae"),
    )


def mase(df: DataFrame, keys: list[str], y: str, p: str, naive: str, eps: float = 1e-9) -> DataFrame:
    """Mean absolute error over that of a naive forecast."""
    return df.where(F.col(y).isNotNull() & F.col(p).isNotNull() & F.col(naive).isNotNull()).groupBy(*keys).agg((F.avg(F.abs(F.col(p) - F.col(y))) / F.greatest(F.avg(F.abs(F.col(naive) - F.col(y))), F.lit(eps))).alias("mase"))


def metrics_by_sets(df: DataFrame, dims: list[str], sets: list[list[str]], y: str, p: str) -> DataFrame:
    """The error metrics by several sets of dimensions in one pass; a dimension out of the set reads (all)."""
    e = F.col(p) - F.col(y)
    own = df.where(F.col(y).isNotNull() & F.col(p).isNotNull()).select(*(F.coalesce(F.col(d).cast("string"), F.lit("(none)")).alias(d) for d in dims), y, p)
    out = own.groupingSets([[F.col(d) for d in s] for s in sets], *(F.col(d) for d in dims)).agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.count("*").alias("n"))
    return out.select(*(F.coalesce(d, F.lit("(all)")).alias(d) for d in dims), "mae", "rmse", "n")


def best_model(metrics: DataFrame, site: str, model: str, by: str = "mae") -> DataFrame:
    """Each site's model of the least error, ties by name."""
    return metrics.groupBy(site).agg(F.min_by(F.col(model), F.struct(by, model)).alias("best_model"), F.min(by).alias(by))


def consolidated(rows: DataFrame, special: DataFrame, keys: list[str], code: str, main: str, value: str) -> DataFrame:
    """Sums of special rows by keys are added to the rows of code `main`; keys without such a row get one."""
    extra = special.groupBy(*keys).agg(F.sum(value).alias("__extra"))
    j = rows.join(extra, keys, "left")
    own = j.withColumn(value, F.when(F.col(code) == main, F.coalesce(value, F.lit(0.0)) + F.coalesce("__extra", F.lit(0.0))).otherwise(F.col(value))).drop("__extra")
    new = extra.join(rows.where(F.col(code) == main).select(*keys).distinct(), keys, "left_anti")
    return own.select(*keys, code, value).unionByName(new.select(*keys, F.lit(main).cast(rows.schema[code].dataType).alias(code), F.col("__extra").alias(value)))
