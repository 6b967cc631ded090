"""Scans (S) of landed files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import decimal_comma


def scan_csv(spark: SparkSession, path: str, sep: str = ";", columns: list[str] | None = None) -> DataFrame:
    """A CSV file with a header, all columns as text, a byte-order mark dropped."""
    df = spark.read.csv(path, header=True, sep=sep, encoding="UTF-8", inferSchema=False)
    df = df.toDF(*(c.lstrip("﻿") for c in df.columns))
    return df.select(*(f"`{c}`" for c in columns)) if columns else df


def scan_mapped(spark: SparkSession, files: dict[str, tuple[str, str, dict[str, str]]], numbers: tuple[str, ...] = ()) -> DataFrame | None:
    """Several CSV files, each with its separator and column mapping (source -> name), tagged by source; missing files are skipped."""
    out = None
    for source, (path, sep, mapping) in files.items():
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
            continue
        df = scan_csv(spark, path, sep)
        df = df.select(*((decimal_comma(F.col(f"`{s}`")) if n in numbers else F.col(f"`{s}`")).alias(n) for s, n in mapping.items()), F.lit(source).alias("source"))
        out = df if out is None else out.unionByName(df)
    return out


def scan_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed JSON records with nested objects."""
    return spark.read.schema(schema).json(path)


def date_slice(df: DataFrame, ts: str, start: str, stop: str) -> DataFrame:
    """Rows from start to before stop; the filter reaches the scan."""
    return df.where((F.col(ts) >= F.lit(start).cast("timestamp")) & (F.col(ts) < F.lit(stop).cast("timestamp")))


def known_and_future(df: DataFrame, ts: str, label: str, columns: list[str], as_of: str, days: int) -> tuple[DataFrame, DataFrame]:
    """Of a few columns, rows of the last days with a label, and rows without one."""
    own = df.select(*columns)
    return own.where(F.col(label).isNotNull() & (F.col(ts) >= F.date_sub(F.lit(as_of).cast("date"), days))), own.where(F.col(label).isNull())


def high_water_marks(df: DataFrame, site: str, ts: str, as_of: str, look_back: int, sites: DataFrame | None = None, start: str | None = None) -> DataFrame:
    """By site from where to read on: its latest time, at most as_of less the look-back; sites without rows from the start date."""
    mark = df.groupBy(site).agg(F.max(F.to_date(ts)).alias("mark")).select(site, F.least("mark", F.date_sub(F.lit(as_of).cast("date"), look_back)).alias("read_from"))
    return mark if sites is None else sites.select(site).join(mark, site, "left").select(site, F.coalesce("read_from", F.lit(start).cast("date")).alias("read_from"))


def year_range(*dates: tuple[DataFrame, str]) -> DataFrame:
    """First and last year over several facts."""
    years = [df.select(F.year(c).alias("y")) for df, c in dates]
    both = years[0]
    for y in years[1:]:
        both = both.unionAll(y)
    return both.agg(F.min("y").alias("first_year"), F.max("y").alias("last_year"))


def consolidated(tables: dict[str, DataFrame], key: str) -> DataFrame:
    """Tables of one layout as one, with the table's id and a key that holds it."""
    out = None
    for name, df in tables.items():
        own = df.select(F.lit(name).alias("source_id"), F.concat_ws("_", F.lit(name), F.col(key).cast("string")).alias("pk"), *df.columns)
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out
