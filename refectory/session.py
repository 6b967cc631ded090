"""A session with the settings that the engine's results rely on, and its intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(name: str = "refectory", **settings: str) -> SparkSession:
    base = {
        "spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic", "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return SparkSession.builder.appName(name).config(map=base | settings).getOrCreate()


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder in that of spark.checkpoint.dir; where none is set, a temporary one in local mode (tests), an error on a cluster."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir is not set: streams need a folder that all executors share")
        base = f"file://{tempfile.mkdtemp(prefix='spark-refectory-')}"
    return f"{base}/refectory/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet into that folder and read again, where several later steps read it; it survives lost executors."""
    at = work_path(df.sparkSession, name)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)
