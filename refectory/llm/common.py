"""What the training-data operators share: intermediate tables, row keys, word splitting, component finding."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of all contracts here: \x20 and \x09-\x0D, which is also what bytes.split() and bytes.strip() take.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
_OWN_DIR: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where none is set, a temporary one in local mode (tests), an error on a cluster."""
    if at := spark.conf.get("spark.checkpoint.dir", None):
        return at
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
    if not _OWN_DIR:
        _OWN_DIR.append(f"file://{tempfile.mkdtemp(prefix='spark-refectory-')}")
    return _OWN_DIR[0]


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/refectory/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it again: later jobs start from there, also after a lost executor."""
    spark, at = df.sparkSession, work_path(df.sparkSession, name)
    df.write.parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    out.staged_at = at
    return out


def drop_staged(*tables: DataFrame | None) -> None:
    """Delete the files of tables from staged() that nothing reads any more."""
    for df in tables:
        if at := getattr(df, "staged_at", None):
            spark = df.sparkSession
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Spark keeps the shuffle files of a job until the driver happens to collect its garbage, which it seldom does: do it now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def gives_back(kernel: Callable) -> Callable:
    """The kernel, after which its worker, which stays for later tasks, hands what it freed back to the system."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from kernel(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # where the C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return run


def small_batches(operator: Callable, rows: int = 1000) -> Callable:
    """The operator's eager jobs send fewer rows at a time to Python, which bounds memory where rows are whole texts or sets of shingles."""

    @wraps(operator)
    def run(docs: DataFrame, *args: object, **options: object) -> object:
        conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
        held = conf.get(name)
        conf.set(name, str(min(rows, int(held)) if int(held) > 0 else rows))
        try:
            return operator(docs, *args, **options)
        finally:
            conf.set(name, held)

    return run


def join_hot(left: DataFrame, right: DataFrame, on: list[str], weight: str, hot: int = 256, most: int = 1 << 16) -> DataFrame:
    """Inner join with right, which has one row for each key; weight: its column that tells how many rows of left have the key.

    The keys met more than `hot` times, `most` of them at most, are sent to all tasks, so that their rows stay where they are; the rest
    is joined by a shuffle. left is read twice, so it should be a staged table.
    """
    top = right.where(F.col(weight) > hot).orderBy(F.desc(weight), *on).limit(most)
    cols = [*left.columns, *(c for c in right.columns if c not in on)]
    often = left.join(F.broadcast(top), on).select(*cols)
    seldom = left.join(F.broadcast(top.select(*on)), on, "left_anti").join(right, on).select(*cols)
    return often.unionByName(seldom)


def row_key(*cols: str) -> list[Column]:
    """128 bits that stand for a row's values, nulls included: columns k1 and k2."""
    # a null leaves xxhash64's seed as it is, so it is hashed as a flag besides
    own = [x for c in cols for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(*own).alias("k1"), F.xxhash64(F.lit(0x51ED), *own).alias("k2")]


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def maybe_in(keys: DataFrame, key: Column, words: int = 1 << 16) -> Column:
    """A condition that holds where key is one of keys' column key, and seldom elsewhere: one bit for each of 64 * words hashes.

    The bits are one array of a fixed size, gathered as a scalar subquery; with more keys than bits it lets everything through.
    """
    spark = keys.sparkSession
    place = lambda k: F.pmod(k, F.lit(64 * words))
    bits = keys.select(place(F.col("key")).alias("p")).groupBy(F.floor(F.col("p") / 64).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(64)).cast("int"))).alias("v"))
    whole = spark.range(words).select(F.col("id").cast("int").alias("w")).join(bits, "w", "left").select("w", F.coalesce("v", F.lit(0).cast("long")).alias("v"))
    packed = whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "v"))), lambda x: x["v"]).alias("bits"))
    word = F.get(packed.scalar(), F.floor(place(key) / 64).cast("int"))
    return F.getbit(word, F.pmod(place(key), F.lit(64)).cast("int")) == 1


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+`, with A-Z lower-cased and no other letter changed."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def crc_fold(col: str, n: int) -> Column:
    """crc32 of a number as text, modulo n."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(n))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected links by alternating large-star and small-star steps.

    edges: links between columns a and b (long; nulls and loops are ignored). Returns (node, component), component being the
    smallest node of its component; nodes without links aren't listed. Each round is two aggregations and joins on node, whose
    minimum per node is pre-aggregated, and is written to the shared folder, so a lost executor costs one round at most.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u > v").distinct()
    e = staged(e, "links")
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: each larger neighbour of u links to the smallest of u's neighbourhood
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        # small star: u and its smaller neighbours link to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        new = staged(small, "links")
        now = tuple(new.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))).first())
        drop_staged(e)
        e = new
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components: not settled after {max_rounds} rounds")
    nodes = e.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return nodes.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
