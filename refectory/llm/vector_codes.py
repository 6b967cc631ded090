"""Vector codes: vectors cut into parts, each part named by the nearest entry of a codebook, with LAESA pivots.

A part's distances to a few fixed pivots are computed once and kept beside its integer components. In each round the pivots' distances to
the codebook's entries give, by the triangle inequality, lower bounds of the part's distance to each entry. The entry of the least bound
is evaluated first, in exact integers; of the others only those whose bound doesn't exceed the best distance so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_hot, read_table, staged

#: Largest integer component: squared distances of parts of up to 1000 components stay below 2^62.
LARGEST = 1 << 24
#: Rows that a task works on at a time.
ROWS = 2000
CODED = "vec_id long, label_key string, ints binary, to_pivots binary"


def usable(vector: str = "embedding") -> Column:
    """Vectors that are not null and hold neither null nor non-finite components."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.col(vector).isNotNull() & finite


def _measured(size: int, parts: int, pivots: np.ndarray):
    """pivots: (parts, n, components)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                own = batch.slice(at, ROWS)
                vectors = own["embedding"]
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
                ints = np.floor(256 * flat).astype(np.int64)
                cut = ints.reshape(len(ints), parts, -1)
                far = np.sqrt(((cut[:, :, None, :] - pivots[None]) ** 2).sum(3).astype(np.float64)).astype("<f4")
                yield pa.record_batch([own["vec_id"], own["label_key"], pa.array([x.tobytes() for x in ints.astype("<i4")], pa.binary()), pa.array([x.tobytes() for x in far], pa.binary())], names=["vec_id", "label_key", "ints", "to_pivots"])

    return run


def fixed_pivots(book: np.ndarray, n: int) -> np.ndarray:
    """book (entries, components) -> n of its entries far from each other: the first, then always the one farthest from those chosen."""
    chosen = [0]
    while len(chosen) < n:
        far = np.min([((book - book[i]) ** 2).sum(1) for i in chosen], axis=0)
        chosen.append(int(far.argmax()))
    return book[chosen]


def nearest(own: np.ndarray, to_pivots: np.ndarray, book: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """own (rows, components), to_pivots (rows, pivots), book (entries, components): index and squared distance of each row's nearest
    entry, the lower index where two are equally near; and how many distances were evaluated."""
    entries = np.sqrt(((book[:, None, :] - pivots[None]) ** 2).sum(2).astype(np.float64))
    # |d(x, p) - d(e, p)| <= d(x, e); the slack is far more than what rounding to 32 bits can take away
    low = np.zeros((len(own), len(book)))
    for p in range(entries.shape[1]):
        x, e = to_pivots[:, p, None].astype(np.float64), entries[None, :, p]
        np.maximum(low, np.abs(x - e) - 1e-6 * (x + e), out=low)
    low *= low
    first = low.argmin(1)
    best = ((own - book[first]) ** 2).sum(1)
    row, entry = np.nonzero(low <= best[:, None])  # the first one is among them
    exact = ((own[row] - book[entry]) ** 2).sum(1)
    begin = np.searchsorted(row, np.arange(len(own)))
    least = np.minimum.reduceat(exact, begin) if len(own) else best
    hit = np.flatnonzero(exact == least[row])
    _, at = np.unique(row[hit], return_index=True)
    return entry[hit[at]], least, len(own) + len(row)


def _rows(batch: pa.RecordBatch, size: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    ints = np.frombuffer(b"".join(batch["ints"].to_pylist()), "<i4").astype(np.int64).reshape(batch.num_rows, parts, size // parts)
    return ints, np.frombuffer(b"".join(batch["to_pivots"].to_pylist()), "<f4").reshape(batch.num_rows, parts, -1)


def _summed(size: int, parts: int, books: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                ints, far = _rows(whole.slice(at, ROWS), size, parts)
                for p in range(parts):
                    code, _, _ = nearest(ints[:, p], far[:, p], books[p], pivots[p])
                    np.add.at(total[p], code, ints[:, p])
                    count[p] += np.bincount(code, minlength=books.shape[1])
        part, entry = np.nonzero(count)
        yield pa.record_batch([pa.array(part), pa.array(entry), pa.array(count[part, entry]), pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))], names=["part", "entry", "n", "sums"])

    return run


def next_books(rows: DataFrame, size: int, parts: int, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Each entry becomes floor(sum / count) of the parts nearest to it; unused ones stay. A task sends one row for each entry at most."""
    sums = rows.select("ints", "to_pivots").mapInArrow(_summed(size, parts, books, pivots), "part long, entry long, n long, sums array<bigint>")
    own = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size // parts)))
    out = books.copy()
    for r in own.collect():  # parts * entries rows
        out[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(size // parts)]
    return out


def _coded(size: int, parts: int, books: np.ndarray, pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ints, far = _rows(batch, size, parts)
                codes, error = np.zeros((len(ints), parts), np.uint8), np.zeros(len(ints), np.int64)
                for p in range(parts):
                    codes[:, p], least, _ = nearest(ints[:, p], far[:, p], books[p], pivots[p])
                    error += least
                yield pa.record_batch([batch["vec_id"], batch["label_key"], pa.array([x.tobytes().hex() for x in codes], pa.string()), pa.array(error)], names=["vec_id", "label_key", "code", "error"])

    return run


def vector_codes(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, pivots: int = 4) -> tuple[DataFrame, np.ndarray]:
    """vectors (vec_id, embedding, label, ...) -> (vec_id, label_key, code, error), one row for each usable vector; and the codebooks.

    Components become floor(256 * x). The codebooks begin with the vectors of the `entries` smallest vec_ids (null last; of rows of one
    id, by their components), of fewer if there are no more. code: two hex digits for each part; error: squared distances summed over
    the parts. label_key is the label as text after "=", or empty for a null label. To the driver go only codebooks and sums for their
    entries. Vectors whose length isn't that of the first one, or not a multiple of `parts`, and vectors with a component of 2^24 or
    more after scaling, are listed with null code and error and take no part in anything. An empty table gives no rows. Columns but
    these three aren't read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("vector_codes: codes have two hex digits")
    spark = vectors.sparkSession
    label = F.coalesce(F.concat(F.lit("="), F.col("label").cast("string")), F.lit(""))
    own = vectors.where(usable()).select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label_key"), "embedding")
    fits = (F.size("embedding") > 0) & (F.size("embedding") % parts == 0) & F.forall("embedding", lambda x: F.abs(x) < LARGEST // 256)
    order = [F.col("vec_id").asc_nulls_last(), "embedding"]
    lead = own.where(fits).orderBy(*order).select(F.size("embedding").alias("n")).first()
    size = lead["n"] if lead else parts
    good = fits & (F.size("embedding") == size)
    first = own.where(good).orderBy(*order).limit(entries).select("embedding").collect()
    none = own.where(~good).select("vec_id", "label_key", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    if not first:
        return none, np.zeros((parts, 0, size // parts), np.int64)
    books = np.floor(256 * np.array([r["embedding"] for r in first], np.float64)).astype(np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    at = np.array([fixed_pivots(b, min(pivots, len(first))) for b in books])
    rows = staged(own.where(good).mapInArrow(_measured(size, parts, at), CODED), "parts")
    for _ in range(rounds):
        books = next_books(rows, size, parts, books, at)
    out = rows.mapInArrow(_coded(size, parts, books, at), "vec_id long, label_key string, code string, error long")
    return staged(out.unionByName(none), "codes"), books


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = vector_codes(read_table(spark, sf_dir, "embeddings"))
    sums = staged(codes.groupBy("label_key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    out = join_hot(codes, sums, ["label_key"], "n")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _assigned(book: str, name: str) -> str:
    return f"""
{name} AS (SELECT x.v, x.p, arg_min(b.e, (d, b.e)) AS e, min(d) AS d FROM (
  SELECT x.v, x.p, b.e, list_sum(list_transform(list_zip(x.c, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM x JOIN {book} b USING (p)) AS b JOIN x USING (v, p) GROUP BY x.v, x.p)"""


def _moved(book: str, assigned: str, name: str) -> str:
    return f"""
{name} AS (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM {book} b LEFT JOIN (
  SELECT p, e, list(q ORDER BY i) AS c FROM (
    SELECT p, e, i, (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS q FROM (
      SELECT a.p, a.e, unnest(x.c) AS y, generate_subscripts(x.c, 1) AS i FROM {assigned} a JOIN x USING (v, p)) GROUP BY p, e, i) GROUP BY p, e) m USING (p, e))"""


#: For tables without repeated vec_ids, whose vectors are all of one length and within the bounds.
OP11_SQL = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda z: CAST(floor(256 * CAST(z AS DOUBLE)) AS BIGINT)) AS c, row_number() OVER (ORDER BY vec_id) - 1 AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda z: z IS NULL OR NOT isfinite(z))) = 0),
x AS MATERIALIZED (SELECT v, p, c[p * (len(c) // 16) + 1 : (p + 1) * (len(c) // 16)] AS c FROM k, range(16) AS r(p)),
b0 AS (SELECT p, v AS e, c FROM x WHERE v < 64),{_assigned("b0", "a1")},{_moved("b0", "a1", "b1")},{_assigned("b1", "a2")},{_moved("b1", "a2", "b2")},{_assigned("b2", "a3")},
s AS (SELECT v, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a3 GROUP BY v),
h AS (SELECT sha256(string_agg(y, ',' ORDER BY p, e)) AS codebooks_sha256 FROM (SELECT p, e, array_to_string(c, ',') AS y FROM b2))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM k JOIN s USING (v), h
"""
