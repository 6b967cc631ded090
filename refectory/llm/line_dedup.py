"""Line de-duplication: explode normalised lines, hash, count documents per hash, drop, reassemble by position."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_staged, join_hot, read_table, row_key, staged

OCC = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("pos", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.int8())])
FLUSH = 200_000


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z lower-cased."""
    return line.strip(b" \t\n\r\x0b\x0c").lower()


def _explode(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k1, k2, pos, digest, first = [], [], [], [], []

        def out() -> pa.RecordBatch:
            h = np.frombuffer(b"".join(digest), np.int64).reshape(-1, 2)
            made = pa.record_batch([pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(pos, pa.int32()), pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(first, pa.int8())], schema=OCC)
            for x in (k1, k2, pos, digest, first):
                x.clear()
            return made

        for batch in batches:
            for a, b, text in zip(batch["k1"].to_pylist(), batch["k2"].to_pylist(), batch["text"].to_pylist(), strict=True):
                seen = set()
                for i, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
                    key = line_key(line)
                    # code points are the bytes that don't continue one
                    if len(key) < min_chars or sum((c & 0xC0) != 0x80 for c in key[: 4 * min_chars]) < min_chars:
                        continue
                    d = blake2b(key, digest_size=16).digest()
                    k1.append(a), k2.append(b), pos.append(i), digest.append(d), first.append(int(d not in seen))
                    seen.add(d)
                    if len(pos) >= FLUSH:
                        yield out()
        if pos:
            yield out()

    return run


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, lines, dropped = [], [], []
        for text, gone in zip(batch["text"].to_pylist(), batch["gone"].to_pylist(), strict=True):
            own = (text or "").split("\n")
            lines.append(len(own))
            if gone:
                out = set(gone)
                own = [x for i, x in enumerate(own) if i not in out]
            dropped.append(lines[-1] - len(own))
            texts.append("\n".join(own))
        cols = {"kept_text": pa.array(texts, pa.string()), "n_lines": pa.array(lines, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
        kept = [c for c in batch.schema.names if c not in ("text", "gone")]
        yield pa.record_batch([batch[c] for c in kept] + list(cols.values()), names=kept + list(cols))


def line_dedup(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep: Sequence[str] = ()) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, those of keep, kept_text, n_lines, n_dropped, one row for each row.

    A line's key is the line without white space ([\\x20\\x09-\\x0D]) at its ends and with A-Z lower-cased. Keys of at least
    min_chars code points found in at least min_docs rows lose all their lines. A null or empty text is one empty line and stays
    empty; a text that loses all lines becomes empty. Each row counts as a document, also one that repeats another. Other columns
    aren't read; those of keep may have any names but the result's own. Lines are counted by 128-bit hashes: a row for each line goes
    through the shuffle, without its text, and the sum per hash is pre-aggregated; very common lines find their places without a shuffle.
    """
    if clash := {"doc_id", "kept_text", "n_lines", "n_dropped"} & {c.lower() for c in keep}:
        raise ValueError(f"line_dedup: {', '.join(sorted(clash))} can't be kept, the result has columns of that name")
    own = {f"keep_{i}": c for i, c in enumerate(keep)}
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *(F.col(f"`{c}`").alias(n) for n, c in own.items())).select("*", *row_key("doc_id", "text"))
    occ = staged(keyed.select("k1", "k2", "text").mapInArrow(_explode(min_chars), "k1 long, k2 long, pos int, h1 long, h2 long, first tinyint"), "lines")
    common = occ.groupBy("h1", "h2").agg(F.sum("first").alias("n"), F.count("*").alias("lines")).where(F.col("n") >= min_docs).select("h1", "h2", "lines")
    common = staged(common, "common")
    gone = staged(join_hot(occ, common, ["h1", "h2"], "lines").groupBy("k1", "k2").agg(F.collect_set("pos").alias("gone")), "gone")
    drop_staged(occ, common)
    joined = keyed.join(gone, ["k1", "k2"], "left").select("doc_id", *own, "text", "gone")
    kinds = "".join(f"{n} {docs.schema[c].dataType.simpleString()}, " for n, c in own.items())
    out = joined.mapInArrow(_reassemble, f"doc_id long, {kinds}kept_text string, n_lines long, n_dropped long")
    return out.select("doc_id", *(F.col(n).alias(c) for n, c in own.items()), "kept_text", "n_lines", "n_dropped")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
OP2_SQL = f"""
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM s),
k AS (SELECT doc_id, pos, line, translate(trim(line, {_TRIM}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, c.key IS NOT NULL AS gone FROM k LEFT JOIN c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
