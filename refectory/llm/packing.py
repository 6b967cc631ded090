"""Best-fit packing with large-item matching.

What decides a packing is only how many pieces there are of each length, at most `capacity` numbers. The plan is made from these:
pieces above a third of the capacity are matched greedily, two per sequence at most, and smaller ones go into the smallest gap that
holds them, longest first. Each piece then finds its place by its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import gives_back, read_table, staged
from .tokens import PreTokens, word_tokenizer, worker_tier

PIECE = "doc_id long, piece int, start long, length long, ids binary"


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, pieces, first sequence, pieces per sequence, offset) that cover every piece; counts: by length."""
    left, runs, done = dict(counts), [], dict.fromkeys(counts, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> (first sequence, sequences)
    order: list[int] = []
    opened = 0

    def place(size: int, n: int, first: int, per: int, offset: int) -> None:
        runs.append((size, done[size], n, first, per, offset))
        done[size] += n
        left[size] -= n

    def free(gap: int, first: int, n: int) -> None:
        if gap and n:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, n))

    large = sorted(x for x in left if 3 * x > capacity)
    for a in reversed(large):
        while left[a]:
            at = bisect.bisect_right(large, min(a, capacity - a)) - 1
            while at >= 0 and (not left[large[at]] or large[at] == a and left[a] < 2):
                at -= 1
            if at < 0:
                n = left[a]
                place(a, n, opened, 1, 0)
                free(capacity - a, opened, n)
            else:
                b = large[at]
                n = left[a] // 2 if a == b else min(left[a], left[b])
                place(a, n, opened, 1, 0)
                place(b, n, opened, 1, a)
                free(capacity - a - b, opened, n)
            opened += n
    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[s]:
            at = bisect.bisect_left(order, s)
            if at == len(order):  # none holds it: open as many as these pieces fill
                n = max(1, left[s] // (capacity // s))
                free(capacity, opened, n)
                opened += n
                continue
            gap = order[at]
            first, n = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap], order[at]
            per = gap // s
            full = min(n, left[s] // per)
            if full:
                place(s, full * per, first, per, capacity - gap)
                free(gap - per * s, first, full)
                free(gap, first + full, n - full)
            else:
                k = left[s]
                place(s, k, first, k, capacity - gap)
                free(gap - k * s, first, 1)
                free(gap, first + 1, n - 1)
    return runs


def _words(ids: list[int], ends: list[int]) -> list[bytes]:
    """The ids of each word as bytes; all are turned into bytes once."""
    raw = np.asarray(ids, "<u4").tobytes()
    return [raw[4 * a : 4 * b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _cut(path: str, capacity: int, end: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tier: PreTokens = worker_tier("ids", path, lambda ids: np.asarray(ids, "<u4").tobytes(), None, path, _words)
        tail = b"" if end is None else np.asarray([end], "<u4").tobytes()
        # a thousand documents at a time: their ids are held until they are passed on
        for batch in (whole.slice(at, 1000) for whole in batches for at in range(0, whole.num_rows, 1000)):
            rows = [[], [], [], [], []]
            for doc, parts in zip(batch["doc_id"].to_pylist(), tier.of(batch["text"].to_pylist()), strict=True):
                ids = b"".join(parts) + tail
                for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    for x, v in zip(rows, (doc, i, at // 4, len(own) // 4, own), strict=True):
                        x.append(v)
            yield pa.record_batch([pa.array(x, t) for x, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["doc_id", "piece", "start", "length", "ids"])

    return run


def token_pieces(docs: DataFrame, capacity: int = 4096, path: str | None = None, end: int | None = 1) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, piece, start, length, ids: token ids (little-endian unsigned 32-bit) in pieces of capacity.

    A null text is empty, and then only the end id, if there is one; documents without any id have no piece.
    """
    path = path or word_tokenizer()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(gives_back(_cut(path, capacity, end)), PIECE)


def pack(pieces: DataFrame, capacity: int = 4096, carry: list[Column] | None = None, slice_rows: int = 50_000) -> DataFrame:
    """pieces (doc_id, piece, start, length, ...) -> doc_id, piece, start, length, what carry names, sequence_id, offset.

    carry: columns made from a piece that go with it (by default its ids). Every piece of 1 to capacity tokens gets a place; no
    sequence is longer than capacity and offsets have no gaps. Repeated rows get places of their own. Null ids are as good as others.
    Ranks within a length are counted by slices of about slice_rows rows, so that a very common length is dealt over many tasks.
    To the driver goes one number for each length, capacity of them at most; the runs of the plan, sent to all tasks, are a few for each.
    """
    own = ["doc_id", "piece", "start", "length"]
    held = staged(pieces.select(*own, *(carry if carry is not None else [F.col("ids")])), "pieces")
    extra = [c for c in held.columns if c not in own]
    n_slices = max(1, held.count() // slice_rows)
    sliced = held.withColumn("__slice", F.pmod(F.xxhash64(*held.columns), F.lit(n_slices)))
    sizes = staged(sliced.groupBy("length", "__slice").agg(F.count("*").alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    if any(not 1 <= x <= capacity for x in counts):
        raise ValueError(f"pack: pieces of 1 to {capacity} tokens are expected")
    base = sizes.select("length", "__slice", (F.sum("n").over(Window.partitionBy("length").orderBy("__slice")) - F.col("n")).alias("__base"))
    within = Window.partitionBy("length", "__slice").orderBy("doc_id", "piece", "start")
    ranked = sliced.withColumn("__rank", F.row_number().over(within) - 1).join(base, ["length", "__slice"])
    ranked = ranked.select(*own, *extra, (F.col("__rank") + F.col("__base")).cast("long").alias("__rank"))
    runs = np.array(sorted(packing_plan(counts, capacity)), np.int64).reshape(-1, 6)
    names = [*own, *extra, "sequence_id", "offset"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = runs[:, 0] * (1 << 44) + runs[:, 1]
        for batch in batches:
            size, rank = batch["length"].to_numpy(), batch["__rank"].to_numpy()
            r = runs[np.searchsorted(starts, size * (1 << 44) + rank, "right") - 1]
            nth = rank - r[:, 1]
            sequence, offset = r[:, 3] + nth // r[:, 4], r[:, 5] + nth % r[:, 4] * size
            yield pa.record_batch([*(batch[c] for c in own + extra), pa.array(sequence), pa.array(offset)], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(read_table(spark, sf_dir, "documents"))
    return pack(pieces, carry=[F.crc32("ids").alias("ids_crc32")])
