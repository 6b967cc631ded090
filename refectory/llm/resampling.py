"""Importance resampling towards a target distribution of word n-grams.

Each batch of texts interns its n-grams in an open-addressed NumPy table: the xxhash64 of an n-gram's bytes says where to look, its bytes
are compared on a hit, and each slot holds the n-gram's bucket and how often it came. The corpus' counts by bucket are sums over slots;
a document's weight is what its occurrences, which know their slots, gather from the gains of the buckets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, staged

#: A-Z lower-cased, every other ASCII character but digits and a-z as a space; bytes of other characters belong to words.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
#: Words whose n-grams are interned together, about; a longer text goes in several parts.
PART_WORDS = 20_000
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))  # fixed values of xxHash


def words_of(text: str | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the text with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split() if text else []


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _turn(acc + lane * _P2, 31) * _P1


def eights(flat: np.ndarray) -> np.ndarray:
    """At each place of the bytes the eight that begin there, as a little-endian number; behind the end come zeros."""
    out = np.zeros(len(flat), np.uint64)
    for i in range(8):
        out[: len(flat) - i] |= flat[i:].astype(np.uint64) << np.uint64(8 * i)
    return out


def _lanes_of(lanes: np.ndarray, at: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Cuts spans into lanes of 8 bytes, then one of 4, then of 1: (width, which spans have a next one, its bytes as numbers)."""
    for n, mask in ((8, ~np.uint64(0)), (4, np.uint64(0xFFFFFFFF)), (1, np.uint64(0xFF))):
        more = np.flatnonzero(left >= n)
        while len(more):
            yield n, more, lanes[at[more]] & mask
            at[more] += n
            left[more] -= n
            more = more[left[more] >= n]


def _crc_tables() -> np.ndarray:
    """What a byte that is followed by 0 to 7 zero bytes does to the CRC-32 of polynomial 0xEDB88320."""
    own = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        own = np.where(own & 1, (own >> np.uint32(1)) ^ np.uint32(0xEDB88320), own >> np.uint32(1))
    out = [own]
    for _ in range(7):
        out.append((out[-1] >> np.uint32(8)) ^ own[out[-1] & np.uint32(255)])
    return np.array(out)


_CRC = _crc_tables()


def crc32_of(lanes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32, as zlib's, of spans; lanes: eights() of their bytes."""
    crc = np.full(len(start), 0xFFFFFFFF, np.uint64)
    for n, more, v in _lanes_of(lanes, start.astype(np.int64), length.astype(np.int64)):
        v ^= crc[more] if n > 1 else crc[more] & np.uint64(255)
        out = _CRC[n - 1][(v & np.uint64(255)).astype(np.intp)].astype(np.uint64)
        for i in range(1, n):
            out ^= _CRC[n - 1 - i][((v >> np.uint64(8 * i)) & np.uint64(255)).astype(np.intp)]
        crc[more] = out if n > 1 else out ^ (crc[more] >> np.uint64(8))
    return (crc ^ np.uint64(0xFFFFFFFF)).astype(np.int64)


def xxhash64(lanes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of spans; lanes: eights() of their bytes."""
    with np.errstate(over="ignore"):
        h = np.full(len(start), _P5)
        at, left = start.astype(np.int64), length.astype(np.int64)
        long = np.flatnonzero(left >= 32)
        if len(long):
            acc = [np.full(len(long), x) for x in (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)]
            more = np.arange(len(long))
            while len(more):
                own = long[more]
                for i in range(4):
                    acc[i][more] = _round(acc[i][more], lanes[at[own] + 8 * i])
                at[own] += 32
                left[own] -= 32
                more = more[left[own] >= 32]
            x = _turn(acc[0], 1) + _turn(acc[1], 7) + _turn(acc[2], 12) + _turn(acc[3], 18)
            for a in acc:
                x = (x ^ _round(np.zeros(len(a), np.uint64), a)) * _P1 + _P4
            h[long] = x
        h += length.astype(np.uint64)
        none = np.zeros(1, np.uint64)
        for n, more, v in _lanes_of(lanes, at, left):
            if n == 8:
                h[more] = _turn(h[more] ^ _round(none, v), 27) * _P1 + _P4
            elif n == 4:
                h[more] = _turn(h[more] ^ v * _P1, 23) * _P2 + _P3
            else:
                h[more] = _turn(h[more] ^ v * _P5, 11) * _P1
        h = (h ^ (h >> np.uint64(33))) * _P2
        h = (h ^ (h >> np.uint64(29))) * _P3
        return h ^ (h >> np.uint64(32))


def _same_bytes(lanes: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the spans of `length` bytes at a and at b are equal."""
    same = np.ones(len(a), bool)
    tail = length & 7
    # the last bytes of a span, without what follows
    keep = np.where(tail > 0, (np.uint64(1) << (8 * tail).astype(np.uint64)) - np.uint64(1), np.uint64(0))
    end = length - tail
    odd = np.flatnonzero(tail)
    same[odd] = ((lanes[a[odd] + end[odd]] ^ lanes[b[odd] + end[odd]]) & keep[odd]) == 0
    more, at = np.flatnonzero(same & (end > 0)), 0
    while len(more):
        same[more] = lanes[a[more] + at] == lanes[b[more] + at]
        at += 8
        more = more[same[more] & (end[more] > at)]
    return same


@dataclass
class Interned:
    """The n-grams of one batch. slot: of each occurrence; bucket and count: of each slot (count 0: empty)."""

    slot: np.ndarray
    bucket: np.ndarray
    count: np.ndarray


def intern(flat: bytes, start: np.ndarray, length: np.ndarray, buckets: int) -> Interned:
    """An open-addressed table, at most half full, of the spans of flat; probing is linear, by all occurrences at once."""
    lanes, n = eights(np.frombuffer(flat, np.uint8)), len(start)
    key = xxhash64(lanes, start, length)
    size = 1 << max(1, (2 * n - 1).bit_length())
    owner = np.full(size, -1, np.int64)  # the occurrence whose bytes a slot stands for
    slot = (key & np.uint64(size - 1)).astype(np.int64)
    todo = np.arange(n)
    while len(todo):
        at = slot[todo]
        free = owner[at] < 0
        owner[at[free]] = todo[free]  # of several that meet in an empty slot one takes it, the others look at it like any later one
        first = owner[at]
        same = (key[first] == key[todo]) & (length[first] == length[todo])
        check = np.flatnonzero(same & (first != todo))
        same[check] = _same_bytes(lanes, start[first[check]], start[todo[check]], length[todo[check]])
        todo = todo[~same]
        slot[todo] = (slot[todo] + 1) & (size - 1)
    bucket, used = np.zeros(size, np.int64), np.flatnonzero(owner >= 0)
    bucket[used] = crc32_of(lanes, start[owner[used]], length[owner[used]]) % buckets
    return Interned(slot, bucket, np.bincount(slot, minlength=size))


@dataclass
class Grams:
    """Occurrences of the n-grams of some texts: spans of flat, and which text (by its place in the batch) each comes from."""

    flat: bytes
    start: np.ndarray
    length: np.ndarray
    text: np.ndarray


def grams(texts: list[str | None], longest: int) -> Iterator[tuple[Grams | None, list[tuple[int, int]]]]:
    """All runs of 1 to `longest` consecutive words of each text, PART_WORDS words or so at a time, with (text, words) of what came.

    A part of a longer text also holds the longest - 1 words that follow it, so that no run is lost or counted twice.
    """
    parts: list[tuple[int, list[bytes], int]] = []  # text, words, how many of them runs begin at
    held = 0
    for i, text in enumerate(texts):
        words = words_of(text)
        for at in range(0, max(1, len(words)), PART_WORDS):
            own = words[at : at + PART_WORDS + longest - 1]
            begins = min(PART_WORDS, len(words) - at)
            if held and held + len(own) > PART_WORDS:
                yield _spans(parts, longest), [(t, b) for t, _, b in parts]
                parts, held = [], 0
            parts.append((i, own, begins))
            held += len(own)
    if parts:
        yield _spans(parts, longest), [(t, b) for t, _, b in parts]


def _spans(parts: list[tuple[int, list[bytes], int]], longest: int) -> Grams | None:
    flat = b" ".join(chain.from_iterable(words for _, words, _ in parts))
    if not flat:
        return None
    gap = np.flatnonzero(np.frombuffer(flat, np.uint8) == 32)
    begin, end = np.append(0, gap + 1), np.append(gap, len(flat))
    sizes = np.array([len(words) for _, words, _ in parts])
    stop = np.repeat(np.cumsum(sizes), sizes)  # of each word, where its part ends
    nth = np.arange(len(begin)) - (stop - np.repeat(sizes, sizes))
    text, opens = np.repeat([t for t, _, _ in parts], sizes), nth < np.repeat([b for _, _, b in parts], sizes)
    starts, ends, of = [], [], []
    for n in range(longest):
        at = np.flatnonzero(opens & (np.arange(len(begin)) + n < stop))
        starts.append(begin[at])
        ends.append(end[at + n])
        of.append(text[at])
    start = np.concatenate(starts)
    return Grams(flat, start, np.concatenate(ends) - start, np.concatenate(of))


def _counted(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for own, _ in grams(batch["text"].to_pylist(), longest):
                if own:
                    t = intern(own.flat, own.start, own.length, buckets)
                    total += np.bincount(t.bucket, weights=t.count, minlength=buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, longest: int = 3, buckets: int = 10_000) -> np.ndarray:
    """Occurrences of n-grams by bucket over column text of all rows. A task sends one number for each bucket at most."""
    out = np.zeros(buckets, np.int64)
    counts = texts.select("text").mapInArrow(_counted(longest, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for r in counts.collect():  # one row for each bucket
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of target share over source share), one occurrence added to every bucket of both."""
    n, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * (all_s + n) / (float(s + 1) * (all_t + n)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weighed(gains: np.ndarray, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            weight, features, words = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for own, came in grams(batch["text"].to_pylist(), longest):
                for i, w in came:
                    words[i] += w
                if own:
                    t = intern(own.flat, own.start, own.length, len(gains))
                    np.add.at(weight, own.text, gains[t.bucket][t.slot])
                    features += np.bincount(own.text, minlength=n)
            yield pa.record_batch([batch["doc_id"], pa.array(features), pa.array(words), pa.array(weight)], names=["doc_id", "n_features", "n_words", "weight"])

    return run


def importance_weights(docs: DataFrame, gains: np.ndarray, longest: int = 3) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_features, n_words, weight (sum of the gains of all n-grams, repeats counted)."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(_weighed(gains, longest), "doc_id long, n_features long, n_words long, weight long")


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 * a Gumbel variate), drawn by the first 32 bits of sha256("seed:doc_id")."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def draw(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """scored (doc_id, score, ...), a staged table -> also rank: 1, 2, ... for the floor(percent * N / 100) best of the N eligible rows.

    Best is the highest score, of equal ones the smaller doc_id (null last); repeated rows get ranks of their own. The best scores are
    cut into 16 to 1000 slices; the slices' sizes, one number each, say which of them are ranked at all and where each begins.
    """
    able = scored.where(eligible)
    n = able.count()
    take = percent * n // 100
    slices = min(1000, max(16, take // 20_000))
    # borders only among the best; what lies below is one slice that is not ranked unless the draw reaches into it
    share = [1 - min(1.0, 1.25 * take / max(1, n)) * i / slices for i in range(1, slices + 1)]
    cuts = sorted({r for r in (able.agg(F.percentile_approx("score", share, 100 * slices + 1000).alias("c")).first()["c"] or [])}, reverse=True)
    border = F.array(*(F.lit(x).cast("long") for x in cuts)) if cuts else F.array().cast("array<bigint>")
    part = F.when(F.col("score") >= cuts[-1], F.size(F.filter(border, lambda x: x > F.col("score")))).otherwise(len(cuts)) if cuts else F.lit(0)
    sizes = {r["part"]: r["n"] for r in able.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    ahead, at = {}, 0
    for p in sorted(sizes):
        if at < take:
            ahead[p] = at
        at += sizes[p]
    if not ahead:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    base = F.create_map(*(F.lit(x).cast("long") for p, b in ahead.items() for x in (p, b)))
    ranked = F.row_number().over(Window.partitionBy("__part").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))
    best = scored.withColumn("__part", F.when(eligible, part).otherwise(-1)).where(F.col("__part").isin(*ahead))
    best = best.withColumn("rank", (ranked + base[F.col("__part").cast("long")]).cast("long")).drop("__part")
    rest = scored.where(~F.coalesce(eligible & part.isin(*ahead), F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return best.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank"))).unionByName(rest)


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, longest: int = 3, buckets: int = 10_000, seed: int = 42) -> DataFrame:
    """docs (doc_id, text, ...), target (text, ...) -> doc_id, n_features, n_words, weight, score, rank, one row for each row of docs.

    Words are those of words_of(); features are all runs of 1 to `longest` of them, repeats counted, hashed by crc32 into buckets. A
    bucket's gain compares its share of the target's features with that of docs' features. Null texts and texts without words have no
    features and weigh 0. score adds Gumbel noise that doc_id draws (a null id draws by an empty one), so that the best scores are a
    sample without replacement by weight; rows of one doc_id and text score alike. rank is null for what isn't drawn. An empty target
    or empty docs are no error. Other columns aren't read.
    """
    gains = bucket_gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    weights = importance_weights(docs, gains, longest)
    scored = staged(weights.withColumn("score", (F.col("weight") + gumbel(F.col("doc_id"), seed)).cast("long")), "scores")
    return draw(scored, F.col("n_words") >= least_words, percent)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")
