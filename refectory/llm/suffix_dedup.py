"""Suffix-array de-duplication of repeated passages.

A passage of `length` bytes that occurs twice has the same minimizer in both places: of its k-grams the one of least hash, the first
of equals. So only suffixes at minimizers are sorted, by minimizer: those of one k-gram meet in one task. There they are put in order by
what follows and, mirrored, by what precedes, deep-shallow: by multikey quicksort, eight bytes a character, down to a shallow depth, and
by blind tries beyond it. The common prefixes of neighbours then tell, for each window that a minimizer stands for, which windows are equal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_staged, join_hot, maybe_in, read_table, row_key, small_batches, staged

GRAM = 32
#: Bits of the filter that tells minimizers met once from others; more minimizers than that only make it let more through.
FILTER_BITS = 1 << 26
CHUNK = 2_000_000
SPAN = "k1 long, k2 long, start long, stop long"
ROW = "h long, doc_id long, k1 long, k2 long, pos long, low short, high short, before binary, after binary, start long, stop long, hot boolean"
WINDOW = "w1 long, w2 long, doc_id long, k1 long, k2 long, start long"


def minimizers(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end in data (ends: where each ends): places of minimizers, their hashes, and the least and largest offset
    of a place within the windows of `length` bytes that it is the minimizer of."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.astype(np.uint64), none, none
    h = data.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    n = 1
    while n < GRAM:  # hashes of 2n bytes from two of n
        h = (h[:-n] * np.uint64(0xFF51AFD7ED558CCD)) ^ (h[n:] + np.uint64(0x632BE59BD9B4E019))
        h ^= h >> np.uint64(29)
        n *= 2
    window = length - GRAM + 1
    m = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    n = 1
    while 2 * n <= window:
        m = np.minimum(m[:-n], m[n:])
        n *= 2
    if n < window:
        m = np.minimum(m[: len(h) - window + 1], m[window - n : len(h) - n + 1])
    starts = np.r_[0, ends[:-1]]
    many = np.maximum(ends - starts - length + 1, 0)
    p = np.repeat(starts - np.r_[0, np.cumsum(many)[:-1]], many) + np.arange(many.sum())
    if not len(p):
        return none, none.astype(np.uint64), none, none
    a = (m[p] & np.uint64(0xFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    last = np.r_[first[1:], len(a)] - 1
    return a[first], h[a[first]], a[first] - p[last], a[first] - p[first]


def _chunks(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    """Texts as bytes end to end, their ends, and their (doc_id, k1, k2, place in the text).

    A very long text goes in pieces that share length - 1 bytes, so that each of its windows is in one piece.
    """
    parts, keys, size = [], [], 0

    def out():
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([len(x) for x in parts]), list(keys)

    for batch in batches:
        for text, doc, *k in zip(*(batch[c].to_pylist() for c in ("text", "doc_id", "k1", "k2")), strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            # 2^24 places at most in a chunk
            for at in range(0, max(len(raw) - length + 1, 1), 4 * CHUNK):
                parts.append(raw[at : at + 4 * CHUNK + length - 1]), keys.append((doc, *k, at))
                size += len(parts[-1])
                if size > CHUNK:
                    yield out()
                    parts.clear(), keys.clear()
                    size = 0
    if parts:
        yield out()


def _hashes(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for data, ends, _ in _chunks(batches, length):
            u, n = np.unique(minimizers(data, ends, length)[1], return_counts=True)
            yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(n)], names=["h", "n"])

    return run


def _contexts(length: int, bits, hot):
    """A row for each minimizer that may be met elsewhere, with the bytes around it; of equal surroundings in one batch the first only, the
    others being spans to remove right away. hot: minimizers that too many rows hold for one task."""
    names = ["h", "doc_id", "k1", "k2", "pos", "low", "high", "before", "after", "start", "stop", "hot"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.int16(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, many = bits.value, hot.value if hot else None
        for data, ends, keys in _chunks(batches, length):
            place, h, low, high = minimizers(data, ends, length)
            at = (h % np.uint64(FILTER_BITS)).astype(np.int64)
            keep = np.flatnonzero((words[at >> 6] >> (at & 63)) & 1)
            place, h, low, high, at = place[keep], h[keep].view(np.int64), low[keep], high[keep], at[keep]
            crowded = ((many[at >> 6] >> (at & 63)) & 1).astype(bool) if hot else np.zeros(len(at), bool)
            owner = np.searchsorted(ends, place, "right")
            begin = np.r_[0, ends[:-1]]
            raw = data.tobytes()
            seen: dict = {}
            rows = [[] for _ in names]
            by_doc = sorted(range(len(keys)), key=lambda i: (keys[i][0] is None, keys[i][0] or 0, *keys[i][1:]))
            turn = np.empty(len(keys), np.int64)
            turn[by_doc] = np.arange(len(keys))
            for i in np.lexsort((place, turn[owner])).tolist():
                p, o = int(place[i]), int(owner[i])
                b, e, (doc, k1, k2, shift) = int(begin[o]), int(ends[o]), keys[o]
                lo, hi = int(low[i]), int(high[i])
                before, after = raw[max(b, p - hi) : p], raw[p : min(e, p + length - lo)]
                own = (before, after, lo)
                pos = p - b + shift
                if own in seen:  # all its windows stood earlier
                    row = (None, None, k1, k2, None, None, None, None, None, pos - hi, pos - lo + length, None)
                else:
                    seen[own] = True
                    row = (int(h[i]), doc, k1, k2, pos, lo, hi, before[::-1], after, None, None, bool(crowded[i]))
                for x, v in zip(rows, row, strict=True):
                    x.append(v)
            if rows[0]:
                yield pa.record_batch([pa.array(x, t) for x, t in zip(rows, kinds, strict=True)], names=names)

    return run


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """The order of strings of one length, equal ones in the order given.

    A blind trie holds at its inner nodes only a depth and the bytes there; a string goes down without comparing what lies between,
    and is compared once, with the leaf that it comes to.
    """
    same: dict[bytes, list[int]] = {}
    for i, s in enumerate(strings):
        same.setdefault(s, []).append(i)
    keys = list(same)
    root: object = keys[0]
    for s in keys[1:]:
        node = root
        while not isinstance(node, bytes):
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        x = int.from_bytes(s, "big") ^ int.from_bytes(node, "big")
        d = len(s) - (x.bit_length() + 7) // 8
        other = node[d]
        parent, node = None, root
        while not isinstance(node, bytes) and node[0] < d:
            parent, node = node, node[1][s[node[0]]]
        if not isinstance(node, bytes) and node[0] == d:
            node[1][s[d]] = s
            continue
        new = (d, {other: node, s[d]: s})
        if parent is None:
            root = new
        else:
            parent[1][s[parent[0]]] = new
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if isinstance(node, bytes):
            out += same[node]
        else:
            stack += [node[1][c] for c in sorted(node[1], reverse=True)]
    return out


def multikey_quicksort(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows of words within groups, and for each place in it the number of the run of equal rows that it is in.

    Each round takes all segments that aren't in order yet: a segment is parted by its rows' words at one depth into those below, at
    and above a pivot; those at it go on with the next word.
    """
    n, width = words.shape
    order = np.argsort(group, kind="stable")
    starts = np.r_[True, group[order][1:] != group[order][:-1]] if n else np.zeros(0, bool)
    begin = np.flatnonzero(starts)
    size, depth = np.diff(np.r_[begin, n]), np.zeros(len(begin), np.int64)
    while True:
        live = (size > 1) & (depth < width)
        begin, size, depth = begin[live], size[live], depth[live]
        if not len(begin):
            return order, np.cumsum(starts) - 1
        first = np.cumsum(size) - size
        seg = np.repeat(np.arange(len(size)), size)
        local = np.arange(len(seg)) - first[seg]
        pos = begin[seg] + local
        row = order[pos]
        word = words[row, depth[seg]]
        a, b, c = word[first], word[first + size // 2], word[first + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[seg]
        low, same = word < pivot, word == pivot
        before_low, before_same = np.cumsum(low) - low, np.cumsum(same) - same
        before_low, before_same = before_low - before_low[first][seg], before_same - before_same[first][seg]
        n_low, n_same = np.add.reduceat(low, first, dtype=np.int64), np.add.reduceat(same, first, dtype=np.int64)
        at = np.where(low, before_low, np.where(same, n_low[seg] + before_same, (n_low + n_same)[seg] + local - before_low - before_same))
        order[begin[seg] + at] = row
        n_high = size - n_low - n_same
        begin = np.concatenate([begin, begin + n_low, begin + n_low + n_same])
        size = np.concatenate([n_low, n_same, n_high])
        depth = np.concatenate([depth, depth + 1, depth])
        starts[begin[size > 0]] = True


def deep_shallow(rows: np.ndarray, group: np.ndarray, shallow: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """Order of rows (bytes, one width) within groups, and common prefixes with the row before in that order, -1 where a group begins."""
    n, width = rows.shape
    head = np.zeros((n, -(-min(shallow, width) // 8) * 8), np.uint8)
    head[:, : min(shallow, width)] = rows[:, :shallow]
    order, tie = multikey_quicksort(head.view(">u8").astype(np.uint64), group)
    if width > shallow and n:
        first = np.flatnonzero(np.r_[True, tie[1:] != tie[:-1]])
        size = np.diff(np.r_[first, n])
        for a, k in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            own = order[a : a + k]
            order[a : a + k] = own[blind_trie_order([x.tobytes() for x in rows[own, shallow:]])]
    common = np.full(n, -1, np.int64)
    for a in range(1, n, 50_000):
        b = min(a + 50_000, n)
        differ = rows[order[a:b]] != rows[order[a - 1 : b - 1]]
        common[a:b] = np.where(differ.any(1), differ.argmax(1), width)
    common[np.flatnonzero(np.r_[True, group[order][1:] != group[order][:-1]]) if n else []] = -1
    return order, common


def _padded(column: pa.BinaryArray, width: int) -> np.ndarray:
    """Byte strings as rows, filled up with zeros."""
    n = len(column)
    edge = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + n + 1]
    out = np.zeros((n, width), np.uint8)
    out[np.arange(width) < np.diff(edge)[:, None]] = np.frombuffer(column.buffers()[2], np.uint8)[edge[0] : edge[-1]]
    return out


def repeated_spans(table: pa.Table, length: int) -> tuple[np.ndarray, ...]:
    """Spans (k1, k2, start, stop) of windows that also start earlier, among the minimizers of whole k-grams.

    A minimizer at which a very long text was cut is there twice, each time for other windows.
    """
    empty = tuple(np.zeros(0, np.int64) for _ in range(4))
    h, doc = table["h"].to_numpy(), table["doc_id"].to_pandas()
    none = doc.isna().to_numpy()
    doc = doc.fillna(0).astype("int64").to_numpy()
    order = np.lexsort((-table["high"].to_numpy().astype(np.int64), *(table[c].to_numpy() for c in ("pos", "k2", "k1")), doc, none, h))
    _, group, size = np.unique(h[order], return_inverse=True, return_counts=True)
    order, group = order[size[group] > 1], group[size[group] > 1]
    if not len(order):
        return empty
    table = table.take(pa.array(order)).combine_chunks()
    k1, k2, pos, low, high = (table[c].to_numpy().astype(np.int64) for c in ("k1", "k2", "pos", "low", "high"))
    sides = []
    for name, width in (("before", length - GRAM), ("after", length)):
        rank, common = deep_shallow(_padded(table[name].combine_chunks(), width), group)
        most = np.maximum(common, np.r_[common[1:], -1])  # with either neighbour: the longest with any
        by_row = np.empty(len(rank), np.int64)
        by_row[rank] = most
        sides.append((rank, common, by_row))
    alive = sides[0][2] + sides[1][2] >= length
    n = len(alive)
    found_row, found_offset = [], []
    cls_b, cls_a = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(length - GRAM + 1):
        rows = np.flatnonzero(alive & (low <= o) & (o <= high) & (sides[0][2] >= o) & (sides[1][2] >= length - o))
        if len(rows) < 2:
            continue
        cls_b[sides[0][0]] = np.cumsum(sides[0][1] < o)
        cls_a[sides[1][0]] = np.cumsum(sides[1][1] < length - o)
        _, first = np.unique(cls_b[rows] * (n + 1) + cls_a[rows], return_index=True)
        later = np.ones(len(rows), bool)
        later[first] = False
        found_row.append(rows[later]), found_offset.append(np.full(later.sum(), o))
    if not found_row:
        return empty
    row = np.concatenate(found_row)
    start = pos[row] - np.concatenate(found_offset)
    by = np.lexsort((start, k2[row], k1[row]))
    row, start = row[by], start[by]
    k1, k2 = k1[row], k2[row]
    new = np.flatnonzero(np.r_[True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (start[1:] > start[:-1] + length)])
    last = np.r_[new[1:], len(start)] - 1
    return k1[new], k2[new], start[new], start[last] + length


def _windows(length: int):
    """Each window of each row, as 128 bits and its place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high, pos = (batch[c].to_numpy().astype(np.int64) for c in ("low", "high", "pos"))
            sums = []
            for lo, hi, before, after in zip(low.tolist(), high.tolist(), batch["before"].to_pylist(), batch["after"].to_pylist(), strict=True):
                raw = before[::-1] + after  # what is before has `high` bytes
                sums += [hashlib.blake2b(raw[a : a + length], digest_size=16).digest() for a in range(hi - lo + 1)]
            row = np.repeat(np.arange(len(pos)), high - low + 1)
            first = np.cumsum(high - low + 1) - (high - low + 1)
            start = (pos - high)[row] + np.arange(len(row)) - first[row]
            w = np.frombuffer(b"".join(sums), np.int64).reshape(-1, 2)
            at = pa.array(row)
            yield pa.record_batch([pa.array(w[:, 0]), pa.array(w[:, 1]), batch["doc_id"].take(at), batch["k1"].take(at), batch["k2"].take(at), pa.array(start)], names=["w1", "w2", "doc_id", "k1", "k2", "start"])

    return run


def crowded_spans(rows: DataFrame, length: int, most: int) -> DataFrame:
    """Spans as of repeated_spans, of minimizers that too many rows hold for one task: windows find their least occurrence by aggregation.

    Windows met more than `most` times are sent to the tasks, the 65,536 most frequent ones at most.
    """
    windows = rows.mapInArrow(_windows(length), WINDOW)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2", "start")
    lead = windows.groupBy("w1", "w2").agg(F.min(place).alias("lead"), F.count("*").alias("n")).where("n > 1")
    found = join_hot(windows, staged(lead, "leads"), ["w1", "w2"], "n", most)
    return found.where(place != F.col("lead")).select("k1", "k2", "start", (F.col("start") + length).alias("stop")).distinct()


def _sorted_task(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [b for b in batches if b.num_rows]
        if own:
            yield pa.record_batch([pa.array(x) for x in repeated_spans(pa.Table.from_batches(own), length)], names=["k1", "k2", "start", "stop"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, removed, spans, kept = [], [], [], []
        for text, own in zip(batch["text"].to_pylist(), batch["spans"].to_pylist(), strict=True):
            raw = (text or "").encode("utf-8", "surrogatepass")
            merged: list[list[int]] = []
            for s in sorted((x["start"], x["stop"]) for x in own or ()):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            at, out = 0, []
            for a, b in merged:
                out.append(raw[at:a])
                at = b
            out.append(raw[at:])
            size.append(len(raw)), removed.append(sum(b - a for a, b in merged)), spans.append(merged), kept.append(b"".join(out))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.record_batch([batch["doc_id"], pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array([[{"start": a, "stop": b} for a, b in x] for x in spans], kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "spans", "kept"])


@small_batches
def suffix_dedup(docs: DataFrame, length: int = 100, partition_rows: int = 150_000, hot_rows: int = 150_000) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_bytes, n_removed, spans (start, stop in bytes), kept (binary), one row for each row.

    Removes each byte that lies in a string of `length` bytes (more than 64) that also starts earlier: in a smaller doc_id (null ids
    last), or earlier in the same text. Strings are judged on the input. A null text is empty and loses nothing. Rows of one doc_id
    and one text are one document and all get its result; unlike texts of one doc_id come in a fixed order. Other columns aren't read.
    Of equal texts only the first is searched, the others go whole. Texts move once, at the end; a minimizer that many texts hold is
    thinned to its distinct surroundings in each batch before the shuffle. One met more than hot_rows times is not sorted in one task:
    its windows are told apart by 128 bits each.
    """
    spark, key = docs.sparkSession, ["k1", "k2"]
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *row_key("doc_id", "text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    narrow = staged(keyed.where(size >= length).select("doc_id", *key, size.alias("n"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(3), "text").alias("t2")), "texts")
    lead = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *key)
    copies = staged(narrow.groupBy("t1", "t2").agg(F.min(lead).alias("lead"), F.count("*").alias("rows")).where("rows > 1"), "leads")
    first = (F.col("k1") == F.col("lead.k1")) & (F.col("k2") == F.col("lead.k2"))
    copies = join_hot(narrow, copies, ["t1", "t2"], "rows").groupBy(*key, "n").agg(F.max(first).alias("first"), F.count("*").alias("rows"))
    copies = staged(copies.where("not first or rows > 1"), "copies")
    again, repeated = copies.where("not first").select(*key, "n"), copies.where("first").select(*key)
    long = keyed.where(size >= length).select("doc_id", *key, "text")
    maybe = maybe_in(copies.select(F.col("k1").alias("key")), F.col("k1"))
    texts = long.where(~maybe).unionByName(long.where(maybe).join(copies, key, "left_anti"))
    # of rows that repeat one document one is searched; they are merged in each task before they move
    once = long.where(maybe_in(repeated.select(F.col("k1").alias("key")), F.col("k1"))).groupBy(*key).agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
    texts = texts.unionByName(staged(once.join(repeated, key, "left_semi"), "repeated"))

    hashes = texts.mapInArrow(_hashes(length), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(64)).cast("int"))
    words = hashes.select("n", F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1)).alias("p")).groupBy(F.floor(F.col("p") / 64).cast("int").alias("w"))
    words = words.agg(F.bit_or(bit).alias("v"), F.coalesce(F.bit_or(F.when(F.col("n") > hot_rows, bit)), F.lit(0).cast("long")).alias("hot")).toArrow()
    bits, hot = np.zeros(FILTER_BITS // 64, np.int64), np.zeros(FILTER_BITS // 64, np.int64)
    bits[words["w"].to_numpy()] = words["v"].to_numpy()
    hot[words["w"].to_numpy()] = words["hot"].to_numpy()
    crowded = bool(hot.any())
    bits, hot = spark.sparkContext.broadcast(bits), spark.sparkContext.broadcast(hot) if crowded else None

    found = staged(texts.mapInArrow(_contexts(length, bits, hot), ROW), "suffixes")
    rows = found.where("h is not null and not hot").drop("start", "stop", "hot")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // partition_rows)
    spans = rows.repartition(parts, "h").mapInArrow(_sorted_task(length), SPAN)
    if crowded:
        spans = spans.unionByName(crowded_spans(found.where("hot").drop("start", "stop", "hot"), length, hot_rows))
    spans = spans.unionByName(found.where("h is null").select(*key, "start", "stop"))
    spans = spans.unionByName(again.select(*key, F.lit(0).cast("long").alias("start"), F.col("n").alias("stop")))
    spans = staged(staged(spans, "spans").groupBy(*key).agg(F.collect_set(F.struct("start", "stop")).alias("spans")), "spans")
    drop_staged(found, narrow)
    # texts that lose nothing stay where they are
    maybe = maybe_in(spans.select(F.col("k1").alias("key")), F.col("k1"))
    whole = keyed.where(~maybe).select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    out = keyed.where(maybe).join(spans, key, "left").select("doc_id", "text", "spans").unionByName(whole)
    return out.mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept binary")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
