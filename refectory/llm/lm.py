"""Language-model scoring by context-tree weighting.

A text's words, A-Z lower-cased and joined by single spaces, then one end byte, are a byte sequence; each byte is eight binary
decisions, and each decision has a context tree over the bytes before it. Every node holds a Krichevsky-Trofimov estimate, and the
weighted mixture over all depths, 0 to DEPTH bytes, is what a frozen context-tree weighting of the training texts predicts.

Byte strings (a context and the byte after it) are counted over all documents and dealt to buckets by their two latest context bytes, so
that each bucket holds whole subtrees, which are built there level by level; only the nodes of depth 1 and 0, at most 65,280 and 255, meet
on the driver. The most frequent byte strings are sent to all tasks, which score texts by them; what a text needs besides is looked up in
the buckets.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_fold, drop_staged, read_table, staged, words_of

DEPTH = 5
END = b"\xff"  # in no UTF-8 text
#: At most this many of the most frequent words and byte strings are sent to all tasks; the others are looked up where they are.
SENT_WORDS, SENT_GRAMS = 1 << 19, 1 << 21
BUCKETS = 512
#: Counts are told apart up to here when those to be sent are chosen.
MOST = 1024
CHUNK = 2_000_000
HALF = math.log(0.5)
NAMES = ["chunk", "idx", "doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base_score", "score", "word", "n", "bucket", "grams", "docs"]
KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
SCORED = "chunk long, idx long, doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double, word binary, n long, bucket int, grams binary, docs binary"
PART = "chunk long, idx long, doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double, docs binary, sums binary"


def byte_grams(words: list[list[bytes]], depth: int = DEPTH) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By a few megabytes: the byte strings that end at each byte of each text, and the number of the text.

    A byte string is the byte's depth predecessors, the latest first (zero bytes stand before a text), then the byte itself.
    """
    parts = [b"\0" * depth + b" ".join(w) + END for w in words]
    data = np.frombuffer(b"".join(parts), np.uint8)
    size = np.fromiter(map(len, parts), np.int64, len(parts))
    doc = np.repeat(np.arange(len(parts), dtype=np.int32), size)
    real = np.ones(len(data), bool)
    real[((np.cumsum(size) - size)[:, None] + np.arange(depth)).ravel()] = False
    for a in range(depth, len(data), CHUNK):
        seg = data[a - depth : a + CHUNK]
        m = len(seg)
        gram = seg[depth:].astype(np.int64)
        for i in range(1, depth + 1):
            gram |= seg[depth - i : m - i].astype(np.int64) << (8 * (depth + 1 - i))
        keep = real[a : a + CHUNK]
        yield gram[keep], doc[a : a + CHUNK][keep]


def _by_bucket(gram: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """An order of byte strings by bucket that leaves those of one bucket as they are, and where each bucket begins in it."""
    latest = gram >> (8 * (depth - 1))
    bucket = (((latest * 40503) & 0xFFFF) >> 7).astype(np.uint16)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(BUCKETS + 1))


def _summed(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct byte strings, sorted, and the sums of their counts."""
    if not len(gram):
        return gram, n
    order = np.argsort(gram, kind="stable")
    gram, n = gram[order], n[order]
    first = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
    return gram[first], np.add.reduceat(n, first)


def _chunks(batches: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[tuple[list[list[bytes]], list[bool], list]]:
    """Texts by a few megabytes: words, whether held out, ids."""
    words, held, ids, n = [], [], [], 0
    for batch in batches:
        for text, out, doc in zip(batch["text"].to_pylist(), batch["held_out"].to_pylist(), batch["doc_id"].to_pylist(), strict=True):
            words.append(words_of(text)), held.append(out), ids.append(doc)
            n += len(text or "") + 8
            if n > size:
                yield words, held, ids
                words, held, ids, n = [], [], [], 0
    if words:
        yield words, held, ids


def _gather(depth: int):
    """Counts of words, and of byte strings by bucket; byte strings of held-out texts alone are there with 0."""
    names, kinds = ["word", "n", "bucket", "grams", "counts"], [pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        grams, ns, waiting = np.zeros(0, np.int64), np.zeros(0, np.int64), []

        def out_words() -> Iterator[pa.RecordBatch]:
            items = list(counts.items())
            counts.clear()
            for i in range(0, len(items), 50_000):
                part = items[i : i + 50_000]
                yield pa.record_batch([pa.array([w for w, _ in part], pa.binary()), pa.array([n for _, n in part], pa.int64()), *(pa.nulls(len(part), t) for t in kinds[2:])], names=names)

        def out_grams() -> pa.RecordBatch:
            order, edge = _by_bucket(grams, depth)
            own = [b for b in range(BUCKETS) if edge[b] < edge[b + 1]]
            cut = lambda x: pa.array([x[order[edge[b] : edge[b + 1]]].tobytes() for b in own], pa.binary())
            return pa.record_batch([*(pa.nulls(len(own), t) for t in kinds[:2]), pa.array(own, pa.int32()), cut(grams), cut(ns)], names=names)

        for words, held, _ in _chunks(batches):
            for w, out in zip(words, held, strict=True):
                if not out:
                    counts.update(w)
                    counts[END] += 1
            out = np.array(held, bool)
            for gram, doc in byte_grams(words, depth):
                hidden = out[doc]
                u, n = np.unique(gram[~hidden], return_counts=True)
                unseen = np.unique(gram[hidden])
                waiting += [(u, n.astype(np.int64)), (unseen, np.zeros(len(unseen), np.int64))]
            if sum(len(x) for x, _ in waiting) > 2_000_000:
                grams, ns = _summed(*(np.concatenate([a, *(x[i] for x in waiting)]) for i, a in enumerate((grams, ns))))
                waiting.clear()
            if len(grams) > 2_000_000:
                yield out_grams()
                grams, ns = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if len(counts) > 300_000:
                yield from out_words()
        yield from out_words()
        grams, ns = _summed(*(np.concatenate([a, *(x[i] for x in waiting)]) for i, a in enumerate((grams, ns))))
        if len(grams):
            yield out_grams()

    return run


_LOG_GAMMA: list[np.ndarray] = []


def _log_gamma_half(x: np.ndarray) -> np.ndarray:
    """ln Gamma(x + 0.5) for whole x >= 0: from a table, beyond it by Stirling's series."""
    if not _LOG_GAMMA:
        _LOG_GAMMA.append(math.log(math.pi) / 2 + np.r_[0.0, np.cumsum(np.log(np.arange(1 << 16) + 0.5))])
    table = _LOG_GAMMA[0]
    out = table[np.minimum(x, len(table) - 1)]
    if len(big := np.flatnonzero(x >= len(table))):
        y = x[big] + 0.5
        out[big] = (y - 0.5) * np.log(y) - y + math.log(2 * math.pi) / 2 + 1 / (12 * y) - 1 / (360 * y**3)
    return out


_LOG_FACTORIAL: list[np.ndarray] = []


def _log_factorial(x: np.ndarray) -> np.ndarray:
    if not _LOG_FACTORIAL:
        _LOG_FACTORIAL.append(np.r_[0.0, np.cumsum(np.log(np.arange(1, 1 << 16)))])
    table = _LOG_FACTORIAL[0]
    out = table[np.minimum(x, len(table) - 1)]
    if len(big := np.flatnonzero(x >= len(table))):
        y = x[big] + 1.0
        out[big] = (y - 0.5) * np.log(y) - y + math.log(2 * math.pi) / 2 + 1 / (12 * y) - 1 / (360 * y**3)
    return out


def kt_log(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of a sequence of a zeros and b ones."""
    return _log_gamma_half(a) + _log_gamma_half(b) - _log_factorial(a + b) - math.log(math.pi)


class Subtrees:
    """The context trees' nodes of depth 2 and more over sorted byte strings, which hold every string of their two latest bytes."""

    def __init__(self, gram: np.ndarray, n: np.ndarray, depth: int) -> None:
        self.gram, self.n, self.depth, self.symbol = gram, n, depth, gram & 255
        # in each depth's order, strings of one node stand together, whichever of the eight decisions the node belongs to
        self.orders = {depth: np.arange(len(gram))}
        for d in range(depth - 1, 1, -1):
            self.orders[d] = np.argsort(self._context(d) << 8 | self.symbol, kind="stable")

    def _context(self, d: int) -> np.ndarray:
        return self.gram >> (8 * (self.depth + 1 - d))

    def decision(self, j: int) -> tuple[np.ndarray, dict]:
        """The j-th decision's bits, and by depth: names of nodes, where they begin in the depth's order, zeros, ones, own and mixed logs."""
        bit, part = self.symbol >> (7 - j) & 1, (1 << j) | (self.symbol >> (8 - j))
        levels, below, ones = {}, np.zeros(len(self.gram)), self.n * bit
        for d in range(self.depth, 1, -1):
            o = self.orders[d]
            name = (self._context(d) << 8 | part)[o]
            first = np.flatnonzero(np.r_[True, name[1:] != name[:-1]])
            b = np.add.reduceat(ones[o], first)
            a = np.add.reduceat(self.n[o], first) - b
            own = kt_log(a, b)
            mixed = own if d == self.depth else HALF + np.logaddexp(own, np.add.reduceat(below[o], first))
            below = np.zeros(len(self.gram))
            below[o[first]] = mixed
            levels[d] = name[first], first, a, b, own, mixed
        return bit, levels

    def log10(self, top: np.ndarray) -> np.ndarray:
        """log10 of each string's last byte given the others. top: for nodes of depth 1, the probability of a one so far and the weight left."""
        out = np.zeros(len(self.gram))
        for j in range(8 if len(self.gram) else 0):
            bit, levels = self.decision(j)
            node = self._context(1) << 8 | (1 << j) | (self.symbol >> (8 - j))
            p, rest = top[0][node], top[1][node]
            for d in range(2, self.depth + 1):
                name, first, a, b, own, mixed = levels[d]
                stop = np.exp(HALF + own - mixed) if d < self.depth else np.ones(len(own))
                each = np.empty(len(self.gram), np.int64)
                each[self.orders[d]] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(self.gram)]))
                p = p + rest * (stop * (b + 0.5) / (a + b + 1.0))[each]
                rest = rest * (1 - stop)[each]
            out += np.log10(np.where(bit == 1, p, 1 - p))
        return out


def _merged(depth: int):
    """One row for each bucket, with its distinct byte strings, their counts and how many have which count; and the nodes of depth 2."""
    names, kinds = ["bucket", "grams", "counts", "how_many", "node", "a", "b", "mixed"], [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, g, n in zip(batch["bucket"].to_pylist(), batch["grams"], batch["counts"], strict=True):
                own = held.setdefault(bucket, [])
                own.append(tuple(np.frombuffer(x.as_buffer(), np.int64) for x in (g, n)))
                if sum(len(x) for x, _ in own[1:]) > 1_000_000 + len(own[0][0]):
                    own[:] = [_summed(*(np.concatenate([x[i] for x in own]) for i in (0, 1)))]
        for bucket in sorted(held):
            own = held.pop(bucket)
            gram, n = _summed(*(np.concatenate([x[i] for x in own]) for i in (0, 1)))
            how_many = np.bincount(np.minimum(n, MOST), minlength=MOST + 1)
            yield pa.record_batch([pa.array([bucket], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (gram, n, how_many)), *(pa.nulls(1, t) for t in kinds[4:])], names=names)
            tree = Subtrees(gram, n, depth)
            for j in range(8):
                name, _, a, b, _, mixed = tree.decision(j)[1][2]
                yield pa.record_batch([*(pa.nulls(len(name), t) for t in kinds[:4]), *(pa.array(x) for x in (name, a, b, mixed))], names=names)

    return run


def top_nodes(first: pa.Table) -> np.ndarray:
    """Of the nodes of depth 1 (node, a, b, below: its children's logs in sum): the probability of a one by depths 0 and 1, and the weight left."""
    node, a, b, below = (first[c].to_numpy() for c in ("node", "a", "b", "below"))
    own = kt_log(a, b)
    mixed = HALF + np.logaddexp(own, below)
    part = node & 255
    a0, b0, below0 = (np.bincount(part, x, 256) for x in (a, b, mixed))
    own0 = kt_log(a0.astype(np.int64), b0.astype(np.int64))
    stop0 = np.exp(HALF + own0 - (HALF + np.logaddexp(own0, below0)))
    stop = np.exp(HALF + own - mixed)
    out = np.zeros((2, 1 << 16))
    out[0, node] = (stop0 * (b0 + 0.5) / (a0 + b0 + 1))[part] + (1 - stop0)[part] * stop * (b + 0.5) / (a + b + 1.0)
    out[1, node] = (1 - stop0)[part] * (1 - stop)
    return out


def _modelled(depth: int, top, often: int):
    """(bucket, grams, logs) of each bucket, and those of its byte strings that have a count of `often` at least."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, g, n in zip(batch["bucket"].to_pylist(), batch["grams"], batch["counts"], strict=True):
                gram, n = (np.frombuffer(x.as_buffer(), np.int64) for x in (g, n))
                logs = Subtrees(gram, n, depth).log10(top.value)
                sent = n >= often
                yield pa.record_batch([pa.array([bucket], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in (gram, logs, gram[sent], logs[sent]))], names=["bucket", "grams", "logs", "often_grams", "often_logs"])

    return run


class GramTable:
    """A hash table from byte strings to numbers, for many at once."""

    def __init__(self, gram: np.ndarray, value: np.ndarray) -> None:
        bits = max(int(2 * len(gram)).bit_length(), 4)
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
        at, left = self._slot(gram), np.arange(len(gram))
        while len(left):
            free = self.keys[at] < 0
            self.keys[at[free]] = gram[left[free]]
            own = self.keys[at] == gram[left]
            self.values[at[own]] = value[left[own]]
            at, left = (at[~own] + 1) & self.mask, left[~own]

    def _slot(self, gram: np.ndarray) -> np.ndarray:
        return ((gram.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each is there, and its value or 0."""
        at = self._slot(gram)
        met = self.keys[at]
        hit = met == gram
        left = np.flatnonzero(~hit & (met >= 0))
        while len(left):
            at[left] = (at[left] + 1) & self.mask
            met = self.keys[at[left]]
            hit[left] = met == gram[left]
            left = left[~hit[left] & (met >= 0)]
        return hit, np.where(hit, self.values[at], 0.0)


def _scored(depth: int, sent_words, sent_grams):
    """A row for each text with what the sent words and byte strings give; the rest as rows by word or by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = sent_words.value, sent_grams.value
        chunk = TaskContext.get().partitionId() << 32

        def rows(size: int, **cols) -> pa.RecordBatch:
            return pa.record_batch([pa.array(cols[c], t) if c in cols else pa.nulls(size, t) for c, t in zip(NAMES, KINDS, strict=True)], names=NAMES)

        for words, held, ids in _chunks(batches):
            chunk += 1
            n_bytes, n_tokens, n_known, base = [], [], [], []
            rare_doc, rare_word, rare_n = [], [], []
            for i, w in enumerate(words):
                w.append(END)
                logs = [x for x in map(known.get, w) if x is not None]
                n_bytes.append(sum(map(len, w)) + len(w) - 1 - (len(w) > 1)), n_tokens.append(len(w)), n_known.append(len(logs)), base.append(math.fsum(logs))
                if len(logs) < len(w):
                    for x, n in Counter(x for x in w if x not in known).items():
                        rare_doc.append(i), rare_word.append(x), rare_n.append(n)
                w.pop()
            score, ask, ask_doc = np.zeros(len(words)), [], []
            for gram, doc in byte_grams(words, depth):
                hit, logs = table.get(gram)
                score += np.bincount(doc, logs, len(words))
                ask.append(gram[~hit]), ask_doc.append(doc[~hit])
            yield rows(len(words), chunk=[chunk] * len(words), idx=np.arange(len(words)), doc_id=ids, held_out=held, n_bytes=n_bytes, n_tokens=n_tokens, n_known=n_known, base_score=base, score=score)
            for a in range(0, len(rare_doc), 100_000):
                own = slice(a, a + 100_000)
                yield rows(len(rare_doc[own]), chunk=[chunk] * len(rare_doc[own]), idx=rare_doc[own], word=rare_word[own], n=rare_n[own])
            gram, doc = np.concatenate(ask), np.concatenate(ask_doc)
            order, edge = _by_bucket(gram, depth)
            asked = [b for b in range(BUCKETS) if edge[b] < edge[b + 1]]
            cut = lambda x: [x[order[edge[b] : edge[b + 1]]].tobytes() for b in asked]
            if asked:
                yield rows(len(asked), chunk=[chunk] * len(asked), bucket=asked, grams=cut(gram), docs=cut(doc))

    return run


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, the bucket's byte strings and logs (logs not null) before those asked for -> sums by chunk and text."""
    current, keys, values, sums, size = None, None, None, {}, 0

    def out() -> pa.RecordBatch:
        chunks, docs, totals = [], [], []
        for chunk, own in sums.items():
            doc, where = np.unique(np.concatenate([d for d, _ in own]), return_inverse=True)
            chunks.append(chunk), docs.append(doc.tobytes()), totals.append(np.bincount(where, np.concatenate([s for _, s in own]), len(doc)).tobytes())
        sums.clear()
        return pa.record_batch([pa.array(chunks, pa.int64()), pa.array(docs, pa.binary()), pa.array(totals, pa.binary())], names=["chunk", "docs", "sums"])

    for batch in batches:
        for bucket, chunk, g, logs, d in zip(batch["bucket"].to_pylist(), batch["chunk"].to_pylist(), batch["grams"], batch["logs"], batch["docs"], strict=True):
            gram = np.frombuffer(g.as_buffer(), np.int64)
            if logs.is_valid:
                current, keys, values = bucket, gram, np.frombuffer(logs.as_buffer(), np.float64)
                continue
            if bucket != current:
                raise RuntimeError(f"bucket {bucket} is asked but not there")
            doc = np.frombuffer(d.as_buffer(), np.int32)
            u, where = np.unique(doc, return_inverse=True)
            sums.setdefault(chunk, []).append((u, np.bincount(where, values[np.searchsorted(keys, gram)], len(u))))
            size += len(u)
            if size > 2_000_000:
                yield out()
                size = 0
    if sums:
        yield out()


def _completed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk, its texts before what else was found for them -> whole rows."""
    names = ["doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base_score", "score"]
    current, held, n = None, {c: [] for c in names}, 0
    more: dict[str, np.ndarray] = {}

    def out() -> pa.RecordBatch:
        cols = {c: pa.concat_arrays(x) for c, x in held.items()}
        for c in more:
            cols[c] = pa.array((cols[c].to_numpy() + more[c]).astype(np.int64 if c == "n_known" else np.float64))
        return pa.record_batch([cols[c] for c in names], names=names)

    def grown(c: str) -> np.ndarray:
        if len(more.setdefault(c, np.zeros(n))) < n:
            more[c] = np.r_[more[c], np.zeros(n - len(more[c]))]
        return more[c]

    for batch in batches:
        chunk = batch["chunk"].to_numpy()
        edges = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1]]).tolist() if len(chunk) else []
        for a, b in zip(edges, [*edges[1:], len(chunk)], strict=True):
            own = batch.slice(a, b - a)
            if chunk[a] != current:
                if n:
                    yield out()
                current, n = chunk[a], 0
                more.clear()
                for x in held.values():
                    x.clear()
            kind = own["kind"].to_numpy()
            texts = int((kind == 0).sum())
            for c in names:
                held[c].append(own[c].slice(0, texts))
            n += texts
            words = own.slice(texts, int((kind == 1).sum()))
            if len(words):
                np.add.at(grown("n_known"), words["idx"].to_numpy(), words["n_known"].to_numpy())
                np.add.at(grown("base_score"), words["idx"].to_numpy(), words["base_score"].to_numpy())
            for d, s in zip(own["docs"].slice(texts + len(words)), own["sums"].slice(texts + len(words)), strict=True):
                grown("score")[np.frombuffer(d.as_buffer(), np.int32)] += np.frombuffer(s.as_buffer(), np.float64)
    if n:
        yield out()


def lm_scores(docs: DataFrame, held_out: Column, depth: int = DEPTH) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte, one row for each row.

    Trained on rows for which held_out is false or null. Tokens are words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, then one end; a
    null or empty text is only the end. base_score: log10 of the add-one unigram model; score: log10 of the context-tree model's
    probability of the text's byte sequence; bits_per_byte: that code length over the sequence's bytes. depth: 2 to 6 bytes of context. With
    no training text, counts are all 0. Each row is scored by itself, also one that repeats another. Other columns aren't read. Of words
    and byte strings the most frequent ones go to all tasks (SENT_WORDS and SENT_GRAMS at most), the others meet in shuffles.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    gathered = staged(own.mapInArrow(_gather(depth), "word binary, n long, bucket int, grams binary, counts binary"), "counts")
    words = staged(gathered.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")), "words")
    counts = gathered.where("bucket is not null").select("bucket", "grams", "counts").repartition("bucket")
    merged = staged(counts.mapInArrow(_merged(depth), "bucket int, grams binary, counts binary, how_many binary, node long, a long, b long, mixed double"), "grams")
    drop_staged(gathered)

    up = F.shiftleft(F.shiftright("node", 16), 8).bitwiseOR(F.col("node").bitwiseAND(F.lit(255)))
    first = merged.where("node is not null").groupBy(up.alias("node")).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("mixed").alias("below")).toArrow()
    top = spark.sparkContext.broadcast(top_nodes(first))
    how_many = sum((np.frombuffer(r["how_many"], np.int64) for r in merged.where("bucket is not null").select("how_many").toLocalIterator()), np.zeros(MOST + 1, np.int64))
    at_least = np.cumsum(how_many[::-1])[::-1]
    all_grams = first["a"].to_numpy()[first["node"].to_numpy() & 255 == 1].sum() + first["b"].to_numpy()[first["node"].to_numpy() & 255 == 1].sum()
    fits = np.flatnonzero(at_least[1:] <= SENT_GRAMS)
    often = int(fits[0]) + 1 if len(fits) else max(MOST, -(-int(all_grams) // SENT_GRAMS))
    model = staged(merged.where("bucket is not null").select("bucket", "grams", "counts").mapInArrow(_modelled(depth, top, often), "bucket int, grams binary, logs binary, often_grams binary, often_logs binary"), "model")
    drop_staged(merged)
    sent = model.select("often_grams", "often_logs").toArrow()
    sent_grams = spark.sparkContext.broadcast(GramTable(*(np.frombuffer(b"".join(sent[c].to_pylist()), t) for c, t in (("often_grams", np.int64), ("often_logs", np.float64)))))
    del sent

    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    lost = math.log10(total + distinct + 1)
    steps = words.groupBy(F.least("n", F.lit(MOST)).alias("n")).count().orderBy(F.desc("n")).collect()
    least, room = max(MOST, -(-total // SENT_WORDS)), SENT_WORDS
    for step in steps:
        room -= step["count"]
        if room < 0:
            break
        least = step["n"]
    sent = words.where(F.col("n") >= least).toArrow()
    sent_words = spark.sparkContext.broadcast(dict(zip(sent["word"].to_pylist(), (np.log10(sent["n"].to_numpy() + 1.0) - lost).tolist(), strict=True)))

    out = staged(own.mapInArrow(_scored(depth, sent_words, sent_grams), SCORED), "scored")
    for b in (top, sent_words, sent_grams):
        b.unpersist()
    c = F.coalesce(words["n"], F.lit(0))
    rare = out.where("word is not null").select("chunk", "idx", "word", F.col("n").alias("times")).join(words, "word", "left").groupBy("chunk", "idx")
    rare = rare.agg(F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("n_known"), F.sum(F.col("times") * (F.log10(c + 1) - lost)).alias("base_score"))
    null = F.lit(None)
    asked = model.select("bucket", null.cast("long").alias("chunk"), "grams", "logs", null.cast("binary").alias("docs"))
    asked = asked.unionByName(out.where("bucket is not null").select("bucket", "chunk", "grams", null.cast("binary").alias("logs"), "docs"))
    found = asked.repartition("bucket").sortWithinPartitions("bucket", F.col("logs").isNull()).mapInArrow(_looked_up, "chunk long, docs binary, sums binary")
    texts = out.where("n_tokens is not null").select(F.lit(0).alias("kind"), "chunk", "idx", "doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base_score", "score", null.cast("binary").alias("docs"), null.cast("binary").alias("sums"))
    parts = texts.unionByName(rare.select(F.lit(1).alias("kind"), "*"), True).unionByName(found.select(F.lit(2).alias("kind"), "*"), True)
    whole = parts.repartition("chunk").sortWithinPartitions("chunk", "kind", "idx").mapInArrow(_completed, "doc_id long, held_out boolean, n_bytes long, n_tokens long, n_known long, base_score double, score double")
    bits = -F.col("score") * math.log2(10) / F.col("n_bytes")
    return whole.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", bits.alias("bits_per_byte"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"), crc_fold("doc_id", 7) == 2)
