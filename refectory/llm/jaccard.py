"""N-gram Jaccard join by a token-group matrix.

Texts with one and the same set of shingles are one class. Classes that share a rare shingle are put into groups, each around a leader,
the class of theirs whose shingles are the most common; a group is kept in blocks of a bounded number of shingles. Within a block every
class that its leader doesn't reach is held against all others. Then a matrix of shingles and blocks tells which classes meet which other
blocks; a class opens a block only where its overlap with the union of the block's shingles reaches what a link needs, and only then is it
compared with the members. Before that, classes that by a sketch of their shingles can't link with any other of a short list leave it.
Classes already linked, directly or not, are not compared again.

Which shingles of a set must be looked up follows the prefix lemma: with sets of a and b shingles that link only if they share o, the
first a - o + 1 and b - o + 1 shingles in any common order share one at least. Shingles met often come last in that order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, drop_staged, free_name, gives_back, join_hot, maybe_in, read_table, release, row_key, small_batches, staged, words_of

#: Counts of shingles are kept in at most 2^22 cells, by the first bits of their hashes; one byte a cell is sent to all tasks. They only
#: set the order in which shingles are looked up.
CELL_BITS, PART_BITS = 22, 10
#: Looked-up shingles of a part, about: with many there are more than 2^PART_BITS parts.
PART_TOKENS = 4_000_000
#: Shingles that a task holds before it passes them on.
AT_ONCE = 300_000
#: Shingles of a block's classes together, about.
BLOCK_SHINGLES = 1_000_000
#: Lists of a shingle with more classes than that aren't thinned by sketches: their classes are grouped as they are.
SHORT_LIST = 64
#: Classes that ask one copy of a block.
ASKING = 5_000
CACHE = 100_000
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHE:
            self.clear()
        h = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return h


_HASHES = _WordHashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _M1
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str | None, k: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of k words; of fewer words, the sequence as one; none without words."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    size = min(k, len(w))
    h = w[: len(w) - size + 1].copy()
    for j in range(1, size):
        h = _mixed(h) * _M2 + w[j : len(w) - size + 1 + j]
    return np.unique(_mixed(h + np.uint64(size)))


def set_digest(tokens: np.ndarray) -> tuple[int, int]:
    d = blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _survey(k: int):
    """A row for each document; and the cells of the shingles of the classes of a few megabytes of documents, by part."""
    names = ["k1", "k2", "doc_id", "n", "h", "h2", "part", "cells"]
    low = CELL_BITS - PART_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, seen = [], 0, set()

        def cells() -> pa.RecordBatch:
            cell = np.sort((np.concatenate(waiting) >> np.uint64(64 - CELL_BITS)).astype(np.uint32))
            edges = np.searchsorted(cell, np.arange((1 << PART_BITS) + 1) << low)
            parts = np.flatnonzero(np.diff(edges))
            own = (cell & np.uint32((1 << low) - 1)).astype(np.uint16)
            waiting.clear(), seen.clear()
            return pa.record_batch([*(pa.nulls(len(parts), pa.int64()) for _ in range(6)), pa.array(parts, pa.int32()), pa.array([own[edges[p] : edges[p + 1]].tobytes() for p in parts.tolist()], pa.binary())], names=names)

        for batch in batches:
            n, h, h2 = [], [], []
            for text in batch["text"]:
                tokens = shingle_set(text.as_py(), k)
                d = set_digest(tokens)
                n.append(len(tokens)), h.append(d[0]), h2.append(d[1])
                if d not in seen and len(tokens):
                    seen.add(d), waiting.append(tokens)
                    size += len(tokens)
                    if size > AT_ONCE:
                        yield cells()
                        size = 0
            own = [batch["k1"], batch["k2"], batch["doc_id"], *(pa.array(x, pa.int64()) for x in (n, h, h2))]
            yield pa.record_batch([*own, pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names=names)
        if waiting:
            yield cells()

    return run


def _levels(counts: np.ndarray) -> np.ndarray:
    """Counts as bytes: 0 for none, 1 for one, then eight steps for each doubling."""
    return np.where(counts > 0, np.minimum(1 + 8 * np.log2(np.maximum(counts, 1)), 255), 0).astype(np.uint8)


def _counted(bits: int):
    """The levels of the cells of each part, folded to 2^bits cells in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, sums = CELL_BITS - PART_BITS, {}
        for batch in batches:
            for part, cells in zip(batch["part"].to_pylist(), batch["cells"], strict=True):
                found = np.bincount(np.frombuffer(cells.as_buffer(), np.uint16), minlength=1 << low)
                sums[part] = sums[part] + found if part in sums else found
        out = {p: _levels(x.reshape(-1, 1 << (CELL_BITS - bits)).sum(1)).tobytes() for p, x in sums.items()}
        yield pa.record_batch([pa.array(list(out), pa.int32()), pa.array(list(out.values()), pa.binary())], names=["part", "levels"])

    return run


def _prefixes(k: int, num: int, den: int, part_bits: int, sent):
    """For each class met in a task (cls, h, h2, n, central, sketch), central being how common its shingles are; and by part, in arrays, the shingles
    of a few thousand classes that must be looked up, each with a number: its class's from cls on, times 32, then its place in
    sixteenths of the prefix, times 2, and one more if it is short: enough with a set of the class's size or more."""
    names = ["cls", "h", "h2", "n", "central", "sketch", "part", "tokens", "owners"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = sent.value
        shift = np.uint64(64 - (len(levels).bit_length() - 1))
        cls = TaskContext.get().partitionId() << 32
        seen, rows, tokens, owners, size = set(), [], [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal cls
            yield pa.record_batch([pa.array(np.arange(cls, cls + len(rows))), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(4)), pa.array([r[4] for r in rows], pa.list_(pa.int64())), pa.nulls(len(rows), pa.int32()), *(pa.nulls(len(rows), pa.binary()) for _ in range(2))], names=names)
            token, owner = np.concatenate(tokens), np.concatenate(owners)
            part = (token >> np.uint64(64 - part_bits)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            own, edge = np.unique(part[order], return_index=True)
            own, edge = own.tolist(), [*edge.tolist(), len(part)]
            cut = lambda x: pa.array([x[order[a:b]].tobytes() for a, b in zip(edge, edge[1:], strict=False)], pa.binary())
            yield pa.record_batch([pa.array([cls] * len(own), pa.int64()), *(pa.nulls(len(own), pa.int64()) for _ in range(4)), pa.nulls(len(own), pa.list_(pa.int64())), pa.array(own, pa.int32()), cut(token), cut(owner)], names=names)
            cls += len(rows)
            rows.clear(), tokens.clear(), owners.clear()

        for batch in batches:
            for text in batch["text"]:
                own = shingle_set(text.as_py(), k)
                n = len(own)
                if not n or (d := set_digest(own)) in seen:
                    continue
                seen.add(d)
                level = levels[(own >> shift).astype(np.int64)]
                order = np.argsort(level, kind="stable")[: n - -(-num * n // den) + 1]
                tokens.append(own[order])
                place = np.arange(len(order))
                owners.append((len(rows) << 5 | 16 * place // len(order) << 1 | (place <= n - -(-2 * num * n // (num + den)))).astype(np.uint32))
                rows.append((*d, n, int(16 * level.mean()), sketch(own)))
                size += len(order)
                if size > AT_ONCE:
                    yield from out()
                    size = 0
            if len(seen) > 500_000:
                seen.clear()
        if rows:
            yield from out()

    return run


def sketch(tokens: np.ndarray) -> np.ndarray:
    """512 bits, each the parity of the number of tokens that fall on it: two sets differ in as many tokens as their sketches in bits, or more."""
    return np.packbits(np.bincount((tokens & np.uint64(511)).astype(np.int64), minlength=512).astype(np.uint8) & 1).view(np.int64)


def may_link(a: str, b: str, num: int, den: int) -> Column:
    """Whether sets of sizes a.n and b.n with such sketches can link: they differ in (den - num) / (den + num) of both sizes at most."""
    bits = [F.bit_count(F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])) for i in range(8)]
    return reduce(lambda x, y: x + y, bits) * (den + num) <= (F.col(f"{a}.n") + F.col(f"{b}.n")) * (den - num)


def may_reach(num: int, den: int) -> Column:
    """Whether sets x and y of which this shingle is the first common one can share enough: of each, only what follows it can be common.

    place: in sixteenths of what is looked up of a set, rounded down. A pair that links passes at its first common shingle.
    """
    left = [F.col(f"{s}.n") - F.floor(F.col(f"{s}.place") * (F.col(f"{s}.n") - F.ceil(F.col(f"{s}.n") * num / den) + 1) / 16) for s in "xy"]
    return F.least(*left) * (num + den) >= (F.col("x.n") + F.col("y.n")) * num


def _paired(lists: DataFrame, may: Column) -> DataFrame:
    """Rows of lists (token, node, n, ...) that have another one of their token with which they may link."""
    x, y = lists.alias("x"), lists.alias("y")
    return x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.node") != F.col("y.node")) & may, "left_semi")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part -> by part, the shingles that come more than once and somewhere short, sorted."""
    current, held = None, []

    def summed(own: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        token, n, short = (np.concatenate([x[i] for x in own]) for i in range(3))
        order = np.argsort(token, kind="stable")
        first = np.flatnonzero(np.r_[True, token[order][1:] != token[order][:-1]])
        return token[order[first]], np.add.reduceat(n[order], first), np.maximum.reduceat(short[order], first)

    def out() -> Iterator[pa.RecordBatch]:
        if held:
            token, n, short = summed(held)
            keep = token[(n > 1) & (short > 0)]
            if len(keep):
                yield pa.record_batch([pa.array([current], pa.int32()), pa.array([keep.tobytes()], pa.binary())], names=["part", "shared"])

    for batch in batches:
        for part, t, o in zip(batch["part"].to_pylist(), batch["tokens"], batch["owners"], strict=True):
            if part != current:
                yield from out()
                current, held = part, []
            token, owner = np.frombuffer(t.as_buffer(), np.uint64), np.frombuffer(o.as_buffer(), np.uint32)
            held.append((token, np.ones(len(token), np.int64), (owner & 1).astype(np.uint8)))
            if sum(len(x) for x, *_ in held[1:]) > 200_000 + len(held[0][0]):
                held = [summed(held)]
    yield from out()


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part, its shared shingles (shared not null) first -> (token, cls, short, place) of those shingles."""
    current, shared = None, None
    for batch in batches:
        for part, cls, t, o, own in zip(batch["part"].to_pylist(), batch["cls"].to_pylist(), batch["tokens"], batch["owners"], batch["shared"], strict=True):
            if own.is_valid:
                current, shared = part, np.frombuffer(own.as_buffer(), np.uint64)
            elif part == current:
                token, owner = np.frombuffer(t.as_buffer(), np.uint64), np.frombuffer(o.as_buffer(), np.uint32)
                at = np.minimum(np.searchsorted(shared, token), len(shared) - 1)
                hit = shared[at] == token
                if hit.any():
                    owner = owner[hit].astype(np.int64)
                    yield pa.record_batch([pa.array(token[hit].view(np.int64)), pa.array(cls + (owner >> 5)), pa.array((owner & 1).astype(bool)), pa.array((owner >> 1 & 15).astype(np.int32))], names=["token", "cls", "short", "place"])


class Block:
    """Token sets, held so that one set is compared with all of them at once."""

    def __init__(self, sets: list[np.ndarray], num: int, den: int) -> None:
        self.sizes, self.num, self.den = np.array([len(x) for x in sets], np.int64), num, den
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        self.tokens, self.owner = flat[order], owner[order]

    def linked(self, tokens: np.ndarray) -> np.ndarray:
        """Which of the sets link with this one. The block stays closed where even the union of its sets shares too few tokens."""
        none = np.zeros(0, np.int64)
        low = np.searchsorted(self.tokens, tokens)
        many = np.searchsorted(self.tokens, tokens, "right") - low
        if np.count_nonzero(many) * self.den < self.num * len(tokens):
            return none
        at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        common = np.bincount(self.owner[at], minlength=len(self.sizes))
        return np.flatnonzero(common * self.den >= (len(tokens) + self.sizes - common) * self.num)


def own_groups(sets: list[np.ndarray], lead: int, num: int, den: int) -> np.ndarray:
    """The component of each set within a block, as the number of one of its sets.

    What the leader reaches is one component; each of the others is compared with all sets.
    """
    block, label = Block(sets, num, den), np.arange(len(sets))
    turns = [lead, *(i for i in range(len(sets)) if i != lead)]
    for i in turns:
        if i == lead or label[i] != label[lead]:
            met = np.unique(label[block.linked(sets[i])])
            if len(met) > 1:
                label[np.isin(label, met)] = met[0]
    return label


def _compared(k: int, num: int, den: int):
    """Rows (block, node, text, h, h2, role) sorted by block and role -> links (a, b): role 0 is a member, 1 a member that leads, 2 one that asks.

    Texts take less room on their way than their shingles. A block without asking rows is compared within itself. Only so many links are given as connect what links connect.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, nodes, sets, lead, block, links = None, [], [], 0, None, []

        def close() -> None:
            if block is None and len(sets) > 1:
                links.extend((nodes[i], nodes[j]) for i, j in enumerate(own_groups(sets, lead, num, den).tolist()) if i != j)

        def out() -> pa.RecordBatch:
            made = pa.record_batch([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["a", "b"])
            links.clear()
            return made

        for batch in batches:
            for key, node, role, h, h2, text in zip(*(batch[c].to_pylist() for c in ("block", "node", "role", "h", "h2")), batch["text"], strict=True):
                if key != current:
                    close()
                    current, nodes, sets, lead, block = key, [], [], 0, None
                own = shingle_set(text.as_py(), k)
                if set_digest(own) != (h, h2):  # another text of the same 64 bits
                    continue
                if role == 2:
                    if block is None and sets:
                        block = Block(sets, num, den)
                        met = np.arange(len(sets))  # members already connected by rows that asked before
                    if block is not None and len(hit := block.linked(own)):
                        fresh = np.unique(met[hit])
                        links.extend((node, nodes[j]) for j in fresh.tolist())
                        met[np.isin(met, fresh)] = fresh[0]
                elif not nodes or node != nodes[-1]:
                    lead = len(nodes) if role == 1 else lead
                    nodes.append(node), sets.append(own)
            if len(links) > 50_000:
                yield out()
        close()
        yield out()

    return run


@small_batches
def _grouped(docs: DataFrame, k: int, threshold: tuple[int, int], block_shingles: int) -> tuple[DataFrame, DataFrame]:
    """Rows (k1, k2, doc_id, n, h, h2) of docs, and classes (h, h2, rows, component, component_id) of those with shingles."""
    spark, (num, den) = docs.sparkSession, threshold
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").select(*row_key("doc_id", "text"), "doc_id", "text")
    survey = staged(own.mapInArrow(gives_back(_survey(k)), "k1 long, k2 long, doc_id long, n long, h long, h2 long, part int, cells binary"), "shingles")
    rows = staged(survey.where("h is not null").select("k1", "k2", "doc_id", "n", "h", "h2"), "rows")
    classes = rows.where("n > 0").groupBy("h", "h2").agg(F.min("doc_id").alias("smallest"), F.min("k1").alias("k1"), F.first("n").alias("n"), F.count("*").alias("rows"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")  # numbered once, when it is written

    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = min(max(int(total).bit_length() + 1, PART_BITS), CELL_BITS)
    parts = survey.where("part is not null").select("part", "cells").repartition("part").mapInArrow(gives_back(_counted(bits)), "part int, levels binary").toArrow()
    levels = np.zeros((1 << PART_BITS, 1 << (bits - PART_BITS)), np.uint8)
    for part, x in zip(parts["part"].to_pylist(), parts["levels"], strict=True):
        levels[part] = np.frombuffer(x.as_buffer(), np.uint8)
    drop_staged(survey)
    release(spark)
    sent = spark.sparkContext.broadcast(levels.ravel())

    part_bits = min(max(PART_BITS, (int(total) // PART_TOKENS).bit_length()), 24)
    prefixes = staged(own.select("text").mapInArrow(gives_back(_prefixes(k, num, den, part_bits, sent)), "cls long, h long, h2 long, n long, central long, sketch array<long>, part int, tokens binary, owners binary"), "prefixes")
    sent.unpersist()
    null = lambda kind: F.lit(None).cast(kind)
    blobs = prefixes.where("part is not null").select("part", "cls", "tokens", "owners", null("binary").alias("shared"))
    shared = staged(blobs.select("part", "tokens", "owners").repartition("part").sortWithinPartitions("part").mapInArrow(gives_back(_shared), "part int, shared binary"), "shared")
    release(spark)
    both = shared.select("part", null("long").alias("cls"), null("binary").alias("tokens"), null("binary").alias("owners"), "shared").unionByName(blobs)
    met = staged(both.repartition("part").sortWithinPartitions("part", F.col("shared").isNull()).mapInArrow(gives_back(_lists), "token long, cls long, short boolean, place int"), "met")
    # a class is met in several tasks under as many numbers
    named = staged(prefixes.where("h is not null").select("cls", "h", "h2", "n", "central", "sketch").join(classes.select("h", "h2", "node"), ["h", "h2"]), "named")
    drop_staged(prefixes, shared)
    release(spark)
    known = staged(met.join(named.select("cls", "node", "n", "central"), "cls").groupBy("token", "node").agg(F.first("n").alias("n"), F.max("short").alias("short"), F.min("place").alias("place"), F.first("central").alias("central")), "known")
    several = known.groupBy("token").agg(F.count("*").alias("many"), F.max("short").alias("any_short")).where("many > 1 AND any_short").select("token", "many")
    lists = staged(join_hot(known, staged(several, "several"), ["token"], "many"), "lists")
    # in short lists, classes stay that may link with another one, by their places in the list and then by their sketches; that is seen
    # within the join, no pair is kept
    every = lists
    near = staged(_paired(lists.where(F.col("many") <= SHORT_LIST).drop("many"), may_reach(num, den)), "near")
    sketches = named.join(near.select("node"), "node", "left_semi").groupBy("node").agg(F.first("sketch").alias("sketch"))
    likely = _paired(near.join(sketches, "node"), may_link("x", "y", num, den) & may_reach(num, den)).drop("sketch")
    lists = staged(likely.unionByName(lists.where(F.col("many") > SHORT_LIST).drop("many")).drop("place"), "lists")
    drop_staged(met, known, every, named, near)
    release(spark)

    # groups around leaders
    leads = lists.groupBy("token").agg(F.max(F.struct("central", "node")).alias("lead"), F.count("*").alias("many"))
    led = join_hot(lists.select("token", "node", "n"), staged(leads, "leads"), ["token"], "many")
    led = staged(led.groupBy("node").agg(F.first("n").alias("n"), F.max("lead").alias("lead")).select("node", "n", F.col("lead.node").alias("leader")), "led")

    def dealt(members: DataFrame, by: list[str]) -> DataFrame:
        """Adds block: members by their group, groups of many shingles in several blocks."""
        wide = members.groupBy(*by).agg(F.ceil(F.sum("n") / block_shingles).alias("salts")).where("salts > 1")
        both = members.join(wide, by, "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
        return both.withColumn("block", F.xxhash64(*by, F.pmod(F.xxhash64("node", F.lit(5)), "salts")))

    first = staged(dealt(led, ["leader"]), "first")
    heads = first.select("leader", "block").distinct()
    members = first.select("block", "node", F.when(F.col("node") == F.col("leader"), 1).otherwise(0).alias("role")).unionByName(heads.select("block", F.col("leader").alias("node"), F.lit(1).alias("role")))
    alone = first.groupBy("block").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.min("leader").alias("leader")).where("lo = hi AND lo = leader").select("block")
    members = members.join(alone, "block", "left_anti")

    needed = classes.join(led.select("node"), "node", "left_semi").select("k1", "h", "h2", "node")
    needed = staged(needed, "needed")
    texts = own.where(maybe_in(needed.select(F.col("k1").alias("key")), F.col("k1"))).select("k1", "text").join(needed, "k1")
    texts = staged(texts.select("node", "h", "h2", "text"), "texts")
    release(spark)

    def compared(asked: DataFrame) -> DataFrame:
        """Links of rows (block, node, role), each block in one task."""
        own = asked.join(texts, "node").repartition("block").sortWithinPartitions("block", F.col("role") == 2, "node", F.desc("role"))
        return own.select("block", "node", "role", "h", "h2", "text").mapInArrow(gives_back(_compared(k, num, den)), "a long, b long")

    links = staged(compared(members), "links")
    groups = staged(components(links), "groups")
    release(spark)

    # what is left: classes and the other blocks that they share shingles with
    known = led.join(groups, "node", "left").join(first.select("node", F.col("block").alias("was")), "node")
    known = known.withColumn("single", F.col("component").isNull()).withColumn("component", F.coalesce("component", "node")).withColumn("group", F.when(F.col("single"), F.col("leader")).otherwise(F.col("component")))
    known = staged(dealt(known, ["single", "group"]).select("node", "n", "component", "was", "block"), "known")
    placed = staged(lists.select("token", "node", "short").join(known, "node"), "placed")
    mixed = placed.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("was").alias("w1"), F.max("was").alias("w2"), F.count("*").alias("many")).where("lo < hi AND w1 < w2").select("token", "many")
    every, placed = placed, staged(join_hot(placed, staged(mixed, "mixed"), ["token"], "many").drop("many"), "placed")
    drop_staged(every)
    release(spark)
    far = None
    if not placed.isEmpty():
        small = F.when(F.col("short"), F.col("n"))
        matrix = placed.groupBy("token", F.col("block").alias("other")).agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min(small).alias("least_short"), F.min("component").alias("c1"), F.max("component").alias("c2"), F.min("was").alias("w1"), F.max("was").alias("w2"))
        # a class meets a block in a list if the smaller side is there with a short prefix; of two blocks, one asks the other
        meet = (F.col("short") & (F.col("n") <= F.col("most"))) | (F.col("least_short") <= F.col("n"))
        sized = (F.col("least") * num <= F.col("n") * den) & (F.col("n") * num <= F.col("most") * den)
        new = ~((F.col("c1") == F.col("c2")) & (F.col("c1") == F.col("component"))) & ~((F.col("w1") == F.col("w2")) & (F.col("w1") == F.col("was")))
        met = placed.join(matrix, "token").where((F.col("block") <= F.col("other")) & meet & sized & new).select("node", F.col("other").alias("block")).distinct()
        met = staged(met, "met")
        copies = met.groupBy("block").agg(F.ceil(F.count("*") / ASKING).alias("copies"))
        part = lambda turn: F.xxhash64("block", turn)
        asking = met.join(copies, "block").select(part(F.pmod(F.xxhash64("node", F.lit(6)), "copies")).alias("block"), "node", F.lit(2).alias("role"))
        held = known.select("node", "block").join(copies, "block").withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
        held = held.select(part(F.col("turn")).alias("block"), "node", F.lit(0).alias("role"))
        more = staged(compared(held.unionByName(asking)), "links")
        if not more.isEmpty():
            at = known.select("node", "component")
            more = more.join(at.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a").join(at.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b")
            far = staged(components(more.select("ca", "cb"), "ca", "cb"), "groups")
        drop_staged(met)
    final = classes.select("h", "h2", "rows", "smallest", "node").join(groups, "node", "left").select("h", "h2", "rows", "smallest", F.coalesce("component", "node").alias("component"))
    if far is not None:
        final = final.join(far.select(F.col("node").alias("component"), F.col("component").alias("whole")), "component", "left").withColumn("component", F.coalesce("whole", "component"))
    final = staged(final, "components")
    smallest = staged(final.groupBy("component").agg(F.min("smallest").alias("component_id"), F.count("*").alias("many")), "smallest")
    final = staged(join_hot(final.select("h", "h2", "rows", "component"), smallest, ["component"], "many").select("h", "h2", "rows", "component", "component_id"), "final")
    drop_staged(classes, lists, led, first, needed, texts, links, groups, known, placed, far)
    return rows, final


def jaccard_groups(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (4, 5), block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_shingles, component_id, one row for each row.

    Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased; a set holds the distinct shingles of k words, or the whole sequence if it has
    fewer. Two rows link when den * intersection >= num * union of their sets, threshold being (num, den). component_id is the
    smallest doc_id reachable by links, itself included. Null, empty and blank texts have no shingle, link with nothing and are
    their own component. A null doc_id counts as larger than any; a component of null ids alone has a null id. Rows with equal sets are one
    class and are never paired; unlike texts under one doc_id are not linked by it. Other columns aren't read. Shingles are compared by
    64-bit hashes and classes by 128-bit ones. block_shingles bounds what one task holds; the result doesn't depend on it.
    """
    rows, final = _grouped(docs, k, threshold, block_shingles)
    out = join_hot(rows.where("n > 0"), final, ["h", "h2"], "rows").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    return out.unionByName(rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, k: int = 5, threshold: tuple[int, int] = (4, 5), block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of docs, with all their columns, less near-duplicates: one row of each component of jaccard_groups stays.

    It is the one with the smallest doc_id (null ids last; of unlike texts under one doc_id, the first by hash); of rows that repeat it
    one stays. Rows without shingles all stay. Rows are told apart by doc_id and text, never by doc_id alone.
    """
    rows, final = _grouped(docs, k, threshold, block_shingles)
    own = join_hot(rows.where("n > 0"), final.select("h", "h2", "rows", "component"), ["h", "h2"], "rows")
    own = staged(own.groupBy("component", "k1", "k2").agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("times")), "rows")
    lead = own.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")).alias("lead"), F.count("*").alias("many"))
    told = join_hot(own, staged(lead, "leads"), ["component"], "many")
    stays = (F.col("k1") == F.col("lead.k1")) & (F.col("k2") == F.col("lead.k2"))
    one, two, stay = (free_name(docs, x) for x in ("k1", "k2", "stays"))
    told = told.select(F.col("k1").alias(one), F.col("k2").alias(two), stays.alias(stay), "times").where(~F.col(stay) | (F.col("times") > 1)).drop("times")
    told = staged(told, "told")
    drop_staged(own)
    key = docs.select("*", F.col("doc_id").cast("long").alias(free_name(docs, "id")))
    key = key.select(*docs.columns, *(x.alias(n) for x, n in zip(row_key(free_name(docs, "id"), "text"), (one, two), strict=True)))
    maybe = maybe_in(told.select(F.col(one).alias("key")), F.col(one))
    met = key.where(maybe).join(told, [one, two], "left")
    again = met.where(F.col(stay)).dropDuplicates([one, two])
    return key.where(~maybe).select(*docs.columns).unionByName(met.where(F.col(stay).isNull()).select(*docs.columns)).unionByName(again.select(*docs.columns))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(read_table(spark, sf_dir, "documents"), k=4, threshold=(85, 100))
