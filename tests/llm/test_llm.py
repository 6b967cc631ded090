"""Each training-data operator against a brute-force version on a small fixture with nulls, ties, repetitions and long texts."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from refectory.llm import common, embedding_dedup, exact_dedup, jaccard, line_dedup, lm, mixing, packing, suffix_dedup, tokens, toxicity


def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def bag(items):
    return collections.Counter(items)


def test_line_dedup(documents, nothing):
    rows = pairs(documents)
    seen = collections.Counter()
    key = lambda x: "".join(c.lower() if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    for _, t in rows:
        seen.update({key(x) for x in (t or "").split("\n")} - {""})
    want = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) == "" or seen[key(x)] < 10]
        want.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    got = [(r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in line_dedup.line_dedup(documents).collect()]
    assert bag(got) == bag(want)
    assert line_dedup.line_dedup(nothing).count() == 0
    # columns that are kept may have the names of what is used inside
    odd = documents.select("doc_id", "text", F.col("source").alias("gone"), F.col("n_chars").alias("k1"), F.col("lang").alias("lines n"))
    kept = line_dedup.line_dedup(odd, keep=["gone", "k1", "lines n"])
    assert kept.columns == ["doc_id", "gone", "k1", "lines n", "kept_text", "n_lines", "n_dropped"]
    assert bag((r.doc_id, r.kept_text, r.n_lines, r.n_dropped) for r in kept.collect()) == bag(want)
    assert bag((r.doc_id, r.gone, r.k1) for r in kept.collect()) == bag((r.doc_id, r.source, r.n_chars) for r in documents.collect())
    with pytest.raises(ValueError):
        line_dedup.line_dedup(odd.withColumnRenamed("k1", "n_lines"), keep=["n_lines"])


def test_very_common_lines(spark):
    rows = [(i, f"own {i}\nthe common line\nrare {i // 3}\n the COMMON line") for i in range(700)]
    got = {r.doc_id: (r.kept_text, r.n_lines, r.n_dropped) for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {i: (f"own {i}\nrare {i // 3}", 4, 2) for i in range(700)}


def test_exact_dedup(spark, documents, nothing, tmp_path, monkeypatch):
    at = str(tmp_path / "docs")
    documents.repartition(3).write.parquet(at)
    norm = lambda t: "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t or "")
    squeeze = lambda t: __import__("re").sub(" +", " ", norm(t))
    rows = [(d, squeeze(t)) for d, t in pairs(documents)]
    groups = collections.defaultdict(list)
    for d, t in rows:
        groups[t].append(d)
    want = bag((d, min((x for x in groups[t] if x is not None), default=None), len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for d, t in rows)
    for digest in (exact_dedup.sha256, lambda c: F.pmod(F.crc32(c.cast("binary")), F.lit(3)).cast("string")):  # the second one makes unlike texts collide
        got = exact_dedup.exact_dedup(spark, at, digest).collect()
        assert bag((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
    monkeypatch.setattr(exact_dedup, "COPIES", 2)  # each digest is dealt over several keys
    copies = spark.createDataFrame([(i, "a  copy" if i % 3 else f"own {i % 7}") for i in range(900)], "doc_id long, text string")
    copies.write.parquet(at + "c")
    out = exact_dedup.exact_dedup(spark, at + "c").collect()
    assert {(r.keep_id, r.group_size) for r in out if r.doc_id % 3} == {(1, 600)} and sum(r.kept for r in out) == 8
    nothing.write.parquet(at + "0")
    assert exact_dedup.exact_dedup(spark, at + "0").count() == 0


def brute_groups(rows, k, num, den):
    sets = []
    for _, t in rows:
        w = common.words_of(t)
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and den * both >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = collections.defaultdict(list)
    for i, (d, _) in enumerate(rows):
        low[find(i)].append(d)
    return [(d, len(sets[i]), min((x for x in low[find(i)] if x is not None), default=None)) for i, (d, _) in enumerate(rows)]


def test_jaccard_groups(spark, documents, nothing):
    got = [tuple(r) for r in jaccard.jaccard_groups(documents, 4, (85, 100)).collect()]
    assert bag(got) == bag(brute_groups(pairs(documents), 4, 85, 100))
    assert jaccard.jaccard_groups(nothing).count() == 0


@pytest.mark.parametrize(("shingles", "short"), [(400, 4), (1_000_000, 64)])
def test_jaccard_groups_of_many_near_copies(spark, monkeypatch, shingles, short):
    """Groups of near copies that drift apart, in one block and in many, whose links don't all go through a leader; repeated ids."""
    monkeypatch.setattr(jaccard, "ASKING", 7)
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    rng = random.Random(3)
    rows = []
    for g in range(4):
        base = [f"w{g}_{i}" for i in range(60)] + [f"common{i}" for i in range(30)]
        for c in range(40):
            own = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5]) + 2 * (g == 3)):
                own[rng.randrange(len(own))] = f"edit{rng.randrange(10**9)}"
            rows.append((len(rows), " ".join(own)))
    chain = [f"c{i}" for i in range(120)]
    for i in range(30):  # each links with the next ones only
        rows.append((len(rows), " ".join(chain[3 * i : 3 * i + 40])))
    rows += [(5, "an id that has two texts"), (None, rows[7][1] + " more"), (None, None)]
    got = [tuple(r) for r in jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, (4, 5), shingles).collect()]
    assert bag(got) == bag(brute_groups(rows, 3, 4, 5))


def test_sketches_never_lose_a_link(spark):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(300):
        base = rng.integers(0, 1 << 62, rng.integers(1, 900)).astype(np.uint64)
        other = np.r_[base[rng.random(len(base)) < rng.choice([0.5, 0.8, 0.9, 1.0])], rng.integers(0, 1 << 62, rng.integers(0, 60)).astype(np.uint64)]
        a, b = np.unique(base), np.unique(other)
        if len(b):
            common_ = len(np.intersect1d(a, b))
            rows.append((len(a), jaccard.sketch(a).tolist(), len(b), jaccard.sketch(b).tolist(), 5 * common_ >= 4 * (len(a) + len(b) - common_), common_ / (len(a) + len(b) - common_)))
    df = spark.createDataFrame(rows, "an long, asketch array<long>, bn long, bsketch array<long>, links boolean, j double")
    df = df.select(F.struct(F.col("an").alias("n"), F.col("asketch").alias("sketch")).alias("x"), F.struct(F.col("bn").alias("n"), F.col("bsketch").alias("sketch")).alias("y"), "links", "j")
    got = df.select("links", "j", jaccard.may_link("x", "y", 4, 5).alias("may")).collect()
    assert all(r.may for r in got if r.links) and sum(r.links for r in got) > 50
    assert sum(not r.may for r in got if r.j < 0.6) > 0.8 * sum(r.j < 0.6 for r in got)


def test_token_counts_and_packing(spark, documents, nothing):
    t = Tokenizer.from_file(tokens.word_tokenizer())
    ids = lambda x: t.encode(x or "", add_special_tokens=False).ids
    rows = pairs(documents)
    got = [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(documents).collect()]
    assert bag(got) == bag((d, len((x or "").encode()), len(ids(x)), len(ids(x)) > 2048) for d, x in rows)
    assert tokens.token_counts(nothing).count() == 0
    placed = packing.pack(packing.token_pieces(documents, 512), 512).collect()
    want = bag((d, i, i * 512, np.asarray((ids(x) + [1])[i * 512 : i * 512 + 512], "<u4").tobytes()) for d, x in rows for i in range(-(-(len(ids(x)) + 1) // 512)))
    assert bag((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in placed) == want
    sequences = collections.defaultdict(list)
    for r in placed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 512
    assert packing.pack(packing.token_pieces(nothing)).count() == 0
    odd = packing.pack(packing.token_pieces(documents, 512), 512, carry=[F.crc32("ids").alias("slice"), F.length("ids").alias("rank"), F.lit(1).alias("base")], slice_rows=3)
    assert odd.columns == ["doc_id", "piece", "start", "length", "slice", "rank", "base", "sequence_id", "offset"] and odd.count() == len(placed)


@pytest.mark.parametrize("seed", range(6))
def test_packing_plan(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([rng.randint(1, 100), rng.randint(30, 70), 100]) for _ in range(400)]
    runs = packing.packing_plan(dict(collections.Counter(sizes)), 100)
    fill, ranks = collections.Counter(), collections.defaultdict(list)
    for size, rank, n, first, per, offset in runs:
        ranks[size] += range(rank, rank + n)
        for i in range(n):
            assert offset + (i % per) * size + size <= 100
            fill[first + i // per] += size
    assert all(sorted(v) == list(range(sizes.count(s))) for s, v in ranks.items()) and max(fill.values()) <= 100
    assert len(fill) <= 1.12 * math.ceil(sum(sizes) / 100) + 1 + sum(s > 50 for s in sizes) * 0.5


def test_mixing(spark, documents, nothing, monkeypatch):
    out = mixing.mix(documents, block=16).collect()
    assert bag((r.doc_id, r.size) for r in out) == bag((d, len(common.words_of(x))) for d, x in pairs(documents))
    by = collections.defaultdict(list)
    for r in out:
        by[r.source].append(r)
    total = sum(r.size for r in out)
    for rows in by.values():
        r = rows[0]
        assert r.source_size == sum(x.size for x in rows) and 0 <= r.target <= 2 * r.source_size
        assert sum(x.taken for x in rows) == math.floor(r.target + 0.5) and all(0 <= x.taken <= 2 * x.size for x in rows)
    assert abs(sum(rows[0].target for rows in by.values()) - 1.5 * total) < 1e-6 * total
    assert bag(map(tuple, out)) == bag(map(tuple, mixing.mix(documents.repartition(5), block=16).collect()))
    assert mixing.mix(nothing).count() == 0
    monkeypatch.setattr(mixing, "PART_ROWS", 0.01)  # parts of several digits
    assert bag(map(tuple, out)) == bag(map(tuple, mixing.mix(documents, block=16).collect()))


def test_suffix_dedup(documents, nothing):
    rows = sorted(set(pairs(documents)), key=lambda r: (r[0] is None, r[0] or 0))
    got = {}
    for r in suffix_dedup.suffix_dedup(documents).collect():
        got.setdefault((r.doc_id, r.n_bytes), set()).add((r.n_removed, len(r.spans), bytes(r.kept)))
    seen = set()
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(b[i : i + 100])
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        assert (sum(gone), spans, bytes(c for c, m in zip(b, gone, strict=True) if not m)) in got[d, len(b)]
    assert suffix_dedup.suffix_dedup(nothing).count() == 0


def brute_removed(rows):
    """The bytes that suffix_dedup is to keep, by distinct (doc_id, text)."""
    seen, kept = set(), {}
    for d, t in sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0)):
        b, gone = t.encode(), bytearray(len(t.encode()))
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(b[i : i + 100])
        kept[d, t] = bytes(c for c, m in zip(b, gone, strict=True) if not m)
    return kept


@pytest.mark.parametrize("parts", [1, 3])
def test_suffix_dedup_of_repeated_rows(spark, parts):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(5, text)] * 3 + [(6, text), (6, text), (7, "x" + text[:300] + "y"), (None, text[::-1]), (None, text[::-1]), (9, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    want = brute_removed(rows)
    assert want[5, text] == text.encode() and want[6, text] == b""
    got = [(r.doc_id, r.n_bytes, bytes(r.kept)) for r in suffix_dedup.suffix_dedup(df).collect()]
    assert bag(got) == bag((d, len(t), want[d, t]) for d, t in rows)


def test_suffix_dedup_of_crowded_minimizers(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    some = " ".join(word() for _ in range(30))
    rows = [(i, " ".join(word() for _ in range(20)) + " " + some[: rng.choice([32, 90, 104, 140, 200])] + " " + " ".join(word() for _ in range(20))) for i in range(60)]
    rows += [(None, some), (100, rows[3][1] + rows[4][1]), (101, rows[5][1]), (102, "é" * 300)]
    want = brute_removed(rows)
    widest = []
    spans_of = suffix_dedup.crowded_spans
    monkeypatch.setattr(suffix_dedup, "crowded_spans", lambda rows, *a: (widest.append(rows.groupBy("h").count().agg(F.max("count")).first()[0]), spans_of(rows, *a))[1])
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.n_bytes, bytes(r.kept)) for r in suffix_dedup.suffix_dedup(df, hot_rows=5).collect()]
    assert bag(got) == bag((d, len(t.encode()), want[d, t]) for d, t in rows)
    assert max(widest) > 5


@pytest.mark.parametrize("chunk", [100, 150, 400])
def test_suffix_dedup_of_texts_in_pieces(monkeypatch, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rng = np.random.default_rng(chunk)
    every = collections.namedtuple("Bits", "value")(np.full(suffix_dedup.FILTER_BITS // 64, -1))
    for _ in range(25):
        word = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
        text = word(2500)
        other = word(700) + text[500 : 866 + rng.integers(900)] + word(600) + text[rng.integers(600) : 1500]
        rows = [(1, text[500:866]), (2, text), (3, other), (4, "ab" * 900), (5, text[1000:1250] + "ab" * 70)]
        batch = suffix_dedup.pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in rows], "k1": [d for d, _ in rows], "k2": [-d for d, _ in rows], "text": [t for _, t in rows]})
        table = suffix_dedup.pa.Table.from_batches(suffix_dedup._contexts(100, every, None)(iter([batch])))
        within = table.filter(suffix_dedup.pa.compute.is_null(table["h"]))
        table = table.filter(suffix_dedup.pa.compute.is_valid(table["h"]))
        spans = list(zip(*(x.tolist() for x in suffix_dedup.repeated_spans(table, 100)), strict=True))
        spans += list(zip(*(within[c].to_pylist() for c in ("k1", "k2", "start", "stop")), strict=True))
        want = brute_removed(rows)
        for d, t in rows:
            gone = {i for k1, k2, a, b in spans if (k1, k2) == (d, -d) for i in range(a, b)}
            assert bytes(c for i, c in enumerate(t.encode()) if i not in gone) == want[d, t]


@pytest.mark.parametrize("seed", range(4))
def test_multikey_quicksort(seed):
    rng = np.random.default_rng(seed)
    words = rng.integers(0, [2, 3, 1000, 1 << 60][seed], (700, 3)).astype(np.uint64)
    group = rng.integers(0, 9, 700)
    order, tie = suffix_dedup.multikey_quicksort(words, group)
    rows = [(group[i], *words[i].tolist()) for i in order]
    assert rows == sorted(rows) and sorted(order) == list(range(700))
    assert [x == y for x, y in zip(tie[1:], tie[:-1], strict=True)] == [x == y for x, y in zip(rows[1:], rows[:-1], strict=True)]


@pytest.mark.parametrize("seed", range(3))
def test_deep_shallow_order(seed):
    rng = np.random.default_rng(seed)
    m = rng.integers(0, 2, (300, 100)).astype(np.uint8)
    m[100:200] = m[rng.integers(0, 20, 100)]
    m[150:200, 60] ^= 1
    group = rng.integers(0, 4, 300)
    order, common_ = suffix_dedup.deep_shallow(m, group)
    want = sorted(range(300), key=lambda i: (group[i], m[i].tobytes()))
    assert [(group[i], m[i].tobytes()) for i in order] == [(group[i], m[i].tobytes()) for i in want]
    for i in range(1, 300):
        a, b = order[i - 1], order[i]
        assert common_[i] == (-1 if group[a] != group[b] else next((j for j in range(100) if m[a, j] != m[b, j]), 100))


def links_and_labels(v, threshold=0.95):
    near = v @ v.T >= threshold
    label = np.arange(len(v))
    while (new := np.array([label[n].min() for n in near])).tolist() != label.tolist():
        label = new
    return near.sum(1) - 1, label


@pytest.mark.parametrize("options", [{"shard_rows": 100, "most_rows": 150}, {"shard_rows": 10, "sample": 400, "overlap": 2}])
def test_embedding_groups(spark, options):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 16))
    vecs = [base[rng.integers(40)] + rng.normal(size=16) * rng.choice([0.02, 0.15, 1.0]) for _ in range(900)]
    vecs += [vecs[3], vecs[3], vecs[4] * 2]
    rows = [(i, [float(np.float32(x)) for x in v], 1, "z") for i, v in enumerate(vecs)]
    odd = [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] + [1.0] * 15), (2003, [1.0, 2.0]), (2004, [None] + [1.0] * 15), (2005, []), (2006, [float("inf")] * 16), (None, rows[0][1])]
    df = spark.createDataFrame(rows + [(i, v, 0, "z") for i, v in odd], "vec_id long, embedding array<float>, node int, q string")
    got = {r.vec_id: r for r in embedding_dedup.embedding_groups(df, 0.95, **options).collect()}
    x = np.array([r[1] for r in rows])
    links, label = links_and_labels(x / np.linalg.norm(x, axis=1, keepdims=True))
    assert sum(got[i].n_links for i in range(len(x))) >= 0.98 * links.sum() and all(got[i].n_links <= links[i] for i in range(len(x)))
    assert sum(got[i].component_id == label[i] for i in range(len(x))) >= 0.98 * len(x)
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in odd)
    assert embedding_dedup.embedding_groups(df.limit(0)).count() == 0


def test_unlike_vectors_of_one_id(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (3, [0.02, 1.0]), (4, [-1.0, 0.0])]
    got = embedding_dedup.embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 0.95).collect()
    assert bag((r.vec_id, r.n_links, r.component_id) for r in got) == bag([(1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 1, 1), (3, 2, 1), (4, 0, 4)])


def unit_vectors(spark, v):
    return spark.createDataFrame([(i, x.tolist(), 1) for i, x in enumerate(v)], "node long, vec array<double>, copies long")


def test_near_links_across_parts_of_a_shard(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(200, 24))
    v = np.concatenate([base, base + 0.05 * rng.normal(size=base.shape)])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links, label = links_and_labels(v)
    assert links.sum() >= 380
    counts, edges, _ = embedding_dedup.near_links(unit_vectors(spark, v), 0.95, shard_rows=400, most_rows=100, steps=2, least_recall=0.0, contract=0.0)
    assert {r.q: r.n for r in counts.collect()} == {i: n for i, n in enumerate(links.tolist()) if n}
    got = {r.node: r.component for r in common.components(edges).collect()}
    assert all(got.get(i, i) == c for i, c in enumerate(label.tolist()))


def test_near_links_across_shards(spark):
    """With one shard for each vector, most links are met only by going on into other shards."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(30, 8))
    v = np.concatenate([base + 0.08 * rng.normal(size=base.shape) for _ in range(20)])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links, label = links_and_labels(v)
    counts, edges, recall = embedding_dedup.near_links(unit_vectors(spark, v), 0.95, overlap=1, shard_rows=12)
    got = {r.q: r.n for r in counts.collect()}
    assert recall >= 0.9 and all(n <= links[q] for q, n in got.items()) and sum(got.values()) >= 0.95 * links.sum()


def test_audit_sees_isolated_pairs(spark, monkeypatch):
    rng = np.random.default_rng(4)
    hot = rng.normal(size=24) + 0.02 * rng.normal(size=(300, 24))
    base = rng.normal(size=(60, 24))
    alone = rng.normal(size=(300, 24))
    v = np.concatenate([hot, base, base + 0.02 * rng.normal(size=base.shape), alone])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    df = unit_vectors(spark, v)
    # rare links: one block of 20 queries has too few
    true, n = embedding_dedup.audit_counts(df, 0.95, 20, linked=60, blocks=30)
    near = (v @ v.T >= 0.95).sum(1) - 1
    got = {r.q: r.n for r in true.collect()}
    assert n == len(got) >= 60 and all(near[q] == c for q, c in got.items())
    # a search that meets the large group only: by pairs 0.998 of all, by queries less
    def only_hot(index, adjacent, query, *_):
        out = query @ index.T >= 0.95
        out[out.sum(1) < 50] = False
        return out

    monkeypatch.setattr(embedding_dedup, "range_search", only_hot)
    with pytest.raises(RuntimeError, match="recall"):
        embedding_dedup.near_links(df, 0.95)


def grams_of(text, depth=lm.DEPTH):
    """The byte strings of a text, the oldest byte first."""
    raw = b"\0" * depth + b" ".join(common.words_of(text)) + lm.END
    return [int.from_bytes(raw[i : i + depth + 1], "big") for i in range(len(raw) - depth)]


@pytest.mark.parametrize("size", [7, 100, 10_000])
def test_byte_grams(monkeypatch, size):
    monkeypatch.setattr(lm, "CHUNK", size)
    texts = ["", "Ab c", "x" * 50, None, "word " * 60]
    got = [x for gram, doc in lm.byte_grams([common.words_of(t) for t in texts]) for x in zip(doc.tolist(), gram.tolist(), strict=True)]
    latest_first = lambda x: int.from_bytes(x.to_bytes(6, "big")[-2::-1] + x.to_bytes(6, "big")[-1:], "big")
    assert got == [(i, latest_first(x)) for i, t in enumerate(texts) for x in grams_of(t)]


def test_gram_table():
    rng = np.random.default_rng(2)
    gram = np.unique(rng.integers(0, 1 << 48, 5000))
    value = rng.normal(size=len(gram))
    hit, got = lm.GramTable(gram, value).get(np.r_[gram[::-1], gram + 1])
    assert hit[: len(gram)].all() and (got[: len(gram)] == value[::-1]).all()
    assert (hit[len(gram) :] == np.isin(gram + 1, gram)).all()


@pytest.mark.parametrize("sent", [None, (3, 40)])
def test_lm_scores(spark, documents, nothing, monkeypatch, sent):
    if sent:  # most words and byte strings are looked up in shuffles
        monkeypatch.setattr(lm, "SENT_WORDS", sent[0])
        monkeypatch.setattr(lm, "SENT_GRAMS", sent[1])
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    rows = pairs(documents)
    counts = collections.Counter()
    for d, t in rows:
        if not held(d):
            counts.update([*common.words_of(t), lm.END])
    n, v = sum(counts.values()), len(counts)
    want = bag((d, held(d), len(w) + 1, sum(counts[x] > 0 for x in [*w, lm.END]), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in [*w, lm.END]), 6)) for d, w in ((d, common.words_of(t)) for d, t in rows))
    out = lm.lm_scores(documents, common.crc_fold("doc_id", 7) == 2).collect()
    assert bag((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    # the model against a direct evaluation of the trees
    grams = collections.Counter()
    for d, t in rows:
        for x in grams_of(t):
            grams[x] += not held(d)
    for r in random.Random(1).sample([r for r in out if r.n_tokens < 200], 12):
        t = next(t for d, t in rows if d == r.doc_id and len(common.words_of(t)) + 1 == r.n_tokens)
        direct = sum(direct_log10(grams, x) for x in grams_of(t))
        assert abs(direct - r.score) < 1e-6 * abs(direct) + 1e-6
        assert abs(r.bits_per_byte + direct / math.log10(2) / len(grams_of(t))) < 1e-6
    assert lm.lm_scores(nothing, F.lit(False)).count() == 0


_TREES: dict = {}


def direct_log10(grams, gram, depth=lm.DEPTH):
    """The mixture's prediction for a byte string, from the recursive definition."""
    if id(grams) not in _TREES:
        nodes = collections.defaultdict(lambda: [0, 0])
        children = collections.defaultdict(set)
        for g, n in grams.items():
            for j in range(8):
                bit, part = g >> (7 - j) & 1, (1 << j) | ((g & 255) >> (8 - j))
                for d in range(depth + 1):
                    c = (g >> 8) & ((1 << 8 * d) - 1)
                    nodes[d, c, part][bit] += n
                    if d < depth:
                        children[d, c, part].add((d + 1, (g >> 8) & ((1 << 8 * (d + 1)) - 1), part))
        memo: dict = {}

        def mixed(k):
            if k not in memo:
                own = kt(*nodes[k])
                memo[k] = own if k[0] == depth else math.log(0.5) + np.logaddexp(own, sum(mixed(x) for x in children[k]))
            return memo[k]

        _TREES[id(grams)] = (nodes, mixed)
    nodes, mixed = _TREES[id(grams)]
    out = 0.0
    for j in range(8):
        bit, part = gram >> (7 - j) & 1, (1 << j) | ((gram & 255) >> (8 - j))
        p, rest = 0.0, 1.0
        for d in range(depth + 1):
            k = (d, (gram >> 8) & ((1 << 8 * d) - 1), part)
            stop = 1.0 if d == depth else math.exp(math.log(0.5) + kt(*nodes[k]) - mixed(k))
            p += rest * stop * (nodes[k][bit] + 0.5) / (sum(nodes[k]) + 1)
            rest *= 1 - stop
        out += math.log10(p)
    return out


def kt(a, b):
    return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)


@pytest.mark.parametrize("seed", range(20))
def test_maximal_segments(seed):
    rng = random.Random(seed)
    scores = [rng.choice([-1.0, 2.0, 5.0, -0.5]) if rng.random() < 0.5 else -0.5 for _ in range(40)]
    at = [i for i, s in enumerate(scores) if s > 0]
    flat = [s if s > 0 else -0.5 for s in scores]

    def maximal(a, b):  # the recursive definition: the best segment, then left and right of it
        best = max(((sum(flat[i:j]), -(j - i), i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        return [*maximal(a, best[2]), (best[2], best[3], best[0]), *maximal(best[3], b)]

    got = toxicity.maximal_segments(at, [flat[i] for i in at], -0.5)
    assert sorted(round(s, 6) for *_, s in got) == sorted(round(s, 6) for *_, s in maximal(0, 40))


def test_logistic_step_settles_on_texts_told_apart():
    """Whole Newton steps swing between two points here, and which one is last decides about every text."""
    r = np.random.default_rng(5)
    best = np.concatenate([np.full(17_000, -5.0), r.uniform(-5, 2, 580), np.exp(r.uniform(np.log(2.3), np.log(260), 1900))])
    x = np.stack([np.ones_like(best), best, np.log1p(np.maximum(best, 0))], 1)
    y = (best > 2.2).astype(float)
    w = np.array(toxicity._logistic(x, y))
    p = 1 / (1 + np.exp(-np.clip(x @ w, -700, 700)))
    assert np.abs(x.T @ (y - p) - 1e-3 * w).max() < 1e-4  # where the slope is nought
    assert ((p >= 0.3) == (y > 0)).all()


def test_toxicity(spark, documents, nothing):
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choice(["vile", "nasty", "rotten"]) if i % 5 == 0 and rng.random() < 0.15 else f"plain{rng.randrange(300)}" for _ in range(80))) for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, ~toxicity.held_out())
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    test = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((got[i].score >= 0.3) == (i % 5 == 0) for i in test) >= 0.97 * len(test)
    assert all(got[i].segments for i in test if got[i].score > 0.9)
    out = toxicity.score(documents, model).collect()
    assert len(out) == documents.count() and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.fit(docs, labels.limit(0), ~toxicity.held_out()).lexicon == {}


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(500), rng.randrange(500)) for _ in range(300)] + [(0, i) for i in range(600, 900)] + [(5, 5), (None, 3)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
