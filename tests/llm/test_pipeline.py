"""The corpus pipeline: each stage, and all of them, against brute force on texts with nulls, repeated ids and rows, and empty ones."""

import collections
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from refectory.llm import common, toxicity

from .test_llm import bag, brute_groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents and labels: every fourth document is toxic."""
    rng = random.Random(5)
    rows = []
    for i in range(160):
        words = [rng.choice(["vile", "nasty", "rotten"]) if i % 4 == 0 and rng.random() < 0.2 else f"plain{rng.randrange(200)}" for _ in range(60)]
        rows.append((i, " ".join(words)))
    rows += [(200 + i, f"own {i} line of its own\n  A Shared Line\nlast {i} of this text here") for i in range(12)]
    base = [f"word{i}" for i in range(80)]
    rows += [(300, " ".join(base)), (301, " ".join([*base[:40], "other", *base[41:]])), (302, " ".join(base).upper()), (303, " ".join(base[:30]))]
    # one id with two texts, of which one is a near copy; repeated rows; nulls and blanks
    rows += [(300, "an unlike text that has the same id as another one"), (301, "a second unlike text of an id that is there"), (400, " ".join(base[::-1])), (400, " ".join(base[::-1])), (None, " ".join([*base[:50], "x"])), (None, " ".join(base[::-1]))]
    rows += [(500, None), (501, ""), (502, " \n\t"), (None, None), (503, "ten long words " * 2500)]
    at = str(tmp_path_factory.mktemp("tables"))
    docs = [(d, t, "en", None if d is None else f"s{d % 3}", len(t or "")) for d, t in rows]
    spark.createDataFrame(docs, SCHEMA).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def whole(df):
    return [tuple(r) for r in df.select(*corpus_pipeline.COLUMNS).collect()]


@pytest.fixture(scope="module")
def stages(spark, tables):
    """The result of each stage on what the stage before it kept; each stage also gets a column of a clashing name."""
    docs, out = common.read_table(spark, tables, "documents"), [whole(common.read_table(spark, tables, "documents"))]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.staged(stage(spark, docs.selectExpr("*", "doc_id AS k1", "'x' AS gone"), tables), name)
        out.append(whole(docs) if name != "best_fit_packing" else docs.collect())
    return out


def test_toxicity_stage(spark, tables, stages):
    before, after = stages[0], stages[1]
    model = toxicity.fit(common.read_table(spark, tables, "documents"), common.read_table(spark, tables, "labels"), ~toxicity.held_out())
    assert bag(after) == bag(r for r in before if toxicity.probability(*toxicity.text_segments(r[1], model), model) < 0.3)
    kept = {r[0] for r in after}
    held = [i for i in range(160) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((i not in kept) == (i % 4 == 0) for i in held) >= 0.95 * len(held)
    assert len(after) >= len(before) - 45


def test_line_stage(stages):
    key = lambda x: common.words_of(x) and x.strip(" \t\n\x0b\x0c\r").lower()
    seen = collections.Counter()
    for r in stages[1]:
        seen.update({key(x) for x in (r[1] or "").split("\n") if key(x)})
    want = []
    for d, t, lang, source, _ in stages[1]:
        kept = "\n".join(x for x in (t or "").split("\n") if not key(x) or seen[key(x)] < 10)
        want.append((d, kept, lang, source, len(kept)))
    assert bag(stages[2]) == bag(want) and any("Shared" in (r[1] or "") for r in stages[1]) and not any("Shared" in r[1] for r in stages[2])


def test_near_duplicate_stage(stages):
    before, after = stages[2], stages[3]
    # groups by row: unlike rows of one id are told apart by numbering the rows
    order = sorted(range(len(before)), key=lambda i: (before[i][0] is None, before[i][0] or 0))
    numbered = [(n, before[i][1]) for n, i in enumerate(order)]
    groups = collections.defaultdict(list)
    for n, size, component in brute_groups(numbered, 5, 4, 5):
        groups[component if size else ("blank", n)].append(before[order[n]])
    left = bag(after)
    for rows in groups.values():
        least = min((r[0] for r in rows if r[0] is not None), default=None)
        own = [r for r in rows if left[r] > 0 and r[0] == least]
        assert own, rows
        left[own[0]] -= 1
    assert not +left
    ids = {r[0] for r in after}
    assert {300, 303, 400, 500, 501, 502} <= ids and 302 not in ids
    assert sum(r[0] == 300 for r in after) == 2 and sum(r[0] == 301 for r in after) == 1 and sum(r[0] == 400 for r in after) == 1


def test_mixing_stage(stages):
    before, after = stages[3], stages[4]
    size = lambda r: len(common.words_of(r[1]))
    times = bag(after)
    assert set(times) <= set(before)
    for r, n in bag(before).items():
        assert times[r] == n if size(r) == 0 else times[r] <= 2 * n
    total = sum(map(size, before))
    assert abs(sum(map(size, after)) - 1.5 * total) <= 0.35 * total


def test_packing_stage(stages):
    t = Tokenizer.from_file(__import__("public_tokenizers").path("word_bpe_49k.json"))
    ids = [t.encode(r[1] or "", add_special_tokens=False).ids + [1] for r in stages[4]]
    want = bag((r[0], i, 4096 * i, zlib.crc32(np.asarray(x[4096 * i : 4096 * i + 4096], "<u4").tobytes())) for r, x in zip(stages[4], ids, strict=True) for i in range(-(-len(x) // 4096)))
    assert bag((r.doc_id, r.piece, r.start, r.ids_crc32) for r in stages[5]) == want
    sequences = collections.defaultdict(list)
    for r in stages[5]:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= -(-sum(map(len, ids)) // 4096) + 1


def test_run(spark, tables, stages):
    got = corpus_pipeline.run(spark, tables).collect()
    place = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert bag(map(place, got)) == bag(map(place, stages[5]))


def test_empty_tables(spark, tables):
    docs = common.read_table(spark, tables, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert docs.count() == 0
