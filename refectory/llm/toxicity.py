"""Toxicity by maximum-scoring segments.

Tokens are words and the first 4 and 5 bytes of longer words, so that inflected forms count together. Tokens get log-odds between
toxic and clean labelled texts, by how many texts hold them, shrunk by a Dirichlet prior; those that differ significantly form the
lexicon, and all other words share one small negative score. A linear scan finds all maximal scoring
segments of a text. How unlikely a segment's score is in a clean text of that length follows the extreme-value distribution fitted to
the clean texts' best segments; what the significant segments carry beyond chance is summed and turned into a probability.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_fold, read_table

#: A-Z lower-cased, ASCII punctuation to spaces: then bytes.split() gives the words.
_FOLD = bytes(ord(" ") if chr(c) in string.punctuation else c + 32 if 65 <= c <= 90 else c for c in range(256))


STEMS = (4, 5)


def tokens_of(word: bytes) -> list[bytes]:
    """The word, and its stems, marked by a byte that is in no word."""
    return [word, *(word[:n] + b" " for n in STEMS if len(word) > n)]


def fold_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


@dataclass
class ToxicityModel:
    lexicon: dict[bytes, float]
    other: float  # score of a word outside the lexicon
    scale: float = 1.0  # lambda of the extreme-value distribution
    log_k: float = 0.0  # ln K: the best of n words exceeds x with probability 1 - exp(-K n exp(-lambda x))
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)  # of the logistic step: constant, best segment, sum

    def __post_init__(self) -> None:
        self.heads = {x.rstrip(b" ")[: STEMS[0]] for x in self.lexicon}

    def word_score(self, word: bytes) -> float | None:
        return max((self.lexicon[x] for x in tokens_of(word) if x in self.lexicon), default=None)


def maximal_segments(at: list[int], scores: list[float], other: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a text in which words at positions `at` score `scores`, others `other`.

    Each candidate keeps the cumulative scores before its start and at its end. A new positive word joins, with all between, to the
    nearest earlier candidate that starts lower, if that one also ends lower; else it stands alone. Linear: candidates that can no
    longer be joined are passed by links.
    """
    found: list[list] = []  # [start, end, before, through, link]
    total, last = 0.0, 0
    for i, s in zip(at, scores, strict=True):
        total += other * (i - last)
        last = i + 1
        before = total
        total += s
        if s <= 0:
            continue
        new = [i, i + 1, before, total]
        k = len(found) - 1
        while True:
            while k >= 0 and found[k][2] >= new[2]:
                k = found[k][4]
            if k < 0 or found[k][3] >= new[3]:
                found.append([*new, k])
                break
            new = [found[k][0], new[1], found[k][2], new[3]]
            after = found[k][4]
            del found[k:]
            k = after
    return [(a, b, hi - lo) for a, b, lo, hi, _ in found]


def text_segments(text: str | None, model: ToxicityModel) -> tuple[int, list[tuple[int, int, float]]]:
    words, heads, n = fold_words(text), model.heads, STEMS[0]
    at = [i for i, w in enumerate(words) if w[:n] in heads]
    hits = [(i, s) for i in at if (s := model.word_score(words[i])) is not None]
    return len(words), maximal_segments([i for i, _ in hits], [s for _, s in hits], model.other) if hits else []


def features(n: int, segments: list[tuple[int, int, float]], model: ToxicityModel) -> tuple[float, float, list[float]]:
    """The best segment's excess over chance, the sum of all significant ones, and each segment's expected count by chance."""
    if not segments:
        return 0.0, 0.0, []
    chance = model.log_k + math.log(max(n, 1))
    over = [model.scale * s - chance for _, _, s in segments]
    best = max(over)
    return max(best, -5.0), sum(x for x in over if x > 0), [math.exp(min(-x, 700.0)) for x in over]


def probability(n: int, segments: list, model: ToxicityModel) -> float:
    if not segments:
        x = (-5.0, 0.0)
    else:
        x = features(n, segments, model)[:2]
    z = model.weights[0] + model.weights[1] * x[0] + model.weights[2] * math.log1p(x[1])
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


#: Stand for the number of words and of texts in the counts.
WORDS, TEXTS = b" words", b" texts"


def _token_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> Iterator[pa.RecordBatch]:
        words = list(counts[0].keys() | counts[1].keys())
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            yield pa.record_batch([pa.array(part, pa.binary()), *(pa.array([c[w] for w in part], pa.int64()) for c in counts)], names=["word", "n0", "n1"])
        counts[0].clear(), counts[1].clear()

    for batch in batches:
        for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
            words, own = fold_words(text), counts[1 if toxic else 0]
            own.update({t for w in set(words) for t in tokens_of(w)})
            own[WORDS] += len(words)
            own[TEXTS] += 1
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield from out()
    yield from out()


def labelled(docs: DataFrame, labels: DataFrame, train: Column, max_docs: int) -> DataFrame:
    """(text, toxic) of at most max_docs labelled rows for which train holds, by a fixed order of their ids; equal texts once.

    Where labels contradict each other, the text counts as toxic.
    """
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & train).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    return docs.select("doc_id", "text").join(F.broadcast(own), "doc_id").groupBy("text").agg(F.max("toxic").cast("int").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, train: Column, max_docs: int = 20_000, prior: float = 1.0, min_g2: float = 28.0, min_log_odds: float = 3.0) -> ToxicityModel:
    """Fit on at most max_docs labelled rows (doc_id, toxic) for which train holds.

    prior: the Dirichlet prior's counts for a token, dealt to both sides by their numbers of texts. A token enters the lexicon when its
    log-odds are at least min_log_odds and its likelihood ratio (G squared) at least min_g2. Only such tokens reach the driver, besides
    a few numbers for each labelled document. Without labels of both kinds every score is 0.
    """
    rows = labelled(docs, labels, train, max_docs).persist()
    counts = rows.mapInArrow(_token_counts, "word binary, n0 long, n1 long").groupBy("word").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    counts = counts.persist()
    totals = {bytes(r["word"]): (r["n0"], r["n1"]) for r in counts.where(F.col("word").isin(bytearray(WORDS), bytearray(TEXTS))).collect()}
    t0, t1 = totals.get(TEXTS, (0, 0))
    if not t0 or not t1:
        counts.unpersist(), rows.unpersist()
        return ToxicityModel({}, 0.0, weights=(-700.0, 0.0, 0.0))
    share = t1 / (t0 + t1)
    k, m = F.col("n1"), F.col("n0")
    y0, y1 = m + prior * (1 - share), k + prior * share
    delta = F.log(y1 / (t1 + prior - y1)) - F.log(y0 / (t0 + prior - y0))
    part = lambda c, q: F.when(c > 0, c * F.log(c / (k + m) / q)).otherwise(0.0)
    own = counts.select("word", "n0", "n1", delta.alias("delta"), (2 * (part(k, share) + part(m, 1 - share))).alias("g2")).where((k < t1) | (m < t0))
    found = own.where((F.col("delta") >= min_log_odds) & (F.col("g2") >= min_g2)).collect()
    counts.unpersist()
    n0, n1 = totals[WORDS]
    found = [r for r in found if bytes(r["word"]) not in (WORDS, TEXTS)]
    q0, q1 = ((sum(r[c] for r in found if not bytes(r["word"]).endswith(b" ")) + 0.5) / (n + 1) for c, n in (("n0", n0), ("n1", n1)))
    model = ToxicityModel({bytes(r["word"]): r["delta"] for r in found}, min(math.log((1 - q1) / (1 - q0)), -1e-3))
    lexicon, other = model.lexicon, model.other

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [text_segments(t, ToxicityModel(lexicon, other)) for t in batch["text"].to_pylist()]
            top = pa.array([max((s for _, _, s in x), default=0.0) for _, x in own], pa.float64())
            segments = pa.array([[s for _, _, s in x] for _, x in own], pa.list_(pa.float64()))
            yield pa.record_batch([batch["toxic"], pa.array([n for n, _ in own], pa.int64()), top, segments], names=["toxic", "n", "top", "segments"])

    seen = rows.mapInArrow(best, "toxic int, n long, top double, segments array<double>").collect()
    rows.unpersist()
    # the extreme-value distribution of the clean texts' best segments, by moments: the best of n words less ln(n) / lambda
    clean = [(r["top"], math.log(r["n"])) for r in seen if not r["toxic"] and r["top"] > 0 and r["n"] > 0]
    if len(clean) >= 30:
        top, ln = (np.array(x) for x in zip(*clean, strict=True))
        scale = 1.0
        for _ in range(20):
            scale = math.pi / math.sqrt(6) / max(float(np.std(top - ln / scale)), 1e-3)
        model.scale = min(max(scale, 0.05), 5.0)
        model.log_k = model.scale * float(np.mean(top - ln / model.scale)) - 0.5772156649
    x, y = [], []
    for r in seen:
        best_over, total, _ = features(r["n"], [(0, 0, s) for s in r["segments"]], model) if r["segments"] else (-5.0, 0.0, [])
        x.append((1.0, best_over, math.log1p(total)))
        y.append(float(r["toxic"] > 0))
    model.weights = _logistic(np.array(x), np.array(y))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, ...]:
    """Newton steps for a logistic regression with a slight penalty.

    Where the texts can be told apart completely the penalty alone bounds the weights, and whole steps swing from side to side for good;
    so a step is halved until the loss goes down by a part of what its slope promises. The loss is convex, and that leads to its minimum.
    """
    loss = lambda w: float(np.logaddexp(0, x @ w).sum() - y @ (x @ w) + ridge * (w @ w) / 2)
    w = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -700, 700)))
        slope = x.T @ (y - p) - ridge * w
        step, at = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope), loss(w)
        while loss(w + step) > at - 1e-4 * (slope @ step) and np.abs(step).max() > 1e-9:
            step = step / 2
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, model: ToxicityModel, max_chance: float = 0.05) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_words, score, segments, one row for each row, without a shuffle.

    segments: (start, end, score, expected) in words, of those that a clean text of this length would be expected to hold less than
    max_chance times. Null and empty texts have no segment and the score of such a text. Other columns aren't read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())]))
        for batch in batches:
            n, p, segments = [], [], []
            for text in batch["text"].to_pylist():
                k, own = text_segments(text, model)
                n.append(k), p.append(probability(k, own, model))
                expected = features(k, own, model)[2]
                segments.append([{"start": a, "end": b, "score": s, "expected": e} for (a, b, s), e in zip(own, expected, strict=True) if e < max_chance])
            yield pa.record_batch([batch["doc_id"], pa.array(n, pa.int64()), pa.array(p, pa.float64()), pa.array(segments, kind)], names=["doc_id", "n_words", "score", "segments"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return own.mapInArrow(run, "doc_id long, n_words long, score double, segments array<struct<start: long, end: long, score: double, expected: double>>")


def keep_below(docs: DataFrame, model: ToxicityModel, threshold: float) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores below threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [probability(*text_segments(t, model), model) < threshold for t in batch["text"].to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out(col: str = "doc_id", n: int = 4, rest: int = 2) -> Column:
    """Whether crc32 of the id as text leaves this remainder; null ids aren't held out."""
    return F.coalesce(crc_fold(col, n) == rest, F.lit(False))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"), ~held_out())
    out = score(docs, model)
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("segments").alias("n_segments"))
