"""Token counts by a map-side lookup of two tiers: a broadcast table of frequent pre-tokens, then each worker's own cache."""

from __future__ import annotations

import gc
import os
import re
import string
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table

#: str.split() also takes these for white space; tokenizers' \s does not, so texts that hold one are encoded whole.
ODD = re.compile("[\x1c-\x1f]")
#: Entries a worker keeps before it starts anew.
CACHE = 800_000


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: What a chunk is stripped of before its letters are looked up.
PUNCTUATION = ".,;:!?\"'()"


class PreTokens:
    """Values of chunks (runs between white space), by a tokenizer that drops white space, lower-cases and splits letters from the rest.

    known: values given beforehand, which stay. Others are encoded once and kept until CACHE of them are there. Values add up: a
    chunk of letters with punctuation around is the sum of its parts, so that a word is encoded once for all its forms.
    cut: values of many words at once, from all their ids and where each word ends; it has to give what value gives.
    """

    def __init__(self, path: str, value, known: dict | None = None, cut=None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.value, self.known = Tokenizer.from_file(path), value, known or {}
        self.cut = cut or (lambda ids, ends: [value(ids[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)])
        self.cache, self.words = dict(self.known), {}
        # whether a run of a-z reaches the model as it is, so that the model alone encodes it
        a, t = string.ascii_lowercase, self.tokenizer
        same = t.normalizer is None or t.normalizer.normalize_str(a) == a
        self.bare = same and t.pre_tokenizer is not None and [x for x, _ in t.pre_tokenizer.pre_tokenize_str(a)] == [a] and t.post_processor is None
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for x, i in vocabulary.items() if x.endswith("</w>")]] = True

    def encode(self, texts: list[str]) -> list:
        return [self.value(x.ids) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[str]) -> list:
        """Values of words of lower-case letters only: by the model alone, or encoded together and told apart by the tokens that end a word."""
        out = []
        if self.bare and all(map(str.isascii, words)):
            tokenize = self.tokenizer.model.tokenize
            for at in range(0, len(words), 1000):
                ids, ends = [], []
                for x in words[at : at + 1000]:
                    ids += [t.id for t in tokenize(x)]
                    ends.append(len(ids))
                out += self.cut(ids, ends)
            return out
        for at in range(0, len(words), 1000):
            part = words[at : at + 1000]
            ids = self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):  # not one run of tokens for each word
                out += self.encode(part)
            else:
                out += self.cut(ids, ends.tolist())
        return out

    def learn(self, chunks: Iterable[str]) -> None:
        """Makes and keeps the values of chunks. Nothing here goes in circles, so looking for that, again and again, is put off."""
        on = gc.isenabled()
        gc.disable()
        try:
            self._learn(set(chunks))
        finally:
            if on:
                gc.enable()

    def _learn(self, chunks: set[str]) -> None:
        new = [x for x in chunks if x not in self.cache]
        if len(self.cache) - len(self.known) + len(self.words) + len(new) > CACHE:
            self.cache, self.words = dict(self.known), {}
            new = [x for x in chunks if x not in self.cache]
        plain = [x for x in new if x.isascii() and x.isalpha()]  # most: nothing to strip
        low = [x.lower() for x in plain]
        split, whole, words, rest = [], [], set(low), set()
        for x in new if len(plain) < len(new) else ():
            if x.isascii() and x.isalpha():
                continue
            word = x.strip(PUNCTUATION)
            # below U+0130 letters are lower-cased one by one and need no normalisation
            if word.isalpha() and (word.isascii() or max(word) < "\u0130"):
                i = x.index(word)
                if "'" not in x[:i]:  # else it may join the letters
                    lead, letters, trail = x[:i], word.lower(), x[i + len(word) :]
                    split.append((x, lead, letters, trail))
                    words.add(letters)
                    rest.add(lead)
                    rest.add(trail)
                    continue
            whole.append(x)
        plainest = {x for x in words if x.isascii()}
        for group, encode in ((plainest, self.encode_words), (words - plainest, self.encode_words), (rest, self.encode)):
            group = [x for x in group if x not in self.words]
            self.words.update(zip(group, encode(group), strict=True))
        own = self.words
        self.cache.update(zip(plain, map(own.__getitem__, low), strict=True))
        for x, a, b, c in split:
            self.cache[x] = own[a] + own[b] + own[c] if a else own[b] + own[c]
        for at in range(0, len(whole), 4096):
            part = whole[at : at + 4096]
            self.cache.update(zip(part, self.encode(part), strict=True))

    def of(self, texts: list[str | None]) -> Iterator[list]:
        """For each text the values of its pre-tokens, in order; one value where it is encoded whole."""
        at = 0
        while at < len(texts):
            # each text is split once; the misses of many texts are encoded together
            part, held = [], 0
            while at < len(texts) and held <= CACHE // 4:
                text = texts[at]
                part.append(None if not text else text if ODD.search(text) else text.split())
                held += len(part[-1]) if isinstance(part[-1], list) else 0
                at += 1
            new = set(chain.from_iterable(x for x in part if isinstance(x, list))).difference(self.cache)
            if new and len(new) <= CACHE // 4:
                self.learn(new)
            for chunks in part:
                if chunks is None:
                    yield []
                elif isinstance(chunks, str):
                    yield self.encode([chunks])
                else:
                    try:
                        yield list(map(self.cache.__getitem__, chunks))
                    except KeyError:
                        yield self._long(chunks)

    def _long(self, chunks: list[str]) -> list:
        out = []
        for at in range(0, len(chunks), CACHE // 4):  # no more at once than the cache holds
            part = chunks[at : at + CACHE // 4]
            self.learn(part)
            out += [self.cache[x] for x in part]
        return out


_WORKER: dict = {}


def worker_tier(kind: str, path: str, value, known: dict | None, key: object, cut=None) -> PreTokens:
    """The PreTokens that this worker process already has, or new ones."""
    if _WORKER.get((kind, path), (None,))[0] != key:
        _WORKER[kind, path] = (key, PreTokens(path, value, known, cut))
    return _WORKER[kind, path][1]


def _frequent(size: int, longest: int = 64):
    """A task's `size` most frequent pre-tokens; of some hundred thousand at a time those that come once are forgotten."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update((text.as_py() or "").split())
                if len(counts) > 8 * size:
                    counts = Counter({x: n for x, n in counts.items() if n > 1})
                    if len(counts) > 4 * size:
                        counts = Counter(dict(counts.most_common(2 * size)))
        own = [(x, n) for x, n in counts.most_common(size) if n > 1 and len(x) <= longest]
        yield pa.record_batch([pa.array([x for x, _ in own], pa.string()), pa.array([n for _, n in own], pa.int64())], names=["chunk", "n"])

    return run


def frequent_lengths(docs: DataFrame, path: str, size: int = 1 << 16, sample: int = 10_000, tasks: int = 8) -> dict[str, int]:
    """The first tier: lengths of at most size pre-tokens, the most frequent ones of a sample of about `sample` documents.

    The sample is taken by a hash of the document over all of them, so every file and source is in it, and goes to a few tasks; each
    sends its size most frequent pre-tokens to the driver. So what is sent doesn't grow with the corpus, and no pre-token is shuffled. The
    choice only decides which pre-tokens are found in the first tier; no count depends on it.
    """
    every = docs.count()
    own = docs.select("doc_id", "text")
    if every > sample:
        own = own.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(every)) < sample)
    counts: Counter = Counter()
    for r in own.select("text").repartition(tasks).mapInArrow(_frequent(size), "chunk string, n long").toLocalIterator():
        counts[r["chunk"]] += r["n"]
    tier = PreTokens(path, len)
    tier.learn(x for x, _ in counts.most_common(size))
    return tier.cache


def _counted(path: str, table, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tier = worker_tier("lengths", path, len, table.value, key)
        for batch in batches:
            counts = [sum(x) for x in tier.of(batch["text"].to_pylist())]
            yield pa.record_batch([batch["doc_id"], batch["n_bytes"], pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str | None = None, limit: int = 2048) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, n_bytes, n_tokens, over_limit, one row for each row, in one pass without a shuffle.

    Before it a bounded sample fills the first tier, see frequent_lengths.
    Counts are those of the tokenizer at path over the whole text, without special tokens added. A null text counts as empty (0, 0).
    Other columns aren't read. path: a tokenizers file whose pre-tokens never span white space.
    """
    path = path or word_tokenizer()
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = own.mapInArrow(_counted(path, table, f"{id(table)}-{docs.sparkSession.sparkContext.applicationId}"), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"))
