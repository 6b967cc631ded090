"""Corpus pipeline: toxicity, line de-duplication, near-duplicates, source mixing, packing.

Each stage takes (spark, docs, sf_dir), docs having the columns of `documents`, and works on all that the one before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refectory.llm import jaccard, line_dedup, mixing, packing, toxicity
from refectory.llm.common import read_table, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.3. The model is fitted on labelled documents outside the held-out fold."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.keep_below(docs.select(*COLUMNS), model, 0.3)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more go from every document; every document stays."""
    out = line_dedup.line_dedup(docs.select(*COLUMNS), keep=["lang", "source"])
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of its smallest doc_id; documents without words all stay."""
    return jaccard.keep_one(docs.select(*COLUMNS), k=5, threshold=(4, 5))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, by whole documents: the words taken over the document's words, rounded.

    Documents without words have no share in any target and stay once.
    """
    taken = mixing.mix(docs)
    times = taken.groupBy("doc_id", "size").agg(F.sum("taken").alias("taken"), F.count("*").alias("rows"))
    times = times.select("doc_id", "size", F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("rows") / F.col("size"))).otherwise(1).cast("int").alias("times"))
    own = docs.select(*COLUMNS, mixing.word_count("text").alias("size"))
    both = own.join(times.withColumnRenamed("doc_id", "id").withColumnRenamed("size", "n"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("size") == F.col("n")))
    return both.where("times > 0").withColumn("nth", F.explode(F.sequence(F.lit(1), "times"))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their places in sequences."""
    return packing.pack(packing.token_pieces(docs), carry=[F.crc32("ids").alias("ids_crc32")])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", drop_near_duplicates),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs


#: Toxicity and packing can't be expressed in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
