"""Mixing sources to target weights by a low-discrepancy schedule [DataFrame and SQL functions only].

Each source's documents are shuffled and laid end to end, and that line is cut into blocks of equally many words. Points of the
golden-ratio sequence, mapped through the sources' cumulative targets, say which source each slot of the mix draws from; the slots of
a source are ranked, and the rank names its next block. A source that is taken more than once starts its line again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, read_table, staged

GOLDEN = 0.6180339887498949
#: Frac(2^20 * golden ratio): slots are numbered in two parts, so that points stay exact to 2^-30 up to 2^40 slots.
GOLDEN_HIGH = 0.607787409740351
CELLS = 4096
#: Documents of a source that are put in order in one task, about: each source has as many parts as it needs.
PART_ROWS = 500


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """sizes (source, source_size), one row a source -> also target: water-filling of share times all sizes by weight, capped.

    Sources in code-point order, null last, take the weights in turn. A source's target stops at most times its size; what is over
    goes to the others by weight. Equal caps are one level. All of it is over one row for each source, tens of them or thousands.
    """
    ranked = sizes.withColumn("nth", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = reduce(lambda x, iw: x.when(F.pmod("nth", F.lit(len(weights))) == iw[0], F.lit(iw[1])), enumerate(weights[1:], 1), F.when(F.pmod("nth", F.lit(len(weights))) == 0, F.lit(weights[0])))
    capped = ranked.withColumn("w", weight).withColumn("cap", F.col("source_size") * most).withColumn("level", F.col("cap") / F.col("w"))
    order = Window.orderBy("level", "nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.partitionBy()
    before = F.sum("cap").over(order) - F.col("cap")
    rest = F.sum("w").over(every) - F.sum("w").over(order) + F.col("w")
    fill = capped.withColumn("fill", (F.sum("source_size").over(every) * share - before) / rest)
    # the first source that the filling level doesn't cap sets the level
    level = F.min(F.when(F.col("fill") <= F.col("level"), F.struct("level", "nth", "fill"))).over(every)["fill"]
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("w") * level, F.col("cap").cast("double")))
    return fill.select("source", "source_size", "nth", target.alias("target"))


def word_count(text: str) -> Column:
    """Number of words [^\\x20\\x09-\\x0D]+; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _spread(df: DataFrame, by: str, part: Column, order: list, total: str | None = None) -> DataFrame:
    """Adds `before`: per value of by, the number of rows (or the sum of total) ahead in the order (part, *order).

    Counted in two steps, within (by, part) and over the sums of the parts, so that no value of by is sorted in one task.
    """
    cut = df.withColumn("part", part)
    one = F.lit(1) if total is None else F.col(total)
    sums = cut.groupBy(by, "part").agg(F.sum(one).alias("part_sum"))
    ahead = sums.select(by, "part", (F.sum("part_sum").over(Window.partitionBy(by).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("part_sum")).alias("ahead"))
    own = F.sum(one).over(Window.partitionBy(by, "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - one
    return cut.withColumn("own", own).join(ahead, [by, "part"]).withColumn("before", F.col("own") + F.col("ahead")).drop("own", "ahead")


def mix_schedule(sources: DataFrame, block: int) -> DataFrame:
    """sources (nth, source_size, quota) -> slot, nth, block, pass, block_end: what each slot of the mix takes.

    Every source gets exactly the slots of its quota. The sequence's discrepancy leaves a source a few slots short or over: those
    over are left out, and those that lack are added at the end.
    """
    spark = sources.sparkSession
    size, quota = F.col("source_size"), F.col("quota")
    nb = F.ceil(size / block)
    need = F.when(size > 0, F.floor(quota / size) * nb + F.ceil(F.pmod(quota, size) / block)).otherwise(0)
    src = staged(sources.withColumn("need", need.cast("long")), "sources")
    n = src.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]
    w = Window.orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bounds = src.where("need > 0").withColumn("hi", F.sum("need").over(w) / F.lit(max(n, 1)))
    bounds = bounds.withColumn("lo", F.coalesce(F.lag("hi").over(Window.orderBy("nth")), F.lit(0.0)))
    cells = bounds.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * CELLS).cast("int"), F.least(F.lit(CELLS - 1), F.floor(F.col("hi") * CELLS).cast("int"))))).select("cell", "nth", "lo", "hi")
    high, low = F.floor(F.col("id") / (1 << 20)), F.pmod("id", F.lit(1 << 20))
    u = high * GOLDEN_HIGH - F.floor(high * GOLDEN_HIGH) + low * GOLDEN - F.floor(low * GOLDEN)
    points = spark.range(n).select(F.col("id").alias("slot"), (u - F.floor(u)).alias("u")).withColumn("cell", F.floor(F.col("u") * CELLS).cast("int"))
    drawn = points.join(cells, "cell").where((F.col("u") >= F.col("lo")) & ((F.col("u") < F.col("hi")) | (F.col("hi") >= 1.0))).select("slot", "nth")
    ranked = _spread(drawn, "nth", F.floor(F.col("slot") / 65_536), ["slot"]).select("slot", "nth", F.col("before").alias("rank"))
    have = ranked.groupBy("nth").agg(F.count("*").alias("have"))
    lacking = src.join(have, "nth", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < need")
    lacking = lacking.select("nth", F.explode(F.sequence("have", F.col("need") - 1)).alias("rank")).select((F.lit(n) + F.col("rank")).alias("slot"), "nth", "rank")
    out = ranked.unionByName(lacking).join(src, "nth").where("rank < need")
    nth_pass, nth_block = F.floor(F.col("rank") / nb), F.pmod("rank", nb)
    stop = F.when(nth_pass < F.floor(quota / size), size).otherwise(F.pmod(quota, size))
    return out.select("slot", "nth", nth_block.cast("long").alias("block"), nth_pass.cast("long").alias("pass"), F.least((nth_block + 1) * block, stop).cast("long").alias("block_end"))


def mix(docs: DataFrame, block: int = 1024, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: int = 2) -> DataFrame:
    """docs (doc_id, text, source, ...) -> doc_id, source, size, source_size, target, taken, one row for each row.

    size counts words [^\\x20\\x09-\\x0D]+ (null text: 0). taken: words of the document that the mix takes, repeats counted; a
    source's sum is its target rounded, and no document has more than `most` times its size. Sources are shuffled by the MD5 of
    doc_id, so reruns agree; rows of the same doc_id and size stand for each other. Null sources are one source, the last. An empty
    table gives no rows, and if no text has words, everything is 0.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", word_count("text").alias("size"))
    rows = staged(rows.withColumn("turn", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))), "sizes")
    sizes = staged(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents")), "sources")
    sources = source_targets(sizes.drop("documents"), weights, share, most).withColumn("quota", F.round("target").cast("long"))
    digits = F.greatest(F.lit(1), F.ceil(F.log(16.0, F.col("documents") / PART_ROWS))).cast("int").alias("digits")
    sources = staged(sources.join(sizes.select(F.col("source").alias("name"), digits), F.col("source").eqNullSafe(F.col("name"))).drop("name"), "targets")
    # null-safe: the source's number stands for it from here on
    numbered = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).select("doc_id", rows["source"], "size", "turn", "nth", "source_size", "target", "digits")
    laid = _spread(numbered, "nth", F.substr(F.col("turn"), F.lit(1), F.col("digits")), ["turn", "size"], "size").withColumn("row", F.row_number().over(Window.partitionBy("nth", "part").orderBy("turn", "size")))
    first, last = F.floor(F.col("before") / block), F.floor((F.col("before") + F.col("size") - 1) / block)
    parts = laid.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))))
    taken = mix_schedule(sources.select("nth", "source_size", "quota"), block).select("nth", "block", "block_end")
    begin = F.greatest(F.col("before"), F.col("block") * block)
    end = F.least(F.col("before") + F.col("size"), F.coalesce("block_end", F.lit(0)))  # a block not drawn: nothing
    drawn = parts.join(taken, ["nth", "block"], "left").withColumn("words", F.coalesce(F.greatest(end - begin, F.lit(0)), F.lit(0)))
    out = drawn.groupBy("nth", "part", "row", "doc_id", "source", "size", "source_size", "target").agg(F.sum("words").cast("long").alias("taken"))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).drop("source")


OP9_SQL = """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS turn FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS nth FROM d GROUP BY source),
w AS (SELECT *, CASE nth % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, 2 * source_size AS cap FROM s),
l AS (SELECT *, CAST(cap AS DOUBLE) / w AS level FROM w),
f AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5
        - CAST(sum(cap) OVER (ORDER BY level, nth ROWS UNBOUNDED PRECEDING) - cap AS DOUBLE))
        / CAST(sum(w) OVER () - sum(w) OVER (ORDER BY level, nth ROWS UNBOUNDED PRECEDING) + w AS DOUBLE) AS fill FROM l),
t AS (SELECT f.source, source_size, nth, least(CAST(cap AS DOUBLE), coalesce(w * (SELECT fill FROM f WHERE fill <= level ORDER BY level, nth LIMIT 1), CAST(cap AS DOUBLE))) AS target FROM f),
p AS (SELECT doc_id, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS quota,
             CAST(sum(size) OVER (PARTITION BY nth ORDER BY turn, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       greatest(0, least(stop, quota) - (stop - size)) + greatest(0, least(stop + source_size, quota) - (stop + source_size - size)) AS taken
FROM p
"""
