"""Joins that need more than one built-in (J)."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def null_safe(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Equality of keys in which null equals null."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def full_outer_zero(a: DataFrame, b: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Full outer join on null-safe keys, missing measures 0, rows of zeros only left out. Measures are named apart on the sides."""
    a, b = a.alias("a"), b.alias("b")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    # which side a row is from is known by a mark, as keys may be null
    j = a.withColumn("__a", F.lit(1)).alias("a").join(b.withColumn("__b", F.lit(1)).alias("b"), on, "full_outer")
    pick = [F.when(F.col("a.__a").isNotNull(), F.col(f"a.{k}")).otherwise(F.col(f"b.{k}")).alias(k) for k in keys]
    own = [F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in measures]
    out = j.select(*pick, *own)
    some = F.lit(False)
    for m in measures:
        some = some | (F.col(m) != 0)
    return out.where(some)


def routed(fact: DataFrame, status: DataFrame, dim: DataFrame, site: str, group: str, dim_key: str, how: str = "left", also: tuple[str, ...] = ()) -> DataFrame:
    """Fact joined with dim by site where the group's status is 2, else by group.

    status (group column, status), one row a group. The key is computed once, so that this is an equi-join. also: columns of both sides
    that must be equal as well.
    """
    s = status.select(F.col(group), F.col("status").alias("__status"))
    keyed = fact.join(s, group, "left").withColumn("__route", F.when(F.col("__status") == 2, F.col(site)).otherwise(F.col(group)))
    return keyed.join(dim.withColumnRenamed(dim_key, "__route"), ["__route", *also], how).drop("__status", "__route")


def latest_started(fact: DataFrame, date: str, periods: DataFrame, start: str, cols: list[str], order: str) -> DataFrame:
    """For each row the values `cols` of the period that started last on or before its date (of equal starts the largest `order`).

    Periods do not depend on other columns, so each distinct date is matched once with the periods, a small table, and joined back.
    """
    days = fact.select(F.to_date(date).alias("__day")).distinct()
    best = days.join(periods, F.col("__day") >= F.to_date(start)).groupBy("__day").agg(F.max_by(F.struct(*cols), F.struct(F.to_date(start), F.col(order))).alias("__p"))
    return fact.withColumn("__day", F.to_date(date)).join(best, "__day", "left").select(*(F.col(c) for c in fact.columns), *(F.col(f"__p.{c}").alias(c) for c in cols))


def within_period(fact: DataFrame, date: str, periods: DataFrame, start: str, end: str, how: str = "inner") -> DataFrame:
    """Rows with the periods that hold their day, both ends in; overlapping periods give a row each."""
    day = F.to_date(F.col(date))
    return fact.join(periods, (day >= F.to_date(F.col(start))) & (day <= F.to_date(F.col(end))), how)


def period_or_none(fact: DataFrame, keys: list[str], date: str, periods: DataFrame, start: str, end: str) -> DataFrame:
    """Rows with the period of their key that holds the day; rows whose key has no period at all stay with nulls, others go."""
    known = periods.select(*keys).distinct().withColumn("__known", F.lit(True))
    j = fact.join(known, keys, "left").join(periods, keys, "left")
    return j.where(F.col("__known").isNull() | F.to_date(F.col(date)).between(F.to_date(F.col(start)), F.to_date(F.col(end)))).drop("__known")


def densify(df: DataFrame, day: str, group: str, entity: str, measures: list[str]) -> DataFrame:
    """Every day of a group for every entity of it, missing measures 0."""
    sums = df.groupBy(day, group, entity).agg(*(F.sum(m).alias(m) for m in measures))
    grid = sums.select(group, day).distinct().join(sums.select(group, entity).distinct(), group)
    return grid.join(sums, [group, day, entity], "left").select(group, day, entity, *(F.coalesce(m, F.lit(0)).alias(m) for m in measures))


def overlay(df: DataFrame, key: str, corrections: DataFrame, value: str) -> DataFrame:
    """Corrections (key, value) go before the own value; one correction a key."""
    return df.join(corrections.select(key, F.col(value).alias("__fix")), key, "left").withColumn(value, F.coalesce("__fix", value)).drop("__fix")


def by_year_or_latest(df: DataFrame, lookup: DataFrame, site: str, year: str, value: str, default: float) -> DataFrame:
    """The value of (site, year), else the site's latest known one, else a constant; of several values of a year the largest."""
    exact = lookup.groupBy(site, year).agg(F.max(value).alias("__exact"))
    latest = exact.where("__exact is not null").groupBy(site).agg(F.max_by("__exact", year).alias("__latest"))
    return df.join(exact, [site, year], "left").join(latest, site, "left").withColumn(value, F.coalesce("__exact", "__latest", F.lit(default))).drop("__exact", "__latest")


def id_chain(fact: DataFrame, key: str, maps: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Ids followed through maps (frame, from, to), as session -> wave -> school year; each step adds its id, null where the chain breaks.

    A map has one row an id; of several the smallest target counts.
    """
    out = fact
    for m, a, b in maps:
        one = m.where(F.col(a).isNotNull()).groupBy(F.col(a).alias("__from")).agg(F.min(b).alias(b))
        out = out.join(one, F.col(key) == F.col("__from"), "left").drop("__from")
        key = b
    return out


def resolve_ids(df: DataFrame, label: str, lookup: DataFrame, lookup_label: str, lookup_id: str, strict: bool = True) -> DataFrame:
    """The id of each row's label; of several ids of a label the smallest. A label that the lookup lacks is an error; not strict, it has a null id."""
    ids = lookup.groupBy(F.col(lookup_label).alias("__label")).agg(F.min(lookup_id).alias(lookup_id))
    out = df.join(ids, F.col(label) == F.col("__label"), "left").drop("__label")
    if strict and (lost := out.where(F.col(label).isNotNull() & F.col(lookup_id).isNull()).select(label).distinct().orderBy(label).limit(5).collect()):
        raise ValueError(f"resolve_ids: no {lookup_id} for {', '.join(repr(r[0]) for r in lost)}")
    return out


def key_union(sources: list[tuple[DataFrame, str]], name: str) -> DataFrame:
    """The distinct keys of several sources (frame, column), without nulls and empty texts."""
    keys = [df.select(F.col(c).alias(name)).where(F.col(name).isNotNull() & (F.col(name).cast("string") != "")).distinct() for df, c in sources]
    return reduce(DataFrame.unionByName, keys).distinct()


def filled_years(df: DataFrame, entities: DataFrame, key: str, years: DataFrame, year: str, value: str) -> DataFrame:
    """Entities without any row get one of null value for each year."""
    none = entities.select(key).distinct().join(df.select(key).distinct(), key, "left_anti")
    return df.select(key, year, value).unionByName(none.crossJoin(years.select(year).distinct()).withColumn(value, F.lit(None).cast(df.schema[value].dataType)))


def _jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    reach = max(max(la, lb) // 2 - 1, 0)
    used, hits = [False] * lb, []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(lb, i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                hits.append(ch)
                break
    if not hits:
        return 0.0
    other = [ch for ch, u in zip(b, used, strict=True) if u]
    moved = sum(x != y for x, y in zip(hits, other, strict=True)) // 2
    m = len(hits)
    return (m / la + m / lb + (m - moved) / m) / 3


@lru_cache(100_000)
def _similarity(a: str, b: str) -> float:
    s, n = _jaro(a, b), 0
    if s > 0.7:
        while n < min(4, len(a), len(b)) and a[n] == b[n]:
            n += 1
    return s + n * 0.1 * (1 - s)


def _similarities(x: str, names: list[str]) -> np.ndarray:
    """_similarity() of x to each name: the same steps, one letter of x at a time for all names."""
    if len(names) < 20 or not x:
        return np.array([_similarity(x, b) for b in names], float)
    length = np.array([len(b) for b in names])
    text = np.array(names, dtype=f"U{max(1, length.max())}").view(np.uint32).reshape(len(names), -1)
    rows, place = np.arange(len(names)), np.arange(text.shape[1])
    reach = np.maximum(np.maximum(len(x), length) // 2 - 1, 0)[:, None]
    free, hit = place < length[:, None], np.zeros((len(names), len(x)), bool)
    for i, c in enumerate(x):
        fits = (text == ord(c)) & free & (place >= i - reach) & (place <= i + reach)
        j = fits.argmax(axis=1)
        hit[:, i] = fits[rows, j]
        free[rows, j] &= ~hit[:, i]
    used = (place < length[:, None]) & ~free
    m = hit.sum(axis=1)
    (a, i), (b, j) = np.nonzero(hit), np.nonzero(used)  # hits of a name in the order of x, and in its own
    moved = np.bincount(a[np.array([ord(c) for c in x])[i] != text[b, j]], minlength=len(names))
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.where(m > 0, (m / len(x) + m / length + (m - moved // 2) / m) / 3, 0.0)
    same, n = np.ones(len(names), bool), np.zeros(len(names), np.int64)
    for i, c in enumerate(x[: min(4, text.shape[1])]):
        same &= (text[:, i] == ord(c)) & (length > i)
        n += same
    return np.where(s > 0.7, s + n * 0.1 * (1 - s), s)


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity with prefix weight 0.1 and at most 4 characters, from a Jaro similarity of 0.7; null with null."""
    return pd.Series([None if x is None or y is None else _similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


_SYMBOLS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def letter_bits(name: Column) -> Column:
    """How often a name has each letter and digit, up to three times: a bit for each, in two numbers; and how many letters are left."""
    letters = F.filter(F.split(F.upper(name), ""), lambda c: c != "")
    nth = F.transform(letters, lambda c, i: F.size(F.filter(F.slice(letters, 1, i + 1), lambda x: x == c)))
    bit = F.zip_with(letters, nth, lambda c, n: F.when((n <= 3) & F.contains(F.lit(_SYMBOLS), c), 3 * (F.call_function("locate", c, F.lit(_SYMBOLS)) - 1) + n - 1))
    word = lambda low: F.aggregate(F.filter(bit, lambda x: x.between(low, low + 63)), F.lit(0).cast("long"), lambda w, x: w.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), x - low)))
    return F.struct(word(0).alias("lo"), word(64).alias("hi"), F.size(F.filter(bit, F.isnull)).alias("rest"))


def similarity_bound(a: str, b: str) -> Column:
    """No Jaro-Winkler similarity of columns a and b is above: no more letters match than are common, all of them in order at best.

    Columns {a}_letters and {b}_letters hold letter_bits() of them.
    """
    x, y, own, other = F.col(a), F.col(b), F.col(f"{a}_letters"), F.col(f"{b}_letters")
    common = F.bit_count(own["lo"].bitwiseAND(other["lo"])) + F.bit_count(own["hi"].bitwiseAND(other["hi"])) + F.least(own["rest"], other["rest"])
    jaro = (common / F.length(x) + common / F.length(y) + 1) / 3
    prefix = reduce(lambda m, n: m + n, [((F.least(F.length(x), F.length(y)) >= i) & (F.substring(x, 1, i) == F.substring(y, 1, i))).cast("int") for i in range(1, 5)])
    return F.when(x == y, 1.0).when(common == 0, 0.0).when(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro)).otherwise(jaro)


#: A task compares at most about so many queries with so many people at a time.
QUERIES_AT_ONCE, PEOPLE_AT_ONCE = 1000, 65_536


@lru_cache(100_000)
def _bits(name: str) -> tuple[int, int, int]:
    """letter_bits() of a name as it is."""
    lo = hi = rest = 0
    seen: dict[str, int] = {}
    for c in name:
        n = seen[c] = seen.get(c, 0) + 1
        bit = 3 * _SYMBOLS.find(c) + n - 1
        if n > 3 or c not in _SYMBOLS:
            rest += 1
        elif bit < 64:
            lo |= 1 << bit
        else:
            hi |= 1 << (bit - 64)
    return lo, hi, rest


class _Names:
    """Distinct names of a column of people, with what similarity_bound() needs of them, and each person's place among them."""

    def __init__(self, people: pd.DataFrame, name: str) -> None:
        self.at, own = pd.factorize(people[name])
        self.names, self.place = list(own), {x: i for i, x in enumerate(own)}
        self.length = np.array([len(x) for x in self.names], float)
        self.head = np.array([[ord(c) for c in x[:4]] + [-1] * (4 - len(x)) for x in self.names], np.int32).reshape(-1, 4).T.copy()
        self.lo, self.hi, self.rest = np.array([_bits(x) for x in self.names], np.uint64).reshape(-1, 3).T.copy()

    def bound(self, x: str) -> np.ndarray:
        """similarity_bound() of x and each distinct name."""
        lo, hi, rest = np.array(_bits(x), np.uint64)
        common = np.bitwise_count(self.lo & lo).astype(float) + np.bitwise_count(self.hi & hi) + np.minimum(self.rest, rest)
        with np.errstate(divide="ignore", invalid="ignore"):
            jaro = (common / len(x) + common / self.length + 1) / 3 if x else np.zeros(len(common))
        same, prefix = np.ones(len(common), bool), np.zeros(len(common), np.int8)
        for i, c in enumerate(x[:4]):
            same &= self.head[i] == ord(c)
            prefix += same
        out = np.where(jaro > 0.7, jaro + 0.1 * prefix * (1 - jaro), jaro)
        out[common == 0] = 0
        if x in self.place:
            out[self.place[x]] = 1
        return out

    def similar(self, x: str, people: np.ndarray) -> np.ndarray:
        """Similarity of x to these people's names, each distinct one scored once."""
        own, back = np.unique(self.at[people], return_inverse=True)
        return _similarities(x, [self.names[i] for i in own])[back]


def _best_of(per_class: int, without_date: int, counts: bool) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """Of some queries and people of a block: each query's likeliest people by class, or how many pairs were scored for that.

    The k best by bound of each class are scored first. Their least score is one that k people reach, so those whose bound is below it
    can't be among the k best; the others are scored. Scores are not rounded here, and bounds and scores are rounded apart in the last
    digits: people within 2e-9 of the k-th stay, of those with equal scores the k of the smallest ids.
    """

    def run(queries: pd.DataFrame, people: pd.DataFrame) -> pd.DataFrame:
        found, tried, latest = [], 0, (None, None)
        if len(queries) and len(people):
            first, last = _Names(people, "__f"), _Names(people, "__l")
            ids, birth = people["person_id"].to_numpy(), people["__b"].to_numpy(object)
            known = (first.at >= 0) & (last.at >= 0)
            births = {b: birth == b for b in queries["__b"].dropna().unique()}
            for q in queries.sort_values("__l").to_dict("records"):
                f, name = q["__f"], q["__l"]
                scorable = known if isinstance(f, str) and isinstance(name, str) else np.zeros(len(ids), bool)
                if scorable.any():
                    if latest[0] != name:
                        latest = name, last.bound(name)
                    bound = 0.4 * first.bound(f)[first.at] + 0.6 * latest[1][last.at]
                score = lambda at: 0.4 * first.similar(f, at) + 0.6 * last.similar(name, at)  # noqa: B023, E731
                dated = births.get(q["__b"])
                for valid, own in ((False, np.ones(len(ids), bool)),) if dated is None else ((True, dated), (False, ~dated)):
                    k = without_date if not isinstance(q["__b"], str) else per_class
                    at = np.flatnonzero(own & scorable)
                    if short := len(at) < k:
                        none = np.flatnonzero(own & ~scorable)
                        none = none[np.argsort(ids[none], kind="stable")[:k]]
                    elif len(at) > k:
                        top = at[np.argpartition(-bound[at], k - 1)[:k]]
                        tried += k
                        at = at[bound[at] >= score(top).min() - 2e-9]
                    s = score(at) if len(at) else np.zeros(0)
                    tried += len(at)
                    order = np.lexsort((ids[at], -s))
                    at, s = at[order], s[order]
                    if not short:
                        start = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
                        nth = np.arange(len(s)) - np.repeat(start, np.diff(np.r_[start, len(s)]))
                        keep = (nth < k) & (s >= s[k - 1] - 2e-9)
                        at, s = at[keep], s[keep]
                    else:
                        at, s = np.r_[at, none], np.r_[s, np.full(len(none), np.nan)]
                    if not counts:
                        found.append(pd.DataFrame({"query_id": q["query_id"], "person_id": ids[at], "date_valid": valid, "score": s, "most": k}))
        if counts:
            return pd.DataFrame({"scored": [tried]})
        return pd.concat(found) if found else pd.DataFrame(columns=["query_id", "person_id", "date_valid", "score", "most"])

    return run


def _matched(queries: DataFrame, people: DataFrame, block: str, first: str, last: str, birth: str, per_class: int, without_date: int, counts: bool) -> DataFrame:
    """_best_of() every part of a block's queries and every part of its people: each pair of the block meets once, in a group of bounded size."""
    from ..functions.scalars import normal_name

    def named(df: DataFrame, key: str) -> DataFrame:
        return df.where(F.col(block).isNotNull()).select(key, block, normal_name(F.col(first)).alias("__f"), normal_name(F.col(last)).alias("__l"), F.col(birth).cast("string").alias("__b"))

    n = lambda df, name, most: df.groupBy(block).agg(F.ceil(F.count("*") / most).cast("int").alias(name))
    sizes = n(queries, "__qs", QUERIES_AT_ONCE).join(n(people, "__ps", PEOPLE_AT_ONCE), block)
    part = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    # a few rows become very many pairs: more tasks than there are cores, however small the tables
    keys, tasks = (block, "__q", "__p"), 4 * queries.sparkSession.sparkContext.defaultParallelism
    asked = named(queries, "query_id").join(sizes, block).withColumn("__q", part("query_id", "__qs")).withColumn("__p", every("__ps")).repartition(tasks, *keys)
    own = named(people, "person_id").join(sizes, block).withColumn("__p", part("person_id", "__ps")).withColumn("__q", every("__qs")).repartition(tasks, *keys)
    own = own.select(*(F.col(c).alias(c) for c in own.columns if c not in ("__qs", "__ps")))  # columns of its own, also where queries are people
    asked = asked.select(*(F.col(c).alias(c) for c in asked.columns if c not in ("__qs", "__ps")))
    kind = {k: df.schema[k].dataType.simpleString() for df, k in ((queries, "query_id"), (people, "person_id"))}
    schema = "scored long" if counts else f"query_id {kind['query_id']}, person_id {kind['person_id']}, date_valid boolean, score double, most int"
    return asked.groupBy(*keys).cogroup(own.groupBy(*keys)).applyInPandas(_best_of(per_class, without_date, counts), schema)


def fuzzy_candidates(queries: DataFrame, people: DataFrame, block: str, first: str, last: str, birth: str, per_class: int = 5, without_date: int = 10) -> DataFrame:
    """For each query (query_id, block, first, last, birth) the likeliest people (person_id, ...) of its block.

    Score: 0.4 first name + 0.6 last name, names compared without case and accents. Five with the birth date and five without, or ten where the
    query has none. The blocking key is an equi-join; all pairs of a block are bounded in arrays, only those that can be among the best are scored.
    """
    found = _matched(queries, people, block, first, last, birth, per_class, without_date, False).withColumn("score", F.round("score", 9))
    w = Window.partitionBy("query_id", "date_valid").orderBy(F.desc_nulls_last("score"), "person_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.col("most")).select("query_id", "person_id", "date_valid", "score", "rank")


def fuzzy_pruning(queries: DataFrame, people: DataFrame, block: str, first: str, last: str, birth: str, per_class: int = 5, without_date: int = 10) -> DataFrame:
    """J17, one row: pairs of the blocks, and how many of them are scored by fuzzy_candidates(), first ones counted twice."""
    tried = _matched(queries, people, block, first, last, birth, per_class, without_date, True)
    both = queries.groupBy(block).agg(F.count("*").alias("__q")).join(people.groupBy(block).agg(F.count("*").alias("__p")), block)
    none = F.lit(0).cast("long")
    pairs = both.agg(F.coalesce(F.sum(F.col("__q") * F.col("__p")), none).alias("pairs"))
    return pairs.crossJoin(tried.agg(F.coalesce(F.sum("scored"), none).alias("scored"))).select("pairs", "scored")
