"""Weights of forecasts on the simplex that minimise a scaled mean absolute error (M18, M20, M21), from sums that Spark forms.

The error is convex and piecewise linear in the weights. At a vector of weights its value and a subgradient are sums over the rows; each
such pair bounds the error from below everywhere. Each pass over the rows evaluates a few vectors for every scope at once, those where the
bounds so far leave most room; it ends when no vector of a grid can be better than the best one found.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

#: Vectors evaluated in a pass, passes at most, and points of the grid at most.
TRIED, PASSES, POINTS = 10, 9, 21_000


def simplex_grid(k: int, step: float = 0.005) -> np.ndarray:
    """Vectors of k multiples of 1/n that sum up to 1: of `step`, or as fine as POINTS allow."""
    if k == 1:
        return np.ones((1, 1))
    n = round(1 / step)
    count = lambda n: int(np.prod([(n + i) / i for i in range(1, k)]).round())
    while n > 1 and count(n) > POINTS:
        n -= 1
    bars = np.array(list(combinations(range(n + k - 1), k - 1)), int).reshape(-1, k - 1)
    edges = np.hstack([np.full((len(bars), 1), -1), bars, np.full((len(bars), 1), n + k - 1)])
    return (np.diff(edges, axis=1) - 1) / n


class Search:
    """What is known of one scope's error, and what to try next."""

    def __init__(self, grid: np.ndarray):
        self.points, self.low = grid, np.full(len(grid), -np.inf)
        self.w, self.error, self.width, self.cuts = None, np.inf, 0.5, []

    def learn(self, w: np.ndarray, error: float, slope: np.ndarray) -> None:
        if error < self.error:
            self.w, self.error = w, error
        self.cuts.append((w, error, slope))
        self.low = np.maximum(self.low, error + (self.points - w) @ slope)

    def refine(self, k: int, fine: bool) -> None:
        """Where the grid is coarse, points around the best vector join it, closer each time."""
        if fine:
            return
        near = np.random.default_rng(k).dirichlet(np.ones(k), 3000)
        self.width /= 2
        near = self.w + self.width * (near - self.w)
        low = np.max([e + (near - w) @ s for w, e, s in self.cuts], axis=0)
        self.points, self.low = np.vstack([self.points, near]), np.append(self.low, low)

    def next(self, n: int) -> np.ndarray:
        """The point of the least bound, and others that can still be better, far from each other."""
        open_ = np.flatnonzero(self.low < self.error * (1 - 1e-9) - 1e-12)
        if not len(open_):
            return open_.reshape(0, self.points.shape[1])
        own = self.points[open_[np.argsort(self.low[open_], kind="stable")[:3000]]]
        out, far = [own[0]], np.abs(own - own[0]).sum(1)
        while len(out) < n and far.max() > 0:
            out.append(own[far.argmax()])
            far = np.minimum(far, np.abs(own - out[-1]).sum(1))
        return np.array(out)

    def gap(self) -> float:
        """How much better than the best one a point can be at most."""
        return float(max(0.0, self.error - self.low.min()))


def on_scope(scope: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in scope], F.lit(True))


def least_error(df: DataFrame, scope: list[str], y: str, models: list[str], scale: Column | None = None, naive: str | None = None, least_rows: int = 20, step: float = 0.005) -> DataFrame:
    """By scope: model, weight, and n, error, gap and passes.

    error is the mean of |weighted forecast - y| / scale (sMAE, with the site's mean as scale); with a naive forecast it is divided by
    the scope's mean error of that (MASE), in which the scope's mean of y stands for missing ones.
    Rows that lack y or a model don't count; a scope of fewer than least_rows rows has equal weights and a null error. With up to three
    models the weights are the best ones of the grid of `step` if gap is 0, as it nearly always is; with more models the grid is
    coarser and is made finer around the best vector. The driver holds some vectors for each scope, so scopes may be thousands.
    """
    spark, k = df.sparkSession, len(models)
    part = F.lit(1.0) if scale is None else 1.0 / scale
    rows = df.select(*scope, F.col(y).cast("double").alias("__y"), part.cast("double").alias("__c"), *(F.col(m).cast("double").alias(f"__m{i}") for i, m in enumerate(models)), F.col(naive or y).cast("double").alias("__naive"))
    own = [f"__m{i}" for i in range(k)]
    rows = staged(rows.withColumn("__known", reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in ("__y", "__c", *own)])), "weights")
    fields = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in scope]

    def evaluated(known: DataFrame, w: list[list[Column]]) -> list:
        """Each scope's number of rows, and for each vector its error and the slopes of the error."""
        y = F.col("__y")
        plain = F.abs(F.col("__naive") - y)  # rows of a missing naive forecast follow once the mean of y is known
        aggs = [F.count(F.when(F.col("__known"), 1)).alias("n"), F.avg(F.when(F.col("__known"), y)).alias("mean"), F.sum(F.when(F.col("__known"), plain)).alias("naive"), F.count(F.when(F.col("__known"), plain)).alias("n_naive")]
        for c, each in enumerate(w):
            gap = reduce(lambda a, b: a + b, [x * F.col(m) for x, m in zip(each, own, strict=True)]) - y
            aggs += [F.avg(F.abs(gap) * F.col("__c")).alias(f"e{c}"), *(F.avg(F.signum(gap) * F.col(m) * F.col("__c")).alias(f"s{c}_{i}") for i, m in enumerate(own))]
        return known.groupBy(*scope).agg(*aggs).collect()

    grid = simplex_grid(k, step)
    fine = len(grid) > 1 and np.isclose(grid[grid > 0].min(), step)
    first = np.vstack([np.eye(k), np.full((1, k), 1 / k)])
    if fine:  # the nearest point of the grid
        first[-1] = grid[np.abs(grid - first[-1]).sum(1).argmin()]
    state: dict[tuple, Search] = {}
    facts, passes = {}, 1
    for r in evaluated(rows.withColumn("__c", F.when(F.col("__known"), F.col("__c"))), [[F.lit(float(x)) for x in w] for w in first]):
        key = tuple(r[c] for c in scope)
        state[key], facts[key] = Search(grid), r
        for c, w in enumerate(first) if r["n"] else ():
            state[key].learn(w, r[f"e{c}"], np.array([r[f"s{c}_{i}"] for i in range(k)]))
    known = rows.where("__known")
    live = {key: s for key, s in state.items() if facts[key]["n"] >= least_rows}
    while live and passes < PASSES:
        tried = {}
        for key, s in live.items():
            s.refine(k, fine)
            if len(w := s.next(TRIED)):
                tried[key] = w
        if not tried:
            break
        now = spark.createDataFrame([(*key, [float(x) for x in np.ravel(w)]) for key, w in tried.items()], ", ".join([*fields, "__w array<double>"]))
        both = known.alias("r").join(F.broadcast(now).alias("t"), on_scope(scope)).select(*(F.col(f"r.{c}") for c in known.columns), "__w")
        for r in evaluated(both, [[F.get("__w", F.lit(c * k + i)) for i in range(k)] for c in range(TRIED)]):
            key = tuple(r[c] for c in scope)
            for c, w in enumerate(tried[key]):
                live[key].learn(w, r[f"e{c}"], np.array([r[f"s{c}_{i}"] for i in range(k)]))
        passes += 1
        live = {key: live[key] for key in tried}
    divisor = dict.fromkeys(state, 1.0)
    if naive is not None:
        lost = known.where("__naive IS NULL").alias("r")
        means = spark.createDataFrame([(*key, r["mean"]) for key, r in facts.items() if r["n"]], ", ".join([*fields, "mean double"]))
        rest = lost.join(F.broadcast(means).alias("t"), on_scope(scope)).groupBy(*(F.col(f"r.{c}").alias(c) for c in scope)).agg(F.sum(F.abs(F.col("mean") - F.col("__y"))).alias("naive"), F.count("*").alias("n")) if any(r["n"] != r["n_naive"] for r in facts.values()) else None
        more = {tuple(r[c] for c in scope): r["naive"] for r in rest.collect()} if rest is not None else {}
        divisor = {key: max(((r["naive"] or 0.0) + (more.get(key) or 0.0)) / r["n"], 1e-6) if r["n"] else 1.0 for key, r in facts.items()}
    out = []
    for key, s in state.items():
        n, by = facts[key]["n"], divisor[key]
        w, error, gap = (s.w, float(s.error) / by, s.gap() / by) if n >= least_rows else (np.full(k, 1 / k), None, None)
        out += [(*key, m, float(x), n, error, gap, passes) for m, x in zip(models, w, strict=True)]
    return spark.createDataFrame(out, ", ".join([*fields, "model string, weight double, n long, error double, gap double, passes int"]))
