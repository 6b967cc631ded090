"""Embedding near-duplicates by a robust-pruned flat graph.

Vectors are dealt to their nearest clusters, several each, so that shards overlap. In each shard a flat graph is built: every vector keeps
those near neighbours that none of the kept ones covers (robust pruning). Searches start at the shard's medoids and the query's own place,
go greedily to the query's surroundings, and expand from every vector in range until no new one is met; cosines are computed for the
vectors that a search meets. The graphs of all shards together are one, by the vectors that they share: a query goes on into each shard
that a vector in its range is also in. Links are counted where they are found, a pair in one shard only, so no pair is ever a row. Recall
is measured against brute force.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, drop_staged, join_hot, read_table, staged

#: kind "n": vec_id q has n linked classes of `copies` rows; "edge": q and x are in one component; "go": q has still to be searched in shard s, from x on.
FOUND = "kind string, q long, x long, s long, n long, copies long"
PAIRS = 500_000


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type = np.float64) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), kind).reshape(len(flat), -1)


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def _normalised(batches):
    """(vec_id, vec): unit vectors in double precision; null where there is none. Scaled first, so that no square over- or underflows."""
    for batch in batches:
        rows, ids = batch["embedding"], batch["vec_id"].to_numpy(zero_copy_only=False)
        size = pc.fill_null(pc.list_value_length(rows), 0).to_numpy()
        known = np.asarray(pc.is_valid(rows)) & np.asarray(pc.is_valid(batch["vec_id"])) & (size > 0)
        flat = np.asarray(pc.fill_null(rows.filter(pa.array(known)).flatten().cast(pa.float64()), np.nan))
        begin = np.cumsum(size * known) - size * known
        out: list = [None] * len(ids)
        for d in np.unique(size[known]).tolist():
            at = np.flatnonzero(known & (size == d))
            v = flat[begin[at][:, None] + np.arange(d)]
            largest = np.abs(v).max(1)
            good = np.isfinite(v).all(1) & (largest > 0)
            v = v[good] / largest[good][:, None]
            v /= np.sqrt((v * v).sum(1))[:, None]
            for i, x in zip(at[good].tolist(), v, strict=True):
                out[i] = x
        yield pa.record_batch([batch["vec_id"], pa.array(out, pa.list_(pa.float64()))], names=["vec_id", "vec"])


def pruned_graph(vectors: np.ndarray, degree: int, alpha: float, near: int, seed: int) -> np.ndarray:
    """Adjacency (rows padded with the vector itself): from the nearest `near` and a few far vectors, those that robust pruning keeps."""
    m, sims = len(vectors), vectors @ vectors.T
    rows = np.arange(m)[:, None]
    c = min(near, m)
    nearest = np.argpartition(-sims, c - 1, axis=1)[:, :c]
    far = np.random.default_rng(seed).integers(0, m, (m, min(16, m)))
    cand = np.concatenate([nearest, far], 1)
    cand = cand[rows, np.argsort(-sims[rows, cand], axis=1, kind="stable")]
    gap = 1 - sims[rows, cand]
    alive = cand != rows
    adjacent = np.repeat(rows, degree, 1)
    for r in range(degree):
        at = alive.argmax(1)
        has = alive[rows[:, 0], at]
        if not has.any():
            break
        p = cand[rows[:, 0], at]
        adjacent[has, r] = p[has]
        alive &= ~((alpha * (1 - sims[p[:, None], cand]) <= gap) & has[:, None])
        alive[rows[:, 0], at] = False
    return adjacent


def range_search(index: np.ndarray, adjacent: np.ndarray, query: np.ndarray, starts: np.ndarray, own: np.ndarray, threshold: float, steps: int, width: int = 8) -> np.ndarray:
    """For each query the indexed vectors in range that the search meets, as a boolean matrix.

    Searches start at `starts`, and at the query's own place in the graph or a vector known to be in range (own; -1 where there is
    none). Greedy steps keep the `width` best vectors met and end when all of them are expanded.
    """
    n, m = len(query), len(index)
    seen, close = np.zeros((n, m), bool), np.zeros((n, m), bool)
    if n == 0:
        return close
    every = np.arange(n)[:, None]
    ids = np.concatenate([np.tile(starts, (n, 1)), np.where(own >= 0, own, starts[0])[:, None]], 1)
    sims = np.einsum("nd,nkd->nk", query, index[ids])
    seen[every, ids] = True
    close[every, ids] = sims >= threshold
    sims[(ids[:, -1:] == ids[:, :-1]).any(1), -1] = -2  # the own place is a start as well
    done = sims == -2
    for _ in range(steps):
        best = np.where(done, -2.0, sims)
        at = best.argmax(1)
        live = np.flatnonzero(best[every[:, 0], at] > -2)
        if not len(live):
            break
        done[live, at[live]] = True
        new = adjacent[ids[live, at[live]]]
        fresh = ~seen[live[:, None], new]
        seen[live[:, None], new] = True
        own_sims = np.where(fresh, np.einsum("nd,nkd->nk", query[live], index[new]), -2.0)
        r, c = np.nonzero(own_sims >= threshold)
        close[live[r], new[r, c]] = True
        pad = np.full((n, new.shape[1]), -2.0)
        pad[live] = own_sims
        more = np.zeros((n, new.shape[1]), ids.dtype)
        more[live] = new
        ids, sims, done = np.concatenate([ids, more], 1), np.concatenate([sims, pad], 1), np.concatenate([done, pad == -2], 1)
        top = np.argpartition(-sims, min(width, sims.shape[1] - 1), axis=1)[:, :width]
        ids, sims, done = ids[every, top], sims[every, top], done[every, top]
    # in range edges are followed both ways: a vector that is nobody's choice is met through its own
    a, b = np.repeat(np.arange(m), adjacent.shape[1]), adjacent.ravel()
    links = np.unique(np.concatenate([a * m + b, b * m + a]))
    to, begin = links % m, np.searchsorted(links, np.arange(m + 1) * m)
    q, x = np.nonzero(close)
    while len(q):  # expand whatever is in range
        next_q, next_x = [], []
        for i in range(0, len(q), 50_000):
            own_q, own_x = q[i : i + 50_000], x[i : i + 50_000]
            many = begin[own_x + 1] - begin[own_x]
            at = np.repeat(begin[own_x] - np.cumsum(many) + many, many) + np.arange(many.sum())
            pair = np.repeat(own_q, many) * m + to[at]
            pair = np.unique(pair[~seen.ravel()[pair]])
            seen.ravel()[pair] = True
            for j in range(0, len(pair), PAIRS):
                p, y = pair[j : j + PAIRS] // m, pair[j : j + PAIRS] % m
                hit = np.einsum("nd,nd->n", query[p], index[y]) >= threshold
                close[p[hit], y[hit]] = True
                next_q.append(p[hit]), next_x.append(y[hit])
        q, x = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (next_q, next_x))
    return close


def _component_edges(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links between queries (rows) and indexed vectors (columns), as few (row, column) as connect what they connect."""
    rows, cols = [], []
    free_q, free_x = close.any(1), np.ones(close.shape[1], bool)
    for q in np.flatnonzero(free_q).tolist():
        if not free_q[q]:
            continue
        todo = [q]
        free_q[q] = False
        while todo:
            q = todo.pop()
            new = np.flatnonzero(close[q] & free_x)
            free_x[new] = False
            rows += [q] * len(new)
            cols += new.tolist()
            for x in new.tolist():
                met = np.flatnonzero(close[:, x] & free_q)
                free_q[met] = False
                rows += met.tolist()
                cols += [x] * len(met)
                todo += met.tolist()
    return np.array(rows, np.int64), np.array(cols, np.int64)


def _among(shards: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """For each shard of each row (n x a) whether it is in the row's list (n x b)."""
    return (shards[:, :, None] == lists[:, None, :]).any(2)


def _padded(column: pa.ChunkedArray, fill: int) -> np.ndarray:
    """Lists of shards as rows of one length."""
    rows = column.to_pylist()
    out = np.full((len(rows), max(map(len, rows), default=0) or 1), fill, np.int64)
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return out


def _search(threshold: float, degree: int, alpha: float, near: int, steps: int):
    """One part of a shard, and those that ask it: its own vectors, those of another part, or queries from other shards.

    Columns: own (indexed here), asks, near (a vector's shards), had (shards in which a query was searched before; empty for a shard's
    own vectors), new (shards that it is searched in now), via (a vector in range; null: itself), whole (the shard has one part).
    """

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        own, asks, whole = (table[c].to_numpy() for c in ("own", "asks", "whole"))
        vectors, node, copies = _matrix(table["vec"]), table["node"].to_numpy(), table["copies"].to_numpy()
        shards, had, new = (_padded(table[c], fill) for c, fill in (("near", -1), ("had", -2), ("new", -3)))
        via = pc.fill_null(table["via"], -1).to_numpy() if table["via"].type != pa.null() else np.full(len(node), -1)
        ix = np.flatnonzero(own)[np.argsort(node[own], kind="stable")]
        qs = np.flatnonzero(asks)[np.argsort(node[asks], kind="stable")]
        out: dict[str, list] = {"kind": [], "q": [], "x": [], "s": [], "n": [], "copies": []}

        def emit(kind: str, q, x=None, s=None, n=None, copies=None) -> None:
            for c, v in (("q", q), ("x", x), ("s", s), ("n", n), ("copies", copies)):
                out[c].append(pa.nulls(len(q), pa.int64()) if v is None else pa.array(v, pa.int64()))
            out["kind"].append(pa.array([kind] * len(q), pa.string()))

        if len(ix) and len(qs):
            index, query, m = vectors[ix], vectors[qs], len(ix)
            mine = bool(own[qs].all())  # the part asks itself
            if not mine and not whole.all() or m < 3:  # no graph holds both parts of a shard: they are compared completely
                close = np.concatenate([query[a : a + 1000] @ index.T >= threshold for a in range(0, len(qs), 1000)])
            else:
                adjacent = pruned_graph(index, min(degree, m - 1), alpha, near, int(node[ix[0]]) & 0xFFFF)
                middle = index @ index.mean(0)
                starts = np.unique(np.r_[middle.argmax(), np.linspace(0, m - 1, min(4, m)).astype(int)])
                if mine:
                    place = np.arange(m)
                else:
                    place = np.minimum(np.searchsorted(node[ix], via[qs]), m - 1)
                    place = np.where(node[ix][place] == via[qs], place, -1)
                close = range_search(index, adjacent, query, starts, place, threshold, steps)
                if mine:
                    close |= close.T
            close &= node[qs][:, None] != node[ix][None, :]
            a, b = _component_edges(close)
            emit("edge", node[qs[a]], node[ix[b]])
            n, weight = np.zeros(len(qs), np.int64), np.zeros(len(qs), np.int64)
            go: list = []
            q, x = np.nonzero(close)
            for i in range(0, len(q), PAIRS):
                a, b = qs[q[i : i + PAIRS]], ix[x[i : i + PAIRS]]
                apart = ~_among(had[a], shards[b]).any(1)
                # of the shards in which a query meets a vector now, the first one counts the pair
                first = np.where(_among(new[a], shards[b]), new[a], np.iinfo(np.int64).max).min(1)
                counts = apart & (first == shard)
                n += np.bincount(q[i : i + PAIRS], counts, len(qs)).astype(np.int64)
                weight += np.bincount(q[i : i + PAIRS], counts * copies[b], len(qs)).astype(np.int64)
                # on into the shards of what is in range; and what is met from outside looks back
                for asker, at, known, there in ((a, b, np.concatenate([had[a], new[a]], 1), shards[b]), (b, a, shards[b], shards[a])):
                    r, c = np.nonzero(~_among(there, known) & (there >= 0))
                    go.append(np.stack([node[asker[r]], there[r, c], node[at[r]]], 1))
                go = [np.concatenate(go)]
                go = [go[0][np.unique(go[0][:, :2], axis=0, return_index=True)[1]]]
            has = np.flatnonzero(n)
            emit("n", node[qs[has]], n=n[has], copies=weight[has])
            if go:
                emit("go", go[0][:, 0], x=go[0][:, 2], s=go[0][:, 1])
        cols = {c: pa.concat_arrays(v) if v else pa.array([], pa.string() if c == "kind" else pa.int64()) for c, v in out.items()}
        return pa.table(cols)

    return run


def _centres(vectors: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means over a sample."""
    rng = np.random.default_rng(seed)
    c = vectors[rng.choice(len(vectors), k, replace=False)]
    for _ in range(rounds):
        near = (vectors @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, vectors)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.where(size > 0, size, 1), c)
    return c


def nearest_centres(v: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each row of v, a thousand rows at a time."""
    parts = [np.argsort(-(v[a : a + 1000] @ centres.T), axis=1, kind="stable")[:, :n] for a in range(0, len(v), 1000)]
    return np.concatenate(parts) if parts else np.zeros((0, min(n, len(centres))), np.int64)


def _nearest(centres: np.ndarray, n: int) -> object:
    def run(batches):
        for batch in batches:
            v = _matrix(batch["vec"])
            near = nearest_centres(v, centres, n)
            yield pa.record_batch([batch["node"], batch["vec"], batch["copies"], _lists(near.astype(np.int64))], names=["node", "vec", "copies", "near"])

    return run


def _finer(key: tuple, table: pa.Table) -> pa.Table:
    """The centres of a cluster's own clusters, from a sample of it."""
    v, k = _matrix(table["vec"]), table["k"][0].as_py()
    return pa.table({"cluster": pa.array([key[0].as_py()], pa.int64()), "centres": pa.array([_centres(v, min(k, len(v))).tobytes()], pa.binary())})


def _finer_nearest(n: int):
    """Rows sorted by cluster, its centres first -> (node, shard): each vector in its n nearest clusters within the cluster."""

    def run(batches):
        cluster, centres = None, None
        for batch in batches:
            key = batch["cluster"].to_numpy()
            edges = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]).tolist() if len(key) else []
            for a, b in zip(edges, [*edges[1:], len(key)], strict=True):
                part = batch.slice(a, b - a)
                if key[a] != cluster:
                    cluster = int(key[a])
                    centres = np.frombuffer(part["centres"][0].as_buffer(), np.float64) if part["centres"][0].is_valid else None
                    part = part.slice(1 if centres is not None else 0)
                if not len(part):
                    continue
                v = _matrix(part["vec"])
                if centres is None:  # a small cluster is a shard as it is
                    sub = np.zeros((len(v), 1), np.int64)
                else:
                    c = centres.reshape(-1, v.shape[1])
                    sub = 1 + nearest_centres(v, c, n)
                node = np.repeat(part["node"].to_numpy(), sub.shape[1])
                yield pa.record_batch([pa.array(node), pa.array((cluster << 24) + sub.ravel())], names=["node", "shard"])

    return run


def dealt_vectors(classes: DataFrame, n: int, n_near: int, shard_rows: int, sample: int) -> DataFrame:
    """classes (node, vec, copies) -> also near: the shards of each vector, those of its n_near nearest clusters.

    Cluster centres are fitted on `sample` vectors, an eighth as many at most. Where more shards are needed, each cluster that is too
    large gets centres of its own, fitted on a sample of it in a task of its own, and its vectors go to their two nearest ones.
    """
    picked = classes.orderBy(F.xxhash64("node"), "node").limit(sample).toArrow()
    vectors = _matrix(picked["vec"])
    k = max(1, min(n // shard_rows, len(vectors) // 8))
    n_near = min(n_near, k)
    kind = "node long, vec array<double>, copies long, near array<long>"
    dealt = staged(classes.mapInArrow(_nearest(_centres(vectors, k), n_near), kind), "shards")
    if n // shard_rows <= k:
        return dealt
    members = dealt.select("node", "vec", F.explode("near").alias("cluster"))
    sizes = members.groupBy("cluster").agg(F.count("*").alias("size")).where(F.col("size") > 2 * n_near * shard_rows)
    sizes = staged(sizes, "sizes")  # a row for each of the centres at most
    per = max(sample // 8, 64)
    drawn = members.join(F.broadcast(sizes), "cluster").where(F.pmod(F.xxhash64("node", F.lit(3)), F.greatest(F.lit(1), F.floor(F.col("size") / per))) == 0)
    drawn = drawn.select("cluster", "vec", F.least(F.ceil(F.col("size") / (n_near * shard_rows)), F.lit(per // 2)).cast("int").alias("k"))
    finer = drawn.groupBy("cluster").applyInArrow(_finer, "cluster long, centres binary")
    null = F.lit(None)
    rows = finer.select("cluster", null.cast("long").alias("node"), null.cast("array<double>").alias("vec"), "centres").unionByName(members.select("cluster", "node", "vec", null.cast("binary").alias("centres")))
    shards = rows.repartition("cluster").sortWithinPartitions("cluster", F.col("centres").isNull()).mapInArrow(_finer_nearest(2), "node long, shard long")
    near = shards.groupBy("node").agg(F.collect_list("shard").alias("near"))
    return staged(dealt.drop("near").join(near, "node"), "shards")


def _brute(ids: np.ndarray, vectors: np.ndarray, threshold: float):
    def run(batches):
        for batch in batches:
            v, node = _matrix(batch["vec"]), batch["node"].to_numpy()
            many = ((vectors @ v.T >= threshold) & (ids[:, None] != node[None, :])).sum(1) if len(v) else np.zeros(len(ids), int)
            yield pa.record_batch([pa.array(ids[many > 0]), pa.array(many[many > 0])], names=["q", "n"])

    return run


def audit_counts(classes: DataFrame, threshold: float, audit: int, linked: int = 200, blocks: int = 16) -> tuple[DataFrame, int]:
    """(q, n): how many vectors are in range of q, by comparison with every vector, for those of the queries drawn that have one.

    Queries are drawn by hash in blocks of `audit`, until `linked` have a vector in range, the vectors end, or all blocks are drawn.
    """
    spark, kind = classes.sparkSession, "q long, n long"
    mark = F.xxhash64("node", F.lit(1))
    last, found = None, []
    for _ in range(blocks):
        rest = classes if last is None else classes.where((mark > last[0]) | ((mark == last[0]) & (F.col("node") > last[1])))
        asked = rest.select("node", "vec", mark.alias("mark")).orderBy("mark", "node").limit(audit).toArrow()
        if not len(asked):
            break
        ids = asked["node"].to_numpy()
        last = asked["mark"][-1].as_py(), asked["node"][-1].as_py()
        found += classes.mapInArrow(_brute(ids, _matrix(asked["vec"]), threshold), kind).groupBy("q").agg(F.sum("n").alias("n")).collect()
        if len(ids) < audit or len(found) >= linked:
            break
    return spark.createDataFrame([(r.q, r.n) for r in found], kind), len(found)


def audited(true: DataFrame, counts: DataFrame) -> float:
    """The mean over audited queries of the share of their true links that counts (q, n) has: a large group counts no more than a pair."""
    met = counts.join(F.broadcast(true.select("q")), "q", "left_semi").select("q", F.col("n").alias("met"))
    share = F.least(F.coalesce("met", F.lit(0)), "n") / F.col("n")
    return true.join(met, "q", "left").agg(F.avg(share)).first()[0]


def near_links(classes: DataFrame, threshold: float, overlap: int = 4, shard_rows: int = 600, most_rows: int = 2800, sample: int = 20_000, degree: int = 24, alpha: float = 1.2, near: int = 64, steps: int = 64, audit: int = 400, least_recall: float = 0.97, contract: float = 0.9) -> tuple[DataFrame, DataFrame, float | None]:
    """classes (node, vec: unit vectors of one length, copies) -> counts (q, n, copies), edges (a, b) and the recall measured.

    counts: how many other classes, and rows of them, have a cosine >= threshold with q; q without any isn't there. edges connect what
    links connect. sample: vectors that the cluster centres are fitted on. A shard of more than most_rows is cut into parts, which are
    compared with each other completely. audit: queries of a block that are also compared with every vector (see audit_counts); below
    least_recall the search is done again with more shards for each vector, steps and candidates, three times at most, and if recall
    is below `contract` even then, that is an error. Where no query drawn has a link, recall is not measured (None).
    """
    spark = classes.sparkSession
    n = classes.count()
    if n < 2:
        return spark.createDataFrame([], "q long, n long, copies long"), spark.createDataFrame([], "a long, b long"), None
    true, measured = audit_counts(classes, threshold, audit)
    recall, part = None, F.pmod(F.xxhash64("node", "shard"), F.col("parts")).cast("int")
    nothing = F.array().cast("array<long>")
    for attempt in range(3):
        dealt = dealt_vectors(classes, n, overlap + 2 * attempt, shard_rows, sample)
        members = dealt.select("node", "vec", "copies", "near", F.explode("near").alias("shard"))
        parts = staged(members.groupBy("shard").agg(F.ceil(F.count("*") / most_rows).cast("int").alias("parts")), "parts")
        search = _search(threshold, degree, alpha, near << attempt, steps << attempt)
        cols = ["shard", "i", "j", "node", "vec", "copies", "near", "had", "new", F.lit(None).cast("long").alias("via"), "own", "asks", "whole"]
        # a row for each pair of an indexed part and a part of queries that it is in on either side
        placed = members.join(parts, "shard").withColumn("mine", part).withColumn("whole", F.col("parts") == 1).withColumns({"had": nothing, "new": F.col("near")})
        both = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        as_index = both.withColumns({"i": F.col("mine"), "j": F.col("other"), "own": F.lit(True), "asks": F.col("mine") == F.col("other")}).select(*cols)
        as_query = both.where("mine != other").withColumns({"i": F.col("other"), "j": F.col("mine"), "own": F.lit(False), "asks": F.lit(True)}).select(*cols)
        found = staged(as_index.unionByName(as_query).groupBy("shard", "i", "j").applyInArrow(search, FOUND), "found")
        every, visited = [found], staged(dealt.select("node", F.col("near").alias("had")), "visited")
        while True:  # on into shards that the query isn't in
            go = every[-1].where("kind = 'go'").groupBy(F.col("q").alias("node"), F.col("s").alias("shard")).agg(F.min("x").alias("via"))
            go = staged(go.join(visited, "node").where(~F.array_contains("had", F.col("shard"))), "go")
            if go.isEmpty():
                break
            new = staged(go.groupBy("node").agg(F.array_sort(F.collect_list("shard")).alias("new")), "new")
            asking = go.join(new, "node").join(dealt.select("node", "vec", "copies", "near"), "node").join(parts, "shard").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            asking = asking.withColumn("turn", F.pmod(F.xxhash64("node", F.lit(4)), F.lit(1 << 10)))
            many = staged(asking.groupBy("shard", "i").agg(F.ceil(F.count("*") / most_rows).cast("int").alias("copies_of")), "asking")
            asking = asking.join(many, ["shard", "i"]).withColumn("j", F.pmod("turn", "copies_of").cast("int")).withColumns({"own": F.lit(False), "asks": F.lit(True), "whole": F.col("parts") == 1})
            held = placed.withColumn("i", F.col("mine")).join(many, ["shard", "i"]).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("copies_of") - 1))).withColumns({"own": F.lit(True), "asks": F.lit(False), "new": nothing})
            tasks = held.select(*cols).unionByName(asking.select(*(F.col("via") if i == 9 else c for i, c in enumerate(cols))))
            every.append(staged(tasks.groupBy("shard", "i", "j").applyInArrow(search, FOUND), "found"))
            after = staged(visited.join(new, "node", "left").select("node", F.when(F.col("new").isNull(), F.col("had")).otherwise(F.concat("had", "new")).alias("had")), "visited")
            drop_staged(visited, go, new, many)
            visited = after
        found = spark.read.schema(every[0].schema).parquet(*(x.staged_at for x in every))
        counts = staged(found.where("kind = 'n'").groupBy("q").agg(F.sum("n").alias("n"), F.sum("copies").alias("copies")), "links")
        recall = audited(true, counts) if measured else None
        if recall is None or recall >= least_recall:
            break
        drop_staged(*every, counts)
    if recall is not None and recall < contract:
        raise RuntimeError(f"near_links: recall {recall:.3f} on {measured} queries with links, less than {contract}")
    edges = staged(found.where("kind = 'edge'").select(F.col("q").alias("a"), F.col("x").alias("b")), "edges")
    drop_staged(*every, dealt, visited)
    return counts, edges, recall


def embedding_groups(vectors: DataFrame, threshold: float = 0.95, **options) -> DataFrame:
    """vectors (vec_id, embedding, ...) -> vec_id, n_links, component_id, kept, recall, one row for each row.

    Links are pairs with cosine >= threshold in double precision. Equal vectors are one class, counted but never paired. Vectors that
    are null, zero, hold null or non-finite components, are not of the most common length, or have a null vec_id link with nothing
    and are their own component. component_id: the smallest vec_id reachable. recall: as measured on the audit's queries, null where none
    of them has a link. Unlike vectors that share a vec_id are each searched and have their own links and component. Other columns
    aren't read.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = staged(rows.mapInArrow(_normalised, "vec_id long, vec array<double>"), "vectors")
    length = rows.where("vec is not null").groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.select("vec_id", F.when(F.size("vec") == (length["d"] if length else 0), F.col("vec")).alias("vec"))
    rows = rows.withColumns({"k1": F.xxhash64("vec"), "k2": F.xxhash64(F.lit(11), "vec")})
    classes = rows.where("vec is not null").groupBy("k1", "k2").agg(F.min("vec_id").alias("smallest"), F.first("vec").alias("vec"), F.count("*").alias("copies"))
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")  # numbered once, when it is written
    counts, edges, recall = near_links(classes.select("node", "vec", "copies"), threshold, **options)
    groups = components(edges)
    known = classes.select("k1", "k2", "node", "smallest", "copies").join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = known.join(counts.select(F.col("q").alias("node"), F.col("copies").alias("others")), "node", "left")
    known = staged(known.select("k1", "k2", "smallest", "copies", "component", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links")), "known")
    smallest = staged(known.groupBy("component").agg(F.min("smallest").alias("component_id"), F.count("*").alias("many")), "smallest")
    final = staged(join_hot(known, smallest, ["component"], "many").select("k1", "k2", "copies", "links", "component_id"), "final")
    valid = rows.where("vec is not null").select("vec_id", "k1", "k2")
    out = join_hot(valid, final, ["k1", "k2"], "copies").select("vec_id", F.col("links").alias("n_links"), "component_id")
    out = out.unionByName(rows.where("vec is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    drop_staged(classes, counts, edges, known, smallest)
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"), F.lit(recall).cast("double").alias("recall"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(read_table(spark, sf_dir, "embeddings"))
