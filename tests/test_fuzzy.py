"""The pruned fuzzy match against scores of all pairs."""

import random

from pyspark.sql import functions as F

from refectory.operators import joins as J


def names(rng, n):
    parts = ["MAR", "IE", "JEAN", "LU", "CAS", "PAUL", "ANNA", "NA", "X", "O'", "-", "É", "00", "0000", "1"]
    return [rng.choice([None, "", *("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(30))]) for _ in range(n)]


def test_bounds_hold(spark):
    rng = random.Random(2)
    df = spark.createDataFrame(list(zip(names(rng, 4000), names(rng, 4000), strict=True)), "a string, b string").repartition(3)
    df = df.withColumns({"a_letters": J.letter_bits(F.col("a")), "b_letters": J.letter_bits(F.col("b"))})
    got = df.select("a", "b", J.similarity_bound("a", "b").alias("bound"), J.jaro_winkler("a", "b").alias("s")).collect()
    assert all((r.s is None) == (r.bound is None) and (r.s is None or r.s <= r.bound + 1e-12) for r in got)
    assert sum(r.bound < 0.6 for r in got if r.s is not None) > 200  # and they tell something


def test_candidates_are_the_best_of_all(spark):
    rng = random.Random(4)
    n = 900
    people = [(i, i % 3, f, name, rng.choice([None, 1, 2])) for i, (f, name) in enumerate(zip(names(rng, n), names(rng, n), strict=True))]
    queries = [(1000 + i, i % 4, f, name, rng.choice([None, 1, 2])) for i, (f, name) in enumerate(zip(names(rng, 60), names(rng, 60), strict=True))]
    q = spark.createDataFrame(queries, "query_id int, org int, f string, l string, b int")
    p = spark.createDataFrame(people, "person_id int, org int, f string, l string, b int")
    plain = lambda s: None if s is None else s.replace("É", "E")
    want = set()
    for qid, org, f, name, birth in queries:
        classes = {True: [], False: []}
        for pid, porg, pf, pl, pb in people:
            if porg == org:
                s = None if None in (f, name, pf, pl) else round(0.4 * J._similarity(plain(f), plain(pf)) + 0.6 * J._similarity(plain(name), plain(pl)), 9)
                classes[birth is not None and birth == pb].append((s is None, -(s or 0), pid, s))
        for valid, own in classes.items():
            want |= {(qid, pid, valid, s, i + 1) for i, (_, _, pid, s) in enumerate(sorted(own, key=lambda x: x[:3])[: 10 if birth is None else 5])}
    got = {tuple(r) for r in J.fuzzy_candidates(q, p, "org", "f", "l", "b").collect()}
    assert got == want
    n = J.fuzzy_pruning(q, p, "org", "f", "l", "b").first()
    assert n.pairs == sum(1 for x in queries for y in people if x[1] == y[1]) and n.scored < n.pairs


def test_parts_of_a_block_give_what_the_block_gives(spark, monkeypatch):
    """Every query meets every person of its block once, in groups of bounded size; equal names are told apart by id."""
    rng = random.Random(5)
    own = names(rng, 12)
    p = spark.createDataFrame([(i, i % 2, rng.choice(own), rng.choice(own), rng.choice([None, 1, 2])) for i in range(600)], "person_id int, org int, f string, l string, b int")
    q = p.where("person_id % 20 = 0").withColumnRenamed("person_id", "query_id")
    want = {tuple(r) for r in J.fuzzy_candidates(q, p, "org", "f", "l", "b").collect()}
    monkeypatch.setattr(J, "QUERIES_AT_ONCE", 4)
    monkeypatch.setattr(J, "PEOPLE_AT_ONCE", 50)
    assert {tuple(r) for r in J.fuzzy_candidates(q, p, "org", "f", "l", "b").collect()} == want
    assert J.fuzzy_pruning(q, p, "org", "f", "l", "b").first().pairs == 30 * 300
    assert "Window" not in J._matched(q, p, "org", "f", "l", "b", 5, 10, False)._jdf.queryExecution().executedPlan().toString()


def test_similarities_of_many_names_are_those_of_each():
    own = [x for x in names(random.Random(6), 1500) if x is not None]
    assert all(J._similarities(x, own).tolist() == [J._similarity(x, b) for b in own] for x in own[:60] + ["A", "ÉÉ", "M" * 9])
