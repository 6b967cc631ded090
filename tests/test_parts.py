"""Tables in parts, change batches in every order, and streams with watermarks."""

import datetime as dt
import glob
import itertools

from pyspark.sql import functions as F

from refectory.operators.parts import KeyedTable, PartedTable, slices
from refectory.plans import streams
from refectory.streaming import sync as T


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


#: Changes of one key: (time, value, deleted at). Two of equal time, of which the deletion counts.
CHANGES = [(1, "a", None), (2, None, 2), (3, "c", None), (3, None, 3)]


def test_changes_give_one_table_however_they_are_batched(spark, tmp_path):
    """Every subset of the changes, in every order, split into batches at every place: each case is a key of its own."""
    cases = []
    for n in range(1, 5):
        for own in itertools.permutations(range(4), n):
            for cuts in itertools.product((0, 1), repeat=n - 1):
                cases.append((own, list(itertools.accumulate((0, *cuts)))))
    batches = [[(key, *CHANGES[c]) for key, (own, at) in enumerate(cases) for c, b in zip(own, at, strict=True) if b == i] for i in range(4)]
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], [F.desc("at")], "deleted", 8)
    kind = "k int, at int, v string, deleted int"
    for b in [*batches, batches[1]]:  # one batch comes twice
        t.merge(spark.createDataFrame(b, kind))
    got = {r.k: r.v for r in t.read().collect()}
    for key, (own, _) in enumerate(cases):
        last = max(own, key=lambda c: (CHANGES[c][0], CHANGES[c][2] is not None))
        assert got.get(key) == CHANGES[last][1], cases[key]
    assert len(cases) == 4 + 12 * 2 + 24 * 4 + 24 * 8
    t.forget(F.col("at") <= 2)
    held = t.read_parts()
    assert held.where("deleted <= 2").count() == 0 and held.where("deleted = 3").count() > 0 and {r.k: r.v for r in t.read().collect()} == got


def test_equal_rows_are_told_apart_by_content(spark, tmp_path):
    kind = "k int, at int, v string"
    for i, order in enumerate(itertools.permutations("abc")):
        t = KeyedTable(spark, str(tmp_path / f"t{i}"), ["k"], [F.desc("at")], buckets=2)
        for v in order:
            t.merge(spark.createDataFrame([(1, 1, v), (None, 1, v)], kind))
        got = rows(t.read())
        assert len(got) == 2 and (i == 0 or got == first)
        first = got


def test_last_batch_counts_unless_newest(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], [F.desc("at")], "deleted", 4)
    kind = "k int, at int, deleted int"
    for b in ([(1, 5, None), (2, 5, None), (3, 5, None)], [(1, 3, None), (2, 3, 3)], [(2, 2, None), (2, 1, 1)]):
        t.merge(spark.createDataFrame(b, kind), newest=False)
    assert rows(t.read()) == [(1, 3, None), (2, 2, None), (3, 5, None)]
    assert t.merge(spark.createDataFrame([], kind)) == t.version()


def written(spark, t):
    """Rows that the last version wrote."""
    return spark.read.parquet(f"{t.path}/{t.version()}").count()


def test_a_batch_rewrites_what_it_touches(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), ["k"], [F.desc("at")], buckets=500)
    t.merge(spark.range(10_000).select(F.col("id").alias("k"), F.lit(0).alias("at")))
    want = dict.fromkeys(range(10_000), 0)
    for i in range(1, 11):
        batch = [(k * 37 % 10_050, i) for k in range(i * 8, i * 8 + 8)]
        t.merge(spark.createDataFrame(batch, "k long, at int"))
        t.prune()
        want |= dict(batch)
        assert len(batch) <= written(spark, t) <= 8 * 45  # parts have 20 rows or so
        assert len(t._pointers()) <= 2
    assert {r.k: r.at for r in t.read().collect()} == want
    assert len(t.parts()) == 500 and len(set(t.parts().values())) > 5


def test_slices_are_replaced_alone(spark, tmp_path):
    f = lambda *r: spark.createDataFrame(list(r), "y int, s string, v int")
    t = PartedTable(spark, str(tmp_path / "t"), slices(["y", "s"]))
    t.write(f((1, "a", 1), (1, "b", 2), (2, "a", 3), (None, "a", 4)))
    held = t.read()
    t.replace(f((1, "a", 5), (1, "a", 6), (3, None, 7)))
    assert rows(t.read()) == sorted([(1, "a", 5), (1, "a", 6), (1, "b", 2), (2, "a", 3), (3, None, 7), (None, "a", 4)], key=str)
    assert written(spark, t) == 3 and held.count() == 4  # a reader of the version before still has it
    v = t.version()
    assert t.replace(f((9, "z", 1)).limit(0)) == v
    t.write(f((7, "q", 1)))
    assert rows(t.read()) == [(7, "q", 1)]
    t.prune(1)
    assert rows(t.read()) == [(7, "q", 1)] and len(t._pointers()) == 1


def land(spark, at, *r):
    spark.createDataFrame(list(r), "id int, ts timestamp, kind string").coalesce(1).write.mode("append").parquet(at)


def day(n, h=0):
    return dt.datetime(2024, 1, 1, h) + dt.timedelta(days=n)


def test_repeats_within_the_look_back_are_dropped(spark, tmp_path):
    at = str(tmp_path / "landed")
    stream = lambda: T.without_repeats(T.landed(spark, at, 1), "ts", ["id"], "45 days")
    land(spark, at, (1, day(0), "first"), (2, day(0), "first"), (2, day(0, 1), "same file"))
    assert T.appended(stream(), str(tmp_path / "out")).count() == 2
    land(spark, at, (1, day(44), "inside"), (3, day(60), "first"))  # the watermark gets to day 15
    assert rows(T.appended(stream(), str(tmp_path / "out")).groupBy("id").count()) == [(1, 1), (2, 1), (3, 1)]
    land(spark, at, (4, day(200), "first"))  # to day 155: the first keys are forgotten
    T.appended(stream(), str(tmp_path / "out"))
    land(spark, at, (1, day(201), "outside"), (3, day(100), "too late"), (4, day(190), "inside"))
    got = T.appended(stream(), str(tmp_path / "out"))
    assert rows(got.groupBy("id").count()) == [(1, 2), (2, 1), (3, 1), (4, 1)] and rows(got.where("kind = 'outside'").select("id")) == [(1,)]


def test_days_come_out_once_complete(spark, tmp_path):
    at = str(tmp_path / "landed")
    out = lambda: rows(T.appended(T.daily_counts(T.landed(spark, at, 1), "ts", "kind"), str(tmp_path / "out")))
    land(spark, at, (1, day(0, 5), "x"), (2, day(1, 5), "x"))
    assert out() == []  # the watermark is at day 0, 5 h
    land(spark, at, (3, day(0, 23), "x"), (4, day(0, 23), "y"), (5, day(2, 1), "x"))
    assert out() == [(day(0).date(), "x", 2), (day(0).date(), "y", 1)]
    land(spark, at, (6, day(0, 1), "x"), (7, day(1, 6), "x"), (8, day(4), "x"))  # the first one is too late
    assert out() == [(day(0).date(), "x", 2), (day(0).date(), "y", 1), (day(1).date(), "x", 2), (day(2).date(), "x", 1)]


def test_latest_times_are_kept_up_to_date(spark, tmp_path):
    at = str(tmp_path / "landed")
    t = KeyedTable(spark, str(tmp_path / "t"), ["kind"], [F.desc("ts")], buckets=4)
    for own in ([(1, day(5), "x"), (2, day(3), "y")], [(3, day(2), "x")], [(4, day(9), "y"), (5, day(1), None)]):
        land(spark, at, *own)
        T.sync(T.landed(spark, at, 1).select("kind", "ts"), T.latest_batches(t, ["kind"], "ts"), str(tmp_path / "stream"))
    assert rows(t.read()) == sorted([("x", day(5)), ("y", day(9)), (None, day(1))], key=str)


def test_parts_land_in_many_files_and_in_one_batch_each(spark, tmp_path):
    """A single task would write each part, and a batch of some of its files would move the watermark past its others."""
    events = [(i, day(i % 30, i % 24), "x") for i in range(3000)]
    src = str(tmp_path / "sf")
    spark.createDataFrame(events, "event_id long, ts timestamp_ntz, kind string").repartition(3).write.parquet(f"{src}/events.parquet")
    at, files = str(tmp_path / "in"), []
    for _ in streams.landed_in_turn(spark, src, f"{at}/landed", 4, again=7):
        stream = streams._timed(T.landed(spark, f"{at}/landed", None))
        got = T.appended(T.without_repeats(stream, "ts", ["event_id"], "7 days"), at)
        files.append(len(glob.glob(f"{at}/landed/*.parquet")))
    assert len(files) == 4 and all(b - a > 1 for a, b in zip([0, *files], files))
    assert got.count() == got.select("event_id").distinct().count() == 3000
