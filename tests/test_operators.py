"""Null, tie and boundary cases of the operators, on small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from refectory.forecast import models as M
from refectory.functions import scalars as S
from refectory.operators import aggregates as A
from refectory.operators import joins as J
from refectory.operators import rows as R
from refectory.operators import tables as K
from refectory.operators import windows as W
from refectory.spec import TableSpec, snake_case
from refectory.streaming import sync as T


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_snake_case():
    assert [snake_case(x) for x in ("idUser", "Date Début", "ID", "code_site")] == ["id_user", "date_debut", "id", "code_site"]


def test_scalars(spark):
    d = spark.createDataFrame([(" 07 ", "oui", "[True, 2, None]", "106,9"), ("x", "?", "bad", ""), (None, None, None, None)], "a string, b string, j string, n string")
    got = d.select(S.code(F.col("a")), S.to_boolean(F.col("b")), *S.json_columns(F.col("j"), 2), S.decimal_comma(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [("7", True, 1, 2, 106.9), (None, None, None, None, None), (None, None, None, None, None)]


def test_horizon_bins(spark):
    d = spark.createDataFrame([(x,) for x in (0, 6, 7, 8, 14, 15, 21, 22)], "h int")
    assert [r[0] for r in d.select(S.horizon_bin(F.col("h"))).collect()] == ["<=7", "<=7", "<=7", "<=14", "<=14", "<=21", "<=21", ">21"]
    assert [r[0] for r in d.select(S.horizon_bin(F.col("h"), closed="left")).collect()] == ["<7", "<7", "<14", "<14", "<21", "<21", ">=21", ">=21"]


def test_iso_weeks(spark):
    d = spark.createDataFrame([(x,) for x in ("2020-12-31", "2021-01-03", "2021-01-04", "2024-12-30")], "s string").select(F.to_date("s").alias("d"))
    assert [tuple(r) for r in d.select(S.iso_year(F.col("d")), S.iso_week(F.col("d"))).collect()] == [(2020, "53"), (2020, "53"), (2021, "01"), (2025, "01")]


def test_merge_is_idempotent_and_null_safe(spark):
    t = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    s = spark.createDataFrame([(None, "c"), (2, "d"), (2, "e")], "k int, v string")
    once = K.merge_upsert(t, s, ["k"], [F.desc("v")])
    assert rows(once) == rows(K.merge_upsert(once, s, ["k"], [F.desc("v")])) == [(1, "a"), (2, "e"), (None, "c")]


def test_not_in_with_null_parent_drops_nothing(spark):
    d = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    some = spark.createDataFrame([(1,)], "p int")
    assert rows(K.without_orphans(d, "k", some, "p", F.lit(True))) == [(1,), (None,)]
    assert K.without_orphans(d, "k", some.union(spark.createDataFrame([(None,)], "p int")), "p", F.lit(True)).count() == 3


def test_stale_ids_need_a_source(spark):
    t = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(K.stale_ids(t, t.where("k = 1"), "k", F.lit(True))) == [(2,)]
    assert K.stale_ids(t, t.limit(0), "k", F.lit(True)).count() == 0


def test_snapshot_table(spark, tmp_path):
    t = K.SnapshotTable(spark, str(tmp_path / "t"))
    t.reload(spark.createDataFrame([(1, "a")], "k int, v string"))
    t.upsert(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), ["k"], [F.desc("v")])
    assert rows(t.read()) == [(1, "b"), (2, "c")]
    try:
        t.reload(t.read().limit(0))
        raise AssertionError("an empty reload went through")
    except ValueError:
        assert t.read().count() == 2


def test_full_outer_matches_null_keys(spark):
    a = spark.createDataFrame([(1, 1.0), (None, 2.0), (3, 0.0)], "k int, x double")
    b = spark.createDataFrame([(None, 5.0), (4, 1.0)], "k int, y double")
    assert rows(J.full_outer_zero(a, b, ["k"], ["x", "y"])) == [(1, 1.0, 0.0), (4, 0.0, 1.0), (None, 2.0, 5.0)]


def test_latest_started_takes_the_last_of_equal_starts(spark):
    p = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01"), (3, "2025-01-01")], "id int, s string").select("id", F.to_date("s").alias("start"))
    f = spark.createDataFrame([("2024-06-01",), ("2023-01-01",), (None,)], "d string").select(F.to_date("d").alias("d"))
    assert rows(J.latest_started(f, "d", p, "start", ["id"], "id")) == [(None, None), (dt.date(2023, 1, 1), None), (dt.date(2024, 6, 1), 2)]


def test_densify_running_never_falls(spark):
    d = spark.createDataFrame([(1, "g", "a", 2), (3, "g", "b", 1), (2, "h", "c", 1)], "day int, g string, e string, n int")
    out = W.running(J.densify(d, "day", "g", "e", ["n"]), ["g", "e"], ["day"], {"t": "n"}).orderBy("g", "e", "day").collect()
    assert [(r.g, r.e, r.day, r.t) for r in out] == [("g", "a", 1, 2), ("g", "a", 3, 2), ("g", "b", 1, 0), ("g", "b", 3, 1), ("h", "c", 2, 1)]


def test_rolling_needs_a_full_window(spark):
    d = spark.range(43).select(F.lit(1).alias("k"), F.col("id").alias("i"), F.col("id").cast("double").alias("v"))
    got = [r.m for r in W.full_window_mean(d, ["k"], ["i"], "v", 42, "m").orderBy("i").collect()]
    assert got[:41] == [None] * 41 and got[41:] == [20.5, 21.5]


def test_within_period_counts_the_last_day_whole(spark):
    p = spark.createDataFrame([("2024-01-01", "2024-01-31")], "a string, b string")
    f = spark.createDataFrame([("2024-01-31 12:00:00",), ("2024-02-01 00:00:00",)], "t string").select(F.to_timestamp("t").alias("t"))
    assert J.within_period(f, "t", p, "a", "b").count() == 1


def test_normalize(spark):
    spec = TableSpec("t", {"pk": "string", "site": "string", "id_user": "long", "ok": "boolean"}, pk_from=("site", "id_user"), site_column="site")
    got = R.normalize(spark.createDataFrame([("3.0", "Oui"), ("", "x")], "idUser string, ok string"), spec, F.lit("s"))
    assert got.schema == spec.struct_type() or spec.errors(got.schema) == []
    assert rows(got) == [("s_3", "s", 3, True), ("s_nan", "s", None, None)]


def test_jaro_winkler_and_ratio(spark):
    got = spark.createDataFrame([("MARTHA", "MARHTA"), ("A", None), ("", "")], "a string, b string").select(J.jaro_winkler("a", "b").alias("s")).collect()
    assert [None if r.s is None or r.s != r.s else round(r.s, 4) for r in got] == [0.9611, None, 1.0]
    assert spark.range(1).select(S.ratio(F.lit(1), F.lit(0))).first()[0] == 0.0


def test_weights_lie_on_the_simplex_and_prefer_the_better_model(spark):
    d = spark.range(60).select(F.lit("s").alias("site"), F.col("id").cast("double").alias("y"), (F.col("id") + 0.1).alias("m1"), (F.col("id") * 3.0 + 5).alias("m2"))
    w = {r.model: r.weight for r in M.fit_weights(d, ["site"], "y", ["m1", "m2"]).collect()}
    assert abs(sum(w.values()) - 1) < 1e-9 and w["m1"] > 0.95
    long = M.long_form(d.withColumn("m2", F.lit(None).cast("double")), ["site", "y"], ["m1", "m2"])
    assert M.apply_weights(long, ["site", "y"], []).count() == 60


def test_error_metrics_skip_zero_actuals(spark):
    d = spark.createDataFrame([("s", 0.0, 1.0), ("s", 2.0, 1.0), ("s", None, 1.0)], "s string, y double, p double")
    r = A.error_metrics(d, ["s"], "y", "p").first()
    assert (r.mae, r.mape, r.bias, r.n) == (1.0, 50.0, 0.0, 2)


def test_snapshot_pointer_survives_a_stop(spark, tmp_path):
    t = K.SnapshotTable(spark, str(tmp_path / "t"))
    f = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    t.write(f((1, "a")))

    class Stopped(K.SnapshotTable):
        """A writer that stops before its pointer is in place."""

        def _pointer(self, n):
            if n > 1:
                raise RuntimeError("stopped")
            return super()._pointer(n)

    with pytest.raises(RuntimeError):
        Stopped(spark, t.path).write(f((2, "b")))
    assert rows(t.read()) == [(1, "a")]
    t.upsert(f((3, "c")), ["k"], [F.desc("v")])
    assert rows(t.read()) == [(1, "a"), (3, "c")]
    held = t.read()
    for i in range(3):
        t.write(f((i, "x")))
    t.prune(2)
    assert rows(t.read()) == [(2, "x")] and len(t._pointers()) == 2 and held is not None


def test_late_rows_dont_replace_newer_ones(spark, tmp_path):
    t = K.SnapshotTable(spark, str(tmp_path / "t"))
    f = lambda *r: spark.createDataFrame(list(r), "k int, at int")
    for batch in (f((1, 5), (2, 1)), f((1, 3), (2, 4), (3, 1)), f((1, 5))):
        t.upsert(batch, ["k"], [F.desc("at")], newest=True)
    assert rows(t.read()) == [(1, 5), (2, 4), (3, 1)]


def test_stream_counts_every_late_file(spark, tmp_path):
    days = [(dt.datetime(2024, 1, d, h), "x" if h % 2 else "y") for d in range(1, 10) for h in range(5)]
    at = str(tmp_path / "landed")
    for d in reversed(range(1, 10)):  # the newest days land first, each file is a batch
        spark.createDataFrame([r for r in days if r[0].day == d], "ts timestamp, kind string").coalesce(1).write.mode("append").parquet(at)
    got = T.counted_by_day(T.landed(spark, at, 1), "ts", "kind", str(tmp_path / "out")).collect()
    assert sum(r.n for r in got) == len(days) and {(r.day.day, r.kind, r.n) for r in got} == {(d, k, n) for d in range(1, 10) for k, n in (("x", 2), ("y", 3))}
    batches = {p.name for p in (tmp_path / "out" / "out").iterdir()}
    assert len([b for b in batches if b.startswith("batch=")]) == 9


def test_reload_goes_on_after_errors(spark, tmp_path):
    t = K.SnapshotTable(spark, str(tmp_path / "t"))
    t.write(spark.createDataFrame([(9,)], "k int"))

    def read(name):
        if name == "bad":
            raise ValueError("no such source")
        return spark.createDataFrame([(int(name),)], "k int")

    audit = {r.chunk: (r.rows, r.status, r.error) for r in T.reload_chunks(t, ["1", "bad", "2"], read, str(tmp_path / "stage")).collect()}
    assert audit == {"1": (1, "complete", None), "bad": (0, "failed", "no such source"), "2": (1, "complete", None)}
    assert rows(t.read()) == [(1,), (2,)]
    T.reload_chunks(t, ["bad"], read, str(tmp_path / "stage2"))
    assert rows(t.read()) == [(1,), (2,)]


def test_lookups(spark):
    f = spark.createDataFrame
    ids = f([("a", 2), ("a", 1), ("b", 3)], "label string, id int")
    df = f([("a",), ("b",), (None,)], "name string")
    assert rows(J.resolve_ids(df, "name", ids, "label", "id")) == [("a", 1), ("b", 3), (None, None)]
    with pytest.raises(ValueError, match="'x'"):
        J.resolve_ids(df.unionByName(f([("x",)], "name string")), "name", ids, "label", "id")
    chain = J.id_chain(f([(1,), (2,), (None,)], "s int"), "s", [(f([(1, 10), (2, 20)], "id int, wave int"), "id", "wave"), (f([(10, 7)], "v int, year int"), "v", "year")])
    assert rows(chain) == [(1, 10, 7), (2, 20, None), (None, None, None)]
    assert rows(J.key_union([(f([("u",), ("",), (None,)], "a string"), "a"), (f([("u",), ("w",)], "b string"), "b")], "k")) == [("u",), ("w",)]
    years = f([("s", 2020, 9.0), ("s", 2021, 5.0), ("s", 2021, 7.0), ("s", 2021, None)], "site string, y int, v double")
    for lookup in (years, years.orderBy(F.desc("v")), years.orderBy("v")):
        assert rows(J.by_year_or_latest(f([("s", 2020), ("s", 2023), ("t", 2020)], "site string, y int"), lookup, "site", "y", "v", 1.0)) == [("s", 2020, 9.0), ("s", 2023, 7.0), ("t", 2020, 1.0)]


def test_names_and_booleans():
    assert [snake_case(x) for x in ("idUser", "iduser", "IdX", "id", "Créé le", "ID Site", "id_a", "idX")] == ["id_user", "id_user", "id_x", "id", "cree_le", "id_site", "id_a", "id_x"]


def test_forecast_helpers(spark, tmp_path):
    f, d = spark.createDataFrame, dt.date
    future = f([("s", d(2024, 1, 1), 5.0), ("s", d(2024, 1, 2), None)], "site string, d date, v double")
    known = f([("s", d(2024, 1, 1), 2.0), ("s", d(2024, 1, 1), 1.0)], "site string, d date, v double")
    assert rows(M.fill_known(future, known, ["site", "d"], "v")) == [("s", d(2024, 1, 1), 3.0), ("s", d(2024, 1, 2), None)]
    cuts = f([(d(2024, 1, i),) for i in (1, 8, 15)], "cutoff date")
    assert rows(M.resumed(cuts, cuts.where("cutoff <= '2024-01-08'"))) == [(d(2024, 1, 15),)]
    assert M.resumed(cuts, cuts.limit(0)).count() == 3 and M.resumed(cuts, None).count() == 3
    M.route_by_tenant(f([("a", 1.0), ("b", 2.0), ("c", 3.0)], "site string, p double"), f([("a", "t1"), ("b", "t2"), ("b", "t2")], "site string, tenant string"), "site", "tenant", str(tmp_path / "out"))
    assert rows(spark.read.parquet(str(tmp_path / "out" / "tenant=t2"))) == [("b", 2.0)] and spark.read.parquet(str(tmp_path / "out")).count() == 2
    ar = M.weekday_autoregression(f([("s", d(2024, 1, 1), 4.0), ("s", d(2024, 1, 8), 6.0)], "uai string, d date, v double"), "uai", "d", "v")
    assert {(r.uai, r.prediction) for r in ar.collect()} == {("s", 5.0)}
