"""How often and how widely movements are shuffled in the delivery reports, and their lookups on odd rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from refectory import registry
from refectory.plans import delivery_reports as R
from refectory.plans.deliveries import BY_SITE, domain

from .conftest import DATA

#: Shuffles of movements by report: by article and by site; the dashboard's sums go to groups, once for the distinct sites.
SHUFFLES = {"stats_liv": 2, "stats_liv59": 2, "stats_liv_annee": 2, "stats_liv_mois": 2, "stats_liv_egalim": 2, "stats_liv_egalim_jour": 2, "stats_dashboard": 4}


def movements_path(df):
    """The plan's operators from its root to the scan of movements, which are on the left of every join."""
    node, out = df._jdf.queryExecution().executedPlan(), []
    while True:
        out.append(node.nodeName())
        if node.nodeName() == "AdaptiveSparkPlan":
            node = node.executedPlan()
        elif node.children().size():
            node = node.children().apply(0)
        else:
            return out


@pytest.mark.parametrize("name", sorted(SHUFFLES))
def test_movements_are_shuffled_by_article_and_by_site_only(spark, name):
    """Every shuffle of all movements takes some hundred times as much disk as a lookup's few rows."""
    path = movements_path(registry.queries()[name](spark, DATA))
    assert "Scan parquet" in path[-1]
    assert sum(x.endswith("Exchange") and "Broadcast" not in x for x in path) == SHUFFLES[name], path


def test_rows_that_no_movement_is_looked_up_in_are_left_out(spark):
    t = domain(spark, DATA)
    groups = {f"g{i}" for i in range(25)}
    sites = {r.login: r.logingroupe for r in t["login"].collect()}
    for name, table in (("FAMART", "famart"), ("ARTICLE", "article")):
        of = lambda g, every=BY_SITE[name]: int(g[1:]) % every == 0
        got = {(r.login_site, r.__getitem__("__group")) for r in R._kept(t, name, t[table]).select("login_site", "__group").distinct().collect()}
        assert {g for g, shared in got if shared} == {g for g in set(sites.values()) if not of(g)}
        assert {s for s, shared in got if not shared} <= {s for s, g in sites.items() if of(g)}
        assert not groups & {s for s, shared in got if not shared}
        assert any(not shared for _, shared in got)


def frame(spark, columns, *rows):
    return spark.createDataFrame(list(rows), columns)


@pytest.fixture
def odd(spark):
    """Group G keeps all by group, group H all by site; rows of site a and of group H are there, but don't count."""
    tables = ("ARTICLE", "MVTART_DET", "DETAILARTICLE", "FOURN", "FAMART", "SFAART")
    day = datetime.datetime(1995, 5, 1)
    mvt = "login_site string, mvcleunik long, arcleunik long, f_ocleunik int, dtemvt timestamp, typmvt string, qtef double, puf double, taux_tva double, qteusart double, bio boolean, circuit_court boolean, id_label int, id_origine int"
    return {
        "login": frame(spark, "login string, logingroupe string, code_site string, fictif boolean", ("a", "G", "ca", False), ("b", "H", "cb", None), ("x", "G", "cx", True)),
        "descfic": frame(spark, "nomfic string, login_group string, statut int", *((n, g, s) for n in tables for g, s in (("G", 1), ("H", 2)))),
        "mvtart": frame(
            spark, mvt,
            ("a", 1, 1, 1, day, "1", 2.0, 3.0, 10.0, 2.0, False, False, 0, 0), ("a", 2, 2, 1, day, "1", 2.0, 3.0, None, 2.0, None, True, -5, 7),
            ("a", 3, 3, None, None, "1", 1.0, 1.0, 0.0, None, True, False, 0, 0), ("a", 4, 9, 1, day, "1", 1.0, 1.0, 0.0, 1.0, True, True, 1, 1),
            ("b", 1, 1, 1, day, "1", 5.0, 1.0, 0.0, 5.0, False, False, 0, 0), ("x", 5, 1, 1, day, "1", 1.0, 1.0, 0.0, 1.0, True, True, 1, 1), ("a", 6, 1, 1, day, "2", 1.0, 1.0, 0.0, 1.0, True, True, 1, 1),
        ),
        "article": frame(
            spark, "login_site string, arcleunik long, codart long, codfamart string, sfaart string, bio boolean, usart string, usart_vers_ufam double",
            ("G", 1, 70, " 1", "s", True, "KG ", 0.0), ("G", 2, 70, "1", "s", False, "L", 2.0), ("G", 3, None, "2", None, None, "L", None), ("b", 1, 70, "1", "s", False, "KG", 3.0), ("a", 1, 71, "8", "z", True, "KG", 9.0), ("H", 1, 71, "8", "z", True, "KG", 9.0),
        ),
        "mvtart_det": frame(spark, "login_site string, mvcleunik long", ("G", 2), ("G", 2), ("a", 1), ("b", 1), ("H", 3)),
        "detail_article": frame(spark, "login_site string, codart long, circuit_court boolean, id_label int, id_origine int", ("G", 70, True, 4, 6), ("b", 70, True, 5, 5), ("G", None, True, 9, 9), ("a", 70, False, 8, 8)),
        "fourn": frame(spark, "login_site string, f_ocleunik int, libfou string, bio boolean, circuit_court boolean, id_label int", ("G", 1, " shop", False, False, 3), ("b", 1, None, True, True, 2), ("a", 1, "no", True, True, 1)),
        "famart": frame(spark, "login_site string, codfamart string, libfamart string, type int, cptfam_1 string", ("G", "1", "one", 1, "6011"), ("G", "1 ", "one", 1, "6011"), ("b", "1", "b-one", 1, "6011"), ("a", "1", "no", 1, "6011")),
        "sfaart": frame(spark, "login_site string, codfamart string, sfaart string, libsfaart string, type int", ("G", "1", "s", "sub", None), ("b", "1", "s", "b-sub", None), ("H", "1", "s", "no", None)),
    }


@pytest.mark.parametrize("rows", [250_000, 1])
def test_lookups_on_odd_rows(spark, monkeypatch, odd, rows):
    """One code of several articles, no code, no day, no supplier, negative labels, doubled details: as the joins by site or group tell."""
    monkeypatch.setattr(R, "ROWS_A_TASK", rows)
    d = R.deliveries(odd)
    cols = ["jour", "login_site", "logingroup", "code_site", "famille_article", "sous_famille_article", "lib_famille_article", "lib_sous_famille_article", "libfou", "idfou", "bio", "clocal", "label1", "idorigine", "montant", "montantht", "qte"]
    day = datetime.date(1995, 5, 1)
    got = sorted((tuple(r) for r in d.select(*cols).collect()), key=lambda r: (r[1], r[15], str(r[12])))
    assert got == [
        (None, "a", "G", "ca", "2", None, "", "", "", 0, 1, 0, 0, 0, 1.0, 1.0, None),
        (day, "a", "G", "ca", "1", "s", "one", "sub", "shop", 1, 0, 1, -5, 7, 6.0, 6.0, 4.0),
        (day, "a", "G", "ca", "1", "s", "one", "sub", "shop", 1, 1, 1, 4, 6, pytest.approx(6.6), 6.0, 2.0),
        (day, "b", "H", "cb", "1", "s", "b-one", "b-sub", "", 1, 0, 0, 0, 5, 5.0, 5.0, 15.0),
    ]


def test_sums_of_a_site_are_in_one_task(spark):
    d = R.stats_liv_annee(R.deliveries(domain(spark, DATA))).select("login_site", "__part", F.spark_partition_id().alias("task")).distinct()
    assert d.groupBy("login_site").count().where("count > 1").count() == 0
