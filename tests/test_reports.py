"""Reports on small fixtures of the domain's tables."""

import datetime as dt

import pytest

from refectory.plans import reports as R

T = lambda y, m, d, h=12: dt.datetime(y, m, d, h)
TS = "timestamp"


@pytest.fixture(scope="module")
def t(spark):
    f = spark.createDataFrame
    return {
        "registration": f([(1.0, "approved", 10.0, 100.0, 1, 5.0, None, T(2024, 1, 2), T(2024, 1, 5)), (2.0, "pending", 10.0, 101.0, None, None, "iban", T(2024, 1, 3), None), (3.0, None, 11.0, 100.0, 2, 5.0, None, T(2024, 1, 3), T(2024, 1, 9))],
            "id double, status string, id_session double, id_user double, tranche_id long, subgroup_id double, choice_bank_detail string, created_at timestamp, updated_at timestamp"),
        "session": f([(10.0, 1.0, 7.0, "s"), (11.0, 2.0, 7.0, "s")], "id double, id_organization double, id_vague double, name string"),
        "vague": f([(7.0, "wave", dt.date(2023, 9, 1), dt.date(2024, 8, 31), 3), (8.0, "later", dt.date(2024, 1, 4), dt.date(2024, 8, 31), 3)], "id_vague double, name string, start_date date, end_date date, id_school_year long"),
        "school_year": f([(3, "2023-2024", dt.date(2023, 9, 1), dt.date(2024, 1, 5))], "school_year_id long, label string, start_date date, end_date date"),
        "organization": f([(1.0, "A", "x", "LYC", "75", 1.0), (2.0, "B", "y", "CLG", "93", None), (3.0, "C", "z", "CLG", "93", None)], "id_organization double, name string, city string, type string, department string, ips double"),
        "user_info_school_year": f([(100.0, 3, "A", "sub", "grp", "card")], "id_user double, school_year_id long, label_tranche string, label_subgroup string, label_group string, choice_bank_details string"),
        "tranche": f([(1, "A", 1), (2, "B", 2)], "id_tranche long, label string, indice long"),
        "subgroup": f([(5.0, "sub5", 9.0, None)], "id_subgroup double, label string, id_group double, facturation_type string"),
        "group": f([(9.0, "g9")], "id_group double, label string"),
        "service": f([(1.0, 1.0, "lunch")], "id_organization double, id_service double, label string"),
        "passage": f([(1.0, 1.0, 100.0, 1.0, T(2024, 1, 3), 5.0, 1), (2.0, 1.0, 100.0, 1.0, T(2024, 1, 5), 5.0, 2)], "id_passage double, id_organization double, id_user double, id_service double, date timestamp, id_subgroup double, id_tranche long"),
        "passage_partner": f([(1.0, 30.0, 1.0, 2.0, T(2024, 1, 5), "m", 1.0), (2.0, None, None, 2.0, T(2024, 1, 6), "?", 1.0)], "id_partner double, nb_passages double, tranche double, id_organization double, date timestamp, subgroup string, service double"),
        "subgroup_mapping": f([(1.0, "m", 4.0), (2.0, "m", 5.0)], "id_subgroupmaping double, subgroup string, id_subgroup double"),
        "history": f([(1.0, 1.0, "deposited", T(2024, 1, 3)), (2.0, 1.0, "deposited", T(2024, 1, 4)), (3.0, 1.0, "approved", T(2024, 1, 5))], "id_reg_history double, registration_id double, event string, created_at timestamp"),
        "organization_enrollment": f([(1, 10)], "organization_id long, total_enrollment long"),
        "bankdetail": f([(1.0, "old", 101.0, 1.0, T(2024, 1, 1)), (2.0, "new", 101.0, 2.0, T(2024, 1, 2))], "bank_detail_id double, choice_bank_details string, id_user double, id_tranche double, updated_at timestamp"),
    }


def test_tarification_1(t):
    got = {(r.organization, r.tranche): (r.total, r.approved, r.unfinished) for r in R.tarification_1(t).collect()}
    assert got == {("A", "A"): (1, 1, 0), ("A", "none"): (1, 0, 1), ("B", "A"): (1, 0, 0)}


def test_tranche_columns_add_up(t):
    rows = R.tarification_passages(t, 3).collect()
    assert sum(r.total for r in rows) == 32.0
    assert all(r.total == r.tranche_1 + r.tranche_2 + r.tranche_3 + r.tranche_none for r in rows)
    assert {(r.organization, r.day.day, r.wave) for r in rows} == {("A", 3, "wave"), ("A", 5, "later"), ("B", 5, "later"), ("B", 6, "later")}


def test_last_day_of_a_year_counts_and_partners_are_mapped(t):
    rows = {(r.organization, r.day.day): r.school_year for r in R.tarification_3(t).collect()}
    assert rows["A", 5] == "2023-2024" and rows["B", 6] is None
    assert {r.group_label for r in R.passages_detail(t).collect()} == {"g9", None}


def test_tracking_is_dense_and_cumulative(t):
    rows = sorted((r.organization, r.day.day, r.created_total, r.deposited_total, r.approved_total) for r in R.suivi_inscriptions(t).collect())
    assert rows[:4] == [("A", 2, 1, 0, 0), ("A", 3, 2, 1, 0), ("A", 5, 2, 1, 1), ("B", 2, 0, 0, 0)]


def test_snapshots_and_enrichment(t):
    assert {(r.id_user, r.tranche) for r in R.user_info_school_year(t).collect()} == {(100.0, "A"), (101.0, "none")}
    assert {(r.id, r.choice_bank_detail, r.tranche_id) for r in R.registration_enrich(t).collect()} == {(1.0, None, 1), (2.0, "iban", 2), (3.0, None, 2)}
    assert {(r.organization, r.last_passage and r.last_passage.day) for r in R.dernier_passage(t).collect()} == {("A", 5), ("B", 6), ("C", None)}
    g = {r.organization: (r.files, r.approved, r.A, r.approved_pct, r.enrolled_pct) for r in R.dashboard_general(t).collect()}
    assert g == {"A": (2, 1, 1, 50.0, 10.0), "B": (1, 0, 1, 0.0, 0.0)}


def test_meals(spark):
    f = spark.createDataFrame
    d = dt.date(2024, 1, 2)
    t = {
        "effect": f([(d, "01", "1", "s", 10, 5.0), (d, "1", " 1", "s", 2, None), (d, "2", "1", "s", 0, 0.0)], "efdate date, codss1 string, codss2 string, login_site string, efreel long, credit double"),
        "mvtart": f([(T(2024, 1, 2), 2, "1", "1", "s", 2.0, 3.0), (T(2024, 1, 2), 1, "1", "1", "s", 9.0, 9.0)], "dtemvt timestamp, typmvt long, codss1 string, codss2 string, login_site string, qteart double, pmpart double"),
        "feuille": f([(1, d, "1", "1", "s", 4, "[True, 3]", "bad")], "fecleunik long, efdate date, codss1 string, codss2 string, login_site string, nb_vegetarien long, id_animation string, type_menu string"),
    }
    rows = R.meals(t).collect()
    assert [(r.efreel, r.totcredit, r.totsortie, r.id_animation_1, r.id_animation_2, r.type_menu_1) for r in rows] == [(12.0, 5.0, 6.0, 1, 3, None)]
    recap = R.recap_site(f([(d, "1", "s", 10.0, 20.0), (dt.date(2024, 1, 3), "2", "s", 5.0, 10.0)], "datej date, codss2 string, login_site string, efreel double, totsortie double"))
    assert [(r.neff, r.neffserv_1, r.neffserv_2, r.rpr) for r in recap.orderBy("datestat").collect()] == [(10.0, 10.0, 0.0, 2.0), (15.0, 10.0, 5.0, 2.0)]
    days = f([(2024, 3)], "annee int, working_days int")
    assert [(r.repas_servis, r.repas_par_jour, r.prix_revient) for r in R.dashboard_effect(recap, days).collect()] == [(15.0, 5.0, 2.0)]


def test_loads_and_predictions(spark):
    f = spark.createDataFrame
    p = f([(1, 1, "[]", False), (1, 2, '[{"user": 5, "name": "x"}, {"user": 6}]', None), (2, 1, '[{"user": 7}]', True)], "constatation_id long, payload_index long, payload string, is_simulation boolean")
    assert sorted(tuple(r) for r in R.constatation_load(p, "struct<user: bigint, name: string>", {"user": "user_id"}).collect()) == [(1, 5), (1, 6)]
    store = f([("u", "d", "x", 7, 1.0, 2.0), ("u", "d", "ens", 20, 3.0, 2.0), ("u", "d", "ens", 9, 4.0, 2.0)], "uai string, target_date string, model string, horizon int, prediction double, effectif_reel double")
    r = R.best_predictions(store, {"ens": 1}, every_model=True).first()
    assert (r.model, r.horizon, r.prediction, r.models) == ("ens", 9, 4.0, {"ens": 4.0, "x": 1.0})
    assert R.accuracy_report(store).where("model = 'ens' AND uai = '(all)' AND bin = '(all)'").first().mae == 1.5
    years = f([("2023",)], "school_year string")
    out = R.etablissement_detail(f([("a", "n", "1"), ("b", "m", "x")], "uai string, nom_etablissement string, code_academie string"), f([("a", "2022", 1.0), ("a", "2022", 3.0)], "uai string, school_year string, ips double"), {1: "C"}, years)
    assert sorted((r.uai, r.school_year, r.ips, r.vacances_zone) for r in out.collect()) == [("a", "2022", 3.0, "C"), ("b", "2023", None, None)]


def test_validations_filters_and_site_report(t, spark):
    rows = sorted((r.organization, r.day.day, r.approved, r.approved_total) for r in R.suivi_validations(t).collect())
    assert rows == [("A", 5, 1, 1)]
    f = {(r.dimension, r.value) for r in R.filter_tables(t).collect()}
    assert ("organization", "B") in f and ("tranche", "none") in f and ("wave", "wave") in f and not any(v is None for _, v in f)
    assert {(r.total, r.organization) for r in R.tarification_2(t).collect()} == {(1, "A"), (1, "B")}
    store = spark.createDataFrame([("u", "m", 1.0, 2.0), ("u", "m", 4.0, 2.0), ("w", "m", 9.0, 3.0)], "uai string, model string, prediction double, effectif_reel double")
    out = R.site_report(store)
    assert out.columns == ["uai", "model", "n", "mae", "rmse", "mape", "bias"] and [(r.uai, r.mae, r.rmse, r.mape) for r in out.collect()] == [("w", 6.0, 6.0, 200.0), ("u", 1.5, 1.58, 75.0)]


def test_constatation_reporting(spark):
    c = spark.createDataFrame([("g", "s", "A", "meal", 1, 10.0, 2.0, 0.5, False), ("g", "s", "A", "meal", 1, 5.0, None, None, None), ("g", "s", "A", "meal", 1, 99.0, 1.0, 1.0, True)],
        "label_group string, subgroup string, tranche_label string, billing_type string, trimestre_id long, bill_amount double, aid_amount double, fee_adjustment_amount double, is_simulation boolean")
    assert [(r.billed, r.aid, r.adjusted, r.bills) for r in R.constatation_reporting({"constatation": c}).collect()] == [(15.0, 2.0, 0.5, 2)]


def test_reports_by_school_year(t, spark, tmp_path):
    R.by_school_year({"tarification_1": R.tarification_1(t)}, str(tmp_path))
    assert (tmp_path / "tarification_1" / "id_school_year=3").is_dir() and spark.read.parquet(str(tmp_path / "tarification_1")).count() == 3
    days = {(r.day.day, r.created, r.deposited, r.approved) for r in R.daily_suivi(t).collect()}
    assert days == {(2, 1, 0, 0), (3, 2, 1, 0), (5, 0, 0, 1)}
