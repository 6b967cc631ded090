"""Report tables over the domain's own tables (R). Each takes frames by name and returns the report; FIXTURES.md has the columns.

Tenants differ by settings only: whether person and group names are shown, and which tranches exist.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import windows as W
from ..spec import TenantConfig

Tables = dict[str, DataFrame]
STATUS = {"approved": ["approved"], "pending": ["pending"], "rejected": ["rejected"], "draft": ["draft"]}


def registration_star(t: Tables) -> DataFrame:
    """Registrations with session, organisation, wave, school year, the user's yearly snapshot, tranche and subgroup."""
    r = t["registration"].select(F.col("id").alias("registration_id"), "status", "id_session", "id_user", "tranche_id", "subgroup_id", F.col("choice_bank_detail").alias("own_choice"), F.col("created_at").alias("registered_at"), F.col("updated_at").alias("changed_at"))
    s = t["session"].select(F.col("id").alias("id_session"), "id_organization", "id_vague")
    v = t["vague"].select("id_vague", F.col("name").alias("wave"), "id_school_year")
    y = t["school_year"].select(F.col("school_year_id").alias("id_school_year"), F.col("label").alias("school_year"))
    o = t["organization"].select("id_organization", F.col("name").alias("organization"), "city", "type", "department", "ips")
    u = t["user_info_school_year"].select("id_user", F.col("school_year_id").alias("id_school_year"), "label_tranche", "label_subgroup", "label_group", "choice_bank_details")
    k = t["tranche"].select(F.col("id_tranche").alias("tranche_id"), F.col("label").alias("tranche_label"))
    g = t["subgroup"].select(F.col("id_subgroup").alias("subgroup_id"), F.col("label").alias("subgroup_label"), "facturation_type")
    star = r.join(s, "id_session").join(o, "id_organization").join(v, "id_vague").join(y, "id_school_year", "left")
    star = star.join(u, ["id_user", "id_school_year"], "left").join(k, "tranche_id", "left").join(g, "subgroup_id", "left")
    return star.withColumns({"tranche": S.effective(F.col("label_tranche"), F.col("tranche_label"), F.lit("none")), "subgroup": S.effective(F.col("label_subgroup"), F.col("subgroup_label")), "billing": F.coalesce("facturation_type", F.lit("autre")), "choice": S.effective(F.col("choice_bank_details"), F.col("own_choice"))})


def tarification_1(t: Tables, cfg: TenantConfig | None = None) -> DataFrame:
    """Files by organisation, wave, tranche and billing class."""
    return A.counts_by(registration_star(t), ["id_school_year", "school_year", "organization", "wave", "tranche", "billing"], "status", STATUS, {"unfinished": ["approved", "rejected"]})


def tarification_2(t: Tables, cfg: TenantConfig | None = None) -> DataFrame:
    """R2: files by status, subgroup and way of payment."""
    return A.counts_by(registration_star(t), ["id_school_year", "organization", "wave", "subgroup", "choice"], "status", STATUS)


def passages(t: Tables) -> DataFrame:
    """Personal passages and counted ones of partners, nb being the weight."""
    p = t["passage"].select("id_organization", F.col("date").alias("at"), F.col("id_service"), "id_tranche", "id_user", "id_subgroup", F.lit(1.0).alias("nb"))
    m = W.latest(t["subgroup_mapping"], ["subgroup"], [F.desc_nulls_last("id_subgroupmaping")]).select("subgroup", F.col("id_subgroup").alias("mapped"))
    x = t["passage_partner"].join(m, "subgroup", "left")
    x = x.select("id_organization", F.col("date").alias("at"), F.col("service").alias("id_service"), F.col("tranche").cast("long").alias("id_tranche"), F.lit(None).cast("double").alias("id_user"), F.col("mapped").alias("id_subgroup"), F.coalesce("nb_passages", F.lit(0.0)).alias("nb"))
    return p.unionByName(x)


def passage_star(t: Tables) -> DataFrame:
    """Passages with service, organisation, tranche, subgroup, the latest started wave and the school year of the day."""
    p = passages(t).join(t["organization"].select("id_organization", F.col("name").alias("organization")), "id_organization", "left")
    p = p.join(t["service"].select("id_service", "id_organization", F.col("label").alias("service")), ["id_service", "id_organization"], "left")
    p = p.join(t["tranche"].select("id_tranche", F.col("label").alias("tranche"), "indice"), "id_tranche", "left").join(t["subgroup"].select("id_subgroup", F.col("label").alias("subgroup"), "id_group"), "id_subgroup", "left")
    p = J.latest_started(p, "at", t["vague"].select("id_vague", F.col("name").alias("wave"), F.col("start_date").alias("wave_start")), "wave_start", ["id_vague", "wave"], "id_vague")
    return J.within_period(p, "at", t["school_year"].select("school_year_id", F.col("label").alias("school_year"), "start_date", "end_date"), "start_date", "end_date", "left")


def tarification_3(t: Tables) -> DataFrame:
    """Passages by day, organisation, tranche and service."""
    return passage_star(t).groupBy(F.to_date("at").alias("day"), "organization", F.coalesce("tranche", F.lit("none")).alias("tranche"), "service", "school_year", "wave").agg(F.sum("nb").alias("passages"))


def tarification_passages(t: Tables, tranches: int = 14) -> DataFrame:
    """Passages by day with a column for each tranche; the columns add up to the total, with those of no tranche."""
    own = [A.sum_if(F.col("indice") == i, F.col("nb")).alias(f"tranche_{i}") for i in range(1, tranches + 1)]
    return passage_star(t).groupBy(F.to_date("at").alias("day"), "organization", "service", "wave").agg(F.sum("nb").alias("total"), *own, A.sum_if(~F.coalesce(F.col("indice").between(1, tranches), F.lit(False)), F.col("nb")).alias("tranche_none"))


def passages_detail(t: Tables) -> DataFrame:
    """Passages by day with subgroup and group."""
    g = t["group"].select("id_group", F.col("label").alias("group_label"))
    return passage_star(t).join(g, "id_group", "left").groupBy(F.to_date("at").alias("day"), "organization", "group_label", "subgroup", "tranche", "service").agg(F.sum("nb").alias("passages"))


def registration_events(t: Tables) -> DataFrame:
    """Creations, first deposits and approvals with 0/1 columns; dimensions are joined once, after the union."""
    h = t["history"].groupBy("registration_id", "event").agg(F.min("created_at").alias("at"))
    kinds = ("created", "deposited", "approved")
    made = t["registration"].select(F.col("id").alias("registration_id"), F.col("created_at").alias("at"), F.lit("created").alias("event"))
    all_ = made.unionByName(h.where(F.col("event").isin("deposited", "approved")).select("registration_id", "at", "event"))
    return all_.select("registration_id", F.to_date("at").alias("day"), *(F.when(F.col("event") == k, 1).otherwise(0).alias(k) for k in kinds))


def suivi_inscriptions(t: Tables) -> DataFrame:
    """For each wave every day for every organisation, with daily counts and running totals of each kind."""
    e = registration_events(t).join(registration_star(t).select("registration_id", "wave", "organization"), "registration_id")
    kinds = ["created", "deposited", "approved"]
    return W.running(J.densify(e, "day", "wave", "organization", kinds), ["wave", "organization"], ["day"], {f"{k}_total": k for k in kinds})


def suivi_validations(t: Tables) -> DataFrame:
    """For each wave every day for every organisation, with the approvals of the day and their running total."""
    e = registration_events(t).where("approved = 1").join(registration_star(t).select("registration_id", "wave", "organization"), "registration_id")
    return W.running(J.densify(e, "day", "wave", "organization", ["approved"]), ["wave", "organization"], ["day"], {"approved_total": "approved"})


def filter_tables(t: Tables) -> DataFrame:
    """The distinct values of each dimension that reports are filtered by, as (dimension, value)."""
    star = registration_star(t)
    dims = ["school_year", "organization", "type", "department", "wave", "tranche", "subgroup", "billing"]
    values = star.select(F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims))).alias("v")).select("v.*")
    return values.where("value is not null").distinct()


def daily_suivi(t: Tables) -> DataFrame:
    """R12."""
    return registration_events(t).groupBy("day").agg(*(F.sum(k).alias(k) for k in ("created", "deposited", "approved")))


def constatation_reporting(t: Tables) -> DataFrame:
    """Billed and paid amounts by group, tranche, billing type and trimester, of bills that are no simulation."""
    c = t["constatation"].where(~F.coalesce(F.col("is_simulation"), F.lit(False)))
    return c.groupBy("label_group", "subgroup", "tranche_label", "billing_type", "trimestre_id").agg(F.sum("bill_amount").alias("billed"), F.sum("aid_amount").alias("aid"), F.sum("fee_adjustment_amount").alias("adjusted"), F.count("*").alias("bills"))


def dernier_passage(t: Tables) -> DataFrame:
    """Every organisation's last passage, nulls last when shown."""
    last = passages(t).groupBy("id_organization").agg(F.max("at").alias("last_passage"))
    return t["organization"].select("id_organization", F.col("name").alias("organization")).join(last, "id_organization", "left")


def user_info_school_year(t: Tables) -> DataFrame:
    """Each user's latest registration of a school year with tranche, subgroup, group and way of payment."""
    star = registration_star(t)
    return W.latest(star, ["id_user", "id_school_year"], [F.desc_nulls_last("changed_at"), F.desc_nulls_last("registration_id")]).select("id_user", "id_school_year", "tranche", "subgroup", "choice", "changed_at")


def registration_enrich(t: Tables) -> DataFrame:
    """Missing tranche and payment of registrations, from the user's latest bank details."""
    b = W.latest(t["bankdetail"], ["id_user"], [F.desc_nulls_last("updated_at"), F.desc_nulls_last("bank_detail_id")]).select("id_user", F.col("choice_bank_details").alias("__c"), F.col("id_tranche").alias("__t"))
    return t["registration"].join(b, "id_user", "left").withColumns({"choice_bank_detail": F.coalesce("choice_bank_detail", "__c"), "tranche_id": F.coalesce(F.col("tranche_id").cast("double"), "__t").cast("long")}).drop("__c", "__t")


def meals(t: Tables) -> DataFrame:
    """Meals, credit and stock-out by day, meal, service and site, animations and menu types as columns."""
    keys = ["datej", "codss1", "codss2", "login_site"]
    norm = lambda df, d: df.withColumns({"datej": F.to_date(d), "codss1": S.code(F.col("codss1")), "codss2": S.code(F.col("codss2"))})
    e = norm(t["effect"], "efdate").groupBy(*keys).agg(F.sum("efreel").cast("double").alias("efreel"), F.sum("credit").alias("totcredit"))
    own = norm(t["mvtart"], "dtemvt")
    out = own.where("typmvt = 2 AND coalesce(codcpt, '') <> '6011'") if "codcpt" in own.columns else own.where("typmvt = 2")
    m = out.groupBy(*keys).agg(F.sum(S.amount(F.col("qteart"), F.col("pmpart"))).alias("totsortie"))
    if "codcpt" in own.columns:
        special = own.where("codcpt = '6011'").withColumn("totsortie", S.amount(F.col("qteart"), F.col("pmpart")))
        m = A.consolidated(m, special, ["datej", "codss2", "login_site"], "codss1", "1", "totsortie")
    j = J.full_outer_zero(e, m, keys, ["efreel", "totcredit", "totsortie"])
    f = norm(t["feuille"], "efdate")
    f = W.latest(f, keys, [F.desc_nulls_last("fecleunik")])
    extra = [c.alias(f"{n}_{i + 1}") for n in ("id_animation", "type_menu") for i, c in enumerate(S.json_columns(F.col(n)))]
    return j.join(f.select(*keys, "nb_vegetarien", *extra), keys, "left")


def recap_site(stats: DataFrame) -> DataFrame:
    """From the start of the year by site: meals, stock-outs, those of services 1 to 5, and the cost of a meal."""
    services = [str(i) for i in range(1, 6)]
    rows = stats.withColumn("datestat", F.to_date("datej")).na.drop(subset=["login_site", "datestat"]).withColumn("year", F.year("datestat"))
    w = A.wide_sums(rows, ["login_site", "year", "datestat"], "codss2", services, {"neffserv": "efreel", "vtotsorserv": "totsortie"})
    w = w.join(rows.groupBy("login_site", "year", "datestat").agg(F.sum("efreel").alias("neff"), F.sum("totsortie").alias("vtotsor")), ["login_site", "year", "datestat"])
    names = ["neff", "vtotsor", *(f"{n}_{c}" for n in ("neffserv", "vtotsorserv") for c in services)]
    r = W.running(w, ["login_site", "year"], ["datestat"], {f"{n}_ytd": n for n in names})
    return r.select("login_site", "datestat", *(F.col(f"{n}_ytd").alias(n) for n in names), S.ratio(F.col("vtotsor_ytd"), F.col("neff_ytd"), 1, 4).alias("rpr"))


def dashboard_effect(recap: DataFrame, working: DataFrame) -> DataFrame:
    """By year meals, meals a working day, sites and the cost of a meal, from each site's last recap of the year."""
    last = W.latest(recap.withColumn("annee", F.year("datestat")), ["login_site", "annee"], [F.desc("datestat")])
    g = last.groupBy("annee").agg(F.sum("neff").alias("repas_servis"), F.count_distinct("login_site").alias("nb_sites"), F.sum("vtotsor").alias("__out"))
    return g.join(working, "annee", "left").select("annee", "repas_servis", "nb_sites", S.ratio(F.col("repas_servis"), F.col("working_days")).alias("repas_par_jour"), S.ratio(F.col("__out"), F.col("repas_servis"), 1, 4).alias("prix_revient"))


def dashboard_general(t: Tables, criteria: Column | None = None) -> DataFrame:
    """By organisation, files and approved ones by tranche, their rate, and the share of enrolment."""
    star = registration_star(t)
    star = star.where(criteria) if criteria is not None else star
    n = star.groupBy("id_organization", "organization").agg(F.count("*").alias("files"), F.count_if(F.col("status") == "approved").alias("approved"))
    by = star.groupBy("id_organization").pivot("tranche", list("ABCDEFGH")).agg(F.count(F.lit(1))).na.fill(0)
    e = t["organization_enrollment"].groupBy(F.col("organization_id").cast("double").alias("id_organization")).agg(F.max("total_enrollment").alias("enrolled"))
    out = n.join(by, "id_organization", "left").join(e, "id_organization", "left")
    return out.withColumns({"approved_pct": S.ratio(F.col("approved"), F.col("files"), 100), "enrolled_pct": S.ratio(F.col("approved"), F.col("enrolled"), 100)})


def etablissement_detail(directory: DataFrame, index: DataFrame, zones: dict[int, str], years: DataFrame) -> DataFrame:
    """Schools with the largest index of a year, a row a year for those without any, and the academy's zone."""
    best = index.groupBy("uai", "school_year").agg(F.max("ips").alias("ips"))
    full = J.filled_years(best, directory.select("uai").distinct(), "uai", years, "school_year", "ips")
    one = W.latest(directory, ["uai"], [F.asc_nulls_last("nom_etablissement")])
    return one.join(full, "uai", "left").withColumn("vacances_zone", S.labelled(F.col("code_academie").try_cast("int"), zones))


def constatation_load(payloads: DataFrame, schema: str, kept: dict[str, str]) -> DataFrame:
    """The latest payload of each constatation that is no simulation, a row for each bill, under new names."""
    last = payloads.where(~F.coalesce(F.col("is_simulation"), F.lit(False))).groupBy("constatation_id").agg(F.max_by("payload", "payload_index").alias("payload"))
    rows = last.select("constatation_id", F.explode(F.from_json("payload", f"array<{schema}>")).alias("b"))
    return rows.select("constatation_id", *(F.col(f"b.{k}").alias(v) for k, v in kept.items()))


def best_predictions(store: DataFrame, priority: dict[str, int], every_model: bool = False) -> DataFrame:
    """By site and day the forecast of the first model, then of the shortest horizon; with every_model all of them as a map."""
    best = W.by_priority(store, ["uai", "target_date"], "model", priority, "horizon").select("uai", "target_date", "model", "horizon", "prediction")
    if not every_model:
        return best
    one = W.latest(store, ["uai", "target_date", "model"], [F.col("horizon")])
    maps = one.groupBy("uai", "target_date").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", "prediction")))).alias("models"))
    return best.join(maps, ["uai", "target_date"])


def accuracy_report(store: DataFrame) -> DataFrame:
    """Errors over all, by horizon bin, by site, and by both."""
    f = store.withColumn("bin", S.horizon_bin(F.col("horizon")))
    return A.metrics_by_sets(f, ["uai", "model", "bin"], [["model"], ["model", "bin"], ["uai", "model"], ["uai", "model", "bin"]], "effectif_reel", "prediction")


def site_report(store: DataFrame, digits: int = 2) -> DataFrame:
    """Errors by site and model, rounded, columns in a fixed order, the worst sites first."""
    m = A.error_metrics(store, ["uai", "model"], "effectif_reel", "prediction")
    cols = ["uai", "model", "n", "mae", "rmse", "mape", "bias"]
    return m.select(*(F.round(c, digits).alias(c) if c in cols[3:] else F.col(c) for c in cols)).orderBy(F.desc_nulls_last("mae"), "uai", "model")


def by_school_year(reports: dict[str, DataFrame], path: str) -> None:
    """Each report as Parquet by school year, in one write."""
    for name, df in reports.items():
        df.write.mode("overwrite").partitionBy("id_school_year").parquet(f"{path}/{name}")
