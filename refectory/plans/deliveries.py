"""The delivery and meal reports on the driver's tables: lines stand for movements and meal counts, suppliers for sites, nations for groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import delivery_reports as R
from .base import query, table

#: Tables that some groups keep by site (status 2), and of which remainder of the nation's number those groups are.
BY_SITE = {"ARTICLE": 2, "MVTART_DET": 3, "DETAILARTICLE": 4, "FOURN": 2, "FAMART": 5, "SFAART": 3, "LABEL": 4, "CATEG": 2, "TRIMESTRE": 3, "NTARIF": 4, "TYPSS1": 2, "TYPSS2": 3}


def domain(spark: SparkSession, sf_dir: str) -> R.Tables:
    """The domain's tables made of the driver's; what a group or a site keeps differs where a lookup by the wrong one would show."""
    li, part, supplier, nation = (table(spark, sf_dir, n) for n in ("lineitem", "part", "supplier", "nation"))
    text = lambda c: F.col(c).cast("string")
    group = lambda c: F.concat(F.lit("g"), text(c))
    login = supplier.select(text("s_suppkey").alias("login"), group("s_nationkey").alias("logingroupe"), F.concat(F.lit("c"), text("s_suppkey")).alias("code_site"), (F.col("s_suppkey") % 17 == 0).alias("fictif"), F.lit(2).alias("profil"), F.col("s_name").alias("nometabs"), F.lit("v").alias("ville"), F.lit(1).alias("id_arrondissement"), F.lit(2).alias("id_canton"))
    settings = F.explode(F.array(*(F.struct(F.lit(k).alias("nomfic"), F.lit(v).alias("every")) for k, v in BY_SITE.items())))
    descfic = nation.select("n_nationkey", settings.alias("s")).where("s.nomfic <> 'CATEG' OR n_nationkey <> 24")
    descfic = descfic.select("s.nomfic", group("n_nationkey").alias("login_group"), F.when(F.col("n_nationkey") % F.col("s.every") == 0, 2).otherwise(1).alias("statut"))
    # those who keep a table: every group and every site, dealt out as the many rows that are made of each would else be one task's
    keepers = nation.select(group("n_nationkey").alias("login_site"), F.lit("G").alias("by")).unionByName(supplier.select(text("s_suppkey").alias("login_site"), F.lit("S").alias("by"))).repartition(spark.sparkContext.defaultParallelism)
    few = lambda n: keepers.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"))
    site = text("l_suppkey").alias("login_site")
    movement = li.select(site, (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("mvcleunik"), F.col("l_partkey").alias("arcleunik"), (F.col("l_partkey") % 50).cast("int").alias("f_ocleunik"), F.col("l_shipdate").alias("dtemvt"),
        F.when(F.col("l_linenumber") < 6, "1").otherwise("2").alias("typmvt"), F.col("l_quantity").alias("qtef"), (F.col("l_discount") * 100).alias("puf"), (F.col("l_tax") * 100).alias("taux_tva"), F.col("l_quantity").alias("qteusart"),
        (F.col("l_returnflag") == "R").alias("bio"), F.when(F.col("l_linenumber") == 1, F.col("l_linestatus") == "F").alias("circuit_court"), (F.col("l_linenumber") % 3).cast("int").alias("id_label"), (F.col("l_linenumber") % 4).cast("int").alias("id_origine"))
    # articles: each part for every group, and for the sites that received it
    # told apart and joined in tasks that grow with the lines: a reader's share of lines, or the session's number of tasks, would not do
    had = li.select(site, F.col("l_partkey").alias("p_partkey")).repartition(R.tasks(li), "p_partkey").distinct().join(part.hint("merge"), "p_partkey").unionByName(part.crossJoin(nation.select(group("n_nationkey").alias("login_site"))))
    code = F.concat(F.lit(" "), (F.col("p_size") % 25).cast("string"))
    article = had.select("login_site", F.col("p_partkey").alias("arcleunik"), F.concat(F.lit("c"), text("p_partkey")).alias("codart"), code.alias("codfamart"), F.col("p_brand").alias("sfaart"), (F.col("p_size") % 5 == 0).alias("bio"), F.when(F.col("p_size") % 2 == 0, "KG ").otherwise("L").alias("usart"), (F.col("p_size") % 3 * 0.5).alias("usart_vers_ufam"))
    detail = had.where("p_partkey % 3 = 0").select("login_site", F.concat(F.lit("c"), text("p_partkey")).alias("codart"), (F.col("p_size") % 7 == 0).alias("circuit_court"), (F.col("p_size") % 4).cast("int").alias("id_label"), (F.col("p_size") % 6).cast("int").alias("id_origine"))
    checked = movement.where("mvcleunik DIV 10 % 4 = 0").select("login_site", "mvcleunik")
    checked = checked.unionByName(checked).unionByName(movement.where("mvcleunik DIV 10 % 4 = 0").join(login.select(F.col("login").alias("login_site"), "logingroupe"), "login_site").select(F.col("logingroupe").alias("login_site"), "mvcleunik"))
    i = F.col("i")
    supply = few(50).select("login_site", i.alias("f_ocleunik"), F.concat(F.lit(" "), "by", F.col("i").cast("string")).alias("libfou"), (i % 7 == 0).alias("bio"), F.lit(None).cast("boolean").alias("circuit_court"), (i % 5).alias("id_label"))
    famart = few(25).select("login_site", F.col("i").cast("string").alias("codfamart"), F.concat("by", F.lit("-F"), F.col("i").cast("string")).alias("libfamart"), (i % 4).alias("type"), F.when(i % 5 < 4, "6011 ").otherwise("602").alias("cptfam_1"))
    brands = part.select("p_brand", (F.col("p_size") % 25).cast("string").alias("codfamart")).distinct()
    sfaart = keepers.crossJoin(F.broadcast(brands)).select("login_site", "codfamart", F.col("p_brand").alias("sfaart"), F.concat("by", F.lit("-"), "p_brand").alias("libsfaart"), F.when(F.col("p_brand") == "Brand#13", 2).alias("type"))
    label = few(5).select("login_site", i.alias("id_label"), (i % 2 == 1).alias("egalim"))
    effect = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id_effect"), F.col("l_shipdate").alias("efdate"), F.concat(F.lit(" 0"), (F.col("l_linenumber") % 3 + 1).cast("string")).alias("codss1"), (F.col("l_linenumber") % 6 + 1).cast("string").alias("codss2"), site, F.concat(F.lit("C"), (F.col("l_partkey") % 6).cast("string"), F.lit(" ")).alias("codcat"),
        F.col("l_quantity").alias("efreel"), (F.col("l_quantity") + 1).alias("eftheo"), F.col("l_discount").alias("credit"), F.lit(1).alias("typfac"), F.lit("o").alias("origine"), F.when(F.col("l_linenumber") == 1, F.col("l_shipdate")).alias("date_import"), F.lit(None).cast("timestamp").alias("date_modif"), (F.col("l_partkey") % 3).alias("codcli"))
    categ = few(6).select("login_site", F.concat(F.lit("C"), F.col("i").cast("string")).alias("codcat"), F.concat("by", F.lit("-C"), F.col("i").cast("string")).alias("libcat"), (i % 3).alias("famcat"), F.when(i == 5, True).alias("noncompte"))
    third = F.make_date(1995 + F.floor(i / 3).cast("int"), i % 3 * 4 + 1, F.lit(1))
    trimestre = few(9).select("login_site", (1995 + F.floor(i / 3)).cast("int").alias("exercice"), third.alias("datdeb"), F.date_sub(F.add_months(third, 4), 1).alias("datfin"), (i % 3 + 1).alias("notrim"))
    # one tariff list for each year, service, customer and category; none for the last customer
    n = few(7 * 3 * 2 * 5).select("login_site", "by", (1992 + i % 7).alias("annee"), (F.floor(i / 7) % 3 + 1).cast("string").alias("codss1"), (F.floor(i / 21) % 2).cast("string").alias("codcli"), F.floor(i / 42).cast("int").alias("c"))
    base = F.when(F.col("by") == "S", 100).otherwise(0)
    ntarif = n.select("login_site", "annee", "codss1", "codcli", F.concat(F.lit("C"), text("c")).alias("codcat"), F.to_json(F.transform(F.sequence(F.lit(1), F.lit(15)), lambda k: k * 1.5 + base)).alias("creditbrut"))
    typss = {f"typss{x}": few(7).select("login_site", F.concat(F.lit("0"), F.col("i").cast("string")).alias(f"codss{x}"), F.concat("by", F.lit(f"-s{x}-"), F.col("i").cast("string")).alias(f"libss{x}")) for x in "12"}
    return {"login": login, "descfic": descfic, "mvtart": movement, "article": article, "detail_article": detail, "mvtart_det": checked, "fourn": supply, "famart": famart, "sfaart": sfaart, "label": label, "effect": effect, "categ": categ, "trimestre": trimestre, "ntarif": ntarif} | typss


_BY = lambda name: f"CASE WHEN s_nationkey % {BY_SITE[name]} = 0 THEN 'S' ELSE 'G' END"
_DEL = f"""WITH b AS (SELECT *, CAST(l_shipdate AS DATE) AS jour, p_size % 25 AS fam, l_partkey % 50 AS f, l_orderkey % 4 = 0 AS checked FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE l_linenumber < 6 AND s_suppkey % 17 <> 0),
d AS (SELECT jour, CAST(isoyear(jour) AS VARCHAR) AS annee, lpad(CAST(weekofyear(jour) AS VARCHAR), 2, '0') AS semaine, lpad(CAST(month(jour) AS VARCHAR), 2, '0') AS mois, 'c' || l_suppkey AS code_site, CAST(l_suppkey AS VARCHAR) AS login_site, 'g' || s_nationkey AS logingroup,
 CAST(fam AS VARCHAR) AS famille_article, p_brand AS sous_famille_article, {_BY('FAMART')} || '-F' || fam AS lib_famille_article, {_BY('SFAART')} || '-' || p_brand AS lib_sous_famille_article, {_BY('FOURN')} || f AS libfou, CAST(f AS INTEGER) AS idfou,
 CASE WHEN l_returnflag = 'R' OR (NOT checked AND (p_size % 5 = 0 OR f % 7 = 0)) THEN 1 ELSE 0 END AS bio,
 CASE WHEN (l_linenumber = 1 AND l_linestatus = 'F') OR (NOT checked AND p_partkey % 3 = 0 AND p_size % 7 = 0) THEN 1 ELSE 0 END AS clocal,
 CAST(CASE WHEN l_linenumber % 3 <> 0 OR checked THEN l_linenumber % 3 WHEN p_partkey % 3 = 0 AND p_size % 4 <> 0 THEN p_size % 4 ELSE f % 5 END AS INTEGER) AS label1,
 CAST(CASE WHEN l_linenumber % 4 <> 0 THEN l_linenumber % 4 WHEN p_partkey % 3 = 0 THEN p_size % 6 ELSE 0 END AS INTEGER) AS idorigine,
 l_quantity * (l_discount * 100) * (1 + l_tax * 100 / 100) AS montant, l_quantity * (l_discount * 100) AS montantht,
 CASE WHEN p_size % 3 = 0 THEN CASE WHEN p_size % 2 = 0 THEN l_quantity ELSE 0 END ELSE l_quantity * (p_size % 3 * 0.5) END AS qte FROM b)"""
_FAMILY, _SITE = ", ".join(R.FAMILY), ", ".join(R.SITE)
_SUMS = "sum(qte) AS qte, sum(montant) AS montant, sum(montantht) AS montantht"


@query(f"{_DEL} SELECT annee, semaine, {_SITE}, {_FAMILY}, bio, clocal, label1, {_SUMS} FROM d GROUP BY ALL")
def stats_liv59(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Received goods by week, site, family and origin, each lookup by site or group."""
    return R.stats_liv59(R.deliveries(domain(spark, sf_dir))).drop("__part")


@query(f"{_DEL} SELECT annee, semaine, {_SITE}, {_FAMILY}, bio, clocal, label1, libfou, idfou, {_SUMS} FROM d WHERE jour >= DATE '1995-01-01' AND jour < DATE '1996-01-01' GROUP BY ALL")
def stats_liv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By week and supplier, of one year's slice."""
    return R.stats_liv(R.deliveries(domain(spark, sf_dir), "1995-01-01", "1996-01-01")).drop("__part")


@query(f"{_DEL} SELECT annee, mois, {_SITE}, {_FAMILY}, bio, clocal, label1, idorigine, libfou, idfou, {_SUMS} FROM d GROUP BY ALL")
def stats_liv_mois(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By month, supplier and place of origin."""
    return R.stats_liv_mois(R.deliveries(domain(spark, sf_dir))).drop("__part")


@query(f"{_DEL} SELECT annee, {_SITE}, {_FAMILY}, bio, clocal, label1, idorigine, libfou, idfou, {_SUMS} FROM d GROUP BY ALL")
def stats_liv_annee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By year, supplier and place of origin."""
    return R.stats_liv_annee(R.deliveries(domain(spark, sf_dir))).drop("__part")


_KINDS = {"local": "clocal = 1", "bio": "bio = 1", "egalim": "bio = 1 OR clocal = 1 OR label1 <> 0", "bio_local": "bio = 1 AND clocal = 1"}
_EGALIM = f"code_site, login_site, {_FAMILY}, {_SUMS}, {', '.join(f'sum(CASE WHEN {c} THEN montant ELSE 0 END) AS {k}_valeur' for k, c in _KINDS.items())} FROM d GROUP BY ALL"
_SHARES = ", ".join(f"CASE WHEN montant = 0 THEN 0 ELSE round({k}_valeur / montant * 100, 2) END AS {k}_pct" for k in _KINDS)


@query(f"{_DEL}, e AS (SELECT annee, semaine, {_EGALIM}) SELECT *, {_SHARES} FROM e")
def stats_liv_egalim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of local, organic and labelled goods by week."""
    return R.stats_liv_egalim(R.stats_liv59(R.deliveries(domain(spark, sf_dir)))).drop("__part")


@query(f"{_DEL}, e AS (SELECT jour, {_EGALIM}) SELECT *, {_SHARES} FROM e")
def stats_liv_egalim_jour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by day."""
    return R.stats_liv_egalim(R.deliveries(domain(spark, sf_dir)), "jour").drop("__part")


_DASH = f"""{_DEL}, a AS (SELECT annee, logingroup AS login_group, count(DISTINCT code_site) AS nb_site, CASE WHEN CAST(famille_article AS INTEGER) % 4 = 1 THEN 'viande' WHEN CAST(famille_article AS INTEGER) % 4 = 2 OR sous_famille_article = 'Brand#13' THEN 'poisson' ELSE 'autre' END AS type_produit,
 CASE WHEN clocal = 1 THEN 'local' ELSE 'non local' END AS local_label, CASE WHEN bio = 1 THEN 'bio' ELSE 'non bio' END AS bio_label, CASE WHEN bio = 1 OR label1 % 2 = 1 THEN 'EGALIM' ELSE 'non EGALIM' END AS egalim_label, sum(montant) AS montant, sum(montantht) AS montantht
 FROM d WHERE CAST(famille_article AS INTEGER) % 5 < 4 GROUP BY ALL)"""


@query(f"{_DASH} SELECT * FROM a")
def stats_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts by group, year, kind of product and labels."""
    t = domain(spark, sf_dir)
    return R.stats_dashboard(t, R.stats_liv_annee(R.deliveries(t)))


_KPI = {"bio": "bio_label = 'bio'", "non_bio": "bio_label = 'non bio'", "local": "local_label = 'local'", "non_local": "local_label = 'non local'", "egalim": "egalim_label = 'EGALIM'", "non_egalim": "egalim_label <> 'EGALIM'"} | {
    f"{k}_{e}": f"{c} AND egalim_label {'=' if e == 'egalim' else '<>'} 'EGALIM'" for k, c in (("viande", "type_produit = 'viande'"), ("poisson", "type_produit = 'poisson'"), ("viande_et_poisson", "type_produit <> 'autre'")) for e in ("egalim", "non_egalim")
}
_EFFECT = "SELECT 'g' || n_nationkey AS logingroup, '1996' AS annee, 'dejeuner' AS service, n_nationkey * 10 AS repas_servis, 2.5 AS prix_revient, n_nationkey / 2 AS repas_par_jour, 1 AS repas_par_jour2 FROM nation"


@query(f"""{_DASH} SELECT {', '.join(f"sum(CASE WHEN {c} THEN montantht ELSE 0 END) AS montant_{k}" for k, c in _KPI.items())}, max(nb_site) AS nb_sites, 2.5 AS dejeuner_prix_de_revient, 30.0 AS dejeuner_repas_servis, 1.5 AS dejeuner_repas_par_jour1, 1.0 AS dejeuner_repas_par_jour2,
 0.0 AS journee_prix_de_revient, 0.0 AS journee_repas_servis, 0.0 AS journee_repas_par_jour1, 0.0 AS journee_repas_par_jour2 FROM a WHERE login_group = 'g3' AND annee = '1996'""")
def dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group's year in one row."""
    t, n = domain(spark, sf_dir), F.col("n_nationkey")
    effect = table(spark, sf_dir, "nation").select(F.concat(F.lit("g"), n.cast("string")).alias("logingroup"), F.lit("1996").alias("annee"), F.lit("dejeuner").alias("service"), (n * 10).alias("repas_servis"), F.lit(2.5).alias("prix_revient"), (n / 2).alias("repas_par_jour"), F.lit(1).alias("repas_par_jour2"))
    return R.dashboard_kpis(R.stats_dashboard(t, R.stats_liv_annee(R.deliveries(t))), effect, "g3", "1996", True)


_K = "(3 * (l_linenumber % 6) + CASE WHEN year(l_shipdate) BETWEEN 1995 AND 1997 THEN (month(l_shipdate) - 1) // 4 + 1 ELSE 1 END)"
_DETAIL = f"""WITH d AS (SELECT l_orderkey * 10 + l_linenumber AS id_effect, CAST(l_shipdate AS DATE) AS datej, CAST(l_linenumber % 3 + 1 AS VARCHAR) AS codss1, CAST(l_linenumber % 6 + 1 AS VARCHAR) AS codss2, 'c' || l_suppkey AS code_site, CAST(l_suppkey AS VARCHAR) AS login_site, 'g' || s_nationkey AS logingroup, s_nationkey,
 'C' || (l_partkey % 6) AS codcateg, {_BY('CATEG')} || '-C' || (l_partkey % 6) AS libcateg, CAST(l_partkey % 6 % 3 AS INTEGER) AS typecateg, l_quantity AS effreel, CASE WHEN l_linenumber = 1 THEN CAST(l_shipdate AS TIMESTAMP) ELSE TIMESTAMP '2015-01-01' END AS date_import,
 CASE WHEN {_K} <= 15 AND l_partkey % 3 < 2 AND year(l_shipdate) BETWEEN 1992 AND 1998 THEN {_K} * 1.5 + CASE WHEN {_BY('NTARIF')} = 'S' THEN 100 ELSE 0 END ELSE 0 END AS tarifbrut
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_partkey % 6 <> 5 AND s_nationkey <> 24)"""


@query(f"{_DETAIL} SELECT year(datej) AS y, codss1, codss2, logingroup, codcateg, libcateg, typecateg, count(*) AS n, sum(effreel) AS effreel, sum(tarifbrut) AS tarifbrut, max(tarifbrut) AS most, max(date_import) AS last_import FROM d GROUP BY ALL")
def stats_fcj59_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meal counts with category and gross tariff, in sums."""
    d = R.stats_fcj59_detail(domain(spark, sf_dir))
    keys = (F.year("datej").alias("y"), "codss1", "codss2", "logingroup", "codcateg", "libcateg", "typecateg")
    return d.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("effreel").alias("effreel"), F.sum("tarifbrut").alias("tarifbrut"), F.max("tarifbrut").alias("most"), F.max("date_import").alias("last_import"))


@query(f"""{_DETAIL}, s AS (SELECT CAST(l_shipdate AS DATE) AS datej, CAST(l_linenumber % 3 + 1 AS VARCHAR) AS codss1, CAST(l_linenumber % 6 + 1 AS VARCHAR) AS codss2, CAST(l_suppkey AS VARCHAR) AS login_site, sum(l_quantity) AS efreel FROM lineitem GROUP BY ALL),
g AS (SELECT datej, codss1, codss2, login_site, sum(CASE WHEN typecateg < 2 THEN effreel ELSE 0 END) AS nb_eleves, sum(CASE WHEN typecateg = 2 THEN effreel ELSE 0 END) AS nb_commensaux, max(date_import) AS last_import FROM d GROUP BY ALL)
SELECT s.login_site, s_name AS nometabs, codss1, codss2, {_BY('TYPSS1')} || '-s1-' || codss1 AS libss1, {_BY('TYPSS2')} || '-s2-' || codss2 AS libss2, count(*) AS days, sum(efreel) AS efreel, sum(nb_eleves) AS nb_eleves, sum(nb_commensaux) AS nb_commensaux, max(last_import) AS last_import
FROM s JOIN supplier ON s.login_site = CAST(s_suppkey AS VARCHAR) LEFT JOIN g USING (datej, codss1, codss2, login_site) GROUP BY ALL""")
def stat_effect_cred_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Meals with the labels of site and services, pupils and guests, in sums."""
    from ..functions import scalars as S

    t = domain(spark, sf_dir)
    code: Column = F.concat(F.lit("c"), "login_site")
    effect = t["effect"].select(F.to_date("efdate").alias("datej"), S.code(F.col("codss1")).alias("codss1"), S.code(F.col("codss2")).alias("codss2"), code.alias("code_site"), "login_site", "efreel")
    stats = effect.repartition(R.tasks(t["effect"]), "datej", "login_site").groupBy("datej", "codss1", "codss2", "code_site", "login_site").agg(F.sum("efreel").alias("efreel"))
    wide = R.stat_effect_cred_1(t, stats, R.stats_fcj59_detail(t))
    return wide.groupBy("login_site", "nometabs", "codss1", "codss2", "libss1", "libss2").agg(F.count("*").alias("days"), F.sum("efreel").alias("efreel"), F.sum("nb_eleves").alias("nb_eleves"), F.sum("nb_commensaux").alias("nb_commensaux"), F.max("detail_date_import").alias("last_import"))
