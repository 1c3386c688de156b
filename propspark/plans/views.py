"""Named views and example reports over the star and listing tables
(V1-V7, A2-A15, J10-J17, F8, F15, F16, F22, L1, L2).

Inputs use the property column names of the star schema; every function
is a DataFrame plan.  Indicators, one row per day, are broadcast; other
dimensions are joined plainly or through ``join_dim`` (broadcast after a size
check); top-k reports end in ``orderBy().limit()`` which
plans as a per-partition top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.constants import ENERGY_EXCLUDED, LIFT_LABELS, RATE_BAND_ELSE, RATE_BANDS
from propspark.functions.scalar import band, label_if, month_key, safe_ratio, sql_round
from propspark.operators.joins import bounded_broadcast, join_dim


def _r(c, n=2):
    return sql_round(c, n)


# V1 / J10 -------------------------------------------------------------------
def complete_transactions(mutations: DataFrame, biens: DataFrame, communes: DataFrame,
                          departements: DataFrame, indicateurs: DataFrame) -> DataFrame:
    m, b, c, d, i = (x.alias(a) for x, a in ((mutations, "m"), (biens, "b"), (communes, "c"),
                                               (departements, "d"), (indicateurs, "i")))
    out = (m.join(b, F.col("m.id_bien") == F.col("b.id_bien"))
           .join(c, F.col("m.code_commune") == F.col("c.code_commune"))
           .join(d, F.col("c.code_departement") == F.col("d.code_departement"))
           .join(bounded_broadcast(i), F.col("m.date_mutation") == F.col("i.date_indicateur"), "left"))
    return out.select(
        "m.id_mutation", "m.date_mutation", "m.valeur_fonciere", "m.valeur_fonciere_log",
        "m.nature_mutation", "m.prix_par_m2_habitable", "m.prix_par_m2_terrain",
        "b.id_parcelle", "b.type_local", "b.surface_reelle_bati", "b.surface_terrain",
        "b.longitude", "b.latitude", "c.code_commune",
        F.col("c.nb_menages_2021").alias("nb_menages_commune"),
        F.col("c.revenu_median_2021").alias("revenu_median_commune"),
        "d.code_departement",
        F.col("d.nb_menages_2021").alias("nb_menages_departement"),
        F.col("d.revenu_median_2021").alias("revenu_median_departement"),
        "d.taux_chomage_2023", "d.salaire_net_horaire_moyen_2022",
        "i.credits_habitat_hors_renegociations", "i.taux_hors_renegociations", "i.ipc")


# V2 / J11 / A2 --------------------------------------------------------------
def commune_stats(communes: DataFrame, mutations: DataFrame) -> DataFrame:
    """Communes without sales stay, with count 0 and NULL measures.
    Mutations are pre-aggregated per commune before the join."""
    per = mutations.groupBy("code_commune").agg(
        F.count("id_mutation").alias("nb_transactions"),
        F.sum("valeur_fonciere").alias("_sv"), F.count("valeur_fonciere").alias("_nv"),
        F.sum("prix_par_m2_habitable").alias("_sp"), F.count("prix_par_m2_habitable").alias("_np"),
        F.min("valeur_fonciere").alias("prix_min"), F.max("valeur_fonciere").alias("prix_max"))
    out = communes.select("code_commune", "code_departement").join(per, "code_commune", "left")
    return out.select(
        "code_commune", "code_departement",
        F.coalesce(F.col("nb_transactions"), F.lit(0)).alias("nb_transactions"),
        safe_ratio("_sv", "_nv").alias("prix_moyen"),
        safe_ratio("_sp", "_np").alias("prix_m2_moyen"),
        "prix_min", "prix_max")


# V3 / J12 / A3 --------------------------------------------------------------
def department_stats(departements: DataFrame, communes: DataFrame, mutations: DataFrame) -> DataFrame:
    """Carried dimension columns are grouped on (Q16).  Sales are reduced
    per commune first, then communes per department."""
    per_c = mutations.groupBy("code_commune").agg(
        F.count("id_mutation").alias("n"), F.sum("valeur_fonciere").alias("sv"),
        F.count("valeur_fonciere").alias("nv"), F.sum("prix_par_m2_habitable").alias("sp"),
        F.count("prix_par_m2_habitable").alias("np"))
    per_d = (communes.select("code_commune", "code_departement").join(per_c, "code_commune", "left")
             .groupBy("code_departement")
             .agg(F.sum("n").alias("n"), F.sum("sv").alias("sv"), F.sum("nv").alias("nv"),
                  F.sum("sp").alias("sp"), F.sum("np").alias("np")))
    out = departements.select("code_departement", "revenu_median_2021", "taux_chomage_2023") \
        .join(per_d, "code_departement", "left")
    return out.select("code_departement", "revenu_median_2021", "taux_chomage_2023",
                      F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("nb_transactions"),
                      safe_ratio("sv", "nv").alias("prix_moyen"),
                      safe_ratio("sp", "np").alias("prix_m2_moyen"))


# A7 / J16 -------------------------------------------------------------------
def price_by_type(mutations: DataFrame, biens: DataFrame) -> DataFrame:
    out = mutations.select("id_bien", "valeur_fonciere", "prix_par_m2_habitable") \
        .join(biens.select("id_bien", "type_local"), "id_bien")
    return (out.groupBy("type_local")
            .agg(F.count(F.lit(1)).alias("nb_ventes"), _r(F.avg("valeur_fonciere")).alias("prix_moyen"),
                 _r(F.avg("prix_par_m2_habitable")).alias("prix_m2_moyen"))
            .orderBy(F.desc("prix_moyen"), "type_local"))


# A8 / J17 / L2 --------------------------------------------------------------
def top_departments(mutations: DataFrame, communes: DataFrame, departements: DataFrame,
                    k: int = 5) -> DataFrame:
    """Top-k departments by mean unit price; ties broken by code (Q21).

    Sales are reduced per commune first (count and sum, combined map-side),
    so the dimension joins see one row per commune instead of every sale
    and a commune holding a large share of the sales cannot skew them."""
    per_c = (mutations.filter(F.col("prix_par_m2_habitable").isNotNull())
             .groupBy("code_commune").agg(F.count(F.lit(1)).alias("_n"),
                                          F.sum("prix_par_m2_habitable").alias("_s")))
    c = communes.select("code_commune", "code_departement")
    d = departements.select("code_departement")
    out = join_dim(join_dim(per_c, c, "code_commune", "inner"), d, "code_departement", "inner")
    return (out.groupBy("code_departement")
            .agg(F.sum("_n").alias("nb_ventes"), _r(F.sum("_s") / F.sum("_n")).alias("prix_m2_moyen"))
            .orderBy(F.desc("prix_m2_moyen"), "code_departement").limit(k))


# A9 -------------------------------------------------------------------------
def yearly_prices(mutations: DataFrame, date_col: str = "date_mutation") -> DataFrame:
    return (mutations.groupBy(F.date_format(F.to_date(date_col), "yyyy").alias("annee"))
            .agg(F.count(F.lit(1)).alias("nb_ventes"), _r(F.avg("valeur_fonciere")).alias("prix_moyen"))
            .orderBy("annee"))


# A10 / J15 / F15 ------------------------------------------------------------
def rate_bands(mutations: DataFrame, indicateurs: DataFrame, rate: str = "taux_hors_renegociations") -> DataFrame:
    """A NULL rate falls in the last band (F15).  Sales are reduced per day
    before the join with the (day-keyed) indicators."""
    per_day = (mutations.groupBy("date_mutation")
               .agg(F.count(F.lit(1)).alias("_n"), F.count("valeur_fonciere").alias("_nv"),
                    F.sum("valeur_fonciere").alias("_s")))
    i = indicateurs.select("date_indicateur", rate)
    out = join_dim(per_day, i, F.col("date_mutation") == F.col("date_indicateur"), "inner")
    return (out.groupBy(band(rate, RATE_BANDS, RATE_BAND_ELSE).alias("tranche_taux"))
            .agg(F.sum("_n").alias("nb_ventes"), _r(F.sum("_s") / F.sum("_nv")).alias("prix_moyen"))
            .orderBy("tranche_taux"))


# V4 / J13 / F8 --------------------------------------------------------------
def listing_view(annonces: DataFrame, diagnostics: DataFrame) -> DataFrame:
    a, d = annonces.alias("a"), diagnostics.alias("d")
    out = a.join(d, F.col("a.id") == F.col("d.id_annonce"), "left")
    cols = [c for c in annonces.columns if c != "description"]
    return out.select(*[F.col(f"a.{c}") for c in cols],
                      "d.dpe_valeur", "d.dpe_lettre", "d.ges_valeur", "d.ges_lettre",
                      safe_ratio("a.prix", "a.surface", 2).alias("prix_m2"))


def _listing_measures(price: bool = True, unit: bool = True, area: bool = False, rooms: bool = False,
                      minmax: bool = False, count_col: str = "id"):
    aggs = [F.count(count_col).alias("nb_annonces")]
    if price:
        aggs.append(_r(F.avg("prix")).alias("prix_moyen"))
    if unit:
        aggs.append(_r(F.avg(safe_ratio("prix", "surface"))).alias("prix_m2_moyen"))
    if area:
        aggs.append(_r(F.avg("surface")).alias("surface_moyenne"))
    if rooms:
        aggs.append(_r(F.avg("pieces"), 1).alias("pieces_moyenne"))
    if minmax:
        aggs += [F.min("prix").alias("prix_min"), F.max("prix").alias("prix_max")]
    return aggs


def with_area(annonces: DataFrame) -> DataFrame:
    """P12."""
    return annonces.filter(F.col("surface") > 0)


# V5 / A4 --------------------------------------------------------------------
def town_stats(annonces: DataFrame) -> DataFrame:
    return (with_area(annonces).groupBy("ville", "code_postal")
            .agg(*_listing_measures(area=True, minmax=True))
            .orderBy(F.desc("nb_annonces"), "ville", "code_postal"))


# V6 / A5 --------------------------------------------------------------------
def type_stats(annonces: DataFrame) -> DataFrame:
    return (with_area(annonces).groupBy("type")
            .agg(*_listing_measures(area=True, rooms=True))
            .orderBy(F.desc("nb_annonces"), "type"))


def _energy_join(annonces: DataFrame, diagnostics: DataFrame) -> DataFrame:
    """J14 + P13."""
    d = diagnostics.filter(F.col("dpe_lettre").isNotNull() & ~F.col("dpe_lettre").isin(ENERGY_EXCLUDED))
    return annonces.join(d, F.col("id") == F.col("id_annonce"))


# V7 / A6 --------------------------------------------------------------------
def energy_stats(annonces: DataFrame, diagnostics: DataFrame) -> DataFrame:
    return (_energy_join(with_area(annonces), diagnostics).groupBy("dpe_lettre")
            .agg(*_listing_measures()).orderBy("dpe_lettre"))


# A11 ------------------------------------------------------------------------
def listing_overview(annonces: DataFrame) -> DataFrame:
    return (with_area(annonces).groupBy("type")
            .agg(F.count(F.lit(1)).alias("nb_annonces"), _r(F.avg("prix")).alias("prix_moyen"),
                 _r(F.avg(safe_ratio("prix", "surface"))).alias("prix_m2_moyen"))
            .orderBy(F.desc("nb_annonces"), "type"))


# A12 ------------------------------------------------------------------------
def top_towns(annonces: DataFrame, min_listings: int = 3, k: int = 5) -> DataFrame:
    return (with_area(annonces).groupBy("ville")
            .agg(F.count(F.lit(1)).alias("nb_annonces"),
                 _r(F.avg(safe_ratio("prix", "surface"))).alias("prix_m2_moyen"))
            .filter(F.col("nb_annonces") >= min_listings)
            .orderBy(F.desc_nulls_last("prix_m2_moyen"), "ville").limit(k))


# A13 ------------------------------------------------------------------------
def energy_distribution(annonces: DataFrame, diagnostics: DataFrame) -> DataFrame:
    return (_energy_join(annonces, diagnostics).groupBy("dpe_lettre")
            .agg(F.count(F.lit(1)).alias("nb_annonces"), _r(F.avg("prix")).alias("prix_moyen"))
            .orderBy("dpe_lettre"))


# A14 / F16 ------------------------------------------------------------------
def lift_split(annonces: DataFrame, flat_type: str = "Appartement") -> DataFrame:
    a = with_area(annonces).filter(F.col("type") == flat_type)
    return (a.groupBy("ascenseur")
            .agg(F.count(F.lit(1)).alias("nb_annonces"), _r(F.avg("prix")).alias("prix_moyen"),
                 _r(F.avg(safe_ratio("prix", "surface"))).alias("prix_m2_moyen"))
            .select(label_if(F.col("ascenseur") == 1, *LIFT_LABELS).alias("type_immeuble"),
                    "nb_annonces", "prix_moyen", "prix_m2_moyen"))


# A15 ------------------------------------------------------------------------
def monthly_listings(annonces: DataFrame, k: int = 6, date_col: str = "date_publication") -> DataFrame:
    """Latest k months (a NULL month sorts last in descending order)."""
    return (annonces.groupBy(month_key(F.try_to_date(F.col(date_col).cast("string"))).alias("mois"))
            .agg(F.count(F.lit(1)).alias("nb_annonces"), _r(F.avg("prix")).alias("prix_moyen"))
            .orderBy(F.desc_nulls_last("mois")).limit(k))
