"""The whole sale pipeline (E1) as one query: raw sale files -> model-ready
table, every step a library operator.

raw text rows (orders) -> clean_sales -> POI features by coordinates
(suppliers) -> monthly macro -> commune / department census -> plain sales
-> missing-distance flags -> department-mean income -> literal household
estimates -> exact-quantile price trim -> Lambert-93 -> log price + one-hot.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from propspark.constants import COMMUNE_POPULATION, POI_CATEGORIES
from propspark.functions import scalar as S
from propspark.functions.geo import lambert93_sql
from propspark.operators import clean, features, impute, macro, spatial, star
from propspark.plans.bindings import (DRIVER_RADII, MACRO_MEASURES, MACRO_SQL, category_sql, lat_sql, lon_sql,
                                      monthly_macro, poi_suppliers, radius_case_sql, table)
from propspark.plans.q_sales import _RAW_SALES_SQL, _REST, _SALE_NATURES_SQL, _strict_sql, _tolerant_sql
from propspark.plans.q_sales import raw_sales_from_orders
from propspark.plans.registry import register, with_ctes


def _commune_census(spark, d):
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("code_commune"), F.col("c_name").alias("nom_commune"),
                    F.when(F.col("c_custkey") % 5 != 0, (F.col("c_custkey") % 500 + 100).cast("double"))
                     .alias("nb_menages_2021_commune"),
                    F.when(F.col("c_custkey") % 7 != 0, F.col("c_acctbal")).alias("revenu_median_2021_commune"))


def _dept_census(spark, d):
    n = table(spark, d, "nation")
    return n.select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("code_departement"),
                    (F.col("n_nationkey") * 1000 + 500).cast("double").alias("nb_menages_2021_departement"),
                    (F.col("n_nationkey") * 250 + 20000).cast("double").alias("revenu_median_2021_departement"),
                    (F.col("n_nationkey") + 10).cast("double").alias("salaire_net_horaire_moyen_2022_departement"),
                    (F.col("n_regionkey") * 2 + 5).cast("double").alias("taux_chomage_2023_departement"))


def sales_model_ready_df(spark, d):
    sales = clean.clean_sales(raw_sales_from_orders(spark, d)).drop("_source_file")
    poi = spatial.project(poi_suppliers(spark, d))
    sales = spatial.features_by_coordinates(sales, poi, radii=DRIVER_RADII)
    sales = macro.attach_month(sales, monthly_macro(spark, d), "date_mutation")
    sales = macro.attach_census(sales, _commune_census(spark, d), _dept_census(spark, d))
    sales = clean.plain_sales(sales)
    sales = impute.distance_missing_flags(sales, radii=DRIVER_RADII)
    sales = impute.group_mean_impute(sales, "revenu_median_2021_commune", "code_commune")
    sales = impute.literal_household_fill(sales, impute.households_dim(spark))
    sales, _ = features.quantile_trim(sales, "valeur_fonciere", 0.001, 0.999, lo=1000.0, materialize=True)
    sales = spatial.project(sales)
    return features.log_onehot(sales, "valeur_fonciere", "type_local", vocabulary=["Maison", "Appartement"],
                               log_col="valeur_fonciere_log")


# Floating results computed by different math libraries are compared after
# rounding (projection and log: 2 and 9 decimals, a mean: 6 decimals).
def _rounded(df):
    return df.withColumns({"x_proj": S.sql_round("x_proj", 2), "y_proj": S.sql_round("y_proj", 2),
                           "valeur_fonciere_log": S.sql_round("valeur_fonciere_log", 9),
                           "revenu_median_2021_commune": S.sql_round("revenu_median_2021_commune", 6)})


def _feature_cols_sql(fill: bool) -> str:
    cols = []
    for cat in POI_CATEGORIES:
        d = f"round_even(min(CASE WHEN pr.category = '{cat}' THEN pr.dist END), 2)"
        cols.append(f"CAST(count(CASE WHEN pr.category = '{cat}' THEN 1 END) AS INTEGER) AS nb_{cat}")
        cols.append(f"{d} AS distance_min_{cat}")
    return ",\n         ".join(cols)


_SX, _SY = lambert93_sql(lon_sql("s_suppkey"), lat_sql("s_suppkey"))
_QX, _QY = lambert93_sql("longitude", "latitude")
_LIT = ", ".join(f"('{c}', {p})" for c, p in COMMUNE_POPULATION)
_DIST_FILL = ",\n       ".join(
    f"coalesce(distance_min_{c}, {DRIVER_RADII[c]!r}) AS distance_min_{c}, "
    f"CAST(distance_min_{c} IS NULL AS INTEGER) AS distance_min_{c}_manquante" for c in POI_CATEGORIES)
_DIST_EXCL = ", ".join(f"distance_min_{c}" for c in POI_CATEGORIES)

_PIPE_SQL = with_ctes(
    _RAW_SALES_SQL,
    f"""typed AS (
  SELECT CAST(TRY_STRPTIME(r_date, '%Y-%m-%d') AS DATE) AS date_mutation, r_nature AS nature_mutation,
         {_strict_sql('r_price')} AS valeur_fonciere, code_postal, code_commune, nom_commune, code_departement,
         id_parcelle, r_type AS type_local, {_strict_sql('r_area')} AS surface_reelle_bati,
         adresse_numero, adresse_suffixe, adresse_nom_voie, adresse_code_voie,
         {_strict_sql('r_terrain')} AS surface_terrain,
         {_tolerant_sql('r_lon')} AS longitude, {_tolerant_sql('r_lat')} AS latitude, _source_file
  FROM raw
  WHERE r_nature IN ({_SALE_NATURES_SQL}) AND coalesce(r_type, '') IN ('Appartement', 'Maison')
    AND r_price IS NOT NULL AND r_lat IS NOT NULL AND r_lon IS NOT NULL)""",
    """feat AS (
  SELECT *, strftime(date_mutation, '%Y-%m') AS annee_mois, CAST(year(date_mutation) AS INTEGER) AS annee,
         valeur_fonciere / NULLIF(surface_reelle_bati, 0) AS prix_par_m2_habitable,
         valeur_fonciere / NULLIF(surface_terrain, 0) AS prix_par_m2_terrain
  FROM typed)""",
    f"""cleaned AS (
  SELECT * EXCLUDE (rn, _source_file) FROM (
    SELECT *, row_number() OVER (PARTITION BY _source_file, date_mutation, longitude, latitude, valeur_fonciere, surface_terrain
                                 ORDER BY {', '.join(c + ' NULLS FIRST' for c in _REST)}) AS rn
    FROM feat) WHERE rn = 1)""",
    f"""pts AS (SELECT DISTINCT longitude, latitude, {_QX} AS x, {_QY} AS y FROM cleaned
         WHERE longitude IS NOT NULL AND latitude IS NOT NULL)""",
    f"""p AS (SELECT {category_sql('s_suppkey')} AS category, s_suppkey AS id, {_SX} AS x, {_SY} AS y FROM supplier)""",
    f"""pr AS (SELECT q.longitude, q.latitude, p.category, sqrt((q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y)) AS dist
       FROM pts q JOIN p ON sqrt((q.x - p.x) * (q.x - p.x) + (q.y - p.y) * (q.y - p.y)) <= {radius_case_sql('p.category')})""",
    f"""geo AS (
  SELECT q.longitude, q.latitude,
         {_feature_cols_sql(False)}
  FROM pts q LEFT JOIN pr ON q.longitude = pr.longitude AND q.latitude = pr.latitude
  GROUP BY q.longitude, q.latitude)""",
    MACRO_SQL,
    """cc AS (SELECT CAST(c_custkey AS VARCHAR) AS code_commune,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 500 + 100 AS DOUBLE) END AS nb_menages_2021_commune,
               CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS revenu_median_2021_commune
        FROM customer)""",
    """dc AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code_departement,
               CAST(n_nationkey * 1000 + 500 AS DOUBLE) AS nb_menages_2021_departement,
               CAST(n_nationkey * 250 + 20000 AS DOUBLE) AS revenu_median_2021_departement,
               CAST(n_nationkey + 10 AS DOUBLE) AS salaire_net_horaire_moyen_2022_departement,
               CAST(n_regionkey * 2 + 5 AS DOUBLE) AS taux_chomage_2023_departement FROM nation)""",
    f"""lit(code_commune, population) AS (VALUES {_LIT})""",
    """joined AS (
  SELECT s.*, g.* EXCLUDE (longitude, latitude),
         m.credits_habitat_hors_renegociations, m.taux_hors_renegociations,
         m.variations_encours_mensuelles_cvs, m.ipc,
         cc.nb_menages_2021_commune, cc.revenu_median_2021_commune,
         dc.nb_menages_2021_departement, dc.revenu_median_2021_departement,
         dc.salaire_net_horaire_moyen_2022_departement, dc.taux_chomage_2023_departement
  FROM cleaned s
  LEFT JOIN geo g ON s.longitude = g.longitude AND s.latitude = g.latitude
  LEFT JOIN macro m ON strftime(s.date_mutation, '%Y-%m') = strftime(m."Date", '%Y-%m')
  LEFT JOIN cc ON s.code_commune = cc.code_commune
  LEFT JOIN dc ON s.code_departement = dc.code_departement
  WHERE s.nature_mutation = 'Vente')""",
    f"""filled AS (
  SELECT * EXCLUDE ({_DIST_EXCL}, revenu_median_2021_commune, nb_menages_2021_commune),
       {_DIST_FILL},
       coalesce(revenu_median_2021_commune,
                avg(revenu_median_2021_commune) OVER (PARTITION BY
                  CASE WHEN substr(code_commune, 1, 2) IN ('97', '98') THEN substr(code_commune, 1, 3)
                       ELSE substr(code_commune, 1, 2) END)) AS revenu_median_2021_commune,
       coalesce(nb_menages_2021_commune,
                CAST((SELECT CAST(round(population / 2.2) AS INTEGER) FROM lit WHERE lit.code_commune = joined.code_commune) AS DOUBLE))
         AS nb_menages_2021_commune
  FROM joined)""",
    """q AS (SELECT quantile_cont(valeur_fonciere, 0.999) AS hi FROM filled)""",
)

_PIPE_SELECT = f"""
SELECT f.*, round({_QX.replace('longitude', 'f.longitude').replace('latitude', 'f.latitude')}, 2) AS x_proj,
       round({_QY.replace('longitude', 'f.longitude').replace('latitude', 'f.latitude')}, 2) AS y_proj,
       round(ln(f.valeur_fonciere), 9) AS valeur_fonciere_log,
       CAST(f.type_local = 'Maison' AS INTEGER) AS type_local__Maison,
       CAST(f.type_local = 'Appartement' AS INTEGER) AS type_local__Appartement
FROM filled f, q WHERE f.valeur_fonciere >= 1000.0 AND f.valeur_fonciere <= q.hi"""


@register("sales_model_ready", (_PIPE_SQL + _PIPE_SELECT).replace(
    "SELECT f.*,", "SELECT f.* EXCLUDE (revenu_median_2021_commune), round(f.revenu_median_2021_commune, 6) AS revenu_median_2021_commune,"))
def sales_model_ready(spark, d):
    return _rounded(sales_model_ready_df(spark, d))


_PROX_COLS = []
for _c in POI_CATEGORIES:
    _PROX_COLS += [f"nb_{_c}", f"distance_min_{_c}", f"distance_min_{_c}_manquante"]


@register("star_proximite", _PIPE_SQL + f""",
trimmed AS (SELECT f.* FROM filled f, q WHERE f.valeur_fonciere >= 1000.0 AND f.valeur_fonciere <= q.hi)
SELECT row_number() OVER (ORDER BY id_parcelle) AS id_proximite,
       row_number() OVER (ORDER BY id_parcelle) AS id_bien,
       {', '.join(_PROX_COLS)}
FROM trimmed""")
def star_proximite(spark, d):
    """K3 proximity table from the model-ready sales, ids in parcel order."""
    flat = sales_model_ready_df(spark, d)
    tables = star.build_star(flat, ["id_parcelle"], bien_cols=["id_parcelle", "type_local"],
                             mutation_cols=["date_mutation", "valeur_fonciere"],
                             indicator_measures={m: m for m in MACRO_MEASURES})
    return tables["proximite"]


@register("model_ready_sample", _PIPE_SQL + """,
trimmed AS (SELECT f.* FROM filled f, q WHERE f.valeur_fonciere >= 1000.0 AND f.valeur_fonciere <= q.hi)
SELECT id_parcelle, valeur_fonciere, code_commune FROM trimmed
ORDER BY md5(concat_ws('|', id_parcelle, '42')), id_parcelle LIMIT 1000""")
def model_ready_sample(spark, d):
    """L3: reproducible sample of the model-ready table (the delivered
    sample is drawn with seed 42)."""
    flat = sales_model_ready_df(spark, d).select("id_parcelle", "valeur_fonciere", "code_commune")
    return features.hash_sample(flat, 1000, ["id_parcelle"], seed=42)
