"""Property roles bound to the generic driver tables.

Each role is given twice, as a Spark builder and as the equivalent SQL
common-table expression used by the DuckDB oracle, so both engines derive
the very same inputs from the given tables:

* sale (mutation)      = ``orders``   (price o_totalprice, date o_orderdate,
  nature o_orderpriority, type o_orderstatus, commune o_custkey; areas are
  derived from the key, some are 0)
* commune              = ``customer`` (department c_nationkey)
* department           = ``nation``
* monthly indicators   = ``lineitem`` by month of ``l_shipdate``
* listing              = ``part``     (town p_brand, type p_type, area p_size - 1)
* point of interest    = ``supplier`` (category s_suppkey % 9)
* property coordinates from a key k, in both engines:
  ``lon = -1 + (k*7919 % 9000)/1000``, ``lat = 43 + (k*104729 % 7000)/1000``.

Values that the oracle compares are produced with integer arithmetic or
plain casts, so no engine-specific number formatting is involved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propspark.functions import scalar as S

from propspark.constants import ENERGY_LETTERS, POI_CATEGORIES
from propspark.functions.scalar import safe_ratio
from propspark.sources.files import read_table

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (S6); small single-split files are spread over the cores."""
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ coordinates
def lon_of(k) -> F.Column:
    k = F.col(k) if isinstance(k, str) else k
    return F.lit(-1.0) + (k * 7919 % 9000).cast("double") / 1000.0


def lat_of(k) -> F.Column:
    k = F.col(k) if isinstance(k, str) else k
    return F.lit(43.0) + (k * 104729 % 7000).cast("double") / 1000.0


def lon_sql(k: str) -> str:
    return f"(-1.0 + CAST(({k} * 7919) % 9000 AS DOUBLE) / 1000.0)"


def lat_sql(k: str) -> str:
    return f"(43.0 + CAST(({k} * 104729) % 7000 AS DOUBLE) / 1000.0)"


# Radii for the driver POIs: 20 km .. 60 km so that hits and misses occur.
DRIVER_RADII = {c: 20000.0 + 5000.0 * i for i, c in enumerate(POI_CATEGORIES)}


def category_sql(k: str) -> str:
    arr = ", ".join(f"'{c}'" for c in POI_CATEGORIES)
    return f"([{arr}])[({k} % 9) + 1]"


def radius_case_sql(cat: str) -> str:
    whens = " ".join(f"WHEN '{c}' THEN {r!r}" for c, r in DRIVER_RADII.items())
    return f"(CASE {cat} {whens} END)"


# ------------------------------------------------------------------------ sales
def sales(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    s = o.select(
        F.col("o_orderkey").alias("id_mutation"),
        F.to_date("o_orderdate").alias("date_mutation"),
        F.col("o_totalprice").alias("valeur_fonciere"),
        F.col("o_orderpriority").alias("nature_mutation"),
        F.col("o_orderstatus").alias("type_local"),
        F.col("o_custkey").alias("code_commune"),
        ((F.col("o_orderkey") % 97) * 2).cast("double").alias("surface_reelle_bati"),
        ((F.col("o_orderkey") % 89) * 10).cast("double").alias("surface_terrain"))
    return s.withColumns({
        "prix_par_m2_habitable": safe_ratio("valeur_fonciere", "surface_reelle_bati"),
        "prix_par_m2_terrain": safe_ratio("valeur_fonciere", "surface_terrain")})


SALES_SQL = """sales AS (
  SELECT o_orderkey AS id_mutation, CAST(o_orderdate AS DATE) AS date_mutation,
         o_totalprice AS valeur_fonciere, o_orderpriority AS nature_mutation,
         o_orderstatus AS type_local, o_custkey AS code_commune,
         CAST((o_orderkey % 97) * 2 AS DOUBLE) AS surface_reelle_bati,
         CAST((o_orderkey % 89) * 10 AS DOUBLE) AS surface_terrain,
         o_totalprice / NULLIF(CAST((o_orderkey % 97) * 2 AS DOUBLE), 0) AS prix_par_m2_habitable,
         o_totalprice / NULLIF(CAST((o_orderkey % 89) * 10 AS DOUBLE), 0) AS prix_par_m2_terrain
  FROM orders)"""


def communes(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(F.col("c_custkey").alias("code_commune"),
                    F.col("c_nationkey").alias("code_departement"),
                    (F.col("c_custkey") % 500 + 100).cast("double").alias("nb_menages_2021"),
                    F.col("c_acctbal").alias("revenu_median_2021"))


COMMUNES_SQL = """communes AS (
  SELECT c_custkey AS code_commune, c_nationkey AS code_departement,
         CAST(c_custkey % 500 + 100 AS DOUBLE) AS nb_menages_2021,
         c_acctbal AS revenu_median_2021
  FROM customer)"""


def departements(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    return n.select(F.col("n_nationkey").alias("code_departement"),
                    (F.col("n_nationkey") * 1000 + 500).cast("double").alias("nb_menages_2021"),
                    (F.col("n_nationkey") * 250 + 20000).cast("double").alias("revenu_median_2021"),
                    (F.col("n_regionkey") * 2 + 5).cast("double").alias("taux_chomage_2023"),
                    (F.col("n_nationkey") + 10).cast("double").alias("salaire_net_horaire_moyen_2022"))


DEPARTEMENTS_SQL = """departements AS (
  SELECT n_nationkey AS code_departement,
         CAST(n_nationkey * 1000 + 500 AS DOUBLE) AS nb_menages_2021,
         CAST(n_nationkey * 250 + 20000 AS DOUBLE) AS revenu_median_2021,
         CAST(n_regionkey * 2 + 5 AS DOUBLE) AS taux_chomage_2023,
         CAST(n_nationkey + 10 AS DOUBLE) AS salaire_net_horaire_moyen_2022
  FROM nation)"""


def monthly_macro(spark: SparkSession, d: str) -> DataFrame:
    """Monthly series from lineitem: one row per month (bounded by months)."""
    li = table(spark, d, "lineitem")
    return (li.withColumn("_m", F.trunc(F.to_date("l_shipdate"), "month")).groupBy(F.col("_m").alias("Date"))
            .agg(S.sql_round(F.month(F.first("_m")) % 5 + F.avg("l_discount") * 10, 6).alias("taux_hors_renegociations"),
                 (F.count(F.lit(1)) / 100.0).alias("credits_habitat_hors_renegociations"),
                 S.sql_round(F.avg("l_tax") * 100, 6).alias("variations_encours_mensuelles_cvs"),
                 S.sql_round(F.avg("l_quantity"), 6).alias("ipc")))


MACRO_SQL = """macro AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date",
         round(month(date_trunc('month', l_shipdate)) % 5 + avg(l_discount) * 10, 6) AS taux_hors_renegociations,
         count(*) / 100.0 AS credits_habitat_hors_renegociations,
         round(avg(l_tax) * 100, 6) AS variations_encours_mensuelles_cvs,
         round(avg(l_quantity), 6) AS ipc
  FROM lineitem GROUP BY date_trunc('month', l_shipdate))"""

MACRO_MEASURES = ["credits_habitat_hors_renegociations", "taux_hors_renegociations",
                  "variations_encours_mensuelles_cvs", "ipc"]


# --------------------------------------------------------------------- listings
def annonces(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("p_partkey") % 200).cast("int")).alias("date_publication"),
        F.col("p_type").alias("type"),
        F.col("p_retailprice").alias("prix"),
        (F.col("p_size") - 1).cast("double").alias("surface"),
        (F.col("p_size") % 7 + 1).alias("pieces"),
        (F.col("p_partkey") % 2).cast("int").alias("ascenseur"),
        F.col("p_brand").alias("ville"),
        F.concat(F.lit("CP"), (F.col("p_partkey") % 3).cast("string")).alias("code_postal"))


ANNONCES_SQL = """annonces AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id,
         CAST(DATE '2024-01-01' + CAST(p_partkey % 200 AS INTEGER) AS DATE) AS date_publication,
         p_type AS type, p_retailprice AS prix, CAST(p_size - 1 AS DOUBLE) AS surface,
         p_size % 7 + 1 AS pieces, CAST(p_partkey % 2 AS INTEGER) AS ascenseur,
         p_brand AS ville, 'CP' || CAST(p_partkey % 3 AS VARCHAR) AS code_postal
  FROM part)"""


def diagnostics(spark: SparkSession, d: str) -> DataFrame:
    """Energy diagnostics for parts of size <= 45; letter from the key,
    ``NULL`` for every 11th key; two non-letter values included."""
    letters = ENERGY_LETTERS + [None]
    p = table(spark, d, "part").filter(F.col("p_size") <= 45)
    arr = F.array(*[F.lit(x) for x in letters])
    return p.select(F.col("p_partkey").cast("string").alias("id_annonce"),
                    ((F.col("p_partkey") % 400) + 50).cast("double").alias("dpe_valeur"),
                    F.element_at(arr, (F.col("p_partkey") % 10 + 1).cast("int")).alias("dpe_lettre"),
                    ((F.col("p_partkey") % 90) + 5).cast("double").alias("ges_valeur"),
                    F.element_at(arr, ((F.col("p_partkey") * 7) % 10 + 1).cast("int")).alias("ges_lettre"))


def _letters_sql() -> str:
    return "[" + ", ".join([f"'{x}'" for x in ENERGY_LETTERS] + ["NULL"]) + "]"


DIAGNOSTICS_SQL = f"""diagnostics AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id_annonce,
         CAST(p_partkey % 400 + 50 AS DOUBLE) AS dpe_valeur,
         ({_letters_sql()})[p_partkey % 10 + 1] AS dpe_lettre,
         CAST(p_partkey % 90 + 5 AS DOUBLE) AS ges_valeur,
         ({_letters_sql()})[(p_partkey * 7) % 10 + 1] AS ges_lettre
  FROM part WHERE p_size <= 45)"""


# -------------------------------------------------------------------- POI roles
def poi_suppliers(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as POIs: (category, id, lon, lat)."""
    s = table(spark, d, "supplier")
    cats = F.array(*[F.lit(c) for c in POI_CATEGORIES])
    return s.select(F.element_at(cats, (F.col("s_suppkey") % 9 + 1).cast("int")).alias("category"),
                    F.col("s_suppkey").alias("id"),
                    lon_of("s_suppkey").alias("longitude"), lat_of("s_suppkey").alias("latitude"))


def customer_points(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select("c_custkey", lon_of("c_custkey").alias("longitude"), lat_of("c_custkey").alias("latitude"))
