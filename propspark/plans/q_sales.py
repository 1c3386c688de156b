"""Sale-side queries: cleaning functions, macro and census joins, imputation,
trimming, encoding, sampling, profiles, star tables and views."""

from __future__ import annotations

from pyspark.sql import functions as F

from propspark.constants import COMMUNE_POPULATION, FRENCH_MONTHS, RATE_BAND_ELSE, RATE_BANDS
from propspark.functions import scalar as S
from propspark.operators import clean, features, impute, macro, profile, star
from propspark.operators.dedup import dedup_subset
from propspark.plans import views
from propspark.plans.bindings import (COMMUNES_SQL, DEPARTEMENTS_SQL, MACRO_MEASURES, MACRO_SQL,
                                      SALES_SQL, communes, departements, monthly_macro, sales, table)
from propspark.plans.registry import register, with_ctes
from propspark.sources.files import empty_partitions

# ------------------------------------------------------------------ flagship
TOP5_SQL = with_ctes(SALES_SQL, COMMUNES_SQL, DEPARTEMENTS_SQL) + """
SELECT d.code_departement, COUNT(*) AS nb_ventes,
       ROUND(AVG(m.prix_par_m2_habitable), 2) AS prix_m2_moyen
FROM sales m JOIN communes c ON m.code_commune = c.code_commune
JOIN departements d ON c.code_departement = d.code_departement
WHERE m.prix_par_m2_habitable IS NOT NULL
GROUP BY d.code_departement
ORDER BY prix_m2_moyen DESC, d.code_departement LIMIT 5"""


@register("top5_departments", TOP5_SQL)
def top5_departments(spark, d):
    return views.top_departments(sales(spark, d), communes(spark, d), departements(spark, d), k=5)


# -------------------------------------------------------------- star helpers
def _mutations(spark, d):
    return sales(spark, d).withColumn("id_bien", F.col("id_mutation"))


def _biens(spark, d):
    return sales(spark, d).select(F.col("id_mutation").alias("id_bien"), "type_local",
                                  "surface_reelle_bati", "surface_terrain")


def _indicators(spark, d):
    flat = macro.attach_month(sales(spark, d).select("date_mutation"), monthly_macro(spark, d),
                              "date_mutation")
    return star.dimension(flat, "date_mutation", {m: m for m in MACRO_MEASURES},
                          key_alias="date_indicateur")


INDIC_SQL = """indic AS (
  SELECT d.date_mutation AS date_indicateur, m.credits_habitat_hors_renegociations,
         m.taux_hors_renegociations, m.variations_encours_mensuelles_cvs, m.ipc
  FROM (SELECT DISTINCT date_mutation FROM sales) d
  LEFT JOIN macro m ON strftime(d.date_mutation, '%Y-%m') = strftime(m."Date", '%Y-%m'))"""


@register("price_by_type", with_ctes(SALES_SQL) + """
SELECT b.type_local, COUNT(*) AS nb_ventes, ROUND(AVG(m.valeur_fonciere), 2) AS prix_moyen,
       ROUND(AVG(m.prix_par_m2_habitable), 2) AS prix_m2_moyen
FROM sales m JOIN sales b ON m.id_mutation = b.id_mutation
GROUP BY b.type_local ORDER BY prix_moyen DESC""")
def price_by_type(spark, d):
    return views.price_by_type(_mutations(spark, d), _biens(spark, d))


@register("yearly_prices", with_ctes(SALES_SQL) + """
SELECT strftime(date_mutation, '%Y') AS annee, COUNT(*) AS nb_ventes,
       ROUND(AVG(valeur_fonciere), 2) AS prix_moyen
FROM sales GROUP BY 1 ORDER BY 1""")
def yearly_prices(spark, d):
    return views.yearly_prices(_mutations(spark, d))


_BAND_SQL = "CASE " + " ".join(f"WHEN i.taux_hors_renegociations < {b} THEN '{lbl}'" for b, lbl in RATE_BANDS) \
    + f" ELSE '{RATE_BAND_ELSE}' END"


@register("rate_bands", with_ctes(SALES_SQL, MACRO_SQL, INDIC_SQL) + f"""
SELECT {_BAND_SQL} AS tranche_taux, COUNT(*) AS nb_ventes, ROUND(AVG(m.valeur_fonciere), 2) AS prix_moyen
FROM sales m JOIN indic i ON m.date_mutation = i.date_indicateur
GROUP BY 1 ORDER BY 1""")
def rate_bands(spark, d):
    return views.rate_bands(_mutations(spark, d), _indicators(spark, d))


@register("view_commune_stats", with_ctes(SALES_SQL, COMMUNES_SQL) + """
SELECT c.code_commune, c.code_departement, COUNT(m.id_mutation) AS nb_transactions,
       AVG(m.valeur_fonciere) AS prix_moyen, AVG(m.prix_par_m2_habitable) AS prix_m2_moyen,
       MIN(m.valeur_fonciere) AS prix_min, MAX(m.valeur_fonciere) AS prix_max
FROM communes c LEFT JOIN sales m ON c.code_commune = m.code_commune
GROUP BY c.code_commune, c.code_departement""")
def view_commune_stats(spark, d):
    return views.commune_stats(communes(spark, d), _mutations(spark, d))


@register("view_department_stats", with_ctes(SALES_SQL, COMMUNES_SQL, DEPARTEMENTS_SQL) + """
SELECT d.code_departement, d.revenu_median_2021, d.taux_chomage_2023,
       COUNT(m.id_mutation) AS nb_transactions, AVG(m.valeur_fonciere) AS prix_moyen,
       AVG(m.prix_par_m2_habitable) AS prix_m2_moyen
FROM departements d LEFT JOIN communes c ON d.code_departement = c.code_departement
LEFT JOIN sales m ON c.code_commune = m.code_commune
GROUP BY d.code_departement, d.revenu_median_2021, d.taux_chomage_2023""")
def view_department_stats(spark, d):
    return views.department_stats(departements(spark, d), communes(spark, d), _mutations(spark, d))


@register("view_complete", with_ctes(SALES_SQL, COMMUNES_SQL, DEPARTEMENTS_SQL, MACRO_SQL, INDIC_SQL) + """
SELECT m.id_mutation, m.date_mutation, m.valeur_fonciere, ln(m.valeur_fonciere) AS valeur_fonciere_log,
       m.nature_mutation, m.prix_par_m2_habitable, m.prix_par_m2_terrain,
       'P' || CAST(m.id_mutation AS VARCHAR) AS id_parcelle, b.type_local, b.surface_reelle_bati,
       b.surface_terrain, NULL::DOUBLE AS longitude, NULL::DOUBLE AS latitude,
       c.code_commune, c.nb_menages_2021 AS nb_menages_commune,
       c.revenu_median_2021 AS revenu_median_commune, d.code_departement,
       d.nb_menages_2021 AS nb_menages_departement, d.revenu_median_2021 AS revenu_median_departement,
       d.taux_chomage_2023, d.salaire_net_horaire_moyen_2022,
       i.credits_habitat_hors_renegociations, i.taux_hors_renegociations, i.ipc
FROM sales m JOIN sales b ON m.id_mutation = b.id_mutation
JOIN communes c ON m.code_commune = c.code_commune
JOIN departements d ON c.code_departement = d.code_departement
LEFT JOIN indic i ON m.date_mutation = i.date_indicateur""")
def view_complete(spark, d):
    m = _mutations(spark, d).withColumn("valeur_fonciere_log", S.natural_log("valeur_fonciere"))
    b = _biens(spark, d).withColumns({
        "id_parcelle": F.concat(F.lit("P"), F.col("id_bien").cast("string")),
        "longitude": F.lit(None).cast("double"), "latitude": F.lit(None).cast("double")})
    return views.complete_transactions(m, b, communes(spark, d), departements(spark, d),
                                       _indicators(spark, d))


# ------------------------------------------------------------ scalar cleaning
def _price_text(k: str, cents: str, spark_side: bool):
    """Price as text with a comma decimal for key % 7 == 0, junk prefix for
    key % 7 == 1, a leading blank for key % 7 == 2."""
    if spark_side:
        base = F.concat((F.col(cents) / 100).cast("long").cast("string"), F.lit("."),
                        F.lpad((F.col(cents) % 100).cast("string"), 2, "0"))
        comma = F.replace(base, F.lit("."), F.lit(","))
        return (F.when(F.col(k) % 7 == 0, comma)
                .when(F.col(k) % 7 == 1, F.concat(F.lit("EUR"), base))
                .when(F.col(k) % 7 == 2, F.concat(F.lit(" "), base))
                .otherwise(base))
    base = (f"CAST({cents} // 100 AS VARCHAR) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')")
    return (f"CASE WHEN {k} % 7 = 0 THEN replace({base}, '.', ',') "
            f"WHEN {k} % 7 = 1 THEN 'EUR' || {base} WHEN {k} % 7 = 2 THEN ' ' || {base} ELSE {base} END")


_NUM_RE = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$'"
_UNSIGNED_RE = r"'^([0-9]+\.?[0-9]*|\.[0-9]+)$'"


def _lineitem_text(spark, d):
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    return li.select("l_orderkey", "l_linenumber",
                     _price_text("l_orderkey", "cents", True).alias("price_text"))


_LI_TEXT_SQL = f"""li AS (
  SELECT l_orderkey, l_linenumber, {_price_text('l_orderkey', 'CAST(round(l_extendedprice * 100) AS BIGINT)', False)} AS price_text
  FROM lineitem)"""


@register("clean_numeric_strict", with_ctes(_LI_TEXT_SQL) + f"""
SELECT l_orderkey, l_linenumber, price_text,
       CASE WHEN regexp_matches(t, {_NUM_RE}) THEN TRY_CAST(t AS DOUBLE) END AS price_clean
FROM (SELECT *, regexp_replace(replace(price_text, ',', '.'), '\\s', '', 'g') AS t FROM li)""")
def clean_numeric_strict(spark, d):
    li = _lineitem_text(spark, d)
    return li.withColumn("price_clean", S.clean_numeric("price_text", "strict"))


@register("clean_numeric_substitute", with_ctes(_LI_TEXT_SQL) + f"""
SELECT l_orderkey, l_linenumber, price_text,
       CASE WHEN regexp_matches(t, {_UNSIGNED_RE}) THEN TRY_CAST(t AS DOUBLE) END AS price_clean
FROM (SELECT *, regexp_replace(price_text, '[^0-9.]', '0', 'g') AS t FROM li)""")
def clean_numeric_substitute(spark, d):
    li = _lineitem_text(spark, d)
    return li.withColumn("price_clean", S.clean_numeric("price_text", "substitute", "0"))


@register("comma_decimal", """
SELECT o_orderkey, TRY_CAST(regexp_replace(t, '^([^,]*),', '\\1.') AS DOUBLE) AS value
FROM (SELECT o_orderkey, CAST(c // 100 AS VARCHAR) || ',' || lpad(CAST(c % 100 AS VARCHAR), 2, '0') AS t
      FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders))""")
def comma_decimal(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.round(F.col("o_totalprice") * 100).cast("long").alias("c"))
    t = F.concat((F.col("c") / 100).cast("long").cast("string"), F.lit(","),
                 F.lpad((F.col("c") % 100).cast("string"), 2, "0"))
    return o.select("o_orderkey", S.comma_decimal(t).alias("value"))


@register("unit_price_safe", """
SELECT l_orderkey, l_linenumber,
       l_extendedprice / NULLIF(CAST(CAST(l_quantity AS BIGINT) % 10 AS DOUBLE), 0) AS unit_price
FROM lineitem""")
def unit_price_safe(spark, d):
    li = table(spark, d, "lineitem")
    area = (F.col("l_quantity").cast("long") % 10).cast("double")
    return li.select("l_orderkey", "l_linenumber", S.safe_ratio("l_extendedprice", area).alias("unit_price"))


_DATE_TEXT = """CASE WHEN o_orderkey % 11 = 0 THEN 'not a date'
                     WHEN o_orderkey % 13 = 0 THEN strftime(o_orderdate, '%Y-%m') || '-32'
                     ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


@register("parse_dates_month_year", f"""
SELECT o_orderkey, d AS date_mutation, strftime(d, '%Y-%m') AS annee_mois, CAST(year(d) AS BIGINT) AS annee
FROM (SELECT o_orderkey, CAST(TRY_STRPTIME({_DATE_TEXT}, '%Y-%m-%d') AS DATE) AS d FROM orders)""")
def parse_dates_month_year(spark, d):
    o = table(spark, d, "orders")
    txt = (F.when(F.col("o_orderkey") % 11 == 0, F.lit("not a date"))
           .when(F.col("o_orderkey") % 13 == 0, F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("-32")))
           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    p = o.select("o_orderkey", S.parse_date(txt).alias("date_mutation"))
    return p.withColumns({"annee_mois": S.month_key("date_mutation"),
                          "annee": S.year_of("date_mutation").cast("long")})


_FR_LABELS = list(FRENCH_MONTHS)


@register("month_label_to_date", """
SELECT o_orderkey, label,
       make_date(CAST(split_part(label, ' ', 2) AS BIGINT),
                 CASE split_part(label, ' ', 1) """ + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in FRENCH_MONTHS.items()) + """ END, 1) AS month_date
FROM (SELECT o_orderkey, ([""" + ", ".join(f"'{k}'" for k in _FR_LABELS) + """])[month(o_orderdate)]
             || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS label FROM orders)""")
def month_label_to_date(spark, d):
    o = table(spark, d, "orders")
    labels = F.array(*[F.lit(k) for k in _FR_LABELS])
    lab = F.concat(F.element_at(labels, F.month("o_orderdate")), F.lit(" "),
                   F.year("o_orderdate").cast("string"))
    return o.select("o_orderkey", lab.alias("label")).withColumn(
        "month_date", S.french_month_to_date("label"))


# ------------------------------------------------------------------- filters
_RAW_ORDERS_SQL = """raw AS (
  SELECT o_orderkey, o_orderpriority AS nature_mutation,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderstatus END AS type_local,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_totalprice END AS valeur_fonciere,
         CAST(o_orderdate AS DATE) AS date_mutation, o_custkey AS code_commune
  FROM orders)"""


def _raw_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey", F.col("o_orderpriority").alias("nature_mutation"),
                    F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderstatus")).alias("type_local"),
                    F.when(F.col("o_orderkey") % 19 != 0, F.col("o_totalprice")).alias("valeur_fonciere"),
                    F.to_date("o_orderdate").alias("date_mutation"),
                    F.col("o_custkey").alias("code_commune"))


@register("filter_sales", with_ctes(_RAW_ORDERS_SQL) + """
SELECT o_orderkey, nature_mutation, type_local, valeur_fonciere, date_mutation
FROM raw
WHERE nature_mutation IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
  AND coalesce(type_local, '') IN ('O', 'F')
  AND valeur_fonciere IS NOT NULL AND date_mutation >= DATE '1996-01-01'""")
def filter_sales(spark, d):
    df = _raw_orders(spark, d).select("o_orderkey", "nature_mutation", "type_local",
                                      "valeur_fonciere", "date_mutation")       # P1
    df = clean.keep_values(df, "nature_mutation", ["1-URGENT", "2-HIGH", "3-MEDIUM"])  # P2
    df = clean.keep_values(df, "type_local", ["O", "F"], null_as="")            # P3
    df = clean.drop_nulls(df, ["valeur_fonciere"])                              # P4
    return clean.since(df, "date_mutation", "1996-01-01")                       # P7


@register("plain_sales", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority = '1-URGENT'""")
def plain_sales(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderpriority")
    return clean.plain_sales(o, "o_orderpriority", "1-URGENT")


@register("dedup_subset", """
SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag
         ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST, l_extendedprice NULLS FIRST) AS rn
  FROM (SELECT l_partkey, l_returnflag, l_orderkey, l_linenumber, l_extendedprice FROM lineitem))
WHERE rn = 1""")
def dedup_subset_q(spark, d):
    li = table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_orderkey",
                                            "l_linenumber", "l_extendedprice")
    return dedup_subset(li, ["l_partkey", "l_returnflag"])


@register("empty_partitions", """
SELECT n_nationkey, n_name FROM nation
WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_nationkey IS NOT NULL AND s_nationkey % 4 <> 1)""")
def empty_partitions_q(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    s = table(spark, d, "supplier").filter(F.col("s_nationkey") % 4 != 1)  # deliveries that did not come
    return empty_partitions(n, s, "n_nationkey", "s_nationkey")


# ------------------------------------------------------------ literal fill
def _literal_values_sql():
    return ", ".join(f"('{c}', {p})" for c, p in COMMUNE_POPULATION)


@register("literal_dim_fill", f"""
WITH lit(code_commune, population) AS (VALUES {_literal_values_sql()}),
est AS (SELECT code_commune, CAST(round(population / 2.2) AS INTEGER) AS nb_menages_estime FROM lit),
cust AS (
  SELECT c_custkey,
         coalesce(([{", ".join(f"'{c}'" for c, _ in COMMUNE_POPULATION)}])[(c_custkey % 60) + 1],
                  lpad(CAST(c_custkey AS VARCHAR), 6, '0')) AS code_commune,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(c_custkey % 500 AS INTEGER) END AS nb_menages_2021_commune
  FROM customer)
SELECT c.c_custkey, c.code_commune,
       coalesce(c.nb_menages_2021_commune, e.nb_menages_estime) AS nb_menages_2021_commune
FROM cust c LEFT JOIN est e ON c.code_commune = e.code_commune""")
def literal_dim_fill(spark, d):
    c = table(spark, d, "customer")
    codes = F.array(*[F.lit(code) for code, _ in COMMUNE_POPULATION])
    cust = c.select(
        "c_custkey",
        F.coalesce(F.try_element_at(codes, (F.col("c_custkey") % 60 + 1).cast("int")),
                   F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("code_commune"),
        F.when(F.col("c_custkey") % 3 != 0, (F.col("c_custkey") % 500).cast("int")).alias("nb_menages_2021_commune"))
    dim = impute.households_dim(spark)
    return impute.literal_household_fill(cust, dim)


# ------------------------------------------------------------------ macro
_S1 = """s1 AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date",
                round(avg(l_discount) * 100, 6) AS taux FROM lineitem GROUP BY 1)"""
_S2 = """s2 AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS "Date",
                count(*) AS n_orders FROM orders GROUP BY 1)"""
_S3 = """s3 AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS "Date",
                round(avg(l_tax) * 100, 6) AS variation FROM lineitem
                WHERE l_shipdate >= TIMESTAMP '1996-01-01' GROUP BY 1)"""


def _series(spark, d):
    li = table(spark, d, "lineitem")
    o = table(spark, d, "orders")
    s1 = li.groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("Date")).agg(
        S.sql_round(F.avg("l_discount") * 100, 6).alias("taux"))
    s2 = o.groupBy(F.trunc(F.to_date("o_orderdate"), "month").alias("Date")).agg(
        F.count(F.lit(1)).alias("n_orders"))
    s3 = li.groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("Date")).agg(
        S.sql_round(F.avg("l_tax") * 100, 6).alias("variation"))
    return s1, s2, clean.since(s3, "Date", "1996-01-01")


@register("macro_inner_chain", with_ctes(_S1, _S2, _S3) + """
SELECT s1."Date" AS "Date", taux, n_orders, variation
FROM s1 JOIN s2 ON s1."Date" = s2."Date" JOIN s3 ON s1."Date" = s3."Date" """)
def macro_inner_chain(spark, d):
    return macro.macro_chain(list(_series(spark, d)), on="Date")


@register("macro_left_month", with_ctes(_S1) + """
SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS date_mutation, g.taux
FROM orders o LEFT JOIN (SELECT * FROM s1 WHERE month("Date") <> 6) g
  ON strftime(o.o_orderdate, '%Y-%m') = strftime(g."Date", '%Y-%m')""")
def macro_left_month(spark, d):
    s1, _, _ = _series(spark, d)
    gap = s1.filter(F.month("Date") != 6)       # a series with a missing month each year
    o = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date_mutation"))
    return macro.attach_month(o, gap, "date_mutation", "Date")


# ----------------------------------------------------------------- census
@register("census_left", """
WITH cc AS (
  SELECT c_custkey AS code_commune, c_name AS nom_commune,
         CASE WHEN c_custkey % 9 = 0 THEN 'N/A' ELSE CAST(c_custkey % 500 + 100 AS VARCHAR) END AS households_txt,
         c_acctbal AS revenu_median_2021_commune FROM customer),
dc AS (SELECT s_nationkey AS code_departement, count(*) AS n_supp, avg(s_acctbal) AS revenu
       FROM supplier GROUP BY 1)
SELECT o.o_orderkey, c.c_custkey AS code_commune, c.c_nationkey AS code_departement,
       c.c_name AS nom_commune,
       TRY_CAST(cc.households_txt AS DOUBLE) AS nb_menages_2021_commune,
       cc.revenu_median_2021_commune,
       CAST(dc.n_supp AS DOUBLE) AS nb_menages_2021_departement,
       round(dc.revenu, 6) AS revenu_median_2021_departement
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN cc ON c.c_custkey = cc.code_commune
LEFT JOIN dc ON c.c_nationkey = dc.code_departement""")
def census_left(spark, d):
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    s = table(spark, d, "supplier")
    sales_df = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", F.col("c_custkey").alias("code_commune"),
        F.col("c_nationkey").alias("code_departement"), F.col("c_name").alias("nom_commune"))
    commune_raw = c.select(
        "c_custkey", "c_name",
        F.when(F.col("c_custkey") % 9 == 0, F.lit("N/A"))
         .otherwise((F.col("c_custkey") % 500 + 100).cast("string")).alias("households_txt"),
        "c_acctbal")
    commune_census = macro.rename_cast(
        commune_raw, {"c_custkey": "code_commune", "c_name": "nom_commune",
                      "households_txt": "nb_menages_2021_commune",
                      "c_acctbal": "revenu_median_2021_commune"},
        doubles=["nb_menages_2021_commune", "revenu_median_2021_commune"])
    dept_census = s.groupBy(F.col("s_nationkey").alias("code_departement")).agg(
        F.count(F.lit(1)).cast("double").alias("nb_menages_2021_departement"),
        S.sql_round(F.avg("s_acctbal"), 6).alias("revenu_median_2021_departement"))
    return macro.attach_census(sales_df, commune_census, dept_census)


@register("group_mean_impute", """
WITH c AS (
  SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS code_commune,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_acctbal END AS revenu
  FROM customer)
SELECT c_custkey, code_commune,
       round(coalesce(revenu, avg(revenu) OVER (PARTITION BY substr(code_commune, 1, 2))), 6) AS revenu
FROM c""")
def group_mean_impute(spark, d):
    c = table(spark, d, "customer").select(
        "c_custkey",
        F.concat(F.lpad(F.col("c_nationkey").cast("string"), 2, "0"),
                 F.lpad(F.col("c_custkey").cast("string"), 6, "0")).alias("code_commune"),
        F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("revenu"))
    out = impute.group_mean_impute(c, "revenu", "code_commune")
    return out.withColumn("revenu", S.sql_round("revenu", 6))


# ------------------------------------------------- trimming / encoding / sample
@register("quantile_trim", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.001) AS lo, quantile_cont(o_totalprice, 0.999) AS hi FROM orders)
SELECT o_orderkey, o_totalprice FROM orders, q WHERE o_totalprice >= q.lo AND o_totalprice <= q.hi""")
def quantile_trim(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    out, _ = features.quantile_trim(o, "o_totalprice", 0.001, 0.999)
    return out


@register("log_onehot", """
SELECT o_orderkey, ln(o_totalprice) AS o_totalprice_log,
       CAST(o_orderstatus = 'F' AS INTEGER) AS o_orderstatus__F,
       CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus__O,
       CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus__P
FROM orders""")
def log_onehot(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return features.log_onehot(o, "o_totalprice", "o_orderstatus", vocabulary=["F", "O", "P"]).drop("o_totalprice", "o_orderstatus")


@register("hash_sample", """
SELECT o_orderkey, o_totalprice FROM orders
ORDER BY md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), '42')), o_orderkey LIMIT 1000""")
def hash_sample(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return features.hash_sample(o, 1000, ["o_orderkey"], seed=42)


# ------------------------------------------------------------------ profiles
_NULLY_SQL = """o AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate
  FROM orders)"""


def _nully_orders(spark, d):
    o = table(spark, d, "orders")
    return o.select("o_orderkey",
                    F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("o_totalprice"),
                    F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
                    F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderdate")).alias("o_orderdate"))


@register("profile_nulls", with_ctes(_NULLY_SQL) + """
SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS null_count FROM o
UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM o
UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM o
UNION ALL SELECT 'o_orderdate', count(*) - count(o_orderdate) FROM o""")
def profile_nulls(spark, d):
    return profile.null_counts(_nully_orders(spark, d))


@register("profile_numeric", with_ctes(_NULLY_SQL) + """
SELECT 'o_totalprice' AS column_name, count(o_totalprice) AS count,
       count(*) - count(o_totalprice) AS null_count,
       round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS std,
       min(o_totalprice) AS min, quantile_cont(o_totalprice, 0.25) AS p25,
       quantile_cont(o_totalprice, 0.5) AS p50, quantile_cont(o_totalprice, 0.75) AS p75,
       max(o_totalprice) AS max
FROM o""")
def profile_numeric(spark, d):
    p = profile.numeric_profile(_nully_orders(spark, d), ["o_totalprice"])
    return p.withColumns({"mean": S.sql_round("mean", 4), "std": S.sql_round("std", 4)})


@register("class_counts", """
SELECT count(*) AS n_total, count_if(o_orderstatus = 'O') AS n_O, count_if(o_orderstatus = 'F') AS n_F
FROM orders""")
def class_counts(spark, d):
    return profile.class_counts(table(spark, d, "orders"), "o_orderstatus", ["O", "F"])


# ---------------------------------------------------------------- star tables
def _flat(spark, d):
    """Model-ready flat table: sales + commune and department census
    + monthly macro (J2) + log price (F13) + one-hot type (F14)."""
    s = sales(spark, d)
    cc = communes(spark, d).withColumnsRenamed({"nb_menages_2021": "nb_menages_2021_commune",
                                                "revenu_median_2021": "revenu_median_2021_commune"})
    dc = departements(spark, d).withColumnsRenamed({
        "nb_menages_2021": "nb_menages_2021_departement",
        "revenu_median_2021": "revenu_median_2021_departement",
        "taux_chomage_2023": "taux_chomage_2023_departement",
        "salaire_net_horaire_moyen_2022": "salaire_net_horaire_moyen_2022_departement"})
    flat = macro.attach_census(s, cc, None)
    flat = macro.attach_census(flat, None, dc)
    flat = macro.attach_month(flat, monthly_macro(spark, d), "date_mutation")
    flat = features.log_onehot(flat, "valeur_fonciere", "type_local", vocabulary=["F", "O", "P"],
                               log_col="valeur_fonciere_log")
    return flat.withColumn("id_parcelle", F.concat(F.lit("P"), F.col("id_mutation").cast("string")))


_FLAT_SQL = """flat AS (
  SELECT s.*, c.code_departement, c.nb_menages_2021 AS nb_menages_2021_commune,
         c.revenu_median_2021 AS revenu_median_2021_commune,
         d.nb_menages_2021 AS nb_menages_2021_departement,
         d.revenu_median_2021 AS revenu_median_2021_departement,
         d.taux_chomage_2023 AS taux_chomage_2023_departement,
         d.salaire_net_horaire_moyen_2022 AS salaire_net_horaire_moyen_2022_departement,
         m.credits_habitat_hors_renegociations, m.taux_hors_renegociations,
         m.variations_encours_mensuelles_cvs, m.ipc
  FROM sales s LEFT JOIN communes c ON s.code_commune = c.code_commune
  LEFT JOIN departements d ON c.code_departement = d.code_departement
  LEFT JOIN macro m ON strftime(s.date_mutation, '%Y-%m') = strftime(m."Date", '%Y-%m'))"""


def _star(spark, d, shared=False):
    return star.build_star(_flat(spark, d), ["id_mutation"], categories=[], shared=shared,
                           indicator_measures={m: m for m in MACRO_MEASURES},
                           bien_cols=["id_parcelle", "type_local", "surface_reelle_bati", "surface_terrain",
                                      "type_local__F", "type_local__O", "type_local__P"])


@register("star_departements", with_ctes(SALES_SQL, COMMUNES_SQL, DEPARTEMENTS_SQL, MACRO_SQL, _FLAT_SQL) + """
SELECT code_departement, nb_menages_2021_departement AS nb_menages_2021,
       revenu_median_2021_departement AS revenu_median_2021,
       taux_chomage_2023_departement AS taux_chomage_2023,
       salaire_net_horaire_moyen_2022_departement AS salaire_net_horaire_moyen_2022
FROM (SELECT *, row_number() OVER (PARTITION BY code_departement ORDER BY
        nb_menages_2021_departement NULLS FIRST, revenu_median_2021_departement NULLS FIRST,
        taux_chomage_2023_departement NULLS FIRST, salaire_net_horaire_moyen_2022_departement NULLS FIRST) AS rn
      FROM flat WHERE code_departement IS NOT NULL) WHERE rn = 1""")
def star_departements(spark, d):
    return _star(spark, d)["departements"]


@register("star_communes", with_ctes(SALES_SQL, COMMUNES_SQL, DEPARTEMENTS_SQL, MACRO_SQL, _FLAT_SQL) + """
SELECT code_commune, code_departement, nb_menages_2021_commune AS nb_menages_2021,
       revenu_median_2021_commune AS revenu_median_2021
FROM (SELECT *, row_number() OVER (PARTITION BY code_commune ORDER BY code_departement NULLS FIRST,
        nb_menages_2021_commune NULLS FIRST, revenu_median_2021_commune NULLS FIRST) AS rn
      FROM flat WHERE code_commune IS NOT NULL) WHERE rn = 1""")
def star_communes(spark, d):
    return _star(spark, d)["communes"]


@register("star_indicators", with_ctes(SALES_SQL, COMMUNES_SQL, DEPARTEMENTS_SQL, MACRO_SQL, _FLAT_SQL) + """
SELECT CAST(date_mutation AS VARCHAR) AS date_indicateur, credits_habitat_hors_renegociations,
       taux_hors_renegociations, variations_encours_mensuelles_cvs, ipc
FROM (SELECT *, row_number() OVER (PARTITION BY date_mutation ORDER BY
        credits_habitat_hors_renegociations NULLS FIRST, taux_hors_renegociations NULLS FIRST,
        variations_encours_mensuelles_cvs NULLS FIRST, ipc NULLS FIRST) AS rn
      FROM flat WHERE date_mutation IS NOT NULL) WHERE rn = 1""")
def star_indicators(spark, d):
    return _star(spark, d)["indicateurs_economiques"]


@register("star_facts", with_ctes(SALES_SQL) + """
SELECT row_number() OVER (ORDER BY id_mutation) AS id_mutation,
       row_number() OVER (ORDER BY id_mutation) AS id_bien,
       CAST(date_mutation AS VARCHAR) AS date_mutation, valeur_fonciere,
       ln(valeur_fonciere) AS valeur_fonciere_log, nature_mutation, code_commune,
       prix_par_m2_habitable, prix_par_m2_terrain
FROM sales""")
def star_facts(spark, d):
    return _star(spark, d)["mutations"]


@register("star_biens", with_ctes(SALES_SQL) + """
SELECT row_number() OVER (ORDER BY id_mutation) AS id_bien, 'P' || CAST(id_mutation AS VARCHAR) AS id_parcelle,
       type_local, surface_reelle_bati, surface_terrain,
       CAST(type_local = 'F' AS INTEGER) AS type_local__F, CAST(type_local = 'O' AS INTEGER) AS type_local__O,
       CAST(type_local = 'P' AS INTEGER) AS type_local__P
FROM sales""")
def star_biens(spark, d):
    return _star(spark, d)["biens"]


# ------------------------------------------------------- raw sale files
_NATURE_OF_PRIORITY = {"1-URGENT": "Vente", "2-HIGH": "Vente en l'état futur d'achèvement",
                       "3-MEDIUM": "Vente terrain à bâtir", "4-NOT SPECIFIED": "Echange",
                       "5-LOW": "Adjudication"}
_TYPE_OF_STATUS = {"F": "Maison", "O": "Appartement", "P": "Dépendance"}


def _milli_text(v):
    """Signed milli-units as fixed 3-decimal text, by integer arithmetic."""
    a = F.abs(v)
    return F.concat(F.when(v < 0, F.lit("-")).otherwise(F.lit("")), (a / 1000).cast("long").cast("string"),
                    F.lit("."), F.lpad((a % 1000).cast("string"), 3, "0"))


def _milli_text_sql(v: str) -> str:
    return (f"(CASE WHEN {v} < 0 THEN '-' ELSE '' END || CAST(abs({v}) // 1000 AS VARCHAR) || '.' || "
            f"lpad(CAST(abs({v}) % 1000 AS VARCHAR), 3, '0'))")


def raw_sales_from_orders(spark, d):
    """orders as raw sale-file rows: every column text, comma decimal
    prices, junk in some areas, NULL price / type / longitude for some
    keys, re-delivered rows (every 50th order twice) and a source file per
    department."""
    o = table(spark, d, "orders")
    o = o.unionByName(o.filter(F.col("o_orderkey") % 50 == 0))
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    price = F.concat((cents / 100).cast("long").cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))
    nat = F.create_map(*[F.lit(x) for kv in _NATURE_OF_PRIORITY.items() for x in kv])
    typ = F.create_map(*[F.lit(x) for kv in _TYPE_OF_STATUS.items() for x in kv])
    area = ((k % 97) * 2).cast("string")
    return o.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_mutation"),
        F.element_at(nat, F.col("o_orderpriority")).alias("nature_mutation"),
        F.when(k % 19 != 0, price).alias("valeur_fonciere"),
        F.concat(F.lit("CP"), (ck % 100).cast("string")).alias("code_postal"),
        ck.cast("string").alias("code_commune"),
        F.concat(F.lit("Commune"), ck.cast("string")).alias("nom_commune"),
        F.lpad((ck % 25).cast("string"), 2, "0").alias("code_departement"),
        F.concat(F.lit("P"), k.cast("string")).alias("id_parcelle"),
        F.when(k % 17 != 0, F.element_at(typ, F.col("o_orderstatus"))).alias("type_local"),
        F.when(k % 23 == 0, F.concat(area, F.lit(" m2"))).otherwise(area).alias("surface_reelle_bati"),
        (k % 90).cast("string").alias("adresse_numero"),
        F.when(k % 11 == 0, F.lit("BIS")).alias("adresse_suffixe"),
        F.concat(F.lit("RUE "), (ck % 40).cast("string")).alias("adresse_nom_voie"),
        F.lpad((ck % 40).cast("string"), 4, "0").alias("adresse_code_voie"),
        ((k % 89) * 10).cast("string").alias("surface_terrain"),
        F.when(ck % 31 != 0, _milli_text(ck * 7919 % 9000 - 1000)).alias("longitude"),
        _milli_text(ck * 104729 % 7000 + 43000).alias("latitude"),
        F.concat(F.lit("dept-"), F.lpad((ck % 25).cast("string"), 2, "0")).alias("_source_file"))


def _case_sql(col, mapping):
    return "CASE " + " ".join(f"WHEN {col} = '{a}' THEN '{b}'" for a, b in
                              ((a, b.replace("'", "''")) for a, b in mapping.items())) + " END"


_RAW_SALES_SQL = f"""o AS (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 50 = 0),
raw AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS r_date,
         {_case_sql('o_orderpriority', _NATURE_OF_PRIORITY)} AS r_nature,
         CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE
           CAST(CAST(round(o_totalprice * 100) AS BIGINT) // 100 AS VARCHAR) || ',' ||
           lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) % 100 AS VARCHAR), 2, '0') END AS r_price,
         'CP' || CAST(o_custkey % 100 AS VARCHAR) AS code_postal,
         CAST(o_custkey AS VARCHAR) AS code_commune,
         'Commune' || CAST(o_custkey AS VARCHAR) AS nom_commune,
         lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0') AS code_departement,
         'P' || CAST(o_orderkey AS VARCHAR) AS id_parcelle,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE {_case_sql('o_orderstatus', _TYPE_OF_STATUS)} END AS r_type,
         CASE WHEN o_orderkey % 23 = 0 THEN CAST((o_orderkey % 97) * 2 AS VARCHAR) || ' m2'
              ELSE CAST((o_orderkey % 97) * 2 AS VARCHAR) END AS r_area,
         CAST(o_orderkey % 90 AS VARCHAR) AS adresse_numero,
         CASE WHEN o_orderkey % 11 = 0 THEN 'BIS' END AS adresse_suffixe,
         'RUE ' || CAST(o_custkey % 40 AS VARCHAR) AS adresse_nom_voie,
         lpad(CAST(o_custkey % 40 AS VARCHAR), 4, '0') AS adresse_code_voie,
         CAST((o_orderkey % 89) * 10 AS VARCHAR) AS r_terrain,
         CASE WHEN o_custkey % 31 = 0 THEN NULL ELSE {_milli_text_sql('((o_custkey * 7919) % 9000 - 1000)')} END AS r_lon,
         {_milli_text_sql('((o_custkey * 104729) % 7000 + 43000)')} AS r_lat,
         'dept-' || lpad(CAST(o_custkey % 25 AS VARCHAR), 2, '0') AS _source_file
  FROM o)"""


def _strict_sql(x):
    t = f"regexp_replace(replace({x}, ',', '.'), '\\s', '', 'g')"
    return f"(CASE WHEN regexp_matches({t}, {_NUM_RE}) THEN TRY_CAST({t} AS DOUBLE) END)"


def _tolerant_sql(x):
    return (f"(CASE WHEN regexp_matches(trim({x}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
            f"THEN TRY_CAST(trim({x}) AS DOUBLE) END)")


_SALE_NATURES_SQL = ", ".join("'" + x.replace("'", "''") + "'" for x in list(_NATURE_OF_PRIORITY.values())[:3])
_REST = ["nature_mutation", "code_postal", "code_commune", "nom_commune", "code_departement", "id_parcelle",
         "type_local", "surface_reelle_bati", "adresse_numero", "adresse_suffixe", "adresse_nom_voie",
         "adresse_code_voie", "annee_mois", "annee", "prix_par_m2_habitable", "prix_par_m2_terrain"]


@register("clean_sales_pipeline", with_ctes(_RAW_SALES_SQL, f"""typed AS (
  SELECT CAST(TRY_STRPTIME(r_date, '%Y-%m-%d') AS DATE) AS date_mutation, r_nature AS nature_mutation,
         {_strict_sql('r_price')} AS valeur_fonciere, code_postal, code_commune, nom_commune, code_departement,
         id_parcelle, r_type AS type_local, {_strict_sql('r_area')} AS surface_reelle_bati,
         adresse_numero, adresse_suffixe, adresse_nom_voie, adresse_code_voie,
         {_strict_sql('r_terrain')} AS surface_terrain,
         {_tolerant_sql('r_lon')} AS longitude, {_tolerant_sql('r_lat')} AS latitude, _source_file
  FROM raw
  WHERE r_nature IN ({_SALE_NATURES_SQL}) AND coalesce(r_type, '') IN ('Appartement', 'Maison')
    AND r_price IS NOT NULL AND r_lat IS NOT NULL AND r_lon IS NOT NULL)""", """feat AS (
  SELECT *, strftime(date_mutation, '%Y-%m') AS annee_mois, CAST(year(date_mutation) AS INTEGER) AS annee,
         valeur_fonciere / NULLIF(surface_reelle_bati, 0) AS prix_par_m2_habitable,
         valeur_fonciere / NULLIF(surface_terrain, 0) AS prix_par_m2_terrain
  FROM typed)""") + f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY _source_file, date_mutation, longitude, latitude, valeur_fonciere,
                                            surface_terrain
                               ORDER BY {', '.join(c + ' NULLS FIRST' for c in _REST)}) AS rn
  FROM feat) WHERE rn = 1""")
def clean_sales_pipeline(spark, d):
    return clean.clean_sales(raw_sales_from_orders(spark, d), numeric_mode="strict")


# --------------------------------------------------- typed monthly series
def _label_series(spark, d):
    li = table(spark, d, "lineitem")
    labels = F.array(*[F.lit(k) for k in _FR_LABELS])
    a = (li.groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("m"))
         .agg(F.round(F.avg("l_discount") * 10000).cast("long").alias("c")))
    a = a.select(F.concat(F.element_at(labels, F.month("m")), F.lit(" "), F.year("m").cast("string")).alias("Category"),
                 F.concat((F.col("c") / 100).cast("long").cast("string"), F.lit(","),
                          F.lpad((F.col("c") % 100).cast("string"), 2, "0")).alias("taux"))
    o = table(spark, d, "orders")
    b = (o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("Date"))
         .agg(F.count(F.lit(1)).cast("string").alias("n_orders")))
    return a, b


@register("macro_typed_series", f"""
WITH a AS (
  SELECT ([{", ".join(f"'{k}'" for k in _FR_LABELS)}])[month(m)] || ' ' || CAST(year(m) AS VARCHAR) AS label,
         c // 100 AS ip, c % 100 AS fp
  FROM (SELECT date_trunc('month', l_shipdate) AS m, CAST(round(avg(l_discount) * 10000) AS BIGINT) AS c
        FROM lineitem GROUP BY 1)),
ta AS (SELECT make_date(CAST(split_part(label, ' ', 2) AS BIGINT),
                        CASE split_part(label, ' ', 1) {" ".join(f"WHEN '{k}' THEN {v}" for k, v in FRENCH_MONTHS.items())} END,
                        1) AS "Date",
              CAST(CAST(ip AS VARCHAR) || '.' || lpad(CAST(fp AS VARCHAR), 2, '0') AS DOUBLE) AS taux FROM a),
tb AS (SELECT CAST(strptime(strftime(o_orderdate, '%Y-%m'), '%Y-%m') AS DATE) AS "Date",
              CAST(count(*) AS DOUBLE) AS n_orders FROM orders GROUP BY 1)
SELECT ta."Date", taux, n_orders FROM ta JOIN tb ON ta."Date" = tb."Date"
WHERE ta."Date" >= DATE '1996-01-01'""")
def macro_typed_series(spark, d):
    a, b = _label_series(spark, d)
    ta = macro.typed_series(a, "Category", ["taux"], start="1996-01-01", label_format="french")
    tb = macro.typed_series(b, "Date", ["n_orders"], start="1996-01-01", label_format="yyyy-MM")
    return macro.macro_chain([ta, tb], on="Date")


@register("star_department_stats", with_ctes(SALES_SQL, COMMUNES_SQL, DEPARTEMENTS_SQL, MACRO_SQL, _FLAT_SQL) + """,
dd AS (SELECT DISTINCT code_departement, revenu_median_2021_departement AS revenu_median_2021,
              taux_chomage_2023_departement AS taux_chomage_2023 FROM flat WHERE code_departement IS NOT NULL),
cc AS (SELECT DISTINCT code_commune, code_departement FROM flat WHERE code_commune IS NOT NULL)
SELECT d.code_departement, d.revenu_median_2021, d.taux_chomage_2023,
       COUNT(m.id_mutation) AS nb_transactions, AVG(m.valeur_fonciere) AS prix_moyen,
       AVG(m.prix_par_m2_habitable) AS prix_m2_moyen
FROM dd d LEFT JOIN cc c ON d.code_departement = c.code_departement
LEFT JOIN flat m ON c.code_commune = m.code_commune
GROUP BY d.code_departement, d.revenu_median_2021, d.taux_chomage_2023""")
def star_department_stats(spark, d):
    """E2 end to end: flat table -> star schema (K3) -> department view (V3)
    over the star's own dimension and fact tables, all read from one written
    flat table."""
    st = _star(spark, d, shared=True)
    return views.department_stats(st["departements"], st["communes"], st["mutations"])
