"""Constraint audits and catalog queries (Q-*, C1-C4, L4, K5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from propspark.functions.scalar import empty_to_null_double
from propspark.operators import catalog, quality
from propspark.plans.bindings import TABLES, table
from propspark.plans.registry import register

SEGMENTS = ["MACHINERY", "BUILDING", "AUTOMOBILE", "HOUSEHOLD"]   # FURNITURE violates the check


def _audit_tables(spark, d):
    o = table(spark, d, "orders")
    broken = o.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 101 == 0, F.col("o_custkey") + 1000000000).otherwise(F.col("o_custkey")).alias("o_custkey"),
        "o_orderstatus",
        F.when(F.col("o_orderkey") % 53 != 0, F.col("o_orderdate")).alias("o_orderdate"))
    # Re-delivered rows: the same order key twice.
    orders = broken.unionByName(broken.filter(F.col("o_orderkey") % 250 == 0))
    return {"orders": orders,
            "customer": table(spark, d, "customer"),
            "nation": table(spark, d, "nation")}


AUDIT_RULES = {
    "orders": quality.Rules(primary_key=["o_orderkey"], not_null=["o_orderdate"],
                            checks={"o_orderstatus": ["O", "F"]},
                            foreign_keys={"o_custkey": ("customer", "c_custkey")}),
    "customer": quality.Rules(primary_key=["c_custkey"], checks={"c_mktsegment": SEGMENTS},
                              foreign_keys={"c_nationkey": ("nation", "n_nationkey")}),
    "nation": quality.Rules(primary_key=["n_nationkey"], not_null=["n_name"]),
}

_SEG = ", ".join(f"'{s}'" for s in SEGMENTS)


@register("audit_constraints", f"""
WITH b AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 101 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END AS o_custkey,
         o_orderstatus, CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate
  FROM orders),
o AS (SELECT * FROM b UNION ALL SELECT * FROM b WHERE o_orderkey % 250 = 0)
SELECT 'orders' AS table_name, 'not_null' AS rule, 'o_orderdate' AS column_name,
       count(*) - count(o_orderdate) AS violations FROM o
UNION ALL SELECT 'orders', 'check', 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F')) FROM o
UNION ALL SELECT 'orders', 'primary_key', 'o_orderkey', coalesce(sum(n - 1), 0)
          FROM (SELECT count(*) AS n FROM o GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'foreign_key', 'o_custkey', count(*) FROM o
          WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL)
UNION ALL SELECT 'customer', 'check', 'c_mktsegment', count(*) FILTER (WHERE c_mktsegment NOT IN ({_SEG})) FROM customer
UNION ALL SELECT 'customer', 'primary_key', 'c_custkey', coalesce(sum(n - 1), 0)
          FROM (SELECT count(*) AS n FROM customer GROUP BY c_custkey HAVING count(*) > 1)
UNION ALL SELECT 'customer', 'foreign_key', 'c_nationkey', count(*) FROM customer
          WHERE c_nationkey IS NOT NULL AND c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey IS NOT NULL)
UNION ALL SELECT 'nation', 'not_null', 'n_name', count(*) - count(n_name) FROM nation
UNION ALL SELECT 'nation', 'primary_key', 'n_nationkey', coalesce(sum(n - 1), 0)
          FROM (SELECT count(*) AS n FROM nation GROUP BY n_nationkey HAVING count(*) > 1)""")
def audit_constraints(spark, d):
    return quality.audit(_audit_tables(spark, d), AUDIT_RULES)


_STAT_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@register("table_stats", "WITH n AS (" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _STAT_TABLES) + """),
c AS (SELECT table_name, CAST(count(*) AS INTEGER) AS column_count,
             string_agg(column_name, ', ' ORDER BY column_index) AS column_names
      FROM duckdb_columns() GROUP BY table_name)
SELECT table_name, row_count, column_count, column_names FROM n JOIN c USING (table_name)""")
def table_stats(spark, d):
    tables = {t: table(spark, d, t) for t in _STAT_TABLES}
    return catalog.table_stats(tables).select("table_name", "row_count", "column_count", "column_names")


@register("table_preview", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5""")
def table_preview(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return catalog.table_preview(o, 5, ["o_orderkey"])


@register("adhoc_sql", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY o_orderstatus""")
def adhoc_sql(spark, d):
    # Views are registered under a prefix so a caller's own temp views are untouched.
    catalog.register_views(spark, {f"propspark_{t}": table(spark, d, t) for t in ("orders",)})
    return catalog.adhoc_sql(spark, "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total "
                                    "FROM propspark_orders GROUP BY o_orderstatus")



# ------------------------------------------------- rules of the nine tables
# Star and listing tables on driver rows, with faults planted by key: missing
# and repeated keys, orphans, values off the lists.
_TYPES = ["Maison", "Appartement", "Dépendance", "Local industriel. commercial ou assimilé", "Château", None]
_LISTED = ["Maison", "Loft", "Palais", None, "Box"]
_LETTERS = ["A", "G", "H", None, "In progress"]


def _pick(values: list, key: str) -> str:
    """SQL of the value by key; Spark and DuckDB both take it."""
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None)
    return f"CASE {key} % {len(values)} {cases} END"


_FAULTY = {
    "departements": "SELECT CAST(n_nationkey AS VARCHAR(9)) AS code_departement FROM nation UNION ALL SELECT '3' FROM nation WHERE n_nationkey < 2",
    "communes": """SELECT CAST(c_custkey AS VARCHAR(19)) AS code_commune, CASE WHEN c_custkey % 31 = 0 THEN NULL
        WHEN c_custkey % 37 = 0 THEN '99' ELSE CAST(c_nationkey AS VARCHAR(9)) END AS code_departement FROM customer""",
    "indicateurs_economiques": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_indicateur FROM orders WHERE o_orderkey % 5 <> 0",
    "biens": f"SELECT o_orderkey AS id_bien, {_pick(_TYPES, 'o_orderkey')} AS type_local FROM orders",
    "proximite": """SELECT o_orderkey - o_orderkey % 2 AS id_proximite, CASE WHEN o_orderkey % 41 = 0 THEN NULL
        WHEN o_orderkey % 43 = 0 THEN -o_orderkey ELSE o_orderkey END AS id_bien FROM orders""",
    "mutations": """SELECT o_orderkey AS id_mutation, CASE WHEN o_orderkey % 47 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS date_mutation,
        o_orderkey AS id_bien, CASE WHEN o_orderkey % 53 = 0 THEN NULL WHEN o_orderkey % 59 = 0 THEN 'x'
        ELSE CAST(o_custkey AS VARCHAR(19)) END AS code_commune FROM orders""",
    "annonces": f"""SELECT CASE WHEN p_partkey % 61 = 0 THEN 'same' ELSE CAST(p_partkey AS VARCHAR(19)) END AS id,
        {_pick(_LISTED, 'p_partkey')} AS type, {_pick(['Neuf', 'Ruine', None], 'p_partkey')} AS etat FROM part""",
    "diagnostics": f"""SELECT p_partkey AS id_diagnostic, CASE WHEN p_partkey % 67 = 0 THEN NULL WHEN p_partkey % 71 = 0 THEN 'twice'
        ELSE CAST(p_partkey AS VARCHAR(19)) END AS id_annonce, {_pick(_LETTERS, 'p_partkey')} AS dpe_lettre,
        {_pick(_LETTERS, 'p_size')} AS ges_lettre FROM part""",
    "images": """SELECT p_partkey - p_partkey % 3 AS id_image, CAST(p_partkey + 5 AS VARCHAR(19)) AS id_annonce,
        CASE WHEN p_partkey % 73 = 0 THEN NULL ELSE 'u' END AS url_image FROM part""",
}
NINE_RULES = quality.STAR_RULES | quality.LISTING_RULES


def _faulty_tables(spark, d) -> dict:
    out = {}
    for t, sql in _FAULTY.items():
        for name in ("nation", "customer", "orders", "part"):
            sql = sql.replace(f"FROM {name}", f"FROM {{{name}}}")
        out[t] = spark.sql(sql, **{n: table(spark, d, n) for n in ("nation", "customer", "orders", "part") if f"{{{n}}}" in sql})
    return out


def _list_sql(values) -> str:
    return ", ".join("NULL" if v is None else f"'{v}'" for v in values)


def _rule_conditions(t: str, r) -> list[tuple[str, str, str]]:
    """(rule, column, SQL condition on a row) of rules that concern a row alone or a parent."""
    out = [("not_null", c, f"{c} IS NULL") for c in r.not_null]
    out += [("check", c, f"{c} NOT IN ({_list_sql(v)})") for c, v in r.checks.items()]
    return out + [("foreign_key", c, f"{c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {pt} WHERE {pc} IS NOT NULL)")
                  for c, (pt, pc) in r.foreign_keys.items()]


def _repeated(t: str, r) -> list[tuple[str, str, str]]:
    """(rule, column, SQL condition) of keys that occur more than once."""
    return [(rule, c, f"{c} IS NOT NULL AND {c} IN (SELECT {c} FROM {t} GROUP BY {c} HAVING count(*) > 1)")
            for rule, c in [("primary_key", c) for c in r.primary_key] + [("unique", c) for c in r.unique]]


_NINE_SQL = "WITH " + ", ".join(f"{t} AS ({sql})" for t, sql in _FAULTY.items())


@register("audit_nine_tables", _NINE_SQL + "\nUNION ALL ".join([""] + [
    f"SELECT '{t}' AS table_name, '{rule}' AS rule, '{c}' AS column_name, count(*) FILTER (WHERE {cond}) AS violations FROM {t}"
    for t, r in NINE_RULES.items() for rule, c, cond in _rule_conditions(t, r)] + [
    f"SELECT '{t}', '{rule}', '{c}', count({c}) - count(DISTINCT {c}) FROM {t}"
    for t, r in NINE_RULES.items() for rule, c, _ in _repeated(t, r)]).replace("\nUNION ALL ", "\n", 1))
def audit_nine_tables(spark, d):
    """Every declared rule of the star and listing tables, counted."""
    return quality.audit(_faulty_tables(spark, d), NINE_RULES)


@register("quarantine_rows", _NINE_SQL + "\nSELECT table_name, broken, count(*) AS n_rows FROM (" + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, array_to_string(list_sort(list_filter([" + ", ".join(
        f"CASE WHEN {cond} THEN '{rule}:{c}' END" for rule, c, cond in _rule_conditions(t, r) + _repeated(t, r))
    + f"], lambda x: x IS NOT NULL)), ',') AS broken FROM {t}" for t, r in NINE_RULES.items()) + ") WHERE broken <> '' GROUP BY ALL")
def quarantine_rows(spark, d):
    """Rows that break rules, by table and set of broken rules."""
    rows = quality.quarantine(_faulty_tables(spark, d), NINE_RULES)
    return rows.groupBy("table_name", F.array_join("broken", ",").alias("broken")).agg(F.count(F.lit(1)).alias("n_rows"))


@register("column_defaults", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE CAST(o_orderkey % 2 AS INTEGER) END AS "type_local__Maison",
       CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE 1 END AS "type_local__Appartement",
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE -0.5 + CAST(o_orderkey % 100 AS DOUBLE) END AS longitude FROM orders""")
def column_defaults(spark, d):
    """Q-DEF on declared defaults and F20 on coordinates given as text."""
    k = F.col("o_orderkey")
    biens = table(spark, d, "orders").select(
        "o_orderkey", F.when(k % 3 != 0, (k % 2).cast("int")).alias("type_local__Maison"), F.when(k % 5 != 0, 1).alias("type_local__Appartement"),
        F.when(k % 4 == 0, F.lit("")).otherwise((F.lit(-0.5) + (k % 100).cast("double")).cast("string")).alias("longitude"))
    filled = quality.with_defaults({"biens": biens}, quality.STAR_RULES)["biens"]
    return filled.withColumn("longitude", empty_to_null_double("longitude"))


@register("catalog_views", """
SELECT 'propspark_v_' || table_name AS name, 'view' AS kind, CAST(count(*) AS INTEGER) AS column_count,
       string_agg(column_name, ', ' ORDER BY column_index) AS column_names
FROM duckdb_columns() WHERE table_name IN ('region', 'nation', 'supplier') GROUP BY table_name""")
def catalog_views(spark, d):
    """View names and columns from the session catalog."""
    names = catalog.register_views(spark, {f"propspark_v_{t}": table(spark, d, t) for t in ("region", "nation", "supplier")})
    return catalog.catalog_listing(spark, names).select("name", "kind", "column_count", "column_names")
