"""Cleaning, dedup, ranking, imputation, features, star, listings, audits."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from propspark.constants import KEPT_SALES_COLUMNS, RAW_SALES_COLUMNS
from propspark.operators import (catalog, clean, dedup, features, impute, listings, macro, profile,
                                 quality, ranking, star)


def _raw_row(**kw):
    row = {c: None for c in RAW_SALES_COLUMNS}
    row.update(kw)
    return tuple(row[c] for c in RAW_SALES_COLUMNS)


def _raw(spark, rows):
    schema = ", ".join(f"{c} string" for c in RAW_SALES_COLUMNS)
    return spark.createDataFrame([_raw_row(**r) for r in rows], schema)


BASE = dict(date_mutation="2021-03-01", nature_mutation="Vente", valeur_fonciere="250000",
            type_local="Maison", surface_reelle_bati="100", surface_terrain="400",
            longitude="2.35", latitude="48.85", code_commune="75056", code_departement="75")


def test_clean_sales_filters_types_and_dedups(spark):
    rows = [
        BASE,
        dict(BASE),                                                          # exact duplicate
        dict(BASE, nature_mutation="Echange"),                               # not a sale
        dict(BASE, type_local=None),                                         # NULL type: no match
        dict(BASE, type_local="Dépendance"),
        dict(BASE, valeur_fonciere=None),
        dict(BASE, longitude=None),
        dict(BASE, date_mutation="2021-04-02", surface_reelle_bati="0", type_local="Appartement"),
        dict(BASE, date_mutation="2021-05-02", surface_reelle_bati="12,5", surface_terrain="1 234"),
        dict(BASE, date_mutation="2021-06-02", nature_mutation="Vente terrain à bâtir"),
    ]
    out = clean.clean_sales(_raw(spark, rows), partition_key=None).orderBy("date_mutation").collect()
    assert len(out) == 4
    assert out[0].valeur_fonciere == 250000.0 and out[0].prix_par_m2_habitable == 2500.0
    assert out[0].annee_mois == "2021-03" and out[0].annee == 2021
    assert out[1].prix_par_m2_habitable is None                         # area 0 -> NULL (Q3)
    assert out[2].surface_reelle_bati == 12.5 and out[2].surface_terrain == 1234.0
    sub = clean.clean_sales(_raw(spark, [rows[8]]), numeric_mode="substitute", partition_key=None).first()
    assert sub.surface_reelle_bati == pytest.approx(120.000015)        # Q2 reproduced on request
    assert set(KEPT_SALES_COLUMNS) <= set(out[0].asDict())


def test_dedup_subset_picks_smallest_remaining_row(spark):
    df = spark.createDataFrame([(1, "x", 5.0), (1, "x", 3.0), (1, None, 9.0), (None, "x", 1.0), (None, "x", 0.5)],
                               "k int, g string, v double")
    got = sorted(dedup.dedup_subset(df, ["k", "g"]).collect(), key=repr)
    assert sorted(map(tuple, got), key=repr) == sorted([(1, "x", 3.0), (1, None, 9.0), (None, "x", 0.5)], key=repr)


def test_dedup_nulls_first_in_survivor(spark):
    df = spark.createDataFrame([(1, None, 1.0), (1, "a", 0.0)], "k int, s string, v double")
    assert tuple(dedup.dedup_subset(df, ["k"]).first()) == (1, None, 1.0)


def test_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 3, "new"), ("b", 2, "only")], "id string, seq long, v string")
    assert sorted(map(tuple, dedup.last_wins(df, ["id"], "seq").collect())) == [("a", 3, "new"), ("b", 2, "only")]


def test_consecutive_ids_equal_global_row_number(spark):
    rnd = random.Random(5)
    vals = [(rnd.randint(0, 10**6), i) for i in range(3000)]
    df = spark.createDataFrame(vals, "v long, k long").repartition(7)
    got = ranking.consecutive_ids(df, ["v", "k"], num_partitions=5).orderBy("id").collect()
    exp = sorted(vals)
    assert [r.id for r in got] == list(range(1, 3001))
    assert [(r.v, r.k) for r in got] == exp


@pytest.mark.parametrize("n", [1, 2, 1001])
def test_exact_quantiles_equal_numpy_linear(spark, n):
    rnd = random.Random(n)
    vals = [rnd.uniform(0, 1e6) for _ in range(n)] + [None, float("nan")]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    qs = [0.001, 0.25, 0.5, 0.999]
    got = ranking.exact_quantiles(df, "v", qs)
    arr = np.array([v for v in vals if v is not None and v == v])
    for q in qs:
        assert got[q] == pytest.approx(float(np.quantile(arr, q)), rel=1e-12)


def test_quantile_trim_keeps_band_and_returns_thresholds(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 1001)], "v double")
    out, th = features.quantile_trim(df, "v", 0.001, 0.999, lo=10.0)
    assert th["lo"] == 10.0 and th["hi"] == pytest.approx(np.quantile(np.arange(1, 1001), 0.999))
    assert out.count() == sum(1 for i in range(1, 1001) if 10 <= i <= th["hi"])


def test_hash_sample_is_partitioning_invariant(spark):
    df = spark.createDataFrame([(i, i * 1.5) for i in range(500)], "k long, v double")
    a = [r.k for r in features.hash_sample(df, 50, ["k"]).collect()]
    b = [r.k for r in features.hash_sample(df.repartition(9), 50, ["k"]).collect()]
    assert a == b and len(set(a)) == 50
    assert features.hash_sample(df, 1000, ["k"]).count() == 500     # fewer rows than n: all


def test_log_onehot_fixed_vocabulary(spark):
    df = spark.createDataFrame([(100.0, "Maison"), (1000.0, None)], "v double, t string")
    out = features.log_onehot(df, "v", "t", vocabulary=["Maison", "Appartement"]).collect()
    assert out[0]["t__Maison"] == 1 and out[0]["t__Appartement"] == 0 and out[1]["t__Maison"] is None


def test_group_mean_impute_by_department_prefix(spark):
    df = spark.createDataFrame([("75101", 10.0), ("75102", None), ("75103", 30.0), ("97101", None),
                                ("97102", 7.0), (None, None)], "code string, v double")
    got = {r.code: r.v for r in impute.group_mean_impute(df, "v", "code").collect()}
    assert got == {"75101": 10.0, "75102": 20.0, "75103": 30.0, "97101": 7.0, "97102": 7.0, None: None}


def test_literal_household_fill(spark):
    df = spark.createDataFrame([("75115", None), ("75115", 5.0), ("01001", None)], "code_commune string, n double")
    dim = impute.households_dim(spark)
    got = [r.n for r in impute.literal_household_fill(df, dim, target="n").orderBy("code_commune", "n").collect()]
    assert got == [None, 5.0, float(round(227746 / 2.2))]


def test_distance_missing_flags(spark):
    cols = {f"distance_min_{c}": None for c in ["gares", "commerces"]}
    df = spark.createDataFrame([(12.0, None)], "distance_min_gares double, distance_min_commerces double")
    out = impute.distance_missing_flags(df, ["gares", "commerces"], {"gares": 1500, "commerces": 500}).first()
    assert (out.distance_min_gares, out.distance_min_gares_manquante) == (12.0, 0)
    assert (out.distance_min_commerces, out.distance_min_commerces_manquante) == (500.0, 1)
    del cols


def test_macro_series_chain_and_month_join(spark):
    prod = spark.createDataFrame([("janv. 2015", "8,6"), ("févr. 2015", "9"), ("déc. 2014", "1,0")],
                                 "Category string, v1 string")
    rate = spark.createDataFrame([("janv. 2015", "2,49"), ("févr. 2015", "2,3")], "Category string, v2 string")
    s1 = macro.typed_series(prod, "Category", ["v1"])
    s2 = macro.typed_series(rate, "Category", ["v2"])
    chain = macro.macro_chain([s1, s2]).orderBy("Date").collect()
    assert [(r.Date, r.v1, r.v2) for r in chain] == [(dt.date(2015, 1, 1), 8.6, 2.49), (dt.date(2015, 2, 1), 9.0, 2.3)]
    sales = spark.createDataFrame([(1, dt.date(2015, 1, 20)), (2, dt.date(2016, 1, 3))], "id int, d date")
    got = {r.id: r.v1 for r in macro.attach_month(sales, macro.macro_chain([s1, s2]), "d").collect()}
    assert got == {1: 8.6, 2: None}


def test_attach_census_drops_clashing_name(spark):
    sales = spark.createDataFrame([("75056", "75", "Paris")], "code_commune string, code_departement string, nom_commune string")
    com = spark.createDataFrame([("75056", "PARIS", 1.0)], "code_commune string, nom_commune string, m double")
    dep = spark.createDataFrame([("75", 2.0)], "code_departement string, d double")
    r = macro.attach_census(sales, com, dep).first()
    assert (r.nom_commune, r.m, r.d) == ("Paris", 1.0, 2.0)


def test_profiles(spark):
    df = spark.createDataFrame([(1.0, "Maison"), (None, "Appartement"), (3.0, "Maison")], "v double, t string")
    cc = profile.class_counts(df, "t", ["Maison", "Appartement"]).first()
    assert (cc.n_total, cc.n_Maison, cc.n_Appartement) == (3, 2, 1)
    nulls = {r.column_name: r.null_count for r in profile.null_counts(df).collect()}
    assert nulls == {"v": 1, "t": 0}
    p = profile.numeric_profile(df, ["v"]).first()
    assert (p["count"], p.null_count, p.mean, p.min, p.p50, p.max) == (2, 1, 2.0, 1.0, 2.0, 3.0)


def test_build_star_lockstep_ids_and_dims(spark):
    flat = spark.createDataFrame([
        ("2021-01-05", 100.0, "75056", "75", 1.0, 2.0, "P1", "Maison"),
        ("2021-01-05", 200.0, "75056", "75", 1.0, 2.0, "P2", "Appartement"),
        ("2021-02-01", 300.0, None, None, None, None, "P3", "Maison"),
    ], "date_mutation string, valeur_fonciere double, code_commune string, code_departement string, "
       "nb_menages_2021_commune double, revenu_median_2021_commune double, id_parcelle string, type_local string")
    flat = flat.withColumn("d", F.to_date("date_mutation")).drop("date_mutation").withColumnRenamed("d", "date_mutation")
    st = star.build_star(flat, ["valeur_fonciere"], categories=[], dept_measures={},
                         commune_measures={"nb_menages_2021_commune": "nb_menages_2021"},
                         indicator_measures={}, bien_cols=["id_parcelle", "type_local"],
                         mutation_cols=["date_mutation", "valeur_fonciere", "code_commune"])
    muts = st["mutations"].orderBy("id_mutation").collect()
    biens = st["biens"].orderBy("id_bien").collect()
    assert [(m.id_mutation, m.id_bien, m.valeur_fonciere) for m in muts] == [(1, 1, 100.0), (2, 2, 200.0), (3, 3, 300.0)]
    assert [b.id_parcelle for b in biens] == ["P1", "P2", "P3"]
    assert st["communes"].count() == 1 and st["departements"].count() == 1     # NULL keys removed
    assert sorted(r.date_indicateur for r in st["indicateurs_economiques"].collect()) == ["2021-01-05", "2021-02-01"]


def test_build_listings_last_wins_and_images(spark):
    cols = listings.ANNONCE_COLUMNS + listings.DIAGNOSTIC_COLUMNS
    base = {c: None for c in cols}

    def rec(seq, **kw):
        r = dict(base, **kw)
        return tuple(r[c] for c in cols) + (kw.get("image_urls"), seq)

    schema = ", ".join(f"{c} string" for c in cols) + ", image_urls array<string>, ingest_seq long"
    rows = [rec(1, id="A", prix="100", image_principale="m1", image_urls=["u1", "", "u2"]),
            rec(2, id="A", prix="150", image_principale="", image_urls=None),
            rec(3, id="B", prix="90", dpe_lettre="C", image_principale="m2", image_urls=["v1"])]
    df = spark.createDataFrame(rows, schema)
    t = listings.build_listings(df)
    assert {r.id: r.prix for r in t["annonces"].collect()} == {"A": "150", "B": "90"}
    assert t["diagnostics"].count() == 2
    imgs = sorted((r.id_annonce, r.url_image, r.est_principale) for r in t["images"].collect())
    assert imgs == [("A", "m1", 1), ("A", "u1", 0), ("A", "u2", 0), ("B", "m2", 1), ("B", "v1", 0)]
    man = sorted((r.id_annonce, r.n, r.path) for r in listings.image_manifest(df).collect())
    assert man == [("A", 1, "A/image_1.jpg"), ("A", 3, "A/image_3.jpg"), ("B", 1, "B/image_1.jpg")]


def test_audit_counts_each_rule(spark):
    parent = spark.createDataFrame([(1,), (2,)], "k int")
    child = spark.createDataFrame([(1, 1, "x"), (1, 3, "y"), (2, None, None), (3, 2, "zz")], "id int, fk int, c string")
    rules = {"child": quality.Rules(primary_key=["id"], not_null=["c"], checks={"c": ["x", "y"]},
                                    foreign_keys={"fk": ("parent", "k")})}
    got = {(r.rule, r.column_name): r.violations
           for r in quality.audit({"child": child, "parent": parent}, rules).collect()}
    assert got == {("not_null", "c"): 1, ("check", "c"): 1, ("primary_key", "id"): 1, ("foreign_key", "fk"): 1}
    d = quality.apply_defaults(child, {"fk": 0}).filter("id = 2").first()
    assert d.fk == 0


def test_catalog_stats_preview_sql(spark):
    t = {"a": spark.createDataFrame([(1,), (2,)], "x int"), "b": spark.createDataFrame([("q",)], "y string")}
    stats = {r.table_name: (r.row_count, r.column_count) for r in catalog.table_stats(t).collect()}
    assert stats == {"a": (2, 1), "b": (1, 1)}
    catalog.register_views(spark, t)
    catalog.register_views(spark, t)     # re-registering replaces (Q13)
    assert catalog.adhoc_sql(spark, "SELECT sum(x) AS s FROM a").first().s == 3
    assert [r.x for r in catalog.table_preview(t["a"], 1, ["x"]).collect()] == [1]


def test_hash_sample_threshold_path_equals_python_md5(spark):
    import hashlib
    df = spark.createDataFrame([(i, float(i)) for i in range(3000)], "k long, v double").repartition(6)
    got = [r.k for r in features.hash_sample(df, 25, ["k"], seed=42).collect()]
    exp = sorted(range(3000), key=lambda i: (hashlib.md5(f"{i}|42".encode()).hexdigest(), i))[:25]
    assert sorted(got) == sorted(exp)
