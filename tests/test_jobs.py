"""The sale job end to end on sf0.001: tables written, ids in lockstep,
views registered over the written tables."""

from __future__ import annotations

import os

import pytest

from propspark.plans.jobs import sales_job

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_sales_job_writes_partitioned_model_and_star(spark, tmp_dir):
    out = sales_job(spark, SF, os.path.join(tmp_dir, "out"))
    assert any(p.startswith("annee=") for p in os.listdir(os.path.join(tmp_dir, "out", "sales_final")))
    n = out["sales_final"].count()
    assert n > 0
    assert out["mutations"].count() == out["biens"].count() == out["proximite"].count() == n
    ids = sorted(r.id_mutation for r in out["mutations"].select("id_mutation").collect())
    assert ids == list(range(1, n + 1))
    joined = out["mutations"].join(out["biens"], "id_bien").count()
    assert joined == n
    assert spark.sql("SELECT sum(nb_transactions) AS s FROM vue_stats_departement").first().s == n
    # The facts are bucketed by sale: they join without an exchange.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = out["mutations"].join(out["biens"], "id_bien").select("valeur_fonciere", "id_parcelle")
        plan = facts._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    again = sales_job(spark, SF, os.path.join(tmp_dir, "out"))
    assert again["mutations"].count() == n


def test_listings_job_last_wins_and_views(spark, tmp_dir):
    import json
    from propspark.plans.jobs import listings_job
    p = os.path.join(tmp_dir, "listings.json")
    recs = [{"id": "A", "type": "Appartement", "prix": 100000, "surface": 50.0, "ville": "Brest",
             "code_postal": "29200", "dpe_lettre": "C", "image_principale": "a0", "image_urls": ["a1"]},
            {"id": "B", "type": "Maison", "prix": {"value": 0, "commission": 200000}, "surface": 100.0,
             "ville": "Brest", "code_postal": "29200", "dpe_lettre": "Not applicable"},
            {"id": "A", "type": "Appartement", "prix": 120000, "surface": 50.0, "ville": "Brest",
             "code_postal": "29200", "dpe_lettre": "B"}]
    with open(p, "w", encoding="utf-8") as f:
        json.dump(recs, f)
    out = listings_job(spark, p, os.path.join(tmp_dir, "out"))
    assert {r.id: r.prix for r in out["annonces"].collect()} == {"A": 120000.0, "B": 200000.0}
    town = spark.sql("SELECT nb_annonces, prix_moyen FROM vue_stats_ville").first()
    assert (town.nb_annonces, town.prix_moyen) == (2, 160000.0)
    assert [r.dpe_lettre for r in spark.sql("SELECT dpe_lettre FROM vue_stats_dpe").collect()] == ["B"]
    assert out["images"].count() == 2


def test_poi_job_writes_one_folder_per_category(spark, tmp_dir):
    from propspark.plans.jobs import poi_job
    schema = "kind string, id long, tags map<string,string>, coords array<struct<lon:double,lat:double>>"
    els = spark.createDataFrame([
        ("node", 1, {"amenity": "pharmacy", "name": "A"}, [(3.0, 46.5)]),
        ("node", 2, {"amenity": "pharmacy", "name": "A"}, [(3.0, 46.5)]),
        ("node", 3, {"public_transport": "station"}, [(3.1, 46.5)])], schema)
    src = os.path.join(tmp_dir, "elements")
    els.write.parquet(src)
    out = poi_job(spark, src, os.path.join(tmp_dir, "out"))
    parts = sorted(p for p in os.listdir(os.path.join(tmp_dir, "out", "poi")) if p.startswith("category="))
    assert parts == ["category=gares", "category=pharmacies"]
    assert sorted((r.category, r.id) for r in out.collect()) == [("gares", 3), ("pharmacies", 1)]


def test_star_from_one_written_flat_table(spark):
    """The tables of a shared star read the written flat table, not its joins."""
    from propspark.plans.q_sales import _star
    st = _star(spark, SF, shared=True)
    plain = _star(spark, SF)
    for name in ("departements", "communes", "indicateurs_economiques"):
        plan = st[name]._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and plan.count("FileScan") == 1
        key = st[name].columns[0]
        assert st[name].orderBy(key).collect() == plain[name].orderBy(key).collect()
