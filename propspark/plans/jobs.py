"""Batch jobs: the sale and listing flows end to end, writing their tables.

``sales_job`` runs E1 and E2 on the driver tables: the model-ready sale
table is written as Parquet partitioned by year (K1), the six star tables
are built from the written table and written next to it, and the views are
registered over the written tables (K5).  The fact tables are bucketed by
``id_bien``, so they join each other without a shuffle.  Every stage reads what the
previous one wrote, so lineage is cut by tables in the output folder
(which on a cluster is a shared folder).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from propspark.constants import POI_DEDUP_THRESHOLD_M
from propspark.operators import catalog, star
from propspark.operators.spatial import dedup_pois
from propspark.operators.listings import build_listings
from propspark.plans import views
from propspark.plans.bindings import MACRO_MEASURES
from propspark.plans.q_pipeline import sales_model_ready_df
from propspark.sources.files import write_bucketed, write_table
from propspark.sources.listings import read_listings, type_listing
from propspark.sources.map_elements import extract_poi

STAR_BIEN_COLUMNS = ["id_parcelle", "type_local", "surface_reelle_bati", "surface_terrain",
                     "longitude", "latitude", "x_proj", "y_proj",
                     "type_local__Maison", "type_local__Appartement"]


def sales_job(spark: SparkSession, sf_dir: str, out_dir: str, buckets: int | None = None) -> dict[str, DataFrame]:
    """E1 + E2: model-ready table and star schema written under ``out_dir``;
    returns the written tables (read back) and registers the views.  The
    facts have ``buckets`` buckets (default: the session's shuffle partitions)."""
    model_path = os.path.join(out_dir, "sales_final")
    write_table(sales_model_ready_df(spark, sf_dir), model_path, partition_by=["annee"])
    model = spark.read.parquet(model_path)

    tables = star.build_star(model, ["id_parcelle"], bien_cols=STAR_BIEN_COLUMNS,
                             indicator_measures={m: m for m in MACRO_MEASURES})
    written = {}
    for name in ("departements", "communes", "indicateurs_economiques"):
        path = os.path.join(out_dir, name)
        write_table(tables[name], path)
        written[name] = spark.read.parquet(path)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    for name in ("biens", "proximite", "mutations"):
        written[name] = write_bucketed(tables[name], os.path.join(out_dir, name), f"fact_{name}", "id_bien", buckets)

    named_views = {
        "vue_transactions_completes": views.complete_transactions(
            written["mutations"], written["biens"], written["communes"], written["departements"],
            written["indicateurs_economiques"]),
        "vue_stats_commune": views.commune_stats(written["communes"], written["mutations"]),
        "vue_stats_departement": views.department_stats(written["departements"], written["communes"],
                                                        written["mutations"]),
    }
    catalog.register_views(spark, {**{f"star_{k}": v for k, v in written.items()}, **named_views})
    return {"sales_final": model, **written, **named_views}


def listings_job(spark: SparkSession, json_path, out_dir: str, multiline: bool = True) -> dict[str, DataFrame]:
    """Listing JSON -> typed records -> annonces / diagnostics / images
    written under ``out_dir`` -> listing views registered over them."""
    records = type_listing(read_listings(spark, json_path, multiline=multiline))
    tables = build_listings(records)
    written = {}
    for name, df in tables.items():
        path = os.path.join(out_dir, name)
        write_table(df, path)
        written[name] = spark.read.parquet(path)
    a, d = written["annonces"], written["diagnostics"]
    named_views = {
        "vue_annonces_complete": views.listing_view(a, d),
        "vue_stats_ville": views.town_stats(a),
        "vue_stats_type": views.type_stats(a),
        "vue_stats_dpe": views.energy_stats(a, d),
    }
    catalog.register_views(spark, {**{f"listing_{k}": v for k, v in written.items()}, **named_views})
    return {**written, **named_views}


def poi_job(spark: SparkSession, elements_path, out_dir: str,
            threshold: float = POI_DEDUP_THRESHOLD_M) -> DataFrame:
    """S10 + G4: landed map elements (Parquet) -> POIs per category, deduped,
    written partitioned by category (one folder per category)."""
    elements = spark.read.parquet(elements_path) if isinstance(elements_path, str) else elements_path
    pois = dedup_pois(extract_poi(elements), threshold)
    path = os.path.join(out_dir, "poi")
    write_table(pois, path, partition_by=["category"])
    return spark.read.parquet(path)
