"""Listing tables.

``annonces`` and ``diagnostics``: the last record per listing id wins
(INSERT OR REPLACE).  ``images``: one row per non-empty image URL of every
record (duplicates within one load kept), main image flagged 1, listed
before the others.  Last-wins is a ``max(struct(seq, ...))`` aggregation,
not a window, so a listing id repeated millions of times is combined
map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.functions.scalar import image_path
from propspark.operators.dedup import last_wins
from propspark.operators.ranking import consecutive_ids

ANNONCE_COLUMNS = ["id", "url", "date_publication", "type", "titre", "prix", "honoraires",
                   "surface", "pieces", "chambres", "etage", "ascenseur", "ville", "code_postal",
                   "latitude", "longitude", "etat", "salle_de_bain", "chauffage_type",
                   "chauffe_eau", "exposition", "charges_annuelles", "description",
                   "image_principale"]
DIAGNOSTIC_COLUMNS = ["dpe_valeur", "dpe_lettre", "ges_valeur", "ges_lettre"]


def upsert_last_wins(df: DataFrame, key: str = "id", seq: str = "ingest_seq") -> DataFrame:
    """Per key the record with the largest ingest sequence."""
    return last_wins(df, [key], seq)


def image_rows(df: DataFrame, key: str = "id", main: str = "image_principale",
               others: str = "image_urls", seq: str = "ingest_seq") -> DataFrame:
    """U3 + P14: main image (flag 1) and other images (flag 0), empty URLs
    skipped, ``n`` = position of the image within its record (1-based,
    main first)."""
    main_rows = (df.filter(F.col(main).isNotNull() & (F.col(main) != ""))
                 .select(F.col(key).alias("id_annonce"), F.col(seq).alias("_seq"),
                         F.lit(0).alias("_pos"), F.col(main).alias("url_image"),
                         F.lit(1).alias("est_principale")))
    other_rows = (df.select(key, seq, F.posexplode_outer(F.coalesce(F.col(others), F.array().cast("array<string>"))))
                  .filter(F.col("col").isNotNull() & (F.col("col") != ""))
                  .select(F.col(key).alias("id_annonce"), F.col(seq).alias("_seq"),
                          (F.col("pos") + 1).alias("_pos"), F.col("col").alias("url_image"),
                          F.lit(0).alias("est_principale")))
    return main_rows.unionByName(other_rows)


def image_manifest(df: DataFrame, key: str = "id", others: str = "image_urls") -> DataFrame:
    """downloaded-image path ``<id>/image_<n>.jpg`` for each listed image
    URL, n from 1 in list order; empty URLs skipped."""
    return (df.select(key, F.posexplode(F.coalesce(F.col(others), F.array().cast("array<string>"))))
            .filter(F.col("col").isNotNull() & (F.col("col") != ""))
            .select(F.col(key).alias("id_annonce"), (F.col("pos") + 1).cast("int").alias("n"),
                    F.col("col").alias("url_image"), image_path(F.col(key), F.col("pos") + 1).alias("path")))


def build_listings(df: DataFrame, key: str = "id", seq: str = "ingest_seq") -> dict[str, DataFrame]:
    """K4: ``annonces``, ``diagnostics``, ``images`` from typed listing records,
    with consecutive ``id_diagnostic`` and ``id_image``."""
    latest = upsert_last_wins(df.select(*ANNONCE_COLUMNS, *DIAGNOSTIC_COLUMNS, seq), key, seq)
    return {
        "annonces": latest.select(*ANNONCE_COLUMNS),
        "diagnostics": consecutive_ids(latest.select(F.col(key).alias("id_annonce"), *DIAGNOSTIC_COLUMNS),
                                       ["id_annonce"], id_col="id_diagnostic"),
        "images": consecutive_ids(image_rows(df, key, seq=seq), ["_seq", "id_annonce", "_pos"],
                                  id_col="id_image").drop("_seq", "_pos"),
    }
