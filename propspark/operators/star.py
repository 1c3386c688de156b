"""Flat sale table -> star schema.

Dimensions are distinct rows on their key (NULL keys removed, one row per
key, first row by the stated order wins, as INSERT OR IGNORE keeps the
first).  Facts get consecutive surrogate ids from the distributed numbering
of ``ranking.consecutive_ids``; ``biens``, ``proximite`` and ``mutations``
share one numbered frame, so their ids advance in lockstep (one property
row per sale, Q14).  With ``shared`` the flat table's used columns are written
once in the shared folder, and dimensions and facts all read that table, so
the joins that make the flat table run once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.constants import POI_CATEGORIES
from propspark.functions.scalar import empty_to_null_double
from propspark.operators.dedup import distinct_dim
from propspark.operators.ranking import consecutive_ids
from propspark.session import shared_table

DEPT_MEASURES = {
    "nb_menages_2021_departement": "nb_menages_2021",
    "revenu_median_2021_departement": "revenu_median_2021",
    "taux_chomage_2023_departement": "taux_chomage_2023",
    "salaire_net_horaire_moyen_2022_departement": "salaire_net_horaire_moyen_2022",
}
COMMUNE_MEASURES = {
    "nb_menages_2021_commune": "nb_menages_2021",
    "revenu_median_2021_commune": "revenu_median_2021",
}
INDICATOR_MEASURES = {
    "Crédits à l'habitat hors renégociations": "credits_habitat_hors_renegociations",
    "Taux hors renégociations": "taux_hors_renegociations",
    "Variations d'encours mensuelles cvs": "variations_encours_mensuelles_cvs",
    "IPC": "ipc",
}
BIEN_COLUMNS = ["id_parcelle", "type_local", "surface_reelle_bati", "surface_terrain",
                "longitude", "latitude", "x_proj", "y_proj",
                "type_local__Maison", "type_local__Appartement"]
MUTATION_COLUMNS = ["date_mutation", "valeur_fonciere", "valeur_fonciere_log", "nature_mutation",
                    "code_commune", "prix_par_m2_habitable", "prix_par_m2_terrain"]


def proximity_columns(categories=POI_CATEGORIES) -> list[str]:
    out = []
    for c in categories:
        out += [f"nb_{c}", f"distance_min_{c}", f"distance_min_{c}_manquante"]
    return out


def dimension(df: DataFrame, key: str, measures: dict[str, str], key_alias: str | None = None,
              extra: list[str] = (), order: list[str] | None = None) -> DataFrame:
    """Distinct dimension rows on ``key`` with renamed measures."""
    cols = list(extra) + list(measures)
    dim = distinct_dim(df, key, cols, order)
    return dim.select(F.col(key).alias(key_alias or key), *extra,
                      *[F.col(src).alias(dst) for src, dst in measures.items()])


def number_facts(df: DataFrame, order: list[str], id_col: str = "id_bien") -> DataFrame:
    """Consecutive ids 1..N in ``order``."""
    return consecutive_ids(df, order, id_col=id_col)


class StarTables(dict):
    """The six star tables; the three fact tables share one numbered frame
    that is computed (one checkpoint + a per-partition count) only when a
    fact table is first requested."""

    def __init__(self, dims: dict, facts):
        super().__init__(dims)
        self._facts = facts
        self._built = False

    def _build(self):
        if not self._built:
            super().update(self._facts())
            self._built = True

    def __getitem__(self, key):
        if key in ("biens", "proximite", "mutations"):
            self._build()
        return super().__getitem__(key)

    def keys(self):
        self._build()
        return super().keys()

    def items(self):
        self._build()
        return super().items()

    def __iter__(self):
        self._build()
        return super().__iter__()


def build_star(df: DataFrame, order: list[str], categories=POI_CATEGORIES,
               dept_measures=DEPT_MEASURES, commune_measures=COMMUNE_MEASURES,
               indicator_measures=INDICATOR_MEASURES, bien_cols=BIEN_COLUMNS,
               mutation_cols=MUTATION_COLUMNS, shared: bool = False) -> StarTables:
    """K3: the six star tables from the model-ready flat table.

    Coordinates given as text are typed with F20 (empty -> NULL).  ``shared``
    is for a flat table that is costly to compute, when several of the tables
    are read; one that is read from files needs none."""
    if shared:
        used = ["code_departement", *dept_measures, "code_commune", *commune_measures, "date_mutation",
                *indicator_measures, *order, *bien_cols, *proximity_columns(categories), *mutation_cols]
        df = shared_table(df.select(*dict.fromkeys(used)), "flat")

    def facts():
        numbered = number_facts(df, order)
        coords = [empty_to_null_double(c).alias(c) for c in ("longitude", "latitude") if c in bien_cols]
        biens = numbered.select("id_bien", *[c for c in bien_cols if c not in ("longitude", "latitude")],
                                *coords)
        proximite = numbered.select(F.col("id_bien").alias("id_proximite"), "id_bien",
                                    *proximity_columns(categories))
        mutations = numbered.select(F.col("id_bien").alias("id_mutation"), "id_bien",
                                    *[F.col(c).cast("string").alias(c) if c == "date_mutation" else F.col(c)
                                      for c in mutation_cols])
        return {"biens": biens, "proximite": proximite, "mutations": mutations}

    dims = {
        "departements": dimension(df, "code_departement", dept_measures),
        "communes": dimension(df, "code_commune", commune_measures, extra=["code_departement"]),
        "indicateurs_economiques": dimension(df, "date_mutation", indicator_measures,
                                             key_alias="date_indicateur").withColumn(
            "date_indicateur", F.col("date_indicateur").cast("string")),
    }
    return StarTables(dims, facts)
