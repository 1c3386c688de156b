"""Constraint audits (Q-PK, Q-FK, Q-NN, Q-CK, Q-DEF).

The table constraints of the relational load become counting queries:
``audit`` returns one row (table, rule, column, violations) per rule, all
rules of one table evaluated in a single aggregation where possible;
``quarantine`` returns the rows themselves.  ``STAR_RULES`` and
``LISTING_RULES`` declare the rules of the nine tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.constants import ENERGY_LETTERS, LISTING_STATES, LISTING_TYPES, POI_CATEGORIES, PROPERTY_TYPES


@dataclass
class Rules:
    primary_key: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    checks: dict[str, list] = field(default_factory=dict)        # column -> allowed values; a list with None never fails
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)  # column -> (table, column)
    unique: list[str] = field(default_factory=list)
    defaults: dict[str, object] = field(default_factory=dict)    # Q-DEF


_FLAGS = {f"distance_min_{c}_manquante": 0 for c in POI_CATEGORIES}

#: The rules of the six star tables.
STAR_RULES = {
    "departements": Rules(primary_key=["code_departement"]),
    "communes": Rules(primary_key=["code_commune"], not_null=["code_departement"],
                      foreign_keys={"code_departement": ("departements", "code_departement")}),
    "indicateurs_economiques": Rules(primary_key=["date_indicateur"]),
    "biens": Rules(primary_key=["id_bien"], checks={"type_local": PROPERTY_TYPES},
                   defaults={"type_local__Maison": 0, "type_local__Appartement": 0}),
    "proximite": Rules(primary_key=["id_proximite"], not_null=["id_bien"], foreign_keys={"id_bien": ("biens", "id_bien")}, defaults=_FLAGS),
    "mutations": Rules(primary_key=["id_mutation"], not_null=["date_mutation", "id_bien", "code_commune"],
                       foreign_keys={"id_bien": ("biens", "id_bien"), "code_commune": ("communes", "code_commune"),
                                     "date_mutation": ("indicateurs_economiques", "date_indicateur")}),
}
#: The rules of the three listing tables.
LISTING_RULES = {
    "annonces": Rules(primary_key=["id"], checks={"type": LISTING_TYPES, "etat": [*LISTING_STATES, None]}, defaults={"ascenseur": 0}),
    "diagnostics": Rules(primary_key=["id_diagnostic"], unique=["id_annonce"], not_null=["id_annonce"],
                         checks={"dpe_lettre": [*ENERGY_LETTERS, None], "ges_lettre": [*ENERGY_LETTERS, None]},
                         foreign_keys={"id_annonce": ("annonces", "id")}),
    "images": Rules(primary_key=["id_image"], not_null=["id_annonce", "url_image"], foreign_keys={"id_annonce": ("annonces", "id")},
                    defaults={"est_principale": 0}),
}


def apply_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Q-DEF: NULL -> column default."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def _row(table, rule, column, n):
    return F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
                    F.lit(column).alias("column_name"), n.cast("long").alias("violations"))


def _keys(r: Rules) -> list[tuple[str, list[str]]]:
    return [("primary_key", r.primary_key)] * bool(r.primary_key) + [("unique", [c]) for c in r.unique]


def with_defaults(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> dict[str, DataFrame]:
    """Q-DEF on every table: NULL -> the declared default."""
    return {t: apply_defaults(df, {c: v for c, v in rules[t].defaults.items() if c in df.columns}) if t in rules else df
            for t, df in tables.items()}


def audit(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    parts = []
    for t, r in rules.items():
        df = tables[t]
        cols = []
        for c in r.not_null:
            cols.append(_row(t, "not_null", c, F.count_if(F.col(c).isNull())))
        for c, allowed in r.checks.items():
            # NULL passes a CHECK (three-valued logic).
            cols.append(_row(t, "check", c, F.count_if(~F.col(c).isin(list(allowed)))))
        if cols:
            parts.append(df.agg(F.array(*cols).alias("a")).select(F.explode("a").alias("r")).select("r.*"))
        for rule, key in _keys(r):
            rows = df if rule == "primary_key" else df.filter(F.col(key[0]).isNotNull())  # NULL is not equal to itself
            dup = (rows.groupBy(*key).count().filter(F.col("count") > 1)
                   .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n")))
            parts.append(dup.select(_row(t, rule, ",".join(key), F.col("n")).alias("r")).select("r.*"))
        for c, (pt, pc) in r.foreign_keys.items():
            parent = tables[pt].select(F.col(pc).alias("_k")).distinct()
            orphans = (df.filter(F.col(c).isNotNull()).select(F.col(c).alias("_k"))
                       .join(parent, "_k", "left_anti").agg(F.count(F.lit(1)).alias("n")))
            parts.append(orphans.select(_row(t, "foreign_key", c, F.col("n")).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


def quarantine(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    """Rows that break a rule: (table_name, broken, row), with the sorted list
    of ``rule:column`` that the row breaks and the row as JSON.

    NOT NULL and CHECK rules are tested in the table's one scan.  A repeated
    key marks every row that has it: keys are counted in a combining
    aggregate, and only the repeated ones are joined back.  A foreign key is
    looked up in the parent's distinct keys."""
    parts = []
    for t, r in rules.items():
        df, columns = tables[t], tables[t].columns
        marks = [F.when(F.col(c).isNull(), F.lit(f"not_null:{c}")) for c in r.not_null]
        marks += [F.when(~F.col(c).isin(list(allowed)), F.lit(f"check:{c}")) for c, allowed in r.checks.items()]
        flagged = df
        for i, (rule, key) in enumerate(_keys(r)):
            rows = df if rule == "primary_key" else df.filter(F.col(key[0]).isNotNull())
            twice = rows.groupBy(*[F.col(c).alias(f"_k{j}") for j, c in enumerate(key)]).count().filter(F.col("count") > 1).drop("count")
            twice = twice.withColumn(f"_twice{i}", F.lit(True))
            same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{j}")) for j, c in enumerate(key)])
            flagged = flagged.join(twice, same, "left").drop(*[f"_k{j}" for j in range(len(key))])
            marks.append(F.when(F.col(f"_twice{i}"), F.lit(f"{rule}:{','.join(key)}")))
        for i, (c, (pt, pc)) in enumerate(r.foreign_keys.items()):
            parent = tables[pt].select(F.col(pc).alias("_p")).filter("_p IS NOT NULL").distinct().withColumn(f"_known{i}", F.lit(True))
            flagged = flagged.join(parent, F.col(c) == F.col("_p"), "left").drop("_p")
            marks.append(F.when(F.col(c).isNotNull() & F.col(f"_known{i}").isNull(), F.lit(f"foreign_key:{c}")))
        broken = F.array_sort(F.array_compact(F.array(*marks)))
        parts.append(flagged.withColumn("broken", broken).filter(F.size("broken") > 0)
                     .select(F.lit(t).alias("table_name"), "broken", F.to_json(F.struct(*columns)).alias("row")))
    return reduce(DataFrame.unionByName, parts)
