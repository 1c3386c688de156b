"""First cleaning pass of the sale records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.constants import (KEPT_SALES_COLUMNS, LOCAL_TYPES, PLAIN_SALE, SALE_NATURES,
                                 SALES_DEDUP_KEY)
from propspark.functions.scalar import (clean_numeric, month_key, parse_date, safe_ratio,
                                        tolerant_float, year_of)
from propspark.operators.dedup import dedup_subset


def keep_values(df: DataFrame, col: str, values, null_as: str | None = None) -> DataFrame:
    """``col IN values``; with ``null_as`` a NULL is compared as that text."""
    c = F.coalesce(F.col(col), F.lit(null_as)) if null_as is not None else F.col(col)
    return df.filter(c.isin(list(values)))


def drop_nulls(df: DataFrame, cols: list[str]) -> DataFrame:
    """P4."""
    return df.na.drop(how="any", subset=cols)


def since(df: DataFrame, col: str, start: str) -> DataFrame:
    """``col >= start``."""
    return df.filter(F.col(col) >= F.to_date(F.lit(start)))


def trim_band(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """``lo <= col <= hi`` (bounds inclusive, NULL / NaN removed)."""
    c = F.col(col)
    return df.filter(c.between(F.lit(lo), F.lit(hi)) & ~F.isnan(c))


def clean_sales(raw: DataFrame, numeric_mode: str = "strict", partition_key: str | None = "_source_file",
                columns: list[str] = KEPT_SALES_COLUMNS) -> DataFrame:
    """Raw STRING sales -> typed sales.

    Prune to the kept columns, keep the three sale natures and the two local
    types, drop rows without price or coordinates, type the numbers (F1)
    and the date (F2), add month key, year and unit prices (F3, F4, F7) and
    drop duplicates on the five-column key within each source file, as the
    files are one per department; ``partition_key=None`` removes duplicates
    across files.  Coordinates are typed before the dedup (quirk Q6).  Junk
    in a price gives NULL in strict mode, and such rows are dropped with the
    rows without a price.
    """
    cols = list(columns) + ([partition_key] if partition_key and partition_key not in columns else [])
    area_junk = "0.00001"
    df = raw.select(*cols)
    df = keep_values(df, "nature_mutation", SALE_NATURES)
    df = keep_values(df, "type_local", LOCAL_TYPES, null_as="")
    df = drop_nulls(df, ["valeur_fonciere", "latitude", "longitude"])
    df = df.withColumns({
        "surface_reelle_bati": clean_numeric("surface_reelle_bati", numeric_mode, area_junk),
        "surface_terrain": clean_numeric("surface_terrain", numeric_mode, area_junk),
        "valeur_fonciere": clean_numeric("valeur_fonciere", numeric_mode, "0"),
        "date_mutation": parse_date("date_mutation"),
        "longitude": tolerant_float("longitude"),
        "latitude": tolerant_float("latitude"),
    })
    df = df.withColumns({
        "annee_mois": month_key("date_mutation"),
        "annee": year_of("date_mutation"),
        "prix_par_m2_habitable": safe_ratio("valeur_fonciere", "surface_reelle_bati"),
        "prix_par_m2_terrain": safe_ratio("valeur_fonciere", "surface_terrain"),
    })
    df = drop_nulls(df, ["valeur_fonciere"])
    key = SALES_DEDUP_KEY + ([partition_key] if partition_key else [])
    return dedup_subset(df, key)


def plain_sales(df: DataFrame, col: str = "nature_mutation", value: str = PLAIN_SALE) -> DataFrame:
    """P5."""
    return df.filter(F.col(col) == value)

