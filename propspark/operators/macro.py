"""Monthly macro series and census joins (S3-S5 typed, F5, F6, J1-J4, P8, P9, F23).

Month-grained and census-grained tables are small: a monthly series holds
12 rows per year, so it is bounded by the calendar and broadcast as it is: the
sales are never shuffled on a few months.  Census tables take a size check
and fall back to a shuffle join when they grow.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propspark.constants import MACRO_START
from propspark.functions.scalar import comma_decimal, french_month_to_date, month_key
from propspark.operators.joins import bounded_broadcast, broadcast_if_small



def typed_series(df: DataFrame, label_col: str, value_cols: list[str],
                 start: str | None = MACRO_START, label_format: str = "french",
                 date_col: str = "Date") -> DataFrame:
    """Series with a month label -> (date_col DATE, DOUBLE values), from ``start``.

    ``label_format``: ``french`` ("janv. 2015", F5) or ``yyyy-MM`` (S4).
    Value columns are parsed with a decimal comma (F6).
    """
    if label_format == "french":
        d = french_month_to_date(label_col)
    else:
        d = F.try_to_date(F.col(label_col), label_format)
    out = df.select(d.alias(date_col), *[comma_decimal(c).alias(c) for c in value_cols])
    if start:
        out = out.filter(F.col(date_col) >= F.to_date(F.lit(start)))
    return out


def macro_chain(series: list[DataFrame], on: str = "Date") -> DataFrame:
    """Inner join of monthly series on the month (each bounded by months)."""
    return reduce(lambda a, b: a.join(bounded_broadcast(b), on, "inner"), series)


def attach_month(sales: DataFrame, macro: DataFrame, sale_date: str,
                 macro_date: str = "Date", key: str = "year_month") -> DataFrame:
    """Left join the macro table on ``yyyy-MM`` of the sale date, then drop
    the join key and the macro date (P8)."""
    m = macro.withColumn(key, month_key(macro_date)).drop(macro_date)
    s = sales.withColumn(key, month_key(sale_date))
    return s.join(bounded_broadcast(m), key, "left").drop(key)


def rename_cast(df: DataFrame, renames: dict[str, str], doubles: list[str] = ()) -> DataFrame:
    """P9 + F23: rename columns then cast measures to DOUBLE (bad text -> NULL)."""
    out = df.withColumnsRenamed(renames)
    return out.withColumns({c: F.col(c).try_cast("double") for c in doubles})


def attach_census(sales: DataFrame, commune: DataFrame | None, departement: DataFrame | None,
                  commune_key: str = "code_commune", dept_key: str = "code_departement",
                  drop_clashing: bool = True) -> DataFrame:
    """J3 + J4: commune then department census, both left joins.

    Columns of a census table that already exist in ``sales`` (other than
    the key) are dropped from the census side first, as the source pipeline
    drops the duplicated commune name.
    """
    out = sales
    for dim, key in ((commune, commune_key), (departement, dept_key)):
        if dim is None:
            continue
        if drop_clashing:
            clash = [c for c in dim.columns if c in out.columns and c != key]
            dim = dim.drop(*clash)
        out = out.join(broadcast_if_small(dim), key, "left")
    return out
