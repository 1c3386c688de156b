"""Every registered query against its DuckDB oracle on sf0.001 (the driver
checks sf0.01 the same way), plus the entry-point smoke check."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from propspark.plans import registry
from propspark.plans.bindings import TABLES

SF = os.environ.get("PROPSPARK_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["code_departement", "nb_ventes", "prix_m2_moyen"]
    assert 0 < df.count() <= 5


def test_every_query_has_an_oracle_or_is_listed():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(queries()) and set(registry.ORACLE) <= set(oracle_sql())


registry.load_all()


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(registry.ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, cols) == _canon(orows, ocols)
