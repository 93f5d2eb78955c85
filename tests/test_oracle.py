"""Every registered sales query against its DuckDB oracle on the smallest
tables (the driver's correctness gate, in miniature; tools/check_oracle.py
runs them at any scale)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from salesmart.plans import catalog
from salesmart.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
# Spark type name -> DuckDB type name of the same column.
_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, bool):
            return ("b", v)
        if isinstance(v, (int, float)) and not (isinstance(v, float) and math.isnan(v)):
            return ("n", float(v))
        return ("s", str(v) if v is not None else "")

    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert {c: _DUCK.get(t, t) for c, t in df.dtypes} == duck_types
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(dcols, drows)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL) <= set(E.oracle_sql())
