"""Every registered query with an oracle equals its DuckDB SQL.

Runs at sf0.001 to keep the suite fast; tools/check_oracle.py runs the same
comparison at sf0.01 and sf0.1.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF001
from tools.check_oracle import TABLES, norm

QUERIES = entry.queries()
SQL = entry.oracle_sql()

# Spark simple type -> DuckDB type name, for the schema half of the check.
DUCK_TYPE = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, con, name):
    sdf = QUERIES[name](spark, SF001)
    stypes = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(SQL[name])
    assert stypes == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(SQL[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    order = sorted(scols)
    a = sorted(tuple(norm(r[scols.index(c)]) for c in order) for r in srows)
    b = sorted(tuple(norm(r[dcols.index(c)]) for c in order) for r in drows)
    assert len(a) == len(b)
    assert a == b


def test_every_query_has_oracle_or_is_a_model_job():
    rows_only = {q for q in set(QUERIES) - set(SQL) if not q.startswith("op") and q != "pipeline"}
    assert rows_only == {"m8_movement_rf", "m9_rf_forecast", "m10_rf_grid", "m11_adf_d", "m11_arima_order",
                         "m12_arima_forecast", "a17_compare_models"}
