"""Every registered query against its DuckDB oracle at the smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from chainflow.plans import registry
from tools.oracle_check import TABLES, rows_of

SF = "/root/testdata/sf0.001"
registry.load_all()
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "StringType": "VARCHAR",
                 "DoubleType": "DOUBLE", "BooleanType": "BOOLEAN"}


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    df = QUERIES[key](spark, SF)
    res = con.execute(ORACLES[key])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    duck_types = {d[0]: str(d[1]) for d in res.description}
    for f in df.schema.fields:
        t = type(f.dataType).__name__
        if t in SPARK_TO_DUCK:
            assert duck_types[f.name] == SPARK_TO_DUCK[t], (f.name, t, duck_types[f.name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns
