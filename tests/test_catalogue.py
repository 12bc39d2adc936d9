"""Every query with SQL gives the same table in DuckDB."""

import math
import os

import duckdb
import pytest

from tabwright import catalogue

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    return repr(float(v)) if isinstance(v, float) else str(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: KINDS.get(t, t) for c, t in df.dtypes} == types
    assert _rows(df.columns, df.collect()) == _rows(columns, result.fetchall())


# whole jobs that test_models.py runs with checks of their results
ELSEWHERE = {"full_run", "cv_balanced", "evaluate_dir", "train_compare", "model_roundtrip"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - ELSEWHERE))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
