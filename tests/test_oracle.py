"""Every registered query against its SQL text run by DuckDB on the same parquet tables."""

import os

import pytest
from oracle import compare, duck

from forecourt.plans.registry import ORACLE_SQL, QUERIES, load_all

load_all()
SF_DIR = os.environ.get("FORECOURT_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, con, key):
    ok, msg = compare(QUERIES[key](spark, SF_DIR), con, ORACLE_SQL[key])
    assert ok, msg


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                   "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("key", sorted(k for k in ORACLE_SQL if k != "publish_snapshot"))
def test_column_types_match_oracle(spark, con, key):
    rel = con.sql(ORACLE_SQL[key])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in QUERIES[key](spark, SF_DIR).schema.fields:
        assert duck_types[f.name] == SPARK_TO_DUCKDB[f.dataType.simpleString()], f.name
