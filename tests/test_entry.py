"""Driver contract: entry smoke and every oracle against DuckDB at sf0.001."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}") + 0.0
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def canon(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["dataset_name", "record_id", "field_name", "issue_type", "issue_description", "severity"]
    assert df.count() >= 0


def test_every_query_has_an_oracle_or_is_documented():
    missing = set(E.queries()) - set(E.oracle_sql()) - set(E._training_data()[0])
    assert missing == set()
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - set(E._training_data()[0])))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(rel.columns, rel.fetchall())
