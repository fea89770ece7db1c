"""Registered queries against their SQL on the small tables.

A cross-section by default; all of them with ENTITYFRAME_ALL_QUERIES=1.
"""

import os

import pytest

import __spark_entry__ as registered

duckdb = pytest.importorskip("duckdb")
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SAMPLE = (
    "chunk_numbers", "filter_range", "filter_in_long", "descendants_many", "distinct_on", "agg_sum_empty", "agg_null_group",
    "dup_plan_last", "dangling_ref_counts", "encode_timestamp", "key_json", "missing_policies", "classify_patch",
    "upsert_result", "infer_mixed",
)
NAMES = sorted(registered.queries()) if os.environ.get("ENTITYFRAME_ALL_QUERIES") else SAMPLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES.split():
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, duck, name):
    df = registered.queries()[name](spark, SF)
    want = duck.execute(registered.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, want.fetchall())


def test_every_query_has_sql():
    for module in registered._MODULES:
        assert set(module.QUERIES) == set(module.SQL)


def test_entry(spark):
    assert registered.entry(spark).columns == ["user_id", "value_sum"]
