"""Every query against its SQL on the smallest tables, and checks of their plans."""

import os

import duckdb
import pytest
from conftest import plan_of

import __spark_entry__ as entry
from tools.check import TABLES, canonical

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    df = entry.queries()[name](spark, SF)
    columns, got = canonical(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    cursor = db.execute(sql)
    wanted_columns, expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert columns == wanted_columns
    assert got == expected


NATIVE = [
    "clean_text", "markdown_sections", "chunk_documents", "noise_flags", "split_by_size", "text_stats_by_split",
    "feature_stats", "standardize_features", "split_shuffled", "global_row_index", "snapshot_diff", "chat_format",
]


@pytest.mark.parametrize("name", NATIVE)
def test_plans_stay_native_and_partitioned(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "Python" not in plan and "InPandas" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # No window runs over a whole table in one task.
    assert "Exchange SinglePartition" not in plan


def test_entry(spark):
    assert entry.entry(spark).count() == 4
