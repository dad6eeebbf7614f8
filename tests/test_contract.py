"""Contract queries against their SQL on the smallest driver tables.

``python -m contract.check`` runs all of them; here those that write many directories are left out.
"""

import os

import pytest

import __spark_entry__ as driver
from contract.check import difference, oracle_connection
from contract.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
SLOW = {"landing_hourly", "landing_scan", "pipeline_file", "pipeline_stream", "stream_replay",
        "stream_incremental", "silver_merge_upsert", "silver_merge_small_source", "compaction",
        "time_travel_count", "catalog_tables", "bronze_append_new", "landing_backfill",
        "landing_restart", "stream_admission", "silver_uniqueness_after_merge",
        "gold_table_status_summary", "gold_table_top_products", "compaction_rows", "stream_compaction",
        "stream_offset_admission", "silver_merge_bucketed"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables here")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys() and SLOW < QUERIES.keys()
    assert QUERIES.keys() <= driver.queries().keys() and ORACLES.keys() <= driver.oracle_sql().keys()


def test_entry_runs(spark):
    df = driver.entry(spark)
    assert df.columns == ["order_date", "currency", "revenue", "order_count", "avg_order_value"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query_equals_its_sql(spark, connection, name):
    df = driver.queries()[name](spark, SF_DIR)
    assert difference(df, driver.oracle_sql()[name], connection) is None
