import random
from datetime import date, datetime
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from test_operators import SCHEMA, T1, T2, brute_force, random_rows, record, rows

from contract.scratch import scratch_dir
from ingotflow import storage
from ingotflow.sinks.catalog import (
    create_databases,
    list_databases,
    register_path,
    register_silver,
)
from ingotflow.snapshots import NULL_VALUE, SnapshotTable
from ingotflow.sources.tables import read_named, read_path, silver_table


@pytest.fixture
def table(spark, base):
    return SnapshotTable(spark, f"{base}/table", "order_date")


def frame(spark, *records):
    return spark.createDataFrame([record(*r) for r in records], SCHEMA)


def files(table):
    return sum(p.files for found in table.snapshot().pieces.values() for p in found)


def test_existence_needs_a_column(spark, base, table):
    assert not table.exists() and table.versions() == []
    with pytest.raises(FileNotFoundError):
        table.read()
    storage.write_new_text(spark, f"{table.root}/snapshots/00000000.json",
                           '{"schema": {"type": "struct", "fields": []}, "pieces": {}, '
                           '"unique_key": null}')
    assert not table.exists()
    table.overwrite(frame(spark, ("A", T1, 1)))
    assert table.exists() and table.versions() == [0, 1]


def test_overwrite_replaces_schema_and_keeps_old_versions(spark, table):
    table.overwrite(frame(spark, ("A", T1, 1), ("B", None, 2)), unique_key="order_id")
    table.overwrite(frame(spark, ("C", T2, 3)).withColumn("more", F.lit("x")))
    assert rows(table.read(0), "order_id", "order_date", "v") == [
        ("A", T1.date(), 1), ("B", None, 2)]
    assert table.read().columns == ["order_id", "order_timestamp", "order_date", "v", "more"]
    assert table.snapshot(0).unique_key == "order_id" and table.snapshot().unique_key is None


def test_empty_table(spark, table):
    table.overwrite(frame(spark, ("A", T1, 1)).limit(0))
    assert table.exists() and table.read().count() == 0
    assert table.merge(frame(spark, ("A", T1, 1)), "order_id", "order_timestamp").inserted == 1
    assert rows(table.read(), "order_id", "v") == [("A", 1)]


def test_moved_row_leaves_no_copy_and_other_dates_are_not_rewritten(spark, table):
    table.overwrite(frame(spark, ("A", T1, 1), ("B", datetime(2024, 3, 1), 2),
                          ("C", datetime(2024, 4, 1), 3)))
    before = table.snapshot()
    result = table.merge(frame(spark, ("A", T2, 10), ("D", datetime(2024, 4, 1), 4)),
                         "order_id", "order_timestamp")
    assert tuple(result) == (1, 1, 1)
    after = table.snapshot()
    assert rows(table.read(), "order_id", "order_date", "v") == [
        ("A", T2.date(), 10), ("B", date(2024, 3, 1), 2), ("C", date(2024, 4, 1), 3),
        ("D", date(2024, 4, 1), 4)]
    assert "order_date=2024-01-01" not in after.pieces
    assert after.pieces["order_date=2024-03-01"] == before.pieces["order_date=2024-03-01"]
    # A date that only gains rows keeps its old files and gets new ones beside them.
    assert after.pieces["order_date=2024-04-01"][0] == before.pieces["order_date=2024-04-01"][0]
    assert table.read(0).count() == 3


@pytest.mark.parametrize("small", [False, True])
def test_merges_match_brute_force(spark, table, small):
    rng = random.Random(7)
    expected = random_rows(rng, 0)
    table.overwrite(spark.createDataFrame(expected, SCHEMA), unique_key="order_id")
    for start in (100, 200, 300):
        source = random_rows(rng, start)
        table.merge(spark.createDataFrame(source, SCHEMA), "order_id", "order_timestamp", small)
        expected = brute_force(expected, source)
        assert rows(table.read(), "*") == expected
        table.compact()
        assert rows(table.read(), "*") == expected
    assert f"order_date={NULL_VALUE}" in table.snapshot().pieces


def test_merge_of_nothing_new_keeps_the_files(spark, table):
    table.overwrite(frame(spark, ("A", T1, 1)))
    result = table.merge(frame(spark, ("A", T1, 2)), "order_id", "order_timestamp")
    assert tuple(result) == (1, 0, 0)
    assert table.snapshot(1).pieces == table.snapshot(0).pieces


def test_merge_refuses_two_updates_of_one_row(spark, table):
    table.overwrite(frame(spark, ("A", T1, 1)))
    twice = frame(spark, ("A", T2, 2), ("A", datetime(2024, 1, 3), 3))
    with pytest.raises(ValueError, match="unique"):
        table.merge(twice, "order_id", "order_timestamp")
    assert table.versions() == [0] and rows(table.read(), "v") == [(1,)]


def test_second_publisher_of_a_version_fails(spark, table):
    table.overwrite(frame(spark, ("A", T1, 1)))
    with pytest.raises(FileExistsError):
        table._publish(table.snapshot())


def test_append_and_compact(spark, table):
    for v in range(3):
        table.append(frame(spark, ("A", T1, v), ("B", T2, v)))
    before, expected = files(table), rows(table.read(), "*")
    table.compact()
    assert files(table) == 2 < before
    assert rows(table.read(), "*") == expected
    assert table.compact().version == table.versions()[-1] == 3  # nothing left to gain
    table.append(frame(spark, ("C", datetime(2024, 5, 1), 9)))
    kept = table.snapshot().pieces["order_date=2024-01-01"]
    table.compact()
    assert table.snapshot().pieces["order_date=2024-01-01"] == kept
    with pytest.raises(ValueError, match="differ"):
        table.append(frame(spark, ("A", T1, 1)).drop("v"))


def test_since_does_not_list_older_partitions(spark, table):
    table.overwrite(frame(spark, ("A", T1, 1), ("B", T2, 2), ("C", None, 3)))
    recent = table.read(since=T2.date())
    assert rows(recent, "order_id") == [("B",)]
    assert all("2024-01-02" in f for f in recent.inputFiles())


def test_partition_filter_prunes(spark, table):
    table.overwrite(frame(spark, ("A", T1, 1), ("B", T2, 2)))
    plan = table.read().filter(F.col("order_date") == T2.date())
    assert "PartitionFilters: [isnotnull(order_date" in plan._jdf.queryExecution().toString()
    assert rows(plan, "order_id") == [("B",)]


def test_catalog_names(spark, base):
    create_databases(spark, "t_silver", location=base)
    assert "t_silver" in {r[0] for r in list_databases(spark).collect()}
    silver = silver_table(spark, f"{base}/silver")
    register_silver(spark, silver.root, "t_silver.orders")  # nothing there yet
    assert not spark.catalog.tableExists("t_silver.orders")
    silver.overwrite(frame(spark, ("A", T1, 1), ("B", None, 2)))
    register_silver(spark, silver.root, "t_silver.orders")
    silver.merge(frame(spark, ("A", T2, 3)), "order_id", "order_timestamp")
    register_silver(spark, silver.root, "t_silver.orders")
    register_silver(spark, silver.root, "t_silver.orders")  # again: no change
    named = read_named(spark, "t_silver", "orders")
    assert named.columns == silver.read().columns
    assert rows(named, "order_id", "v") == [("A", 3), ("B", 2)]
    assert rows(spark.table("t_silver.orders_v0"), "order_id", "v") == [("A", 1), ("B", 2)]
    spark.sql("SELECT * FROM t_silver.orders").write.parquet(f"{base}/plain")
    assert read_path(spark, f"{base}/plain").count() == 2
    register_path(spark, "t_silver.plain", f"{base}/plain")
    assert spark.table("t_silver.plain").count() == 2
    spark.sql("DROP DATABASE t_silver CASCADE")
    assert silver.read().count() == 2


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    def session(master, **settings):
        return SimpleNamespace(sparkContext=SimpleNamespace(master=master),
                               conf=SimpleNamespace(get=lambda key, default: settings.get("dir")))

    shared = session("spark://host:7077", dir="hdfs:///shared/")
    assert scratch_dir(shared, "x").startswith("hdfs:///shared/x-")
    assert scratch_dir(shared, "x") != scratch_dir(shared, "x")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(session("spark://host:7077"), "x")
    assert scratch_dir(session("local[2]"), "x")


def test_large_partitions_are_compacted_without_a_shuffle(spark, table, monkeypatch):
    for v in range(6):
        table.append(frame(spark, *((f"{v}-{i}", T1, i) for i in range(50)), (f"{v}-z", None, 7)).repartition(4))
    before, expected = files(table), rows(table.read(), "*")
    monkeypatch.setattr(table, "_write", None)  # no partition may need the shared shuffle
    large = min(sum(p.bytes for p in found) for found in table.snapshot().pieces.values())
    table.compact(large // 5)
    assert files(table) < before and rows(table.read(), "*") == expected
    assert rows(table.read(table.versions()[-2]), "*") == expected
    assert f"order_date={NULL_VALUE}" in table.snapshot().pieces
