"""Bucketed keys, registration by content, gold behind a view, offsets a batch, the default merge route."""

import random

import pytest
from pyspark.sql import functions as F
from test_operators import SCHEMA, T1, T2, brute_force, random_rows, rows
from test_pipelines import messages
from test_snapshots import frame

from ingotflow import storage
from ingotflow.keys import KeyTable
from ingotflow.operators.upsert import changed_rows
from ingotflow.plans import cli, jobs
from ingotflow.sinks.catalog import create_databases, register_silver
from ingotflow.sinks.gold import build_table
from ingotflow.snapshots import SnapshotTable
from ingotflow.sources.tables import silver_table
from ingotflow.sources.topic import read_topic_files, write_topic_files
from ingotflow.streaming import sinks

KEY, TIME = "order_id", "order_timestamp"


@pytest.fixture
def table(spark, base):
    return SnapshotTable(spark, f"{base}/table", "order_date")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_merge_moves_only_the_source(spark, table):
    rng = random.Random(3)
    first = random_rows(rng, 0)
    table.overwrite(spark.createDataFrame(first, SCHEMA), unique_key=KEY)
    table.merge(spark.createDataFrame(random_rows(rng, 100), SCHEMA), KEY, TIME, key_buckets=8)
    snapshot = table.snapshot()
    known = KeyTable(spark, table.root, snapshot.schema, KEY, TIME, "order_date").read(snapshot.keys)
    assert "Exchange" not in plan_of(known) and "Bucketed: true" in plan_of(known)
    source = spark.createDataFrame(random_rows(rng, 200), SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(changed_rows(known, source, "order_date", KEY, TIME, buckets=8))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    join_left, join_right = plan.split("FileScan")[0], plan.split("FileScan")[1]
    assert "Exchange" in join_left + join_right  # the source's


def test_bucketed_merges_match_brute_force(spark, table):
    rng = random.Random(11)
    expected = random_rows(rng, 0)
    table.overwrite(spark.createDataFrame(expected, SCHEMA), unique_key=KEY)
    for n, start in enumerate((100, 200, 300, 400)):
        source = random_rows(rng, start)
        table.merge(spark.createDataFrame(source, SCHEMA), KEY, TIME, n == 2, key_buckets=4 if n == 0 else None)
        expected = brute_force(expected, source)
        assert rows(table.read(), "*") == expected
    # NULL keys are inserted again each time, which leaves the named ones unique
    keys = table.snapshot().keys
    assert keys.buckets == 4 and len(keys.additions) == 5


def test_keys_are_rewritten_and_dropped(spark, table, monkeypatch):
    monkeypatch.setattr("ingotflow.snapshots.ADDITIONS", 3)
    table.overwrite(frame(spark, ("A", T1, 1)), unique_key=KEY)
    tables = []
    for v in range(6):
        source = frame(spark, (f"K{v}", T1, v), ("A", T1.replace(year=2025, month=v + 1), v))
        assert tuple(table.merge(source, KEY, TIME, key_buckets=2))[1:] == (1, 1)
        tables.append(table.snapshot().keys.table)
    assert len(set(tables)) > 1 and len(table.snapshot().keys.additions) <= 3
    assert [n for n in storage.list_names(spark, table.root) if n.startswith("keys_")] == [tables[-1]]
    assert rows(table.read(), "order_id", "v") == [("A", 5), *((f"K{v}", v) for v in range(6))]
    table.append(frame(spark, ("A", T2, 9)))
    assert table.snapshot().keys is None


def test_additions_of_a_failed_merge_are_not_read(spark, table, monkeypatch):
    table.overwrite(frame(spark, ("A", T1, 1)), unique_key=KEY)
    table.merge(frame(spark, ("B", T1, 1)), KEY, TIME, key_buckets=2)

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(SnapshotTable, "_publish", lost)
    with pytest.raises(RuntimeError):
        table.merge(frame(spark, ("A", T2, 2), ("C", T1, 2)), KEY, TIME)
    monkeypatch.undo()
    assert tuple(table.merge(frame(spark, ("A", T2, 3), ("C", T1, 3)), KEY, TIME))[1:] == (1, 1)
    assert rows(table.read(), "order_id", "v") == [("A", 3), ("B", 1), ("C", 3)]


def test_no_keys_for_a_table_that_is_not_unique(spark, table):
    table.overwrite(frame(spark, ("A", T1, 1), ("A", T1, 2)))
    table.merge(frame(spark, ("B", T1, 1)), KEY, TIME, key_buckets=2)
    assert table.snapshot().keys is None
    other = SnapshotTable(spark, f"{table.root}-2", "order_date")
    other.overwrite(frame(spark, ("A", T1, 1)), unique_key=KEY)
    other.merge(frame(spark, ("B", T1, 1)), KEY, TIME, key_buckets=2)
    name = other.snapshot().keys.table
    other.merge(frame(spark, ("C", T1, 1), ("C", T1, 2)), KEY, TIME)
    assert other.snapshot().keys is None and not spark.catalog.tableExists(name)


def test_job_keeps_keys(spark, base, events):
    for key in "AB":
        events({"order_id": key}).write.mode("append").parquet(f"{base}/landing")
        jobs.landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze")
        jobs.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", key_buckets=2)
    silver = silver_table(spark, f"{base}/silver")
    assert silver.snapshot().keys.buckets == 2 and rows(silver.read(), "order_id") == [("A",), ("B",)]
    args = cli.parser().parse_args(["bronze-to-silver", "--bronze", "b", "--silver", "s", "--key-buckets", "64"])
    assert args.key_buckets == 64


def test_a_rebuilt_table_is_registered_anew(spark, base):
    create_databases(spark, "m_silver", location=base)
    silver = silver_table(spark, f"{base}/silver")
    silver.overwrite(frame(spark, ("A", T1, 1)))
    silver.append(frame(spark, ("B", T1, 2)))
    for version in (0, 1):
        register_silver(spark, silver.root, "m_silver.orders", version)
    storage.delete_tree(spark, silver.root)
    silver.overwrite(frame(spark, *((f"N{v}", T2, v) for v in range(7))))
    register_silver(spark, silver.root, "m_silver.orders")
    assert rows(spark.table("m_silver.orders"), "v") == [(v,) for v in range(7)]
    assert {t.name for t in spark.catalog.listTables("m_silver")} == {"orders", "orders_v0"}
    spark.sql("DROP DATABASE m_silver CASCADE")


def test_gold_stays_readable_when_its_columns_change(spark, base, monkeypatch):
    create_databases(spark, "m_gold", location=base)
    spark.range(4).write.option("path", f"{base}/gold/t/refresh-old").saveAsTable("m_gold.t")  # of an earlier release
    build_table(spark.range(5), "m_gold", "t", f"{base}/gold/t")
    assert spark.table("m_gold.t").count() == 5
    sql = type(spark).sql

    def failing(self, text, *args, **kwargs):
        if text.startswith("CREATE"):
            raise RuntimeError("catalog lost")
        return sql(self, text, *args, **kwargs)

    for statement in ("CREATE TABLE", "CREATE OR REPLACE VIEW"):
        monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: failing(self, text, *a, **k)
                            if text.startswith(statement) else sql(self, text, *a, **k))
        with pytest.raises(RuntimeError, match="catalog lost"):
            build_table(spark.range(3).withColumn("x", F.lit("y")), "m_gold", "t", f"{base}/gold/t")
        monkeypatch.undo()
        assert spark.table("m_gold.t").columns == ["id"] and spark.table("m_gold.t").count() == 5
    for n in (2, 3, 6):
        build_table(spark.range(n).withColumn("x", F.lit("y")), "m_gold", "t", f"{base}/gold/t")
        assert spark.table("m_gold.t").columns == ["id", "x"] and spark.table("m_gold.t").count() == n
    assert len(storage.list_names(spark, f"{base}/gold/t")) == 2
    assert len(spark.catalog.listTables("m_gold")) == 3
    spark.sql("DROP DATABASE m_gold CASCADE")


def test_batches_hold_at_most_so_many_offsets(spark, base, events):
    df = messages(events(*({"order_id": str(i)} for i in range(95))).coalesce(1))
    write_topic_files(df, f"{base}/topic", 10)
    read = []
    stream = read_topic_files(spark, f"{base}/topic", max_offsets=25, offsets_per_file=10)
    sinks.run_to_end(stream.writeStream.foreachBatch(lambda batch, n: read.append([r.offset for r in batch.collect()]))
                     .trigger(availableNow=True).option("checkpointLocation", f"{base}/c").start())
    assert max(map(len, read)) <= 25 and len(read) >= 5 and sorted(sum(read, [])) == list(range(95))
    for wrong in ({"max_offsets": 5, "offsets_per_file": 10}, {"max_offsets": 5},
                  {"max_offsets": 50, "offsets_per_file": 10, "max_files": 1}):
        with pytest.raises(ValueError):
            read_topic_files(spark, f"{base}/topic", **wrong)


def test_a_silver_table_with_merge_is_merged_into_by_default(spark, base, events, monkeypatch):
    """Dispatch only: no format here supports MERGE."""
    events({"order_id": "A"}).write.parquet(f"{base}/landing")
    jobs.landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze")
    create_databases(spark, "m_plain", location=base)
    spark.range(1).write.saveAsTable("m_plain.t")
    assert not jobs.has_merge(spark, "m_plain.t") and not jobs.has_merge(spark, "m_plain.none")
    monkeypatch.setattr(jobs, "MERGE_FORMATS", {"parquet"})
    monkeypatch.setattr(jobs, "SILVER_TABLE", "m_plain.t")
    said = []
    monkeypatch.setattr(jobs, "merge_into", lambda rows, name: said.append(name))
    assert jobs.bronze_to_silver(spark, f"{base}/bronze", "unused").merge is None and said == ["m_plain.t"]
    spark.sql("DROP DATABASE m_plain CASCADE")
