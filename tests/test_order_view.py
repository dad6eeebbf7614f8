"""The order view: each line moves once by part and once by order, in partitions that follow the input."""

import duckdb
import pytest
from pyspark.sql import functions as F

from contract import order_view as view
from contract import queries
from ingotflow.schemas import EVENT_COLUMNS


@pytest.fixture
def tables(spark, tmp_path):
    def save(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    save("lineitem", [(i % 40 if i % 9 else None, i % 7, i % 3, 1.0 + i % 5, 10.0 + i, "FO"[i % 2]) for i in range(200)],
         "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_linestatus string")
    lines = spark.read.parquet(f"{tmp_path}/lineitem.parquet")
    lines.withColumn("l_shipdate", F.expr("timestamp_ntz'1995-03-01' + make_interval(0, 0, 0, l_linenumber)")).coalesce(
        1).write.parquet(f"{tmp_path}/dated/lineitem.parquet")
    base = f"{tmp_path}/dated"
    for name, rows, schema in [
            ("orders", [(i, i % 11, "OPF"[i % 3]) for i in range(40)] + [(3, 5, "O")],
             "o_orderkey long, o_custkey long, o_orderstatus string"),
            ("customer", [(i, f"c{i}", i % 4, 5.0 - i) for i in range(10)],
             "c_custkey long, c_name string, c_nationkey int, c_acctbal double"),
            ("part", [(i, f"p{i}", "t") for i in range(6)] + [(2, "other", "t")],
             "p_partkey long, p_name string, p_type string"),
            ("nation", [(i, f"n{i}", i) for i in range(4)], "n_nationkey int, n_name string, n_regionkey int")]:
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/{name}.parquet")
    return base


@pytest.fixture
def shuffled_joins(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    spark.conf.set(names[0], "-1")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_rows_are_those_of_the_sql(spark, tables):
    columns = [*EVENT_COLUMNS, "line_status", "line_number", "order_key", "nation_key"]
    con = duckdb.connect()
    for name in ("lineitem", "orders", "customer", "part", "nation"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tables}/{name}.parquet/*.parquet'")
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({view.order_sql(columns, 'double')})").fetchall()
    got = view.order_view(spark, tables, columns, "double").withColumn(
        "order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))
    assert want and sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def moves(df, column):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and column in line]


def test_lines_move_at_most_twice(spark, tables, shuffled_joins):
    df = view.order_view(spark, tables)
    assert len(moves(df, "l_partkey#")) == 1 and len(moves(df, "l_orderkey#")) == 1
    orders = view.order_view(spark, tables, ["order_id", "currency"])  # no column of a part
    sides = orders._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression")
    assert "Join" in sides[1] and "o_custkey" not in sides[0]  # customers join the orders, not the lines


def test_messages_are_not_moved_again(spark, tables, shuffled_joins, monkeypatch):
    seen = []
    monkeypatch.setattr(queries, "_as_topic_rows", lambda df: seen.append(df) or df.select("order_id"))
    queries._publish(spark, tables, f"{tables}/topic")
    assert not moves(seen[0], "order_id#")


def test_partitions_follow_the_lines(spark, tables, shuffled_joins, monkeypatch):
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(view, "BYTES_PER_PARTITION", 100)
    view.order_view(spark, tables)
    assert int(spark.conf.get(setting)) > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_tasks_join_their_partitions_in_turn(spark, tables, shuffled_joins):
    df = view.order_view(spark, tables, tasks=3)
    assert len(moves(df, "l_orderkey#")) == 1 and df.rdd.getNumPartitions() == 3
    key = F.concat_ws("|", *EVENT_COLUMNS)
    assert sorted(df.select(key).collect()) == sorted(view.order_view(spark, tables).select(key).collect())


def test_arrivals_are_written_in_one_pass(spark, tables, base):
    rows = view.order_view(spark, tables, ["order_id", "line_status"]).selectExpr("order_id", queries.FIRST_OR_LATER)
    want = {n: sorted(rows.where(f"arrival = {n}").select("order_id").collect()) for n in (0, 1)}
    queries._stage_arrivals(rows, f"{base}/staged", 10)
    for folder, nested in (("landing", True), ("topic", False)):
        if folder == "topic":
            queries._stage_arrivals(rows, f"{base}/staged-topic")
        staged = f"{base}/staged" if nested else f"{base}/staged-topic"
        for n in (0, 1):
            queries._arrive(spark, staged, n, f"{base}/{folder}", nested)
            read = spark.read.schema("order_id string").option("recursiveFileLookup", "true").parquet(f"{base}/{folder}")
            assert sorted(read.collect()) == sorted(sum([want[k] for k in range(n + 1)], []))
    queries._arrive(spark, f"{base}/nothing", 0, f"{base}/empty", True)
    assert spark.read.schema("order_id string").parquet(f"{base}/empty").count() == 0
