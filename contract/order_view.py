"""The driver's tables seen as order events, in Spark and as the same SQL text.

One row per ``lineitem`` row. ``order_id`` repeats, so dedup has work; customers without a positive
balance give negative amounts, so validation has work. Only the dimension tables that the asked
columns need are joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ingotflow.schemas import EVENT_COLUMNS
from ingotflow.storage import size_of

# column -> SQL shared by both engines; {text} is the engine's string type, {time} its event time.
EXPRESSIONS = {
    "order_id": "concat(l_orderkey, '-', l_linenumber)",
    "customer_id": "cast(o_custkey AS {text})",
    "customer_name": "c_name",
    "customer_email": "concat('customer', o_custkey, '@example.com')",
    "order_status": "CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'SHIPPED' "
                    "ELSE 'DELIVERED' END",
    "product_id": "cast(l_partkey AS {text})",
    "product_name": "p_name",
    "product_category": "p_type",
    "quantity": "cast(l_quantity AS int)",
    "unit_price": "l_extendedprice / l_quantity",
    "total_amount": "CASE WHEN c_acctbal > 0 THEN {amount} ELSE -{amount} END",
    "currency": "CASE c_nationkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'BRL' END",
    "order_timestamp": "{time}",
    "shipping_address_city": "concat(n_name, ' City')",
    "shipping_address_state": "concat('Region ', n_regionkey)",
    "shipping_address_country": "n_name",
    # Not event columns: what some queries split or position the rows by.
    "line_status": "l_linestatus",
    "line_number": "l_linenumber",
    "order_key": "l_orderkey",
    "nation_key": "c_nationkey",
}
PART_COLUMNS = {"product_name", "product_category"}
NATION_COLUMNS = {"shipping_address_city", "shipping_address_state", "shipping_address_country"}
# Exact sums need decimals; the event itself carries doubles.
TEXT = {"spark": "string", "duckdb": "varchar"}
AMOUNTS = {"decimal": "cast(l_extendedprice AS decimal(18, 2))", "double": "l_extendedprice"}
# A ship day becomes 24 minutes from 2024 on: the order of times is kept, every row has a time of
# day, and a date holds sixty ship days' rows, as dates do in a busy table.
TIMES = {
    "spark": "timestampadd(SECOND, 1440 * datediff(l_shipdate, DATE'1995-01-01'), "
             "TIMESTAMP'2024-01-01')",
    "duckdb": "TIMESTAMP '2024-01-01' + "
              "to_seconds(1440 * datediff('day', TIMESTAMP '1995-01-01', l_shipdate))",
}
SPLIT_BYTES = 128 * 1024 * 1024
# Parquet bytes of lines for each partition that a shuffle begins with.
BYTES_PER_PARTITION = 4 * 1024 * 1024
# Rows of one order_id and time differ in nothing that these three columns do not decide.
TIES = ["product_id", "quantity", "total_amount"]
JOINS = [
    ("orders", "l_orderkey", "o_orderkey"),
    ("customer", "o_custkey", "c_custkey"),
    ("part", "l_partkey", "p_partkey"),
    ("nation", "c_nationkey", "n_nationkey"),
]


def _joins(columns: Sequence[str]) -> list[tuple[str, str, str]]:
    skipped = set()
    if not PART_COLUMNS & set(columns):
        skipped.add("part")
    if not NATION_COLUMNS & set(columns):
        skipped.add("nation")
    return [join for join in JOINS if join[0] not in skipped]


def _projection(columns: Sequence[str], engine: str, amount: str) -> list[str]:
    fill = {"text": TEXT[engine], "time": TIMES[engine], "amount": AMOUNTS[amount]}
    return [f"{EXPRESSIONS[c].format(**fill)} AS {c}" for c in columns]


def order_view(spark: SparkSession, sf_dir: str, columns: Sequence[str] = EVENT_COLUMNS,
               amount: str = "decimal", tasks: int | None = None) -> DataFrame:
    """``tasks`` leaves the rows to so many tasks, each of which joins partitions one after the other."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    partitions = _deal_by_size(spark, f"{sf_dir}/lineitem.parquet")
    joins = {name: (left, right) for name, left, right in _joins(columns)}

    def joined(df: DataFrame, *names: str) -> DataFrame:
        for name in names:
            if name in joins:
                left, right = joins[name]
                df = df.join(table(spark, sf_dir, name), F.col(left) == F.col(right))
        return df

    # lines move once by part, while they are narrow, and once by order; customers come with the orders
    dated = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    lines = _spread(joined(dated, "part"), tasks and -(-partitions // tasks) * tasks)
    orders = joined(table(spark, sf_dir, "orders"), "customer", "nation")
    left, right = joins["orders"]
    rows = lines.join(orders, F.col(left) == F.col(right)).selectExpr(*_projection(columns, "spark", amount))
    return rows.coalesce(tasks) if tasks else rows


def _spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Spread the fixture's rows over the tasks, at any size: a row group is never split, so the driver's
    single files would be one task each."""
    return df.repartition(partitions, "l_orderkey") if partitions else df.repartition("l_orderkey")


def _deal_by_size(spark: SparkSession, path: str) -> int:
    """Let shuffles begin with partitions in proportion to the lines, which adaptive execution joins where they
    are small; a fixed number of them would grow with the input, and the memory of their tasks too."""
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(at_least, -(-size_of(spark, path) // BYTES_PER_PARTITION))
    partitions = max(wanted, int(spark.conf.get(setting, None) or 0))
    spark.conf.set(setting, partitions)
    return partitions


def order_sql(columns: Sequence[str] = EVENT_COLUMNS, amount: str = "decimal") -> str:
    joins = " ".join(f"JOIN {name} ON {left} = {right}" for name, left, right in _joins(columns))
    return f"SELECT {', '.join(_projection(columns, 'duckdb', amount))} FROM lineitem {joins}"


def silver_sql(columns: Sequence[str], amount: str = "decimal") -> str:
    """Validated, deduplicated order rows with their date."""
    needed = [c for c in dict.fromkeys([*columns, "order_id", "order_timestamp", *TIES])
              if c != "order_date"]
    return latest_sql(f"SELECT *, cast(order_timestamp AS date) AS order_date "
                      f"FROM ({order_sql(needed, amount)}) "
                      f"WHERE total_amount > 0 AND quantity > 0")


def latest_sql(rows: str) -> str:
    order = ", ".join(["order_timestamp DESC", *[f"{c} DESC" for c in TIES]])
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY order_id ORDER BY {order}) AS rn FROM ({rows})) WHERE rn = 1")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
