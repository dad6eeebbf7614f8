"""One query per operator, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contract.framing import as_messages
from contract.order_view import (
    SPLIT_BYTES,
    TIES,
    latest_sql,
    order_sql,
    order_view,
    silver_sql,
    table,
)
from contract.scratch import scratch_dir
from ingotflow.functions.columns import HOUR_BUCKET
from ingotflow.functions.framing import strip_header
from ingotflow.operators import gold, profiles, quality
from ingotflow.operators.dedup import latest_per_key
from ingotflow.operators.enrich import (
    add_file_metadata,
    add_stream_metadata,
    cast_and_derive,
    parse_messages,
    select_file_columns,
    select_stream_columns,
    with_line_total,
)
from ingotflow.operators.upsert import merge_latest
from ingotflow.plans import jobs
from ingotflow.schemas import (
    BRONZE_STREAM,
    EVENT,
    EVENT_COLUMNS,
    ORDER_SCHEMA_JSON,
    SILVER_BASE_COLUMNS,
    load_record_schema,
)
from ingotflow.session import setting
from ingotflow.sinks.bronze import append_bronze, compact_bronze
from ingotflow.sinks.catalog import create_databases, list_databases, register_silver
from ingotflow.snapshots import MAX_OPEN_FILES, OPEN_FILES
from ingotflow.sources.landing import read_landing
from ingotflow.sources.tables import (
    bronze_table,
    read_bronze_file,
    read_bronze_stream,
    read_named,
    read_path,
    silver_table,
)
from ingotflow.sources.topic import read_topic_files, write_topic_files
from ingotflow.storage import delete_tree, list_names, make_dir, move, write_new_text
from ingotflow.streaming.sinks import FLUSH_ROWS, run_to_end

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SILVER_DB, GOLD_DB = "contract_silver", "contract_gold"
KEYS = ["order_id", "order_timestamp", *TIES]
# Two arrivals: a condition on the line status, and its complement for whatever else there is.
BATCHES = ("coalesce(line_status = 'F', false)", "coalesce(line_status <> 'F', true)")
ARRIVAL = "arrival"
FIRST_OR_LATER = f"CASE WHEN {BATCHES[0]} THEN 0 ELSE 1 END AS {ARRIVAL}"
POSITION = ["_kafka_partition", "_kafka_offset", "_kafka_timestamp"]


def query(sql: str) -> Callable[[Query], Query]:
    """Register a function under its own name, with doubles and zone-free times in its result."""
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = lambda spark, sf_dir: _plain(function(spark, sf_dir))
        ORACLES[function.__name__] = sql
        return function
    return register


def _plain(df: DataFrame) -> DataFrame:
    def shown(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return column.cast("timestamp_ntz").alias(field.name)
        return column
    return df.select(*[shown(f) for f in df.schema])


def _names(columns: list[str], *doubles: str) -> str:
    return ", ".join(f"cast({c} AS double) AS {c}" if c in doubles else c for c in columns)


def _ties() -> list:
    return [F.col(c).desc() for c in TIES]


def _silver(spark: SparkSession, sf_dir: str, columns: list[str],
            rows: DataFrame | None = None) -> DataFrame:
    """Cast, validate and dedup over the order view."""
    if rows is None:
        rows = order_view(spark, sf_dir, list(dict.fromkeys([*columns, *KEYS])))
    return latest_per_key(quality.validate(cast_and_derive(rows)), _ties())


# -- gold ------------------------------------------------------------------------------------

DAILY_SQL = """
SELECT order_date, currency, cast(sum(total_amount) AS double) AS revenue,
       count(DISTINCT order_id) AS order_count,
       cast(sum(total_amount) AS double) / count(total_amount) AS avg_order_value
FROM ({rows}) GROUP BY order_date, currency ORDER BY order_date DESC, revenue DESC"""


@query(DAILY_SQL.format(rows=silver_sql(["currency"])))
def gold_daily_revenue(spark, sf_dir):
    return gold.daily_revenue(_silver(spark, sf_dir, ["currency"]))


@query(DAILY_SQL.format(rows=silver_sql(["currency"])))
def gold_daily_revenue_unique_keys(spark, sf_dir):
    return gold.daily_revenue(_silver(spark, sf_dir, ["currency"]), keys_are_unique=True)


@query(f"""
SELECT order_date, order_status, count(*) AS order_count,
       cast(sum(total_amount) AS double) AS total_revenue
FROM ({silver_sql(["order_status"])}) GROUP BY order_date, order_status""")
def gold_order_status_summary(spark, sf_dir):
    return gold.order_status_summary(_silver(spark, sf_dir, ["order_status"]))


def _positions(df: DataFrame, *columns: str) -> DataFrame:
    """The declared order as a column; these frames have a row per date and few values."""
    by_row = Window.orderBy(F.monotonically_increasing_id())
    return df.select(F.row_number().over(by_row).alias("position"), *columns)


def _positions_sql(rows: str, order: str, *columns: str) -> str:
    return (f"SELECT cast(row_number() OVER (ORDER BY {order}) AS integer) AS position, "
            f"{', '.join(columns)} FROM ({rows})")


@query(_positions_sql(DAILY_SQL.format(rows=silver_sql(["currency"])), "order_date DESC, revenue DESC",
                      "order_date", "revenue"))
def daily_revenue_order(spark, sf_dir):
    return _positions(gold.daily_revenue(_silver(spark, sf_dir, ["currency"])), "order_date", "revenue")


@query(_positions_sql(f"SELECT order_date, order_status, count(*) AS order_count FROM "
                      f"({silver_sql(['order_status'])}) GROUP BY order_date, order_status",
                      "order_date DESC, order_count DESC", "order_date", "order_count"))
def status_summary_order(spark, sf_dir):
    return _positions(gold.order_status_summary(_silver(spark, sf_dir, ["order_status"])),
                      "order_date", "order_count")


@query(_positions_sql(f"SELECT DISTINCT order_date, currency FROM ({silver_sql(['currency'])})",
                      "order_date DESC", "order_date"))
def revenue_by_currency_order(spark, sf_dir):
    return _positions(profiles.revenue_by_currency(_silver(spark, sf_dir, ["currency"])), "order_date")


PRODUCTS = ["product_id", "product_name", "product_category"]
TOP_SQL = f"""
SELECT product_id, product_name, product_category,
       cast(sum(total_amount) AS double) AS revenue,
       cast(sum(quantity) AS bigint) AS units_sold, count(order_id) AS order_count
FROM ({silver_sql(PRODUCTS)}) GROUP BY product_id, product_name, product_category"""


@query(TOP_SQL)
def gold_top_products(spark, sf_dir):
    return gold.top_products(_silver(spark, sf_dir, PRODUCTS))


@query(f"SELECT count(*) AS row_count, round(sum(revenue), 2) AS revenue, true AS in_order FROM ({TOP_SQL})")
def top_products_order(spark, sf_dir):
    """Whether no product stands behind one of less revenue, in its partition or in the next one."""
    top = gold.top_products(_silver(spark, sf_dir, PRODUCTS)).select(
        "revenue", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part"))
    in_part = Window.partitionBy("part").orderBy("at")
    falls = F.coalesce(F.lag("revenue").over(in_part) >= F.col("revenue"), F.lit(True))
    parts = top.withColumn("falls", falls).groupBy("part").agg(
        F.count("*").alias("rows"), F.sum("revenue").alias("sum"), F.every("falls").alias("falls"),
        F.max("revenue").alias("highest"), F.min("revenue").alias("lowest"))
    next_falls = F.coalesce(F.lag("lowest").over(Window.orderBy("part")) >= F.col("highest"), F.lit(True))
    return parts.withColumn("next", next_falls).agg(  # one row per partition
        F.sum("rows").alias("row_count"), F.round(F.sum("sum"), 2).alias("revenue"),
        F.every(F.col("falls") & F.col("next")).alias("in_order"))


# -- silver transforms -----------------------------------------------------------------------

@query(f"SELECT order_id, order_timestamp, cast(order_timestamp AS date) AS order_date "
       f"FROM ({order_sql(['order_id', 'order_timestamp'])})")
def silver_cast_derive(spark, sf_dir):
    orders = order_view(spark, sf_dir, ["order_id", "order_timestamp"])
    millis = F.unix_millis(F.col("order_timestamp"))
    return cast_and_derive(orders.withColumn("order_timestamp", millis))


@query(f"SELECT {_names(KEYS, 'total_amount')} FROM ({order_sql(KEYS)}) "
       f"WHERE total_amount > 0 AND quantity > 0")
def silver_validate(spark, sf_dir):
    return quality.validate(order_view(spark, sf_dir, KEYS))


@query(f"""
SELECT count(*) AS rows_before,
       count(*) FILTER (WHERE total_amount > 0 AND quantity > 0) AS rows_after,
       count(*) - count(*) FILTER (WHERE total_amount > 0 AND quantity > 0) AS rows_dropped
FROM ({order_sql(['total_amount', 'quantity'])})""")
def validate_counts(spark, sf_dir):
    return quality.validity_counts(order_view(spark, sf_dir, ["total_amount", "quantity"]))


@query(f"SELECT {_names(KEYS, 'total_amount')} FROM ({silver_sql(KEYS)})")
def silver_dedup_latest(spark, sf_dir):
    return _silver(spark, sf_dir, KEYS).select(*KEYS)


@query(f"""
SELECT count(*) AS rows_before, count(DISTINCT order_id) AS rows_after,
       count(*) - count(DISTINCT order_id) AS rows_removed
FROM ({order_sql(['order_id', 'total_amount', 'quantity'])})
WHERE total_amount > 0 AND quantity > 0""")
def dedup_counts(spark, sf_dir):
    rows = order_view(spark, sf_dir, ["order_id", "total_amount", "quantity"])
    return quality.dedup_counts(quality.validate(rows))


DOMAIN = ["order_status", "currency", "nation_key"]


@query(f"""
SELECT count(*) AS rows_checked,
       count(*) FILTER (WHERE order_status = 'SHIPPED') AS bad_status,
       count(*) FILTER (WHERE nation_key % 4 = 3) AS bad_currency
FROM ({order_sql(DOMAIN)})""")
def domain_check(spark, sf_dir):
    orders = order_view(spark, sf_dir, DOMAIN)
    foreign = orders.withColumns({
        "order_status": F.when(F.col("order_status") != "SHIPPED", F.col("order_status")),
        "currency": F.when(F.col("nation_key") % 4 == 3, "GBP").otherwise(F.col("currency"))})
    return quality.domain_violations(foreign)


LINE = ["order_id", "order_timestamp", "quantity", "unit_price"]


@query(f"SELECT order_id, order_timestamp, quantity, unit_price, "
       f"round(quantity * unit_price, 2) AS total_amount FROM ({order_sql(LINE)})")
def line_total(spark, sf_dir):
    return with_line_total(order_view(spark, sf_dir, LINE))


FIXED = [c for c in SILVER_BASE_COLUMNS if c != "_ingested_at"]


@query(f"SELECT {_names(FIXED, 'total_amount')}, true AS stamped FROM ({silver_sql(FIXED)})")
def silver_columns_file(spark, sf_dir):
    landing = _landed(spark, sf_dir, amount="decimal")
    bronze = add_file_metadata(
        read_landing(spark, landing, _decimal_event()), "one-batch")
    rows = select_file_columns(_silver(spark, sf_dir, [], bronze))
    stamped = (F.col("_ingested_at").isNotNull() & F.col("_source_file").endswith(".parquet")
               & (F.col("_batch_id") == "one-batch"))
    return rows.select(*FIXED, stamped.alias("stamped"))


STREAMED = [*EVENT_COLUMNS, "line_number", "order_key"]
POSITIONS_SQL = ("line_number AS _kafka_partition, order_key AS _kafka_offset, "
                 "order_timestamp AS _kafka_timestamp")


@query(f"SELECT {', '.join(FIXED)}, {POSITIONS_SQL} FROM ({silver_sql(STREAMED, 'double')})")
def silver_columns_stream(spark, sf_dir):
    bronze = add_stream_metadata(parse_messages(_messages(spark, sf_dir)))
    rows = select_stream_columns(_silver(spark, sf_dir, [], bronze))
    return rows.select(*FIXED, *POSITION)


# The silver columns in their order.
FILE_ORDER = ("order_id,customer_id,customer_name,customer_email,order_status,product_id,product_name,"
              "product_category,quantity,unit_price,total_amount,currency,order_timestamp,order_date,"
              "shipping_address_city,shipping_address_state,shipping_address_country,_ingested_at,"
              "_source_file,_batch_id")
STREAM_ORDER = ("order_id,customer_id,customer_name,customer_email,order_status,product_id,product_name,"
                "product_category,quantity,unit_price,total_amount,currency,order_timestamp,order_date,"
                "shipping_address_city,shipping_address_state,shipping_address_country,_ingested_at,"
                "_kafka_partition,_kafka_offset,_kafka_timestamp")


@query(f"SELECT '{FILE_ORDER}' AS file_columns, '{STREAM_ORDER}' AS stream_columns, "
       f"count(*) AS row_count FROM lineitem")
def silver_column_order(spark, sf_dir):
    rows = cast_and_derive(order_view(spark, sf_dir))
    stamped = rows.select("*", *(F.lit(None).alias(c) for c in (
        *POSITION, "_batch_id", "_source_file", "_ingested_at")))
    filed, streamed = select_file_columns(stamped), select_stream_columns(stamped)
    return rows.agg(F.count("*").alias("row_count")).select(
        F.lit(",".join(filed.columns)).alias("file_columns"),
        F.lit(",".join(streamed.columns)).alias("stream_columns"), "row_count")


# -- snapshots and upsert --------------------------------------------------------------------

SPLIT = [*KEYS, "currency", "line_status"]
SILVER_OUT = [*KEYS, "currency", "order_date"]


def _batch(spark: SparkSession, sf_dir: str, condition: str) -> DataFrame:
    rows = order_view(spark, sf_dir, SPLIT).filter(condition)
    return _silver(spark, sf_dir, [], rows.drop("line_status"))


def _batch_sql(condition: str) -> str:
    return latest_sql(f"SELECT *, cast(order_timestamp AS date) AS order_date "
                      f"FROM ({order_sql(SPLIT)}) WHERE {condition} "
                      f"AND total_amount > 0 AND quantity > 0")


def _merged_sql(columns: list[str]) -> str:
    picked = ", ".join(
        f"CASE WHEN t.order_id IS NULL OR s.order_timestamp > t.order_timestamp "
        f"THEN s.{c} ELSE t.{c} END AS {c}" for c in columns)
    return (f"SELECT {picked} FROM ({_batch_sql(BATCHES[0])}) t FULL OUTER JOIN "
            f"({_batch_sql(BATCHES[1])}) s ON t.order_id = s.order_id")


def _two_batches(spark: SparkSession, sf_dir: str, source_is_small: bool):
    silver = silver_table(spark, scratch_dir(spark, "silver"))
    silver.overwrite(_batch(spark, sf_dir, BATCHES[0]), unique_key="order_id")
    silver.merge(_batch(spark, sf_dir, BATCHES[1]), "order_id", "order_timestamp",
                 source_is_small)
    return silver


@query(f"SELECT {_names(SILVER_OUT, 'total_amount')}, true AS table_exists "
       f"FROM ({silver_sql(['currency'])})")
def silver_first_write(spark, sf_dir):
    silver = silver_table(spark, scratch_dir(spark, "silver"))
    silver.overwrite(_silver(spark, sf_dir, ["currency"]).select(*SILVER_OUT),
                     unique_key="order_id")
    return silver.read().withColumn("table_exists", F.lit(silver.exists()))


MERGED_SQL = f"SELECT {_names(SILVER_OUT, 'total_amount')} FROM ({_merged_sql(SILVER_OUT)})"


@query(MERGED_SQL)
def silver_merge_upsert(spark, sf_dir):
    return _two_batches(spark, sf_dir, source_is_small=False).read().select(*SILVER_OUT)


@query(MERGED_SQL)
def silver_merge_small_source(spark, sf_dir):
    return _two_batches(spark, sf_dir, source_is_small=True).read().select(*SILVER_OUT)


@query(MERGED_SQL)
def silver_merge_bucketed(spark, sf_dir):
    """The second arrival in two halves, merged over bucketed keys, then once more."""
    silver = silver_table(spark, scratch_dir(spark, "silver"))
    silver.overwrite(_batch(spark, sf_dir, BATCHES[0]), unique_key="order_id")
    second = _batch(spark, sf_dir, BATCHES[1])
    half = F.pmod(F.xxhash64("order_id"), F.lit(2)) == 0
    for rows, buckets in ((second.filter(half), 8), (second.filter(~half), None), (second, None)):
        silver.merge(rows, "order_id", "order_timestamp", key_buckets=buckets)
    return silver.read().select(*SILVER_OUT)


@query(MERGED_SQL)
def silver_merge_join(spark, sf_dir):
    first, second = (_batch(spark, sf_dir, condition) for condition in BATCHES)
    return merge_latest(first, second).select(*SILVER_OUT)


def _events_sql(condition: str) -> str:
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT user_id, ts, event_id, value, row_number() OVER "
            f"(PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events "
            f"WHERE {condition}) WHERE rn = 1")


@query(f"""
SELECT coalesce(t.user_id, s.user_id) AS user_id,
       CASE WHEN t.user_id IS NULL OR s.ts > t.ts THEN s.ts ELSE t.ts END AS ts,
       CASE WHEN t.user_id IS NULL OR s.ts > t.ts THEN s.event_id ELSE t.event_id END AS event_id,
       CASE WHEN t.user_id IS NULL OR s.ts > t.ts THEN s.value ELSE t.value END AS value
FROM ({_events_sql("event_type IN ('click', 'view')")}) t
FULL OUTER JOIN ({_events_sql("event_type NOT IN ('click', 'view')")}) s
ON t.user_id = s.user_id""")
def merge_keeps_newer(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    browsing = F.col("event_type").isin("click", "view")

    def latest(rows: DataFrame) -> DataFrame:
        return latest_per_key(rows.select("user_id", "ts", "event_id", "value"),
                              [F.col("event_id").desc()], "user_id", "ts")

    return merge_latest(latest(events.filter(browsing)), latest(events.filter(~browsing)),
                        "user_id", "ts")


@query(f"SELECT 0 AS version, count(*) AS row_count FROM ({_batch_sql(BATCHES[0])}) UNION ALL "
       f"SELECT 1, count(*) FROM ({_merged_sql(['order_id'])})")
def time_travel_count(spark, sf_dir):
    silver = _two_batches(spark, sf_dir, source_is_small=False)
    counts = [profiles.row_count(silver.read(version)).select(F.lit(version).alias("version"), "*")
              for version in silver.versions()]
    return counts[0].unionByName(counts[1])


@query(f"SELECT count(*) AS row_count, count(DISTINCT order_id) AS distinct_keys, true AS marked "
       f"FROM ({_merged_sql(['order_id'])})")
def silver_uniqueness_after_merge(spark, sf_dir):
    silver = _two_batches(spark, sf_dir, source_is_small=False)
    marked = silver.snapshot().unique_key == "order_id"
    return profiles.uniqueness(silver.read()).withColumn("marked", F.lit(marked))


ADVISORY_BYTES = 256 * 1024


@query(f"SELECT order_date, count(*) AS row_count, true AS well_sized "
       f"FROM ({silver_sql(['currency'])}) GROUP BY order_date")
def sized_write(spark, sf_dir):
    """Files near the advisory size: no file far above it, and of several none far below on average."""
    silver = silver_table(spark, scratch_dir(spark, "silver"))
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ADVISORY_BYTES)
    try:
        silver.overwrite(_silver(spark, sf_dir, ["currency"]).select(*SILVER_OUT))
    finally:
        spark.conf.set(setting, before)
    file = F.col("_metadata")
    paths = silver.read().inputFiles()
    files = spark.read.option("basePath", f"{silver.root}/data").parquet(*paths).groupBy(
        "order_date", file["file_path"], file["file_size"].alias("bytes")).agg(F.count("*").alias("rows"))
    # Parquet is smaller than what is shuffled, by up to some sixteen times here
    fits = (F.max("bytes") <= 2 * ADVISORY_BYTES) & (
        (F.count("*") == 1) | (F.avg("bytes") >= ADVISORY_BYTES / 32))
    return files.groupBy("order_date").agg(F.sum("rows").alias("row_count"), fits.alias("well_sized"))


# -- bronze, batch ---------------------------------------------------------------------------

def _decimal_event() -> T.StructType:
    return T.StructType([T.StructField(f.name, T.DecimalType(18, 2))
                         if f.name == "total_amount" else f for f in EVENT])


def _landed(spark: SparkSession, sf_dir: str, amount: str = "double") -> str:
    path = scratch_dir(spark, "landing")
    _land(order_view(spark, sf_dir, amount=amount), path)
    return path


def _land(orders: DataFrame, path: str) -> None:
    """Landed files hold at most one flush of rows, as those of the stream do."""
    orders.write.mode("append").option("maxRecordsPerFile", FLUSH_ROWS).option("compression", "zstd").parquet(path)


def _stage_arrivals(rows: DataFrame, path: str, max_records: int = 0) -> None:
    """Write the rows of both arrivals in one pass, each below a folder of its own."""
    with setting(rows.sparkSession, OPEN_FILES, MAX_OPEN_FILES):
        (rows.write.option("maxRecordsPerFile", max_records).option("compression", "zstd")
         .partitionBy(ARRIVAL).parquet(path))


def _arrive(spark: SparkSession, staged: str, number: int, folder: str, nested: bool) -> None:
    """Let a staged arrival into a folder: as a folder of its own, or file by file."""
    make_dir(spark, folder)
    arrival = f"{staged}/{ARRIVAL}={number}"
    names = list_names(spark, arrival)
    if names and nested:
        move(spark, arrival, f"{folder}/{number}")
        return
    for name in names:  # both arrivals have files of the same names
        move(spark, f"{arrival}/{name}", f"{folder}/{number}-{name}")


@query(f"WITH orders_once AS ({order_sql(amount='double')}) SELECT {', '.join(EVENT_COLUMNS)} "
       f"FROM (SELECT * FROM orders_once UNION ALL SELECT * FROM orders_once)")
def bronze_append(spark, sf_dir):
    landing, bronze = _landed(spark, sf_dir), scratch_dir(spark, "bronze")
    for _ in range(2):
        jobs.landing_to_bronze(spark, landing, bronze, compact=False)
    return read_bronze_file(spark, bronze).select(*EVENT_COLUMNS)


@query(order_sql(amount="double"))
def bronze_append_new(spark, sf_dir):
    base = scratch_dir(spark, "bronze")
    for condition in (*BATCHES, None):
        if condition is not None:
            _land(_orders(spark, sf_dir, condition).select(*EVENT_COLUMNS), f"{base}/landing")
        jobs.new_landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze",
                                   f"{base}/checkpoint", compact=False)
    return read_bronze_file(spark, f"{base}/bronze").select(*EVENT_COLUMNS)


def _make_older(spark: SparkSession, path: str, days: int) -> None:
    """Set back the modification times of a directory's files, as a copy that keeps times would."""
    directory = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = directory.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(directory):
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)


@query(order_sql(amount="double"))
def landing_backfill(spark, sf_dir):
    base = scratch_dir(spark, "bronze")
    for condition, arrival in zip(BATCHES, ("now", "late")):
        _land(_orders(spark, sf_dir, condition).select(*EVENT_COLUMNS), f"{base}/landing/{arrival}")
        if arrival == "late":
            _make_older(spark, f"{base}/landing/late", days=30)
        jobs.new_landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze",
                                   f"{base}/checkpoint", compact=False)
    return read_bronze_file(spark, f"{base}/bronze").select(*EVENT_COLUMNS)


@query("SELECT count(*) AS row_count, count(*) AS with_time, count(*) AS with_file, "
       "1 AS batches, count(*) AS with_date FROM lineitem")
def bronze_metadata_file(spark, sf_dir):
    landing, bronze = _landed(spark, sf_dir), scratch_dir(spark, "bronze")
    append_bronze(add_file_metadata(read_landing(spark, landing), "one-batch"), bronze)
    return read_bronze_file(spark, bronze).agg(
        F.count("*").alias("row_count"), F.count("_ingested_at").alias("with_time"),
        F.count_if(F.col("_source_file").endswith(".parquet")).alias("with_file"),
        F.count_distinct(F.col("_batch_id")).cast("int").alias("batches"),
        F.count_if(F.col("ingestion_date") == F.to_date("_ingested_at")).alias("with_date"))


@query(f"SELECT order_id, 2 * count(*) AS row_count, true AS fewer_files "
       f"FROM ({order_sql(['order_id'])}) GROUP BY order_id")
def compaction(spark, sf_dir):
    landing, bronze = _landed(spark, sf_dir), scratch_dir(spark, "bronze")
    for _ in range(2):
        jobs.landing_to_bronze(spark, landing, bronze, compact=False)

    def files() -> int:
        pieces = bronze_table(spark, bronze).snapshot().pieces
        return sum(p.files for found in pieces.values() for p in found)

    before = files()
    compact_bronze(spark, bronze)
    return (read_bronze_file(spark, bronze).groupBy("order_id")
            .agg(F.count("*").alias("row_count"))
            .withColumn("fewer_files", F.lit(files() < before)))


@query(f"WITH orders_once AS ({order_sql(amount='double')}) SELECT {', '.join(EVENT_COLUMNS)} "
       f"FROM (SELECT * FROM orders_once UNION ALL SELECT * FROM orders_once)")
def compaction_rows(spark, sf_dir):
    landing, bronze = _landed(spark, sf_dir), scratch_dir(spark, "bronze")
    for _ in range(2):
        jobs.landing_to_bronze(spark, landing, bronze, compact=False)
    compact_bronze(spark, bronze)
    return read_bronze_file(spark, bronze).select(*EVENT_COLUMNS)


# -- topic, landing, decode ------------------------------------------------------------------

def _orders(spark: SparkSession, sf_dir: str, condition: str | None = None) -> DataFrame:
    orders = order_view(spark, sf_dir, [*STREAMED, "line_status"], amount="double")
    return orders if condition is None else orders.filter(condition)


def _as_topic_rows(orders: DataFrame, *beside: Column) -> DataFrame:
    """Orders as framed topic rows, at the position of their line."""
    return as_messages(orders, F.col("line_number"), F.col("order_key"), F.col("order_timestamp"), *beside)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_topic_rows(_orders(spark, sf_dir))


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as framed topic rows, at their own time."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    text = {c: F.col("event_type") for c in EVENT_COLUMNS}
    orders = table(spark, sf_dir, "events").withColumns({
        **text,
        "order_id": F.col("event_id").cast("string"),
        "customer_id": F.col("user_id").cast("string"),
        "order_status": F.lit("PENDING"),
        "quantity": F.lit(1),
        "unit_price": F.col("value"),
        "total_amount": F.col("value"),
        "currency": F.lit("USD"),
        "order_timestamp": F.col("ts").cast("timestamp"),
    })
    return as_messages(orders, F.lit(0), F.col("event_id"), F.col("ts"))


def _landed_events(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_dir(spark, "hourly")
    _event_messages(spark, sf_dir).write.parquet(f"{base}/topic")
    jobs.topic_to_landing(read_topic_files(spark, f"{base}/topic"), f"{base}/landing",
                          f"{base}/checkpoint")
    return f"{base}/landing"


@query("""
SELECT strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
       strftime(ts, '%H') AS hour, count(*) AS row_count,
       cast(sum(cast(value AS decimal(18, 2))) AS double) AS total
FROM events GROUP BY ALL""")
def landing_hourly(spark, sf_dir):
    schema = T.StructType(EVENT.fields + [T.StructField(c, T.StringType()) for c in HOUR_BUCKET])
    landed = spark.read.schema(schema).parquet(_landed_events(spark, sf_dir))
    return landed.groupBy(*HOUR_BUCKET).agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("total_amount").cast("decimal(18, 2)")).alias("total"))


@query("SELECT cast(event_id AS varchar) AS order_id, cast(user_id AS varchar) AS customer_id, "
       "event_type AS product_name, value AS total_amount, "
       "date_trunc('millisecond', ts) AS order_timestamp, 16 AS columns_read FROM events")
def landing_scan(spark, sf_dir):
    landed = read_landing(spark, _landed_events(spark, sf_dir))
    return landed.select("order_id", "customer_id", "product_name", "total_amount",
                         "order_timestamp", F.lit(len(landed.columns)).alias("columns_read"))


@query("SELECT count(*) AS row_count, count(DISTINCT event_id) AS keys FROM events")
def landing_restart(spark, sf_dir):
    """A landing batch that was finished but not committed, read, and run again."""
    base = scratch_dir(spark, "restart")
    _event_messages(spark, sf_dir).write.parquet(f"{base}/topic")
    for _ in range(2):
        jobs.topic_to_landing(read_topic_files(spark, f"{base}/topic"), f"{base}/landing",
                              f"{base}/landing-checkpoint")
        jobs.new_landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint",
                                   compact=False)
        delete_tree(spark, f"{base}/landing-checkpoint/commits")
    return read_bronze_file(spark, f"{base}/bronze").agg(
        F.count("*").alias("row_count"), F.count_distinct("order_id").alias("keys"))


@query(order_sql(amount="double"))
def schema_file_decode(spark, sf_dir):
    """Records decoded by a schema that is read from a file."""
    path = f"{scratch_dir(spark, 'schema')}/order.avsc"
    write_new_text(spark, path, ORDER_SCHEMA_JSON)
    messages = _messages(spark, sf_dir)
    return parse_messages(messages, load_record_schema(spark, path)).select(*EVENT_COLUMNS)


@query("""
SELECT l_orderkey, l_linenumber,
       CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN '0001' WHEN 4 THEN ''
            WHEN 5 THEN '0100000001' || hex(cast(l_partkey AS varchar))
            ELSE hex(cast(l_partkey AS varchar)) END AS body
FROM lineitem""")
def header_strip(spark, sf_dir):
    line, key = F.col("l_linenumber"), F.col("l_partkey").cast("string").cast("binary")

    def raw(hexadecimal: str):
        return F.lit(bytes.fromhex(hexadecimal))

    value = (F.when(line == 1, F.lit(None).cast("binary")).when(line == 2, raw(""))
             .when(line == 3, raw("0001")).when(line == 4, raw("0000000001"))
             .when(line == 5, F.concat(raw("0100000001"), key))
             .otherwise(F.concat(raw("0000000001"), key)))
    return (table(spark, sf_dir, "lineitem")
            .select("l_orderkey", "l_linenumber", F.hex(strip_header(value)).alias("body")))


@query(order_sql(amount="double"))
def record_decode(spark, sf_dir):
    return parse_messages(_messages(spark, sf_dir)).select(*EVENT_COLUMNS)


@query(f"SELECT order_id, {POSITIONS_SQL} FROM ({order_sql(STREAMED, 'double')})")
def flatten_record(spark, sf_dir):
    return parse_messages(_messages(spark, sf_dir)).select("order_id", *POSITION)


# -- streaming -------------------------------------------------------------------------------

def _publish(spark: SparkSession, sf_dir: str, topic: str, condition: str | None = None) -> None:
    """Write messages spread by key, as over a topic's partitions, in files of one flush of rows.

    The order view is spread by the order's key already.
    """
    (_as_topic_rows(_orders(spark, sf_dir, condition)).write.mode("append").option("maxRecordsPerFile", FLUSH_ROWS)
     .option("compression", "zstd").parquet(topic))


def _streamed(spark: SparkSession, base: str, checkpoint: str = "checkpoint") -> str:
    """Stream the topic to bronze, a micro-batch being one scan split for every task slot."""
    batch_bytes = spark.sparkContext.defaultParallelism * SPLIT_BYTES
    jobs.topic_to_bronze(read_topic_files(spark, f"{base}/topic", max_bytes=batch_bytes),
                         f"{base}/bronze", f"{base}/{checkpoint}", optimize_write=False)
    return f"{base}/bronze"


def _topic(spark: SparkSession, sf_dir: str) -> str:
    base = scratch_dir(spark, "stream")
    _publish(spark, sf_dir, f"{base}/topic")
    return base


@query(f"SELECT {', '.join(EVENT_COLUMNS)}, {POSITIONS_SQL}, true AS stamped "
       f"FROM ({order_sql(STREAMED, 'double')})")
def stream_to_bronze(spark, sf_dir):
    bronze = read_bronze_stream(spark, _streamed(spark, _topic(spark, sf_dir)))
    stamped = F.col("ingestion_date") == F.to_date("_ingested_at")
    return bronze.select(*EVENT_COLUMNS, *POSITION, stamped.alias("stamped"))


@query("SELECT 3 AS batches, count(*) AS row_count FROM events")
def stream_admission(spark, sf_dir):
    """Three files of messages at one file a micro-batch."""
    base = scratch_dir(spark, "stream")
    _event_messages(spark, sf_dir).repartition(3, "offset").write.parquet(f"{base}/topic")
    query_run = jobs.topic_to_bronze(read_topic_files(spark, f"{base}/topic", max_files=1),
                                     f"{base}/bronze", f"{base}/checkpoint")
    batches = sum(p["numInputRows"] > 0 for p in query_run.recentProgress)
    return profiles.row_count(read_bronze_stream(spark, f"{base}/bronze")).select(
        F.lit(batches).alias("batches"), "row_count")


#: Offsets of a micro-batch, as a part of the topic's.
BATCH_PART = 6


@query("SELECT count(*) AS row_count, count(DISTINCT event_id) AS offsets, true AS within_limit, true AS several "
       "FROM events")
def stream_offset_admission(spark, sf_dir):
    """Micro-batches of at most so many offsets, none lost."""
    base = scratch_dir(spark, "stream")
    limit = max(2, table(spark, sf_dir, "events").count() // BATCH_PART)
    write_topic_files(_event_messages(spark, sf_dir), f"{base}/topic", limit // 2)
    jobs.topic_to_bronze(
        read_topic_files(spark, f"{base}/topic", max_offsets=limit, offsets_per_file=limit // 2),
        f"{base}/bronze", f"{base}/checkpoint", compact_every=None)
    batches = (read_bronze_stream(spark, f"{base}/bronze")
               .groupBy(F.regexp_extract(F.col("_metadata.file_path"), "batch=([0-9]+)", 1)).agg(
                   F.count("*").alias("rows"), F.count_distinct("_kafka_offset").alias("offsets")))
    return batches.agg(F.sum("rows").alias("row_count"), F.sum("offsets").alias("offsets"),
                       (F.max("rows") <= limit).alias("within_limit"), (F.count("*") > 1).alias("several"))


@query("SELECT count(*) AS row_count, count(DISTINCT event_id) AS keys FROM events WHERE event_id % 3 <> 2")
def stream_lost_data(spark, sf_dir):
    """A file of messages that vanishes after it was listed, before it is read."""
    base = scratch_dir(spark, "stream")
    for part in range(3):
        rows = _event_messages(spark, sf_dir).filter(F.col("offset") % 3 == part)
        rows.coalesce(1).write.parquet(f"{base}/topic/part={part}")

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0:
            delete_tree(spark, f"{base}/topic/part=2")
        batch.write.mode("append").parquet(f"{base}/read")

    stream = read_topic_files(spark, f"{base}/topic/part=*", max_files=1)
    run_to_end(stream.writeStream.foreachBatch(write).trigger(availableNow=True)
               .option("checkpointLocation", f"{base}/checkpoint").start())
    return spark.read.parquet(f"{base}/read").agg(
        F.count("*").alias("row_count"), F.count_distinct("offset").alias("keys"))


@query(f"""
SELECT 1 AS run, count(*) FILTER (WHERE l_linestatus = 'F') AS row_count FROM lineitem
UNION ALL SELECT 2, count(*) FROM lineitem UNION ALL SELECT 3, count(*) FROM lineitem""")
def stream_incremental(spark, sf_dir):
    base = scratch_dir(spark, "stream")
    counts = []
    for run, condition in enumerate([*BATCHES, None], start=1):
        if condition is not None:
            _publish(spark, sf_dir, f"{base}/topic", condition)
        # Counted at once: scans of one directory compare equal, so Spark would run only one of them.
        counts.append((run, read_bronze_stream(spark, _streamed(spark, base)).count()))
    return spark.createDataFrame(counts, "run int, row_count bigint")


@query(f"""
SELECT 2 * count(*) AS bronze_rows, count(DISTINCT order_id) AS bronze_keys,
       (SELECT count(*) FROM ({silver_sql(['order_id'], 'double')})) AS silver_rows,
       0 AS updated_by_replay, 0 AS inserted_by_replay
FROM ({order_sql(['order_id'])})""")
def stream_replay(spark, sf_dir):
    base = _topic(spark, sf_dir)
    bronze = _streamed(spark, base)
    jobs.bronze_to_silver(spark, bronze, f"{base}/silver", "stream")
    _streamed(spark, base, "fresh-checkpoint")
    replay = jobs.bronze_to_silver(spark, bronze, f"{base}/silver", "stream").merge
    silver = silver_table(spark, f"{base}/silver").read()
    totals = read_bronze_stream(spark, bronze).agg(
        F.count("*").alias("bronze_rows"), F.count_distinct(F.col("order_id")).alias("bronze_keys"))
    return totals.crossJoin(silver.agg(F.count("*").alias("silver_rows"))).withColumns({
        "updated_by_replay": F.lit(replay.updated), "inserted_by_replay": F.lit(replay.inserted)})


@query(f"SELECT {', '.join(EVENT_COLUMNS)}, {POSITIONS_SQL}, true AS fewer_files "
       f"FROM ({order_sql(STREAMED, 'double')}) CROSS JOIN (SELECT unnest([1, 2]) AS run)")
def stream_compaction(spark, sf_dir):
    """Several micro-batches, compacted; a restart takes new rows; all is replayed and compacted again."""
    base = scratch_dir(spark, "stream")
    bronze = f"{base}/bronze"
    orders = order_view(spark, sf_dir, [*STREAMED, "line_status"], amount="double", tasks=5)
    _stage_arrivals(_as_topic_rows(orders, F.expr(FIRST_OR_LATER)), f"{base}/staged")

    def run(checkpoint: str, arrival: int | None = None, compact_every: int | None = None) -> None:
        if arrival is not None:
            _arrive(spark, f"{base}/staged", arrival, f"{base}/topic", nested=False)
        jobs.topic_to_bronze(read_topic_files(spark, f"{base}/topic", max_files=2), bronze, f"{base}/{checkpoint}",
                             compact_every=compact_every)

    def files() -> int:
        return len(read_bronze_stream(spark, bronze).inputFiles())

    run("checkpoint", arrival=0)
    before = files()
    run("checkpoint", compact_every=10)
    fewer = files() < before
    run("checkpoint", arrival=1)
    run("fresh-checkpoint")
    before = files()
    compact_bronze(spark, bronze, schema=BRONZE_STREAM)
    return read_bronze_stream(spark, bronze).select(
        *EVENT_COLUMNS, *POSITION, F.lit(fewer and files() < before).alias("fewer_files"))


# -- profiles --------------------------------------------------------------------------------

@query(f"""
SELECT order_date, currency, cast(sum(total_amount) AS double) AS revenue
FROM ({silver_sql(['currency'])}) GROUP BY order_date, currency""")
def revenue_by_currency(spark, sf_dir):
    return profiles.revenue_by_currency(_silver(spark, sf_dir, ["currency"]))


@query(f"SELECT count(*) AS row_count FROM ({silver_sql(['order_id'])})")
def silver_count(spark, sf_dir):
    return profiles.row_count(_silver(spark, sf_dir, []))


@query("SELECT count(*) AS row_count, 1 AS days FROM lineitem")
def bronze_profile_file(spark, sf_dir):
    landing, bronze = _landed(spark, sf_dir), scratch_dir(spark, "bronze")
    jobs.landing_to_bronze(spark, landing, bronze, compact=False)
    profile = profiles.span(read_bronze_file(spark, bronze), "ingestion_date")
    return profile.select("row_count", (F.datediff("last", "first") + 1).alias("days"))


@query("SELECT count(*) AS row_count, true AS in_order FROM lineitem")
def bronze_profile_stream(spark, sf_dir):
    bronze = read_bronze_stream(spark, _streamed(spark, _topic(spark, sf_dir)))
    profile = profiles.span(bronze, "_ingested_at")
    return profile.select("row_count", (F.col("first") <= F.col("last")).alias("in_order"))


@query(f"SELECT count(*) AS row_count, min(order_date) AS first, max(order_date) AS last "
       f"FROM ({silver_sql(['order_id'])})")
def silver_profile(spark, sf_dir):
    return profiles.span(_silver(spark, sf_dir, []), "order_date")


@query(f"SELECT count(*) AS row_count, count(DISTINCT order_id) AS distinct_keys "
       f"FROM ({silver_sql(['order_id'])})")
def silver_uniqueness(spark, sf_dir):
    return profiles.uniqueness(_silver(spark, sf_dir, []))


@query(f"{TOP_SQL} ORDER BY revenue DESC, product_id LIMIT 10")
def gold_preview(spark, sf_dir):
    return profiles.preview(gold_top_products(spark, sf_dir), 10, F.desc("revenue"),
                            F.asc("product_id"))


@query(f"SELECT * FROM ({DAILY_SQL.format(rows=silver_sql(['currency']))}) "
       f"ORDER BY order_date DESC, currency LIMIT 10")
def latest_days(spark, sf_dir):
    return profiles.preview(gold_daily_revenue(spark, sf_dir), 10, F.desc("order_date"),
                            F.asc("currency"))


# -- catalog and whole pipelines -------------------------------------------------------------

def _gold(spark: SparkSession, silver: str, base: str) -> None:
    create_databases(spark, SILVER_DB, GOLD_DB, location=base)
    jobs.silver_to_gold(spark, silver, f"{base}/gold", SILVER_DB, GOLD_DB)


def _file_silver(spark: SparkSession, sf_dir: str, base: str) -> str:
    """Two arrivals of landed files, each taken through bronze into silver."""
    rows = order_view(spark, sf_dir, [*EVENT_COLUMNS, "line_status"], amount="double")
    _stage_arrivals(rows.selectExpr(*EVENT_COLUMNS, FIRST_OR_LATER), f"{base}/staged", FLUSH_ROWS)
    for number in range(len(BATCHES)):
        _arrive(spark, f"{base}/staged", number, f"{base}/landing", nested=True)
        jobs.landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze")
        jobs.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", "file")
    return f"{base}/silver"


def _stream_silver(spark: SparkSession, sf_dir: str, base: str) -> str:
    for condition in BATCHES:
        _publish(spark, sf_dir, f"{base}/topic", condition)
        bronze = _streamed(spark, base)
        jobs.bronze_to_silver(spark, bronze, f"{base}/silver", "stream")
    return f"{base}/silver"


# A second arrival of equal time does not replace the first, so this is the merge of both.
# The tables sum doubles, whose last bits depend on the order; every amount has two decimals.
PIPELINE_SQL = f"""
SELECT order_date, currency, cast(sum(total_amount) AS double) AS revenue,
       count(DISTINCT order_id) AS order_count
FROM ({_merged_sql(SILVER_OUT)}) GROUP BY order_date, currency"""


def _daily(spark: SparkSession) -> DataFrame:
    return read_named(spark, GOLD_DB, "daily_revenue").select(
        "order_date", "currency", F.round("revenue", 2).alias("revenue"), "order_count")


@query(PIPELINE_SQL)
def pipeline_file(spark, sf_dir):
    base = scratch_dir(spark, "pipeline")
    _gold(spark, _file_silver(spark, sf_dir, base), base)
    return _daily(spark)


@query(PIPELINE_SQL)
def pipeline_stream(spark, sf_dir):
    base = scratch_dir(spark, "pipeline")
    _gold(spark, _stream_silver(spark, sf_dir, base), base)
    return _daily(spark)


@query(f"""
SELECT '{SILVER_DB}' AS database, 'orders' AS name,
       (SELECT count(*) FROM ({silver_sql(['order_id'])})) AS row_count
UNION ALL SELECT '{GOLD_DB}', 'daily_revenue', count(*) FROM
       (SELECT DISTINCT order_date, currency FROM ({silver_sql(['currency'])}))
UNION ALL SELECT '{GOLD_DB}', 'order_status_summary', count(*) FROM
       (SELECT DISTINCT order_date, order_status FROM ({silver_sql(['order_status'])}))
UNION ALL SELECT '{GOLD_DB}', 'top_products', count(*) FROM
       (SELECT DISTINCT product_id FROM ({silver_sql(['product_id'])}))""")
def catalog_tables(spark, sf_dir):
    base = scratch_dir(spark, "pipeline")
    silver = silver_table(spark, f"{base}/silver")
    columns = list(dict.fromkeys([*KEYS, *PRODUCTS, "order_status", "currency"]))
    silver.overwrite(_silver(spark, sf_dir, columns), unique_key="order_id")
    _gold(spark, silver.root, base)
    register_silver(spark, silver.root, f"{SILVER_DB}.orders")
    listed = {row[0] for row in list_databases(spark).collect()}
    names = [(SILVER_DB, "orders"), (GOLD_DB, "daily_revenue"),
             (GOLD_DB, "order_status_summary"), (GOLD_DB, "top_products")]
    counted = [
        profiles.row_count(read_named(spark, database, name))
        .select(F.lit(database).alias("database"), F.lit(name).alias("name"), "row_count")
        for database, name in names if database in listed]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


def _gold_tables(spark: SparkSession, sf_dir: str, columns: list[str]) -> None:
    base = scratch_dir(spark, "gold")
    silver = silver_table(spark, f"{base}/silver")
    needed = list(dict.fromkeys([*KEYS, *PRODUCTS, "order_status", "currency", *columns]))
    silver.overwrite(_silver(spark, sf_dir, needed), unique_key="order_id")
    _gold(spark, silver.root, base)


@query(f"""
SELECT order_date, order_status, count(*) AS order_count,
       cast(sum(total_amount) AS double) AS total_revenue
FROM ({silver_sql(["order_status"])}) GROUP BY order_date, order_status""")
def gold_table_status_summary(spark, sf_dir):
    _gold_tables(spark, sf_dir, ["order_status"])
    return read_named(spark, GOLD_DB, "order_status_summary")


@query(TOP_SQL)
def gold_table_top_products(spark, sf_dir):
    _gold_tables(spark, sf_dir, PRODUCTS)
    return read_named(spark, GOLD_DB, "top_products")


@query(f"SELECT {_names(KEYS, 'total_amount')} FROM ({silver_sql(KEYS)})")
def table_by_path(spark, sf_dir):
    path = scratch_dir(spark, "table")
    _silver(spark, sf_dir, KEYS).select(*KEYS).write.parquet(path)
    return read_path(spark, path)
