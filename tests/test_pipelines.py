from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from contract.framing import as_messages
from ingotflow import storage
from ingotflow.operators.enrich import parse_messages
from ingotflow.plans import cli, jobs
from ingotflow.schemas import BRONZE_STREAM, EVENT_COLUMNS, KAFKA_ROW
from ingotflow.sources.landing import read_landing
from ingotflow.sources.tables import bronze_table, read_bronze_file, read_bronze_stream, silver_table
from ingotflow.sources.topic import read_topic_files, topic_options
from ingotflow.streaming.sinks import start_landing

T1, T2, T3 = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 9), datetime(2024, 1, 3)


def messages(df, hour=10):
    return as_messages(df, F.lit(0), F.monotonically_increasing_id(),
                       F.lit(datetime(2024, 5, 6, hour)))


@pytest.fixture
def topic(events, base):
    """Each call adds one file of messages."""
    def publish(*rows, hour=10):
        messages(events(*rows), hour).coalesce(1).write.mode("append").parquet(f"{base}/topic")
    return publish


def to_bronze(spark, base, checkpoint="checkpoint", max_files=1):
    query = jobs.topic_to_bronze(read_topic_files(spark, f"{base}/topic", max_files),
                                 f"{base}/bronze", f"{base}/{checkpoint}")
    return [p["numInputRows"] for p in query.recentProgress]


def ids(df):
    return sorted(r.order_id for r in df.select("order_id").collect())


def silver(spark, base):
    return sorted(tuple(r) for r in silver_table(spark, f"{base}/silver").read()
                  .select("order_id", "order_timestamp", "total_amount").collect())


def test_messages_have_the_topic_columns(events):
    assert messages(events({})).schema.simpleString() == KAFKA_ROW.simpleString()


def test_topic_options():
    assert topic_options("k:9092", "orders.raw") == {
        "kafka.bootstrap.servers": "k:9092", "subscribe": "orders.raw",
        "startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "10000"}
    assert "maxOffsetsPerTrigger" not in topic_options("k", "t", None)


def test_stream_admits_at_the_limit_and_takes_only_what_is_new(spark, base, topic):
    for key in "ABC":
        topic({"order_id": key})
    assert [n for n in to_bronze(spark, base) if n] == [1, 1, 1]
    assert ids(read_bronze_stream(spark, f"{base}/bronze")) == ["A", "B", "C"]
    assert sum(to_bronze(spark, base)) == 0
    topic({"order_id": "D"})
    assert sum(to_bronze(spark, base)) == 1
    bronze = read_bronze_stream(spark, f"{base}/bronze")
    assert ids(bronze) == ["A", "B", "C", "D"] and bronze.columns == BRONZE_STREAM.names
    assert ids(read_bronze_stream(spark, f"{base}/bronze", since=date(2999, 1, 1))) == []


def test_batch_that_failed_before_its_commit_is_written_once(spark, base, topic, monkeypatch):
    topic({"order_id": "A"}, {"order_id": "B"})
    from ingotflow.streaming import sinks

    write = sinks.write_batch_by_date

    def write_then_crash(*args, **kwargs):
        write(*args, **kwargs)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(sinks, "write_batch_by_date", write_then_crash)
    with pytest.raises(Exception, match="driver lost"):
        to_bronze(spark, base)
    monkeypatch.setattr(sinks, "write_batch_by_date", write)
    to_bronze(spark, base)
    assert ids(read_bronze_stream(spark, f"{base}/bronze")) == ["A", "B"]


def test_replay_from_a_fresh_checkpoint_leaves_silver_alone(spark, base, topic):
    topic({"order_id": "A"}, {"order_id": "B", "order_timestamp": T2})
    to_bronze(spark, base)
    first = jobs.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", "stream")
    assert tuple(first.merge) == (0, 0, 2)
    before = sorted(map(tuple, silver_table(spark, f"{base}/silver").read().collect()))
    to_bronze(spark, base, "other-checkpoint")
    assert ids(read_bronze_stream(spark, f"{base}/bronze")) == ["A", "A", "B", "B"]
    replay = jobs.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", "stream")
    assert (replay.rows_read, replay.rows_valid, replay.rows_latest) == (None, 4, 2)
    assert replay.merge[1:] == (0, 0)
    assert sorted(map(tuple, silver_table(spark, f"{base}/silver").read().collect())) == before


def test_late_and_invalid_records(spark, base, topic):
    topic({"order_id": "A", "order_timestamp": T2, "total_amount": 2.0})
    to_bronze(spark, base)
    jobs.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", "stream")
    topic({"order_id": "A", "order_timestamp": T1, "total_amount": 1.0},
          {"order_id": "A", "order_timestamp": T3, "total_amount": 0.0},
          {"order_id": "B", "order_timestamp": T1})
    to_bronze(spark, base)
    run = jobs.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", "stream",
                                since=date(2000, 1, 1), source_is_small=True, count_read=True)
    assert run.merge[1:] == (0, 1) and (run.rows_read, run.rows_valid) == (4, 3)
    assert silver(spark, base) == [("A", T2, 2.0), ("B", T1, 5.0)]


def test_landing_layout_and_scan(spark, base, topic):
    topic({"order_id": "A"}, {"order_id": "B"}, {"order_id": "C"}, hour=7)
    topic({"order_id": "D"}, hour=23)
    jobs.topic_to_landing(read_topic_files(spark, f"{base}/topic"), f"{base}/landing",
                          f"{base}/checkpoint", max_records_per_file=2)
    landed = read_landing(spark, f"{base}/landing")
    assert landed.columns == EVENT_COLUMNS and ids(landed) == ["A", "B", "C", "D"]
    files = landed.inputFiles()
    assert len(files) == 3 and all(f.endswith(".snappy.parquet") for f in files)
    assert sum("/year=2024/month=05/day=06/hour=07/" in f for f in files) == 2
    assert sum("/year=2024/month=05/day=06/hour=23/" in f for f in files) == 1


def test_interval_trigger_runs_on(spark, base, topic):
    topic({"order_id": "A"})
    parsed = parse_messages(read_topic_files(spark, f"{base}/topic"))
    query = start_landing(parsed, f"{base}/landing", f"{base}/checkpoint", "1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and ids(read_landing(spark, f"{base}/landing")) == ["A"]
    finally:
        query.stop()


def test_stream_failure_is_raised(spark, base):
    junk = spark.createDataFrame([(None, b"\x00\x00\x00\x00\x01\x02", "t", 0, 0, T1, 0)], KAFKA_ROW)
    junk.write.parquet(f"{base}/topic")
    with pytest.raises(Exception, match="malformed"):
        to_bronze(spark, base)


def test_stream_plan_has_no_shuffle_of_its_own(spark, base, events):
    parsed = parse_messages(messages(events({})))
    assert "Exchange" not in parsed._jdf.queryExecution().executedPlan().toString()


def test_files_to_gold(spark, base, events):
    def land(*rows):
        events(*rows).write.mode("append").parquet(f"{base}/landing/topics/year=2024/hour=01")

    def run():
        jobs.landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze")
        return jobs.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver")

    land({"order_id": "A"}, {"order_id": "B", "total_amount": -1.0})
    run()
    bronze = read_bronze_file(spark, f"{base}/bronze")
    row = bronze.first()
    assert "year" not in bronze.columns and row._source_file.startswith("file:/")
    assert row.ingestion_date == row._ingested_at.date()
    assert silver(spark, base) == [("A", T1, 5.0)]

    # Everything landed is appended again; silver takes only what is new.
    land({"order_id": "A", "order_timestamp": T2, "total_amount": 7.0}, {"order_id": "C"})
    second = run()
    assert read_bronze_file(spark, f"{base}/bronze").count() == 6
    assert second.merge[1:] == (1, 1)
    before = sorted(map(tuple, silver_table(spark, f"{base}/silver").read().collect()))
    assert run().merge[1:] == (0, 0)
    assert sorted(map(tuple, silver_table(spark, f"{base}/silver").read().collect())) == before
    assert [r[:2] for r in silver(spark, base)] == [("A", T2), ("C", T1)]

    names = jobs.silver_to_gold(spark, f"{base}/silver", f"{base}/gold", "p_silver", "p_gold")
    assert names == ["p_gold.daily_revenue", "p_gold.order_status_summary", "p_gold.top_products"]
    daily = spark.table("p_gold.daily_revenue").orderBy("order_date").collect()
    assert [tuple(r) for r in daily] == [
        (date(2024, 1, 1), "USD", 5.0, 1, 5.0), (date(2024, 1, 2), "USD", 7.0, 1, 7.0)]
    jobs.silver_to_gold(spark, f"{base}/silver", f"{base}/gold", "p_silver", "p_gold")
    assert spark.table("p_gold.top_products").first().revenue == 12.0
    spark.sql("DROP DATABASE p_silver CASCADE")
    spark.sql("DROP DATABASE p_gold CASCADE")


def test_new_files_are_appended_once_even_after_a_crash(spark, base, events, monkeypatch):
    from ingotflow.streaming import sinks

    def land(*rows):
        events(*rows).coalesce(1).write.mode("append").parquet(f"{base}/landing/year=2024/hour=01")

    def run(**options):
        jobs.new_landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze",
                                   f"{base}/checkpoint", **options)
        return ids(read_bronze_file(spark, f"{base}/bronze"))

    land({"order_id": "A"}, {"order_id": "B"})
    write = sinks.write_batch_by_date

    def write_then_crash(*args, **kwargs):
        write(*args, **kwargs)
        raise RuntimeError("driver lost")

    monkeypatch.setattr(sinks, "write_batch_by_date", write_then_crash)
    with pytest.raises(Exception, match="driver lost"):
        run()
    monkeypatch.setattr(sinks, "write_batch_by_date", write)
    assert run() == ["A", "B"]
    land({"order_id": "C"})
    assert run(max_bytes=1) == ["A", "B", "C"] and run() == ["A", "B", "C"]
    row = read_bronze_file(spark, f"{base}/bronze").first()
    assert row._source_file.endswith(".parquet") and "year" not in row.asDict()


def test_command_line_arguments(monkeypatch):
    monkeypatch.delenv("KAFKA_TOPIC", raising=False)
    args = cli.parser().parse_args(["bronze-to-silver", "--bronze", "b", "--silver", "s",
                                    "--profile", "stream", "--since", "2024-01-02"])
    assert (args.profile, args.since) == ("stream", date(2024, 1, 2))
    args = cli.parser().parse_args(["topic-to-landing", "--landing", "l", "--checkpoint", "c"])
    assert (args.topic, args.max_offsets, args.max_records_per_file) == ("orders.raw", 10_000, 10_000)
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["silver-to-gold", "--silver", "s"])


def test_large_landings_are_appended_in_compacted_files(spark, base, events, monkeypatch):
    events(*[{"order_id": str(i)} for i in range(400)]).repartition(20).write.parquet(f"{base}/landing")
    size = storage.size_of(spark, f"{base}/landing")
    monkeypatch.setattr(jobs, "SMALL_FILE_BYTES", size // 5)
    jobs.landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze")
    table = bronze_table(spark, f"{base}/bronze")
    (piece,), = table.snapshot().pieces.values()
    assert piece.files <= 5 and piece.sized and table.versions() == [0]  # nothing was left to compact
    assert ids(read_bronze_file(spark, f"{base}/bronze")) == sorted(map(str, range(400)))
