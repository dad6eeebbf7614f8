"""Micro-batch directories by date: pruning, compaction, restarts, the older layout."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from test_pipelines import ids, messages

from ingotflow import storage
from ingotflow.operators.enrich import add_stream_metadata, parse_messages
from ingotflow.plans import jobs
from ingotflow.schemas import BRONZE_STREAM
from ingotflow.sinks.bronze import compact_bronze
from ingotflow.sources.tables import read_bronze_file, read_bronze_stream
from ingotflow.sources.topic import read_topic_files
from ingotflow.streaming import batches
from ingotflow.streaming.batches import Piece


@pytest.fixture
def records(events):
    def make(key, day):
        stamped = add_stream_metadata(parse_messages(messages(events({"order_id": key}))))
        return stamped.withColumn("ingestion_date", F.lit(date.fromisoformat(day)))
    return make


def write(spark, path, df, generation, batch):
    batches.write_batch_by_date(df, generation, batch, path)


def read_ids(spark, path, since=None):
    return ids(read_bronze_stream(spark, path, since))


def test_covered_directories_are_not_live():
    day, other = "2024-01-01", "2024-01-02"
    pieces = [Piece(day, "g", 0, 0), Piece(day, "g", 1, 1), Piece(day, "g", 0, 1), Piece(day, "g", 2, 2),
              Piece(day, "h", 1, 1), Piece(other, "g", 1, 1), Piece(day, "g", 3, 9), Piece(day, "g", 0, 2)]
    assert batches.live(pieces) == [Piece(day, "g", 0, 2), Piece(day, "g", 3, 9), Piece(day, "h", 1, 1),
                                    Piece(other, "g", 1, 1)]


def test_since_lists_no_older_date(spark, base, records, monkeypatch):
    path = f"{base}/bronze"
    for n, day in enumerate(["2024-01-01", "2024-01-02", "2024-01-03"]):
        write(spark, path, records("ABC"[n], day), "g", n)
    listed, list_names = [], storage.list_names
    monkeypatch.setattr(storage, "list_names", lambda s, p: listed.append(p) or list_names(s, p))
    recent = read_bronze_stream(spark, path, since=date(2024, 1, 2))
    assert ids(recent) == ["B", "C"] and recent.columns == BRONZE_STREAM.names
    assert len(recent.inputFiles()) == 2 and not [p for p in listed if "2024-01-01" in p]
    assert read_ids(spark, path, date(2024, 1, 4)) == [] and read_ids(spark, path) == ["A", "B", "C"]
    assert read_ids(spark, f"{base}/nothing") == []


def test_older_layout_is_read_beside(spark, base, records):
    path = f"{base}/bronze"
    for n, day in enumerate(["2024-01-01", "2024-01-05"]):
        records("AB"[n], day).write.partitionBy("ingestion_date").parquet(f"{path}/gen=g/batch={n}")
    write(spark, path, records("C", "2024-01-06"), "g", 2)
    assert read_ids(spark, path) == ["A", "B", "C"]
    assert read_ids(spark, path, date(2024, 1, 5)) == ["B", "C"]
    write(spark, path, records("B", "2024-01-05"), "g", 1)  # finished there, not committed
    assert read_ids(spark, path) == ["A", "B", "C"]


def test_a_batch_run_again_replaces_itself(spark, base, records):
    path = f"{base}/bronze"
    write(spark, path, records("A", "2024-01-01"), "g", 0)
    write(spark, path, records("B", "2024-01-01"), "g", 1)
    write(spark, path, records("C", "2024-01-01"), "g", 1)
    write(spark, path, records("D", "2024-01-01"), "h", 1)
    assert read_ids(spark, path) == ["A", "C", "D"]


def test_compaction(spark, base, records):
    path = f"{base}/bronze"

    def compact(**options):
        return batches.compact_batches(spark, path, BRONZE_STREAM, **options)

    def directories():
        return [(p.date[-2:], p.generation, p.batch) for p in batches.live(batches.list_pieces(spark, path))]

    for n in range(4):
        write(spark, path, records("ABCD"[n], "2024-01-01"), "g", n)
    write(spark, path, records("E", "2024-01-02"), "g", 4)
    write(spark, path, records("F", "2024-01-02"), "h", 0)
    before = sorted(map(tuple, read_bronze_stream(spark, path).collect()), key=str)
    reader = read_bronze_stream(spark, path)
    reader.inputFiles()
    assert compact() == 4  # neither query's newest
    assert directories() == [("01", "g", "0-3"), ("02", "g", "4"), ("02", "h", "0")]
    assert sorted(map(tuple, reader.collect()), key=str) == before  # began on the replaced files
    assert sorted(map(tuple, read_bronze_stream(spark, path).collect()), key=str) == before
    assert len(read_bronze_stream(spark, path).inputFiles()) == 3
    assert compact() == 0 and len(batches.list_pieces(spark, path)) == 3

    write(spark, path, records("E", "2024-01-02"), "g", 4)  # run again: still the newest
    for n in range(5, 8):
        write(spark, path, records("GHI"[n - 5], "2024-01-02"), "g", n)
    assert read_ids(spark, path) == sorted("ABCDEFGHI") and compact() == 3
    assert directories() == [("01", "g", "0-3"), ("02", "g", "4-6"), ("02", "g", "7"), ("02", "h", "0")]
    write(spark, path, records("J", "2024-01-02"), "g", 8)
    assert compact(small_bytes=1) == 0  # large enough
    assert compact() == 2 and ("02", "g", "4-7") in directories()
    assert read_ids(spark, path) == sorted("ABCDEFGHIJ")
    assert not [n for n in storage.list_names(spark, path) if n.startswith(batches.DRAFT)]


def test_a_compaction_that_failed_changes_nothing(spark, base, records, monkeypatch):
    path = f"{base}/bronze"
    for n in range(3):
        write(spark, path, records("ABC"[n], "2024-01-01"), "g", n)

    def lost(*args):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(storage, "move", lost)
    with pytest.raises(RuntimeError):
        batches.compact_batches(spark, path, BRONZE_STREAM)
    monkeypatch.undo()
    assert read_ids(spark, path) == ["A", "B", "C"]
    assert batches.compact_batches(spark, path, BRONZE_STREAM) == 2
    assert read_ids(spark, path) == ["A", "B", "C"]
    assert [n for n in storage.list_names(spark, path) if n != "_SUCCESS"] == ["ingestion_date=2024-01-01"]


def test_streams_compact_what_they_write(spark, base, events):
    def publish(key):
        messages(events({"order_id": key})).coalesce(1).write.mode("append").parquet(f"{base}/topic")

    def run(**options):
        jobs.topic_to_bronze(read_topic_files(spark, f"{base}/topic", 1), f"{base}/bronze", f"{base}/checkpoint",
                             **options)
        return read_bronze_stream(spark, f"{base}/bronze")

    for key in "ABCDE":
        publish(key)
    assert ids(run(compact_every=2)) == list("ABCDE") and len(run().inputFiles()) == 2
    publish("F")
    assert ids(run(compact_every=None)) == list("ABCDEF") and len(run(compact_every=None).inputFiles()) == 3
    assert ids(run()) == list("ABCDEF") and len(run().inputFiles()) == 2


def test_files_profile_has_snapshots_and_batches(spark, base, events):
    events({"order_id": "A"}).write.parquet(f"{base}/landing/1")
    jobs.landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze")
    jobs.new_landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint")
    events({"order_id": "B"}).write.parquet(f"{base}/landing/2")
    jobs.new_landing_to_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint")
    bronze = read_bronze_file(spark, f"{base}/bronze")
    assert ids(bronze) == ["A", "A", "B"]
    compact_bronze(spark, f"{base}/bronze")
    assert ids(read_bronze_file(spark, f"{base}/bronze")) == ["A", "A", "B"]
    assert ids(read_bronze_file(spark, f"{base}/bronze", date(2999, 1, 1))) == []
    run = jobs.bronze_to_silver(spark, f"{base}/bronze", f"{base}/silver", since=date(2020, 1, 1))
    assert run.merge.inserted == 2


def shuffles(spark, action):
    """The tables written by ``action`` whose rows were shuffled."""
    plans, original = [], batches.DataFrame.hint
    batches.DataFrame.hint = lambda self, name, *args: plans.append(name) or original(self, name, *args)
    try:
        action()
    finally:
        batches.DataFrame.hint = original
    return plans


def large_batches(spark, base, events, monkeypatch):
    monkeypatch.setattr(batches, "LARGE_BATCH_BYTES", 1)
    rows = events(*[{"order_id": str(i)} for i in range(200)])
    for n in range(4):
        messages(rows).repartition(3).write.mode("append").parquet(f"{base}/topic/{n}")
    path = f"{base}/bronze"
    for n in range(4):
        records = add_stream_metadata(parse_messages(spark.read.parquet(f"{base}/topic/{n}")))
        day = records.withColumn("ingestion_date", F.lit(date(2024, 1, 1)))
        day = day.repartition(3)
        write(spark, path, day, "g", n)
    return path


def test_large_batches_are_not_shuffled(spark, base, events, monkeypatch):
    moved = shuffles(spark, lambda: large_batches(spark, base, events, monkeypatch))
    assert "rebalance" not in moved


def test_size_of_a_batch(spark, base, events):
    events({"order_id": "A"}).write.parquet(f"{base}/rows")
    assert not batches.is_large(spark.read.parquet(f"{base}/rows"))
    assert batches.is_large(spark.range(1 << 24))
    assert not batches.is_large(spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "n int"))  # size unknown


def test_large_batches_of_small_files_are_joined(spark, base, events, monkeypatch):
    path = large_batches(spark, base, events, monkeypatch)
    before = sorted(map(tuple, read_bronze_stream(spark, path).collect()), key=str)
    files = len(read_bronze_stream(spark, path).inputFiles())
    size = min(storage.size_of(spark, f"{path}/{p.directory}") for p in batches.list_pieces(spark, path))
    monkeypatch.setattr(batches, "ALONE_BYTES", 1)
    small = size // 2  # less than a directory, more than a file of it
    moved = shuffles(spark, lambda: batches.compact_batches(spark, path, BRONZE_STREAM, small))
    assert not moved and len(batches.live(batches.list_pieces(spark, path))) == 2
    assert len(read_bronze_stream(spark, path).inputFiles()) < files == 12
    assert sorted(map(tuple, read_bronze_stream(spark, path).collect()), key=str) == before
    assert batches.compact_batches(spark, path, BRONZE_STREAM, small) == 0  # sized already
