"""Silver runs that move keys and places give what those that move whole rows give."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ingotflow.operators import places
from ingotflow.plans import jobs
from ingotflow.schemas import BRONZE_STREAM
from ingotflow.sources.tables import read_bronze_stream, silver_table
from ingotflow.streaming.batches import write_batch_by_date

DAYS = [datetime(2024, 1, day, hour) for day in (1, 2, 3) for hour in (0, 12)]
STAMP = datetime(2024, 5, 6, 7)


def record(rng, key, **given):
    row = {f.name: "x" for f in BRONZE_STREAM} | {
        "order_id": key, "product_id": rng.choice("pqr"), "quantity": rng.choice([1, 2, 2, 0, None]),
        "unit_price": 1.0, "total_amount": rng.choice([1.0, 2.5, float("nan"), 0.0, -1.0, None]),
        "order_timestamp": rng.choice([None, *DAYS]), "_kafka_partition": rng.choice([0, 1, None]),
        "_kafka_offset": rng.randrange(99), "_kafka_timestamp": STAMP, "_ingested_at": STAMP,
        "ingestion_date": date(2024, 5, 6)} | given
    return tuple(row[f.name] for f in BRONZE_STREAM)


def add(spark, base, batch_id, records, parts=3):
    df = spark.createDataFrame(records, BRONZE_STREAM).repartition(parts)
    write_batch_by_date(df, "q", batch_id, f"{base}/bronze", optimize_write=False)


def run(spark, base, monkeypatch, large):
    """One run by places, if ``large``, or by whole rows; what it says and the rows of silver."""
    root = f"{base}/silver-{large}"
    monkeypatch.setattr(jobs, "LARGE_BYTES", 0 if large else 10**12)
    done = jobs.bronze_to_silver(spark, f"{base}/bronze", root, "stream", count_read=True)
    rows = silver_table(spark, root).read().collect()
    return (done.rows_read, done.rows_valid, done.rows_latest, *done.merge[1:],
            silver_table(spark, root).snapshot().unique_key, sorted(map(repr, rows)))


def test_by_places_as_by_whole_rows(spark, base, monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(places, "CHUNK_ROWS", 16)  # several bitmaps a file, and several jobs
    monkeypatch.setattr(places, "IS_MARKED", places.IS_MARKED.replace("1024", "16"))
    monkeypatch.setattr(places, "CHUNKS_AT_ONCE", 3)
    moved = []
    latest = jobs.latest_per_key
    monkeypatch.setattr(jobs, "latest_per_key", lambda df, *a: moved.append(df.count()) or latest(df, *a))
    keys = [*map(str, range(60)), None]
    batch = [record(rng, rng.choice(keys)) for _ in range(200)]
    steps = [batch, batch, [record(rng, rng.choice([*keys, "new", "more"])) for _ in range(150)],
             [record(rng, "0", total_amount=0.0)]]
    for n, records in enumerate(steps):
        add(spark, base, n, records)
        del moved[:]
        by_places = run(spark, base, monkeypatch, True)
        few = sum(moved)
        del moved[:]
        assert by_places == run(spark, base, monkeypatch, False), n
        assert few < sum(moved)  # whole rows that the dedup took


def test_a_replay_moves_no_whole_row(spark, base, monkeypatch):
    rng = random.Random(5)
    batch = [record(rng, str(n), total_amount=1.0, quantity=1, order_timestamp=DAYS[n % 6]) for n in range(50)]
    add(spark, base, 0, batch)
    assert run(spark, base, monkeypatch, True)[3:5] == (0, 50)
    add(spark, base, 1, batch)
    monkeypatch.setattr(jobs, "latest_per_key", lambda *_: pytest.fail("whole rows are compared"))
    assert run(spark, base, monkeypatch, True)[:5] == (100, 100, 50, 0, 0)


def test_nothing_valid(spark, base, monkeypatch):
    add(spark, base, 0, [record(random.Random(1), "a", quantity=0) for _ in range(5)])
    assert run(spark, base, monkeypatch, True)[:5] == (5, 0, 0, 0, 0)


def test_places_need_a_plain_scan(spark, base):
    add(spark, base, 0, [record(random.Random(1), "a")], parts=1)
    bronze = read_bronze_stream(spark, f"{base}/bronze")
    assert places.has_places(bronze)
    assert not places.has_places(bronze.unionByName(bronze))
    assert not places.has_places(bronze.groupBy("order_id").agg(F.count("*")))
    assert len(places.files_of(bronze)) == len(bronze.inputFiles())
