import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ingotflow.operators import gold, profiles, quality
from ingotflow.operators.dedup import latest_per_key
from ingotflow.operators.enrich import (
    cast_and_derive,
    select_file_columns,
    select_stream_columns,
    with_line_total,
)
from ingotflow.operators.upsert import changed_rows, merge_latest, merge_statement
from ingotflow.schemas import SILVER_BASE_COLUMNS, SILVER_FILE_COLUMNS, SILVER_STREAM_OPTIONAL

T1, T2 = datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 9)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_cast_reads_long_as_milliseconds_and_keeps_timestamps(spark):
    millis = spark.createDataFrame([(1_700_000_000_000,)], "order_timestamp bigint")
    row = cast_and_derive(millis).first()
    assert row.order_timestamp == datetime(2023, 11, 14, 22, 13, 20)
    assert row.order_date == date(2023, 11, 14)
    assert cast_and_derive(cast_and_derive(millis)).first() == row
    text = spark.createDataFrame([("2024-01-01 10:00:00",), ("nonsense",)], "order_timestamp string")
    assert rows(cast_and_derive(text), "order_timestamp", "order_date") == [
        (None, None), (T1, date(2024, 1, 1))]


def test_validation_is_three_valued_and_keeps_nan(events):
    df = events({"order_id": "ok"}, {"order_id": "zero", "total_amount": 0.0},
                {"order_id": "null", "total_amount": None}, {"order_id": "noq", "quantity": None},
                {"order_id": "neg", "quantity": -1}, {"order_id": "nan", "total_amount": float("nan")})
    assert rows(quality.validate(df), "order_id") == [("nan",), ("ok",)]
    assert tuple(quality.validity_counts(df).first()) == (6, 2, 4)


def test_invalid_newer_row_does_not_shadow(events):
    df = events({"order_timestamp": T1}, {"order_timestamp": T2, "total_amount": 0.0})
    kept = latest_per_key(quality.validate(df), [])
    assert rows(kept, "order_timestamp") == [(T1,)]


def test_dedup_null_time_last_null_keys_one_group_ties_decided(events):
    df = events({"order_timestamp": None}, {"order_timestamp": T1},
                {"order_id": None, "order_timestamp": T1}, {"order_id": None, "order_timestamp": T2},
                {"order_id": "B", "product_id": "p1"}, {"order_id": "B", "product_id": "p2"})
    kept = latest_per_key(df, [F.col("product_id").desc()])
    assert rows(kept, "order_id", "order_timestamp", "product_id") == [
        ("A", T1, "p1"), ("B", T1, "p2"), (None, T2, "p1")]
    assert tuple(quality.dedup_counts(df).first()) == (6, 3, 3)
    assert tuple(quality.dedup_counts(df.limit(0)).first()) == (0, 0, 0)
    assert kept.columns == df.columns


def test_dedup_prunes_before_the_shuffle(events):
    plan = latest_per_key(events({}), [])._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.rindex("WindowGroupLimit"), plan.index("Exchange")
    assert plan.index("WindowGroupLimit") < exchange < partial


def test_domain_violations_count_null(events):
    df = events({}, {"order_status": "LOST"}, {"order_status": None, "currency": "GBP"})
    assert tuple(quality.domain_violations(df).first()) == (3, 2, 1)


def test_column_lists(spark, events):
    stamped = cast_and_derive(events({})).withColumns(
        {c: F.lit(None) for c in [*SILVER_FILE_COLUMNS[-3:], *SILVER_STREAM_OPTIONAL]})
    assert select_file_columns(stamped).columns == SILVER_FILE_COLUMNS
    assert len(SILVER_FILE_COLUMNS) == 20
    assert select_stream_columns(stamped).columns == [*SILVER_BASE_COLUMNS, *SILVER_STREAM_OPTIONAL]
    without = stamped.drop("_kafka_offset")
    assert "_kafka_offset" not in select_stream_columns(without).columns
    assert with_line_total(events({"quantity": 3, "unit_price": 1.1})).first().total_amount == 3.3


SCHEMA = "order_id string, order_timestamp timestamp, order_date date, v int"


def record(key, moment, value):
    return key, moment, moment.date() if moment else None, value


MERGES = {
    "stale source": ([("A", T2, 1)], [("A", T1, 2)], [("A", 1)]),
    "equal time": ([("A", T1, 1)], [("A", T1, 2)], [("A", 1)]),
    "newer source": ([("A", T1, 1)], [("A", T2, 2)], [("A", 2)]),
    "null source time": ([("A", T1, 1)], [("A", None, 2)], [("A", 1)]),
    "null target time": ([("A", None, 1)], [("A", T2, 2)], [("A", 1)]),
    "null keys": ([(None, T1, 1)], [(None, T2, 2)], [(None, 1), (None, 2)]),
    "one side only": ([("A", T1, 1)], [("B", T1, 2)], [("A", 1), ("B", 2)]),
}


@pytest.mark.parametrize("name", MERGES)
def test_merge_edges(spark, name):
    target, source, expected = MERGES[name]
    t = spark.createDataFrame([record(*r) for r in target], SCHEMA)
    s = spark.createDataFrame([record(*r) for r in source], SCHEMA)
    assert rows(merge_latest(t, s), "order_id", "v") == sorted(expected, key=repr)


def random_rows(rng, first_value):
    keys = rng.sample([f"k{i}" for i in range(40)], 25) + [None]
    days = [None, *[T1 + timedelta(days=d) for d in range(4)]]
    return [record(k, rng.choice(days), first_value + i) for i, k in enumerate(keys)]


def brute_force(target, source):
    merged = {r[0]: r for r in target if r[0] is not None}
    extra = [r for r in target if r[0] is None] + [r for r in source if r[0] is None]
    for r in source:
        old = merged.get(r[0])
        if r[0] is not None and (old is None or (r[1] and old[1] and r[1] > old[1])):
            merged[r[0]] = r
    return sorted([*merged.values(), *extra], key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_merge_matches_brute_force(spark, seed):
    rng = random.Random(seed)
    target, source = random_rows(rng, 0), random_rows(rng, 100)
    t, s = spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)
    assert rows(merge_latest(t, s), "*") == brute_force(target, source)
    for small in (False, True):
        changed = changed_rows(t, s, "order_date", source_is_small=small)
        written = [r for r in brute_force(target, source) if r in source]
        assert rows(changed, *s.columns) == written


def test_merge_refuses_other_columns(spark):
    t = spark.createDataFrame([record("A", T1, 1)], SCHEMA)
    with pytest.raises(ValueError, match="differ"):
        merge_latest(t, t.withColumn("more", F.lit(1)))


def test_merge_statement_parses(spark):
    text = merge_statement("silver.orders", "updates", ["order_id", "order_timestamp", "v"])
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text).toString()
    assert "MergeIntoTable" in plan


def test_gold_models(spark, events):
    df = cast_and_derive(events(
        {"order_id": "A", "total_amount": 10.0, "quantity": 2},
        {"order_id": "B", "total_amount": 20.0, "order_status": "CANCELLED"},
        {"order_id": "C", "total_amount": 5.0, "currency": "EUR", "product_id": "p2"},
        {"order_id": "D", "total_amount": 1.0, "order_timestamp": T2}))
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    daily = [(d2, "USD", 1.0, 1, 1.0), (d1, "USD", 30.0, 2, 15.0), (d1, "EUR", 5.0, 1, 5.0)]
    assert [tuple(r) for r in gold.daily_revenue(df).collect()] == daily
    assert [tuple(r) for r in gold.daily_revenue(df, keys_are_unique=True).collect()] == daily
    assert [tuple(r) for r in gold.order_status_summary(df).collect()] == [
        (d2, "PENDING", 1, 1.0), (d1, "PENDING", 2, 15.0), (d1, "CANCELLED", 1, 20.0)]
    top = gold.top_products(df)
    assert [tuple(r)[0] for r in top.collect()] == ["p1", "p2"]
    assert tuple(top.first())[3:] == (31.0, 4, 3)
    assert [f.dataType for f in top.schema[3:]] == [T.DoubleType(), T.LongType(), T.LongType()]


def test_mean_of_no_amounts_is_null(events):
    df = cast_and_derive(events({"total_amount": None}))
    assert gold.daily_revenue(df).first().avg_order_value is None


def test_unique_keys_avoid_the_key_shuffle(events):
    df = cast_and_derive(events({}))

    def exchanges(model):
        plan = model._jdf.queryExecution().executedPlan().toString()
        return plan.count("Exchange hashpartitioning")

    assert exchanges(gold.daily_revenue(df)) == 2
    assert exchanges(gold.daily_revenue(df, keys_are_unique=True)) == 1


def test_profiles(spark, events):
    df = cast_and_derive(events({}, {"order_timestamp": T2}, {"order_id": "B"}))
    assert tuple(profiles.row_count(df).first()) == (3,)
    assert tuple(profiles.span(df, "order_date").first()) == (3, date(2024, 1, 1), date(2024, 1, 2))
    assert tuple(profiles.uniqueness(df).first()) == (3, 2)
    assert profiles.preview(df, 2).count() == 2
    top = profiles.preview(df, 1, F.desc("order_date"))
    assert top.first().order_date == date(2024, 1, 2)
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()
    assert profiles.revenue_by_currency(df).count() == 2
