"""Running and final totals: worked traces, and random streams against the model."""

import pytest
from pyspark.sql import functions as F

from merchant_ledger.operators import sequence, totals, transitions
from merchant_ledger.operators.slices import is_sliced, slice_if_hot
from merchant_ledger.plans.queries import QUERIES
from model import random_events, totals_after_each

SCHEMA = "seq long, mch_no string, order_id string, state int, amount long, is_snapshot boolean"
AMOUNTS = ["total_amount", "success_amount", "refund_amount", "cancel_amount", "net_amount"]


def frame(spark, events):
    rows = [(i, m, o, s, a, snap) for i, (m, o, s, a, snap) in enumerate(events)]
    return spark.createDataFrame(rows, SCHEMA)


def running(spark, events, **options):
    rows = totals.running_totals(frame(spark, events), ["seq"], **options).collect()
    return [tuple(row[name] for name in AMOUNTS) for row in sorted(rows, key=lambda r: r.seq)]


def trace(text, snapshot=False, merchant="M1"):
    events = []
    for item in text.split():
        order, state, amount = item.split(":")
        events.append((merchant, order, int(state), int(amount), snapshot))
    return events


TRACES = {
    # Snapshot rows add up
    "snapshot_adds": (
        trace("O1:2:100000 O2:5:30000 O3:4:20000 O4:1:99900", True),
        [
            (100000, 100000, 0, 0, 100000),
            (130000, 100000, 30000, 0, 70000),
            (150000, 100000, 30000, 20000, 50000),
            (150000, 100000, 30000, 20000, 50000),
        ],
    ),
    # An order's life; net of a refunded order is negative
    "order_life": (
        trace("O1:0:500 O1:1:500 O1:2:500 O1:5:500"),
        [(0,) * 5, (0,) * 5, (500, 500, 0, 0, 500), (500, 0, 500, 0, -500)],
    ),
    # First seen refunded adds nothing, leaving it makes the bucket negative
    "negative_bucket": (trace("O1:5:100 O1:2:100"), [(0,) * 5, (0, 100, -100, 0, 200)]),
    # A snapshot row records no state
    "snapshot_then_changes": (
        trace("O1:2:1000", True) + trace("O1:5:1000 O1:2:1000"),
        [(1000, 1000, 0, 0, 1000), (1000, 1000, 0, 0, 1000), (1000, 2000, -1000, 0, 3000)],
    ),
    # A delete is one more update
    "delete_is_update": (
        trace("O1:2:100 O1:2:100 O9:2:70"),
        [(100, 100, 0, 0, 100), (100, 100, 0, 0, 100), (170, 170, 0, 0, 170)],
    ),
    # Amount change
    "amount_change": (
        trace("O1:2:100 O1:2:150"),
        [(100, 100, 0, 0, 100), (150, 150, 0, 0, 150)],
    ),
    # An order that changes merchant is new there
    "merchant_change": (
        trace("O1:2:100") + trace("O1:2:100", merchant="M2"),
        [(100, 100, 0, 0, 100), (100, 100, 0, 0, 100)],
    ),
}


@pytest.mark.parametrize("name", TRACES)
def test_trace(spark, name):
    events, expected = TRACES[name]
    assert running(spark, events) == expected
    assert totals_after_each(events) == expected


def test_null_amount_in_a_state_that_moves_no_money(spark):
    events = [("M1", "O1", 1, None, False), ("M1", "O1", 2, 5, False)]
    assert running(spark, events) == [(0,) * 5, (5, 5, 0, 0, 5)]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("rows_per_group", [1_000_000, 40])
def test_random_running(spark, seed, rows_per_group):
    events = random_events(seed, 600, hot=0.4 if seed % 2 else 0.0)
    assert running(spark, events, rows_per_group=rows_per_group) == totals_after_each(events)


@pytest.mark.parametrize("seed", range(4))
def test_random_final(spark, seed):
    events = random_events(seed + 100, 500, hot=0.3)
    last = {m: t for (m, *_), t in zip(events, totals_after_each(events))}
    kinds = {m: snap for m, *_, snap in events}
    df = frame(spark, events)
    for form in (totals.merchant_totals, totals.merchant_totals_from_deltas):
        rows = form(df, ["seq"]).collect()
        assert {r.mch_no: tuple(r[n] for n in AMOUNTS) for r in rows} == last
    rows = totals.latest_totals(df, ["seq"]).collect()
    assert {r.mch_no: tuple(r[n] for n in AMOUNTS) for r in rows} == last
    assert {r.mch_no: r.event_type == "SNAPSHOT" for r in rows} == kinds


def test_hot_groups_are_cut_and_others_left_whole(spark):
    events = random_events(7, 1000, merchants=60, orders=30, hot=0.4)
    sliced = slice_if_hot(frame(spark, events), ["seq"], 100)
    assert is_sliced(sliced)
    sizes = sliced.groupBy("mch_no", "merchant_slice").count().collect()
    assert max(r["count"] for r in sizes) <= 250
    assert {r.mch_no for r in sizes if r.merchant_slice >= 0} == {"M0"}
    orders = sliced.groupBy("mch_no", "order_id", "is_snapshot", "order_slice").count().collect()
    assert {r.order_id for r in orders if r.order_slice >= 0} == {None}


def test_small_or_even_input_is_not_cut(spark):
    events = frame(spark, random_events(8, 400, merchants=40))
    assert not is_sliced(slice_if_hot(events, ["seq"], 1000))
    assert not is_sliced(slice_if_hot(events, ["seq"], 100))


def test_latest_order_state(spark):
    events = trace("O1:2:10 O1:5:20") + trace("O1:4:1", True) + trace("O2:1:7")
    rows = transitions.latest_order_states(frame(spark, events), ["seq"]).collect()
    assert sorted(tuple(r) for r in rows) == [("M1", "O1", 5, 20), ("M1", "O2", 1, 7)]


def test_overflow_fails(spark):
    events = trace(f"O1:2:{2**63 - 1} O2:2:1")
    with pytest.raises(Exception, match="ARITHMETIC_OVERFLOW"):
        running(spark, events)


def test_plain_running_totals_shuffle_once(spark):
    df = totals.running_totals(frame(spark, random_events(1, 50)), ["seq"])
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange") <= 1
    executed = df._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_position_keeps_the_order_of_two_columns(spark, zone, kind):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        times = ["1969-12-31 23:59:59.9", "2024-03-10 01:59:59", "2024-03-10 03:00:00.000001"]
        times += ["2024-11-03 01:30:00", "2024-11-03 02:30:00"]
        rows = [(t, i) for t in times for i in (-(2**63), -1, 0, 7, 2**63 - 1)]
        df = spark.createDataFrame(rows, "t string, id long")
        df = df.withColumn("ts", df.t.cast(kind))
        at = df.select("t", "id", sequence.position(df, ["ts", "id"]).alias("at"))
        assert at.schema["at"].dataType.simpleString() == "decimal(38,0)"
        assert [(r.t, r.id) for r in at.sort("at").collect()] == rows
        assert at.select("at").distinct().count() == len(rows)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_final_totals_are_hash_aggregates(spark):
    df = frame(spark, random_events(1, 50))
    plan = totals.latest_totals(df, ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_rows_without_a_sequence_are_kept(spark):
    events = random_events(9, 300, hot=0.5)
    df = frame(spark, events)
    df = df.withColumn("seq", F.when(F.col("seq") > 0, F.col("seq")))
    for rows_per_group in (20, 10_000):
        rows = totals.running_totals(df, ["seq"], rows_per_group=rows_per_group).collect()
        assert len(rows) == len(events)
        by_seq = {row.seq or 0: tuple(row[name] for name in AMOUNTS) for row in rows}
        assert [by_seq[i] for i in range(len(events))] == totals_after_each(events)


@pytest.mark.parametrize("name", ["merchant_totals_log_position", "merchant_latest_kafka_position"])
def test_real_positions_are_hashed(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan
    assert "SortAggregate" not in plan
