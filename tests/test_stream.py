"""The stream equals the model, also after a stop, a failure, and a hand-over."""

import json
import time
import uuid

import pytest

from merchant_ledger.operators import parsing, totals
from merchant_ledger.sources import changes
from merchant_ledger.streaming.ledger import Ledger, hand_over, run_for, start
from merchant_ledger.streaming.metrics import EventCounters, observed_records
from model import random_events, totals_after_each

AMOUNTS = ["total_amount", "success_amount", "refund_amount", "cancel_amount", "net_amount"]
SEQ = ["file", "pos", "row"]
ONCE = {"availableNow": True}


def write_changes(folder, events, start_at=0, name=None):
    """One file of envelopes, in an order of its own: the sequence is in the envelope."""
    lines = []
    for i, (merchant, order, state, amount, snapshot) in enumerate(events, start_at):
        image = {"pay_order_id": order, "mch_no": merchant, "amount": amount, "state": state}
        source = {"snapshot": str(snapshot).lower(), "file": "log.1", "pos": i, "row": 0}
        lines.append(json.dumps({"op": "u", "after": image, "source": source, "ts_ms": i}))
    lines.reverse()
    folder.mkdir(exist_ok=True)
    target = folder / f"{name or uuid.uuid4().hex}.json"
    target.write_text("\n".join(lines) + "\n")


def stream_of(spark, folder, files_per_trigger=1):
    lines = changes.stream_change_files(spark, str(folder), files_per_trigger)
    good = parsing.good_changes(observed_records(parsing.classified(lines)))
    keep = ["mch_no", "order_id", "state", "amount", "is_snapshot", "ts_ms", *SEQ]
    return good.select(*keep)


def rows_of(ledger):
    rows = sorted(ledger.changelog().collect(), key=lambda row: row.pos)
    return [tuple(row[name] for name in AMOUNTS) for row in rows]


@pytest.fixture
def place(tmp_path):
    (tmp_path / "in").mkdir()
    return tmp_path


def run(spark, place, ledger):
    query = start(stream_of(spark, place / "in"), ledger, str(place / "checkpoint"), ONCE)
    query.awaitTermination()
    return query


def test_batches_and_restart(spark, place):
    events = random_events(11, 300, hot=0.3)
    ledger = Ledger(spark, str(place / "out"), SEQ, batches_per_base=2)
    for part in range(2):
        write_changes(place / "in", events[part * 100 : part * 100 + 100], part * 100, f"a{part}")
        if part == 0:
            run(spark, place, ledger)
    query = run(spark, place, ledger)
    counters = EventCounters()
    for progress in query.recentProgress:
        counters.add(progress)
    snapshots = sum(e[4] for e in events[100:200])
    assert counters.counts == {
        "snapshot_events_total": snapshots,
        "incremental_events_total": 100 - snapshots,
        "output_records_total": 100,
        "bad_records_total": 0,
        "discarded_events_total": 0,
    }
    assert counters.state_rows == len({e[:2] for e in events[:200] if not e[4]})

    write_changes(place / "in", events[200:], 200, "b")
    # A ledger object of a new process, small groups: the path for hot merchants.
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    later = Ledger(spark, str(place / "out"), SEQ, rows_per_group=30, batches_per_base=9)
    assert later.shards() == ledger.shards()
    run(spark, place, later)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    expected = totals_after_each(events)
    assert rows_of(later) == expected
    last = {event[0]: total for event, total in zip(events, expected)}
    assert {r.mch_no: tuple(r[n] for n in AMOUNTS) for r in later.totals().collect()} == last


def test_failed_batch_is_replaced(spark, place):
    events = random_events(12, 60)
    write_changes(place / "in", events)
    seen = []

    def failing_once(changelog, batch_id):
        seen.append((batch_id, changelog.count()))
        if len(seen) == 1:
            raise RuntimeError("sink is down")

    ledger = Ledger(spark, str(place / "out"), SEQ, sinks=[failing_once])
    with pytest.raises(Exception, match="sink is down"):
        run(spark, place, ledger)
    run(spark, place, ledger)
    assert seen == [(0, 60), (0, 60)]
    assert rows_of(ledger) == totals_after_each(events)


def test_hand_over(spark, place):
    snapshot = [(m, f"S{i}", s, a or 0, True) for i, (m, _, s, a, _) in enumerate(random_events(13, 80))]
    events = random_events(14, 80, snapshot_share=0)
    write_changes(place / "in", events)
    schema = "mch_no string, order_id string, state int, amount long, is_snapshot boolean"
    seen = {}
    sink = lambda changelog, batch_id: seen.update({batch_id: changelog.count()})
    ledger = Ledger(spark, str(place / "out"), SEQ, sinks=[sink])
    stream = stream_of(spark, place / "in")
    query = hand_over(
        spark.createDataFrame(snapshot, schema), stream, ledger, str(place / "checkpoint"), ONCE
    )
    query.awaitTermination()
    snapshot.sort(key=lambda row: row[1])
    expected = totals_after_each(snapshot + events)
    rows = ledger.changelog().sort("batch_id", "pos", "order_id").collect()
    assert [tuple(row[name] for name in AMOUNTS) for row in rows] == expected
    assert [row.event_type for row in rows] == ["SNAPSHOT"] * 80 + ["INCREMENTAL"] * 80
    assert seen == {-1: 80, 0: 80}
    assert {row.update_time is None for row in rows} == {False}
    last = {event[0]: total for event, total in zip(snapshot + events, expected)}
    assert {r.mch_no: tuple(r[n] for n in AMOUNTS) for r in ledger.totals().collect()} == last


def test_a_ledger_belongs_to_one_checkpoint(spark, place):
    write_changes(place / "in", random_events(17, 10))
    ledger = Ledger(spark, str(place / "out"), SEQ)
    run(spark, place, ledger)
    stream = stream_of(spark, place / "in")
    with pytest.raises(ValueError, match="belongs to"):
        start(stream, ledger, str(place / "other"), ONCE)
    with pytest.raises(ValueError, match="has batches"):
        hand_over(stream, stream, ledger, str(place / "checkpoint"), ONCE)
    (place / "checkpoint").rename(place / "gone")
    with pytest.raises(ValueError, match="no checkpoint"):
        start(stream, ledger, str(place / "checkpoint"), ONCE)


def test_snapshot_rows_are_validated(spark):
    rows = [("A", "M1", 5, 2), ("B", "", 5, 2), ("C", None, 5, 2), ("D", "M1", None, 2), ("E", "M1", 5, None)]
    table = spark.createDataFrame(rows, "pay_order_id string, mch_no string, amount long, state int")
    good = changes.snapshot_changes(table, on_bad="quarantine")
    assert [row.order_id for row in good.collect()] == ["A"]
    bad = parsing.quarantined(changes.snapshot_records(table)).sort("order_id").collect()
    assert [(row.order_id, row.bad_reason) for row in bad] == [("D", "null_amount"), ("E", "null_state")]
    assert parsing.discarded(changes.snapshot_records(table)).count() == 2
    with pytest.raises(Exception, match="bad change record"):
        changes.snapshot_changes(table).collect()


def test_a_change_without_a_position_fails_everywhere(spark):
    schema = "mch_no string, order_id string, state int, amount long, is_snapshot boolean, seq long"
    rows = spark.createDataFrame([("M", "O", 2, 1, False, 1), ("M", "O", 5, 1, False, None)], schema)
    for form in (totals.running_totals, totals.merchant_totals, totals.latest_totals):
        with pytest.raises(Exception, match="without a position"):
            form(rows, ["seq"]).collect()
    lines = spark.createDataFrame(
        [(json.dumps({"op": "u", "after": {"mch_no": "M", "pay_order_id": "O", "amount": 1, "state": 2}}),)],
        "value string",
    )
    reasons = [parsing.classified(lines, seq=seq).first().bad_reason for seq in ([], SEQ)]
    assert reasons == [None, "missing_position"]


def test_bad_record_stops_the_stream(spark, place):
    (place / "in" / "x.json").write_text("nope\n")
    with pytest.raises(Exception, match="bad change record"):
        run(spark, place, Ledger(spark, str(place / "out"), SEQ))


def test_run_for_stops_an_endless_query(spark, place):
    events = [*random_events(15, 20, snapshot_share=0), ("", "O1", 2, 5, False)]
    write_changes(place / "in", events)
    ledger = Ledger(spark, str(place / "out"), SEQ)
    counters = EventCounters()
    spark.streams.addListener(counters)
    try:
        query = start(stream_of(spark, place / "in"), ledger, str(place / "checkpoint"))
        query.processAllAvailable()
        run_for(query, 1)
        assert not query.isActive
        assert ledger.changelog().count() == 20
        for _ in range(100):
            if counters.counts["output_records_total"]:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(counters)
    assert counters.counts["incremental_events_total"] == 20
    assert counters.counts["discarded_events_total"] == 1
    assert counters.counts["bad_records_total"] == 0


def test_stream_equals_batch(spark, place):
    events = random_events(16, 120, hot=0.5)
    write_changes(place / "in", events[:70], 0, "a")
    write_changes(place / "in", events[70:], 70, "b")
    ledger = Ledger(spark, str(place / "out"), SEQ)
    query = start(stream_of(spark, place / "in", 10), ledger, str(place / "checkpoint"), ONCE)
    query.awaitTermination()
    lines = changes.change_files(spark, str(place / "in"))
    batch = parsing.good_changes(parsing.classified(lines)).select(
        "mch_no", "order_id", "state", "amount", "is_snapshot", *SEQ
    )
    expected = totals.running_totals(batch, SEQ).sort("pos").collect()
    assert rows_of(ledger) == [tuple(row[name] for name in AMOUNTS) for row in expected]
