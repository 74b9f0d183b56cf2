"""What the stream keeps stays small: closed batches, the latest table, states with a time to live."""

import os
import time

from merchant_ledger.streaming.latest import LatestTable
from merchant_ledger.streaming.ledger import Ledger, start
from model import random_events, totals_after_each
from test_stream import AMOUNTS, ONCE, SEQ, rows_of, stream_of, write_changes


def files_below(folder):
    return [os.path.join(at, f) for at, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]


def again(spark, ledger, batch_id):
    """Apply a batch once more, as after a failure."""
    deltas = ledger._read("deltas", batch_id)
    ledger.apply(spark.createDataFrame(deltas.collect(), deltas.schema), batch_id)


def test_closed_batches_are_merged(spark, tmp_path):
    events = random_events(31, 140, hot=0.2)
    ledger = Ledger(spark, str(tmp_path / "out"), SEQ, batches_per_base=2)
    (tmp_path / "in").mkdir()
    for part in range(7):
        write_changes(tmp_path / "in", events[part * 20 : part * 20 + 20], part * 20, f"{part}")
        os.utime(tmp_path / "in" / f"{part}.json", (1_000_000 + part, 1_000_000 + part))
    start(stream_of(spark, tmp_path / "in"), ledger, str(tmp_path / "checkpoint"), ONCE).awaitTermination()
    assert rows_of(ledger) == totals_after_each(events)
    assert ledger.merged() == 5 and ledger.last_batch() == 6
    there = {name: sorted(os.listdir(tmp_path / "out" / name)) for name in ("changelog", "sums", "deltas", "base", "ranges")}
    assert there["changelog"] == [f"batch_id={i}" for i in (4, 5, 6)]
    assert there["sums"] == [f"batch_id={i}" for i in (4, 5, 6)]
    assert there["deltas"] == ["batch_id=6"]
    assert there["base"] == ["batch_id=3", "batch_id=5"]
    assert len(there["ranges"]) == 3
    again(spark, ledger, 6)
    assert rows_of(ledger) == totals_after_each(events)
    last = {r["mch_no"]: tuple(r[n] for n in AMOUNTS) for r in ledger.totals().collect()}
    expected = {}
    for event, row in zip(events, totals_after_each(events)):
        expected[event[0]] = row
    assert last == expected


def test_a_group_closed_twice(spark, tmp_path):
    events = random_events(32, 60)
    ledger = Ledger(spark, str(tmp_path / "out"), SEQ, batches_per_base=1)
    (tmp_path / "in").mkdir()
    for part in range(3):
        write_changes(tmp_path / "in", events[part * 20 : part * 20 + 20], part * 20)
        start(stream_of(spark, tmp_path / "in"), ledger, str(tmp_path / "checkpoint"), ONCE).awaitTermination()
    again(spark, ledger, 2)
    assert rows_of(ledger) == totals_after_each(events)


def test_latest_table_over_batches_and_a_rerun(spark, tmp_path):
    events = random_events(33, 120, merchants=9, hot=0.3)
    latest = LatestTable(spark, str(tmp_path / "latest"), SEQ, buckets=3)
    ledger = Ledger(spark, str(tmp_path / "out"), SEQ, sinks=[latest])
    (tmp_path / "in").mkdir()
    expected = {}
    for part in range(4):
        write_changes(tmp_path / "in", events[part * 30 : part * 30 + 30], part * 30)
        start(stream_of(spark, tmp_path / "in"), ledger, str(tmp_path / "checkpoint"), ONCE).awaitTermination()
        for event, row in list(zip(events, totals_after_each(events)))[part * 30 : part * 30 + 30]:
            expected[event[0]] = row
        for _ in range(2):
            found = {r["mch_no"]: tuple(r[n] for n in AMOUNTS) for r in latest.table().collect()}
            assert found == expected
            latest(ledger._read("changelog", part), part)
    versions = latest._versions()
    assert set(versions) <= {0, 1, 2} and all(len(v) <= 2 for v in versions.values())


def test_only_touched_buckets_are_written(spark, tmp_path):
    latest = LatestTable(spark, str(tmp_path / "latest"), ["pos"], buckets=16)
    rows = lambda first, last: spark.range(first, last).selectExpr(
        "concat('M', id) AS mch_no", "'O' AS order_id", "id AS pos", "id AS net_amount"
    )
    latest(rows(0, 200), 0)
    latest(rows(7, 8), 1)
    assert len(os.listdir(tmp_path / "latest" / "batch_id=0")) > 10
    assert [n for n in os.listdir(tmp_path / "latest" / "batch_id=1") if n.startswith("bucket")] != []
    assert len([n for n in os.listdir(tmp_path / "latest" / "batch_id=1") if n.startswith("bucket")]) == 1
    assert latest.table().count() == 200


def test_an_order_that_expired_is_new(spark, tmp_path):
    events = [("M", "A", 5, 10, False), ("M", "A", 2, 30, False)]
    rows = {}
    for name, ttl in (("kept", None), ("forgotten", 500)):
        place = tmp_path / name
        (place / "in").mkdir(parents=True)
        for part in range(2):
            ledger = Ledger(spark, str(place / "out"), SEQ, ttl_ms=ttl if part == 0 else None)
            write_changes(place / "in", events[part : part + 1], part)
            start(stream_of(spark, place / "in"), ledger, str(place / "checkpoint"), ONCE).awaitTermination()
            time.sleep(1)
        rows[name] = rows_of(ledger)[-1]
    # success, refund: known, the refund is taken back; unknown, only the success counts.
    assert rows["kept"][1:3] == (30, -10)
    assert rows["forgotten"][1:3] == (30, 0)
