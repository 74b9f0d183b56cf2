"""The outbox: order for a hot merchant, and nothing sent twice after a failure."""

import json
import os
import time
from collections import Counter

import pytest

from merchant_ledger.sinks.outbox import Outbox
from merchant_ledger.sinks.queue import Retry

TOTALS = (
    "mch_no string, total_amount long, success_amount long, refund_amount long, cancel_amount long, "
    "net_amount long, update_time long, event_type string, pos long"
)


def queue(folder, fail_at=()):
    """Messages in a file per connection, with the time of each; fails once at each of some positions."""
    folder = str(folder)

    class FileChannel:
        def __init__(self):
            self.path = os.path.join(folder, f"connection-{time.time_ns()}-{os.getpid()}")
            open(self.path, "w").close()

        def publish(self, body, key=None):
            pos = json.loads(key)["pos"]
            mark = os.path.join(folder, f"failed-{pos}")
            if pos in fail_at and not os.path.exists(mark):
                open(mark, "w").close()
                raise ConnectionError("lost")
            with open(self.path, "a") as file:
                file.write(json.dumps([time.time_ns(), json.loads(key), json.loads(body)["mchNo"]]) + "\n")

        def close(self):
            pass

    return FileChannel


def published(folder):
    found = []
    for path in folder.glob("connection-*"):
        found += [(t, key["mch_no"], key["pos"]) for t, key, _ in map(json.loads, path.read_text().splitlines())]
    return [(merchant, pos) for _, merchant, pos in sorted(found)]


def rows(spark, merchants):
    made = [(m, 1, 1, 0, 0, 1, 5, "INCREMENTAL", i) for i, m in enumerate(merchants)]
    return spark.createDataFrame(made, TOTALS)


def in_order(sent):
    by_merchant = {}
    for merchant, pos in sent:
        by_merchant.setdefault(merchant, []).append(pos)
    return all(places == sorted(places) for places in by_merchant.values())


def test_a_hot_merchant_in_slices(spark, tmp_path):
    (tmp_path / "q").mkdir()
    merchants = ["HOT" if i % 10 < 8 else f"M{i % 7}" for i in range(300)] + [None]
    outbox = Outbox(spark, str(tmp_path / "out"), queue(tmp_path / "q"), ["pos"], rows_per_task=60)
    outbox(rows(spark, merchants), 0)
    sent = published(tmp_path / "q")
    assert Counter(sent) == Counter((m, i) for i, m in enumerate(merchants) if m)
    assert in_order(sent)
    sizes = [len(path.read_text().splitlines()) for path in (tmp_path / "q").glob("connection-*")]
    assert max(sizes) < 120


@pytest.mark.parametrize("rows_per_task", [1000, 80])
def test_failures_send_nothing_twice(spark, tmp_path, rows_per_task):
    (tmp_path / "q").mkdir()
    merchants = ["HOT" if i % 4 else f"M{i % 5}" for i in range(120)]
    totals = rows(spark, merchants)
    failures = 0
    for _ in range(10):
        outbox = Outbox(
            spark, str(tmp_path / "out"), queue(tmp_path / "q", fail_at=(9, 64)), ["pos"], Retry(0, 1), rows_per_task
        )
        try:
            outbox(totals, 3)
            break
        except ConnectionError as error:
            assert "lost" in str(error)
            failures += 1
    assert failures >= 2
    sent = published(tmp_path / "q")
    assert Counter(sent) == Counter((m, i) for i, m in enumerate(merchants)) and in_order(sent)
    # The batch once more, as after a failure behind the sink.
    outbox(totals, 3)
    assert published(tmp_path / "q") == sent
    outbox(totals, 4)
    assert len(published(tmp_path / "q")) == 240
    assert os.listdir(tmp_path / "out" / "messages") == ["batch_id=4"]


def test_an_empty_batch(spark, tmp_path):
    (tmp_path / "q").mkdir()
    Outbox(spark, str(tmp_path / "out"), queue(tmp_path / "q"), ["pos"])(rows(spark, []), 0)
    assert published(tmp_path / "q") == []
