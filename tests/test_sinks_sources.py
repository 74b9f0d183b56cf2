"""Queue publishing with a fake client; options of the connectors."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from merchant_ledger.functions import text
from merchant_ledger.operators import parsing
from merchant_ledger.schemas import LOG_POSITION
from merchant_ledger.operators.totals import merchant_totals, snapshot_totals
from merchant_ledger.sinks.queue import Retry, publish, queue_sink, stats_messages
from merchant_ledger.sinks import lines, tables
from merchant_ledger.sources import changes
from test_text import GOLDEN, MESSAGE, NEGATIVE, TOTALS


def fake_queue(folder, failures=0, fail_on=None):
    """A client that appends to files, one per connection. The first ``failures`` attempts
    to connect fail; ``fail_on`` makes the first publish of such a body fail."""
    folder = str(folder)

    def mark(kind):
        name = os.path.join(folder, f"{kind}-{time.time_ns()}-{os.getpid()}")
        open(name, "w").close()
        return name

    def count(kind):
        return sum(name.startswith(kind) for name in os.listdir(folder))

    class FileChannel:
        def __init__(self):
            self.path = mark("connection")

        def publish(self, body):
            if fail_on and fail_on in body and not count("failed"):
                mark("failed")
                raise ConnectionError("lost")
            with open(self.path, "ab") as file:
                file.write(body + b"\n")

        def close(self):
            mark("closed")

    def connect():
        mark("attempt")
        if count("attempt") <= failures:
            raise ConnectionError("refused")
        return FileChannel()

    return connect


def published(folder):
    found = []
    for path in folder.glob("connection-*"):
        found += [json.loads(line) for line in path.read_bytes().splitlines()]
    return found


def attempts(folder):
    return len(list(folder.glob("attempt-*")))


@pytest.fixture
def totals(spark):
    return spark.createDataFrame([GOLDEN, NEGATIVE], TOTALS).coalesce(1)


def test_publish(totals, tmp_path):
    assert publish(stats_messages(totals), fake_queue(tmp_path)) == 2
    assert published(tmp_path)[0] == json.loads(MESSAGE)
    assert attempts(tmp_path) == len(list(tmp_path.glob("closed-*"))) == 1


def test_nothing_to_send_opens_no_connection(totals, tmp_path):
    assert publish(stats_messages(totals.limit(0)), fake_queue(tmp_path)) == 0
    assert attempts(tmp_path) == 0


def test_connect_retries(totals, tmp_path):
    assert publish(stats_messages(totals), fake_queue(tmp_path, failures=3), Retry(3, 1)) == 2
    assert attempts(tmp_path) == 4


def test_connect_gives_up(totals, tmp_path):
    with pytest.raises(Exception, match="refused"):
        publish(stats_messages(totals), fake_queue(tmp_path, failures=9), Retry(3, 1))
    assert attempts(tmp_path) == 4


def test_failed_publish_fails_and_a_rerun_repeats(totals, tmp_path):
    sink = queue_sink(fake_queue(tmp_path, fail_on=b"M2"), Retry(0, 1))
    with pytest.raises(Exception, match="lost"):
        sink(totals, 0)
    sink(totals, 0)
    merchants = sorted(m["mchNo"] for m in published(tmp_path))
    assert merchants == ["M001", "M001", "M2"]  # at least once


def test_update_time_is_set_at_output(spark, tmp_path):
    df = spark.createDataFrame([GOLDEN], TOTALS).drop("update_time")
    message = json.loads(stats_messages(df).first().value)
    assert abs(message["updateTime"] - time.time() * 1000) < 60_000


def test_kafka_options():
    options = changes.kafka_options("host:1", "topic", start_millis=5, offsets_per_trigger=7)
    assert options["startingTimestamp"] == "5"
    assert options["maxOffsetsPerTrigger"] == "7"
    assert "startingTimestamp" not in changes.kafka_options("host:1", "topic")


def test_table_options():
    options = changes.table_options("jdbc:x", "pay.pay_order", "id", 1, 100_000)
    assert options["numPartitions"] == "13"
    assert (options["lowerBound"], options["upperBound"]) == ("1", "100001")
    assert options["fetchsize"] == "2048"
    assert "password" not in options
    huge = changes.table_options("jdbc:x", "t", "id", 1, 10**12)
    assert huge["numPartitions"] == str(-(-(10**12) // 8192))


def test_snapshot_of_the_order_table(spark, tmp_path):
    rows = spark.range(10).select(
        F.concat(F.lit("O"), "id").alias("pay_order_id"),
        F.lit("M1").alias("mch_no"),
        F.lit(10).cast("long").alias("amount"),
        (F.col("id") % 7).cast("int").alias("state"),
    )
    rows.write.parquet(str(tmp_path / "t"))
    table = spark.read.schema("pay_order_id string, mch_no string, amount long, state int").parquet(str(tmp_path / "t"))
    row = snapshot_totals(changes.snapshot_changes(table)).first()
    assert (row.success_amount, row.cancel_amount, row.refund_amount) == (20, 10, 10)


def test_change_files_batch_and_stream_read_the_same(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"op":"u"}\n{"op":"d"}\n')
    batch = changes.change_files(spark, str(tmp_path / "in"))
    stream = changes.stream_change_files(spark, str(tmp_path / "in"))
    assert batch.count() == 2 and stream.isStreaming
    assert batch.schema == stream.schema


def test_log_files_are_ordered_by_number(spark):
    line = (
        '{"op":"u","before":null,"after":{"pay_order_id":"O","mch_no":"M","amount":%d,"state":%d},'
        '"source":{"snapshot":"false","file":"log.%s","pos":7,"row":0}}'
    )
    lines = [(line % (100, 2, "999999"),), (line % (100, 5, "1000000"),)]
    parsed = parsing.good_changes(parsing.classified(spark.createDataFrame(lines, "value string")))
    result = merchant_totals(parsed, LOG_POSITION)
    assert tuple(result.select("success_amount", "refund_amount").first()) == (0, 100)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_changelog_rows_to_kafka_and_jdbc(spark):
    row = spark.createDataFrame([("M1", 5), (None, 6)], "mch_no string, net_amount long")
    assert [r["mch_no"] for r in tables.jdbc_rows(row).collect()] == ["M1"]
    assert [r["key"] for r in tables.kafka_rows(row).collect()] == ["M1"]


def test_console_sink_prints_all(spark, capsys):
    rows = spark.createDataFrame(
        [(f"M{i}", 1, 1, 0, 0, 1, "INCREMENTAL") for i in range(50)],
        "mch_no string, total_amount long, success_amount long, refund_amount long, cancel_amount long,"
        " net_amount long, event_type string",
    )
    lines.console_sink()(rows, 0)
    assert len(capsys.readouterr().out.splitlines()) == 50


def test_a_number_that_is_no_time(spark):
    frame = spark.createDataFrame([(2**63 - 1,), (None,)], "t long")
    shown = [r[0] for r in frame.select(text.local_time("t", "none")).collect()]
    assert shown == [str(2**63 - 1), "none"]
