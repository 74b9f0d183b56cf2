"""One order with most rows of a micro-batch is spread over tasks, with the same results."""

import pytest
from pyspark.sql import functions as F

from merchant_ledger.streaming.ledger import Ledger, start
from merchant_ledger.streaming.orders import in_slices
from merchant_ledger.streaming.states import order_states, state_sizes
from model import random_events, totals_after_each
from test_stream import ONCE, SEQ, rows_of, stream_of, write_changes


def hot_rows(spark, n=20_000):
    hot = F.col("id") % 5 < 4
    return spark.range(n).select(
        F.lit("M").alias("mch_no"),
        F.when(hot, "HOT").otherwise(F.concat(F.lit("O"), F.col("id") % 700)).alias("order_id"),
        (F.col("id") % 7).cast("int").alias("state"),
        (F.col("id") % 100).alias("amount"),
        (F.col("id") % 11 == 0).alias("is_snapshot"),
        F.col("id").alias("pos"),
    )


def test_a_hot_order_is_spread(spark):
    dealt = in_slices(hot_rows(spark), ["pos"], 100, 16)
    assert "repartition" in dealt._jdf.queryExecution().logical().toString().lower()
    hot = dealt.where("order_id = 'HOT'").withColumn("task", F.spark_partition_id())
    per_task = [r["count"] for r in hot.groupBy("task").count().collect()]
    assert len(per_task) == 16 and max(per_task) < 16_000 / 16 * 2
    # The state sees two rows of a slice at most.
    assert hot.where("edge > 0").count() <= 2 * 200
    inner = hot.where("edge = 0 and not is_snapshot").count()
    assert inner >= 16_000 * 10 // 11 - 2 * 201


@pytest.mark.parametrize("width", [1, 7, 50, 10**6])
def test_batches_equal_the_model(spark, tmp_path, width):
    events = random_events(23, 240, hot=0.8)
    ledger = Ledger(spark, str(tmp_path / "out"), SEQ, batches_per_base=2, slice_width=width)
    (tmp_path / "in").mkdir()
    for part in range(3):
        write_changes(tmp_path / "in", events[part * 80 : part * 80 + 80], part * 80)
        start(stream_of(spark, tmp_path / "in"), ledger, str(tmp_path / "checkpoint"), ONCE).awaitTermination()
        # Another width after a restart changes nothing.
        ledger.slice_width = width + part
    assert rows_of(ledger) == totals_after_each(events)


def test_states_are_readable_batch_by_batch(spark, tmp_path):
    events = [("M1", "A", 2, 10, False), ("M1", "B", 5, 20, False), ("M2", "A", 2, 5, True), ("M1", "A", 4, 30, False)]
    ledger = Ledger(spark, str(tmp_path / "out"), SEQ)
    checkpoint = str(tmp_path / "checkpoint")
    (tmp_path / "in").mkdir()
    for part in range(2):
        write_changes(tmp_path / "in", events[part * 2 : part * 2 + 2], part * 2)
        start(stream_of(spark, tmp_path / "in"), ledger, checkpoint, ONCE).awaitTermination()
    listed = lambda states: sorted(tuple(r) for r in states.collect())
    assert listed(order_states(spark, checkpoint)) == [("M1", "A", 4, 30), ("M1", "B", 5, 20)]
    assert listed(order_states(spark, checkpoint, 0)) == [("M1", "A", 2, 10), ("M1", "B", 5, 20)]
    assert listed(state_sizes(spark, checkpoint)) == [("M1", 2)]
