"""Running stored events through the streaming job, to its end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_ledger.operators.parsing import good_changes
from merchant_ledger.session import shared_folder
from merchant_ledger.sources import tables
from merchant_ledger.sources.changes import batch_limit, snapshot_records
from merchant_ledger.streaming.latest import LatestTable
from merchant_ledger.streaming.ledger import Ledger, hand_over, start
from merchant_ledger.streaming.redelivery import ATTEMPT, Redelivery

ALL = {"availableNow": True}


def ledger_of(spark: SparkSession, folder: str, **options) -> Ledger:
    """The ledger of all events below ``folder``."""
    target = shared_folder(spark, "ledger")
    ledger = Ledger(spark, target, tables.SEQ, **options)
    changes = tables.change_events(tables.stream_events(spark, folder))
    query = start(changes, ledger, f"{target}/checkpoint", ALL)
    query.awaitTermination()
    return ledger


def ledger_of_hot_order(spark: SparkSession, folder: str, slice_width: int) -> Ledger:
    """The ledger of all events, four of five of which are one order's."""
    target = shared_folder(spark, "ledger")
    ledger = Ledger(spark, target, tables.SEQ, slice_width=slice_width)
    changes = tables.with_hot_order(tables.change_events(tables.stream_events(spark, folder)))
    start(changes, ledger, f"{target}/checkpoint", ALL).awaitTermination()
    return ledger


def redelivery_of(spark: SparkSession, messages: DataFrame) -> Redelivery:
    """All messages offered until each is handled, rejected or dead. Those with a number that
    is 2 modulo 4 are refused at first."""
    source, target = shared_folder(spark, "messages"), shared_folder(spark, "redelivery")
    messages.write.parquet(source)
    refused = (F.col("event_id") % 4 == 2) & (F.col(ATTEMPT) == 0)
    queue = Redelivery(spark, target, ["event_id"], messages.schema, refused)
    queue.run(spark.readStream.schema(messages.schema).options(**batch_limit()).parquet(source), f"{target}/checkpoint")
    return queue


ARRIVALS = 4


def ledger_of_arrivals(spark: SparkSession, folder: str, **options) -> Ledger:
    """The ledger of all events, which arrive in four batches. After each the stream stops
    and starts again. Late events count when they arrive."""
    source, target = shared_folder(spark, "arrivals"), shared_folder(spark, "ledger")
    ledger = Ledger(spark, target, ["arrival", *tables.SEQ], **options)
    events = tables.read_events(spark, folder).withColumn("arrival", tables.arrival())
    for number in range(ARRIVALS):
        events.filter(F.col("arrival") == number).write.mode("append").parquet(source)
        arrived = spark.readStream.schema(events.schema).parquet(source)
        changes = tables.change_events(arrived, "arrival")
        start(changes, ledger, f"{target}/checkpoint", ALL).awaitTermination()
    return ledger


def latest_of_arrivals(spark: SparkSession, folder: str) -> LatestTable:
    """The table of latest totals after events that arrive in four batches."""
    latest = LatestTable(spark, shared_folder(spark, "latest"), ["arrival", *tables.SEQ], buckets=4)
    ledger_of_arrivals(spark, folder, sinks=[latest])
    return latest


def ledger_after_hand_over(spark: SparkSession, folder: str, **options) -> Ledger:
    """The orders as a table snapshot, with bad rows left out, then the changes."""
    target = shared_folder(spark, "ledger")
    ledger = Ledger(spark, target, tables.SEQ, **options)
    rows = tables.damaged_table_rows(spark.read.parquet(f"{folder}/orders.parquet"))
    snapshot = good_changes(snapshot_records(rows), on_bad="quarantine")
    changes = tables.change_events(tables.stream_events(spark, folder)).filter("not is_snapshot")
    hand_over(snapshot, changes, ledger, f"{target}/checkpoint", ALL).awaitTermination()
    return ledger
