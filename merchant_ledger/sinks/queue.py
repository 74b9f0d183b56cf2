"""Totals to a message queue. The client of the queue is the caller's: here is what to
send, how to connect again, and how often.

Delivery is at least once: a task or micro-batch that runs again publishes again. With the
sequence columns given, a merchant's messages are sent in order by one task, each with a key
(merchant and sequence, as JSON) by which readers can drop repeats.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_ledger.functions.messages import stats_json
from merchant_ledger.operators.totals import in_merchant_order, with_update_time
from merchant_ledger.schemas import MERCHANT

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Channel(Protocol):
    """An open connection to one queue."""

    def publish(self, body: bytes, key: str | None = None) -> None: ...

    def close(self) -> None: ...


@dataclass(frozen=True)
class Retry:
    # Defaults for opening a connection. One attempt, then the retries.
    max_retries: int = 3
    interval_millis: int = 1000

    def connect(self, connect: Callable[[], Channel]) -> Channel:
        for attempt in range(self.max_retries + 1):
            try:
                return connect()
            except Exception:
                if attempt == self.max_retries:
                    raise
                time.sleep(self.interval_millis / 1000)
        raise ValueError("max_retries must not be negative")


def stats_messages(totals: DataFrame, seq: Sequence[str] = ()) -> DataFrame:
    """One JSON message per row, in the column ``value``; with ``seq`` also its ``key``, and
    the rows of a merchant in order."""
    rows = with_update_time(totals).filter(F.col(MERCHANT).isNotNull())
    if not seq:
        return rows.select(stats_json().alias("value"))
    key = F.to_json(F.struct(MERCHANT, *seq))
    return in_merchant_order(rows, seq).select(stats_json().alias("value"), key.alias("key"))


def publish(messages: DataFrame, connect: Callable[[], Channel], retry: Retry = Retry()) -> int:
    """Publish ``value`` of each row (and its ``key``, if there is one) from the executors,
    in the order of the rows of a partition; returns how many were sent.

    A failed publish fails its task: the message is not sent again in place, the task is
    retried by Spark with a new connection, and a stream goes back to its checkpoint.
    """

    columns = [name for name in ("value", "key") if name in messages.columns]

    def publish_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        channel, sent = None, 0
        try:
            for batch in batches:
                for value, *key in zip(*[column.to_pylist() for column in batch.columns]):
                    channel = channel or retry.connect(connect)
                    channel.publish(value.encode("utf-8"), *key)
                    sent += 1
        finally:
            if channel is not None:
                channel.close()
        yield pa.RecordBatch.from_pydict({"sent": pa.array([sent], pa.int64())})

    sent = messages.select(*columns).mapInArrow(publish_partition, "sent bigint")
    return sent.agg(F.sum("sent")).first()[0] or 0


def queue_sink(connect: Callable[[], Channel], retry: Retry = Retry(), seq: Sequence[str] = ()):
    """A ledger sink: publishes the totals of each micro-batch. Give the ledger's ``seq`` for
    messages in order."""

    def send(totals: DataFrame, batch_id: int) -> None:
        publish(stats_messages(totals, seq), connect, retry)

    return send
