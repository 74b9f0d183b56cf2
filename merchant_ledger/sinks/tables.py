"""Totals to tables and topics: rows, payloads and writer options."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_ledger.functions.messages import kafka_json
from merchant_ledger.operators.totals import in_merchant_order, with_update_time
from merchant_ledger.schemas import MERCHANT

INSERT_BATCH = 1000


def _rows(totals: DataFrame) -> DataFrame:
    return with_update_time(totals).filter(F.col(MERCHANT).isNotNull())


def jdbc_rows(totals: DataFrame) -> DataFrame:
    """Rows without a merchant are left out; a changelog gets the time at which it is sent."""
    return _rows(totals).select(MERCHANT, "net_amount", "update_time")


def write_jdbc(totals: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append with plain inserts. For a stream, call this from ``foreachBatch``.

    Each partition opens one connection: limit the partitions to what the database
    bears with ``numPartitions`` in ``properties``.
    """
    jdbc_rows(totals).write.jdbc(
        url, table, mode="append", properties={"batchsize": str(INSERT_BATCH), **properties}
    )


def kafka_rows(totals: DataFrame, seq: Sequence[str] = ()) -> DataFrame:
    """Keyed by merchant: all of a merchant's totals go to one partition of the topic, in
    order if ``seq`` is given."""
    rows = in_merchant_order(_rows(totals), seq) if seq else _rows(totals)
    return rows.select(F.col(MERCHANT).alias("key"), kafka_json().alias("value"))


def write_kafka(totals: DataFrame, servers: str, topic: str, seq: Sequence[str] = ()) -> None:
    (
        kafka_rows(totals, seq)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .save()
    )


def jdbc_sink(url: str, table: str, properties: dict[str, str]):
    """A ledger sink; a repeated micro-batch is appended again."""
    return lambda totals, batch_id: write_jdbc(totals, url, table, properties)


def kafka_sink(servers: str, topic: str, seq: Sequence[str] = ()):
    """A ledger sink; a repeated micro-batch is sent again. Give the ledger's ``seq`` for
    totals in order."""
    return lambda totals, batch_id: write_kafka(totals, servers, topic, seq)
