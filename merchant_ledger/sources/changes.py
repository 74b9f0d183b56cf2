"""Where changes and table snapshots come from. Addresses and secrets are arguments; none
has a default."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_ledger.operators.parsing import bad_values, good_changes

# Defaults for reading a table in chunks.
SPLIT_SIZE = 8192
FETCH_SIZE = 2048


def change_files(spark: SparkSession, path: str) -> DataFrame:
    """Change envelopes from text files, one JSON object per line."""
    return spark.read.text(path)


def batch_limit(files: int | None = None, size: int = 1 << 30) -> dict[str, str]:
    """Bounds a micro-batch of a file stream, by number or (by default) total size of the
    files, and with it the rows one call of the stateful operator gets."""
    return {"maxFilesPerTrigger": str(files)} if files else {"maxBytesPerTrigger": str(size)}


def stream_change_files(
    spark: SparkSession, path: str, files_per_trigger: int | None = None
) -> DataFrame:
    """New files as they arrive."""
    return spark.readStream.options(**batch_limit(files_per_trigger)).text(path)


def kafka_options(
    servers: str,
    topic: str,
    start_millis: int | None = None,
    offsets_per_trigger: int = 1_000_000,
) -> dict[str, str]:
    """Options of a stream of change envelopes, from the earliest one on or from a point in
    time. The limit bounds a micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(offsets_per_trigger),
    }
    if start_millis is not None:
        options["startingTimestamp"] = str(start_millis)
        options["startingOffsetsByTimestampStrategy"] = "latest"
    return options


KAFKA_SEQ = ["partition", "offset"]


def stream_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Change envelopes of a topic. Changes of one merchant must be in one partition (the
    topic is keyed by merchant): only then is (partition, offset) their order."""
    records = spark.readStream.format("kafka").options(**options).load()
    return records.select(F.col("value").cast("string").alias("value"), *KAFKA_SEQ)


def table_options(
    url: str,
    table: str,
    key: str,
    lowest: int,
    highest: int,
    split_size: int = SPLIT_SIZE,
    fetch_size: int = FETCH_SIZE,
    columns: str = "*",
) -> dict[str, str]:
    """Options for reading a table in chunks of ``split_size`` values of its numeric key.

    Chunks are tasks, as many as the range of the key needs: the connections open at a time
    are as many as the executors have cores. For a very large range choose larger chunks.
    """
    chunks = max(1, math.ceil((highest - lowest + 1) / split_size))
    return {
        "url": url,
        "dbtable": f"(SELECT {columns} FROM {table}) AS chunked",
        "partitionColumn": key,
        "lowerBound": str(lowest),
        "upperBound": str(highest + 1),
        "numPartitions": str(chunks),
        "fetchsize": str(fetch_size),
    }


def table_snapshot(
    spark: SparkSession, options: dict[str, str], properties: dict[str, str] | None = None
) -> DataFrame:
    """The table as it is. ``properties`` holds user, password and driver."""
    return spark.read.format("jdbc").options(**{**options, **(properties or {})}).load()


def snapshot_records(rows: DataFrame) -> DataFrame:
    """Rows of the payment-order table as snapshot change events with ``bad_reason``, for
    ``quarantined`` and ``discarded`` as with change records."""
    events = rows.select(
        F.col("pay_order_id").alias("order_id"),
        "mch_no",
        "amount",
        "state",
        F.lit("r").alias("operation"),
        F.lit(True).alias("is_snapshot"),
    )
    return events.withColumn("bad_reason", bad_values())


def snapshot_changes(rows: DataFrame, on_bad: str = "fail") -> DataFrame:
    """The usable rows of the payment-order table as snapshot change events."""
    return good_changes(snapshot_records(rows), on_bad)
