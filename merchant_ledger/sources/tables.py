"""Change events from the test tables, and the change envelopes that carry them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_ledger.schemas import CANCELLED, REFUNDED, SUCCESS
from merchant_ledger.sources.changes import batch_limit

SEQ = ["ts", "event_id"]
SNAPSHOT_END = "2024-01-10"
DATABASE = "pay"
TABLE = "pay_order"

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")


def stream_events(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.readStream.schema(EVENTS_SCHEMA)
        .options(**batch_limit(), pathGlobFilter="events*.parquet")
        .parquet(folder)
    )


def change_events(events: DataFrame, *keep: str) -> DataFrame:
    """``events`` as changes of payment orders; ``keep`` names columns to pass through."""
    kind = F.col("event_type")
    state = (
        F.when(kind == "purchase", SUCCESS)
        .when(kind == "error", CANCELLED)
        .when(kind == "click", REFUNDED)
        .when(kind == "signup", 0)
        .otherwise(1)
    )
    return events.select(
        "event_id",
        "ts",
        F.concat(F.lit("P"), F.col("user_id")).alias("order_id"),
        F.concat(F.lit("M"), F.col("user_id") % 20).alias("mch_no"),
        F.round(F.col("value") * 100).cast("bigint").alias("amount"),
        state.alias("state"),
        _is_snapshot().alias("is_snapshot"),
        *keep,
    )


def with_hot_order(changes: DataFrame) -> DataFrame:
    """The changes, four of five of them of one order."""
    hot = F.col("event_id") % 5 < 4
    return changes.withColumns({
        "order_id": F.when(hot, "HOT").otherwise(F.col("order_id")),
        "mch_no": F.when(hot, "M0").otherwise(F.col("mch_no")),
    })


def write_log(envelopes: DataFrame, folder: str, files: int) -> None:
    """Envelopes as the text files of a change log, each with a range of its positions."""
    envelopes.repartitionByRange(files, "event_id").select("value").write.mode("overwrite").text(folder)


def arrival() -> Column:
    """In which of four batches an event arrives: by week, and some a batch too late."""
    week = F.lit(0)
    for number, start in enumerate(("2024-01-08", "2024-01-15", "2024-01-22"), 1):
        week = F.when(F.col("ts") >= F.lit(start).cast("timestamp_ntz"), number).otherwise(week)
    late = (F.col("event_id") % 50 == 0).cast("int")
    return F.least(week + late, F.lit(3))


def _is_snapshot() -> Column:
    return F.col("ts") < F.lit(SNAPSHOT_END).cast("timestamp_ntz")


def operation() -> Column:
    return (
        F.when(F.col("is_snapshot"), "r")
        .when(F.col("event_id") % 17 == 0, "d")
        .otherwise("u")
    )


def event_millis() -> Column:
    return F.unix_millis(F.col("ts").cast("timestamp"))


def order_rows(orders: DataFrame) -> DataFrame:
    """``orders`` as a table snapshot with one row per payment order."""
    status = F.col("o_orderstatus")
    state = F.when(status == "F", SUCCESS).when(status == "O", REFUNDED).when(status == "P", CANCELLED)
    return orders.select(
        F.concat(F.lit("O"), F.col("o_orderkey")).alias("order_id"),
        F.concat(F.lit("M"), F.col("o_custkey") % 20).alias("mch_no"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount"),
        state.alias("state"),
        F.lit(True).alias("is_snapshot"),
    )


def damaged_table_rows(orders: DataFrame) -> DataFrame:
    """``orders`` as rows of the payment-order table, some without merchant or amount."""
    number = F.substring("order_id", 2, 20).cast("bigint")
    return order_rows(orders).select(
        F.col("order_id").alias("pay_order_id"),
        F.when(number % 11 == 0, "").when(number % 13 != 0, F.col("mch_no")).alias("mch_no"),
        F.when(number % 7 != 0, F.col("amount")).alias("amount"),
        "state",
    )


def to_envelopes(changes: DataFrame, file: Column | None = None) -> DataFrame:
    """One JSON change envelope per event, in the column ``value``."""
    image = F.struct(F.col("order_id").alias("pay_order_id"), "mch_no", "amount", "state")
    op = operation()
    source = F.struct(
        F.col("is_snapshot").cast("string").alias("snapshot"),
        # Every fifth event belongs to a second table of the same database.
        F.lit(DATABASE).alias("db"),
        F.when(F.col("event_id") % 5 == 4, "refund_order").otherwise(TABLE).alias("table"),
        (F.lit("log.000001") if file is None else file).alias("file"),
        F.col("event_id").alias("pos"),
        F.lit(0).alias("row"),
    )
    envelope = F.struct(
        op.alias("op"),
        F.when(op == "d", image).alias("before"),
        F.when(op != "d", image).alias("after"),
        source.alias("source"),
        event_millis().alias("ts_ms"),
    )
    return changes.select("event_id", F.to_json(envelope).alias("value"))
