"""What the stream has kept, read from its checkpoint while it runs or after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_ledger.schemas import MERCHANT, ORDER


def order_states(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The last state recorded for each order: (mch_no, order_id, state, amount).

    Read in as many tasks as the state has partitions, of the last micro-batch or of one
    whose state is still there (``spark.sql.streaming.minBatchesToRetain``).
    """
    reader = spark.read.format("statestore").option("stateVarName", "orders")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    stored = reader.load(checkpoint)
    return stored.select(
        F.col(f"user_map_key.{MERCHANT}").alias(MERCHANT),
        F.col(f"user_map_key.{ORDER}").alias(ORDER),
        F.col("user_map_value.state").alias("state"),
        F.col("user_map_value.amount").alias("amount"),
    )


def state_sizes(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """How many orders are kept per merchant: the gauge of the state's size."""
    states = order_states(spark, checkpoint, batch_id)
    return states.groupBy(MERCHANT).agg(F.count("*").alias("orders"))
