"""From change events to the amounts they add to their merchant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchant_ledger.functions.buckets import bucket
from merchant_ledger.functions.once import with_once
from merchant_ledger.operators.sequence import position, with_positions
from merchant_ledger.operators.slices import (
    ORDER_KEYS,
    ORDER_SLICE,
    WHOLE,
    in_order,
    is_sliced,
    with_carry,
    without_carry,
)
from merchant_ledger.schemas import CANCELLED, MERCHANT, ORDER, REFUNDED, SUCCESS


def with_previous_state(events: DataFrame, seq: Sequence[str]) -> DataFrame:
    """Add ``prev``: struct of state and amount of the order's previous change.

    Snapshot rows record no state, so rows only see rows of their own kind; ``prev`` is
    null for the first one. It is a struct so that a null amount is not taken for that.
    """
    image = F.struct("state", "amount")
    events = with_positions(events, seq)
    if not is_sliced(events):
        window = Window.partitionBy(*ORDER_KEYS).orderBy(*seq)
        return events.withColumn("prev", F.lag(image).over(window))

    keys = [*ORDER_KEYS, ORDER_SLICE]
    hot = events.filter((F.col(ORDER_SLICE) != WHOLE) & ~F.col("is_snapshot"))
    by_slice = Window.partitionBy(*ORDER_KEYS).orderBy(ORDER_SLICE)
    before = _last_states(hot, keys, seq).select(
        *keys, F.lag(image).over(by_slice).alias("before")
    )
    carry = before.filter(F.col("before").isNotNull()).select(*keys, "before.*")
    rows = with_carry(events, carry)
    window = Window.partitionBy(*keys).orderBy(*in_order(rows, seq))
    return without_carry(rows.withColumn("prev", F.lag(image).over(window)))


def delta_columns() -> dict[str, Column]:
    """What each event adds to its merchant's totals, given ``prev``.

    Snapshot: the bucket of the new state. First change of an order: only a success
    counts. Later change: the new bucket less the old one.
    """

    def delta(code: int, first: Column) -> Column:
        old = bucket(code, F.col("prev.state"), F.col("prev.amount"))
        return (
            F.when(F.col("is_snapshot"), bucket(code))
            .when(F.col("prev").isNull(), first)
            .otherwise(bucket(code) - old)
        )

    nothing = F.lit(0).cast("bigint")
    return {
        "d_success": delta(SUCCESS, bucket(SUCCESS)),
        "d_refund": delta(REFUNDED, nothing),
        "d_cancel": delta(CANCELLED, nothing),
    }


def with_deltas(events: DataFrame, seq: Sequence[str]) -> DataFrame:
    return with_previous_state(events, seq).withColumns(delta_columns()).drop("prev")


def _last_states(events: DataFrame, keys: list[str], seq: Sequence[str]) -> DataFrame:
    at = with_once(with_positions(events, seq), {"position": position(events, seq)})
    last = [F.max_by(name, "position").alias(name) for name in ("state", "amount")]
    return at.groupBy(*keys).agg(*last)


def latest_order_states(events: DataFrame, seq: Sequence[str]) -> DataFrame:
    """The state recorded for each order by its last incremental change."""
    return _last_states(events.filter(~F.col("is_snapshot")), [MERCHANT, ORDER], seq)
