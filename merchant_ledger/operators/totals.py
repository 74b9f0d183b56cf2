"""Merchant totals: one row per event (running), or one row per merchant (final)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchant_ledger.functions.buckets import bucket, buckets, derived_amounts, event_type
from merchant_ledger.functions.once import with_once
from merchant_ledger.operators.sequence import position, with_positions
from merchant_ledger.operators.slices import (
    MERCHANT_SLICE,
    ORDER_SLICE,
    ROWS_PER_GROUP,
    WHOLE,
    in_order,
    is_sliced,
    slice_if_hot,
    with_carry,
    without_carry,
    written,
)
from merchant_ledger.operators.transitions import with_deltas
from merchant_ledger.schemas import (
    BUCKETS,
    CANCELLED,
    DELTAS,
    MERCHANT,
    ORDER,
    REFUNDED,
    SUCCESS,
)

SUMS = dict(zip(BUCKETS, DELTAS))


def running_sums(deltas: DataFrame, seq: Sequence[str]) -> DataFrame:
    """Replace the deltas of each event by its merchant's sums up to that event. Carry
    rows among the deltas take part in the sums and are dropped."""
    if not is_sliced(deltas):
        return _summed(deltas, [MERCHANT], seq)

    # Used twice below: for the sums of the slices, and row by row.
    deltas = written(deltas, "deltas")
    keys = [MERCHANT, MERCHANT_SLICE]
    per_slice = (
        deltas.filter(F.col(MERCHANT_SLICE) != WHOLE)
        .groupBy(*keys)
        .agg(*[F.sum(delta).alias(delta) for delta in DELTAS])
    )
    earlier = (
        Window.partitionBy(MERCHANT)
        .orderBy(MERCHANT_SLICE)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = per_slice.select(*keys, *[F.sum(delta).over(earlier).alias(delta) for delta in DELTAS])
    # The first slice of a merchant has a carry of nulls, which a sum leaves out.
    rows = with_carry(deltas, carry)
    return _summed(rows, keys, seq).drop(MERCHANT_SLICE, ORDER_SLICE)


def _summed(rows: DataFrame, keys: list[str], seq: Sequence[str]) -> DataFrame:
    window = (
        Window.partitionBy(*keys)
        .orderBy(*in_order(rows, seq))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    sums = {name: F.sum(delta).over(window) for name, delta in SUMS.items()}
    return without_carry(rows.withColumns(sums)).drop(*DELTAS)


def running_totals(
    events: DataFrame, seq: Sequence[str], rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """One output row per change event: the merchant's totals just after it.

    ``seq`` names columns that are together a strict total order of the events.
    """
    events = slice_if_hot(events, seq, rows_per_group)
    if not is_sliced(events):
        # One shuffle serves both windows: an order lies within its merchant.
        events = events.repartition(MERCHANT)
    return finish(running_sums(with_deltas(events, seq), seq))


def finish(totals: DataFrame) -> DataFrame:
    """Add gross, net and the event type; drop the inputs they came from."""
    return totals.withColumns({**derived_amounts(), "event_type": event_type()})


def order_contributions(events: DataFrame, seq: Sequence[str]) -> DataFrame:
    """Per merchant and order, the sum of all its deltas, without a sort or a window.

    The deltas of successive changes cancel: success ends at the last bucket, refund and
    cancel at the last bucket less the first. Plain aggregates are combined before the
    shuffle, so a hot order or merchant is reduced where it is read.
    """
    change = ~F.col("is_snapshot")
    # Only snapshot rows may lack a position; the order does not matter to them.
    at = with_once(with_positions(events, seq), {"position": position(events, seq)}).withColumn(
        "change_position", F.when(change, F.col("position"))
    )
    grouped = (
        at.withColumns(buckets())
        .groupBy(MERCHANT, ORDER)
        .agg(
            F.min_by("state", "change_position").alias("first_state"),
            F.min_by("amount", "change_position").alias("first_amount"),
            F.max_by("state", "change_position").alias("last_state"),
            F.max_by("amount", "change_position").alias("last_amount"),
            *[F.sum(F.when(~change, F.col(b))).alias(f"snap_{b}") for b in BUCKETS],
            F.max_by("is_snapshot", "position").alias("is_snapshot"),
            F.max("position").alias("position"),
            *[F.max_by(name, "position").alias(name) for name in seq],
        )
    )

    def amount(code: int, less_first: bool) -> Column:
        value = bucket(code, F.col("last_state"), F.col("last_amount"))
        if less_first:
            value = value - bucket(code, F.col("first_state"), F.col("first_amount"))
        return value

    sums = {
        "success_amount": amount(SUCCESS, False),
        "refund_amount": amount(REFUNDED, True),
        "cancel_amount": amount(CANCELLED, True),
    }
    return grouped.select(
        MERCHANT,
        ORDER,
        *[(_zero(f"snap_{name}") + value).alias(name) for name, value in sums.items()],
        "is_snapshot",
        "position",
        *seq,
    )


def _zero(name: str):
    return F.coalesce(F.col(name), F.lit(0))


def merchant_totals(events: DataFrame, seq: Sequence[str]) -> DataFrame:
    """Final totals per merchant (closed form)."""
    sums = [F.sum(name).alias(name) for name in BUCKETS]
    return (
        order_contributions(events, seq)
        .groupBy(MERCHANT)
        .agg(*sums)
        .withColumns(derived_amounts())
    )


def merchant_totals_from_deltas(
    events: DataFrame, seq: Sequence[str], rows_per_group: int = ROWS_PER_GROUP
) -> DataFrame:
    """Final totals per merchant as sums of deltas, as the stream computes them."""
    deltas = with_deltas(slice_if_hot(events, seq, rows_per_group), seq)
    sums = [F.sum(delta).alias(name) for name, delta in SUMS.items()]
    return deltas.groupBy(MERCHANT).agg(*sums).withColumns(derived_amounts())


def latest_totals(events: DataFrame, seq: Sequence[str]) -> DataFrame:
    """The last row of each merchant's running totals, found without running sums: it is
    the final totals with the type and position of the merchant's last event."""
    sums = [F.sum(name).alias(name) for name in BUCKETS]
    return finish(
        order_contributions(events, seq)
        .groupBy(MERCHANT)
        .agg(
            *sums,
            F.max_by("is_snapshot", "position").alias("is_snapshot"),
            *[F.max_by(name, "position").alias(name) for name in seq],
        )
    )


def snapshot_totals(events: DataFrame) -> DataFrame:
    """Totals of a table snapshot: every row counts once, in no particular order."""
    return (
        events.withColumns(buckets())
        .groupBy(MERCHANT)
        .agg(*[F.sum(name).alias(name) for name in BUCKETS])
        .withColumns(derived_amounts())
    )


def in_merchant_order(totals: DataFrame, seq: Sequence[str]) -> DataFrame:
    """A merchant's rows in one task and in order, for sinks that keep the order they get.
    The sort spills; the rows pass one by one."""
    return totals.repartition(MERCHANT).sortWithinPartitions(MERCHANT, *seq)


def with_update_time(totals: DataFrame) -> DataFrame:
    """The time of the output in epoch milliseconds, where the rows do not bring one."""
    if "update_time" in totals.columns:
        return totals
    return totals.withColumn("update_time", F.unix_millis(F.current_timestamp()))
