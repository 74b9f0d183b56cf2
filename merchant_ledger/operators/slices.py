"""Bounding the rows of one group in an order-sensitive operator.

`lag` and running sums need the rows of a group in order, so a window puts a whole
group in one task. One merchant, or one order, may hold a third of all rows. Here the
events are cut into slices: ranges of the sequence with about the same number of rows.
A group too large for a task is then handled slice by slice. What a slice needs of the
earlier ones (the last order state, the totals so far) is put before it as one more row,
the carry row. It sorts first and is dropped after the window.

Results never depend on where the cuts are, only the balance does.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchant_ledger.schemas import MERCHANT, ORDER
from merchant_ledger.session import shared_folder

# A window task sorts and spills this many narrow rows without trouble.
ROWS_PER_GROUP = 4_000_000
# A group above that is cut finer still, to keep all cores busy.
SLICES_PER_GROUP = 4
# A range of the sequence that one task cuts has at least about so many rows.
ROWS_PER_RANGE = ROWS_PER_GROUP // SLICES_PER_GROUP
# Hot keys are broadcast up to this many; more are joined by a shuffle.
BROADCAST_KEYS = 20_000

# The key with the most values first: rows are told apart sooner when they are sorted.
ORDER_KEYS = [ORDER, MERCHANT, "is_snapshot"]
ORDER_SLICE = "order_slice"
MERCHANT_SLICE = "merchant_slice"
CARRY = "is_carry"
# Slice of all rows of a group that needs no cutting.
WHOLE = -1


def is_sliced(events: DataFrame) -> bool:
    return MERCHANT_SLICE in events.columns


def slice_if_hot(
    events: DataFrame,
    seq: Sequence[str],
    rows_per_group: int = ROWS_PER_GROUP,
    by_order: bool = True,
) -> DataFrame:
    """Return ``events`` unchanged if no merchant has more than ``rows_per_group``
    rows, else a copy with the columns ``merchant_slice`` and (``by_order``) ``order_slice``.

    The checks are a row count (parquet metadata) and, for large inputs only, a count
    per merchant. An order is never larger than its merchant, so orders are counted
    only when some merchant is hot, and only those of hot merchants. Events that are dear
    to compute (parsed JSON) are better written to a table first.
    """
    rows = events.count()
    if rows <= rows_per_group:
        return events
    counts = events.groupBy(MERCHANT).count()
    hot_merchants = counts.agg(F.count_if(F.col("count") > rows_per_group)).first()[0]
    if not hot_merchants:
        return events
    sliced = _even_slices(events, seq, math.ceil(rows * SLICES_PER_GROUP / rows_per_group), rows)
    sliced = _slice_hot(sliced, sliced, [MERCHANT], MERCHANT_SLICE, rows_per_group, hot_merchants)
    if by_order:
        of_hot = sliced.filter(F.col(MERCHANT_SLICE) != WHOLE)
        most = rows // rows_per_group
        sliced = _slice_hot(sliced, of_hot, ORDER_KEYS, ORDER_SLICE, rows_per_group, most)
    return sliced.drop("slice")


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, safe from lost executors."""
    folder = shared_folder(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _even_slices(events: DataFrame, seq: Sequence[str], slices: int, rows: int) -> DataFrame:
    """Number the ranges of a range partitioning. They are written, because the cuts come
    from a sample: every later read must see the same ones.

    Tasks and files are no more than the rows need, however small the slices are: a task
    sorts its range then, and cuts it by the number of rows.
    """
    tasks = max(events.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_RANGE))
    ranges = events.repartitionByRange(min(slices, tasks), *seq)
    number = F.spark_partition_id()
    if tasks < slices:
        ranges = ranges.sortWithinPartitions(*seq)
        size = math.ceil(rows / slices)
        # The lower 33 bits of this id count the rows of a task, in their order.
        at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        number = number.cast("bigint") * math.ceil(rows / size) + F.floor(at / size)
    return written(ranges.withColumn("slice", number), "slices")


def _slice_hot(
    events: DataFrame, counted: DataFrame, keys: list[str], name: str, limit: int, hot_keys: int
) -> DataFrame:
    """Add the slice for rows of hot keys, ``WHOLE`` for all others. There are at most
    ``hot_keys`` keys with more than ``limit`` rows; they are broadcast if these are few."""
    counts = counted.groupBy(*keys).count()
    hot = counts.filter(F.col("count") > limit).select(*keys, F.lit(True).alias("is_hot"))
    if hot_keys <= BROADCAST_KEYS:
        hot = F.broadcast(hot)
    same_key = [F.col(f"events.{key}").eqNullSafe(F.col(f"hot.{key}")) for key in keys]
    return (
        events.alias("events")
        .join(hot.alias("hot"), same_key, "left")
        .select(
            "events.*",
            F.when(F.col("is_hot"), F.col("slice")).otherwise(WHOLE).alias(name),
        )
    )


def with_carry(rows: DataFrame, carry: DataFrame) -> DataFrame:
    """Put the carry rows, which lack most other columns, among the rows."""
    marked = rows if CARRY in rows.columns else rows.withColumn(CARRY, F.lit(False))
    return marked.unionByName(carry.withColumn(CARRY, F.lit(True)), allowMissingColumns=True)


def without_carry(rows: DataFrame) -> DataFrame:
    return rows.filter(~F.col(CARRY)).drop(CARRY) if CARRY in rows.columns else rows


def in_order(rows: DataFrame, seq: Sequence[str]) -> list[Column]:
    """The window order: carry rows first, then the sequence."""
    first = [F.col(CARRY).desc()] if CARRY in rows.columns else []
    return [*first, *[F.col(name) for name in seq]]
