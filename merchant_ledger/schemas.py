"""Schemas of the inputs and outputs. Nothing here is ever inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

# Order state codes that move money.
SUCCESS = 2
CANCELLED = 4
REFUNDED = 5

# The event types written to the totals.
SNAPSHOT = "SNAPSHOT"
INCREMENTAL = "INCREMENTAL"

# The keys of the running totals, and of the order states below them.
MERCHANT = "mch_no"
ORDER = "order_id"

BUCKETS = ["success_amount", "refund_amount", "cancel_amount"]
DELTAS = ["d_success", "d_refund", "d_cancel"]

# Columns every order-sensitive operator reads, besides the sequence columns.
CHANGE_COLUMNS = [MERCHANT, ORDER, "state", "amount", "is_snapshot"]


def struct(**fields: T.DataType | str) -> T.StructType:
    """A struct type from ``name="long"`` pairs; needs no running session."""
    built = T.StructType()
    for name, kind in fields.items():
        built = built.add(name, kind)
    return built


def _each(kind: str, names: str) -> dict[str, str]:
    return {name: kind for name in names.split()}


# The fields of a payment order that the totals read. Numbers are read as text and cast one by one, so that one mistyped value is
# told apart from an envelope that is no JSON at all.
ORDER_IMAGE = struct(pay_order_id="string", mch_no="string", amount="string", state="string")

ENVELOPE = struct(
    op="string",
    before=ORDER_IMAGE,
    after=ORDER_IMAGE,
    source=struct(
        snapshot="string", db="string", table="string", file="string", pos="long", row="integer"
    ),
    ts_ms="long",
)

# Sequence columns of parsed envelopes: the position in the change log. Files are ordered by
# the number that their names end with; as text, 999999 would come after 1000000.
LOG_POSITION = ["file_no", "pos", "row"]

# Fixed values. The message contract: one JSON object per changed total.
STATS_MESSAGE = struct(
    mchNo="string",
    **_each("long", "totalAmount successAmount refundAmount cancelAmount netAmount updateTime"),
    eventType="string",
)
