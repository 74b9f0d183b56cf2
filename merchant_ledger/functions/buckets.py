"""Column expressions for money buckets and the amounts derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchant_ledger.schemas import CANCELLED, INCREMENTAL, REFUNDED, SNAPSHOT, SUCCESS


def bucket(code: int, state: Column | None = None, amount: Column | None = None) -> Column:
    """The amount if the order is in state ``code``, else 0."""
    state = F.col("state") if state is None else state
    amount = F.col("amount") if amount is None else amount
    return F.when(state == code, amount).otherwise(F.lit(0).cast("bigint"))


def buckets() -> dict[str, Column]:
    return {
        "success_amount": bucket(SUCCESS),
        "refund_amount": bucket(REFUNDED),
        "cancel_amount": bucket(CANCELLED),
    }


def derived_amounts() -> dict[str, Column]:
    """Gross and net. A refunded order has left success and is subtracted again
    as a refund: that is the defined meaning of net."""
    s, r, c = F.col("success_amount"), F.col("refund_amount"), F.col("cancel_amount")
    return {"total_amount": s + r + c, "net_amount": s - r - c}


def event_type() -> Column:
    return F.when(F.col("is_snapshot"), SNAPSHOT).otherwise(INCREMENTAL)
