"""Change envelopes (JSON text) to typed change events, good and bad ones told apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchant_ledger.functions.once import with_once
from merchant_ledger.operators.sequence import lacks_position
from merchant_ledger.schemas import CANCELLED, ENVELOPE, REFUNDED, SUCCESS

# Why a record cannot be used.
NOT_JSON = "not_json"
MISSING_IMAGE = "missing_image"
MISTYPED_VALUE = "mistyped_value"
MISSING_SNAPSHOT_FLAG = "missing_snapshot_flag"
NULL_STATE = "null_state"
NULL_AMOUNT = "null_amount"
MISSING_POSITION = "missing_position"


def parse_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add the columns ``envelope`` (null if the text is not one JSON object) and
    ``image``: the row image the operation is about.

    The text is read as a one-element array, so text after the object makes it invalid;
    by itself it would be ignored.
    """
    as_list = F.from_json(F.concat(F.lit("["), F.col(value), F.lit("]")), T.ArrayType(ENVELOPE))
    one = F.when(F.size("envelopes") == 1, F.get("envelopes", F.lit(0)))
    return (
        with_once(messages, {"envelopes": as_list})
        .withColumn("envelope", one)
        .drop("envelopes")
        .withColumn("image", row_image())
    )


def row_image() -> Column:
    """Deletes are told by the row before, everything else (also no op) by the row after."""
    return F.when(F.col("envelope.op") == "d", F.col("envelope.before")).otherwise(
        F.col("envelope.after")
    )


def snapshot_flag(snapshot_by: str = "source_flag") -> Column:
    """Whether the event is part of the table snapshot; null if that is not said.

    ``source_flag``: no source means no snapshot, else the source must carry the flag.
    ``op_r``: the operation is a snapshot read.
    """
    if snapshot_by == "op_r":
        return F.coalesce(F.col("envelope.op") == "r", F.lit(False))
    if snapshot_by != "source_flag":
        raise ValueError(f"snapshot_by must be source_flag or op_r, not {snapshot_by!r}")
    flag = F.lower("envelope.source.snapshot")
    return F.when(F.col("envelope.source").isNull(), False).when(
        ~flag.isin("", "null"), flag.isin("true", "1")
    )


def _whole_number(name: str, kind: str) -> Column:
    """Numbers and numeric text alike; a fraction is cut off."""
    return F.col(f"image.{name}").try_cast("decimal(38,6)").try_cast(kind)


def change_columns(snapshot_by: str = "source_flag") -> dict[str, Column]:
    return {
        "order_id": F.col("image.pay_order_id"),
        "mch_no": F.col("image.mch_no"),
        "amount": _whole_number("amount", "bigint"),
        "state": _whole_number("state", "int"),
        "operation": F.col("envelope.op"),
        "is_snapshot": snapshot_flag(snapshot_by),
        "ts_ms": F.col("envelope.ts_ms"),
        "db": F.col("envelope.source.db"),
        "table": F.col("envelope.source.table"),
        "file": F.col("envelope.source.file"),
        "file_no": F.regexp_extract("envelope.source.file", r"([0-9]+)$", 1).try_cast("int"),
        "pos": F.col("envelope.source.pos"),
        "row": F.col("envelope.source.row"),
    }


def has_merchant() -> Column:
    """Null and empty merchant numbers are discarded. A blank one is kept."""
    return F.coalesce(F.col("mch_no") != "", F.lit(False))


def is_mistyped(name: str) -> Column:
    text = F.col(f"image.{name}")
    return text.isNotNull() & ~text.isin("", "null") & F.col(name).isNull()


def bad_values() -> Column:
    """Null for usable values, of change events and of table rows alike. An event without
    merchant is discarded before its state and amount are looked at, so these cannot make
    it bad."""
    moves_money = F.col("state").isin(SUCCESS, CANCELLED, REFUNDED)
    return (
        F.when(~has_merchant(), F.lit(None))
        .when(F.col("state").isNull(), NULL_STATE)
        .when(moves_money & F.col("amount").isNull(), NULL_AMOUNT)
    )


def bad_reason(seq: Sequence[str] = ()) -> Column:
    """Null for a usable record. ``seq`` names the columns that an event needs for its
    place in the order; those of the table snapshot need none."""
    return (
        F.when(F.col("envelope").isNull(), NOT_JSON)
        .when(F.col("image").isNull(), MISSING_IMAGE)
        .when(is_mistyped("amount") | is_mistyped("state"), MISTYPED_VALUE)
        .when(F.col("is_snapshot").isNull(), MISSING_SNAPSHOT_FLAG)
        .when(has_merchant() & lacks_position(seq), MISSING_POSITION)
        .otherwise(bad_values())
    )


def classified(
    messages: DataFrame,
    value: str = "value",
    snapshot_by: str = "source_flag",
    seq: Sequence[str] = (),
) -> DataFrame:
    """Every message with its change columns and ``bad_reason``. Columns of ``messages``
    (an offset, an arrival time) are passed through. With ``seq``, changes that lack one of
    these columns are bad; without it, the operators that need the order fail on them."""
    parsed = with_once(parse_envelopes(messages, value), change_columns(snapshot_by))
    return with_once(parsed, {"bad_reason": bad_reason(seq)}).drop("envelope", "image")


def good_changes(records: DataFrame, on_bad: str = "fail") -> DataFrame:
    """The usable change events of ``classified`` records.

    ``fail``: the job fails at the first bad record. ``quarantine``: bad records are left
    out here; write ``quarantined(records)`` to a side table.
    """
    if on_bad not in ("fail", "quarantine"):
        raise ValueError(f"on_bad must be fail or quarantine, not {on_bad!r}")
    good = F.col("bad_reason").isNull() & has_merchant()
    if on_bad == "fail":
        message = F.concat(F.lit("bad change record: "), F.col("bad_reason"))
        failure = F.raise_error(message).cast("boolean")
        good = F.when(F.col("bad_reason").isNotNull(), failure).otherwise(has_merchant())
    return records.filter(good).drop("bad_reason")


def quarantined(records: DataFrame) -> DataFrame:
    return records.filter(F.col("bad_reason").isNotNull())


def is_discarded() -> Column:
    return F.col("bad_reason").isNull() & ~has_merchant()


def discarded(records: DataFrame) -> DataFrame:
    """Well-formed events without a merchant number."""
    return records.filter(is_discarded())


def select_table(records: DataFrame, db: str, table: str) -> DataFrame:
    """Drop records of other tables. One that names no table stays: an unreadable record
    must fail the job or reach the quarantine, not vanish here."""
    chosen = (F.col("db") == db) & (F.col("table") == table)
    return records.filter(F.coalesce(chosen, F.lit(True)))


def start_from(records: DataFrame, millis: int) -> DataFrame:
    """Drop events written before a point in time. One without a time stays."""
    return records.filter(F.coalesce(F.col("ts_ms") >= millis, F.lit(True)))
