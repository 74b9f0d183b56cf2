"""Totals as JSON messages, and messages as totals and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from merchant_ledger.functions.text import (
    NO_MERCHANT,
    NO_TIME_REPORT,
    NO_TYPE,
    REPORT_LABELS,
    TIME_RANGE,
    ZONE,
    local_time,
    yuan,
)

# Message field -> column of the totals.
FIELDS = {
    "mchNo": "mch_no",
    "totalAmount": "total_amount",
    "successAmount": "success_amount",
    "refundAmount": "refund_amount",
    "cancelAmount": "cancel_amount",
    "netAmount": "net_amount",
    "updateTime": "update_time",
    "eventType": "event_type",
}
AMOUNT_FIELDS = [name for name in FIELDS if name.endswith("Amount")]


def stats_json(fields: list[str] | None = None) -> Column:
    """One totals row as a JSON object; null values are left out."""
    return F.to_json(F.struct(*[F.col(FIELDS[f]).alias(f) for f in fields or FIELDS]))


def kafka_json() -> Column:
    return stats_json(["mchNo", "netAmount", "updateTime"])


def preview(text: Column | str, length: int = 100) -> Column:
    """The start of a rejected message, for its error line only."""
    return F.substring(text, 1, length)


def _or_fallback(field: str, fallback: str) -> Column:
    """The fallback is for an absent field. One that is there with null reads None."""
    shown = F.coalesce(F.col(f"stats.{field}"), F.lit("None"))
    absent = ~F.coalesce(F.array_contains("present", field), F.lit(False))
    return F.when(absent, fallback).otherwise(shown)


def merchant_or_fallback() -> Column:
    return _or_fallback("mchNo", NO_MERCHANT)


def type_or_fallback() -> Column:
    return _or_fallback("eventType", NO_TYPE)


# A text with its escapes, a separator, or what else stands between blanks.
TOKEN = r'"(?:[^"\\]++|\\.)*+"|[,:]|[^\s",:]++'


def raw_line(value: str = "value") -> Column:
    """The whole message, fields in its own order, with one blank after each comma and colon
    and none elsewhere outside of texts."""
    tokens = F.regexp_extract_all(F.col(value).cast("string"), F.lit(TOKEN), F.lit(0))
    spaced = F.transform(tokens, lambda t: F.when(t.isin(",", ":"), F.concat(t, F.lit(" "))).otherwise(t))
    return F.array_join(spaced, "")


def report(printed_at: Column, zone: str = ZONE, value: str = "value") -> Column:
    """The ten lines a reader sees of one message. Needs ``value`` and the columns that
    ``read_messages`` adds; ``printed_at`` is the clock text of the head line. A time that is
    none is shown as it is; an amount may be a fraction."""
    label = {name: F.lit(text) for name, text in REPORT_LABELS.items()}
    whole = F.when(F.col("numbers.updateTime").between(*TIME_RANGE), F.floor("numbers.updateTime"))
    time = (
        F.when(F.col("time_text").isNull(), local_time("stats.updateTime", NO_TIME_REPORT, zone))
        .when(whole.isNotNull(), local_time(whole, NO_TIME_REPORT, zone))
        .otherwise(F.col("time_text"))
    )
    amount = lambda name: F.coalesce(F.col(f"stats.{name}").cast("double"), F.col(f"numbers.{name}"))
    return F.concat_ws(
        "\n",
        F.concat(label["head"], printed_at),
        F.concat(label["mchNo"], merchant_or_fallback()),
        F.concat(label["eventType"], type_or_fallback()),
        F.concat(label["updateTime"], time),
        *[F.concat(label[name], yuan(amount(name))) for name in AMOUNT_FIELDS],
        F.concat(label["raw"], raw_line(value)),
    )
