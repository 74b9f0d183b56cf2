"""Reading totals messages back: decode, parse, and decide what to do with bad ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchant_ledger.functions.once import with_once
from merchant_ledger.schemas import STATS_MESSAGE

# What becomes of a message.
ACK = "ack"  # handled
REJECT = "reject"  # not JSON: never readable, goes to the side table
REQUEUE = "requeue"  # readable, but no totals, or an amount that is no number: offered again

AMOUNTS = [name for name in STATS_MESSAGE.names if name.endswith("Amount")]
#: Amounts and times that are numbers, but not whole ones of 64 bits.
NUMBERS = T.StructType([T.StructField(name, T.DoubleType()) for name in [*AMOUNTS, "updateTime"]])


def read_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``stats`` (the message's fields), ``present`` (its keys), ``numbers``, ``time_text``
    and ``disposition``.

    ``value`` is text or UTF-8 bytes. Works on batch and streaming frames alike. Of fields
    that do not fit the contract, ``numbers`` has amounts and times as fractions, and
    ``time_text`` a time as it stands; both are null where all fields fit. Only an amount
    that is no number can't be shown, so only that keeps a message from being acked.
    """
    body = F.col(value).cast("string")
    # Read as a list, so that text after the message is not ignored.
    listed = F.concat(F.lit("["), body, F.lit("]"))
    objects = F.from_json(listed, T.ArrayType(T.MapType(T.StringType(), T.StringType())))
    read = with_once(messages, {"_objects": objects, "stats": F.from_json(body, STATS_MESSAGE)})
    # A field of a wrong type reads null in ``stats``, but not here.
    texts = F.when(F.size("_objects") == 1, F.get("_objects", F.lit(0)))
    read = read.withColumn("_texts", texts)
    # Numbers, texts and lists are JSON too.
    other_json = F.size(F.from_json(listed, T.ArrayType(T.StringType()))) == 1
    unfit = {
        name: F.coalesce(F.col("_texts")[name].isNotNull() & F.col(f"stats.{name}").isNull(), F.lit(False))
        for name in NUMBERS.names
    }
    any_unfit = reduce(Column.__or__, unfit.values())
    read = with_once(read, {"numbers": F.when(any_unfit, F.from_json(body, NUMBERS))})
    no_number = reduce(Column.__or__, [unfit[name] & F.col(f"numbers.{name}").isNull() for name in AMOUNTS])
    disposition = (
        F.when(~F.is_valid_utf8(body), REQUEUE)
        .when(no_number, REQUEUE)
        .when(F.col("_texts").isNotNull(), ACK)
        .when(other_json, REQUEUE)
        .otherwise(REJECT)
    )
    time_text = F.when(unfit["updateTime"], F.col("_texts")["updateTime"])
    present = {"present": F.map_keys("_texts"), "time_text": time_text, "disposition": disposition}
    return with_once(read, present).drop("_objects", "_texts")


def rejected(read: DataFrame) -> DataFrame:
    return read.filter(F.col("disposition") == REJECT)


def first_messages(messages: DataFrame, count: int, order: Sequence[str]) -> DataFrame:
    """At most ``count`` messages in the order of arrival (a top-k, no full sort)."""
    return messages.orderBy(*order).limit(count)
