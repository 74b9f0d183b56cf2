"""The order of events as a value to take the first or last by."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")
ROOM = {"int": 2**32, "bigint": 2**64}


def position(events: DataFrame, seq: Sequence[str]) -> Column:
    """The sequence as one orderable value, a number where that is possible: an aggregate
    that keeps only numbers is hashed, one that keeps structs has to sort its input.
    """
    kinds = [dict(events.dtypes)[name] for name in seq]
    if len(seq) == 1 and kinds[0] in WHOLE_NUMBERS:
        return F.col(seq[0])
    if all(kind in ROOM for kind in kinds) and kinds.count("bigint") < 2 and len(seq) <= 3:
        # Each number has the room of its type; a first one beyond 10**9 overflows and fails.
        total = F.col(seq[0]).cast("decimal(38,0)")
        for name, kind in zip(seq[1:], kinds[1:]):
            total = (total * F.lit(Decimal(ROOM[kind]))).cast("decimal(38,0)") + F.col(name)
        return total.cast("decimal(38,0)")
    if len(seq) != 2 or not kinds[0].startswith("timestamp") or kinds[1] not in WHOLE_NUMBERS:
        return F.struct(*seq)
    # Each microsecond has room for every bigint, above and below.
    high = _micros(events, seq[0]).cast("decimal(18,0)") * F.lit(Decimal(2 * 10**19))
    return (high + F.col(seq[1])).cast("decimal(38,0)")


def slice_of(events: DataFrame, seq: Sequence[str], width: int) -> Column:
    """A range of the sequence that an event is in, as text. ``width`` is in seconds for a
    time and in positions for a number; rows between two of one range are of it too."""
    kinds = dict(events.dtypes)
    parts = []
    for name in seq:
        if kinds[name].startswith("timestamp"):
            return _joined([*parts, F.floor(_micros(events, name) / F.lit(width * 1_000_000))])
        if kinds[name] == "bigint":
            return _joined([*parts, F.floor(F.col(name) / F.lit(width))])
        parts.append(F.col(name))
    return _joined(parts)


def _joined(parts: Sequence[Column]) -> Column:
    return F.concat_ws("/", *[part.cast("string") for part in parts])


def lacks_position(seq: Sequence[str]) -> Column:
    """Whether a change (a row that is not of the table snapshot) has no place in the order."""
    missing = F.lit(False)
    for name in seq:
        missing = missing | F.col(name).isNull()
    return ~F.col("is_snapshot") & missing


def with_positions(events: DataFrame, seq: Sequence[str]) -> DataFrame:
    """The events; the job fails at a change without a place in the order. A guess would
    give every operator another result."""
    failure = F.raise_error(F.lit("a change without a position")).cast("boolean")
    return events.filter(F.when(lacks_position(seq), failure).otherwise(F.lit(True)))


def _micros(events: DataFrame, name: str) -> Column:
    is_ntz = dict(events.dtypes)[name] == "timestamp_ntz"
    if not is_ntz or events.sparkSession.conf.get("spark.sql.session.timeZone") == "UTC":
        return F.unix_micros(F.col(name).cast("timestamp"))
    # Without a time zone, and so without its gaps.
    since = F.col(name) - F.lit("1970-01-01").cast("timestamp_ntz")
    return (since.cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("bigint")
