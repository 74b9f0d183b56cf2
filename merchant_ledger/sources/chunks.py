"""Reading a table in chunks of about equal numbers of rows, whatever its keys are like."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_ledger.sources.changes import FETCH_SIZE, SPLIT_SIZE

#: No chunk has more than so many times the rows asked for, unless one key alone has them.
MOST = 2


@dataclass(frozen=True)
class Chunk:
    """Keys from ``low`` on and below ``high``. The first chunk has no low end and takes the
    null keys, the last one has no high end, so that no row is in no chunk."""

    low: object
    high: object
    rows: int

    def predicate(self, key: str) -> str:
        """As a condition in SQL."""
        parts = []
        if self.low is not None:
            parts.append(f"{key} >= {literal(self.low)}")
        if self.high is not None:
            parts.append(f"{key} < {literal(self.high)}")
        condition = " AND ".join(parts)
        if self.low is None:
            condition = f"({condition} OR {key} IS NULL)" if condition else "1 = 1"
        return condition


def literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, datetime.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"DATE '{value.isoformat()}'"
    return str(value)


def _ranges(keys: DataFrame, key: str, chunks: int) -> list[tuple]:
    """(least, greatest, rows, kinds) of so many ranges of even size, in order. The bounds come
    from the samples of a range partitioning, so they follow the keys' distribution, not
    their values."""
    ranges = keys.select(key).repartitionByRange(chunks, key).groupBy(F.spark_partition_id().alias("range"))
    rows = ranges.agg(
        F.min(key).alias("least"), F.max(key).alias("greatest"), F.count("*").alias("rows")
    )
    return [(r["least"], r["greatest"], r["rows"]) for r in rows.orderBy("range").collect()]


def plan_chunks(keys: DataFrame, key: str, rows_per_chunk: int = SPLIT_SIZE) -> list[Chunk]:
    """Chunks of about ``rows_per_chunk`` rows each, at most ``MOST`` times that.

    ``keys`` has the key of every row: numbers, dates, times or texts (compared as Spark
    compares them, byte by byte; the database must do so too). One shuffle of the keys
    counts the chunks as it makes them; one that is too large is cut again. Only rows
    of one and the same key are never cut. A row per chunk comes to the driver.
    """
    total = keys.count()
    if not total:
        return []
    pending = [(None, None, total)]
    planned: list[tuple] = []
    while pending:
        low, high, rows = pending.pop()
        part = keys if low is None and high is None else keys.where(Chunk(low, high, 0).predicate(key))
        found = _ranges(part, key, max(1, -(-rows // rows_per_chunk)))
        # Null keys come first and belong to the range of the least key.
        while len(found) > 1 and found[0][0] is None:
            found[:2] = [(found[1][0], found[1][1], found[0][2] + found[1][2])]
        starts = [low, *[least for least, _, _ in found[1:]], high]
        for at, (least, greatest, size) in enumerate(found):
            if size > MOST * rows_per_chunk and least != greatest and len(found) > 1:
                pending.append((starts[at], starts[at + 1], size))
            else:
                planned.append((starts[at], starts[at + 1], size))
    ordered = sorted(planned, key=lambda c: (c[0] is not None, c[0]))
    return [Chunk(*c) for c in ordered]


def chunk_number(chunks: list[Chunk], key: str) -> Column:
    """Which chunk a row is in, from 0."""
    number = F.lit(None).cast("int")
    for at, chunk in enumerate(chunks):
        number = F.when(F.expr(chunk.predicate(key)), at).otherwise(number)
    return number


def chunked_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    chunks: list[Chunk],
    connections: int,
    properties: dict[str, str] | None = None,
    fetch_size: int = FETCH_SIZE,
) -> DataFrame:
    """The table, a query per chunk, with at most ``connections`` of them at a time."""
    options = {**(properties or {}), "fetchsize": str(fetch_size)}
    predicates = [chunk.predicate(key) for chunk in chunks] or ["1 = 1"]
    return spark.read.jdbc(url, table, predicates=predicates, properties=options).coalesce(connections)
