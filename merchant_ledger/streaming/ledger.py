"""The streaming job: order deltas, running totals and final totals, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from merchant_ledger.functions.buckets import derived_amounts
from merchant_ledger.operators.slices import (
    ROWS_PER_GROUP,
    slice_if_hot,
    with_carry,
)
from merchant_ledger.operators.totals import (
    SUMS,
    finish,
    running_sums,
    running_totals,
    snapshot_totals,
    with_update_time,
)
from merchant_ledger.schemas import BUCKETS, CHANGE_COLUMNS, MERCHANT, ORDER, struct
from merchant_ledger.session import delete
from merchant_ledger.streaming.metrics import observed
from merchant_ledger.streaming.orders import ROCKSDB, order_deltas

# How often state and source position are made durable.
TRIGGER = {"processingTime": "5 seconds"}

# Order groups per stateful task: enough to even out, few enough to be large.
SHARDS_PER_TASK = 4

OPENING = -1  # batch id of totals that were there before the stream

# After so many batches their sums are added up into all merchants' totals.
BATCHES_PER_BASE = 64

SUMS_SCHEMA = struct(**{MERCHANT: "string"}, **{name: "long" for name in BUCKETS})

Sink = Callable[[DataFrame, int], None]


class Ledger:
    """Tables below one shared folder, one partition per micro-batch:

    ``deltas``     what each event added,
    ``changelog``  one row per event with its merchant's totals just after it,
    ``sums``       what the batch added, for its own merchants only,
    ``base``       all merchants' totals, after every ``batches_per_base`` batches,
    ``ranges``     the changelog of closed groups of so many batches, in few files each.

    Batch -1 holds the table snapshot of a hand-over. A micro-batch that is run again after
    a failure overwrites its own partitions, so the tables hold every event once. A batch
    reads one base and less than ``batches_per_base`` sums, however long the history is.
    When a group of batches is closed, its changelog is merged into a range, and tables of
    the group before it, which nobody reads any more, are removed: the small files are those
    of two groups at most.
    ``sinks`` get the changelog of each batch; they may see a batch twice and can tell by
    its id, or by merchant and sequence. ``keep`` names further columns of the events for
    the changelog; all others are dropped before the state. ``slice_width`` (seconds or
    positions) lets one order have most rows of a micro-batch. ``ttl_ms`` forgets an order
    so long after its last change, by the clock: its next change then counts as its first.
    Off by default; the first start decides.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        seq: Sequence[str],
        sinks: Sequence[Sink] = (),
        rows_per_group: int = ROWS_PER_GROUP,
        keep: Sequence[str] = (),
        batches_per_base: int = BATCHES_PER_BASE,
        slice_width: int | None = None,
        ttl_ms: int | None = None,
    ):
        self.spark, self.folder, self.seq = spark, folder, list(seq)
        self.sinks, self.rows_per_group = list(sinks), rows_per_group
        self.columns = list(dict.fromkeys([*CHANGE_COLUMNS, *seq, *keep]))
        self.batches_per_base, self.slice_width, self.ttl_ms = batches_per_base, slice_width, ttl_ms

    def _path(self, table: str, batch_id: int | None = None) -> str:
        path = f"{self.folder}/{table}"
        return path if batch_id is None else f"{path}/batch_id={batch_id}"

    def _read(self, table: str, batch_id: int) -> DataFrame:
        return self.spark.read.parquet(self._path(table, batch_id))

    def _read_if_there(self, table: str, batch_id: int | None = None) -> DataFrame | None:
        return _if_there(lambda: self.spark.read.parquet(self._path(table, batch_id)))

    def _write(self, rows: DataFrame, table: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(self._path(table, batch_id))

    def _setting(self, name: str, value) -> object:
        """Chosen at the first start, kept ever after."""
        stored = self._read_if_there(name, 0)
        if stored is not None:
            return stored.first()[0]
        self._write(self.spark.range(1).select(F.lit(value).alias(name)), name, 0)
        return value

    def shards(self) -> int:
        """How many groups the order states are spread over. The states are stored by group."""
        partitions = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return self._setting("shards", SHARDS_PER_TASK * partitions)

    def claim(self, checkpoint: str) -> None:
        """A ledger belongs to one checkpoint: with another one, or with one that is gone,
        batch ids would start again and old totals be taken for new ones."""
        owner = self._setting("checkpoint", checkpoint)
        if owner != checkpoint:
            raise ValueError(f"the ledger {self.folder} belongs to the checkpoint {owner}")
        # A stream writes this file before its first batch.
        known = _if_there(lambda: self.spark.read.text(f"{checkpoint}/metadata"))
        if known is None and self.last_batch() not in (None, OPENING):
            raise ValueError(f"the ledger {self.folder} has batches, but no checkpoint {checkpoint}")
        self._setting("batches_per_base", self.batches_per_base)
        self.ttl_ms = self._setting("ttl_ms", self.ttl_ms or 0) or None

    def open_with(self, snapshot: DataFrame, like: DataFrame, order: Sequence[str]) -> None:
        """The events of a table snapshot as batch -1: one row of the changelog per event, and
        totals for the stream to go on from. ``like`` has the columns of the stream."""
        columns = [
            F.col(f.name) if f.name in snapshot.columns else F.lit(None).cast(f.dataType).alias(f.name)
            for f in like.select(*self.columns).schema
        ]
        events = with_update_time(snapshot.select(*columns))
        self._write(running_totals(events, order, self.rows_per_group), "changelog", OPENING)
        self._write(snapshot_totals(events).select(MERCHANT, *BUCKETS), "base", OPENING)
        for sink in self.sinks:
            sink(self._read("changelog", OPENING), OPENING)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """The body of ``foreachBatch``."""
        # Written first: each further use would run the stateful operator again.
        self._write(batch, "deltas", batch_id)
        deltas = self._read("deltas", batch_id)
        sums = deltas.groupBy(MERCHANT).agg(*[F.sum(d).alias(n) for n, d in SUMS.items()])
        self._write(sums, "sums", batch_id)
        of_batch = self._stored("sums", [batch_id])
        before = self._before(batch_id)
        touched = [rows.join(of_batch, MERCHANT, "left_semi") for rows in before]
        self._write(self._changelog(deltas, _added_up(touched)), "changelog", batch_id)
        if (batch_id + 1) % self._every() == 0:
            self._write(_added_up([*before, of_batch]), "base", batch_id)
        # Two places in turn: the last but one is there while this one is written.
        self._write(self.spark.range(1).select(F.lit(batch_id).alias("last")), "last", batch_id % 2)
        if (batch_id + 1) % self._every() == 0:
            self._close_group(batch_id)
        delete(self.spark, self._path("deltas", batch_id - 1))
        for sink in self.sinks:
            sink(self._read("changelog", batch_id), batch_id)

    def _close_group(self, last: int) -> None:
        """Merge the changelog of the group of batches that ends with ``last``.

        The range is whole before the mark that makes it count, and the group's own tables
        stay until the next group is closed, for readers that have begun with them.
        """
        every = self._every()
        first = last - every + 1
        rows = self._batches("changelog").filter(F.col("batch_id").between(first, last))
        rows.write.mode("overwrite").parquet(f"{self.folder}/ranges/{last:012d}")
        self._write(self.spark.range(1).select(F.lit(last).alias("merged")), "merged", last // every % 2)
        for batch_id in range(first - every, first):
            delete(self.spark, self._path("changelog", batch_id)) if batch_id > OPENING else None
            delete(self.spark, self._path("sums", batch_id))
        delete(self.spark, self._path("base", first - every - 1))

    def merged(self) -> int | None:
        """The last batch whose changelog is in a range."""
        written = self._read_if_there("merged")
        return None if written is None else written.agg(F.max("merged")).first()[0]

    def _batches(self, table: str) -> DataFrame:
        return self.spark.read.parquet(self._path(table))

    def _every(self) -> int:
        return self._setting("batches_per_base", self.batches_per_base)

    def _stored(self, table: str, batch_ids: Sequence[int]) -> DataFrame:
        paths = [self._path(table, batch_id) for batch_id in batch_ids]
        return self.spark.read.schema(SUMS_SCHEMA).parquet(*paths)

    def _before(self, batch_id: int) -> list[DataFrame]:
        """What adds up to the totals before a batch. Before the first one there may be none."""
        base = batch_id // self._every() * self._every() - 1
        parts = []
        if base > OPENING or self._read_if_there("base", OPENING) is not None:
            parts.append(self._stored("base", [base]))
        if base + 1 < batch_id:
            parts.append(self._stored("sums", range(base + 1, batch_id)))
        return parts

    def _changelog(self, deltas: DataFrame, opening: DataFrame | None) -> DataFrame:
        """Running totals. The opening totals of the batch's merchants take part as carry
        rows, which sort before all others, so no join with the events is needed."""
        if opening is not None:
            carry = opening.select(MERCHANT, *[F.col(n).alias(d) for n, d in SUMS.items()])
            deltas = with_carry(deltas, carry)
        deltas = slice_if_hot(deltas, self.seq, self.rows_per_group, by_order=False)
        return finish(running_sums(deltas, self.seq))

    def changelog(self) -> DataFrame:
        merged = self.merged()
        if merged is None:
            return self._batches("changelog")
        single = self._batches("changelog").filter((F.col("batch_id") > merged) | (F.col("batch_id") == OPENING))
        ranges = [f"{self.folder}/ranges/{last:012d}" for last in range(self._every() - 1, merged + 1, self._every())]
        return self.spark.read.schema(single.schema).parquet(*ranges).unionByName(single)

    def last_batch(self) -> int | None:
        """The last batch whose tables are whole; -1 for a snapshot only."""
        written = self._read_if_there("last")
        if written is not None:
            return written.agg(F.max("last")).first()[0]
        return None if self._read_if_there("base", OPENING) is None else OPENING

    def totals(self, batch_id: int | None = None) -> DataFrame:
        """Totals after a batch, by default the last one."""
        if batch_id is None:
            batch_id = self.last_batch()
        rows = None if batch_id is None else _added_up(self._before(batch_id + 1))
        if rows is None:
            raise ValueError(f"the ledger {self.folder} has no batch yet")
        return rows.withColumns(derived_amounts())


def _added_up(parts: Sequence[DataFrame]) -> DataFrame | None:
    if not parts:
        return None
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(MERCHANT).agg(*[F.sum(name).alias(name) for name in BUCKETS])


def _if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def start(
    changes: DataFrame, ledger: Ledger, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Run ``changes`` (a streaming frame of change events) into the ledger.

    Started again with the same checkpoint, it goes on where it stopped. No watermark: no
    row is ever too late. The update time is that of the micro-batch: it is part of the
    checkpoint, so a batch that runs again has the same one.
    """
    ledger.claim(checkpoint)
    conf = ledger.spark.conf
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}  # order states outgrow the heap
    if ledger.ttl_ms:
        # Otherwise a state with a clock asks for empty batches without end. What has expired
        # is not read, and is removed with the next batch.
        settings["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    before = {key: conf.get(key) for key in settings}
    for key, value in settings.items():
        conf.set(key, value)
    try:
        return (
            observed(with_update_time(_deltas(changes, ledger)))
            .writeStream.foreachBatch(ledger.apply)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(**(trigger or TRIGGER))
            .start()
        )
    finally:
        for key, value in before.items():
            conf.set(key, value)


def _deltas(changes: DataFrame, ledger: Ledger) -> DataFrame:
    return order_deltas(changes.select(*ledger.columns), ledger.seq, ledger.shards(), ledger.slice_width, ledger.ttl_ms)


def run_for(query: StreamingQuery, seconds: int) -> None:
    """Let the query run for a time, then stop it. It can be started again later."""
    if not query.awaitTermination(seconds):
        query.stop()


def hand_over(
    snapshot: DataFrame,
    changes: DataFrame,
    ledger: Ledger,
    checkpoint: str,
    trigger: dict | None = None,
    order: Sequence[str] = (ORDER,),
) -> StreamingQuery:
    """Table snapshot first, then the changes since.

    ``snapshot`` are the snapshot's change events, ``changes`` a stream that starts at the
    log position recorded before the snapshot was read. The snapshot's rows get their places
    in the changelog by ``order`` (the table's primary key) and go to the sinks as batch -1;
    they need no state. The ledger must be new. If the snapshot fails, hand over again; on a
    later restart use ``start``: the checkpoint knows the position.
    """
    if ledger.last_batch() not in (None, OPENING):
        raise ValueError(f"the ledger {ledger.folder} has batches: use start, or a new folder")
    ledger.claim(checkpoint)
    ledger.open_with(snapshot, changes, order)
    return start(changes, ledger, checkpoint, trigger)
