"""Totals to a message queue, in order also for a merchant with most of the rows, and without
sending again what a failed attempt has sent.

A batch's messages are written to a table first, so that every attempt has the same ones.
Merchants too large for a task are cut into slices of the sequence, which are sent one after
the other, a wave each; within a wave all merchants are sent in parallel. Tasks don't fail when the
queue does: they return how many messages of each merchant were sent, and the error. This
is written before the batch fails, and the next attempt goes on behind it. Only a lost
executor leaves messages unrecorded; these are sent again, with the same keys.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchant_ledger.functions.messages import stats_json
from merchant_ledger.operators.slices import MERCHANT_SLICE, ROWS_PER_GROUP, is_sliced, slice_if_hot
from merchant_ledger.operators.totals import with_update_time
from merchant_ledger.schemas import MERCHANT
from merchant_ledger.session import delete
from merchant_ledger.sinks.queue import Channel, Retry

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SENT = "mch_no string, sent bigint, error string"


class Outbox:
    """A sink of the ledger, for one queue. ``seq`` are the ledger's sequence columns.

    ``rows_per_task`` is the most rows of one merchant that a task sends. Rows without a merchant are left out.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        connect: Callable[[], Channel],
        seq: Sequence[str],
        retry: Retry = Retry(),
        rows_per_task: int = ROWS_PER_GROUP,
    ):
        self.spark, self.folder, self.connect, self.seq = spark, folder, connect, list(seq)
        self.retry, self.rows_per_task = retry, rows_per_task

    def _path(self, table: str, batch_id: int) -> str:
        return f"{self.folder}/{table}/batch_id={batch_id}"

    def _read(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as error:
            # Without a file an attempt was cut off while it wrote.
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _messages(self, totals: DataFrame, batch_id: int) -> DataFrame:
        """The batch's messages with their wave, as the first attempt has written them."""
        done, path = self._path("written", batch_id), self._path("messages", batch_id)
        if self._read(done) is None:
            rows = with_update_time(totals).filter(F.col(MERCHANT).isNotNull())
            rows = slice_if_hot(rows, self.seq, self.rows_per_task, by_order=False)
            # Whole merchants go first.
            wave = F.col(MERCHANT_SLICE) + 1 if is_sliced(rows) else F.lit(0)
            key = F.to_json(F.struct(MERCHANT, *self.seq))
            messages = rows.select(
                wave.cast("int").alias("wave"), MERCHANT, *self.seq, stats_json().alias("value"), key.alias("key")
            )
            messages.write.mode("overwrite").parquet(path)
            self.spark.range(1).write.mode("overwrite").parquet(done)
        return self.spark.read.parquet(path)

    def sent(self, batch_id: int, wave: int) -> DataFrame:
        """How many messages of each merchant the attempts so far have sent."""
        attempts = self._read(f"{self._path('sent', batch_id)}/wave={wave}")
        attempts = self.spark.createDataFrame([], SENT) if attempts is None else attempts
        return attempts.groupBy(MERCHANT).agg(F.sum("sent").alias("sent"))

    def _wave(self, messages: DataFrame, batch_id: int, wave: int) -> None:
        place = F.row_number().over(Window.partitionBy(MERCHANT).orderBy(*self.seq))
        left = (
            messages.filter(F.col("wave") == wave)
            .withColumn("place", place)
            .join(self.sent(batch_id, wave), MERCHANT, "left")
            .filter(F.col("place") > F.coalesce("sent", F.lit(0)))
        )
        ordered = left.repartition(MERCHANT).sortWithinPartitions(MERCHANT, *self.seq).select(MERCHANT, "value", "key")
        connect, retry = self.connect, self.retry

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            channel, sent, error = None, Counter(), None
            try:
                for batch in batches:
                    for merchant, value, key in zip(*[column.to_pylist() for column in batch.columns]):
                        channel = channel or retry.connect(connect)
                        channel.publish(value.encode("utf-8"), key)
                        sent[merchant] += 1
            except Exception as failure:
                error = f"{type(failure).__name__}: {failure}"
            finally:
                if channel is not None:
                    channel.close()
            rows = [*sent.items(), *([(None, 0)] if error else [])]
            yield pa.RecordBatch.from_pydict({
                "mch_no": pa.array([m for m, _ in rows], pa.string()),
                "sent": pa.array([n for _, n in rows], pa.int64()),
                "error": pa.array([error] * len(rows), pa.string()),
            })

        # An attempt adds its own files; they are read together.
        target = f"{self._path('sent', batch_id)}/wave={wave}"
        before = self._errors(target)
        ordered.mapInArrow(send, SENT).write.mode("append").parquet(target)
        errors = self._errors(target)
        if errors > before:
            text = self._read(target).filter("error IS NOT NULL").first()["error"]
            raise ConnectionError(f"batch {batch_id}, wave {wave}: {text}")

    def _errors(self, path: str) -> int:
        attempts = self._read(path)
        return 0 if attempts is None else attempts.filter(f"error IS NOT NULL AND {MERCHANT} IS NULL").count()

    def __call__(self, totals: DataFrame, batch_id: int) -> None:
        """Send what is left of the batch; fails where the queue did."""
        messages = self._messages(totals, batch_id)
        # A wave per slice: as many as the largest merchant's rows make.
        waves = [r["wave"] for r in messages.select("wave").distinct().orderBy("wave").collect()]
        for wave in waves:
            self._wave(messages, batch_id, wave)
        for table in ("messages", "written", "sent"):
            delete(self.spark, self._path(table, batch_id - 1))
