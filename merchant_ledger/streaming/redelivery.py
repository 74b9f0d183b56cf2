"""Messages that are offered again: attempts are counted per message, and end in a table of
dead letters."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from merchant_ledger.sources.messages import ACK, REJECT, REQUEUE, read_messages
from merchant_ledger.streaming.orders import ROCKSDB

# Executors get this module's code with the task; it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: So many times a message is offered in all.
ATTEMPTS = 3
DEAD = "dead"
SHARDS = 64
#: The state has the failures of a shard in so many entries, for one call each.
BUCKETS = 128
#: Columns added to those of the messages.
ATTEMPT, OUTCOME = "attempt", "outcome"


class Attempts(StatefulProcessor):
    """Counts how often each message has failed, and forgets it when its end is known.

    A message that is handled or rejected at its first offer never touches the state. Calls to
    the state are dear, so it has the messages by buckets: each bucket that is touched is read
    once and written once, however many of a shard's messages fail in a micro-batch.
    """

    def __init__(self, key: list[str], kinds: T.StructType, output: list[str], most: int):
        self.key, self.kinds, self.output, self.most = key, kinds, output, most

    def init(self, handle: StatefulProcessorHandle) -> None:
        failed = T.StructType(list(self.kinds.fields)).add("failures", "integer")
        self.failures = handle.getMapState(
            "failures", T.StructType().add("bucket", "integer"), T.StructType().add("failed", T.ArrayType(failed))
        )

    def _read(self, bucket: int) -> dict[tuple, int]:
        kept = self.failures.getValue((bucket,))
        return {tuple(each[:-1]): each[-1] for each in kept[0]} if kept else {}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        before, now = {}, {}
        for offered in rows:
            outcome, attempt = offered[OUTCOME].tolist(), offered[ATTEMPT].tolist()
            ids = zip(*[offered[name].tolist() for name in self.key])
            for at, (message, bucket) in enumerate(zip(ids, offered["bucket"].tolist())):
                if outcome[at] != REQUEUE and not attempt[at]:
                    attempt[at] = 1
                    continue
                if bucket not in now:
                    before[bucket] = self._read(bucket)
                    now[bucket] = dict(before[bucket])
                failures = now[bucket]
                attempt[at] = failures.get(message, 0) + 1
                if outcome[at] == REQUEUE and attempt[at] < self.most:
                    failures[message] = attempt[at]
                    continue
                failures.pop(message, None)
                if outcome[at] == REQUEUE:
                    outcome[at] = DEAD
            yield offered.assign(**{OUTCOME: outcome, ATTEMPT: attempt})[self.output]
        for bucket, failures in now.items():
            if failures and failures != before[bucket]:
                self.failures.updateValue((bucket,), ([(*message, n) for message, n in failures.items()],))
            elif before[bucket] and not failures:
                self.failures.removeKey((bucket,))

    def close(self) -> None: ...


class Redelivery:
    """Tables below one shared folder, written once per micro-batch and outcome:

    ``ack``      messages that were handled, and at which attempt,
    ``reject``   messages that can never be read,
    ``requeue``  messages that failed; the stream reads this table as its second source,
    ``dead``     messages that have failed ``attempts`` times.

    ``key`` names the columns that tell messages apart, ``refused`` is true for a message
    that is well but can't be handled now; it may depend on ``attempt``, the offers before
    this one (0 at first). A micro-batch that runs again after a failure replaces its own files
    before any other batch has seen them, so a restart loses and doubles nothing.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        key: list[str],
        schema: T.StructType,
        refused: Column | None = None,
        attempts: int = ATTEMPTS,
        shards: int = SHARDS,
    ):
        self.spark, self.folder, self.key, self.attempts, self.shards = spark, folder, key, attempts, shards
        self.refused = F.lit(False) if refused is None else refused
        self.schema = T.StructType(list(schema.fields)).add(ATTEMPT, "integer")

    def _path(self, outcome: str, batch_id: int | None = None) -> str:
        path = f"{self.folder}/{outcome}"
        return path if batch_id is None else f"{path}/{batch_id:012d}"

    def table(self, outcome: str) -> DataFrame:
        read = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true")
        return read.parquet(self._path(outcome))

    def _open(self) -> None:
        for outcome in (ACK, REJECT, REQUEUE, DEAD):
            self.spark.createDataFrame([], self.schema).write.mode("ignore").parquet(self._path(outcome, 0) + "-open")

    def offered(self, messages: DataFrame) -> DataFrame:
        """New messages, and those that are offered again, of a stream."""
        again = (
            self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").parquet(self._path(REQUEUE))
        )
        return messages.withColumn(ATTEMPT, F.lit(0)).select(*self.schema.names).unionByName(again)

    def judged(self, offered: DataFrame, value: str = "value") -> DataFrame:
        """``outcome`` and ``attempt`` of every offer. Messages are spread over shards by their
        key; one call counts all that a shard has in a micro-batch. It holds those of the
        shard that have failed, by number and key, not their texts."""
        read = read_messages(offered, value)
        outcome = F.when((F.col("disposition") == ACK) & self.refused, REQUEUE).otherwise(F.col("disposition"))
        rows = read.withColumn(OUTCOME, outcome).select(*self.schema.names, OUTCOME)
        kinds = T.StructType([self.schema[name] for name in self.key])
        output = rows.schema
        shard = F.pmod(F.xxhash64(*self.key), F.lit(self.shards))
        bucket = F.pmod(F.xxhash64(F.lit("bucket"), *self.key), F.lit(BUCKETS)).cast("int")
        return rows.withColumns({"shard": shard, "bucket": bucket}).groupBy("shard").transformWithStateInPandas(
            Attempts(list(self.key), kinds, output.names, self.attempts), output, outputMode="append", timeMode="none"
        )

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """The body of ``foreachBatch``: the offers once, then their parts by outcome."""
        whole = f"{self.folder}/offers/{batch_id % 2}"
        batch.write.mode("overwrite").parquet(whole)
        offers = self.spark.read.schema(batch.schema).parquet(whole)
        for outcome in (ACK, REJECT, REQUEUE, DEAD):
            part = offers.where(F.col(OUTCOME) == outcome).drop(OUTCOME)
            part.write.mode("overwrite").parquet(self._path(outcome, batch_id))

    def start(self, messages: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Offer the messages of a stream. What fails comes again with a later micro-batch;
        with ``availableNow`` at the next start."""
        self._open()
        conf, name = self.spark.conf, "spark.sql.streaming.stateStore.providerClass"
        before = conf.get(name)
        conf.set(name, ROCKSDB)
        try:
            return (
                self.judged(self.offered(messages))
                .writeStream.foreachBatch(self.apply)
                .option("checkpointLocation", checkpoint)
                .outputMode("append")
                .trigger(**(trigger or {"processingTime": "5 seconds"}))
                .start()
            )
        finally:
            conf.set(name, before)

    def run(self, messages: DataFrame, checkpoint: str) -> None:
        """Offer all there is until no message is left to be offered again."""
        for _ in range(self.attempts):
            self.start(messages, checkpoint, {"availableNow": True}).awaitTermination()
