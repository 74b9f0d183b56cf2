"""The latest totals of every merchant as a table that the stream keeps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from merchant_ledger.operators.sequence import position
from merchant_ledger.schemas import MERCHANT, ORDER
from merchant_ledger.session import delete
from merchant_ledger.streaming.ledger import OPENING

BUCKETS = 64


class LatestTable:
    """A sink of the ledger. Merchants are dealt into ``buckets`` by a hash; a micro-batch
    writes anew the buckets of its own merchants and leaves the others alone.

    Each bucket has versions, named by the batch that wrote them, and the greatest counts.
    A batch that runs again reads the versions before its own and writes its own again, so
    the version before the last is kept, and older ones are removed. The number of buckets
    stays with the table.
    """

    def __init__(self, spark: SparkSession, folder: str, seq: Sequence[str], buckets: int = BUCKETS):
        self.spark, self.folder, self.seq, self.buckets = spark, folder, list(seq), buckets

    def _stored(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def _versions(self, below: int | None = None) -> dict[int, list[int]]:
        """The batches that wrote each bucket, the last one first. Only names of folders are read."""
        stored = self._stored()
        if stored is None:
            return {}
        found: dict[int, list[int]] = {}
        for r in stored.select("bucket", "batch_id").distinct().collect():
            if below is None or r["batch_id"] < below:
                found.setdefault(r["bucket"], []).append(r["batch_id"])
        return {bucket: sorted(ids, reverse=True) for bucket, ids in found.items()}

    def table(self) -> DataFrame:
        """One row per merchant."""
        rows = self._rows(self._versions())
        if rows is None:
            raise ValueError(f"the table {self.folder} has no batch yet")
        return rows.drop("bucket", "batch_id")

    def _rows(self, versions: dict[int, list[int]]) -> DataFrame | None:
        if not versions:
            return None
        by_batch: dict[int, list[int]] = {}
        for bucket, ids in versions.items():
            by_batch.setdefault(ids[0], []).append(bucket)
        newest = F.lit(False)
        for batch_id, buckets in by_batch.items():
            newest = newest | ((F.col("batch_id") == batch_id) & F.col("bucket").isin(buckets))
        return self._stored().filter(newest)

    def _order(self, rows: DataFrame, batch_id: int) -> Column:
        # Rows of a table snapshot have no place in the log; they are in the table's order.
        return F.col(ORDER) if batch_id == OPENING else position(rows, self.seq)

    def __call__(self, rows: DataFrame, batch_id: int) -> None:
        last = Window.partitionBy(MERCHANT).orderBy(F.desc("_at"))
        at = rows.withColumn("_at", self._order(rows, batch_id))
        # One row per merchant at most leaves a task of the changelog: a hot one is no hot key.
        newest = at.withColumn("_turn", F.row_number().over(last)).filter("_turn = 1").drop("_at", "_turn", "batch_id")
        bucket = F.pmod(F.xxhash64(MERCHANT), F.lit(self.buckets)).cast("int")
        newest = newest.withColumn("bucket", bucket)
        touched = [r["bucket"] for r in newest.select("bucket").distinct().collect()]
        versions = self._versions(below=batch_id)
        before = self._rows({b: ids for b, ids in versions.items() if b in touched})
        if before is not None:
            kept = before.drop("batch_id").join(newest.select(MERCHANT), MERCHANT, "left_anti")
            newest = newest.unionByName(kept, allowMissingColumns=True)
        dealt = newest.repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.folder}/batch_id={batch_id}")
        for bucket in touched:
            for old in versions.get(bucket, [])[1:]:
                delete(self.spark, f"{self.folder}/batch_id={old}/bucket={bucket}")
