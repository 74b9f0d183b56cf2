"""A zone map of change files: which times and positions each file has, kept as a table, so
that a start in the middle reads only the files that matter."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_ledger.operators.parsing import parse_envelopes

#: A file as it was when it was read; one that has grown since is another.
FILE = ["path", "length", "modified"]
ZONE_SCHEMA = (
    "path string, length bigint, modified timestamp, records bigint, untimed bigint, "
    "first_ms bigint, last_ms bigint, first_pos bigint, last_pos bigint"
)


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of the files below ``path``. Their content isn't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def zones_of(lines: DataFrame) -> DataFrame:
    """One row per file of a text frame. Records are parsed as they are later, so a record
    without a time there has none here."""
    files = lines.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("length"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
    time, pos = F.col("envelope.ts_ms"), F.col("envelope.source.pos")
    return parse_envelopes(files).groupBy(*FILE).agg(
        F.count("*").alias("records"),
        F.count_if(time.isNull()).alias("untimed"),
        F.min(time).alias("first_ms"),
        F.max(time).alias("last_ms"),
        F.min(pos).alias("first_pos"),
        F.max(pos).alias("last_pos"),
    )


class ZoneMap:
    """The zones of all files below ``path``, as a table at ``folder``.

    ``update`` reads files that have come or changed since, each of them once; a start point
    then costs a look at the table instead of a parse of the log. A row per file comes to
    the driver, which has to plan the files anyway.
    """

    def __init__(self, spark: SparkSession, path: str, folder: str):
        self.spark, self.path, self.folder = spark, path, folder

    def zones(self) -> DataFrame:
        try:
            return self.spark.read.schema(ZONE_SCHEMA).parquet(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ZONE_SCHEMA)

    def update(self) -> int:
        """Add the zones of new and changed files; returns how many. Safe to run again."""
        known = self.zones().select(*FILE)
        new = [r["path"] for r in listed(self.spark, self.path).join(known, FILE, "left_anti").collect()]
        if new:
            zones_of(self.spark.read.text(new)).write.mode("append").parquet(self.folder)
        return len(new)

    def files(self, wanted: Column) -> list[str]:
        """Files whose zone is ``wanted``, and files that have none yet."""
        zones = self.zones().dropDuplicates(FILE)
        found = listed(self.spark, self.path).join(zones, FILE, "left")
        keep = F.coalesce(wanted, F.lit(True)) | F.col("records").isNull()
        return [r["path"] for r in found.where(keep).select("path").collect()]

    def lines_from(self, millis: int) -> DataFrame:
        """Lines of the files that may hold records written at or after a point in time, or
        without a time. Files are read whole: filter the records with ``start_from``."""
        return self._lines((F.col("last_ms") >= millis) | (F.col("untimed") > 0))

    def lines_from_position(self, pos: int) -> DataFrame:
        """Lines of the files that may hold records at or after a position of the log. A
        record without a position is found only where its file has no other."""
        return self._lines(F.col("last_pos") >= pos)

    def _lines(self, wanted: Column) -> DataFrame:
        files = self.files(wanted)
        if files:
            return self.spark.read.text(files)
        return self.spark.createDataFrame([], "value string")
