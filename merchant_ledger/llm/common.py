"""Helpers of this subpackage: written tables, ranks without large groups, word patterns."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchant_ledger.session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the cluster's shared folder and read it back.

    Later stages start from files that every executor sees: a lost executor costs no more
    than its own tasks, and ids made here stay as they are.
    """
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def remove(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, when what was made from them is written itself."""
    for df in tables:
        spark = df.sparkSession
        folders = {file.rpartition("/")[0] for file in df.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """The words of a text, as an array; of null, none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % divisor


def spread(column: Column, digits: int = 3) -> Column:
    """One of 16**digits even buckets, the same in every run and in SQL."""
    return F.substring(F.md5(F.coalesce(column.cast("string"), F.lit(""))), 1, digits)


def rank_within(
    df: DataFrame, keys: list[str], by: str, order: list[Column], of_groups: DataFrame | None = None
) -> DataFrame:
    """Adds ``rank``, from 1, within ``keys``, in the order of (bucket of ``by``, ``order``).

    No group of ``keys`` is sorted as a whole: its rows are dealt into buckets, ranked inside
    a bucket, and moved by the counts of the buckets before. A row per group and bucket is
    all that one group has in one task (at most 4,096). The keys must not be null. Rows that
    are equal in all columns may swap ranks. Columns of ``of_groups``, a row per group, come
    along with the counts, so the rows themselves are shuffled once.
    """
    dealt = df.withColumn("_bucket", spread(F.col(by)))
    counts = dealt.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(
        *keys, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    if of_groups is not None:
        before = before.join(of_groups, keys)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    ranked = dealt.withColumn("_inside", F.row_number().over(inside))
    return (
        ranked.join(before, [*keys, "_bucket"])
        .withColumn("rank", F.col("_before") + F.col("_inside"))
        .drop("_bucket", "_before", "_inside")
    )


def batches_of(frames: Iterator[pd.DataFrame], most: int = 4_000_000) -> Iterator[pd.DataFrame]:
    """The frames, cut so that the texts of each have at most ``most`` characters or are one."""
    for frame in frames:
        at = frame["text"].str.len().cumsum() // most
        for _, part in frame.groupby(at, sort=False):
            yield part
