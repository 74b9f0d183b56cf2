"""Many small slices take no more tasks and files than the rows need."""

from pyspark.sql import functions as F

from merchant_ledger.operators import slices
from merchant_ledger.operators.slices import slice_if_hot


def events_of(spark, rows=4000):
    return spark.range(rows).selectExpr(
        "concat('M', id % 2) AS mch_no", "concat('O', id % 50) AS order_id", "id * 7919 % 4001 AS seq",
        "id % 100 AS amount", "1 AS state", "false AS is_snapshot",
    )


def test_tasks_do_not_grow_with_the_slices(spark, monkeypatch):
    folders = []
    written = slices.written
    monkeypatch.setattr(slices, "written", lambda rows, purpose: folders.append(written(rows, purpose)) or folders[-1])
    sliced = slice_if_hot(events_of(spark), ["seq"], 20)
    assert len(folders[0].inputFiles()) <= spark.sparkContext.defaultParallelism
    ranges = sliced.groupBy("merchant_slice").agg(F.count("*").alias("n"), F.min("seq").alias("a"), F.max("seq").alias("b"))
    ranges = ranges.orderBy("merchant_slice").collect()
    assert len(ranges) >= 800 and max(r["n"] for r in ranges) <= 5
    assert all(x["b"] < y["a"] for x, y in zip(ranges, ranges[1:]))
    assert sum(r["n"] for r in ranges) == 4000
