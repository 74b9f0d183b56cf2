"""Chunks of a table: every row in one of them, none much larger than asked for."""

import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from merchant_ledger.sources.chunks import chunk_number, plan_chunks


def covered(rows, chunks):
    """Rows per chunk, by the predicates as any database would see them."""
    con = duckdb.connect()
    stored = rows.toPandas()  # noqa: F841
    con.execute("CREATE TABLE t AS SELECT * FROM stored")
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {c.predicate('id')}").fetchone()[0] for c in chunks]
    once = " + ".join(f"CAST(coalesce({c.predicate('id')}, false) AS INTEGER)" for c in chunks)
    assert con.execute(f"SELECT count(*) FROM t WHERE {once} <> 1").fetchone()[0] == 0
    assert [c.rows for c in chunks] == counts
    return counts


KEYS = {
    "even": "id",
    "skewed": "cast(pow(id, 5) as bigint)",
    "gap": "if(id < 4900, id, id * 1000000000000)",
    "negative": "id * -3",
    "text": "concat('order-000\\'', hex(id))",
    "decimal": "cast(id / 7 as decimal(20, 4))",
}


@pytest.mark.parametrize("name", KEYS)
def test_even_chunks(spark, name):
    rows = spark.range(5000).selectExpr(f"{KEYS[name]} AS id")
    chunks = plan_chunks(rows, "id", 300)
    counts = covered(rows, chunks)
    assert sum(counts) == 5000 and max(counts) <= 600
    assert len(chunks) >= 5000 / 600
    numbers = rows.select(chunk_number(chunks, "id").alias("n")).groupBy("n").count().collect()
    assert {r["n"]: r["count"] for r in numbers} == dict(enumerate(counts))


def test_dates(spark):
    rows = spark.range(2000).select(F.date_add(F.lit(datetime.date(2020, 1, 1)), F.col("id").cast("int")).alias("id"))
    assert max(covered(rows, plan_chunks(rows, "id", 150))) <= 300


def test_one_key_with_half_of_the_rows_and_nulls(spark):
    key = F.when(F.col("id") % 2 == 0, 77).when(F.col("id") % 5 != 0, F.col("id"))
    rows = spark.range(3000).select(key.cast("bigint").alias("id"))
    chunks = plan_chunks(rows, "id", 100)
    counts = covered(rows, chunks)
    assert sum(counts) == 3000
    hot = [c for c in chunks if (c.low is None or c.low <= 77) and (c.high is None or 77 < c.high)]
    assert len(hot) == 1


def test_small_tables(spark):
    rows = spark.range(0)
    assert plan_chunks(rows, "id", 10) == []
    one = spark.range(1)
    assert [c.predicate("id") for c in plan_chunks(one, "id", 10)] == ["1 = 1"] or covered(one, plan_chunks(one, "id", 10)) == [1]
    nulls = spark.range(50).select(F.lit(None).cast("bigint").alias("id"))
    assert sum(c.rows for c in plan_chunks(nulls, "id", 10)) == 50
