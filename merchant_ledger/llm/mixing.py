"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchant_ledger.llm.common import materialize, rank_within, words

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = "mix"


def targets(sizes: DataFrame, weights=WEIGHTS, cap: int = MOST_COPIES) -> DataFrame:
    """``sizes`` (source, source_size) with the size that the mix is to take of each source.

    Sources in code point order, null last, have the weights in turn. They share the size of
    all; a target stops at ``cap`` times its source's size, and what is over goes to the
    others by weight. In order of size per weight the stopped sources come first, so sums
    over the sources before find them without a loop. One row per source, in one task.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ordered) - 1) % len(weights) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn).cast("long"))
    everything = Window.partitionBy()
    before = Window.orderBy(
        F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last()
    ).rowsBetween(Window.unboundedPreceding, -1)
    exact = lambda c: c.cast("decimal(19,0)")
    most = F.col("source_size") * cap
    summed = weighed.select(
        "*",
        F.sum("source_size").over(everything).alias("all_size"),
        F.sum("weight").over(everything).alias("all_weight"),
        F.coalesce(F.sum(most).over(before), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    )
    full = summed.withColumn(
        "full",
        exact(most) * exact(F.col("all_weight") - F.col("weight_before"))
        <= exact(F.col("weight")) * exact(F.col("all_size") - F.col("size_before")),
    )
    rest_size = F.col("all_size") - F.sum(F.when(F.col("full"), most).otherwise(0)).over(everything)
    rest_weight = F.col("all_weight") - F.sum(
        F.when(F.col("full"), F.col("weight")).otherwise(0)
    ).over(everything)
    shared = F.col("weight").cast("double") * rest_size.cast("double") / F.nullif(rest_weight, F.lit(0)).cast("double")
    return full.select(
        "source", "source_size", F.when(F.col("full"), most.cast("double")).otherwise(shared).alias("target")
    )


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and ``copies``, how often the mix takes each.

    All documents of a source have the same expected copies, target / source_size, so the
    prefix sum of these is that rate times the document's rank. With one offset per source
    (the same in every run) a document is emitted once for each integer boundary that its
    step of the prefix sum crosses: at most ``cap`` times. Longest documents come first, so
    that a source's words miss its target by less than its longest document.

    Ranks are counts of the longer documents plus a rank among those of the same length,
    which are dealt into buckets: no source and no length is sorted as a whole. A null text
    has size 0; a null source is a source of its own; null or repeated doc_ids are ordered
    by the other columns, and rows equal in all columns are taken one by one. A source
    without words has target 0 and is not taken. No rows give no rows. Columns of ``docs``
    other than doc_id, text and source pass through, but for the names added here.
    """
    ours = ["size", "source_size", "target", "copies", "rank"]
    return _taken(_sized(docs.drop(*ours, "_source", "_longer", "_text", "_bucket", "_before", "_inside")), weights, cap, seed)


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumns({
        "size": F.size(words(F.col("text"))).cast("long"),
        "_source": F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")),
        "_text": F.xxhash64("text"),
    })


def _taken(sized: DataFrame, weights, cap: int, seed: str) -> DataFrame:
    lengths = materialize(
        sized.groupBy("_source", "source", "size").agg(F.count(F.lit(1)).alias("_n")), "mix-lengths"
    )
    per_source = targets(
        lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("_n")).cast("long").alias("source_size")),
        weights,
        cap,
    ).withColumn("_source", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))
    longer = Window.partitionBy("_source").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    steps = lengths.select(
        "_source", "size", F.coalesce(F.sum("_n").over(longer), F.lit(0)).alias("_longer")
    ).join(per_source.drop("source"), "_source")
    placed = rank_within(sized, ["_source", "size"], "doc_id", [F.col("doc_id"), F.col("_text")], steps)
    rank = F.col("_longer") + F.col("rank")
    rate = F.col("target") / F.nullif(F.col("source_size"), F.lit(0)).cast("double")
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.col("_source"))), 1, 8)
    offset = F.conv(digits, 16, 10).cast("long") / F.lit(4294967296.0)
    crossed = F.floor(rate * rank + offset) - F.floor(rate * (rank - 1) + offset)
    return placed.withColumn("copies", F.coalesce(crossed, F.lit(0)).cast("long")).drop(
        "_source", "_longer", "_text", "rank"
    )


def mixed(docs: DataFrame, weights=WEIGHTS, cap: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    rows = _sized(docs.select("doc_id", "text", "source", F.struct("*").alias("_row"))).drop("text")
    taken = _taken(rows, weights, cap, seed).where("copies > 0")
    return taken.select("_row", F.explode(F.sequence(F.lit(1), "copies"))).select("_row.*")


def op1(docs: DataFrame) -> DataFrame:
    """Per document what the mix takes of it: (doc_id, size, source_size, target, taken)."""
    return mix(docs.select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


ORACLE = f"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         coalesce('s' || source, 'n') AS k
  FROM documents),
s AS (SELECT k, source, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
w AS (
  SELECT *, ([1, 2, 3])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
b AS (
  SELECT *, sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight,
         coalesce(sum(3 * source_size) OVER o, 0) AS size_before,
         coalesce(sum(weight) OVER o, 0) AS weight_before
  FROM w WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (
  SELECT *, 3 * source_size * (all_weight - weight_before) <= weight * (all_size - size_before) AS is_full
  FROM b),
t AS (
  SELECT k, source_size, CASE WHEN is_full THEN (3 * source_size)::DOUBLE
         ELSE weight::DOUBLE
              * (all_size - sum(CASE WHEN is_full THEN 3 * source_size ELSE 0 END) OVER ())::DOUBLE
              / nullif(all_weight - sum(CASE WHEN is_full THEN weight ELSE 0 END) OVER (), 0)::DOUBLE
         END AS target
  FROM f),
r AS (
  SELECT d.*, row_number() OVER (
           PARTITION BY k ORDER BY size DESC, substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3), doc_id) AS rank
  FROM d),
c AS (
  SELECT doc_id, size, source_size, target, rank, target / nullif(source_size, 0)::DOUBLE AS rate,
         ('0x' || substr(md5('{SEED}|' || k), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
  FROM r JOIN t USING (k))
SELECT doc_id, size, source_size, target,
       (coalesce(floor(rate * rank + shift) - floor(rate * (rank - 1) + shift), 0))::BIGINT * size AS taken
FROM c
"""
