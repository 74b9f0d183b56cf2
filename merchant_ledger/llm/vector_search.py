"""Nearest neighbours by adaptive scans of rotated dimensions within probed lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from merchant_ledger.llm.common import materialize

NEAREST = 10
#: Centroids and rotation come from at most so many vectors, those with the least hashes of their ids.
SAMPLE = 20_000
MOST_LISTS = 1_024
#: Share of all lists that a query probes.
PROBED = 0.6
#: Columns per block, and how sure a test must be before it gives a candidate up.
BLOCK, SURE = 16, 2.1
#: Rows of one list, and queries, that meet in one task.
ROWS, QUERIES = 20_000, 2_000


def usable(vector: Column) -> Column:
    """Neither null nor zero, and no component is null or not finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def centroids(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """k-means from the first rows of a sample in random order."""
    centres = sample[np.random.default_rng(7).permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        nearest = assign(sample, centres)
        for k in np.unique(nearest):
            centres[k] = sample[nearest == k].mean(axis=0)
    return centres


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(axis=1) - 2 * rows @ centres.T


def assign(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return distances(rows, centres).argmin(axis=1)


def rotation(width: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(11).normal(size=(width, width)))
    return q * np.sign(np.diag(r))


def adaptive(query: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Positions of the rows that may be among the ``most`` nearest to the query; both rotated.

    After each block of columns the distance so far, scaled to all columns, is held against
    the distance that the best ``most`` have in full: a candidate stays as long as the test
    can't tell that it is farther. After rotation every block is like a random sample.
    """
    width = len(query)
    first = ((rows[:, :BLOCK] - query[:BLOCK]) ** 2).sum(axis=1)
    if len(rows) <= most:
        return np.arange(len(rows))
    best = np.argpartition(first, most - 1)[:most]
    limit = ((rows[best] - query) ** 2).sum(axis=1).max()
    alive, partial = np.arange(len(rows)), first
    for done in range(BLOCK, width + 1, BLOCK):
        part = min(1.0, done / width)
        slack = 1.0 if done >= width else (1 + SURE / np.sqrt(done)) ** 2
        stay = partial <= limit * part * slack * (1 + 1e-9)
        alive, partial = alive[stay], partial[stay]
        if done < width:
            step = slice(done, done + BLOCK)
            partial = partial + ((rows[alive, step] - query[step]) ** 2).sum(axis=1)
    return alive


def search(vectors: DataFrame, every: int = 100, nearest: int = NEAREST, probed: float = PROBED) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``nearest`` found of each query among all rows.

    Queries are the rows whose vec_id ``every`` divides. Equal vectors are searched once,
    and of equal candidates only the ``nearest`` + 1 least ids, with the count of their rows
    (``nearest`` at most), can be in a result, so a vector that very many rows have costs no more than others. Vectors lie in lists by
    nearest centroid; there are about as many lists as the root of half the rows. A query meets the rows
    of its nearest lists in blocks of bounded size, dealt by id; what the adaptive scan
    keeps is measured exactly, in double precision on the vectors as they are.

    Vectors that are null, zero, or hold null or non-finite components, rows without a
    vec_id, and vectors of another length than the most frequent one take no part. Ties go
    to the smaller vec_id. A repeated row is as many candidates. Fewer candidates give shorter results; no rows give none. The
    query's own row, and any with its vec_id, is no candidate. Other columns are not read.
    """
    spark = vectors.sparkSession
    found = vectors.select("vec_id", F.col("embedding").alias("v")).where(
        usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    )
    kept = nearest + 1
    same = Window.partitionBy("key", "v").orderBy("vec_id")
    found = found.withColumn("key", F.xxhash64("v"))
    rows = found.groupBy("key", "v", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(nearest)).alias("times"))
    rows = rows.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= kept)
    rows = rows.groupBy("key", "v").agg(F.sort_array(F.collect_list(F.struct("vec_id", "times"))).alias("ids"))
    rows = rows.select("key", "v", F.col("ids.vec_id").alias("ids"), F.col("ids.times").alias("times"))
    rows = materialize(rows, "near-rows")
    widths = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "width").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if widths is None:
        return empty
    width, total = widths["width"], widths["n"]
    rows = rows.where(F.size("v") == width)
    asked = found.where((F.size("v") == width) & (F.col("vec_id") % every == 0)).select("vec_id", "key", "v")
    picked = rows.select("v").orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(SAMPLE).toPandas()
    sample = np.array(picked["v"].tolist(), dtype=float)
    centres = centroids(sample, max(1, min(MOST_LISTS, round((total / 2) ** 0.5), len(sample))))
    n_lists = len(centres)
    n_probed = max(1, int(np.ceil(probed * n_lists)))
    turn = rotation(width)

    def listed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                yield frame.assign(list=assign(np.array(frame["v"].tolist(), dtype=float), centres))

    def probes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                far = distances(np.array(frame["v"].tolist(), dtype=float), centres)
                near = np.argpartition(far, n_probed - 1, axis=1)[:, :n_probed]
                yield frame.assign(lists=near.tolist())

    kind = rows.schema["v"].dataType.simpleString()
    placed = materialize(
        rows.mapInPandas(listed, f"key bigint, v {kind}, ids array<bigint>, times array<bigint>, list int"), "near-lists"
    )
    # So many vectors a query's vec_id may have at most, its own among them; none of them is a neighbour.
    own = asked.groupBy("key", "v", "vec_id").agg(F.lit(1).alias("one"))
    own = own.join(own.groupBy("vec_id").agg(F.count(F.lit(1)).alias("own")), "vec_id")
    searched = own.groupBy("key", "v").agg(F.max("own").alias("own"))
    searched = materialize(searched.withColumn("query", F.monotonically_increasing_id()), "near-searched")
    wanted = materialize(
        searched.select("key", "v", "query", "own").mapInPandas(probes, f"key bigint, v {kind}, query bigint, own bigint, lists array<int>").select(
            "query", "own", "v", F.explode("lists").alias("list")
        ),
        "near-probes",
    )
    # Two numbers per list: in how many blocks its rows and its queries are.
    sizes = placed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("row_blocks")).join(
        wanted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("query_blocks")), "list"
    )
    sizes = F.broadcast(materialize(sizes, "near-blocks"))
    dealt = lambda id_, blocks: F.pmod(F.xxhash64(id_), F.col(blocks)).cast("int")
    every_of = lambda blocks: F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))
    left = placed.join(sizes, "list").withColumns({"row_block": dealt("key", "row_blocks"), "query_block": every_of("query_blocks")})
    right = wanted.join(sizes, "list").withColumns({"query_block": dealt("query", "query_blocks"), "row_block": every_of("row_blocks")})
    group = ["list", "row_block", "query_block"]

    def met(some: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(some) and len(queries):
            exact = np.array(some["v"].tolist(), dtype=float)
            turned = exact @ turn
            ids, times = some["ids"].to_numpy(), some["times"].to_numpy()
            for query, own, vector in zip(queries["query"], queries["own"], queries["v"]):
                most = nearest + own
                q = np.array(vector, dtype=float)
                alive = adaptive(q @ turn, turned, most)
                score = np.sqrt(((exact[alive] - q) ** 2).sum(axis=1))
                best = np.argsort(score, kind="stable")
                if len(best) > most:
                    best = best[score[best] <= score[best[most - 1]]]
                for k in best:
                    parts.append((query, ids[alive[k]].tolist(), times[alive[k]].tolist(), score[k]))
        return pd.DataFrame(parts, columns=["query", "ids", "times", "score"])

    near = (
        left.select(*group, "v", "ids", "times").groupBy(*group)
        .cogroup(right.select(*group, "v", "query", "own").groupBy(*group))
        .applyInPandas(met, "query bigint, ids array<bigint>, times array<bigint>, score double")
        .select("query", F.inline(F.arrays_zip("ids", "times")), "score")
        .withColumnRenamed("ids", "vec_id")
    )
    # The ``kept`` vec_ids that come first, whichever of them is the query's own; of each, its nearest rows.
    first = F.min("score").over(Window.partitionBy("query", "vec_id"))
    nth = F.row_number().over(Window.partitionBy("query", "vec_id").orderBy("score"))
    near = near.withColumns({"first": first, "nth": nth}).where(F.col("nth") <= nearest)
    place = F.dense_rank().over(Window.partitionBy("query").orderBy("first", "vec_id"))
    near = near.withColumn("place", place).where(F.col("place") <= kept)
    top = near.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id", "times"))).alias("top"))
    names = asked.select(F.col("vec_id").alias("query_id"), "key", "v").join(
        searched.select("key", "v", "query"), ["key", "v"]
    )
    others = F.filter("top", lambda t: t["vec_id"] != F.col("query_id"))
    others = F.slice(F.flatten(F.transform(others, lambda t: F.array_repeat(t, t["times"].cast("int")))), 1, nearest)
    return (
        names.join(top, "query")
        .select("query_id", F.posexplode(others).alias("at", "t"))
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score"))
    )


def op5(vectors: DataFrame) -> DataFrame:
    return search(vectors)
