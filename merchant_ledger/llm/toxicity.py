"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_ledger.llm.common import batches_of, materialize, remainder

#: Lengths of the character n-grams, and how many buckets their hashes have.
SIZES = (3, 4, 5)
BITS = 18
BUCKETS = 1 << BITS
THRESHOLD = 0.3
HELD_OUT, FOLDS = 2, 4
#: At most so many labelled documents are learned from, in so many tasks.
LABELLED, TASKS = 200_000, 16
ROUNDS, BATCH, RATE, SHRINK = 4, 64, 0.01, 1e-5
#: Documents that both classes together have of every bucket beforehand, by their shares.
BEFOREHAND = 4

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Buckets:
    """The distinct buckets of a whole text: of the n-grams of its words in lower case.

    Each word has a blank before and after it, which belong to its n-grams.
    """

    def __init__(self):
        self.last = np.zeros(BUCKETS, np.int64)

    def __call__(self, text: str) -> np.ndarray:
        spaced = f" {' '.join(text.lower().split())} "
        points = np.frombuffer(spaced.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        blank = points == np.uint64(32)
        total, within, made = points, np.ones(len(points), bool), []
        with np.errstate(over="ignore"):
            for size in range(2, max(SIZES) + 1):
                n = max(0, len(points) - size + 1)
                total = total[:n] * _A + points[size - 1 :]
                if size > 2:
                    within = within[:n] & ~blank[size - 2 : size - 2 + n]
                if size in SIZES:
                    made.append((total[within[:n]] + np.uint64(size)) * _B >> np.uint64(64 - BITS))
        flat = np.concatenate(made).astype(np.int32)
        turn = np.arange(len(flat))
        self.last[flat] = turn
        return flat[self.last[flat] == turn]


@dataclass
class Linear:
    """``weights`` per bucket, ratios included, and a bias; or the one score there is."""

    weights: np.ndarray
    bias: float
    only: float | None = None

    def score(self, buckets: list[np.ndarray]) -> np.ndarray:
        if self.only is not None:
            return np.full(len(buckets), self.only)
        margins = np.array([self.weights[b].sum(dtype=np.float64) for b in buckets]) + self.bias
        return 1 / (1 + np.exp(-np.clip(margins, -500, 500)))


def labelled(docs: DataFrame, labels: DataFrame, most: int = LABELLED) -> DataFrame:
    """(label, buckets) of the documents to learn from: not held out, at most ``most`` of them.

    A document with several labels has the majority's, in a tie 1; null labels and null ids
    don't count. Which ones are taken beyond ``most`` follows a hash of their ids, before a
    text is read: what is broadcast has ``most`` rows at the most.
    """
    known = labels.where("toxic is not null and doc_id is not null").select("doc_id", "toxic")
    label = known.where(remainder(F.col("doc_id"), FOLDS) != HELD_OUT).groupBy("doc_id").agg(
        (F.avg("toxic") >= 0.5).cast("int").alias("label")
    )
    chosen = label.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = Buckets()
        for frame in batches_of(frames):
            yield pd.DataFrame({"label": frame["label"], "buckets": [buckets(t) for t in frame["text"]]})

    return texts.select("label", "text").mapInPandas(made, "label int, buckets array<int>")


def ratios(rows: DataFrame, sizes: dict[int, int]) -> np.ndarray:
    """Log-count ratios of all buckets; ``sizes`` has how many documents each class has.

    Each class counts in how many of its documents a bucket occurs. What is added beforehand
    has the classes' shares, so that the ratio of a bucket never seen is 0 however uneven
    the classes are. ``BUCKETS`` numbers per class come to the driver.
    """
    counted = (
        rows.select("label", F.explode("buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.sum("label").alias("bad"), F.count(F.lit(1)).alias("all"))
        .toPandas()
    )
    bad, good = (np.full(BUCKETS, BEFOREHAND * sizes[k] / sum(sizes.values())) for k in (1, 0))
    at = counted["bucket"].to_numpy()
    bad[at] += counted["bad"].to_numpy()
    good[at] += (counted["all"] - counted["bad"]).to_numpy()
    return np.log(bad / sizes[1]) - np.log(good / sizes[0])


def epoch(
    buckets: list[np.ndarray], labels: np.ndarray, weights: np.ndarray, bias: float, ratio: np.ndarray, seed: int
) -> tuple[np.ndarray, float]:
    """One pass of logistic regression with steps scaled per coordinate, in a fixed order."""
    weights, squares, bias_square = weights.copy(), np.full(BUCKETS, 1e-6), 1e-6
    order = np.random.default_rng(seed).permutation(len(labels))
    for first in range(0, len(order), BATCH):
        rows = order[first : first + BATCH]
        sizes = [len(buckets[i]) for i in rows]
        flat = np.concatenate([buckets[i] for i in rows]) if sum(sizes) else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(rows)), sizes)
        margin = np.bincount(owner, weights[flat] * ratio[flat], minlength=len(rows)) + bias
        off = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels[rows]
        step = np.bincount(flat, off[owner], minlength=BUCKETS) * ratio / len(rows)
        touched = np.flatnonzero(step)
        slope = step[touched] + SHRINK * weights[touched]
        squares[touched] += slope**2
        weights[touched] -= RATE * slope / np.sqrt(squares[touched])
        slope = off.mean()
        bias_square += slope**2
        bias -= RATE * slope / np.sqrt(bias_square)
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS, most: int = LABELLED) -> Linear:
    """Learn from labelled documents that are not held out.

    In each round every task goes through its own documents from the common weights; the
    means of what they return, by documents, are the next common weights. With labels of one
    kind or none, that kind's share is the score (0.5 without any).
    """
    rows = materialize(labelled(docs, labels, most), "toxic-buckets")
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return Linear(np.zeros(0), 0.0, only=float(next(iter(sizes))) if sizes else 0.5)
    ratio = ratios(rows, sizes)
    weights, bias = np.zeros(BUCKETS), float(np.log(sizes[1] / sizes[0]))
    dealt = rows.coalesce(TASKS)
    for turn in range(rounds):

        def made(frames: Iterator[pd.DataFrame], weights=weights, bias=bias, turn=turn) -> Iterator[pd.DataFrame]:
            frames = [f for f in frames if len(f)]
            if not frames:
                return
            buckets = [b for f in frames for b in f["buckets"]]
            label = np.concatenate([f["label"].to_numpy() for f in frames])
            moved, moved_bias = epoch(buckets, label, weights, bias, ratio, turn)
            yield pd.DataFrame({"n": [len(label)], "bias": [moved_bias], "w": [moved.astype(np.float32).tobytes()]})

        parts = dealt.mapInPandas(made, "n bigint, bias double, w binary").collect()
        n = sum(r["n"] for r in parts)
        weights = sum(np.frombuffer(r["w"], np.float32).astype(float) * (r["n"] / n) for r in parts)
        bias = sum(r["bias"] * r["n"] for r in parts) / n
    return Linear((weights * ratio).astype(np.float32), bias)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score) per row of ``docs``.

    A feature is whether an n-gram of a word occurs in the whole text, so one insult in a
    long text counts as much as in a short one. Only texts are inputs of a score. The model
    (one number per bucket) goes to the tasks, which score the texts where they are: no text
    is shuffled. Null and empty texts have the bias alone; rows with a null doc_id are scored
    but never learned from; repeated rows are scored each; no rows give no rows. Other
    columns of ``docs`` are not read.
    """
    model = fit(docs, labels)

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        buckets = Buckets()
        for frame in batches_of(frames):
            yield frame.assign(score=model.score([buckets(t) for t in frame["text"]])).drop(columns="text")

    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("string"), held.alias("held_out"), F.coalesce("text", F.lit("")).alias("text")
    )
    result = rows.mapInPandas(made, "doc_id string, held_out boolean, score double")
    return result.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op11(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, labels).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
