"""Quality classifier: a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_ledger.llm.common import materialize, remainder

FEATURES = [
    "words", "word_length", "kinds", "adjacent", "symbols", "shouts", "capitals", "digits", "lines", "line_kinds",
]
SYMBOLS, SHOUTS, DIGITS = b"#*$%&|<>{}[]\\^~=_@", b"!?", b"0123456789"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = CAPITALS + CAPITALS.lower()
THRESHOLD = 0.7
HELD_OUT, FOLDS = 2, 4


def statistics(text: str) -> list[float]:
    """Transformed statistics of a text: logarithms of counts, square roots of shares."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw)
    count = lambda chars: size - len(raw.translate(None, chars))
    share = lambda k, of: (min(1.0, k / of) if of else 0.0) ** 0.5
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        np.log1p(n),
        np.log1p(sum(map(len, words)) / n if n else 0),
        np.log1p(len(set(words))) / np.log1p(n) if n else 0.0,
        share(sum(map(eq, words, words[1:])), n),
        share(count(SYMBOLS), n),
        share(count(SHOUTS), n),
        share(count(CAPITALS), count(LETTERS)),
        share(count(DIGITS), size),
        np.log1p(n / len(lines)) if lines else 0.0,
        share(len(lines) - len(set(lines)), len(lines)),
    ]


def features(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and ``x``, the statistics of each whole text (null: empty)."""

    def made(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["x"] = [statistics(t) for t in frame.pop("text")]
            yield frame

    held = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    rows = docs.select(
        F.col("doc_id").cast("string"), held.alias("held_out"), F.coalesce("text", F.lit("")).alias("text")
    )
    kind = docs.schema["doc_id"].dataType
    made_rows = rows.mapInPandas(made, "doc_id string, held_out boolean, x array<double>")
    return made_rows.withColumn("doc_id", F.col("doc_id").cast(kind))


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log weights of both classes; or the one class's score."""

    means: list[np.ndarray]
    inverse: list[np.ndarray]
    constant: list[float]
    only: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1, from the difference of the two log densities."""
        if self.only is not None:
            return np.full(len(x), self.only)
        logs = [
            c - 0.5 * (((x - m) @ inv.T) ** 2).sum(axis=1)
            for m, inv, c in zip(self.means, self.inverse, self.constant)
        ]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -500, 500)))


def fit(featured: DataFrame, labels: DataFrame, pooled: float = 0.1, ridge: float = 0.05) -> Discriminant:
    """Learn from labelled documents that are not held out.

    Sums, and sums of products, are added up where the rows are; two rows of them come to
    the driver. Each class's covariance is shrunk towards that of both and towards a
    multiple of the identity. A document with several labels has the majority's, in a tie 1;
    null labels don't count. With labels of one kind or none, that kind's share is the score.
    """
    label = labels.where("quality is not null").groupBy("doc_id").agg(
        (F.avg("quality") >= 0.5).cast("int").alias("label")
    )
    rows = featured.where(~F.col("held_out")).join(label, "doc_id")
    d = len(FEATURES)
    x = [F.col("x")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(x[i]).alias(f"s{i}") for i in range(d)],
        *[F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i, j in pairs],
    ).collect()
    by = {r["label"]: r for r in sums}
    if len(by) < 2:
        return Discriminant([], [], [], only=float(next(iter(by))) if by else 0.5)
    means, covs, counts = [], [], []
    for k in (0, 1):
        r = by[k]
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        cov = np.zeros((d, d))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = r[f"p{i}_{j}"] / r["n"] - mean[i] * mean[j]
        means.append(mean), covs.append(cov), counts.append(r["n"])
    both = (counts[0] * covs[0] + counts[1] * covs[1]) / sum(counts)
    scale = np.diag(both).clip(1e-6)
    inverse, constant = [], []
    for k in (0, 1):
        shrunk = (1 - pooled) * covs[k] + pooled * both + ridge * np.diag(scale)
        factor = np.linalg.cholesky(shrunk)
        inverse.append(np.linalg.inv(factor))
        constant.append(float(np.log(counts[k] / sum(counts)) - np.log(np.diag(factor)).sum()))
    return Discriminant(means, inverse, constant)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score) per row of ``docs``.

    Only texts are inputs of a score. Statistics are written once, ten numbers per document.
    Null, empty and very long texts are scored as they are; rows with a null doc_id are
    scored but never learned from; repeated rows are scored each; no rows give no rows.
    """
    featured = materialize(features(docs), "quality-features")
    model = fit(featured, labels)

    def scores(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            x = np.array(frame.pop("x").tolist(), dtype=float).reshape(len(frame), len(FEATURES))
            yield frame.assign(score=model.score(x))

    text_id = featured.withColumn("doc_id", F.col("doc_id").cast("string"))
    result = text_id.mapInPandas(scores, "doc_id string, held_out boolean, score double")
    return result.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))


def op6(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, labels).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score reaches the threshold, as they are.

    The model is fitted on the statistics of ``docs``; a second pass over the texts scores
    and filters in one go, so no text is shuffled.
    """
    model = fit(materialize(features(docs), "quality-features"), labels)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t or "") for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
        return pd.Series(model.score(x))

    return docs.where(score(F.col("text")) >= THRESHOLD)
