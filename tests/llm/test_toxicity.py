"""The n-gram classifier: counts against brute force, held-out accuracy, odd rows and labels."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import samples

from merchant_ledger.llm import toxicity

SYLLABLES = ["an", "er", "tion", "the", "in", "ou", "le", "ment", "sch", "ung", "ha", "nd"]
STEMS = ["grubb", "vilex", "snorq"]


def corpus(n=1200, seed=3):
    """(doc_id, text, label): a fifth have words with one of three stems, with other endings each."""
    rng = np.random.default_rng(seed)
    made = []
    for i in range(n):
        words = ["".join(rng.choice(SYLLABLES, size=rng.integers(1, 4))) for _ in range(rng.integers(20, 400))]
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            words[rng.integers(len(words))] = str(rng.choice(STEMS)) + "".join(rng.choice(SYLLABLES, size=2))
        made.append((i, " ".join(words), int(bad)))
    return made


def held_out(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_texts(spark):
    made = corpus()
    docs = spark.createDataFrame([m[:2] for m in made], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id long, toxic int")
    rows = {r["doc_id"]: r for r in toxicity.op11(docs, labels).collect()}
    assert all(rows[i]["held_out"] == held_out(i) for i, _, _ in made)
    judged = [(rows[i]["predicted"], y) for i, _, y in made if held_out(i)]
    assert sum(p == y for p, y in judged) / len(judged) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows.values())
    # One insult more, at the end of a long clean text, moves its score.
    long = " ".join(t for _, t, y in made if not y)[:200_000]
    model = toxicity.fit(docs, labels)
    clean, insulted = model.score([toxicity.Buckets()(long), toxicity.Buckets()(long + " grubbanle vilexhand snorqouer")])
    assert insulted > clean


def test_held_out_labels_are_never_read(spark):
    made = corpus(300)
    docs = spark.createDataFrame([m[:2] for m in made], "doc_id long, text string")
    scores = []
    for flip in (0, 1):
        labels = [(i, 1 - y if flip and held_out(i) else y) for i, _, y in made]
        found = toxicity.op11(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
        scores.append({r["doc_id"]: r["score"] for r in found})
    assert scores[0] == scores[1]


def test_ratios_by_brute_force(spark):
    made = corpus(200)
    docs = spark.createDataFrame([m[:2] for m in made], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id long, toxic int")
    learned = [(set(toxicity.Buckets()(t).tolist()), y) for i, t, y in made if not held_out(i)]
    counts = defaultdict(Counter)
    for buckets, y in learned:
        counts[y].update(buckets)
    n = Counter(y for _, y in learned)
    rows = toxicity.labelled(docs, labels)
    assert {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()} == n
    ratio = toxicity.ratios(rows, n)
    prior = n[1] / (n[0] + n[1])
    for bucket in set(counts[0]) | set(counts[1]):
        bad, good = counts[1][bucket] + 4 * prior, counts[0][bucket] + 4 * (1 - prior)
        assert ratio[bucket] == pytest.approx(math.log((bad / n[1]) / (good / n[0])))
    unseen = next(b for b in range(toxicity.BUCKETS) if b not in counts[0] and b not in counts[1])
    assert ratio[unseen] == pytest.approx(0)


def test_buckets_are_those_of_words():
    buckets = lambda text: set(toxicity.Buckets()(text).tolist())
    assert buckets("Big  cat\n") == buckets("cat big") == buckets("big") | buckets("CAT")
    found = toxicity.Buckets()("a b " * 50_000 + "x" * 100_000)
    assert len(found) == len(set(found.tolist())) < 20
    assert len(buckets("")) == len(buckets(" \t")) == 0
    n_grams = sum(max(0, len("  ") + 7 - n + 1) for n in toxicity.SIZES)
    assert len(buckets("zebrahs")) == n_grams


def test_odd_rows_and_labels(spark):
    docs = samples.frame(spark)
    some = spark.createDataFrame(
        [(3, None, 1), (4, None, 0), (4, None, 1), (5, None, None), (None, None, 1), (100, None, 0), (101, None, 0), (3, None, 1)],
        "doc_id long, text string, toxic int",
    )
    found = toxicity.op11(docs, some).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(r["doc_id"] for r in docs.collect())
    assert all(0 <= r["score"] <= 1 for r in found)
    assert all(not r["held_out"] for r in found if r["doc_id"] is None)
    for label, expected in ((1, 1.0), (0, 0.0), (None, 0.5)):
        one = spark.createDataFrame([(3, label)], "doc_id long, toxic int")
        assert {r["score"] for r in toxicity.op11(docs, one).collect()} == {expected}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.op11(docs, none).collect()} == {0.5}
    assert toxicity.op11(samples.frame(spark, []), none).count() == 0


def test_bounded_sample(spark):
    made = corpus(200)
    docs = spark.createDataFrame([m[:2] for m in made], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in made], "doc_id long, toxic int")
    assert toxicity.labelled(docs, labels, most=50).count() == 50
