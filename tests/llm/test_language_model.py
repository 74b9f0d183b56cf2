"""The language model by its definition: a distribution, exact choices, the end apart, the head by its histogram."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from merchant_ledger.llm import language_model as lm


def test_gradient_is_that_of_the_log_probability():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 7, (4, 50)).astype(np.uint16)
    chosen = rng.integers(0, lm.WIDTH, 50)
    weights = rng.normal(size=(8, lm.WIDTH))
    total = lambda w: lm.log_shares(w, rows, chosen).sum()
    expected = np.zeros_like(weights)
    for i in np.ndindex(weights.shape):
        more, less = weights.copy(), weights.copy()
        more[i] += 1e-5
        less[i] -= 1e-5
        expected[i] = (total(more) - total(less)) / 2e-5
    for row in range(4):
        moved, squares = weights.copy(), np.full(8, 1e12)
        lm.descend(moved, squares, rows, chosen, 1e6)
    assert np.allclose(moved - weights, expected, atol=1e-3)


def test_every_choice_has_its_share():
    rng = np.random.default_rng(2)
    weights = rng.normal(size=(16, lm.WIDTH)).astype(np.float32)
    rows = np.repeat(rng.integers(0, 16, (4, 1)), lm.WIDTH, axis=1).astype(np.uint16)
    assert np.exp(lm.log_shares(weights, rows, np.arange(lm.WIDTH))).sum() == pytest.approx(1, abs=1e-5)


def test_probabilities_of_all_words_add_up_to_less_than_one(spark):
    """After a context, all known words, the end and a word that is unknown in each leaf are a distribution."""
    words = [f"w{i}" for i in range(60)] + ["the"] * 30 + ["of"] * 20
    rng = np.random.default_rng(3)
    texts = [" ".join(rng.choice(words, 12)) for _ in range(40)]
    learned = [(i, t) for i, t in enumerate(texts)]
    context = "the w7"
    every = sorted(set(" ".join(texts).split()))
    docs = learned + [(10_000 + i, f"{context} {w}") for i, w in enumerate(every)] + [(20_000, context)]
    found = {r["doc_id"]: r for r in lm.scored(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    # Texts with the context that are held out share its probability; the end follows each word by its own.
    held = [10.0 ** found[i]["score"] for i, _ in docs if i >= 10_000 and found[i]["held_out"]]
    assert sum(held) < 1 and all(p > 0 for p in held)


def test_the_end_is_no_word(spark):
    ids = [i for i in range(20) if zlib.crc32(str(i).encode()) % 7 != lm.HELD_OUT][:2]
    docs = spark.createDataFrame(list(zip(ids, ["\x00", "a"])), "doc_id long, text string")
    n, v = 4, 3
    for r in lm.op9(docs).collect():
        assert not r["held_out"] and r["train_tokens"] == n and r["n_known"] == 2
        assert r["base_score"] == pytest.approx(math.log10(2 / (n + v + 1)) + math.log10(3 / (n + v + 1)))


def test_head_takes_the_most_frequent(spark):
    counts = Counter({b"%d" % i: 1 + 10_000 // (i + 1) for i in range(500)})
    rows = spark.createDataFrame([(bytearray(w), 0, 0, c) for w, c in counts.items()], "word binary, kind int, leaf long, count long")
    for most in (0, 1, 10, 100, 1000):
        head = lm.most_frequent(rows, most)
        assert len(head) <= most and all(counts[w] == c for w, (c, _, _) in head.items())
        assert not head or min(c for c, _, _ in head.values()) >= max([c for w, c in counts.items() if w not in head], default=0)
    assert len(lm.most_frequent(rows, 1000)) == 500 and len(lm.most_frequent(rows, 100)) >= 90


def test_context_tells_words_of_a_class_apart(spark):
    """Both words have one ending, and so one class: only the second softmax can tell which follows."""
    docs = spark.createDataFrame(
        [(i, "red xing " * 40 if i % 2 else "blue ying " * 40) for i in range(3000)], "doc_id long, text string"
    ).coalesce(1)
    r = lm.op9(docs).where("held_out").groupBy().sum("score", "base_score", "n_tokens").first()
    assert r[0] / r[2] > -0.3 and r[1] / r[2] < -0.5


def test_tokens_of_a_batch_are_those_of_each_text():
    rng = np.random.default_rng(7)
    signs = list("aAbZ \t\n\x0b\x0c\r\x1c\x85\xa0éÉKİ\ud800\x00")
    for _ in range(60):
        texts = ["".join(rng.choice(signs, rng.integers(0, 25))) for _ in range(rng.integers(1, 6))]
        distinct, places, starts = lm.tokens_of(texts)
        assert [[distinct[i] for i in places[a:b]] for a, b in zip(starts, starts[1:])] == [lm.tokens(t) for t in texts]
        assert len(set(distinct)) == len(distinct)


def test_each_distinct_word_is_told_once_a_batch(monkeypatch):
    asked = []
    hashed = lm._hashed
    monkeypatch.setattr(lm, "_hashed", lambda parts: asked.extend(parts) or hashed(parts))
    *_, starts, h, kinds, slots, leaves, counts = lm._flat(["red fox " * 500] * 4, lm.Words({b"fox": 9}, {b"red": 5}))
    assert len(h) == starts[-1] == 4004 and len(asked) < 20
    assert slots[0] == 5 and counts[:2].tolist() == [-1, 9] and kinds[1000] == lm.WIDTH - 1


def test_step_adds_what_each_row_has():
    """Rows with one token and rows with several move by the sum of their gradients."""
    rng = np.random.default_rng(8)
    rows, chosen = rng.integers(0, 60, (1, 50)).astype(np.uint16), rng.integers(0, lm.WIDTH, 50)
    weights = rng.normal(size=(60, lm.WIDTH))
    gradient, one = np.zeros_like(weights), -np.exp(weights[rows[0]])
    one /= -one.sum(axis=1, keepdims=True)
    one[np.arange(50), chosen] += 1
    np.add.at(gradient, rows[0], one)
    squares = (gradient**2).sum(axis=1) / lm.WIDTH
    moved, found = weights.copy(), np.zeros(60)
    lm.descend(moved, found, rows, chosen, 0.1)
    assert np.allclose(found, squares)
    assert np.allclose(moved, weights + gradient * 0.1 / np.sqrt(squares + 1e-6)[:, None])


def test_slices_that_many_words_have_are_looked_up_once(monkeypatch):
    words = [b"", b"a", b"\xff\x00", lm.END] + [b"re%ded" % i for i in range(1000)]
    told, asked = lm.Words(own={b"a": 6}), []
    of = lm._Hashed.of
    monkeypatch.setattr(lm._Hashed, "of", lambda self, parts: asked.extend(parts) or of(self, parts))
    _, kinds, slots, leaves, _ = told(words)
    assert len(asked) < 20
    assert kinds.tolist() == [of(told.kinds, [w[-2:]])[0] for w in words] and kinds[3] == lm.WIDTH - 1
    shared = [of(told.shared, [w[:2]])[0] for w in words]
    assert slots.tolist() == shared[:1] + [6] + shared[2:]
    assert [x // lm.WIDTH for x in leaves.tolist()] == [k * lm.WIDTH + s for k, s in zip(kinds.tolist(), shared)]
