"""Runs by grammar against brute force over all periods."""

from __future__ import annotations

import hashlib
import random
import time
import zlib

import numpy as np
import pytest
import samples
from hypothesis import given, settings
from hypothesis import strategies as st

from merchant_ledger.llm import periodic_runs


def brute_force(words):
    """All periods are tried; longer ones than a run's smallest are left out."""
    kinds = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([kinds[w] for w in words])
    found = []
    for q in range(1, len(ids) // 4 + 1):
        equal = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        edges = np.flatnonzero(equal[1:] != equal[:-1])
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            n = end - start + q
            if n >= max(6, 4 * q) and not any(s <= start and start + n <= s + k for s, k, p in found if p < q and n >= p + q):
                found.append((start, n, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = samples.words(text)
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_force(words)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
        sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


@pytest.mark.parametrize("source", ["odd", "table"])
def test_query(spark, source):
    docs = samples.frame(spark) if source == "odd" else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = periodic_runs.op12(docs)
    assert found.columns == COLUMNS
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.collect()), key=order) == sorted((expected(*r) for r in rows), key=order)


def text_of(rng):
    kinds, made = rng.choice([1, 2, 3, 5, 20]), []
    while len(made) < rng.randint(0, 100):
        unit = [rng.randrange(kinds) for _ in range(rng.randint(1, 12))]
        times = rng.randint(1, 40 if len(unit) < 3 else 8)
        made += (unit * times)[: rng.randint(len(unit), len(unit) * times)]
        if rng.random() < 0.2:
            made = made * rng.randint(1, 4)
    return made[:400]


def test_runs_of_many_texts():
    rng = random.Random(7)
    texts = [text_of(rng) for _ in range(600)]
    assert [periodic_runs.runs(t) for t in texts] == [brute_force(t) for t in texts]
    words = [[str(i).encode() for i in t] for t in texts]
    assert periodic_runs.runs_of_texts(words) == [brute_force(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_any_sequence(ids):
    assert periodic_runs.runs(ids) == brute_force(ids)


def test_grammar_gives_the_sequence_back():
    rng = random.Random(9)
    for _ in range(200):
        ids = text_of(rng)
        kinds = max(ids, default=-1) + 1
        rules, rest = periodic_runs.re_pair(ids, kinds)
        spelled = [[i] for i in range(kinds)]
        for left, right in rules:
            spelled.append(spelled[left] + spelled[right])
        assert [i for symbol in rest for i in spelled[symbol]] == ids
        pairs = [pair for pair in zip(rest, rest[1:]) if pair[0] != pair[1]]
        assert len(pairs) == len(set(pairs))


def test_words_beyond_characters():
    """Tuples stand in for strings where a text has more words than there are characters."""
    ids = [1, 2, 3] * 5 + [0] * 9
    y, z = tuple(ids[:9]), tuple(ids[9:])
    squares = periodic_runs.prefix_squares
    found = periodic_runs.crossing(y, z, squares(z), squares(y[::-1]))
    assert found == {(0, 15, 3)}


def test_nested_and_long():
    unit = ["a"] * 7 + ["b"]
    words = [w.encode() for w in unit * 5]
    assert periodic_runs.runs_of_texts([words]) == [brute_force(words)]
    start = time.perf_counter()
    long = [str(i).encode() for i in range(30_000)] * 5
    assert periodic_runs.runs_of_texts([long]) == [[(0, 150_000, 30_000)]]
    assert periodic_runs.runs_of_texts([[b"x"] * 200_000]) == [[(0, 200_000, 1)]]
    assert time.perf_counter() - start < 30


def test_own_output(spark):
    docs = spark.createDataFrame([(1, "so so so so so so then"), (None, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert [tuple(r) for r in rows[1]["runs"]] == [(0, 6, 1)]
    assert rows[None]["n_runs"] == 0 and rows[None]["runs"] == []
    assert periodic_runs.op12(samples.frame(spark, [])).count() == 0
