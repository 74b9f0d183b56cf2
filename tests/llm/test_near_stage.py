"""The pipeline's near-duplicate stage against brute force, with copies of similarity 0.8 to 0.9."""

from __future__ import annotations

import numpy as np
import pytest
import samples

import corpus_pipeline
from merchant_ledger.llm import components, ngram_join


def brute_force(texts: list[str], size: int = 5, percent: int = 80) -> list[int]:
    """The least index in each text's group."""
    split = [samples.words(t.lower()) for t in texts]
    sets = [{tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or {tuple(w)} for w in split]
    group = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= percent * len(a | b) and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


def planted() -> list[str]:
    rng = np.random.default_rng(5)
    texts = []
    for g, n in enumerate((6, 9, 24, 45, 50, 55, 58, 62, 70, 120, 200)):
        base = [f"g{g}w{k}" for k in range(n)]
        texts.append(" ".join(base))
        for part in (0.12, 0.15, 0.2, 0.24, 0.25, 0.27, 0.4):
            own = f"p{part}".replace(".", "")
            texts.append(" ".join(base + [f"g{g}{own}x{k}" for k in range(round(part * n))]))
        for i in range(6):
            words = list(base)
            for at in rng.integers(0, n, size=rng.integers(1, 5)):
                words[at] = f"g{g}i{i}e{at}"
            texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("frequent", [100, 3])
def test_stage_keeps_one_of_each_group(spark, monkeypatch, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    texts = planted()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(brute_force(texts)))


def test_lengthened_copy_goes(spark):
    base = " ".join(f"w{k}" for k in range(200))
    longer = base + "".join(f" more{k}" for k in range(30))
    docs = spark.createDataFrame([(1, base), (2, longer)], "doc_id long, text string")
    assert [r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()] == [1]


def test_pair_of_many_lists_is_compared_a_few_times(spark, monkeypatch):
    """Texts that share a head or a tail just miss each other; each of its shingles is a list of them."""
    base = " ".join(f"b{k}" for k in range(158))
    ends = lambda name, i: " ".join(f"{name}{i}x{k}" for k in range(23))
    texts = [f"{ends('head', i)} {base} {ends('tail', j)}" for i in range(8) for j in range(8)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows, pairs = [], []
    distinct = type(docs).distinct

    def counted(frame):
        once = distinct(frame)
        if frame.columns == ["u", "v"]:
            rows.append(frame.count())
            pairs.append(once.count())
        return once

    monkeypatch.setattr(type(docs), "distinct", counted)
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(64)) == brute_force(texts)
    assert max(pairs) > 300 and sum(rows) < 5_000, (rows, pairs)


def edges_written(monkeypatch) -> list[int]:
    """Gets a 1 for each table of edges that the components write."""
    written, write = [], components.materialize

    def counted(df, purpose):
        written.extend([1] * (purpose == "edges"))
        return write(df, purpose)

    monkeypatch.setattr(components, "materialize", counted)
    return written


def test_components_end_with_the_round_that_makes_stars(spark, monkeypatch):
    written = edges_written(monkeypatch)
    stars = [(k % 5, 10 + k) for k in range(50)]
    frame = spark.createDataFrame([*stars, *stars, (7, 7), (None, 3)], "u long, v long")
    found = {(r["node"], r["root"]) for r in components.components(frame).collect()}
    assert found == {(10 + k, k % 5) for k in range(50)} | {(k, k) for k in range(5)}
    assert len(written) == 1
    path = spark.createDataFrame([(1, 2), (2, 3)], "u long, v long")
    assert {tuple(r) for r in components.components(path).collect()} == {(1, 1), (2, 1), (3, 1)}
    assert len(written) == 3


def test_rounds_without_new_links_leave_the_components(spark, monkeypatch):
    """Links of the first round, and 81 texts that just miss each other, for more rounds than one."""
    written = edges_written(monkeypatch)
    base = " ".join(f"b{k}" for k in range(158))
    ends = lambda name, i: " ".join(f"{name}{i}x{k}" for k in range(23))
    texts = [f"{ends('head', i)} {base} {ends('tail', j)}" for i in range(9) for j in range(9)]
    copied = " ".join(f"c{k}" for k in range(100))
    texts += [copied, f"{copied} one", f"{copied} two"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(brute_force(texts))) == list(range(82))
    assert len(written) <= 2, written


@pytest.mark.parametrize("pivots, more", [(1, 2), (2, 3)])
def test_links_of_later_rounds_join_components(spark, monkeypatch, pivots, more):
    """Texts without six blocks of one base link if they lack four of the same; the lists hold nearly all of them."""
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    monkeypatch.setattr(ngram_join, "MORE", more)
    joined, join = [], ngram_join._joined
    monkeypatch.setattr(ngram_join, "_joined", lambda *a: (joined.append(1), join(*a))[1])
    blocks = [" ".join(f"b{k}x{i}" for i in range(10)) for k in range(40)]
    texts = [" ".join(blocks[: 2 * i] + blocks[2 * i + 6 :]) for i in range(18) if i not in (5, 10)]
    order = np.random.default_rng(3).permutation(len(texts))
    texts = [texts[i] for i in order]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    expected = sorted(set(brute_force(texts)))
    assert len(expected) == 3 and sorted(r["doc_id"] for r in kept.collect()) == expected
    assert joined


def substituted(words: list[str], places, name: str) -> str:
    return " ".join(f"{name}e{at}" if at in set(places) else word for at, word in enumerate(words))


def test_near_copies_that_can_link_with_none_leave_the_lists(spark, monkeypatch):
    """Four words of 150 replaced cost 20 of 146 shingles: with a text of as many shingles no link is possible."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    looked_at, looked = [], ngram_join._compared
    monkeypatch.setattr(ngram_join, "_compared", lambda m, *a: (looked_at.append(m.count()), looked(m, *a))[1])
    words, rng = [f"b{k}" for k in range(150)], np.random.default_rng(7)
    places = [5 + 35 * np.arange(4) + rng.integers(0, 30, size=4) for _ in range(80)]
    texts = [substituted(words, p, f"t{i}") for i, p in enumerate(places)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(80)) == brute_force(texts)
    assert not looked_at, looked_at


@pytest.mark.parametrize("size, percent", [(5, 80), (3, 90)])
@pytest.mark.parametrize("pivots", [1, 16])
def test_links_between_sizes_are_found(spark, monkeypatch, size, percent, pivots):
    """Near copies with words replaced, left out and added, about as far apart as a link allows."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    monkeypatch.setattr(ngram_join, "PIVOTS", pivots)
    rng = np.random.default_rng(size)
    texts = []
    for group, n in enumerate((30, 48, 54, 60, 100, 150)):
        base = [f"g{group}w{k}" for k in range(n)]
        for i in range(28):
            least = int(rng.integers(0, n // 5))
            words = base[least if i % 3 else 0 : n - int(rng.integers(0, n // 8))]
            at = rng.integers(0, len(words), size=rng.integers(0, 1 + n // 30))
            texts.append(substituted(words, at, f"g{group}t{i % 9}") + f" g{group}more{i % 4}" * (i % 5))
    texts = [texts[i] for i in rng.permutation(len(texts))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = ngram_join.near_duplicates(docs, size, percent).collect()
    expected = brute_force(texts, size, percent)
    assert 12 < len(set(expected)) < len(texts) - 12
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(expected))
