"""Operators against brute force, on odd rows and on the smallest tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import samples
from pyspark.sql import functions as F

from merchant_ledger.llm import (
    components, language_model, mixing, ngram_join, packing, pii, quality_classifier, quality_rules, secret_scan,
    url_filters, vector_search,
)
from merchant_ledger.llm.queries import vocabulary

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", params=["odd", "table"])
def docs(request, spark):
    if request.param == "odd":
        return samples.frame(spark).cache()
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


def listed(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def same(found, expected):
    assert Counter(map(tuple, found)) == Counter(map(tuple, expected))


def test_empty_tables(spark):
    none = samples.frame(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    results = [
        mixing.op1(none), pii.op2(none), secret_scan.op3(none), packing.pack(none, vocabulary()),
        vector_search.op5(vectors), quality_classifier.op6(none, labels), ngram_join.op7(none),
        quality_rules.op8(none), language_model.op9(none), url_filters.op10(pages),
        quality_classifier.accepted(none, labels), ngram_join.without_near_duplicates(none),
        secret_scan.redacted(none), mixing.mixed(none),
    ]
    assert [r.count() for r in results] == [0] * len(results)


def test_mixing_equals_sql(spark, docs):
    table = docs.toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("documents", table.astype({"doc_id": "Int64"}))
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({mixing.ORACLE})").fetchall()
    found = mixing.op1(docs).select(columns).collect()
    same(found, expected)
    assert all(r["taken"] <= 3 * r["size"] for r in found)


def test_mixing_near_targets(spark):
    docs = spark.createDataFrame(
        [(i, "w " * (1 + i * 7 % 50), "abcd"[i * i % 4]) for i in range(4000)], "doc_id long, text string, source string"
    )
    taken, target = Counter(), {}
    for r in mixing.mix(docs).collect():
        taken[r["source"]] += r["copies"] * r["size"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - t) <= 50 for s, t in target.items())
    assert mixing.mixed(docs).columns == docs.columns


def pii_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(s):
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(s))]
        return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0

    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
              if all(int(x) <= 255 for x in m[0].split("."))]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
              if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return sorted(found)


def digest(spans, kinds):
    return hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans).encode()).hexdigest()


def test_personal_data(docs):
    expected = []
    for doc_id, text in listed(docs):
        spans = pii_spans(text or "")
        expected.append((doc_id, *[sum(s[1] == k for s in spans) for k in range(4)], digest(spans, pii.KINDS)))
    same([r[:6] for r in pii.op2(docs).collect()], expected)


@pytest.mark.parametrize("text, kind, found", [
    ("mail john.doe (at) example (dot) com now", 0, "john.doe (at) example (dot) com"),
    ("john dot doe at example dot com", 0, "john dot doe at example dot com"),
    ("é jоhn@еxample.com", 0, "jоhn@еxample.com"),
    ("10[dot]20[dot]30[dot]40", 1, "10[dot]20[dot]30[dot]40"),
    ("call plus one two three four five five five one two three four ok", 3,
     "plus one two three four five five five one two three four"),
])
def test_disguises(text, kind, found):
    assert [(k, text[a:b]) for a, k, b in pii.disguised(text, pii.detect(text))] == [(kind, found)]


@pytest.mark.parametrize("text", ["look at this dot", "we met at ten dot", "one two three", "at home. dot com", "naïve"])
def test_no_disguise(text):
    assert pii.disguised(text, []) == []


ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
    r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secret_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32])


def test_secrets(docs):
    expected = []
    for doc_id, text in listed(docs):
        spans = secret_spans(text or "")
        expected.append((doc_id, *[sum(s[1] == k for s in spans) for k in range(3)], digest(spans, secret_scan.KINDS)))
    found = secret_scan.op3(docs)
    same([r[:5] for r in found.collect()], expected)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_random_strings_and_redaction(spark):
    ordinary = " ".join(f"the quick internationalization_of_{k}_identifiers some/path/to/module.name" for k in range(40))
    key = "q7Zr9XkP2mVt4LwB8sYc1NdF6hJg3T"
    docs = spark.createDataFrame(
        [(1, ordinary), (2, f"é use {key} here"), (3, 'token = "abcdef1234567890" end'), (4, None)], "doc_id long, text string"
    )
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.op3(docs).collect()}
    assert spans == {1: "", 2: f"random:6:{6 + len(key)}", 3: "assign:0:25", 4: ""}
    texts = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs).collect()}
    assert texts == {1: ordinary, 2: "é use [secret] here", 3: 'token = "[secret]" end', 4: None}


def test_packing(docs):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary().tokenizer)
    tokenizer.encode_special_tokens = True
    want = Counter()
    for doc_id, text in listed(docs):
        want[doc_id, tuple(tokenizer.encode(text or "", add_special_tokens=False).ids) + (0,)] += 1
    lengths, pieces, places = Counter(), defaultdict(set), defaultdict(list)
    for r in packing.pack(docs, vocabulary()).collect():
        lengths[r["doc_id"], r["doc_tokens"]] += r["length"]
        pieces[r["doc_id"], r["doc_tokens"]].add((r["start"], r["length"], r["ids_crc32"]))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    expected = Counter()
    for (doc_id, ids), n in want.items():
        expected[doc_id, len(ids)] += n * len(ids)
        for start, length, crc in pieces[doc_id, len(ids)]:
            part = np.array(ids[start : start + length], dtype="<u4").tobytes()
            assert any(zlib.crc32(np.array(o[start : start + length], dtype="<u4").tobytes()) == crc
                       for d, o in want if d == doc_id and len(o) == len(ids)), part
    assert lengths == expected
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024 and at & at - 1 == 0


@pytest.mark.parametrize("counts", [{600: 1000}, {n: n % 7 for n in range(1, 1024)}, {1024: 5, 1: 1}, {700: 9, 324: 3, 5: 2}])
def test_plan_has_no_padding(counts):
    places, splits = packing.plan(counts)
    filled = Counter()
    for length, first, last, each, sequence, offset in places:
        for rank in range(first, last + 1):
            filled[sequence + (rank - first) // each] += length
    assert all(n <= 1024 and n & n - 1 == 0 for n in filled.values())
    assert sum(filled.values()) == sum(n * c for n, c in counts.items())


def test_vector_search(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 32)).astype("float32")
    x[300:700] = x[5]
    made = [(i, v.tolist()) for i, v in enumerate(x)]
    made += [(2000, None), (2001, [0.0] * 32), (2002, [float("nan")] * 32), (2003, [1.0]), (None, [1.0] * 32), (2004, [None] * 32)]
    table = spark.createDataFrame(made, "vec_id long, embedding array<float>")
    found = defaultdict(list)
    for r in vector_search.op5(table).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["score"], r["vec_id"]))
    hits = 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        best = [i for i in np.lexsort((np.arange(1500), d)) if i != q][:10]
        assert found[q] == sorted(found[q]) and len(found[q]) == 10 and all(abs(d[v] - s) < 1e-9 for s, v in found[q])
        hits += len({v for _, v in found[q]} & set(best))
    assert set(found) == set(range(0, 1500, 100)) and hits / 150 >= 0.9


def test_classifier_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.op6(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) >= 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)


def test_classifier_odd_rows(spark):
    docs = samples.frame(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(18)] + [(3, None), (3, 0)], "doc_id long, quality int")
    scores = [r["score"] for r in quality_classifier.op6(docs, labels).collect()]
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores)
    one = labels.where("quality = 1")
    assert {r["score"] for r in quality_classifier.op6(docs, one).collect()} == {1.0}


def near_groups(docs):
    sets = []
    for doc_id, text in listed(docs):
        found = samples.words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        n = len(found)
        sets.append((doc_id, {tuple(found[i : i + 3]) for i in range(n - 2)} if n > 2 else {tuple(found)} if n else set()))
    group = list(range(len(sets)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 90 * len(a | b):
                group[top(i)] = top(j)
    ids = defaultdict(set)
    for i, (doc_id, _) in enumerate(sets):
        ids[top(i)].add(doc_id)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in ids.items()}
    return [(doc_id, len(s), least[top(i)]) for i, (doc_id, s) in enumerate(sets)]


def test_ngram_join(docs):
    same(ngram_join.op7(docs).collect(), near_groups(docs))


def test_ngram_join_in_pairs(spark, monkeypatch):
    """With few shingles rare, lists are of pairs, and many sets just miss each other."""
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    rng = np.random.default_rng(3)
    made = []
    for group in range(3):
        base = [f"g{group}w{k}" for k in range(120)]
        for i in range(60):
            words = list(base)
            for at in rng.integers(0, 120, size=rng.integers(0, 5)):
                words[at] = f"e{rng.integers(0, 40)}"
            made.append((len(made), " ".join(words)))
    docs = spark.createDataFrame(made, "doc_id long, text string")
    same(ngram_join.op7(docs).collect(), near_groups(docs))


def test_one_of_each_group_stays(spark):
    docs = samples.frame(spark)
    kept = ngram_join.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    groups = {(i, n): c for i, n, c in near_groups(docs)}
    left = Counter(r["doc_id"] for r in kept.collect())
    assert left[100] == 1 and not any(left[i] for i in range(101, 108)) and left[3] == 1 and left[0] == 1
    assert set(left) >= {i for (i, n), c in groups.items() if i is not None and i == c}


def test_quality_rules(docs):
    expected = []
    for doc_id, text in listed(docs):
        w = samples.words(text)
        windows = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        inside = {j for i in range(len(w) - 7) if windows[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if samples.WORD.search(x)]
        failed = len(w) < 20 or 100 * len(inside) > 30 * len(w)
        expected.append((doc_id, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
                         len(lines) - len(set(lines)), len(inside), failed))
    found = quality_rules.op8(docs)
    same([r[:7] for r in found.collect()], expected)
    assert not found.where("base_failed and kept").count()
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()


def test_rules_keep_good_texts(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    rows = quality_rules.op8(docs).join(labels, "doc_id").where("not base_failed and label = 1").collect()
    good = [r["kept"] for r in rows]
    assert sum(good) / len(good) >= 0.99


def test_language_model(docs):
    split = [(d, language_model.tokens(t or "")) for d, t in listed(docs)]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    counts = Counter(w for d, ws in split if not held(d) for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = [(d, held(d), len(ws), sum(counts[w] > 0 for w in ws), n,
             round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, ws in split]
    found = language_model.op9(docs).collect()
    same([(*r[:5], round(r["base_score"], 6)) for r in found], base)
    assert all(r["score"] < 0 for r in found)


def test_model_beats_unigrams(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = language_model.op9(docs).where("held_out").groupBy().sum("score", "base_score").first()
    assert held[0] > held[1]


def test_url_filters(spark):
    page = '<html><link href="{}" rel="canonical"></html>'
    pages = spark.createDataFrame([
        (1, "http://WWW.Example.com/en/1?q#f", None), (2, "https://blog.example.com/en/x", ""),
        (3, "http://a.net/es/", ""), (4, "http://mynet/es/", ""), (5, "no url", ""), (6, None, None), (7, "x://a.org", ""),
        (8, "http://alias.org/1", page.format("http://a.net/fr/9")), (9, "http://alias.org/2", page.format("/1")),
        (10, "http://other.org/", page.format("http://alias.org/2")), (11, "http://b.org/", page.format("http://a.net/fr/7")),
        (12, "http://c.org/", ""), (8, "http://alias.org/1", None),
    ], "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://c.org/", "http://shop.com/x"), ("http://c.org/", "http://a.net/es/2")],
                                      "from_url string, to_url string")
    found = {r["page_id"]: tuple(r)[1:] for r in url_filters.judge(pages, redirects=redirects).collect()}
    assert found == {
        1: ("www.example.com", "/en/1", "www.example.com/en/", "allow"), 2: ("blog.example.com", "/en/x", "example.com/en/", "block"),
        3: ("a.net", "/es/", "net/es/", "block"), 4: ("mynet", "/es/", None, "allow"), 5: ("", "", None, "allow"),
        6: ("", "", None, "allow"), 7: ("a.org", "", None, "allow"), 8: ("alias.org", "/1", None, "block"),
        9: ("alias.org", "/2", None, "block"), 10: ("other.org", "/", None, "block"), 11: ("b.org", "/", None, "block"),
        12: ("c.org", "/", None, "allow"),
    }


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, size=(220, 2))] + [(k, k + 1) for k in range(400, 460)]
    group = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    expected = {x: g for x, g in group.items() if any(x in e and e[0] != e[1] for e in edges)}
    frame = spark.createDataFrame(edges + [(None, 1)], "u long, v long")
    assert {r["node"]: r["root"] for r in components.components(frame).collect()} == expected
