"""Every stage of the pipeline against brute force, on odd rows; each works on what the one before kept."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import samples
from test_near_stage import brute_force, planted

import corpus_pipeline
from merchant_ledger.llm import mixing, quality_classifier, secret_scan
from merchant_ledger.llm.common import materialize
from merchant_ledger.llm.queries import vocabulary

#: Base patterns, and which group of them is the secret.
RULES = [
    (re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
                r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 8),
    (re.compile("(AKIA[A-Z0-9]+)"), 16),
    (re.compile("([0-9a-f]+)"), 32),
]


def rows():
    """Odd rows, groups of near copies, secrets; then texts of junk, for the classifier to reject."""
    made = [r for r in samples.rows()]
    made += [(300 + i, t, "en", f"s{i % 4}", len(t), 0, 0, "y") for i, t in enumerate(planted()[:60])]
    made += [(500 + i, f"{'#$% ' * (20 + i)}{'!! ' * i}", "en", "s1", 90, 0, 0, "z") for i in range(30)]
    made += [(600, "so password=hunter2hunter2 and " + "0f" * 20, None, "s2", 70, 0, 0, None)]
    return made


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    samples.frame(spark, rows()).coalesce(2).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 0 if r[0] >= 500 else 1, None) for r in rows() if r[0] is not None and r[0] % 3]
    labels += [(302, None, None), (None, 1, 1), (303, 1, 0), (303, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def kept(spark, folder):
    """What each stage returns, from the documents on."""
    found = [spark.read.parquet(f"{folder}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found.append(materialize(stage(spark, found[-1], folder), f"test-{name}"))
    return found


def counted(docs):
    return Counter(map(tuple, docs.collect()))


def test_stages_are_those_asked_for(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_join", "secret_scan", "mix_sources", "pack_sequences",
    ]
    assert all(docs.columns == kept[0].columns for docs in kept)


def qualities(texts, learned):
    """Scores by the definition: Gaussian classes, covariances shrunk towards both's and towards the variances."""
    x = np.array([quality_classifier.statistics(t or "") for t in texts])
    own = [np.array([quality_classifier.statistics(t or "") for t, y in learned if y == k]) for k in (0, 1)]
    n = [len(o) for o in own]
    covs = [np.cov(o.T, bias=True) for o in own]
    both = (n[0] * covs[0] + n[1] * covs[1]) / sum(n)
    logs = []
    for k in (0, 1):
        cov = 0.9 * covs[k] + 0.1 * both + 0.05 * np.diag(np.diag(both).clip(1e-6))
        off = x - own[k].mean(axis=0)
        far = np.einsum("ij,ij->i", off, np.linalg.solve(cov, off.T).T)
        logs.append(np.log(n[k] / sum(n)) - 0.5 * far - 0.5 * np.linalg.slogdet(cov)[1])
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def test_quality(spark, folder, kept):
    votes = defaultdict(list)
    for r in spark.read.parquet(f"{folder}/labels.parquet").collect():
        if r["doc_id"] is not None and r["quality"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            votes[r["doc_id"]].append(r["quality"])
    docs = kept[0].collect()
    learned = [(r["text"], int(np.mean(votes[r["doc_id"]]) >= 0.5)) for r in docs if r["doc_id"] in votes]
    scores = qualities([r["text"] for r in docs], learned)
    ours = quality_classifier.op6(kept[0], spark.read.parquet(f"{folder}/labels.parquet")).collect()
    assert Counter((r["doc_id"], round(r["score"], 6)) for r in ours) == Counter(
        (r["doc_id"], round(float(s), 6)) for r, s in zip(docs, scores)
    )
    assert counted(kept[1]) == Counter(tuple(r) for r, s in zip(docs, scores) if s >= 0.7)
    gone = counted(kept[0]) - counted(kept[1])
    assert {r[0] for r in gone} & set(range(500, 530)) and kept[1].count() > 60


def test_near_copies(kept):
    docs = kept[1].collect()
    group = brute_force([r["text"] or "" for r in docs])
    expected, chosen = Counter(), {}
    for r, g in zip(docs, group):
        if not samples.words(r["text"]):
            expected[tuple(r)] += 1
        elif g not in chosen or (r["doc_id"] is None, r["doc_id"] or 0) < (chosen[g][0] is None, chosen[g][0] or 0):
            chosen[g] = tuple(r)
    # Of rows with one id and text any may stay: other columns are left out.
    key = lambda rows: Counter((r[0], r[1]) for r in rows.elements())
    assert key(counted(kept[2])) == key(expected + Counter(chosen.values()))


def test_secrets(kept):
    before, after = kept[2].collect(), kept[3].collect()
    spans = defaultdict(list)
    for r in secret_scan.op3(kept[2]).collect():
        spans[r["doc_id"]].append(r["spans"])
    expected = Counter()
    for r in before:
        text, cuts = r["text"], set()
        for pattern, least in RULES:
            for m in pattern.finditer(text or ""):
                value = m.group(1)
                if len(value) >= least:
                    cuts.add((m.start(1), m.end(1)))
        extra = [s.split(":") for s in spans[r["doc_id"]][0].split(",") if s.startswith("random")]
        cuts |= {(int(s), int(e)) for _, s, e in extra}
        if cuts:
            out, at = "", 0
            for start, end in sorted(cuts):
                if start >= at:
                    out += text[at:start] + "[secret]"
                at = max(at, end)
            text = out + text[at:]
        expected[r["doc_id"], text, len(text) if text is not None else None, r["source"]] += 1
    assert Counter((r["doc_id"], r["text"], r["n_chars"], r["source"]) for r in after) == expected
    assert "[secret]" in " ".join(r["text"] or "" for r in after)
    assert "hunter2" not in " ".join(r["text"] or "" for r in after)


def test_mix(kept):
    table = kept[3].toPandas().astype({"doc_id": "Int64"})
    con = duckdb.connect()
    con.register("documents", table)
    want = Counter()
    for doc_id, size, taken in con.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE}) WHERE size > 0").fetchall():
        want[doc_id] += taken // size
    mixed = [r for r in kept[4].collect() if samples.words(r["text"])]
    assert Counter(r["doc_id"] for r in mixed) == +want
    assert {tuple(r) for r in mixed} <= {tuple(r) for r in kept[3].collect()}


def test_pieces(spark, folder, kept):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary().tokenizer)
    tokenizer.encode_special_tokens = True
    ids = [(r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0]) for r in kept[4].collect()]
    pieces = corpus_pipeline.run(spark, folder).collect()
    tokens, places = Counter(), defaultdict(list)
    for p in pieces:
        tokens[p["doc_id"], p["doc_tokens"]] += p["length"]
        places[p["sequence_id"]].append((p["offset"], p["length"]))
        assert any(
            d == p["doc_id"] and len(i) == p["doc_tokens"]
            and zlib.crc32(np.array(i[p["start"] : p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"]
            for d, i in ids
        )
    want = Counter()
    for doc_id, own in ids:
        want[doc_id, len(own)] += len(own)
    assert tokens == want
    for found in places.values():
        ends = [0] + [offset + length for offset, length in sorted(found)]
        assert [offset for offset, _ in sorted(found)] == ends[:-1] and ends[-1] <= 1024


def test_empty_documents(spark, tmp_path):
    samples.frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
