"""Long texts: spans, ratios and redaction as in short ones, in time that grows with the text."""

from __future__ import annotations

import re
import time

import pytest
from pyspark.sql import functions as F

from merchant_ledger.llm import secret_scan

DIGEST = "aZ3kQ9xW7bT5mR2vY8cN4pL6"


def redacted(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs).collect()}


def test_matches_beyond_a_block(spark):
    text = "é" + " token=abcdefgh1é\n" * 700 + "x"
    found = spark.createDataFrame([(text,)], "text string").select(
        secret_scan.matches(F.col("text"), secret_scan.ASSIGN).alias("m")
    ).first()["m"]
    assert [tuple(m) for m in found] == [(*m.span(), m[0]) for m in re.finditer("token=[a-z0-9]+", text)]
    assert redacted(spark, [text]) == {0: re.sub("abcdefgh1", "[secret]", text)}


def test_pieces(spark):
    text = "".join(chr(97 + i * i % 26) for i in range(3 * secret_scan.CHARACTERS)) + "é"
    c, n = secret_scan.CHARACTERS, len(text)
    places = [(0, 0), (0, 1), (c - 1, c + 1), (c, 2 * c), (0, n), (n - 1, n), (n, n), (5, 3 * c), (c - 1, c)]
    df = spark.createDataFrame([(text, a, b) for a, b in places], "text string, a int, b int")
    found = df.select("a", "b", secret_scan.piece(secret_scan.blocks_of(F.col("text")), F.col("a"), F.col("b"))).collect()
    assert [r[2] for r in found] == [text[r["a"] : r["b"]] for r in found]


def test_ratio_is_the_sum_over_transitions(spark):
    size = len(secret_scan.ALPHABET)
    model = [round((i * 37 % 101) / 10 - 5, 4) for i in range(size * size)]
    strings = [DIGEST, "a", "", "--", DIGEST * 100]
    place = secret_scan.ALPHABET.index
    expected = [sum(model[place(x) * size + place(y)] for x, y in zip(s, s[1:])) for s in strings]
    df = spark.createDataFrame([(s,) for s in strings], "s string").withColumn("t", secret_scan.table_of(model))
    df = df.select(secret_scan.log_ratio(F.col("s"), F.col("t")))
    assert [r[0] for r in df.collect()] == pytest.approx(expected)


def test_long_texts_take_seconds(spark):
    texts = ["password=hunter2hunter2 \n" * 4_000, DIGEST * 300]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    started = time.time()
    found = secret_scan.scan(docs, [0.5] * len(secret_scan.ALPHABET) ** 2).select("doc_id", F.size("_all")).collect()
    assert dict(map(tuple, found))[0] == 4_000 and time.time() - started < 40
