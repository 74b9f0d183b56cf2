"""Values of assignments without quotes, and random strings without a digit."""

from __future__ import annotations

from pyspark.sql import functions as F

from merchant_ledger.llm import secret_scan


def test_values_and_strings_without_digits(spark, monkeypatch):
    ordinary = " ".join(f"the quick internationalization_of_{k}_identifiers some/path/to/module.name" for k in range(40))
    key = "qZxrKXkPvmVtWLwBzsYcQNdFjhJgGTbH"
    docs = spark.createDataFrame([
        (1, ordinary), (2, f"é use {key} here"), (3, "é password=hunter2hunter2 end"),
        (4, "api_key=ABCDEFGHIJ;Token: abc=def=ghi"),
    ], "doc_id long, text string")
    learned = []
    samples = secret_scan.labelled_samples
    monkeypatch.setattr(secret_scan, "labelled_samples", lambda d, f: (learned.append(f), samples(d, f))[1])
    texts = {r["doc_id"]: r["text"] for r in secret_scan.redacted(docs).collect()}
    assert texts == {
        1: ordinary, 2: "é use [secret] here", 3: "é password=[secret] end", 4: "api_key=[secret];Token: [secret]",
    }
    values = {r[0] for r in learned[0].select(F.explode("values")).collect()}
    assert values == {"hunter2hunter2", "ABCDEFGHIJ", "abc=def=ghi"}
