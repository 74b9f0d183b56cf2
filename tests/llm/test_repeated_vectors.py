"""Vector search on repeated rows, against brute force."""

from __future__ import annotations

from collections import Counter

import numpy as np

from merchant_ledger.llm import vector_search


def test_repeated_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 16)).astype("float32")
    x[30:45] = x[7]
    made = [(i, v) for i, v in enumerate(x)]
    made += [(0, x[0])] * 11 + [(10, x[10])] * 2 + [(11, x[10])] * 3 + [(20, x[7])] * 4 + [(8, x[7])] * 25
    made += [(30, x[30])] * 12 + [(40, x[0] + np.float32(k / 1000)) for k in range(1, 16)] + [(50, x[50] + np.float32(0.001 * k)) for k in range(14)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in made], "vec_id long, embedding array<float>")
    found = vector_search.search(table, every=10, probed=1.0).collect()
    expected = Counter()
    for q, v in made:
        if q % 10 == 0:
            score = [(float(np.sqrt(((w.astype(float) - v.astype(float)) ** 2).sum())), i) for i, w in made if i != q]
            expected.update((q, k, i, round(s, 9)) for k, (s, i) in enumerate(sorted(score)[:10], 1))
    assert Counter((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in found) == expected
