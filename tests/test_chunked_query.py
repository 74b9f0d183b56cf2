"""The chunked orders, by keys whose cubes are no longs."""

from merchant_ledger.plans import queries


def test_large_keys(spark, tmp_path):
    first = 9_000_000
    spark.range(first, first + 4000).selectExpr("id AS o_orderkey").write.parquet(str(tmp_path / "orders.parquet"))
    found = queries.chunked_orders(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in found] == [(4000, 4000, True)]
