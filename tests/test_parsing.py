"""Change envelopes: good ones, and each way of being bad."""

import json

import pytest

from merchant_ledger.operators import parsing


def envelope(**fields):
    order = {"pay_order_id": "O1", "mch_no": "M1", "amount": 100, "state": 2}
    base = {"op": "u", "before": None, "after": order, "source": {"snapshot": "false"}}
    return json.dumps({**base, **fields})


def order(**fields):
    return {"pay_order_id": "O1", "mch_no": "M1", "amount": 100, "state": 2, **fields}


def records(spark, *values, **options):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value string")
    return parsing.classified(df, **options)


def reason(spark, value):
    return records(spark, value).first().bad_reason


def without(name):
    fields = order()
    del fields[name]
    return fields


BAD = {
    "": "not_json",
    "nope": "not_json",
    '{"op":"u",': "not_json",
    "5": "not_json",
    "null": "not_json",
    "[1]": "not_json",
    '[{"op":"u"}]': "not_json",
    envelope() + " x": "not_json",
    envelope() + "," + envelope(): "not_json",
    envelope(after=None): "missing_image",
    envelope(op="d"): "missing_image",
    envelope(op=None, after=None): "missing_image",
    envelope(source={}): "missing_snapshot_flag",
    envelope(source={"snapshot": None}): "missing_snapshot_flag",
    envelope(source={"snapshot": ""}): "missing_snapshot_flag",
    envelope(after=order(amount="x")): "mistyped_value",
    envelope(after=order(state={"a": 1})): "mistyped_value",
    envelope(after=without("state")): "null_state",
    envelope(after=order(amount=None)): "null_amount",
    envelope(after=order(amount=None, state=5)): "null_amount",
}

GOOD = {
    envelope(): False,
    envelope(source=None): False,
    envelope(source={"snapshot": "true"}): True,
    envelope(source={"snapshot": True}): True,
    envelope(source={"snapshot": 1}): True,
    envelope(source={"snapshot": "1"}): True,
    envelope(source={"snapshot": "last"}): False,
    envelope(source={"snapshot": False}): False,
    envelope(after=order(amount=None, state=1)): False,
    envelope(after=order(deleted=True)): False,
    envelope(op=None): False,
    envelope(after=order(amount="100", state="2")): False,
    envelope(after=order(mch_no=" ")): False,
}


def test_bad_records(spark):
    rows = records(spark, *BAD).collect()
    assert {list(BAD)[r.id]: r.bad_reason for r in rows} == BAD


def test_null_value_is_bad(spark):
    assert reason(spark, None) == "not_json"


def test_good_records(spark):
    rows = parsing.good_changes(records(spark, *GOOD)).collect()
    assert {list(GOOD)[r.id]: r.is_snapshot for r in rows} == GOOD


def test_delete_uses_the_row_before(spark):
    value = envelope(op="d", before=order(amount=7), after=None)
    row = parsing.good_changes(records(spark, value)).first()
    assert (row.order_id, row.amount, row.operation) == ("O1", 7, "d")


def test_other_operations_use_the_row_after(spark):
    value = envelope(op="c", before=order(amount=7))
    assert parsing.good_changes(records(spark, value)).first().amount == 100


def test_fail_is_the_default(spark):
    df = parsing.good_changes(records(spark, envelope(), "nope"))
    with pytest.raises(Exception, match="bad change record: not_json"):
        df.collect()
    with pytest.raises(Exception, match="bad change record"):
        df.count()  # no column of the result is needed, it must fail all the same


def test_quarantine(spark):
    all_records = records(spark, envelope(), "nope", envelope(after=None))
    assert [r.id for r in parsing.good_changes(all_records, "quarantine").collect()] == [0]
    bad = parsing.quarantined(all_records).orderBy("id").collect()
    assert [(r.id, r.value, r.bad_reason) for r in bad] == [
        (1, "nope", "not_json"),
        (2, envelope(after=None), "missing_image"),
    ]


def test_events_without_merchant_are_discarded_before_they_can_be_bad(spark):
    values = [
        envelope(after=order(mch_no="")),
        envelope(after=order(mch_no=None)),
        envelope(after=order(mch_no="", state=None)),
        envelope(),
    ]
    all_records = records(spark, *values)
    assert [r.id for r in parsing.good_changes(all_records).collect()] == [3]
    assert parsing.discarded(all_records).count() == 3
    assert parsing.quarantined(all_records).count() == 0


def test_snapshot_by_operation(spark):
    values = [envelope(op="r", source={}), envelope(source={"snapshot": "true"})]
    rows = parsing.good_changes(records(spark, *values, snapshot_by="op_r")).collect()
    assert {r.id: r.is_snapshot for r in rows} == {0: True, 1: False}
    with pytest.raises(ValueError):
        records(spark, envelope(), snapshot_by="other")


def test_table_and_start(spark):
    source = {"snapshot": "false", "db": "pay", "table": "pay_order"}
    values = [
        envelope(source=source, ts_ms=10),
        envelope(source={**source, "table": "t"}, ts_ms=20),
        envelope(source={**source, "db": "x"}, ts_ms=20),
        envelope(source=source, ts_ms=20),
    ]
    chosen = parsing.select_table(records(spark, *values), "pay", "pay_order")
    assert [r.id for r in chosen.orderBy("id").collect()] == [0, 3]
    assert [r.id for r in parsing.start_from(chosen, 11).collect()] == [3]


def test_unreadable_records_pass_the_table_and_time_filters(spark):
    values = ["nope", envelope(source=None), envelope(source={"db": "other"})]
    chosen = parsing.select_table(records(spark, *values), "pay", "pay_order")
    kept = parsing.start_from(chosen, 11)
    assert [r.id for r in kept.orderBy("id").collect()] == [0, 1]
    assert [r.id for r in parsing.quarantined(kept).collect()] == [0]


def test_envelope_is_parsed_once(spark):
    df = parsing.good_changes(records(spark, envelope()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
