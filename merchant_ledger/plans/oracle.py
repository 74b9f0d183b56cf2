"""The same queries as SQL over the stored tables, for checking."""

from __future__ import annotations

# Change events of the table ``events``.
CHANGES = """
    SELECT event_id, ts,
           'P' || user_id AS order_id,
           'M' || (user_id % 20) AS mch_no,
           CAST(round(value * 100) AS BIGINT) AS amount,
           CASE event_type WHEN 'purchase' THEN 2 WHEN 'error' THEN 4 WHEN 'click' THEN 5
                           WHEN 'signup' THEN 0 ELSE 1 END AS state,
           ts < TIMESTAMP '2024-01-10' AS is_snapshot,
           CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'r'
                WHEN event_id % 17 = 0 THEN 'd' ELSE 'u' END AS op,
           epoch_us(ts) // 1000 AS ms
    FROM events"""

BUCKETS = """
    SELECT *,
           CASE WHEN state = 2 THEN amount ELSE 0 END AS b2,
           CASE WHEN state = 5 THEN amount ELSE 0 END AS b5,
           CASE WHEN state = 4 THEN amount ELSE 0 END AS b4
    FROM changes"""

PREVIOUS = """
    SELECT *,
           lag(state) OVER w AS prev_state, lag(amount) OVER w AS prev_amount,
           lag(b2) OVER w AS p2, lag(b5) OVER w AS p5, lag(b4) OVER w AS p4,
           row_number() OVER w = 1 AS is_first
    FROM bucketed
    WINDOW w AS (PARTITION BY mch_no, order_id, is_snapshot ORDER BY ts, event_id)"""

DELTAS = """
    SELECT *,
           CASE WHEN is_snapshot OR is_first THEN b2 ELSE b2 - p2 END AS d_success,
           CASE WHEN is_snapshot THEN b5 WHEN is_first THEN 0 ELSE b5 - p5 END AS d_refund,
           CASE WHEN is_snapshot THEN b4 WHEN is_first THEN 0 ELSE b4 - p4 END AS d_cancel
    FROM previous"""

SUMS = """
    SELECT *,
           CAST(sum(d_success) OVER w AS BIGINT) AS success_amount,
           CAST(sum(d_refund) OVER w AS BIGINT) AS refund_amount,
           CAST(sum(d_cancel) OVER w AS BIGINT) AS cancel_amount
    FROM deltas
    WINDOW w AS (PARTITION BY mch_no ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

RUNNING = """
    SELECT *,
           success_amount + refund_amount + cancel_amount AS total_amount,
           success_amount - refund_amount - cancel_amount AS net_amount,
           CASE WHEN is_snapshot THEN 'SNAPSHOT' ELSE 'INCREMENTAL' END AS event_type,
           ms AS update_time
    FROM sums"""

STEPS = {
    "changes": CHANGES,
    "bucketed": BUCKETS,
    "previous": PREVIOUS,
    "deltas": DELTAS,
    "sums": SUMS,
    "running": RUNNING,
}


def _with_steps(select: str, where: str | None = None) -> str:
    """``select`` over the named steps; ``where`` restricts the change events."""
    steps = dict(STEPS)
    if where:
        steps["changes"] += f" WHERE {where}"
    named = ",\n".join(f"{name} AS ({sql})" for name, sql in steps.items())
    return f"WITH {named}\n{select}"


AMOUNTS = "total_amount, success_amount, refund_amount, cancel_amount, net_amount"
RUNNING_ROWS = f"SELECT event_id, mch_no, {AMOUNTS}, event_type FROM running"
IS_SNAPSHOT = "ts < TIMESTAMP '2024-01-10'"

TOTALS = """
    SELECT mch_no,
           CAST(sum(d_success + d_refund + d_cancel) AS BIGINT) AS total_amount,
           CAST(sum(d_success) AS BIGINT) AS success_amount,
           CAST(sum(d_refund) AS BIGINT) AS refund_amount,
           CAST(sum(d_cancel) AS BIGINT) AS cancel_amount,
           CAST(sum(d_success - d_refund - d_cancel) AS BIGINT) AS net_amount
    FROM deltas GROUP BY mch_no"""

YUAN = "'¥' || printf('%.2f', {} / 100.0)"
TIME = "strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S')"


def _yuan(column: str) -> str:
    return YUAN.format(column)


INSTANT = """strftime(ts, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN ms % 1000 = 0 THEN '' ELSE printf('.%03d', ms % 1000) END || 'Z'"""

FAULT = "event_id % 16"
HAS_MERCHANT = f"{FAULT} NOT IN (5, 6)"
BAD_REASON = f"""
    CASE WHEN {FAULT} IN (1, 10) THEN 'not_json'
         WHEN {FAULT} = 2 THEN 'missing_image'
         WHEN {FAULT} = 9 THEN 'mistyped_value'
         WHEN {FAULT} = 3 THEN 'missing_snapshot_flag'
         WHEN {FAULT} = 7 THEN 'null_state'
         WHEN {FAULT} = 8 AND state IN (2, 4, 5) THEN 'null_amount' END"""

MESSAGE_PAIRS = """
    '{"mchNo": "' || mch_no || '", "totalAmount": ' || total_amount
    || ', "successAmount": ' || success_amount || ', "refundAmount": ' || refund_amount
    || ', "cancelAmount": ' || cancel_amount || ', "netAmount": ' || net_amount
    || ', "updateTime": ' || update_time || ', "eventType": "' || event_type || '"}'"""

DAMAGED_PAIRS = MESSAGE_PAIRS.replace(
    "|| total_amount", "|| total_amount || CASE event_id % 10 WHEN 5 THEN '.25' ELSE '' END"
).replace(
    "|| update_time",
    """|| CASE event_id % 10 WHEN 1 THEN '"abc"' WHEN 9 THEN '9223372036854775807'
        ELSE CAST(update_time AS VARCHAR) END""",
)

# The texts inside are those of functions/text.py, which the output must have.
SELECTS: dict[str, str] = {
    "cdc_parse": """SELECT event_id, order_id, mch_no, amount, state, op AS operation,
        is_snapshot, ms AS ts_ms FROM changes""",
    "cdc_row_image": """SELECT event_id, op = 'd' AS has_before, op <> 'd' AS has_after,
        order_id FROM changes""",
    "snapshot_flag": """SELECT event_id, is_snapshot AS by_source_flag, op = 'r' AS by_op_r
        FROM changes""",
    "table_filter": """SELECT event_id, 'pay' AS db, 'pay_order' AS "table", order_id
        FROM changes WHERE event_id % 5 <> 4""",
    "start_from_timestamp": """SELECT event_id, ms AS ts_ms, order_id FROM changes
        WHERE ts >= TIMESTAMP '2024-01-15'""",
    "cdc_quarantine": f"""SELECT event_id, bad_reason FROM
        (SELECT event_id, {BAD_REASON} AS bad_reason FROM changes)
        WHERE bad_reason IS NOT NULL""",
    "merchant_key_filter": f"""SELECT event_id, mch_no,
        CASE WHEN {FAULT} = 4 THEN false ELSE is_snapshot END AS is_snapshot
        FROM changes WHERE {HAS_MERCHANT} AND ({BAD_REASON}) IS NULL""",
    "discarded_events": f"""SELECT op AS operation, count(*) AS discarded FROM changes
        WHERE NOT ({HAS_MERCHANT}) GROUP BY op""",
    "state_buckets": """SELECT event_id, b2 AS success_amount, b5 AS refund_amount,
        b4 AS cancel_amount FROM bucketed""",
    "order_prev_state": """SELECT event_id, order_id, prev_state, prev_amount FROM previous
        WHERE NOT is_snapshot""",
    "order_latest_state": """SELECT mch_no, order_id,
        arg_max(state, (ts, event_id)) AS state, arg_max(amount, (ts, event_id)) AS amount
        FROM changes WHERE NOT is_snapshot GROUP BY mch_no, order_id""",
    "incremental_deltas": """SELECT event_id, d_success, d_refund, d_cancel FROM deltas
        WHERE NOT is_snapshot""",
    "merchant_running": RUNNING_ROWS,
    "merchant_running_sliced": RUNNING_ROWS,
    "order_contributions": """SELECT mch_no, order_id,
        CAST(sum(d_success) AS BIGINT) AS success_amount,
        CAST(sum(d_refund) AS BIGINT) AS refund_amount,
        CAST(sum(d_cancel) AS BIGINT) AS cancel_amount
        FROM deltas GROUP BY mch_no, order_id""",
    "merchant_totals": TOTALS,
    "merchant_totals_from_deltas": TOTALS,
    "merchant_latest": f"""SELECT mch_no, {AMOUNTS}, event_type, event_id FROM
        (SELECT *, row_number() OVER (PARTITION BY mch_no ORDER BY ts DESC, event_id DESC) AS n
         FROM running) WHERE n = 1""",
    "event_metrics": """SELECT count(*) FILTER (WHERE is_snapshot) AS snapshot_events_total,
        count(*) FILTER (WHERE NOT is_snapshot) AS incremental_events_total,
        count(*) AS output_records_total,
        CAST(3 * count(DISTINCT mch_no) AS BIGINT) AS stats_map_size FROM changes""",
    "negative_net_alerts": f"""SELECT event_id, mch_no, net_amount,
        '[ledger] ⚠️ 告警 | 商户：' || mch_no || ' | 净额为负：' || {_yuan("net_amount")}
        || ' | 可能存在异常' AS line FROM running WHERE net_amount < 0""",
    "stats_text_console": f"""SELECT event_id,
        '【实时商户统计】> MerchantStats{{商户号=''' || mch_no || ''', 支付成功=¥' || success_amount
        || ', 已退款=¥' || refund_amount || ', 已撤销=¥' || cancel_amount || ', 净额=¥' || net_amount
        || ', 事件=''' || event_type || ''', 时间=''' || {INSTANT} || '''}}' AS line FROM running""",
    "stats_text_basic": f"""SELECT event_id, '[ledger] | 商户：' || mch_no || ' | 总单量：'
        || total_amount || ' | 净额：' || {_yuan("net_amount")} || ' | 更新时间：' || {TIME} AS line
        FROM running""",
    "stats_text_verbose": f"""SELECT event_id, '[ledger] [详细] 商户：' || mch_no
        || ' | 成功：' || {_yuan("success_amount")} || ' | 退款：' || {_yuan("refund_amount")}
        || ' | 撤销：' || {_yuan("cancel_amount")} || ' | 净额：' || {_yuan("net_amount")}
        || ' | 类型：' || event_type || ' | 时间：' || {TIME} AS line FROM running""",
    "change_event_text": """SELECT event_id, 'CdcChangeEvent{orderId=''' || order_id
        || ''', mchNo=''' || mch_no || ''', amount=' || amount || ', state=' || state
        || ', op=''' || op || ''', isSnapshot=' || is_snapshot || '}' AS line FROM changes""",
    "stats_report": f"""SELECT event_id, concat_ws(chr(10),
        '【商户统计】' || strftime(ts, '%H:%M:%S'), '商户号: ' || mch_no, '事件类型: ' || event_type,
        '更新时间: ' || {TIME}, '总金额: ' || {_yuan("total_amount")},
        '成功金额: ' || {_yuan("success_amount")}, '退款金额: ' || {_yuan("refund_amount")},
        '撤销金额: ' || {_yuan("cancel_amount")}, '净额: ' || {_yuan("net_amount")},
        '原始数据: ' || {MESSAGE_PAIRS}) AS report FROM running""",
    "stats_json_roundtrip": f"""SELECT event_id, mch_no, {AMOUNTS}, update_time, event_type,
        'ack' AS disposition FROM running""",
    "bad_messages": """SELECT event_id, substr('#{"mchNo":"' || mch_no || '","totalAmount":'
            || total_amount || ',"successAmount":' || success_amount || ',"refundAmount":'
            || refund_amount || ',"cancelAmount":' || cancel_amount || ',"netAmount":' || net_amount
            || ',"updateTime":' || update_time || ',"eventType":"' || event_type || '"}', 1, 100) AS start,
            'reject' AS disposition FROM running
        WHERE event_id % 10 = 3""",
    "message_dispositions": """SELECT CASE event_id % 10 WHEN 3 THEN 'reject'
        WHEN 6 THEN 'requeue' WHEN 7 THEN 'requeue' ELSE 'ack' END AS disposition, count(*) AS messages
        FROM running GROUP BY 1""",
    "message_fallbacks": """SELECT event_id, CASE event_id % 3 WHEN 0 THEN '未知商户'
        WHEN 1 THEN 'None' ELSE mch_no END AS merchant,
        CASE event_id % 3 WHEN 2 THEN '未知类型' ELSE event_type END AS kind FROM running""",
    "first_messages": """SELECT event_id, mch_no FROM changes ORDER BY ts, event_id LIMIT 10""",
    "kafka_payload": """SELECT event_id, 3 AS fields, mch_no, net_amount, update_time
        FROM running""",
    "jdbc_rows": "SELECT mch_no, net_amount, update_time FROM running",
    "stream_merchant_running": RUNNING_ROWS,
    "stream_merchant_totals": TOTALS,
}

HANDOVER = f"""
    WITH changes AS ({CHANGES} WHERE NOT ({IS_SNAPSHOT})),
    bucketed AS ({BUCKETS}), previous AS ({PREVIOUS}), deltas AS ({DELTAS}),
    parts AS (
        SELECT mch_no, d_success AS s, d_refund AS r, d_cancel AS c FROM deltas
        UNION ALL
        SELECT 'M' || (o_custkey % 20),
               CASE WHEN o_orderstatus = 'F' THEN fen ELSE 0 END,
               CASE WHEN o_orderstatus = 'O' THEN fen ELSE 0 END,
               CASE WHEN o_orderstatus = 'P' THEN fen ELSE 0 END
        FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS fen FROM orders))
    SELECT mch_no, CAST(sum(s + r + c) AS BIGINT) AS total_amount,
           CAST(sum(s) AS BIGINT) AS success_amount, CAST(sum(r) AS BIGINT) AS refund_amount,
           CAST(sum(c) AS BIGINT) AS cancel_amount, CAST(sum(s - r - c) AS BIGINT) AS net_amount
    FROM parts GROUP BY mch_no"""

def _in_order(sql: str, order: str) -> str:
    """``sql`` with another order of the events."""
    backwards = ", ".join(f"{column} DESC" for column in order.split(", "))
    return sql.replace("ORDER BY ts, event_id", f"ORDER BY {order}").replace(
        "ORDER BY ts DESC, event_id DESC", f"ORDER BY {backwards}"
    )


ARRIVAL = """least(3, CAST(event_id % 50 = 0 AS INTEGER) + CASE
    WHEN ts >= TIMESTAMP '2024-01-22' THEN 3 WHEN ts >= TIMESTAMP '2024-01-15' THEN 2
    WHEN ts >= TIMESTAMP '2024-01-08' THEN 1 ELSE 0 END)"""


def _in_arrival_order(select: str) -> str:
    return _in_order(_with_steps(select), f"{ARRIVAL}, ts, event_id")


HANDOVER_STEPS = f"""
    WITH changes AS ({CHANGES} WHERE NOT ({IS_SNAPSHOT})),
    bucketed AS ({BUCKETS}), previous AS ({PREVIOUS}), changed AS ({DELTAS}),
    deltas AS (
        SELECT order_id, event_id, ts, mch_no, is_snapshot, ms, d_success, d_refund, d_cancel
        FROM changed
        UNION ALL
        SELECT 'O' || o_orderkey, NULL, NULL, 'M' || (o_custkey % 20), true, NULL,
               CASE WHEN o_orderstatus = 'F' THEN fen ELSE 0 END,
               CASE WHEN o_orderstatus = 'O' THEN fen ELSE 0 END,
               CASE WHEN o_orderstatus = 'P' THEN fen ELSE 0 END
        FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS fen FROM orders)
        WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 7 <> 0),
    sums AS ({_in_order(SUMS, "NOT is_snapshot, ts, event_id, order_id")}),
    running AS ({RUNNING})"""

HOT = _with_steps(RUNNING_ROWS).replace(
    "'P' || user_id AS order_id", "CASE WHEN event_id % 5 < 4 THEN 'HOT' ELSE 'P' || user_id END AS order_id"
).replace(
    "'M' || (user_id % 20) AS mch_no", "CASE WHEN event_id % 5 < 4 THEN 'M0' ELSE 'M' || (user_id % 20) END AS mch_no"
)

COVERED = "SELECT count(*) AS row_count, count(*) AS covered_once, true AS even FROM orders"

ORACLE = {
    **{name: _with_steps(select) for name, select in SELECTS.items()},
    "snapshot_running": _with_steps(RUNNING_ROWS, IS_SNAPSHOT),
    "incremental_running": _with_steps(RUNNING_ROWS, f"NOT ({IS_SNAPSHOT})"),
    "snapshot_totals": _with_steps(TOTALS, IS_SNAPSHOT),
    "handover_totals": HANDOVER,
    "handover_stream_running": f"""{HANDOVER_STEPS} SELECT order_id, event_id, mch_no, {AMOUNTS},
        event_type FROM running""",
    "handover_stream_totals": f"{HANDOVER_STEPS} {TOTALS}",
    "stream_batches_running": _in_arrival_order(RUNNING_ROWS),
    "start_from_timestamp_pruned": _with_steps(SELECTS["start_from_timestamp"]),
    "log_zones": _with_steps("""SELECT count(*) AS records, 0::BIGINT AS untimed, min(ms) AS first_ms,
        max(ms) AS last_ms, min(event_id) AS first_pos, max(event_id) AS last_pos FROM changes"""),
    "chunked_orders": COVERED,
    "chunked_orders_text_key": COVERED,
    "message_redelivery": _with_steps("""SELECT event_id, CASE event_id % 10 WHEN 3 THEN 'reject'
        WHEN 6 THEN 'dead' WHEN 7 THEN 'dead' ELSE 'ack' END AS outcome,
        CAST(CASE WHEN event_id % 10 = 3 THEN 1 WHEN event_id % 10 IN (6, 7) THEN 3
             WHEN event_id % 4 = 2 THEN 2 ELSE 1 END AS INTEGER) AS attempts FROM changes"""),
    "stream_hot_order_running": HOT,
    "stream_order_states": _in_arrival_order(SELECTS["order_latest_state"]),
    "stream_latest": _in_arrival_order(
        SELECTS["merchant_latest"].replace("ORDER BY ts DESC", f"ORDER BY {ARRIVAL} DESC, ts DESC")
    ),
    "stream_state_sizes": _with_steps("""SELECT mch_no, count(DISTINCT order_id) AS orders FROM changes
        WHERE NOT is_snapshot GROUP BY mch_no"""),
    "stream_batches_totals": _in_arrival_order(TOTALS),
    "merchant_totals_log_position": _in_order(_with_steps(TOTALS), "event_id % 20, event_id"),
    "merchant_latest_kafka_position": _in_order(
        _with_steps(SELECTS["merchant_latest"]), "event_id"
    ),
    "damaged_stats_report": _with_steps(
        SELECTS["stats_report"].replace(MESSAGE_PAIRS, DAMAGED_PAIRS).replace(
            TIME, f"CASE event_id % 10 WHEN 1 THEN 'abc' WHEN 9 THEN '9223372036854775807' ELSE {TIME} END"
        )
        + " WHERE event_id % 10 NOT IN (3, 6, 7)"
    ),
    "stats_report_extra_fields": _with_steps(
        SELECTS["stats_report"].replace(
            MESSAGE_PAIRS,
            f"""'{{"zzz": {{"a": 1, "b": [1, "x,y"]}}, ' || substr({MESSAGE_PAIRS}, 2)""",
        )
    ),
}
