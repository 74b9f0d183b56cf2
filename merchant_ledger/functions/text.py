"""Text forms of amounts, times, totals and events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "Asia/Shanghai"

# Output texts and formats, character for character.
AMOUNT_FORMAT = "¥%.2f"
NO_AMOUNT = "0.00"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
NO_TIME_LOG = "-"
NO_TIME_REPORT = "未知时间"
NO_MERCHANT = "未知商户"
NO_TYPE = "未知类型"
CONSOLE_PREFIX = "【实时商户统计】"
STATS_FORMAT = (
    "MerchantStats{商户号='%s', 支付成功=¥%d, 已退款=¥%d, 已撤销=¥%d, "
    "净额=¥%d, 事件='%s', 时间='%s'}"
)
EVENT_FORMAT = (
    "CdcChangeEvent{orderId='%s', mchNo='%s', amount=%d, state=%d, op='%s', isSnapshot=%s}"
)
BASIC_FORMAT = "%s | 商户：%s | 总单量：%s | 净额：%s | 更新时间：%s"
VERBOSE_FORMAT = (
    "%s [详细] 商户：%s | 成功：%s | 退款：%s | 撤销：%s | 净额：%s | 类型：%s | 时间：%s"
)
ALERT_FORMAT = "%s ⚠️ 告警 | 商户：%s | 净额为负：%s | 可能存在异常"
REPORT_LABELS = {
    "head": "【商户统计】",
    "mchNo": "商户号: ",
    "eventType": "事件类型: ",
    "updateTime": "更新时间: ",
    "totalAmount": "总金额: ",
    "successAmount": "成功金额: ",
    "refundAmount": "退款金额: ",
    "cancelAmount": "撤销金额: ",
    "netAmount": "净额: ",
    "raw": "原始数据: ",
}


# A day inside the years 1 and 9999 in every zone.
TIME_RANGE = (-62135510400000, 253402214400000)


def yuan(fen: Column | str) -> Column:
    """An amount in 1/100 as text with two decimals; null has no currency sign."""
    fen = F.col(fen) if isinstance(fen, str) else fen
    return F.when(fen.isNull(), NO_AMOUNT).otherwise(F.format_string(AMOUNT_FORMAT, fen / 100.0))


def local_time(millis: Column | str, missing: str = NO_TIME_LOG, zone: str = ZONE) -> Column:
    """Epoch milliseconds as wall time of ``zone``, whatever the session's zone is.

    A number beyond the years 1 to 9999 is no time and is shown as it is.
    """
    millis = F.col(millis) if isinstance(millis, str) else millis
    is_time = millis.between(*TIME_RANGE)
    text = F.date_format(_wall_time(F.when(is_time, millis), zone), TIME_FORMAT)
    return F.when(millis.isNull(), missing).when(is_time, text).otherwise(millis.cast("string"))


def _wall_time(millis: Column, zone: str) -> Column:
    return F.convert_timezone(None, F.lit(zone), F.timestamp_millis(millis))


def iso_instant(millis: Column | str) -> Column:
    """Epoch milliseconds as ISO 8601 in UTC; milliseconds only where there are any."""
    millis = F.col(millis) if isinstance(millis, str) else millis
    part = F.pmod(millis, F.lit(1000))
    fraction = F.when(part == 0, "").otherwise(F.format_string(".%03d", part))
    seconds = F.date_format(_wall_time(millis, "UTC"), "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(seconds, fraction, F.lit("Z"))


def console_line(prefix: str = CONSOLE_PREFIX) -> Column:
    """A row of totals as printed to the console. Amounts stay in 1/100 there."""
    return F.concat(F.lit(f"{prefix}> "), stats_text())


def stats_text() -> Column:
    return F.format_string(
        STATS_FORMAT,
        "mch_no",
        "success_amount",
        "refund_amount",
        "cancel_amount",
        "net_amount",
        "event_type",
        iso_instant("update_time"),
    )


def event_text() -> Column:
    """A change event as text; missing values read ``null``."""
    return F.format_string(
        EVENT_FORMAT, "order_id", "mch_no", "amount", "state", "operation", "is_snapshot"
    )


def basic_line(prefix: str, zone: str = ZONE) -> Column:
    return F.format_string(
        BASIC_FORMAT,
        F.lit(prefix),
        "mch_no",
        F.col("total_amount").cast("string"),
        yuan("net_amount"),
        local_time("update_time", zone=zone),
    )


def verbose_line(prefix: str, zone: str = ZONE) -> Column:
    return F.format_string(
        VERBOSE_FORMAT,
        F.lit(prefix),
        "mch_no",
        yuan("success_amount"),
        yuan("refund_amount"),
        yuan("cancel_amount"),
        yuan("net_amount"),
        "event_type",
        local_time("update_time", zone=zone),
    )


def alert_line(prefix: str) -> Column:
    return F.format_string(ALERT_FORMAT, F.lit(prefix), "mch_no", yuan("net_amount"))
