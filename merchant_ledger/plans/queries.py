"""The registered queries: each reads the whole of a table below ``folder``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchant_ledger.functions import messages as msg
from merchant_ledger.functions import text
from merchant_ledger.functions.buckets import buckets
from merchant_ledger.operators import parsing, totals, transitions
from merchant_ledger.operators.slices import slice_if_hot
from merchant_ledger.schemas import BUCKETS, DELTAS, LOG_POSITION, MERCHANT
from merchant_ledger.session import shared_folder
from merchant_ledger.sinks.tables import jdbc_rows
from merchant_ledger.sources import tables
from merchant_ledger.sources.changes import KAFKA_SEQ
from merchant_ledger.sources.chunks import MOST, chunk_number, plan_chunks
from merchant_ledger.sources.messages import ACK, REJECT, first_messages, read_messages, rejected
from merchant_ledger.sources.tables import SEQ
from merchant_ledger.sources.zones import ZoneMap
from merchant_ledger.streaming import replay
from merchant_ledger.streaming.redelivery import DEAD
from merchant_ledger.streaming.states import order_states, state_sizes

PREFIX = "[ledger]"
START_MILLIS = 1705276800000  # 2024-01-15 00:00 UTC
# Small enough for the slices to be used on the smallest test tables.
TINY_GROUP = 400
SLICE_SECONDS = 6 * 3600
LOG_FILES = 12
CHUNKS = 20

AMOUNTS = ["total_amount", *BUCKETS, "net_amount"]
RUNNING = ["event_id", MERCHANT, *AMOUNTS, "event_type"]


def changes(spark: SparkSession, folder: str) -> DataFrame:
    return tables.change_events(tables.read_events(spark, folder))


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    return tables.to_envelopes(changes(spark, folder))


# --- parsing -------------------------------------------------------------------------


def cdc_parse(spark: SparkSession, folder: str) -> DataFrame:
    good = parsing.good_changes(parsing.classified(envelopes(spark, folder)))
    return good.select(
        "event_id", "order_id", "mch_no", "amount", "state", "operation", "is_snapshot", "ts_ms"
    )


def cdc_row_image(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parsing.parse_envelopes(envelopes(spark, folder))
    return parsed.select(
        "event_id",
        F.col("envelope.before").isNotNull().alias("has_before"),
        F.col("envelope.after").isNotNull().alias("has_after"),
        F.col("image.pay_order_id").alias("order_id"),
    )


def snapshot_flag(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parsing.parse_envelopes(envelopes(spark, folder))
    return parsed.select(
        "event_id",
        parsing.snapshot_flag("source_flag").alias("by_source_flag"),
        parsing.snapshot_flag("op_r").alias("by_op_r"),
    )


def table_filter(spark: SparkSession, folder: str) -> DataFrame:
    records = parsing.classified(envelopes(spark, folder))
    chosen = parsing.select_table(records, tables.DATABASE, tables.TABLE)
    return chosen.select("event_id", "db", "table", "order_id")


def start_from_timestamp(spark: SparkSession, folder: str) -> DataFrame:
    records = parsing.classified(envelopes(spark, folder))
    return parsing.start_from(records, START_MILLIS).select("event_id", "ts_ms", "order_id")


def start_from_timestamp_pruned(spark: SparkSession, folder: str) -> DataFrame:
    """As start_from_timestamp, from files of which only those are read that matter."""
    log, zones = shared_folder(spark, "log"), shared_folder(spark, "zones")
    tables.write_log(envelopes(spark, folder), log, LOG_FILES)
    zone_map = ZoneMap(spark, log, zones)
    zone_map.update()
    records = parsing.classified(zone_map.lines_from(START_MILLIS))
    late = parsing.start_from(records, START_MILLIS)
    return late.select(F.col("pos").alias("event_id"), "ts_ms", "order_id")


def log_zones(spark: SparkSession, folder: str) -> DataFrame:
    """What the zone map knows of a log that came in two parts."""
    log, zones = shared_folder(spark, "log"), shared_folder(spark, "zones")
    zone_map = ZoneMap(spark, log, zones)
    for number in range(2):
        part = envelopes(spark, folder).filter(F.col("event_id") % 2 == number)
        tables.write_log(part, f"{log}/part{number}", LOG_FILES)
        zone_map.update()
    return zone_map.zones().agg(
        F.sum("records").alias("records"),
        F.sum("untimed").alias("untimed"),
        F.min("first_ms").alias("first_ms"),
        F.max("last_ms").alias("last_ms"),
        F.min("first_pos").alias("first_pos"),
        F.max("last_pos").alias("last_pos"),
    )


def _chunks(rows: DataFrame, key: str) -> DataFrame:
    """How the planned chunks cover the rows: each once, none of more than twice its share."""
    size = max(1, rows.count() // CHUNKS)
    chunks = plan_chunks(rows, key, size)
    covered = rows.withColumns({
        "chunk": chunk_number(chunks, key),
        "times": sum((F.coalesce(F.expr(chunk.predicate(key)).cast("int"), F.lit(0)) for chunk in chunks), F.lit(0)),
    })
    per_chunk = covered.groupBy("chunk").agg(F.count("*").alias("n"), F.count_if(F.col("times") == 1).alias("once"))
    return per_chunk.agg(
        F.sum("n").alias("row_count"), F.sum("once").alias("covered_once"), (F.max("n") <= MOST * size).alias("even")
    )


def chunked_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of ``orders`` by a key whose values are dense at one end and rare at the other."""
    number = F.col("o_orderkey").cast("double")  # the cube of a long need not be one
    key = number * number * number
    return _chunks(spark.read.parquet(f"{folder}/orders.parquet").select(key.alias("id")), "id")


def chunked_orders_text_key(spark: SparkSession, folder: str) -> DataFrame:
    """The same by a text key, with a null and a quote in some."""
    number = F.col("o_orderkey")
    key = F.when(number % 100 != 0, F.concat(F.lit("o'"), number.cast("string")))
    return _chunks(spark.read.parquet(f"{folder}/orders.parquet").select(key.alias("id")), "id")


def with_faults(spark: SparkSession, folder: str) -> DataFrame:
    """All events as envelopes, some of them damaged in one of eight ways."""
    value = F.col("value")
    kind = F.col("event_id") % 16

    def without(pattern: str, instead: str = "") -> Column:
        return F.regexp_replace(value, pattern, instead)

    damaged = (
        F.when(kind == 1, F.substring(value, 1, 40))
        .when(kind == 2, without(r'"(before|after)":\{[^}]*\},'))
        .when(kind == 3, without(r'"source":\{[^}]*\}', '"source":{}'))
        .when(kind == 4, without(r',"source":\{[^}]*\}'))
        .when(kind == 5, without(r'"mch_no":"[^"]*"', '"mch_no":""'))
        .when(kind == 6, without(r'"mch_no":"[^"]*",'))
        .when(kind == 7, without(r',"state":[0-9]+'))
        .when(kind == 8, without(r'"amount":-?[0-9]+,'))
        .when(kind == 9, without(r'"amount":(-?[0-9]+),', '"amount":"x$1",'))
        .when(kind == 10, F.concat(value, F.lit(" }")))
        .otherwise(value)
    )
    return envelopes(spark, folder).withColumn("value", damaged)


def cdc_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    records = parsing.classified(with_faults(spark, folder))
    return parsing.quarantined(records).select("event_id", "bad_reason")


def merchant_key_filter(spark: SparkSession, folder: str) -> DataFrame:
    records = parsing.classified(with_faults(spark, folder))
    kept = parsing.good_changes(records, on_bad="quarantine")
    return kept.select("event_id", "mch_no", "is_snapshot")


def discarded_events(spark: SparkSession, folder: str) -> DataFrame:
    records = parsing.classified(with_faults(spark, folder))
    return parsing.discarded(records).groupBy("operation").agg(F.count("*").alias("discarded"))


# --- buckets, order states, deltas -----------------------------------------------------


def state_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return changes(spark, folder).select(
        "event_id", *[column.alias(name) for name, column in buckets().items()]
    )


def order_prev_state(spark: SparkSession, folder: str) -> DataFrame:
    events = changes(spark, folder).filter(~F.col("is_snapshot"))
    with_prev = transitions.with_previous_state(slice_if_hot(events, SEQ), SEQ)
    return with_prev.select(
        "event_id",
        "order_id",
        F.col("prev.state").alias("prev_state"),
        F.col("prev.amount").alias("prev_amount"),
    )


def order_latest_state(spark: SparkSession, folder: str) -> DataFrame:
    return transitions.latest_order_states(changes(spark, folder), SEQ)


def incremental_deltas(spark: SparkSession, folder: str) -> DataFrame:
    events = changes(spark, folder).filter(~F.col("is_snapshot"))
    return transitions.with_deltas(slice_if_hot(events, SEQ), SEQ).select("event_id", *DELTAS)


# --- totals --------------------------------------------------------------------------


def _running(events: DataFrame, **options) -> DataFrame:
    return totals.running_totals(events, SEQ, **options).select(*RUNNING)


def snapshot_running(spark: SparkSession, folder: str) -> DataFrame:
    return _running(changes(spark, folder).filter("is_snapshot"))


def incremental_running(spark: SparkSession, folder: str) -> DataFrame:
    return _running(changes(spark, folder).filter("not is_snapshot"))


def merchant_running(spark: SparkSession, folder: str) -> DataFrame:
    return _running(changes(spark, folder))


def merchant_running_sliced(spark: SparkSession, folder: str) -> DataFrame:
    """As merchant_running, along the path for merchants and orders too large for a task."""
    return _running(changes(spark, folder), rows_per_group=TINY_GROUP)


def snapshot_totals(spark: SparkSession, folder: str) -> DataFrame:
    events = changes(spark, folder).filter("is_snapshot")
    return totals.snapshot_totals(events).select(MERCHANT, *AMOUNTS)


def order_contributions(spark: SparkSession, folder: str) -> DataFrame:
    contributions = totals.order_contributions(changes(spark, folder), SEQ)
    return contributions.select(MERCHANT, "order_id", *BUCKETS)


def merchant_totals(spark: SparkSession, folder: str) -> DataFrame:
    return totals.merchant_totals(changes(spark, folder), SEQ).select(MERCHANT, *AMOUNTS)


def merchant_totals_from_deltas(spark: SparkSession, folder: str) -> DataFrame:
    summed = totals.merchant_totals_from_deltas(changes(spark, folder), SEQ)
    return summed.select(MERCHANT, *AMOUNTS)


def merchant_latest(spark: SparkSession, folder: str) -> DataFrame:
    latest = totals.latest_totals(changes(spark, folder), SEQ)
    return latest.select(MERCHANT, *AMOUNTS, "event_type", "event_id")


def _log_changes(spark: SparkSession, folder: str, **options) -> DataFrame:
    """Events parsed from a log whose file numbers grow by a digit."""
    file = F.concat(F.lit("log."), F.lit(999_990) + F.col("event_id") % 20)
    logged = tables.to_envelopes(changes(spark, folder), file)
    return parsing.good_changes(parsing.classified(logged, seq=LOG_POSITION))


def merchant_totals_log_position(spark: SparkSession, folder: str) -> DataFrame:
    logged = totals.merchant_totals(_log_changes(spark, folder), LOG_POSITION)
    return logged.select(MERCHANT, *AMOUNTS)


def merchant_latest_kafka_position(spark: SparkSession, folder: str) -> DataFrame:
    """A merchant's events are in one partition, by their offsets."""
    partition = F.substring(MERCHANT, 2, 9).cast("int") % 4
    events = _log_changes(spark, folder).withColumns(
        {"partition": partition, "offset": F.col("event_id")}
    )
    latest = totals.latest_totals(events, KAFKA_SEQ)
    return latest.select(MERCHANT, *AMOUNTS, "event_type", F.col("offset").alias("event_id"))


def handover_totals(spark: SparkSession, folder: str) -> DataFrame:
    """A table snapshot first, then the changes: totals of both."""
    first = tables.order_rows(spark.read.parquet(f"{folder}/orders.parquet"))
    then = changes(spark, folder).filter("not is_snapshot")
    parts = [totals.snapshot_totals(first), totals.merchant_totals(then, SEQ)]
    both = parts[0].unionByName(parts[1])
    return both.groupBy(MERCHANT).agg(*[F.sum(name).alias(name) for name in AMOUNTS])


def event_metrics(spark: SparkSession, folder: str) -> DataFrame:
    events = changes(spark, folder)
    return events.agg(
        F.count_if("is_snapshot").alias("snapshot_events_total"),
        F.count_if(~F.col("is_snapshot")).alias("incremental_events_total"),
        F.count("*").alias("output_records_total"),
        (F.count_distinct(MERCHANT) * 3).alias("stats_map_size"),
    )


# --- output forms --------------------------------------------------------------------


def running_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The changelog with the event's time as its update time."""
    running = totals.running_totals(changes(spark, folder), SEQ)
    return running.withColumn("update_time", tables.event_millis())


def negative_net_alerts(spark: SparkSession, folder: str) -> DataFrame:
    rows = running_rows(spark, folder).filter(F.col("net_amount") < 0)
    return rows.select("event_id", MERCHANT, "net_amount", text.alert_line(PREFIX).alias("line"))


def _lines(spark: SparkSession, folder: str, line: Column) -> DataFrame:
    return running_rows(spark, folder).select("event_id", line.alias("line"))


def stats_text_console(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder, text.console_line())


def stats_text_basic(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder, text.basic_line(PREFIX))


def stats_text_verbose(spark: SparkSession, folder: str) -> DataFrame:
    return _lines(spark, folder, text.verbose_line(PREFIX))


def change_event_text(spark: SparkSession, folder: str) -> DataFrame:
    events = changes(spark, folder).withColumn("operation", tables.operation())
    return events.select("event_id", text.event_text().alias("line"))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return running_rows(spark, folder).select("event_id", "ts", msg.stats_json().alias("value"))


def stats_report(spark: SparkSession, folder: str) -> DataFrame:
    read = read_messages(messages(spark, folder)).filter(F.col("disposition") == ACK)
    printed_at = F.date_format("ts", "HH:mm:ss")
    return read.select("event_id", msg.report(printed_at).alias("report"))


def stats_report_extra_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of messages with a field that the contract does not have."""
    extra = F.concat(F.lit('{"zzz":{"a":1,"b":[1, "x,y"]},'), F.substr("value", F.lit(2)))
    read = read_messages(messages(spark, folder).withColumn("value", extra))
    printed_at = F.date_format("ts", "HH:mm:ss")
    return read.select("event_id", msg.report(printed_at).alias("report"))


def damaged_stats_report(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of what is acked of messages with a time or an amount that is none."""
    read = read_messages(damaged_messages(spark, folder)).filter(F.col("disposition") == ACK)
    return read.select("event_id", msg.report(F.date_format("ts", "HH:mm:ss")).alias("report"))


def stats_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    read = read_messages(messages(spark, folder))
    fields = [F.col(f"stats.{f}").alias(name) for f, name in msg.FIELDS.items()]
    return read.select("event_id", *fields, "disposition")


def damaged_messages(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_id") % 10
    time = '"updateTime":([0-9]+)'
    damaged = (
        F.when(kind == 3, F.concat(F.lit("#"), "value"))
        .when(kind == 7, F.concat(F.lit("["), "value", F.lit("]")))
        .when(kind == 1, F.regexp_replace("value", time, '"updateTime":"abc"'))
        .when(kind == 5, F.regexp_replace("value", '"totalAmount":(-?[0-9]+)', '"totalAmount":$1.25'))
        .when(kind == 6, F.regexp_replace("value", '"netAmount":(-?[0-9]+)', '"netAmount":"$1"'))
        .when(kind == 9, F.regexp_replace("value", time, '"updateTime":9223372036854775807'))
        .otherwise(F.col("value"))
    )
    return messages(spark, folder).withColumn("value", damaged)


def bad_messages(spark: SparkSession, folder: str) -> DataFrame:
    bad = rejected(read_messages(damaged_messages(spark, folder)))
    return bad.select("event_id", msg.preview("value").alias("start"), "disposition")


def message_dispositions(spark: SparkSession, folder: str) -> DataFrame:
    read = read_messages(damaged_messages(spark, folder))
    return read.groupBy("disposition").agg(F.count("*").alias("messages"))


def message_redelivery(spark: SparkSession, folder: str) -> DataFrame:
    """Where each message ends, and after how many offers."""
    queue = replay.redelivery_of(spark, damaged_messages(spark, folder).select("event_id", "value"))
    ends = [
        queue.table(outcome).select("event_id", F.lit(outcome).alias("outcome"), F.col("attempt").alias("attempts"))
        for outcome in (ACK, REJECT, DEAD)
    ]
    return ends[0].unionByName(ends[1]).unionByName(ends[2])


def message_fallbacks(spark: SparkSession, folder: str) -> DataFrame:
    """Merchant and type as read from messages that lack them, or hold a null."""
    kind = F.col("event_id") % 3
    name = F.when(kind == 0, F.regexp_replace("value", '"mchNo":"[^"]*",', "")).when(
        kind == 1, F.regexp_replace("value", '"mchNo":"[^"]*"', '"mchNo":null')
    )
    value = F.when(kind == 2, F.regexp_replace("value", ',"eventType":"[^"]*"', "")).otherwise(name)
    read = read_messages(messages(spark, folder).withColumn("value", value))
    return read.select(
        "event_id",
        msg.merchant_or_fallback().alias("merchant"),
        msg.type_or_fallback().alias("kind"),
    )


def first_ten_messages(spark: SparkSession, folder: str) -> DataFrame:
    first = first_messages(messages(spark, folder), 10, SEQ)
    stats = read_messages(first)
    return stats.select("event_id", F.col("stats.mchNo").alias(MERCHANT))


def kafka_payload(spark: SparkSession, folder: str) -> DataFrame:
    payload = running_rows(spark, folder).select("event_id", msg.kafka_json().alias("value"))
    read = read_messages(payload)
    return read.select(
        "event_id",
        F.size("present").alias("fields"),
        F.col("stats.mchNo").alias("mch_no"),
        F.col("stats.netAmount").alias("net_amount"),
        F.col("stats.updateTime").alias("update_time"),
    )


def jdbc_insert_rows(spark: SparkSession, folder: str) -> DataFrame:
    return jdbc_rows(running_rows(spark, folder))


# --- streaming -----------------------------------------------------------------------


def stream_merchant_running(spark: SparkSession, folder: str) -> DataFrame:
    return replay.ledger_of(spark, folder).changelog().select(*RUNNING)


def stream_merchant_totals(spark: SparkSession, folder: str) -> DataFrame:
    return replay.ledger_of(spark, folder).totals().select(MERCHANT, *AMOUNTS)


def stream_hot_order_running(spark: SparkSession, folder: str) -> DataFrame:
    """Four of five events are of one order, whose rows are spread over tasks."""
    ledger = replay.ledger_of_hot_order(spark, folder, SLICE_SECONDS)
    return ledger.changelog().select(*RUNNING)


def stream_order_states(spark: SparkSession, folder: str) -> DataFrame:
    """The states that the stream has kept, read from its checkpoint."""
    ledger = replay.ledger_of_arrivals(spark, folder)
    return order_states(spark, f"{ledger.folder}/checkpoint")


def stream_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The latest totals per merchant, as the stream's own table has them."""
    latest = replay.latest_of_arrivals(spark, folder).table()
    return latest.select(MERCHANT, *AMOUNTS, "event_type", "event_id")


def stream_state_sizes(spark: SparkSession, folder: str) -> DataFrame:
    ledger = replay.ledger_of(spark, folder)
    return state_sizes(spark, f"{ledger.folder}/checkpoint")


def stream_batches_running(spark: SparkSession, folder: str) -> DataFrame:
    return replay.ledger_of_arrivals(spark, folder).changelog().select(*RUNNING)


def stream_batches_totals(spark: SparkSession, folder: str) -> DataFrame:
    """With a new base after every second batch."""
    ledger = replay.ledger_of_arrivals(spark, folder, batches_per_base=2)
    return ledger.totals().select(MERCHANT, *AMOUNTS)


def handover_stream_running(spark: SparkSession, folder: str) -> DataFrame:
    changelog = replay.ledger_after_hand_over(spark, folder).changelog()
    return changelog.select("order_id", *RUNNING)


def handover_stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    return replay.ledger_after_hand_over(spark, folder).totals().select(MERCHANT, *AMOUNTS)


QUERIES = {
    query.__name__: query
    for query in (
        cdc_parse,
        cdc_row_image,
        snapshot_flag,
        table_filter,
        start_from_timestamp,
        start_from_timestamp_pruned,
        log_zones,
        chunked_orders,
        chunked_orders_text_key,
        cdc_quarantine,
        merchant_key_filter,
        discarded_events,
        state_buckets,
        order_prev_state,
        order_latest_state,
        incremental_deltas,
        snapshot_running,
        incremental_running,
        merchant_running,
        merchant_running_sliced,
        snapshot_totals,
        order_contributions,
        merchant_totals,
        merchant_totals_from_deltas,
        merchant_latest,
        merchant_totals_log_position,
        merchant_latest_kafka_position,
        handover_totals,
        event_metrics,
        negative_net_alerts,
        stats_text_console,
        stats_text_basic,
        stats_text_verbose,
        change_event_text,
        stats_report,
        stats_report_extra_fields,
        stats_json_roundtrip,
        bad_messages,
        message_dispositions,
        message_redelivery,
        damaged_stats_report,
        message_fallbacks,
        first_ten_messages,
        kafka_payload,
        jdbc_insert_rows,
        stream_merchant_running,
        stream_merchant_totals,
        stream_hot_order_running,
        stream_order_states,
        stream_state_sizes,
        stream_latest,
        stream_batches_running,
        stream_batches_totals,
        handover_stream_running,
        handover_stream_totals,
    )
}
QUERIES["first_messages"] = QUERIES.pop("first_ten_messages")
QUERIES["jdbc_rows"] = QUERIES.pop("jdbc_insert_rows")
