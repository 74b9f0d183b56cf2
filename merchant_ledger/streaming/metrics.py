"""Event counters of the streaming job."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from merchant_ledger.operators.parsing import is_discarded

EVENTS = "ledger_events"
RECORDS = "ledger_records"


def observed_records(records: DataFrame) -> DataFrame:
    """Count the records of ``classified`` that will not become events. Use it before
    ``good_changes``."""
    return records.observe(
        RECORDS,
        F.count_if(F.col("bad_reason").isNotNull()).alias("bad_records_total"),
        F.count_if(is_discarded()).alias("discarded_events_total"),
    )


def observed(deltas: DataFrame) -> DataFrame:
    """Count events as they pass, at no cost of a second pass."""
    snapshot = F.col("is_snapshot")
    return deltas.observe(
        EVENTS,
        F.count_if(snapshot).alias("snapshot_events_total"),
        F.count_if(~snapshot).alias("incremental_events_total"),
        F.count(F.lit(1)).alias("output_records_total"),
    )


class EventCounters(StreamingQueryListener):
    """Sums the counts of all micro-batches. Register with ``spark.streams.addListener``.

    ``state_rows`` is the number of order states kept, as of the last micro-batch.
    """

    def __init__(self) -> None:
        self.counts: Counter[str] = Counter()
        self.state_rows = 0

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        self.add(event.progress)

    def add(self, progress) -> None:
        for name in (EVENTS, RECORDS):
            if name in progress.observedMetrics:
                self.counts.update(progress.observedMetrics[name].asDict())
        for operator in progress.stateOperators:
            self.state_rows = operator.numRowsTotal
