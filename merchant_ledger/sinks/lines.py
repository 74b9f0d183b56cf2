"""Totals as lines of text: to the console, to log files, to an alert file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchant_ledger.functions import text
from merchant_ledger.operators.totals import with_update_time
from merchant_ledger.schemas import MERCHANT


def _rows(totals: DataFrame) -> DataFrame:
    return with_update_time(totals).filter(F.col(MERCHANT).isNotNull())


def console_lines(totals: DataFrame, prefix: str = text.CONSOLE_PREFIX) -> DataFrame:
    return _rows(totals).select(text.console_line(prefix).alias("value"))


def log_lines(totals: DataFrame, prefix: str, verbose: bool = False) -> DataFrame:
    """One to three lines per row: basic, on request verbose, and an alert if net is
    negative. All in one pass over the rows."""
    alert = F.when(F.col("net_amount") < 0, text.alert_line(prefix))
    details = [text.verbose_line(prefix)] if verbose else []
    lines = F.array_compact(F.array(text.basic_line(prefix), *details, alert))
    return _rows(totals).select(F.explode(lines).alias("value"))


def alert_lines(totals: DataFrame, prefix: str) -> DataFrame:
    alerts = _rows(totals).filter(F.col("net_amount") < 0)
    return alerts.select(text.alert_line(prefix).alias("value"))


def console_sink(prefix: str = text.CONSOLE_PREFIX):
    """A ledger sink that prints every line of each micro-batch.

    Lines come to the driver partition by partition, never all at once.
    """

    def show(totals: DataFrame, batch_id: int) -> None:
        for row in console_lines(totals, prefix).toLocalIterator():
            print(row["value"])

    return show


def log_sink(folder: str, prefix: str, verbose: bool = False):
    """A ledger sink: one folder of text files per micro-batch, replaced on a rerun."""

    def write(totals: DataFrame, batch_id: int) -> None:
        lines = log_lines(totals, prefix, verbose)
        lines.write.mode("overwrite").text(f"{folder}/batch_id={batch_id}")

    return write
