"""Evaluate an expensive column once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df.withColumns(columns)``, each of them computed a single time per row.

    The optimizer merges projections and pushes filters below them, and so copies a parsed
    column into every expression that refers to it. It leaves columns alone that depend on
    where they are computed. The condition is always true.
    """
    here = F.spark_partition_id() >= 0
    return df.withColumns({name: F.when(here, column) for name, column in columns.items()})
