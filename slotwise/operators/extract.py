"""Column-list extracts, whole or bounded by time."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from slotwise.operators.upsert import in_range


def extract_window(
    table: DataFrame, columns: Sequence[str], time_column: str, low: datetime, high: datetime
) -> DataFrame:
    """``columns`` of the rows with ``time_column`` in ``[low, high)``."""
    return table.where(in_range(table, time_column, low, high)).select(*columns)


def extract_snapshot(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    return table.select(*columns)


def sample_rows(table: DataFrame, rows: int = 10) -> DataFrame:
    """Any ``rows`` rows, for a look at a table; which ones is not defined."""
    return table.limit(rows)
