"""Daily and per-minute analytics jobs over stored tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.operators.live import (
    STAT,
    STAT_KEY,
    active_viewers,
    airing_revenue,
    airing_viewers,
    revenue_stats,
)
from slotwise.operators.sessions import order_time_histogram, view_time_histogram
from slotwise.sources.schemas import LIVE_STAT_TABLE
from slotwise.sources.tables import append_table, replace_day_in_table, upsert_table
from slotwise.sources.versions import Change

# A tick touches the rows of its own day only.
STAT_PARTITION = ("data_type", "init_day")


def run_view_times(log: DataFrame, schedule: DataFrame, seconds_dim: DataFrame, table: str, day: date) -> None:
    """Recompute and replace one day of the viewing-time histogram."""
    replace_day_in_table(view_time_histogram(log, schedule, seconds_dim, [day]), table, day)


def run_order_times(log: DataFrame, schedule: DataFrame, seconds_dim: DataFrame, table: str, day: date) -> None:
    """Recompute and replace one day of the time-to-order histogram."""
    replace_day_in_table(order_time_histogram(log, schedule, seconds_dim, [day]), table, day)


def run_live_viewers(
    log: DataFrame, codes: DataFrame, schedule: DataFrame, table: str, as_of: datetime, mode: str = "append"
) -> None:
    """One tick of the live viewer statistics."""
    store_stats(airing_viewers(codes, schedule, active_viewers(log, as_of), as_of), table, mode)


def run_live_revenue(
    orders: DataFrame, programmes: DataFrame, table: str, now: datetime, mode: str = "append"
) -> None:
    """One tick of the live revenue statistics.

    With ``append`` each tick adds the last half hour again, as a polling job without deletes
    does; ``upsert`` replaces rows of the same minute, tape and type.
    """
    store_stats(revenue_stats(airing_revenue(orders, programmes, now)), table, mode)


def store_stats(stats: DataFrame, table: str, mode: str = "append", change: Change | None = None) -> None:
    """All rows of a tick in one write, in a table of ``LIVE_STAT_TABLE`` partitioned by ``STAT_PARTITION``."""
    stats = stats.select(*STAT, F.col("init_date").cast("date").alias("init_day"))
    if mode == "append":
        append_table(stats, table, STAT_PARTITION, change)
    elif mode == "upsert":
        upsert_table(
            stats.sparkSession, table, LIVE_STAT_TABLE, stats, STAT_KEY, STAT_PARTITION, key_in_partition=True, change=change
        )
    else:
        raise ValueError(f"unknown mode {mode!r}")
