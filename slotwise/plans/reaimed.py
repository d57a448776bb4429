"""Jobs whose rule is our own definition.

Their counterparts are known by name and arguments only, so these jobs do what the name and the
tables around it suggest.  No equality with anything else is claimed.
"""

from __future__ import annotations

from calendar import monthrange
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slotwise.functions.timeops import shift_month
from slotwise.operators.dims import second_dim
from slotwise.operators.upsert import in_range
from slotwise.plans.warehouse import SECOND_DIM
from slotwise.sources.readers import read_csv
from slotwise.sources.schemas import ORDER_PROMOTION, ORDER_PROMOTION_TABLE
from slotwise.sources.tables import (
    overwrite_partitions,
    overwrite_table,
    read_table,
    replace_range_in_table,
)


def current_slice(log: DataFrame, low: datetime, high: datetime, column: str = "start_time") -> DataFrame:
    """Log rows of ``[low, high)``."""
    return log.where(in_range(log, column, low, high))


def run_current_slice(log: DataFrame, table: str, low: datetime, high: datetime) -> None:
    """Replace the current table by the slice ``[low, high)``."""
    overwrite_table(current_slice(log, low, high), table)


def run_history_days(
    spark: SparkSession, log: DataFrame, table: str, schema: StructType, low: datetime, high: datetime
) -> None:
    """Replace the history days in ``[low, high)`` by the log's rows of those days."""
    replace_range_in_table(spark, table, schema, log, "log_dt", low, high, "log_dt")


def run_second_dim(spark: SparkSession, table: str, start: date, end: date, load_dt: datetime) -> None:
    """Generate the seconds of ``[start, end)`` and replace them in the table.

    The generated days are whole and the table is partitioned by day, so the keyed replacement
    is a replacement of partitions.
    """
    overwrite_partitions(second_dim(spark, start, end, load_dt), table, SECOND_DIM.partition)


def coming_year(run: datetime) -> tuple[date, date]:
    """Days a yearly run generates: from the first of next month to the run's date a year on."""
    last = monthrange(run.year + 1, run.month)[1]
    return shift_month(run, 1).date(), date(run.year + 1, run.month, min(run.day, last))


def run_range_load(
    spark: SparkSession,
    source: str,
    stage: str,
    table: str,
    schema: StructType,
    column: str,
    low: datetime,
    high: datetime,
    partition: str,
) -> int:
    """Stage a CSV, then replace ``[low, high)`` of ``column`` in the table by the staged rows.

    Returns how many staged rows lie outside and were left out; they are still in ``stage``.
    """
    overwrite_table(read_csv(spark, source, schema), stage)
    staged = read_table(spark, stage, schema)
    # Counted before anything is published.
    outside = rows_outside(staged, column, low, high)
    replace_range_in_table(spark, table, schema, staged, column, low, high, partition)
    return outside


def run_promotion_load(
    spark: SparkSession, source: str, stage: str, table: str, low: datetime, high: datetime
) -> int:
    """Stage promotions, then replace those inserted in ``[low, high)``; returns how many were left out."""
    overwrite_table(read_csv(spark, source, ORDER_PROMOTION), stage)
    staged = promotion_rows(read_table(spark, stage, ORDER_PROMOTION))
    outside = rows_outside(staged, "insert_date", low, high)
    replace_range_in_table(
        spark, table, ORDER_PROMOTION_TABLE, staged, "insert_date", low, high, "insert_month"
    )
    return outside


def rows_outside(rows: DataFrame, column: str, low: datetime, high: datetime) -> int:
    """Rows that a range load leaves out: before, after, or without a time."""
    return rows.where(~F.coalesce(in_range(rows, column, low, high), F.lit(False))).count()


def promotion_rows(promotions: DataFrame) -> DataFrame:
    """Promotions with the month they are stored under."""
    return promotions.withColumn("insert_month", F.substring(F.col("insert_date").cast("string"), 1, 7))
