"""Loads and exports of the warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slotwise.functions.fixed import IGNORED_SLOT
from slotwise.functions.timeops import schedule_days, since_previous_month
from slotwise.operators.extract import extract_snapshot, extract_window
from slotwise.sources import schemas
from slotwise.sources.readers import read_csv, read_day_folder, read_ratings
from slotwise.sources.tables import append_table, overwrite_table, read_table, upsert_table
from slotwise.sources.versions import locate, stores
from slotwise.sources.writers import export_csv


@dataclass(frozen=True)
class LoadSpec:
    """How a warehouse table is staged and upserted."""

    schema: StructType
    key: str
    partition: str | None = None
    # Rows with the same key always lie in the same partition.
    key_in_partition: bool = False
    source: str = "csv"
    # Every value of the file is quoted, so an empty one stands for null.
    all_quoted: bool = False
    # SQL text of the rows that are inserted; what is deleted does not depend on it.
    insert_where: str | None = None


HOUR_DIM = LoadSpec(schemas.HOUR_DIM, key="hh")
MINUTE_DIM = LoadSpec(schemas.MINUTE_DIM, key="mi")
SEC_DIM = LoadSpec(schemas.SEC_DIM, key="sec")
SECOND_DIM = LoadSpec(schemas.SECOND_DIM, key="dhms", partition="date", key_in_partition=True)
CALENDAR = LoadSpec(schemas.CALENDAR, key="date")
PROGRAMME = LoadSpec(schemas.PROGRAMME, key="seq_frame_no", partition="bd_date", all_quoted=True)
COMPETITOR_SCHEDULE = LoadSpec(
    schemas.COMPETITOR_SCHEDULE,
    key="brd_dt",
    partition="brd_dt",
    source="parquet",
    insert_where=f"brd_stt_tslot_cd <> '{IGNORED_SLOT}'",
)
GUIDE_SCHEDULE = LoadSpec(schemas.GUIDE_SCHEDULE, key="brd_dt", partition="brd_dt", source="parquet")


def load_stage(
    spark: SparkSession, spec: LoadSpec, source: str, stage: str, day: date | None = None
) -> int:
    """Empty the stage, load the files, return the number of staged rows, counted as they are written."""
    if spec.source == "parquet":
        rows = read_day_folder(spark, source, day, spec.schema)
    else:
        rows = read_csv(spark, source, spec.schema, empty_as_null=spec.all_quoted)
    return overwrite_table(rows, stage)


def apply_stage(spark: SparkSession, spec: LoadSpec, stage: str, targets: Sequence[str]) -> None:
    """Upsert one stage into every target table.

    Targets of one store appear together, once all are written; those of other stores one after another.
    """
    work = read_table(spark, stage, spec.schema)
    where = None if spec.insert_where is None else F.expr(spec.insert_where)
    changes = stores(spark, targets)
    for target in targets:
        upsert_table(
            spark, target, spec.schema, work, spec.key, spec.partition, where, spec.key_in_partition,
            changes[locate(spark, target)[0]],
        )
    for change in changes.values():
        change.publish()


def load(
    spark: SparkSession,
    spec: LoadSpec,
    source: str,
    stage: str,
    targets: Sequence[str],
    day: date | None = None,
) -> int:
    """Stage, count, upsert.  The count gates nothing: an empty stage deletes nothing."""
    staged = load_stage(spark, spec, source, stage, day)
    apply_stage(spark, spec, stage, targets)
    return staged


def load_ratings(
    spark: SparkSession, path: str | Sequence[str], table: str, schema: StructType = schemas.RATINGS
) -> None:
    """Append a ratings file without header line."""
    append_table(read_ratings(spark, path, schema), table)


def load_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    table: str,
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    replace: bool = False,
) -> None:
    """Delimited file into a table, replacing or appending."""
    rows = read_csv(spark, path, schema, sep, header)
    (overwrite_table if replace else append_table)(rows, table)


def extract_schedule(table: DataFrame, schema: StructType, run: datetime) -> DataFrame:
    """Schedule rows from yesterday to tomorrow."""
    return extract_window(table, schema.fieldNames(), "bd_date", *schedule_days(run))


def extract_promotions(table: DataFrame, run: datetime) -> DataFrame:
    """Promotions since the first day of the previous month, without today's."""
    low, high = since_previous_month(run)
    return extract_window(table, schemas.ORDER_PROMOTION.fieldNames(), "insert_date", low, high)


def export_snapshot(
    table: DataFrame,
    schema: StructType,
    path: str,
    quote_all: bool = False,
) -> None:
    """A whole table as gzip CSV."""
    export_csv(extract_snapshot(table, schema.fieldNames()), path, quote_all=quote_all)
