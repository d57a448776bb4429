"""Viewers of programmes, kept up to date by windows of the session log.  Re-aimed: the rule is our own.

A store holds the marks of every session and the viewers they add up to.  A run takes the log rows of
``[start, end)``, which may overlap earlier windows or bring late rows, merges them into the marks of their
sessions, and counts again only the programmes that these sessions reach or reached.  All tables appear together.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.operators.sessions import (
    PROGRAMME,
    SESSION_KEY,
    distinct_programmes,
    match_programmes,
    merge_marks,
    minute_viewers_of,
    programme_viewers_of,
    session_marks,
    sessions_of,
)
from slotwise.operators.sizing import stored_side
from slotwise.operators.upsert import in_range
from slotwise.sources.schemas import MINUTE_VIEWERS, PROGRAMME_VIEWERS, SESSION_MARKS
from slotwise.sources.scratch import new_folder
from slotwise.sources.tables import read_table, upsert_table
from slotwise.sources.versions import Change, create_store

# A session is logged under the day it began, or the day before.
LATE = timedelta(days=1)


def run_programme_viewers(spark: SparkSession, store: str, log: DataFrame, schedule: DataFrame, start: datetime, end: datetime) -> int:
    """Viewers per programme after the log rows of ``[start, end)``; returns how many programmes were counted again."""
    return _run(spark, store, log, schedule, start, end, {"programmes": (PROGRAMME_VIEWERS, programme_viewers_of)})


def run_minute_viewers(spark: SparkSession, store: str, log: DataFrame, schedule: DataFrame, start: datetime, end: datetime) -> int:
    """The same for viewers per minute of the programme."""
    return _run(spark, store, log, schedule, start, end, {"minutes": (MINUTE_VIEWERS, minute_viewers_of)})


def programme_viewers_table(spark: SparkSession, store: str) -> DataFrame:
    return read_table(spark, f"{store}/programmes", PROGRAMME_VIEWERS)


def minute_viewers_table(spark: SparkSession, store: str) -> DataFrame:
    return read_table(spark, f"{store}/minutes", MINUTE_VIEWERS)


def _run(spark: SparkSession, store: str, log: DataFrame, schedule: DataFrame, start: datetime, end: datetime, kinds: dict) -> int:
    create_store(spark, store)
    days = F.col("log_dt").between(F.lit((start - LATE).date()), F.lit(end.date()))
    coming = _stored(spark, session_marks(log.where(days & in_range(log, "start_time", start, end))), "marks-coming")
    touched = [r[0] for r in coming.select("log_dt").distinct().collect()]
    if not touched:
        return 0
    with Change(spark, store) as change:
        held = change.read("marks", SESSION_MARKS).where(F.col("log_dt").isin(touched))
        key = list(SESSION_KEY)
        keys = stored_side(coming.select(*key), "marks-keys")
        before = held.join(keys, key, "left_semi")
        merged = _stored(spark, merge_marks(before.unionByName(coming)), "marks-merged")
        # What the sessions reached before counts too: an end that came late can lie before the last start.
        spans = sessions_of(before.unionByName(merged)).select("log_dt", "pn", "enter_time", "exit_time")
        programmes = distinct_programmes(schedule.where(F.col("bd_date").isin(touched)))
        reached = _stored(spark, match_programmes(spans, programmes).select(*PROGRAMME).distinct(), "reached")
        media = stored_side(reached.select(F.col("bd_date").alias("log_dt"), F.col("media_code").alias("pn")).distinct(), "reached-media")
        others = held.join(keys, key, "left_anti")
        sessions = sessions_of(others.unionByName(merged)).join(media, ["log_dt", "pn"], "left_semi")
        for name, (schema, count) in kinds.items():
            counted = count(sessions, reached)
            # A programme that lost its last viewer has no row but is deleted like the others.
            work = reached.join(counted.hint("merge"), list(PROGRAMME), "left").select(*schema.fieldNames())
            upsert_table(
                spark, f"{store}/{name}", schema, work, PROGRAMME, "bd_date", F.col("viewers").isNotNull(),
                key_in_partition=True, change=change,
            )
        upsert_table(spark, f"{store}/marks", SESSION_MARKS, merged, key, "log_dt", key_in_partition=True, change=change)
    return reached.count()


def _stored(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    path = new_folder(spark, purpose)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
