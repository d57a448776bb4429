"""The connection log as folds of growing sets of days, for the history form of the live viewers.

A day is folded once it is over.  Sets of equal length that lie side by side become one of twice the length, as a
binary counter carries, so a history of n days is read from about log2(n) folders and every row is written again
about log2(n) times.  Latest times of latest times are again latest times: late rows of a day merge into its set.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.timeops import ntz
from slotwise.operators.live import active_from_latest, latest_events, merge_latest
from slotwise.sources.schemas import CONNECTION_FOLDS
from slotwise.sources.tables import read_table
from slotwise.sources.versions import Change, locate, pieces_of

HOUR = timedelta(hours=1)
# A set of folds covers 2 ** level days from its first day on.
FOLD_PARTITION = ("level", "first_day")


def add_days(spark: SparkSession, table: str, log: DataFrame, since: date, until: date) -> None:
    """Folds the log rows of the days ``[since, until)`` into the table.

    Days that are covered already are merged, so rows may come late or twice.  New days follow the covered
    ones: sets from the first day covered to ``until`` are cut anew, and only those that change are written.
    """
    root, name = locate(spark, table)
    log = log.where((F.col("log_time") >= ntz(_at(since))) & (F.col("log_time") < ntz(_at(until))))
    new = latest_events(log, F.col("log_time").cast("date").alias("day"))
    with Change(spark, root) as change:
        held = change.placed(name, CONNECTION_FOLDS)
        # One row per set.
        sets = [(r["level"], r["first_day"]) for r in held.select(*FOLD_PARTITION).distinct().collect()]
        first = min([since, *[f for _, f in sets]])
        end = max([until, *[f + timedelta(days=1 << level) for level, f in sets]])
        wanted = blocks(first, end)
        coming = {since + timedelta(days=i) for i in range((until - since).days)}
        # A set stays if it is still wanted and none of its days comes again.
        gone = [s for s in sets if s not in wanted or _days(s) & coming]
        old = held.where(_is_one_of(gone))
        rows = new.unionByName(old.select(F.col("first_day").alias("day"), *[c for c in new.columns if c != "day"]))
        # A day goes to the wanted set that begins last before it.
        begins = F.array_sort(F.array(*[F.struct(F.lit(f).alias("first_day"), F.lit(level).alias("level")) for level, f in wanted]))
        block = F.element_at(F.filter(begins, lambda s: s["first_day"] <= F.col("day")), -1)
        merged = rows.withColumn("block", block).select("block.*", *[c for c in new.columns if c != "day"])
        folds = merged.groupBy(*FOLD_PARTITION, "media_code", "user_id").agg(
            *[F.max(c).alias(c) for c in ("last_activity", "last_connect", "last_disconnect")]
        )
        change.drop(name, pieces_of(old))
        change.add(name, folds.select(*CONNECTION_FOLDS.fieldNames()), FOLD_PARTITION)


def blocks(since: date, until: date) -> set[tuple[int, date]]:
    """As few sets as can be for a range of days, each beginning at a multiple of its length."""
    start = date(1970, 1, 1).toordinal()
    at, end, found = since.toordinal() - start, until.toordinal() - start, set()
    while at < end:
        level = 0
        while at % (2 << level) == 0 and at + (2 << level) <= end:
            level += 1
        found.add((level, date.fromordinal(start + at)))
        at += 1 << level
    return found


def active_viewers_from_folds(
    spark: SparkSession, table: str, log: DataFrame, as_of: datetime, timeout: timedelta = HOUR
) -> DataFrame:
    """The history form from the sets that end before ``as_of`` and the log rows of the days since."""
    folds = read_table(spark, table, CONNECTION_FOLDS)
    sets = [(r["level"], r["first_day"]) for r in folds.select(*FOLD_PARTITION).distinct().collect()]
    used = [s for s in sets if max(_days(s)) < as_of.date()]
    rest = log.where(F.col("log_time") < ntz(as_of))
    if used:
        rest = rest.where(F.col("log_time") >= ntz(_at(max(max(_days(s)) for s in used) + timedelta(days=1))))
    folds = folds.where(_is_one_of(used))
    latest = merge_latest(folds.drop(*FOLD_PARTITION).unionByName(latest_events(rest)))
    return active_from_latest(latest, as_of, timeout)


def _is_one_of(sets: list[tuple[int, date]]) -> Column:
    """Literals for the scan to skip by."""
    chosen = F.lit(False)
    for level, first in sets:
        chosen = chosen | ((F.col("level") == level) & (F.col("first_day") == F.lit(first)))
    return chosen


def _at(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)


def _days(block: tuple[int, date]) -> set[date]:
    level, first = block
    return {first + timedelta(days=i) for i in range(1 << level)}
