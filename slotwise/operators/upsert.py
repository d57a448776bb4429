"""Keyed and range delete-insert as frames: what a table holds afterwards.

Key comparison follows SQL: a missing key matches nothing, so target rows without a key stay and
work rows without a key delete nothing but are inserted.  Work rows are not de-duplicated.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions.timeops import bound_for
from slotwise.operators.sizing import stored_side


def delete_by_key(
    target: DataFrame, work: DataFrame, key: str | Sequence[str], broadcast_limit: int | None = None
) -> DataFrame:
    """Target rows whose key is not in ``work``.

    Only the distinct keys of ``work`` take part; they are stored once, and measured as they are written.  If
    they fit they are broadcast and the target is filtered in place, without a shuffle; beyond that the
    anti join shuffles both sides, and adaptive execution splits a hot target key.
    """
    key = [key] if isinstance(key, str) else list(key)
    keys = work.select(*key).dropna().distinct()
    return target.join(stored_side(keys, "upsert-keys", broadcast_limit), on=key, how="left_anti")


def upsert_by_key(
    target: DataFrame,
    work: DataFrame,
    key: str | Sequence[str],
    insert_filter: Column | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Delete target rows whose key is in ``work``, then insert the work rows.

    ``insert_filter`` restricts the insert only: a key whose work rows are all filtered out is
    still deleted.  Rows for which it is null are not inserted.
    """
    kept = delete_by_key(target, work, key, broadcast_limit).select(*target.columns)
    rows = work if insert_filter is None else work.where(insert_filter)
    return kept.unionByName(rows.select(*target.columns))


def replace_day(target: DataFrame, rows: DataFrame, day: date, column: str = "bd_date") -> DataFrame:
    """Delete one day, then insert ``rows``."""
    kept = target.where((F.col(column) != F.lit(day)) | F.col(column).isNull())
    return kept.unionByName(rows.select(*target.columns))


def replace_range(
    target: DataFrame, rows: DataFrame, column: str, low: datetime, high: datetime, refuse_outside: bool = False
) -> DataFrame:
    """Delete ``[low, high)`` of a time column, then insert the rows of that range.

    With ``refuse_outside`` a row outside the range, or without a time, fails the job instead of being
    left out: loads of whole files use it, where leaving rows out would lose them unseen.
    """
    inside = in_range(target, column, low, high)
    kept = target.where(~inside | F.col(column).isNull())
    coming = refuse_rows_outside(rows, column, low, high) if refuse_outside else rows.where(in_range(rows, column, low, high))
    return kept.unionByName(coming.select(*target.columns))


def refuse_rows_outside(rows: DataFrame, column: str, low: datetime, high: datetime) -> DataFrame:
    """``rows``, failing on one outside ``[low, high)`` or without a time."""
    refused = F.raise_error(F.lit(f"a row lies outside [{low}, {high}) of {column}")).cast("boolean")
    return rows.where(F.when(in_range(rows, column, low, high), F.lit(True)).otherwise(refused))


def in_range(df: DataFrame, column: str, low: datetime, high: datetime) -> Column:
    """Half-open range test whose bounds have the column's own type, so it reaches the scan."""
    kind = df.schema[column].dataType
    return (F.col(column) >= bound_for(kind, low)) & (F.col(column) < bound_for(kind, high))
