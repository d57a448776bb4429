"""Stored Parquet tables with day, range and keyed replacement.

A change writes new files beside the old ones and publishes them with the next version of the table's store; see
:mod:`slotwise.sources.versions`.  Only partition folders that hold a deleted row are written again, found by reading
the key or the partition column alone; rows that are merely added become folders of their own, which
:func:`compact_table` joins from time to time.  Tables may be partitioned by several columns.

Functions that change a table publish it at once, or leave that to the ``change`` they are given, so that several
tables of a store appear together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slotwise.operators.sizing import stored_side
from slotwise.operators.upsert import in_range, refuse_rows_outside
from slotwise.sources.versions import Change, is_versioned, locate, manifest, pieces_of, read_version

Partition = str | Sequence[str] | None


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table with its columns in schema order; partition values get the schema's types.

    A folder of plain Parquet files is read as it is.
    """
    if is_versioned(spark, path):
        return read_version(spark, path, schema)
    return spark.read.schema(schema).parquet(path).select(*[f"`{n}`" for n in schema.fieldNames()])


def create_table(spark: SparkSession, path: str, schema: StructType, partition: Partition = None) -> None:
    """An empty table; truncates an existing one."""
    overwrite_table(spark.createDataFrame([], schema), path, partition)


def overwrite_table(df: DataFrame, path: str, partition: Partition = None, change: Change | None = None) -> int:
    """Replace the whole table; returns how many rows were written."""
    with _changing(df.sparkSession, path, change) as (held, name):
        held.clear(name)
        return held.add(name, df, _columns(partition))[0]


def append_table(df: DataFrame, path: str, partition: Partition = None, change: Change | None = None) -> int:
    with _changing(df.sparkSession, path, change) as (held, name):
        return held.add(name, df, _columns(partition))[0]


def overwrite_partitions(df: DataFrame, path: str, partition: Partition, change: Change | None = None) -> int:
    """Replace the partitions ``df`` has rows for and leave the others alone."""
    spark, columns = df.sparkSession, _columns(partition)
    with _changing(spark, path, change) as (held, name):
        kinds = StructType([df.schema[c] for c in columns])
        before = held.placed(name, kinds)
        rows = held.add(name, df, columns)[0]
        written = set(held.table(name).writes) - set(held.seen.get(name, {}))
        coming = held.read(name, kinds, {w: None for w in written}).distinct()
        same = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in columns]
        held.drop(name, pieces_of(before.alias("old").join(F.broadcast(coming).alias("new"), same, "left_semi")))
        return rows


def replace_day_in_table(
    rows: DataFrame, path: str, day: date, partition: str = "bd_date", change: Change | None = None
) -> None:
    """Replace one day by its recomputed ``rows``; no rows empties the day."""
    with _changing(rows.sparkSession, path, change) as (held, name):
        that_day = F.col(partition) == F.lit(day)
        held.drop(name, pieces_of(held.placed(name, StructType([rows.schema[partition]])).where(that_day)))
        held.add(name, rows.where(that_day), [partition])


def upsert_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    work: DataFrame,
    key: str | Sequence[str],
    partition: Partition = None,
    insert_filter: Column | None = None,
    key_in_partition: bool = False,
    change: Change | None = None,
) -> None:
    """Keyed delete-insert into a stored table; see :func:`slotwise.operators.upsert.upsert_by_key`.

    The distinct keys of ``work`` are stored once, measured by that, and looked up in the table's key columns.
    When the caller knows that a key always lies in the same partition (``key_in_partition``, or the
    partition columns are among the key), only the partitions of ``work`` are searched.
    """
    key, columns = _columns(key), _columns(partition)
    rows = (work if insert_filter is None else work.where(insert_filter)).select(*schema.fieldNames())
    with _changing(spark, path, change) as (held, name):
        named = [*key, *[c for c in columns if c not in key]]
        asked = stored_side(work.select(*named if key_in_partition else key).dropna(subset=key).distinct(), "upsert-keys")
        keys = asked.select(*key).distinct() if key_in_partition else asked
        whole = held.placed(name, StructType([schema[c] for c in named]))
        pruned = [c for c in columns if key_in_partition or c in key]
        target = whole.where(_among(asked, pruned)) if pruned else whole
        hit = pieces_of(target.join(keys, on=key, how="left_semi"))
        kept = None if key == columns else held.read(name, schema, hit).join(keys, on=key, how="left_anti").select(*schema.fieldNames())
        held.drop(name, hit)
        held.add(name, rows if kept is None or not hit else kept.unionByName(rows), columns)


def replace_range_in_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    rows: DataFrame,
    column: str,
    low: datetime,
    high: datetime,
    partition: Partition,
    refuse_outside: bool = False,
    change: Change | None = None,
) -> None:
    """Replace ``[low, high)`` of a time column in a stored table; see ``replace_range`` for other rows."""
    columns = _columns(partition)
    coming = refuse_rows_outside(rows, column, low, high) if refuse_outside else rows.where(in_range(rows, column, low, high))
    with _changing(spark, path, change) as (held, name):
        whole = held.placed(name, StructType([schema[column], *[schema[c] for c in columns if c != column]]))
        hit = pieces_of(whole.where(in_range(whole, column, low, high)))
        kept = held.read(name, schema, hit)
        kept = kept.where(~F.coalesce(in_range(kept, column, low, high), F.lit(False)))
        held.drop(name, hit)
        held.add(name, kept.unionByName(coming.select(*schema.fieldNames())), columns)


def compact_table(spark: SparkSession, path: str, schema: StructType, most: int = 16) -> None:
    """Writes the partitions again that are spread over more than ``most`` writes."""
    root, name = locate(spark, path)
    held = Change(spark, root)
    columns = held.table(name).partition
    pieces = pieces_of(held.placed(name, StructType([schema[c] for c in columns])))
    spread: dict[str, list[str]] = {}
    for write, folders in pieces.items():
        for folder in folders:
            spread.setdefault(folder, []).append(write)
    many: dict[str, list[str]] = {}
    for folder, writes in spread.items():
        for write in writes if len(writes) > most else ():
            many.setdefault(write, []).append(folder)
    if many:
        rows = held.read(name, schema, many)
        held.drop(name, many)
        held.add(name, rows, columns)
        held.publish()


# ---- helpers ---------------------------------------------------------------------


@contextmanager
def _changing(spark: SparkSession, path: str, change: Change | None) -> Iterator[tuple[Change, str]]:
    """The change to work in and the table's name in its store; a change of one's own is published at the end."""
    root, name = locate(spark, path)
    if change is not None:
        if change.root != root:
            raise ValueError(f"{path} is not in the store {change.root}")
        yield change, name
        return
    with Change(spark, root) as own:
        yield own, name


def versions_of(spark: SparkSession, path: str) -> int:
    """The version of the store a table lies in."""
    return manifest(spark, locate(spark, path)[0]).version


def _columns(columns: Partition) -> list[str]:
    return [] if columns is None else [columns] if isinstance(columns, str) else list(columns)


def _among(rows: DataFrame, columns: list[str]) -> Column:
    """Membership of the partition values that ``rows`` has, column by column, as literals for the scan to skip by."""
    wanted = F.lit(True)
    for c in columns:
        # Partition values: one row per folder that can be touched.
        values = [r[0] for r in rows.select(c).distinct().collect()]
        one = F.col(c).isin([v for v in values if v is not None])
        # The empty text has no folder name and is stored as null.
        wanted = wanted & ((one | F.col(c).isNull()) if None in values or "" in values else one)
    return wanted
