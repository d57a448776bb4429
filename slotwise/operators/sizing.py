"""Broadcast only what has been measured to fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DecimalType, MapType, StringType, StructType

from slotwise.sources.scratch import new_folder

# A broadcast table is built on the driver and held by every executor.
BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = 8
_ROW_OVERHEAD = 32
_WIDE_DECIMAL = 18


def row_bytes(df: DataFrame) -> Column:
    """Upper estimate of a row's size in memory."""
    width = F.lit(_ROW_OVERHEAD)
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        width = width + F.lit(_FIXED_WIDTH)
        if isinstance(kind, StringType | BinaryType):
            width = width + F.coalesce(F.octet_length(column), F.lit(0))
        elif isinstance(kind, DecimalType) and kind.precision > _WIDE_DECIMAL:
            width = width + F.lit(2 * _FIXED_WIDTH)
        elif isinstance(kind, ArrayType | MapType | StructType):
            # Written as text a value takes a byte at least; in memory it may take a word.
            width = width + F.lit(_FIXED_WIDTH) * F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0))
    return width.cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of ``df``: one distributed aggregate, one row back."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]


def stored_measured(df: DataFrame, purpose: str) -> tuple[DataFrame, int]:
    """``df`` written to the shared folder and read again, with its size as counted by the write: computed once."""
    spark, path, size = df.sparkSession, new_folder(df.sparkSession, purpose), Observation()
    df.observe(size, F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), size.get["bytes"]


def fits_broadcast(df: DataFrame, limit: int | None = None) -> bool:
    return fits(measured_bytes(df), limit)


def fits(size: int, limit: int | None = None) -> bool:
    return size <= (BROADCAST_BYTES if limit is None else limit)


def broadcast_if_small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast if it fits, otherwise for sort-merge.

    Without the second mark a side that was measured as too large could still be broadcast on
    Spark's own estimate, which knows nothing of compression or of rows yet to be expanded.
    Sort-merge spills, and adaptive execution splits its skewed partitions.
    """
    return F.broadcast(df) if fits_broadcast(df, limit) else df.hint("merge")


def stored_side(df: DataFrame, purpose: str, limit: int | None = None) -> DataFrame:
    """The same for a side that is costly to compute: stored as it is measured, and joined as stored."""
    stored, size = stored_measured(df, purpose)
    return F.broadcast(stored) if fits(size, limit) else stored.hint("merge")
