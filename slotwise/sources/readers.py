"""Readers with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from slotwise.functions.text import strip_newlines
from slotwise.operators.sizing import stored_side


def csv_options(
    sep: str = ",", header: bool = True, multi_line: bool = False, empty_as_null: bool = False
) -> dict[str, str | bool | None]:
    """Options that undo what ``export_csv`` does, for batch and streaming readers."""
    options = {
        "sep": sep,
        "header": header,
        "enforceSchema": True,
        "quote": '"',
        "escape": '"',
        "nullValue": "" if empty_as_null else None,
        "emptyValue": "",
        "mode": "FAILFAST",
        "multiLine": multi_line,
        "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
        "dateFormat": "yyyy-MM-dd",
    }
    if multi_line:
        # Left to itself, the multi-line reader takes the first line break it meets for the row
        # end, even one inside quotes, and then finds no further rows.
        options["lineSep"] = "\n"
    return options


def multi_line_schema(schema: StructType) -> StructType:
    """``schema`` with its last column as text; see :func:`finish_multi_line`."""
    *others, last = schema.fields
    return StructType([*others, StructField(last.name, StringType())])


def finish_multi_line(df: DataFrame, schema: StructType, ends: Column | None = None) -> DataFrame:
    """Take the ``\\r`` of a ``\\r\\n`` row end off the last column and give it its type.

    ``ends`` tells for a row whether its file has such row ends; by default all files are taken to, so a last value
    that ends in ``\\r`` loses it.
    """
    *others, last = schema.fields
    text = F.col(f"`{last.name}`")
    cut = F.when(text != "\r", F.regexp_replace(text, "\r$", ""))
    if ends is not None:
        cut = F.when(ends, cut).otherwise(text)
    return df.select(*[f"`{f.name}`" for f in others], cut.cast(last.dataType).alias(last.name))


def _by_row_end(spark: SparkSession, path: str | Sequence[str], rows: DataFrame, schema: StructType) -> DataFrame:
    """Multi-line rows finished file by file.

    A file has ``\\r\\n`` row ends if its first line does; where that stops inside quotes, the last line tells.
    There is one row per file to know this by.
    """
    file = F.col("_metadata.file_path").alias("_file")
    lines = spark.read.option("lineSep", "\n").text(path).select(
        file, "value", F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("_at")
    )
    first, last = F.min_by("value", "_at"), F.max_by("value", "_at")
    quotes = F.length(first) - F.length(F.replace(first, F.lit('"'), F.lit("")))
    ends = lines.groupBy("_file").agg(F.when(quotes % 2 == 0, first).otherwise(last).endswith("\r").alias("_ends"))
    named = rows.select("*", file)
    return finish_multi_line(named.join(stored_side(ends, "row-ends"), "_file"), schema, F.col("_ends"))


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    multi_line: bool = False,
    empty_as_null: bool = False,
) -> DataFrame:
    """Delimited text, gzip by file name, quotes removed and doubled quotes undone.

    Columns are taken by position; a header line is skipped, not read.  An unquoted empty field
    is null, a quoted empty one is the empty text: what ``export_csv`` writes comes back
    unchanged.  Files in which *every* value is quoted cannot tell the two apart; read them with
    ``empty_as_null``.  A malformed row fails the read instead of turning into nulls.
    ``multi_line`` is needed only for line breaks inside quotes; it stops Spark from splitting a
    file, so large inputs should arrive as many files.  Whether rows end in ``\\r\\n`` is found out file by file, so a
    last value that ends in ``\\r`` keeps it.  A file without header cannot be told from one with those row ends if its
    first row ends in such a value, or holds a line break while the last row ends in such a value.
    """
    reader = spark.read.options(**csv_options(sep, header, multi_line, empty_as_null))
    if multi_line:
        return _by_row_end(spark, path, reader.schema(multi_line_schema(schema)).csv(path), schema)
    return reader.schema(schema).csv(path)


def read_ratings(spark: SparkSession, path: str | Sequence[str], schema: StructType) -> DataFrame:
    """Ratings file without a header line; names come from ``schema``.

    As names are given, a header line would be read as data.  ``\\r\\n`` inside text is removed.
    """
    return strip_newlines(read_csv(spark, path, schema, header=False, multi_line=True))


def read_day_folder(spark: SparkSession, root: str, day: date, schema: StructType) -> DataFrame:
    """Parquet files of ``root/yyyymmdd/``."""
    return spark.read.schema(schema).parquet(f"{root}/{day:%Y%m%d}")


def either_case(path: str) -> str:
    """Glob for a file whose extension arrives in upper or lower case."""
    stem, dot, extension = path.rpartition(".")
    return stem + dot + "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in extension)


def read_pages(spark: SparkSession, path: str, fields: Sequence[str]) -> DataFrame:
    """Landed open-data pages, one JSON document per file: ``page``, ``dataset``, ``total``, ``rows``.

    A document is ``{dataset: {list_total_count, RESULT, row: [...]}}`` whose root name is not
    known beforehand, so it is parsed as a map and its first entry taken.  All row values are
    text.  A page without ``row`` (an error answer) has null ``rows``; one that is no JSON document, as when
    it was cut off, fails the read.
    """
    row = ", ".join(f"`{f}`: string" for f in fields)
    shape = (
        "map<string, struct<list_total_count: bigint, RESULT: struct<CODE: string, MESSAGE: string>, "
        f"row: array<struct<{row}>>>>"
    )
    documents = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("page"),
        F.map_entries(F.from_json("value", shape, {"mode": "FAILFAST"}))[0].alias("entry"),
    )
    return documents.select(
        "page",
        F.col("entry.key").alias("dataset"),
        F.col("entry.value.list_total_count").alias("total"),
        F.col("entry.value.row").alias("rows"),
    )


def flatten_pages(pages: DataFrame) -> DataFrame:
    """All rows of all pages."""
    return pages.select(F.explode("rows").alias("r")).select("r.*")


def jdbc_window_options(
    url: str,
    table: str,
    columns: Sequence[str],
    time_column: str,
    low: datetime,
    high: datetime,
    partitions: int,
) -> dict[str, str]:
    """Options of a parallel database read of ``[low, high)``.

    The column list and the range go to the database as a subquery; the range is also cut in
    ``partitions`` equal slices, one connection each.
    """
    inside = f"{time_column} >= TIMESTAMP '{low}' AND {time_column} < TIMESTAMP '{high}'"
    return {
        "url": url,
        "dbtable": f"(SELECT {', '.join(columns)} FROM {table} WHERE {inside}) extract_window",
        "partitionColumn": time_column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
        "fetchsize": "10000",
    }


def read_jdbc_window(spark: SparkSession, options: dict[str, str], **login: str) -> DataFrame:
    return spark.read.format("jdbc").options(**options, **login).load()
