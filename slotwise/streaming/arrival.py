"""Load files as they arrive, each once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from slotwise.functions.text import strip_newlines
from slotwise.sources.readers import csv_options, finish_multi_line, multi_line_schema


def arriving_csv(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    file_glob: str = "*A.[Cc][Ss][Vv]",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Headerless CSV files landing in ``folder``; the extension comes in either case."""
    rows = (
        spark.readStream.schema(multi_line_schema(schema))
        .options(**csv_options(header=False, multi_line=True))
        .option("pathGlobFilter", file_glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return strip_newlines(finish_multi_line(rows, schema))


def load_arrived(rows: DataFrame, table: str, checkpoint: str) -> DataStreamWriter:
    """Append everything that arrived since the last run, then stop.

    The checkpoint remembers the loaded files, and the sink's log makes a repeated batch
    harmless.
    """
    return (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
