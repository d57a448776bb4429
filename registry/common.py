"""Registration and presentation shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Run times of the registered jobs.
AS_OF = datetime(2024, 1, 15, 12, 0)
DAY = date(2024, 1, 15)
RUN = datetime(2024, 1, 20, 7, 0)
LOAD_AT = datetime(2024, 2, 1, 7, 0)
WIDE = {
    "order_back": timedelta(hours=24),
    "air_back": timedelta(hours=96),
    "air_ahead": timedelta(minutes=10),
}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that states the same result."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, for the comparison only: exact sums have been taken by then."""
    return df.select(
        [
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if f.dataType.typeName() == "decimal"
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
