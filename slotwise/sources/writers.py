"""File writers.  All of them write in parallel, one file per task."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame



def export_csv(
    df: DataFrame,
    path: str,
    compress: bool = True,
    quote_all: bool = False,
    header: bool = True,
    sep: str = ",",
    mode: str = "overwrite",
) -> None:
    """Header CSV in UTF-8, gzip by default, replacing what was there.

    Null is written as nothing and the empty text as ``""``; with ``quote_all`` both are ``""``.
    Both kinds of timestamp keep their microseconds; instants carry their offset.
    """
    (
        df.write.mode(mode)
        .option("header", header)
        .option("sep", sep)
        .option("quoteAll", quote_all)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("nullValue", None)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .option("compression", "gzip" if compress else "none")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )


def jdbc_write_options(url: str, table: str, connections: int = 8) -> dict[str, str]:
    """Options of a database write over a bounded number of connections.

    Replacing empties the table instead of dropping it, so its definition and rights stay.
    """
    return {
        "url": url,
        "dbtable": table,
        "numPartitions": str(connections),
        "batchsize": "10000",
        "truncate": "true",
    }


def write_jdbc(df: DataFrame, options: dict[str, str], replace: bool = False, **login: str) -> None:
    """All rows into a database table, replacing or appending."""
    writer = df.write.format("jdbc").options(**options, **login)
    writer.mode("overwrite" if replace else "append").save()


def day_folder(root: str, day: date) -> str:
    return f"{root}/{day:%Y%m%d}"


def export_day_csv(df: DataFrame, root: str, day: date) -> None:
    """Uncompressed header CSV in the folder of a day."""
    export_csv(df, day_folder(root, day), compress=False)
