"""Freshness checks, counts and the run audit."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slotwise.functions.text import clean_date, is_day


def freshness_of_pages(
    pages: DataFrame,
    date_column: str,
    as_of: date,
    day_off: int = 0,
    drop_parentheses: bool = True,
) -> DataFrame:
    """Whether the first row of the first landed page is dated ``as_of + day_off`` or later.

    ``pages`` comes from ``read_pages``.  As the source lists its newest row first, only row 0
    counts; of deliveries in folders of days (``yyyymmdd``), that of the newest day.  The comparison is a
    text comparison; ``is_valid`` tells whether the text was a date.
    """
    day = F.regexp_extract("page", r"/(\d{8})/", 1)
    newest_first = F.struct(-F.coalesce(day.try_cast("long"), F.lit(0)), "page")
    first = pages.where(F.size("rows") > 0).agg(
        F.min_by(F.col("rows")[0][date_column], newest_first).alias("last_text")
    )
    return _judge(first, clean_date(F.col("last_text"), drop_parentheses), as_of, day_off)


def freshness_of_table(df: DataFrame, date_column: str, as_of: date, day_off: int = 0) -> DataFrame:
    """The same for a table, whose rows have no order: its latest date decides."""
    last = df.agg(F.max(date_column).cast("string").alias("last_text"))
    return _judge(last, clean_date(F.col("last_text")), as_of, day_off)


def _judge(one_row: DataFrame, last_date: Column, as_of: date, day_off: int) -> DataFrame:
    wanted = (as_of + timedelta(days=day_off)).isoformat()
    return one_row.select(
        last_date.alias("last_date"),
        F.lit(wanted).alias("search_date"),
        is_day(last_date).alias("is_valid"),
        F.coalesce(last_date >= F.lit(wanted), F.lit(False)).alias("is_fresh"),
    )


def page_gaps(pages: DataFrame, page_rows: int = 1000, number: str = r"(\d+)\D*$") -> DataFrame:
    """What is wrong with a paged delivery: ``dataset``, ``problem``, ``page``, ``expected``, ``found``.

    ``pages`` comes from ``read_pages``; ``number`` finds a page's number, counted from 1, in its file name or folder.
    A dataset of ``list_total_count`` rows has that many pages of ``page_rows`` rows, the last one shorter.  Problems:

    * ``missing``: an expected page did not come (rows expected, none found);
    * ``doubled``: a page came more than once (once expected, so often found);
    * ``short`` or ``long``: a page holds other than its rows;
    * ``unexpected``: a page behind the last;
    * ``total``: pages disagree on the total; the largest counts (as expected, the smallest as found).

    Pages without rows, as error answers are, do not count as delivered.
    """
    delivered = pages.where(F.col("rows").isNotNull()).select(
        "dataset",
        F.regexp_extract(F.regexp_replace("page", "/[^/]*\\.(txt|json)[^/]*$", ""), number, 1).cast("long").alias("page"),
        "total",
        F.size("rows").cast("long").alias("found"),
    )
    totals = delivered.groupBy("dataset").agg(F.max("total").alias("total"), F.min("total").alias("least"))
    came = delivered.groupBy("dataset", "page").agg(F.count(F.lit(1)).alias("times"), F.min("found").alias("low"), F.max("found").alias("high"))
    count = F.ceil(F.col("total") / page_rows).cast("long")
    # Page numbers by set difference: a row per expected page, never per row of the data.
    wanted = totals.where("total > 0").select(
        "dataset", F.explode(F.sequence(F.lit(1).cast("long"), count)).alias("page"), "total", count.alias("pages")
    )
    rows = F.when(F.col("page") < F.col("pages"), F.lit(page_rows)).otherwise(F.col("total") - (F.col("pages") - 1) * page_rows)
    both = wanted.withColumn("expected", rows.cast("long")).join(came, ["dataset", "page"], "full")

    def problem(name: str, where: Column, expected: Column, found: Column) -> Column:
        return F.when(where, F.struct(F.lit(name).alias("problem"), expected.cast("long").alias("expected"), found.cast("long").alias("found")))

    known = F.col("expected").isNotNull()
    found = F.array_compact(
        F.array(
            problem("missing", F.col("times").isNull(), F.col("expected"), F.lit(0)),
            problem("doubled", F.col("times") > 1, F.lit(1), F.col("times")),
            problem("short", known & (F.col("low") < F.col("expected")), F.col("expected"), F.col("low")),
            problem("long", known & (F.col("high") > F.col("expected")), F.col("expected"), F.col("high")),
            problem("unexpected", ~known, F.lit(0), F.col("high")),
        )
    )
    of_pages = both.select("dataset", "page", F.explode(found).alias("p")).select("dataset", "p.problem", "page", "p.expected", "p.found")
    of_totals = totals.where("least < total").select(
        "dataset", F.lit("total").alias("problem"), F.lit(None).cast("long").alias("page"), F.col("total").alias("expected"), F.col("least").alias("found")
    )
    return of_pages.unionByName(of_totals)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def line_count(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a landed file."""
    return row_count(spark.read.text(path))


AUDIT_SCHEMA = "dag_id string, task_id string, run_id string, msg string"


def audit_row(spark: SparkSession, job: str, task: str, run: str, message: str) -> DataFrame:
    return spark.createDataFrame([(job, task, run, message)], AUDIT_SCHEMA)


def append_audit(spark: SparkSession, path: str, job: str, task: str, run: str, message: str) -> None:
    audit_row(spark, job, task, run, message).write.mode("append").parquet(path)
