"""Generated time dimensions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions.timeops import epoch_hours, ntz


def second_dim(spark: SparkSession, start: date, end: date, load_dt: datetime) -> DataFrame:
    """Every second of the days ``[start, end)``, generated in parallel without a shuffle."""
    day = F.date_add(F.lit(start), F.floor(F.col("id") / 24).cast("int"))
    hours = spark.range((end - start).days * 24).select(
        day.alias("date"), (F.col("id") % 24).cast("int").alias("h")
    )
    return _seconds_of_hours(hours, ntz(load_dt))


def seconds_of_days(days: DataFrame, load_dt: Column) -> DataFrame:
    """Every second of the distinct days in ``days.date``.

    A few days make few rows before they are expanded, which adaptive execution would put in one
    task; the explicit partition count keeps the expansion on all cores.
    """
    tasks = int(days.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hours = (
        days.select("date")
        .distinct()
        .select("date", F.explode(F.sequence(F.lit(0), F.lit(23))).alias("h"))
        .repartition(tasks, "date", "h")
    )
    return _seconds_of_hours(hours, load_dt)


def runs_of_days(days: DataFrame) -> DataFrame:
    """The second dimension of the distinct days in ``days.date`` as runs: one row a day, nothing generated."""
    midnight = F.col("date").cast("timestamp_ntz")
    last = midnight + F.expr("INTERVAL 86399 SECONDS")
    return days.select("date").distinct().select(
        "date", midnight.alias("first_second"), last.alias("last_second"), F.lit(1).cast("bigint").alias("copies")
    )


def second_runs(seconds: DataFrame) -> DataFrame:
    """A second dimension as runs: ``date``, ``first_second``, ``last_second``, ``copies``.

    A run is a row of seconds without a gap, of one day, each listed ``copies`` times.  A year of 31.5 million
    seconds becomes 365 rows if nothing is missing.  Windows hold the seconds of a day.
    """
    day = W.partitionBy("date").orderBy("dhms")
    counted = (
        seconds.where(F.col("dhms").isNotNull())
        .groupBy(F.col("dhms").cast("date").alias("date"), "dhms")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    follows = (F.lag("dhms").over(day) + F.expr("INTERVAL 1 SECOND") == F.col("dhms")) & (F.lag("copies").over(day) == F.col("copies"))
    begun = F.when(follows, 0).otherwise(1)
    numbered = counted.withColumn("begun", begun).withColumn("run", F.sum("begun").over(day))
    return (
        numbered.groupBy("date", "run")
        .agg(F.min("dhms").alias("first_second"), F.max("dhms").alias("last_second"), F.first("copies").alias("copies"))
        .drop("run")
    )


def hourly_runs(runs: DataFrame) -> DataFrame:
    """Runs cut at full hours, with the hour as ``cell``: an instant can lie in runs of its own cell only."""
    hours = F.sequence(epoch_hours("first_second"), epoch_hours("last_second"))
    begins = F.timestamp_add("HOUR", F.col("cell"), F.lit("1970-01-01").cast("timestamp_ntz"))
    cut = runs.select("first_second", "last_second", "copies", F.explode(hours).alias("cell"))
    return cut.select(
        "cell",
        F.greatest("first_second", begins).alias("first_second"),
        F.least("last_second", begins + F.expr("INTERVAL 3599 SECONDS")).alias("last_second"),
        "copies",
    )


def _seconds_of_hours(hours: DataFrame, load_dt: Column) -> DataFrame:
    begins = F.col("date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("h"))
    every_second = F.sequence(
        F.col("begins"), F.col("begins") + F.expr("INTERVAL 3599 SECONDS"), F.expr("INTERVAL 1 SECOND")
    )
    return (
        hours.withColumn("begins", begins)
        .select("date", _two_digits(F.col("h")).alias("hh"), F.explode(every_second).alias("dhms"))
        .withColumn("mi", _two_digits(F.minute("dhms")))
        .withColumn("sec", _two_digits(F.second("dhms")))
        .select(
            "dhms", "date", F.concat("hh", "mi", "sec").alias("hms"), "hh", "mi", "sec", load_dt.alias("load_dt")
        )
    )


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")
