"""The driver's test tables seen as domain tables.

Every frame has a twin in ``SQL``: common table expressions over the same tables that the
comparison queries of ``__spark_entry__`` start from.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slotwise.functions.timeops import event_time, trunc_hour, trunc_second
from slotwise.sources.scratch import new_folder

MONEY = "decimal(18,2)"


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A derived table written to the shared folder, as its domain twin would be stored.

    What several jobs of a query read is then derived from the driver's tables once.
    """
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def media() -> Column:
    return F.concat(F.lit("TV"), F.lpad((F.col("user_id") % 5).cast("string"), 2, "0"))


def goods() -> Column:
    return F.regexp_extract("props", "[0-9]+", 0)


def session_log(e: DataFrame) -> DataFrame:
    start = trunc_second("ts")
    kind = (
        F.when(F.col("event_type") == "purchase", "begin_checkout")
        .when(F.col("event_type") == "click", "checkout_progress")
        .otherwise(F.col("event_type"))
    )
    return e.select(
        F.col("ts").cast("date").alias("log_dt"),
        media().alias("pn"),
        F.concat_ws("-", F.col("user_id"), F.hour("ts")).alias("sid"),
        start.alias("start_time"),
        (start + F.floor("value") * F.expr("INTERVAL '1' SECOND")).alias("end_time"),
        kind.alias("ec_type"),
    )


def programmes(e: DataFrame) -> DataFrame:
    """One programme per hour, media and goods with events, starting at minute 31."""
    return e.select(
        F.col("ts").cast("date").alias("bd_date"),
        (trunc_hour("ts") + F.expr("INTERVAL 31 MINUTES")).alias("bd_btime"),
        media().alias("media_code"),
        F.concat(F.lit("T"), F.hour("ts")).alias("tape_code"),
        goods().alias("goods_code"),
    ).distinct()


def frames(e: DataFrame) -> DataFrame:
    """Schedule frames: two tapes run at the same time on different media."""
    return e.select(
        F.col("ts").cast("date").alias("bd_date"),
        (trunc_hour("ts") + F.expr("INTERVAL 31 MINUTES")).alias("bd_btime"),
        media().alias("media_code"),
        F.concat(F.lit("T"), F.hour("ts"), F.lit("-"), (F.col("user_id") % 5) % 2).alias("tape_code"),
    ).distinct()


def connection_log(e: DataFrame) -> DataFrame:
    status = (
        F.when(F.col("event_type") == "view", "connect")
        .when(F.col("event_type") == "error", "disconnect")
        .otherwise("ping")
    )
    return e.select(
        F.col("ts").alias("log_time"),
        media().alias("pn"),
        F.col("user_id").cast("string").alias("uid"),
        status.alias("status"),
        F.col("ts").alias("st"),
    )


def order_lines(e: DataFrame) -> DataFrame:
    return e.where(F.col("event_type") == "purchase").select(
        goods().alias("goods_code"),
        media().alias("media_code"),
        F.col("ts").alias("order_date"),
        F.col("value").cast(MONEY).alias("order_amt"),
    )


def event_days(e: DataFrame) -> DataFrame:
    return e.select(F.col("ts").cast("date").alias("date")).distinct()


def filled(df: DataFrame, schema: StructType, key: str) -> DataFrame:
    """``df`` with all columns of a schema: those it lacks get values of their own, so that none can be mistaken.

    Every third of them is null where the text of ``key`` ends in 7.
    """
    text, have = F.col(key).cast("string"), set(df.columns)
    columns = []
    for i, field in enumerate(schema.fields):
        kind = field.dataType.typeName()
        if field.name in have:
            value = F.col(f"`{field.name}`")
        elif kind == "string":
            value = F.concat(F.lit(f"{field.name}/"), text)
        elif kind == "timestamp_ntz":
            value = F.expr(f"TIMESTAMP_NTZ'2024-03-01 00:00:00' + INTERVAL '{i}' MINUTE")
        elif kind == "date":
            value = F.date_add(F.lit(date(2024, 3, 1)), i)
        else:
            value = F.lit(i) + F.length(text) + F.lit(0.25 if kind in ("decimal", "double") else 0)
        if field.name not in have and i % 3 == 0:
            value = F.when(~text.endswith("7"), value)
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(columns)


def filled_sql(schema: StructType, have: str, key: str) -> str:
    """The same columns as a select list over a relation with the columns ``have``."""
    listed, columns = set(have.split()), []
    for i, field in enumerate(schema.fields):
        kind, text = field.dataType.typeName(), f"CAST({key} AS VARCHAR)"
        if field.name in listed:
            value = f'CAST("{field.name}" AS DOUBLE)' if kind == "decimal" else f'"{field.name}"'
        elif kind == "string":
            value = f"'{field.name}/' || {text}"
        elif kind == "timestamp_ntz":
            value = f"TIMESTAMP '2024-03-01 00:00:00' + INTERVAL {i} MINUTE"
        elif kind == "date":
            value = f"DATE '2024-03-01' + {i}"
        elif kind in ("decimal", "double"):
            value = f"CAST({i} + length({text}) + 0.25 AS DOUBLE)"
        else:
            value = f"CAST({i} + length({text}) AS BIGINT)"
        if field.name not in listed and i % 3 == 0:
            value = f"CASE WHEN {text} NOT LIKE '%7' THEN {value} END"
        columns.append(f'{value} AS "{field.name}"')
    return ", ".join(columns)


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a file stream with the event time ``at``."""
    schema = events(spark, sf_dir).schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return rows.withColumn("at", event_time("ts"))


# Each text defines the relation of the same name; ``e`` is the events table.
SQL = {
    "session_log": """
        session_log AS (
            SELECT CAST(ts AS DATE) AS log_dt,
                   'TV' || lpad(CAST(user_id % 5 AS VARCHAR), 2, '0') AS pn,
                   CAST(user_id AS VARCHAR) || '-' || CAST(extract(hour FROM ts) AS VARCHAR) AS sid,
                   date_trunc('second', ts) AS start_time,
                   date_trunc('second', ts) + to_seconds(CAST(floor(value) AS BIGINT)) AS end_time,
                   CASE event_type WHEN 'purchase' THEN 'begin_checkout'
                                   WHEN 'click' THEN 'checkout_progress' ELSE event_type END AS ec_type
            FROM events)""",
    "programmes": """
        programmes AS (
            SELECT DISTINCT CAST(ts AS DATE) AS bd_date,
                   date_trunc('hour', ts) + INTERVAL 31 MINUTE AS bd_btime,
                   'TV' || lpad(CAST(user_id % 5 AS VARCHAR), 2, '0') AS media_code,
                   'T' || CAST(extract(hour FROM ts) AS VARCHAR) AS tape_code,
                   regexp_extract(props, '[0-9]+') AS goods_code
            FROM events)""",
    "frames": """
        frames AS (
            SELECT DISTINCT CAST(ts AS DATE) AS bd_date,
                   date_trunc('hour', ts) + INTERVAL 31 MINUTE AS bd_btime,
                   'TV' || lpad(CAST(user_id % 5 AS VARCHAR), 2, '0') AS media_code,
                   'T' || CAST(extract(hour FROM ts) AS VARCHAR) || '-'
                       || CAST((user_id % 5) % 2 AS VARCHAR) AS tape_code
            FROM events)""",
    "connection_log": """
        connection_log AS (
            SELECT ts AS log_time,
                   'TV' || lpad(CAST(user_id % 5 AS VARCHAR), 2, '0') AS pn,
                   CAST(user_id AS VARCHAR) AS uid,
                   CASE event_type WHEN 'view' THEN 'connect' WHEN 'error' THEN 'disconnect'
                                   ELSE 'ping' END AS status,
                   ts AS st
            FROM events)""",
    "order_lines": """
        order_lines AS (
            SELECT regexp_extract(props, '[0-9]+') AS goods_code,
                   'TV' || lpad(CAST(user_id % 5 AS VARCHAR), 2, '0') AS media_code,
                   ts AS order_date,
                   CAST(value AS DECIMAL(18, 2)) AS order_amt
            FROM events WHERE event_type = 'purchase')""",
    "seconds_dim": """
        seconds_dim AS (
            SELECT d.day + to_seconds(s.i) AS dhms, CAST(d.day AS DATE) AS date
            FROM (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS day FROM events) d,
                 (SELECT unnest(range(86400)) AS i) s)""",
}


def with_sql(*names: str) -> str:
    """``WITH`` clause of the named relations."""
    return "WITH " + ",".join(SQL[name] for name in names)
