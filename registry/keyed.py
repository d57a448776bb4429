"""Keyed, day and range replacement, as frames and on stored tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from registry.analytics import CLASSES, ORDER_TIMES, VIEW_TIMES, WATCHED, log_and_schedule, seconds_dim, viewers_tick
from registry.common import AS_OF, DAY, plain, query
from registry.common import SQL as QUERY_SQL
from slotwise import testmap as t
from slotwise.functions.timeops import since_previous_month, trailing_minutes
from slotwise.operators.extract import extract_snapshot, extract_window
from slotwise.operators.sessions import order_time_histogram, view_time_histogram
from slotwise.operators.upsert import replace_day as replace_day_rows
from slotwise.operators.upsert import replace_range as replace_range_rows
from slotwise.operators.upsert import upsert_by_key as upsert_rows
from slotwise.plans import analytics, reaimed, viewers
from slotwise.sources import schemas
from slotwise.sources.scratch import new_folder
from slotwise.sources.tables import create_table, overwrite_table, read_table
from slotwise.sources.writers import export_csv

AMOUNT = "decimal(18,2)"


def order_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as booked: one row per order."""
    return t.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_no"),
        F.col("o_orderdate").alias("booked_at"),
        F.col("o_totalprice").cast(AMOUNT).alias("amount"),
        F.lit("booked").alias("origin"),
    )


def line_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as delivered, staged: one row per order and return flag, so several per key."""
    lines = t.table(spark, sf_dir, "lineitem")
    amounts = lines.groupBy(F.col("l_orderkey").alias("order_no"), F.col("l_returnflag").alias("origin")).agg(
        F.sum(F.col("l_extendedprice").cast(AMOUNT)).cast(AMOUNT).alias("amount"),
        F.min("l_shipdate").alias("booked_at"),
    )
    return t.stored(spark, amounts, "delivered")


AMOUNTS_SQL = """
    booked AS (
        SELECT o_orderkey AS order_no, o_orderdate AS booked_at,
               CAST(o_totalprice AS DECIMAL(18, 2)) AS amount, 'booked' AS origin
        FROM orders),
    delivered AS (
        SELECT l_orderkey AS order_no, min(l_shipdate) AS booked_at,
               CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DECIMAL(18, 2)) AS amount,
               l_returnflag AS origin
        FROM lineitem GROUP BY l_orderkey, l_returnflag)"""
AMOUNT_COLUMNS = "order_no, booked_at, CAST(amount AS DOUBLE) AS amount, origin"


@query(
    f"""WITH {AMOUNTS_SQL}
    SELECT {AMOUNT_COLUMNS} FROM booked WHERE order_no NOT IN (SELECT order_no FROM delivered)
    UNION ALL SELECT {AMOUNT_COLUMNS} FROM delivered"""
)
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(upsert_rows(order_amounts(spark, sf_dir), line_amounts(spark, sf_dir), "order_no"))


@query(
    f"""WITH {AMOUNTS_SQL}
    SELECT {AMOUNT_COLUMNS} FROM booked WHERE booked_at NOT IN (SELECT booked_at FROM delivered)
    UNION ALL SELECT {AMOUNT_COLUMNS} FROM delivered WHERE origin <> 'N'"""
)
def upsert_filtered_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By day slice; rows of one return flag delete their days but are not inserted."""
    return plain(
        upsert_rows(
            order_amounts(spark, sf_dir),
            line_amounts(spark, sf_dir),
            "booked_at",
            insert_filter=F.col("origin") != "N",
        )
    )


@query(
    f"""WITH {AMOUNTS_SQL}
    SELECT {AMOUNT_COLUMNS} FROM booked WHERE (order_no, origin) NOT IN (SELECT order_no, origin FROM delivered)
    UNION ALL SELECT {AMOUNT_COLUMNS} FROM delivered"""
)
def upsert_by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        upsert_rows(order_amounts(spark, sf_dir), line_amounts(spark, sf_dir), ["order_no", "origin"])
    )


@query(
    f"""{t.with_sql('connection_log')}
    SELECT CAST(log_time AS DATE) AS log_dt, pn, uid, status, log_time FROM connection_log
    WHERE CAST(log_time AS DATE) <> DATE '2024-01-15'
    UNION ALL
    SELECT CAST(log_time AS DATE), pn, uid, 'replayed', log_time FROM connection_log
    WHERE CAST(log_time AS DATE) = DATE '2024-01-15' AND status <> 'ping'"""
)
def replace_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = t.connection_log(t.events(spark, sf_dir)).select(
        F.col("log_time").cast("date").alias("log_dt"), "pn", "uid", "status", "log_time"
    )
    rows = log.where((F.col("log_dt") == F.lit(DAY)) & (F.col("status") != "ping"))
    return replace_day_rows(log, rows.withColumn("status", F.lit("replayed")), DAY, "log_dt")


@query(
    f"""WITH {AMOUNTS_SQL}
    SELECT {AMOUNT_COLUMNS} FROM booked
    WHERE NOT (booked_at >= TIMESTAMP '1997-05-01' AND booked_at < TIMESTAMP '1997-06-15')
    UNION ALL
    SELECT {AMOUNT_COLUMNS} FROM delivered
    WHERE booked_at >= TIMESTAMP '1997-05-01' AND booked_at < TIMESTAMP '1997-06-15'"""
)
def replace_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = since_previous_month(datetime(1997, 6, 15, 7, 0))
    return plain(
        replace_range_rows(order_amounts(spark, sf_dir), line_amounts(spark, sf_dir), "booked_at", low, high)
    )


@query(
    f"""WITH {AMOUNTS_SQL}
    SELECT order_no, booked_at, CAST(amount AS DOUBLE) AS amount FROM booked
    WHERE booked_at >= TIMESTAMP '1997-05-01' AND booked_at < TIMESTAMP '1997-06-15'"""
)
def extract_window_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = since_previous_month(datetime(1997, 6, 15, 7, 0))
    columns = ["order_no", "booked_at", "amount"]
    return plain(extract_window(order_amounts(spark, sf_dir), columns, "booked_at", low, high))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def extract_snapshot_of_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_snapshot(t.table(spark, sf_dir, "customer"), ["c_custkey", "c_name", "c_mktsegment"])


# ---- stored tables ---------------------------------------------------------------


@query(
    f"""{t.with_sql('session_log', 'programmes', 'seconds_dim')}, {WATCHED}, {CLASSES}, counted AS ({VIEW_TIMES})
    SELECT * REPLACE (CASE WHEN bd_date = DATE '2024-01-15' THEN view_cnt ELSE 0 END AS view_cnt) FROM counted"""
)
def run_view_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored histogram with stale counts, after one day has been recomputed."""
    log, schedule = log_and_schedule(spark, sf_dir)
    seconds = seconds_dim(schedule)
    stale = view_time_histogram(log, schedule, seconds).withColumn("view_cnt", F.lit(0).cast("bigint"))
    table = new_folder(spark, "view-times")
    overwrite_table(stale, table, "bd_date")
    analytics.run_view_times(log, schedule, seconds, table, DAY)
    return read_table(spark, table, stale.schema)


@query(
    f"""{t.with_sql('session_log', 'programmes', 'seconds_dim')}, {WATCHED}, {CLASSES}, counted AS ({ORDER_TIMES})
    SELECT * REPLACE (CASE WHEN bd_date = DATE '2024-01-15' THEN order_cnt ELSE 0 END AS order_cnt) FROM counted"""
)
def run_order_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the time to the first order."""
    log, schedule = log_and_schedule(spark, sf_dir)
    seconds = seconds_dim(schedule)
    stale = order_time_histogram(log, schedule, seconds).withColumn("order_cnt", F.lit(0).cast("bigint"))
    table = new_folder(spark, "order-times")
    overwrite_table(stale, table, "bd_date")
    analytics.run_order_times(log, schedule, seconds, table, DAY)
    return read_table(spark, table, stale.schema)


def _live_sql(again: str) -> str:
    return f"""{t.with_sql('order_lines', 'programmes')},
    airings AS (SELECT DISTINCT bd_btime, tape_code, goods_code, media_code FROM programmes
        WHERE bd_btime >= TIMESTAMP '2024-01-15 10:00:00' AND bd_btime <= TIMESTAMP '2024-01-15 12:10:00'),
    stats AS (
        SELECT date_trunc('minute', o.order_date) AS init_date, a.tape_code, 'DA002' AS data_type,
               CAST(sum(o.order_amt) AS DOUBLE) AS data_value, a.bd_btime
        FROM order_lines o JOIN airings a ON o.goods_code = a.goods_code AND o.media_code = a.media_code
        WHERE o.order_date >= TIMESTAMP '2024-01-15 11:30:00'
          AND o.order_date <= TIMESTAMP '2024-01-15 12:00:00' AND o.order_amt > 0
        GROUP BY ALL)
    SELECT * FROM stats {again}"""


def _two_ticks(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    e = t.events(spark, sf_dir)
    table = new_folder(spark, "live-stat")
    create_table(spark, table, schemas.LIVE_STAT_TABLE, analytics.STAT_PARTITION)
    for _ in range(2):
        analytics.run_live_revenue(t.order_lines(e), t.programmes(e), table, AS_OF, mode)
    return plain(read_table(spark, table, schemas.LIVE_STAT))


@query(_live_sql("UNION ALL SELECT * FROM stats"))
def run_live_revenue_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tick twice: appending keeps both."""
    return _two_ticks(spark, sf_dir, "append")


@query(_live_sql(""))
def run_live_revenue_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tick twice: upserting keeps one."""
    return _two_ticks(spark, sf_dir, "upsert")


TODAY, YESTERDAY = viewers_tick("2024-01-15 12:00:00", "2024-01-15"), viewers_tick("2024-01-14 12:00:00", "2024-01-14")
TICK_TABLES = t.with_sql("connection_log", "programmes", "frames")


def _viewer_ticks(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    """A tick of the day before, and today's twice."""
    e, table = t.events(spark, sf_dir), new_folder(spark, "live-stat")
    create_table(spark, table, schemas.LIVE_STAT_TABLE, analytics.STAT_PARTITION)
    for at in (AS_OF - timedelta(days=1), AS_OF, AS_OF):
        analytics.run_live_viewers(t.connection_log(e), t.frames(e), t.programmes(e), table, at, mode)
    return plain(read_table(spark, table, schemas.LIVE_STAT))


@query(f"{TICK_TABLES} {YESTERDAY} UNION ALL {TODAY} UNION ALL {TODAY}")
def run_live_viewers_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _viewer_ticks(spark, sf_dir, "append")


@query(f"{TICK_TABLES} {YESTERDAY} UNION ALL {TODAY}")
def run_live_viewers_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _viewer_ticks(spark, sf_dir, "upsert")


@query(
    f"""{t.with_sql('session_log')}
    SELECT * FROM session_log
    WHERE start_time >= TIMESTAMP '2024-01-15 11:30:00' AND start_time < TIMESTAMP '2024-01-15 12:00:00'"""
)
def current_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-aimed: the last half hour of the session log as the current table."""
    log, table = t.session_log(t.events(spark, sf_dir)), new_folder(spark, "current")
    reaimed.run_current_slice(log, table, *trailing_minutes(AS_OF))
    return read_table(spark, table, schemas.SESSION_LOG)


def _three_windows(spark: SparkSession, sf_dir: str, run, kept) -> DataFrame:
    """The log in windows that overlap; the last brings a day again."""
    log, schedule = log_and_schedule(spark, sf_dir)
    store = new_folder(spark, "viewers")
    for start, end in (
        (datetime(2023, 12, 1), datetime(2024, 1, 15, 12)),
        (datetime(2024, 1, 15, 9), datetime(2024, 12, 31)),
        (datetime(2024, 1, 14), datetime(2024, 1, 15)),
    ):
        run(spark, store, log, schedule, start, end)
    return kept(spark, store)


@query(QUERY_SQL["programme_viewers"])
def run_programme_viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-aimed: viewers per programme after three windows are those of the whole log."""
    return _three_windows(spark, sf_dir, viewers.run_programme_viewers, viewers.programme_viewers_table)


@query(QUERY_SQL["minute_viewers"])
def run_minute_viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-aimed: the same per minute."""
    return _three_windows(spark, sf_dir, viewers.run_minute_viewers, viewers.minute_viewers_table)


@query(
    f"""{t.with_sql('session_log')}
    SELECT log_dt, pn, sid, start_time, end_time,
           CASE WHEN log_dt = DATE '2024-01-14' THEN ec_type ELSE 'old' END AS ec_type
    FROM session_log"""
)
def history_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-aimed: yesterday's history replaced by the log, other days untouched."""
    log, table = t.session_log(t.events(spark, sf_dir)), new_folder(spark, "history")
    overwrite_table(log.withColumn("ec_type", F.lit("old")), table, "log_dt")
    low, high = datetime(2024, 1, 14), datetime(2024, 1, 15)
    reaimed.run_history_days(spark, log, table, schemas.SESSION_LOG, low, high)
    return read_table(spark, table, schemas.SESSION_LOG)


@query(
    """
    WITH span AS (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events),
    days AS (SELECT unnest(range(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day FROM span)
    SELECT CAST(day AS DATE) AS date, lpad(CAST(h AS VARCHAR), 2, '0') AS hh, CAST(3600 AS BIGINT) AS seconds,
           day + to_hours(h) AS first_second, day + to_hours(h) + INTERVAL 3599 SECOND AS last_second,
           lpad(CAST(h AS VARCHAR), 2, '0') || '0000' AS first_hms
    FROM days, (SELECT unnest(range(24)) AS h) hours"""
)
def second_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-aimed: the generated second dimension over the event days, summed up per hour."""
    span = t.events(spark, sf_dir).agg(
        F.min("ts").cast("date").alias("lo"), F.max("ts").cast("date").alias("hi")
    ).first()
    table = new_folder(spark, "seconds")
    create_table(spark, table, schemas.SECOND_DIM, "date")
    end = date.fromordinal(span["hi"].toordinal() + 1)
    reaimed.run_second_dim(spark, table, span["lo"], end, datetime(2024, 12, 1))
    return (
        read_table(spark, table, schemas.SECOND_DIM)
        .groupBy("date", "hh")
        .agg(
            F.count_distinct("dhms").alias("seconds"),
            F.min("dhms").alias("first_second"),
            F.max("dhms").alias("last_second"),
            F.min("hms").alias("first_hms"),
        )
    )


def _replace_three_days(spark: SparkSession, rows: DataFrame, schema: StructType, mark: str, key: str) -> DataFrame:
    """A stored schedule marked old, after three days of it came again in a CSV of all rows."""
    landed, stage, table = (new_folder(spark, f"schedule-{n}") for n in ("csv", "stage", "table"))
    rows = t.filled(rows, schema, key)
    export_csv(rows.withColumn(mark, F.lit("new")), landed)
    overwrite_table(rows.withColumn(mark, F.lit("old")), table, "bd_date")
    low, high = datetime(2024, 1, 14), datetime(2024, 1, 17)
    reaimed.run_range_load(spark, landed, stage, table, schema, "bd_date", low, high, "bd_date")
    return plain(read_table(spark, table, schema))


NEW_OR_OLD = "CASE WHEN bd_date >= DATE '2024-01-14' AND bd_date < DATE '2024-01-17' THEN 'new' ELSE 'old' END"
FRAMES_HAVE, AIRING_HAVE = "bd_date bd_btime media_code tape_code", "bd_date bd_btime media_code tape_code goods_code"


@query(
    f"""{t.with_sql('frames')}, numbered AS (
        SELECT *, CAST(bd_date AS VARCHAR) || '/' || tape_code || '/' || media_code AS seq_frame_no FROM frames)
    SELECT * REPLACE ({NEW_OR_OLD} AS etc) FROM (
        SELECT {t.filled_sql(schemas.SCHEDULE_FRAME, FRAMES_HAVE + " seq_frame_no", "tape_code")} FROM numbered)"""
)
def replace_range_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-aimed: schedule frames of three days."""
    frames = t.frames(t.events(spark, sf_dir))
    rows = frames.withColumn("seq_frame_no", F.concat_ws("/", "bd_date", "tape_code", "media_code"))
    return _replace_three_days(spark, rows, schemas.SCHEDULE_FRAME, "etc", "tape_code")


@query(
    f"""{t.with_sql('programmes')} SELECT * REPLACE ({NEW_OR_OLD} AS bd_flag) FROM (
        SELECT {t.filled_sql(schemas.BROADCAST_GOODS, AIRING_HAVE, "goods_code")} FROM programmes)"""
)
def replace_range_broadcast_goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-aimed: broadcast goods of three days."""
    return _replace_three_days(spark, t.programmes(t.events(spark, sf_dir)), schemas.BROADCAST_GOODS, "bd_flag", "goods_code")


@query(
    f"""{t.with_sql('programmes')} SELECT * REPLACE ({NEW_OR_OLD} AS insert_id) FROM (
        SELECT {t.filled_sql(schemas.BROADCAST_NO_GOODS, AIRING_HAVE, "goods_code")} FROM programmes)"""
)
def replace_range_broadcast_no_goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-aimed: the second broadcast goods table, three days."""
    return _replace_three_days(
        spark, t.programmes(t.events(spark, sf_dir)), schemas.BROADCAST_NO_GOODS, "insert_id", "goods_code"
    )


@query(
    f"""{t.with_sql('session_log')}
    SELECT * REPLACE (CASE WHEN log_dt >= TIMESTAMP '2024-01-14 23:45:00' AND log_dt < TIMESTAMP '2024-01-15 00:15:00'
                           THEN ec_type ELSE 'old' END AS ec_type) FROM session_log"""
)
def replace_range_over_midnight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-aimed: half an hour around midnight, on a column of days."""
    log, table = t.session_log(t.events(spark, sf_dir)), new_folder(spark, "midnight")
    overwrite_table(log.withColumn("ec_type", F.lit("old")), table, "log_dt")
    reaimed.run_history_days(
        spark, log, table, schemas.SESSION_LOG, datetime(2024, 1, 14, 23, 45), datetime(2024, 1, 15, 0, 15)
    )
    return read_table(spark, table, schemas.SESSION_LOG)


def promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t.table(spark, sf_dir, "orders")
    return t.filled(
        orders.select(
            F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("seq"),
            F.col("o_custkey").cast("string").alias("promo_no"),
            F.col("o_totalprice").alias("proc_amt"),
            F.when(F.col("o_orderstatus") == "F", "Y").otherwise("N").alias("cancel_yn"),
            F.col("o_orderdate").alias("insert_date"),
        ),
        schemas.ORDER_PROMOTION,
        "seq",
    )


PROMOTIONS_SQL = f"""
    SELECT {t.filled_sql(schemas.ORDER_PROMOTION, "seq promo_no proc_amt cancel_yn insert_date", "seq")} FROM (
    SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS seq, CAST(o_custkey AS VARCHAR) AS promo_no,
           CAST(o_totalprice AS DECIMAL(18, 2)) AS proc_amt,
           {{0}} AS cancel_yn, o_orderdate AS insert_date
    FROM orders {{1}})"""


@query(
    PROMOTIONS_SQL.format(
        """CASE WHEN o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-06-15'
                THEN (CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END) ELSE 'old' END""",
        "",
    )
)
def replace_range_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Re-aimed: promotions since the previous month from a CSV, stored by month."""
    rows = promotions(spark, sf_dir)
    landed, stage, table = (new_folder(spark, f"promotions-{n}") for n in ("csv", "stage", "table"))
    export_csv(rows, landed)
    old = reaimed.promotion_rows(rows.withColumn("cancel_yn", F.lit("old")))
    overwrite_table(old, table, "insert_month")
    low, high = since_previous_month(datetime(1997, 6, 15, 7, 0))
    reaimed.run_promotion_load(spark, landed, stage, table, low, high)
    return plain(read_table(spark, table, schemas.ORDER_PROMOTION_TABLE).drop("insert_month"))
