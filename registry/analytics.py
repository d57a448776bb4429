"""Histograms, live figures and per-programme viewers."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.common import AS_OF, LOAD_AT, WIDE, plain, query
from slotwise import testmap as t
from slotwise.functions.timeops import instant_in, ntz, wall_clock_in
from slotwise.operators import live, sessions
from slotwise.operators.dims import runs_of_days, second_runs, seconds_of_days
from slotwise.plans import folds
from slotwise.sources.scratch import new_folder
from slotwise.sources.tables import overwrite_table, read_table

# A session comes with its first row and goes with its latest end, or its latest start where no row ends.
# It watched every airing that it neither left before the start nor reached after the hour.
WATCHED = """
    arrivals AS (
        SELECT log_dt AS day, pn AS channel, sid AS viewer, start_time AS came FROM session_log
        QUALIFY row_number() OVER (PARTITION BY log_dt, pn, sid ORDER BY start_time) = 1),
    departures AS (
        SELECT log_dt AS day, pn AS channel, sid AS viewer, coalesce(end_time, start_time) AS went FROM session_log
        QUALIFY row_number() OVER (
            PARTITION BY log_dt, pn, sid ORDER BY end_time DESC NULLS LAST, start_time DESC NULLS LAST) = 1),
    airings AS (SELECT bd_date, bd_btime, media_code, tape_code FROM programmes GROUP BY ALL),
    watched AS (
        SELECT p.*, v.*,
               CAST(greatest(0, epoch(date_trunc('minute', came)) - epoch(date_trunc('minute', bd_btime))) / 60 AS BIGINT) AS base_mi
        FROM (arrivals JOIN departures USING (day, channel, viewer)) v
        JOIN airings p ON v.day = p.bd_date AND v.channel = p.media_code
        WHERE NOT (went < bd_btime OR came >= bd_btime + INTERVAL 1 HOUR))"""

# The duration classes and their limits in seconds.
CLASSES = """
    classes(label, low, high) AS (VALUES
        ('0.1초미만', -1e18, 1), ('1.1-10초', 1, 10), ('2.10-30초', 10, 30), ('3.30초-1분', 30, 60), ('4.1분-2분', 60, 120),
        ('5.2분-3분', 120, 180), ('6.3분-4분', 180, 240), ('7.4분-5분', 240, 300), ('8.5분이상', 300, 1e18))"""

# Every programme, minute and class with the sessions that came in a second of the dimension.
VIEW_TIMES = """
    SELECT bd_date, bd_btime, tape_code, base_mi, label AS view_time_cd, count(*) AS view_cnt
    FROM watched JOIN classes
      ON epoch(date_trunc('second', went)) - epoch(date_trunc('second', came)) >= low
     AND epoch(date_trunc('second', went)) - epoch(date_trunc('second', came)) < high
    WHERE came IN (SELECT dhms FROM seconds_dim) GROUP BY ALL"""


def log_and_schedule(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The session log, and the programme schedule as a stored table."""
    e = t.events(spark, sf_dir)
    return t.session_log(e), t.stored(spark, sessions.distinct_programmes(t.programmes(e)), "programmes")


def seconds_dim(schedule: DataFrame) -> DataFrame:
    """The seconds of all schedule days, which are the days with events, as runs."""
    return runs_of_days(schedule.select(F.col("bd_date").alias("date")))


@query(f"{t.with_sql('session_log', 'programmes', 'seconds_dim')}, {WATCHED}, {CLASSES} {VIEW_TIMES}")
def view_time_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, schedule = log_and_schedule(spark, sf_dir)
    return sessions.view_time_histogram(log, schedule, seconds_dim(schedule))


# The same for sessions that order after their first second.
ORDER_TIMES = """
    WITH first_orders AS (
        SELECT log_dt AS day, pn AS channel, sid AS viewer, start_time AS ordered FROM session_log
        WHERE ec_type IN ('begin_checkout', 'checkout_progress')
        QUALIFY row_number() OVER (PARTITION BY log_dt, pn, sid ORDER BY start_time) = 1),
    waits AS (
        SELECT w.*, epoch(date_trunc('second', ordered)) - epoch(date_trunc('second', came)) AS waited
        FROM watched w JOIN first_orders USING (day, channel, viewer)
        WHERE came IN (SELECT dhms FROM seconds_dim))
    SELECT bd_date, bd_btime, tape_code, base_mi, label AS dif_order_time_cd, count(*) AS order_cnt
    FROM waits JOIN classes ON waited >= low AND waited < high WHERE waited > 0 GROUP BY ALL"""


@query(f"{t.with_sql('session_log', 'programmes', 'seconds_dim')}, {WATCHED}, {CLASSES}, counted AS ({ORDER_TIMES}) SELECT * FROM counted")
def order_time_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, schedule = log_and_schedule(spark, sf_dir)
    return sessions.order_time_histogram(log, schedule, seconds_dim(schedule))


# A dimension with gaps, in which the seconds of some hours stand twice.
HOLEY = """
    holey_dim AS (
        SELECT dhms FROM seconds_dim WHERE CAST(epoch(dhms) AS BIGINT) % 7 <> 3
        UNION ALL SELECT dhms FROM seconds_dim WHERE extract(hour FROM dhms) IN (9, 12))"""


def holey_runs(spark: SparkSession, schedule: DataFrame) -> DataFrame:
    """Its stored seconds as stored runs."""
    seconds = seconds_of_days(schedule.select(F.col("bd_date").alias("date")), ntz(LOAD_AT))
    second = F.unix_seconds(F.col("dhms").cast("timestamp"))
    listed = seconds.where(second % 7 != 3).unionByName(seconds.where(F.hour("dhms").isin(9, 12)))
    return t.stored(spark, second_runs(t.stored(spark, listed, "holey-seconds")), "holey-runs")


@query(
    f"""{t.with_sql('session_log', 'programmes', 'seconds_dim')}, {WATCHED}, {CLASSES}, {HOLEY}
    SELECT bd_date, bd_btime, tape_code, base_mi, label AS view_time_cd, count(*) AS view_cnt
    FROM watched JOIN holey_dim ON dhms = came JOIN classes
      ON epoch(date_trunc('second', went)) - epoch(date_trunc('second', came)) >= low
     AND epoch(date_trunc('second', went)) - epoch(date_trunc('second', came)) < high
    GROUP BY ALL"""
)
def view_time_histogram_by_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries in seconds that are missing do not count, those in seconds listed twice count twice."""
    log, schedule = log_and_schedule(spark, sf_dir)
    return sessions.view_time_histogram(log, schedule, holey_runs(spark, schedule))


@query(
    f"""{t.with_sql('session_log', 'programmes', 'seconds_dim')}, {WATCHED}, {CLASSES}, {HOLEY}, counted AS (
        {ORDER_TIMES.replace("WHERE came IN (SELECT dhms FROM seconds_dim)", "JOIN holey_dim ON dhms = came")}) SELECT * FROM counted"""
)
def order_time_histogram_by_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    log, schedule = log_and_schedule(spark, sf_dir)
    return sessions.order_time_histogram(log, schedule, holey_runs(spark, schedule))


@query(
    f"""{t.with_sql('session_log', 'programmes')}, {WATCHED}
    SELECT bd_date, bd_btime, media_code, tape_code, count(DISTINCT viewer) AS viewers FROM watched GROUP BY ALL"""
)
def programme_viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.programme_viewers(*log_and_schedule(spark, sf_dir))


@query(
    f"""{t.with_sql('session_log', 'programmes')}, {WATCHED}
    SELECT bd_date, bd_btime, media_code, tape_code, CAST(mi AS BIGINT) AS base_mi, count(DISTINCT viewer) AS viewers
    FROM (SELECT w.*, minute.mi FROM watched w, range(0, 61) AS minute(mi)
          WHERE mi = base_mi
             OR (mi > base_mi AND date_trunc('minute', bd_btime) + to_minutes(mi)
                              <= least(went, bd_btime + INTERVAL 3599 SECOND)))
    GROUP BY bd_date, bd_btime, media_code, tape_code, mi"""
)
def minute_viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.minute_viewers(*log_and_schedule(spark, sf_dir))


# Who was heard of in the last day, without those whose disconnect no connect follows.
CONNECTED = """
    heard AS (SELECT * FROM connection_log WHERE log_time < TIMESTAMP '2024-01-15 12:00:00' {0}),
    gone AS (
        SELECT pn, uid FROM heard d WHERE status = 'disconnect' AND NOT EXISTS (
            SELECT 1 FROM heard k WHERE k.pn = d.pn AND k.uid = d.uid AND k.status = 'connect' AND k.st > d.st)),
    present AS (
        SELECT pn, uid FROM heard WHERE log_time >= TIMESTAMP '2024-01-14 12:00:00' EXCEPT SELECT pn, uid FROM gone),
    viewers AS (SELECT pn AS media_code, count(*) AS unique_viewers FROM present GROUP BY pn)"""
LAST_DAY = "AND log_time >= TIMESTAMP '2024-01-14 12:00:00'"


@query(f"{t.with_sql('connection_log')}, {CONNECTED.format(LAST_DAY)} SELECT * FROM viewers")
def active_viewers_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = t.connection_log(t.events(spark, sf_dir))
    return live.active_viewers(log, AS_OF, lookback=timedelta(hours=24))


@query(f"{t.with_sql('connection_log')}, {CONNECTED.format('')} SELECT * FROM viewers")
def active_viewers_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = t.connection_log(t.events(spark, sf_dir))
    return live.active_viewers(log, AS_OF, lookback=None, timeout=timedelta(hours=24))


@query(f"{t.with_sql('connection_log')}, {CONNECTED.format('')} SELECT * FROM viewers")
def active_viewers_from_daily_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history form from one stored fold per day instead of the raw log."""
    log = t.connection_log(t.events(spark, sf_dir)).where(F.col("log_time") < ntz(AS_OF))
    daily = t.stored(spark, live.latest_events(log, F.col("log_time").cast("date").alias("log_dt")), "folds")
    return live.active_from_latest(live.merge_latest(daily), AS_OF, timedelta(hours=24))


@query(f"{t.with_sql('connection_log')}, {CONNECTED.format('')} SELECT * FROM viewers")
def active_viewers_from_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history form from sets of 1, 2, 4, ... days, kept in steps; the last step brings days again."""
    log, table = t.connection_log(t.events(spark, sf_dir)), new_folder(spark, "fold-sets")
    first = log.agg(F.min("log_time")).first()[0].date()
    for since, until in ((first, date(2024, 1, 9)), (date(2024, 1, 9), date(2024, 1, 14)), (date(2024, 1, 12), date(2024, 1, 15))):
        folds.add_days(spark, table, log, since, until)
    return folds.active_viewers_from_folds(spark, table, log, AS_OF, timedelta(hours=24))


@query(f"{t.with_sql('connection_log')}, {CONNECTED.format(LAST_DAY)} SELECT * FROM viewers")
def active_viewers_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of instants, stored by their day in UTC, looked at on the business clock."""
    log = t.connection_log(t.events(spark, sf_dir))
    log = log.withColumns({c: instant_in(c) for c in ("log_time", "st")})
    log = log.withColumn("log_day", wall_clock_in("log_time", "UTC").cast("date"))
    table = new_folder(spark, "instants")
    overwrite_table(log, table, "log_day")
    return live.active_viewers(
        read_table(spark, table, log.schema), AS_OF, lookback=timedelta(hours=24), day="log_day", day_zone="UTC"
    )


@query(
    f"""{t.with_sql('connection_log', 'programmes', 'frames')}, {CONNECTED.format(LAST_DAY)},
    airing_now AS (
        SELECT * FROM frames
        WHERE bd_date BETWEEN DATE '2024-01-14' AND DATE '2024-01-15'
          AND bd_btime = (SELECT bd_btime FROM programmes
                          WHERE bd_date BETWEEN DATE '2024-01-14' AND DATE '2024-01-15'
                            AND bd_btime <= TIMESTAMP '2024-01-15 12:00:00'
                          ORDER BY bd_btime DESC LIMIT 1))
    SELECT TIMESTAMP '2024-01-15 12:00:00' AS init_date, tape_code, 'DA001' AS data_type, bd_btime,
           CAST(coalesce(sum(unique_viewers), 0) AS DOUBLE) AS data_value
    FROM airing_now LEFT JOIN viewers USING (media_code) GROUP BY tape_code, bd_btime"""
)
def airing_viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t.events(spark, sf_dir)
    viewers = live.active_viewers(t.connection_log(e), AS_OF, lookback=timedelta(hours=24))
    return plain(live.airing_viewers(t.frames(e), t.programmes(e), viewers, AS_OF))


def viewers_tick(at: str, day: str) -> str:
    """The statistic of one tick that looks an hour back, stated anew from single events."""
    return f"""
    SELECT TIMESTAMP '{at}' AS init_date, f.tape_code, 'DA001' AS data_type, f.bd_btime,
           CAST(coalesce(sum(v.n), 0) AS DOUBLE) AS data_value
    FROM frames f
    LEFT JOIN (
        SELECT pn, count(*) AS n FROM (
            SELECT pn, uid FROM connection_log WHERE log_time >= TIMESTAMP '{at}' - INTERVAL 1 HOUR AND log_time < TIMESTAMP '{at}'
            EXCEPT
            SELECT d.pn, d.uid FROM connection_log d
            WHERE d.status = 'disconnect' AND d.log_time >= TIMESTAMP '{at}' - INTERVAL 1 HOUR AND d.log_time < TIMESTAMP '{at}'
              AND NOT EXISTS (
                SELECT 1 FROM connection_log k
                WHERE k.pn = d.pn AND k.uid = d.uid AND k.status = 'connect' AND k.st > d.st
                  AND k.log_time >= TIMESTAMP '{at}' - INTERVAL 1 HOUR AND k.log_time < TIMESTAMP '{at}'))
        GROUP BY pn) v ON v.pn = f.media_code
    WHERE f.bd_date BETWEEN DATE '{day}' - 1 AND DATE '{day}' AND f.bd_btime = (
        SELECT max(bd_btime) FROM programmes WHERE bd_date BETWEEN DATE '{day}' - 1 AND DATE '{day}' AND bd_btime <= TIMESTAMP '{at}')
    GROUP BY f.tape_code, f.bd_btime"""


# Every single order beside every airing of its goods.
SALES = """
    sales AS (
        SELECT bd_btime, tape_code, date_trunc('minute', order_date) AS minute, order_amt
        FROM (SELECT bd_btime, tape_code, goods_code, media_code FROM programmes GROUP BY ALL)
        JOIN order_lines USING (goods_code, media_code)
        WHERE order_amt > 0
          AND order_date BETWEEN TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 24 HOUR AND TIMESTAMP '2024-01-15 12:00:00'
          AND bd_btime - INTERVAL 10 MINUTE <= TIMESTAMP '2024-01-15 12:00:00'
          AND bd_btime + INTERVAL 96 HOUR >= TIMESTAMP '2024-01-15 12:00:00')"""


@query(
    f"""{t.with_sql('order_lines', 'programmes')}, {SALES}
    SELECT bd_btime, tape_code, left(CAST(minute AS VARCHAR), 16) AS order_mi, CAST(sum(order_amt) AS DOUBLE) AS price
    FROM sales GROUP BY bd_btime, tape_code, minute"""
)
def airing_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t.events(spark, sf_dir)
    return plain(live.airing_revenue(t.order_lines(e), t.programmes(e), AS_OF, **WIDE))


@query(
    f"""{t.with_sql('order_lines', 'programmes')}, {SALES}
    SELECT minute AS init_date, tape_code, 'DA002' AS data_type, bd_btime, CAST(sum(order_amt) AS DOUBLE) AS data_value
    FROM sales GROUP BY bd_btime, tape_code, minute"""
)
def airing_revenue_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = t.events(spark, sf_dir)
    revenue = live.airing_revenue(t.order_lines(e), t.programmes(e), AS_OF, **WIDE)
    return plain(live.revenue_stats(revenue))
