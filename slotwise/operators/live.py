"""Live figures: connected viewers and order revenue per airing programme."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions.fixed import CONNECT, DISCONNECT, REVENUE_STAT, TIME_ZONE, VIEWERS_STAT
from slotwise.functions.timeops import bound_for, days_between, minute_text, ntz, parse_minute, trunc_minute

HOUR = timedelta(hours=1)
STAT = ("init_date", "tape_code", "data_type", "data_value", "bd_btime")
STAT_KEY = ("init_date", "tape_code", "data_type")


# ---- connected viewers -----------------------------------------------------------


def latest_events(log: DataFrame, *within: Column) -> DataFrame:
    """Last activity, connect and disconnect per (media, user), optionally ``within`` days or minutes.

    Maxima of maxima are maxima: folds of single days or minutes can be stored, and
    :func:`merge_latest` of any of them equals the fold of their log rows.
    """
    return log.groupBy(*within, F.col("pn").alias("media_code"), F.col("uid").alias("user_id")).agg(
        F.max("log_time").alias("last_activity"),
        F.max(F.when(F.col("status") == CONNECT, F.col("st"))).alias("last_connect"),
        F.max(F.when(F.col("status") == DISCONNECT, F.col("st"))).alias("last_disconnect"),
    )


def merge_latest(folds: DataFrame) -> DataFrame:
    """One fold of several stored :func:`latest_events` results."""
    marks = ("last_activity", "last_connect", "last_disconnect")
    return folds.groupBy("media_code", "user_id").agg(*[F.max(m).alias(m) for m in marks])


def is_connected() -> Column:
    """No disconnect, or a connect after it.  A disconnect without a connect is out."""
    return F.col("last_disconnect").isNull() | (F.col("last_connect") > F.col("last_disconnect"))


def count_viewers(latest: DataFrame, by: Sequence[str] = ("media_code",)) -> DataFrame:
    """Viewers per media.  Users are unique per media here, so a plain count is the distinct one."""
    return latest.where(is_connected()).groupBy(*by).agg(F.count("user_id").alias("unique_viewers"))


def active_viewers(
    log: DataFrame,
    as_of: datetime,
    lookback: timedelta | None = HOUR,
    timeout: timedelta = HOUR,
    tz: str = TIME_ZONE,
    day: str | None = None,
    day_zone: str = TIME_ZONE,
) -> DataFrame:
    """Distinct connected users per media just before ``as_of``.

    With ``lookback`` only events in ``[as_of - lookback, as_of)`` are seen, so an older
    disconnect is forgotten.  With ``lookback=None`` connects and disconnects come from the
    whole history and users without activity in ``[as_of - timeout, as_of)`` are left out.  The
    two give different answers.  ``as_of`` is a wall clock of ``tz``.

    A log partitioned by ``day``, the date of ``log_time`` in ``day_zone``, is read in the days of the look-back
    only: the days are literals, whatever the zones of the log, the business and the session.
    """
    kind = log.schema["log_time"].dataType
    if day is not None:
        first, last = days_between(as_of - lookback if lookback is not None else as_of, as_of, tz, day_zone)
        in_days = F.col(day) <= F.lit(last)
        log = log.where(in_days if lookback is None else in_days & (F.col(day) >= F.lit(first)))
    seen = log.where(F.col("log_time") < bound_for(kind, as_of, tz))
    if lookback is not None:
        return count_viewers(
            latest_events(seen.where(F.col("log_time") >= bound_for(kind, as_of - lookback, tz)))
        )
    return active_from_latest(latest_events(seen), as_of, timeout, tz)


def active_from_latest(
    latest: DataFrame, as_of: datetime, timeout: timedelta = HOUR, tz: str = TIME_ZONE
) -> DataFrame:
    """The history form from an already folded (or stored) :func:`latest_events`."""
    kind = latest.schema["last_activity"].dataType
    recent = latest.where(F.col("last_activity") >= bound_for(kind, as_of - timeout, tz))
    return count_viewers(recent)


def active_from_minutes(folds: DataFrame, as_of: datetime, lookback: timedelta = HOUR) -> DataFrame:
    """The windowed form from folds stored per day ``log_dt`` and ``minute``.

    A tick reads ``lookback`` worth of small folds instead of the raw log.  ``as_of`` and
    ``lookback`` are whole minutes.
    """
    since = as_of - lookback
    inside = (
        F.col("log_dt").between(F.lit(since.date()), F.lit(as_of.date()))
        & (F.col("minute") >= ntz(since))
        & (F.col("minute") < ntz(as_of))
    )
    return count_viewers(merge_latest(folds.where(inside)))


# ---- airing programmes -----------------------------------------------------------


def airing_start(ticks: DataFrame, schedule: DataFrame) -> DataFrame:
    """Latest programme start at or before each tick, looking at the tick's day and the day before.

    ``ticks`` has wall clocks ``as_of``; starts are compared by minute.  Start minutes and tick
    minutes are laid side by side per schedule day and a running maximum carries the last start
    to the ticks, so no (tick, start) pairs are formed and a window holds one day of minutes.
    """
    day = F.col("tick").cast("date")
    asked = ticks.select(trunc_minute("as_of").alias("tick")).distinct()
    marks = (
        schedule.select(F.col("bd_date").alias("day"), trunc_minute("bd_btime").alias("start"))
        .distinct()
        .select("day", F.col("start").alias("minute"), "start", F.lit(None).cast("timestamp_ntz").alias("tick"))
        .unionByName(
            asked.select(
                F.explode(F.array(F.date_sub(day, 1), day)).alias("day"),
                F.col("tick").alias("minute"),
                F.lit(None).cast("timestamp_ntz").alias("start"),
                "tick",
            )
        )
    )
    so_far = W.partitionBy("day").orderBy("minute").rangeBetween(W.unboundedPreceding, W.currentRow)
    return (
        marks.withColumn("latest", F.max("start").over(so_far))
        .where(F.col("tick").isNotNull())
        .groupBy(F.col("tick").alias("init_date"))
        .agg(F.max("latest").alias("bd_btime"))
        .where(F.col("bd_btime").isNotNull())
    )


def airing_viewers_at(on_air: DataFrame, codes: DataFrame, viewers: DataFrame) -> DataFrame:
    """Viewer statistics of the tapes on air, for any number of ticks.

    ``on_air`` comes from :func:`airing_start`; ``viewers`` has ``as_of, media_code,
    unique_viewers``.  Tapes of media without viewers get zero and rows without a tape are
    dropped.  Missing media match missing media, as in a data-frame merge.
    """
    today = F.col("init_date").cast("date")
    tapes = codes.select("bd_date", "media_code", "tape_code", trunc_minute("bd_btime").alias("code_minute"))
    here = on_air.join(
        tapes,
        (F.col("bd_btime") == F.col("code_minute")) & F.col("bd_date").between(F.date_sub(today, 1), today),
    ).where(F.col("tape_code").isNotNull())
    counts = viewers.select(
        trunc_minute("as_of").alias("seen_at"), F.col("media_code").alias("seen_on"), "unique_viewers"
    )
    joined = here.join(
        counts,
        (F.col("init_date") == F.col("seen_at")) & F.col("media_code").eqNullSafe(F.col("seen_on")),
        "left",
    )
    total = F.coalesce(F.sum("unique_viewers"), F.lit(0)).cast("decimal(18,2)")
    return (
        joined.groupBy("init_date", "tape_code", "bd_btime")
        .agg(total.alias("data_value"))
        .withColumn("data_type", F.lit(VIEWERS_STAT))
        .select(*STAT)
    )


def airing_viewers(
    codes: DataFrame, schedule: DataFrame, viewers: DataFrame, as_of: datetime
) -> DataFrame:
    """Viewer statistics of the tapes on air at ``as_of``; no rows before the first programme.

    The latest start is one row and is broadcast.
    """
    as_of = _minute(as_of)
    days = [(as_of - timedelta(days=1)).date(), as_of.date()]
    started = schedule.where(F.col("bd_date").isin(days)).select(trunc_minute("bd_btime").alias("start"))
    on_air = started.where(F.col("start") <= ntz(as_of)).agg(F.max("start").alias("bd_btime"))
    return airing_viewers_at(
        F.broadcast(on_air.withColumn("init_date", ntz(as_of))),
        codes.where(F.col("bd_date").isin(days)),
        viewers.select(ntz(as_of).alias("as_of"), "media_code", "unique_viewers"),
    )


# ---- revenue ---------------------------------------------------------------------


def airing_revenue(
    orders: DataFrame,
    programmes: DataFrame,
    now: datetime,
    order_back: timedelta = timedelta(minutes=30),
    air_back: timedelta = timedelta(minutes=120),
    air_ahead: timedelta = timedelta(minutes=10),
) -> DataFrame:
    """Order amount per (programme start, tape, order minute).

    All bounds are whole minutes and closed.  An order counts for every airing of its goods and
    media within the programme range; there is no time match between the two.  Both sides are
    aggregated before the join, so popular goods travel as one row per order minute.
    """
    now = now.replace(second=0, microsecond=0)
    per_minute = (
        orders.where(
            F.col("order_date").between(ntz(_minute(now - order_back)), ntz(now)) & (F.col("order_amt") > 0)
        )
        .groupBy("goods_code", "media_code", trunc_minute("order_date").alias("minute"))
        .agg(F.sum("order_amt").alias("price"))
    )
    airings = (
        programmes.where(
            F.col("bd_btime").between(ntz(_minute(now - air_back)), ntz(_minute(now + air_ahead)))
        )
        .select("bd_btime", "tape_code", "goods_code", "media_code")
        .distinct()
    )
    return (
        per_minute.join(airings, on=["goods_code", "media_code"], how="inner")
        .groupBy("bd_btime", "tape_code", "minute")
        .agg(F.sum("price").alias("price"))
        .select("bd_btime", "tape_code", minute_text("minute").alias("order_mi"), "price")
    )


def revenue_stats(revenue: DataFrame) -> DataFrame:
    """Statistic rows of :func:`airing_revenue`; zero totals are skipped."""
    return revenue.where(F.col("price") != 0).select(
        parse_minute("order_mi").alias("init_date"),
        "tape_code",
        F.lit(REVENUE_STAT).alias("data_type"),
        F.col("price").cast("decimal(18,2)").alias("data_value"),
        "bd_btime",
    )


def _minute(value: datetime) -> datetime:
    return value.replace(second=0, microsecond=0)
