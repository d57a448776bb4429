"""Live viewers and revenue as streams.

Late rows: a row older than the watermark is dropped.  Windows are published once the watermark
has passed their end, so the newest windows of a stream that stopped stay unpublished.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from slotwise.functions.fixed import CONNECT, DISCONNECT
from slotwise.functions.timeops import epoch_minutes, minute_text, ntz, wall_clock
from slotwise.operators.live import airing_start, airing_viewers_at, count_viewers, latest_events, revenue_stats
from slotwise.operators.sizing import stored_side
from slotwise.plans.analytics import STAT_PARTITION
from slotwise.sources.schemas import LIVE_STAT_TABLE, ORDER_SUMS
from slotwise.sources.scratch import remove_folder
from slotwise.sources.tables import compact_table, upsert_table
from slotwise.sources.versions import Change, create_store, expire


def stream_active_viewers(
    log: DataFrame, lookback: str = "60 minutes", every: str = "1 minute", delay: str = "1 minute"
) -> DataFrame:
    """Connected viewers per media at every tick, from a stream with event time ``log_time``.

    The window ``[tick - lookback, tick)`` is the batch predicate.  Each event lies in
    ``lookback / every`` windows and the state holds one row per window, media and user: a wider
    ``every`` shrinks both.  Rows are combined per (window, media, user) before the shuffle.  For
    very many users see :func:`stream_minute_folds`, whose state does not multiply.
    Result: ``as_of`` (event time of the tick), ``media_code``, ``unique_viewers``.
    """
    per_user = (
        log.withWatermark("log_time", delay)
        .groupBy(
            F.window("log_time", lookback, every).alias("span"),
            F.col("pn").alias("media_code"),
            F.col("uid").alias("user_id"),
        )
        .agg(
            F.max(F.when(F.col("status") == CONNECT, F.col("st"))).alias("last_connect"),
            F.max(F.when(F.col("status") == DISCONNECT, F.col("st"))).alias("last_disconnect"),
        )
    )
    counted = count_viewers(per_user, by=("span", "media_code"))
    return counted.select(F.col("span.end").alias("as_of"), "media_code", "unique_viewers")


def stream_minute_folds(log: DataFrame, delay: str = "1 minute") -> DataFrame:
    """One fold per closed minute, media and user, for ``active_from_minutes``.

    The state is one row per user and open minute, whatever the look-back.  Stored by ``minute``,
    a tick then reads the folds of its look-back.
    """
    minute = F.window("log_time", "1 minute").alias("span")
    folds = latest_events(log.withWatermark("log_time", delay), minute)
    return folds.select(
        wall_clock("span.start").alias("minute"),
        wall_clock("span.start").cast("date").alias("log_dt"),
        "media_code",
        "user_id",
        wall_clock("last_activity").alias("last_activity"),
        "last_connect",
        "last_disconnect",
    )


def write_airing_viewers(
    viewers: DataFrame, codes: DataFrame, schedule: DataFrame, path: str, checkpoint: str
) -> DataStreamWriter:
    """Stream of :func:`stream_active_viewers` to statistic rows of the tapes on air.

    Every micro-batch is stored, so the state behind it is read once, joined with the days of the schedule that its
    ticks can meet, and replaces its own folder ``batch_id=N``: a batch that is run again after a failure leaves
    no duplicates.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        # Spark runs the session of a batch without adaptive execution; all but storing it is done in that of the tables.
        spark, held = schedule.sparkSession, f"{path}-ticks/batch_id={batch_id}"
        batch.withColumn("as_of", wall_clock("as_of")).write.mode("overwrite").parquet(held)
        ticks = spark.read.parquet(held)
        stats = airing_stats(ticks, codes, schedule)
        if stats is not None:
            stats.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        remove_folder(spark, held)

    return viewers.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(store)


def airing_stats(counts: DataFrame, codes: DataFrame, schedule: DataFrame) -> DataFrame | None:
    """Statistic rows of the stored ticks ``counts``; of both tables only the ticks' days and the days before
    are read.  None without ticks."""
    first, last = counts.agg(F.min("as_of"), F.max("as_of")).first()
    if first is None:
        return None
    days = F.col("bd_date").between(F.lit(first.date() - timedelta(days=1)), F.lit(last.date()))
    return airing_viewers_at(airing_start(counts, schedule.where(days)), codes.where(days), counts)


SUM_KEY, SUM_PARTITION = ("goods_code", "media_code", "minute"), ("order_day", "order_hour")
REVENUE_KEY = ("init_date", "data_type")


def stream_order_sums(orders: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Order amount per (goods, media, order minute), from a stream with the event time ``order_at``.

    Sums come before any join: goods that a third of all orders ask for are one state row a minute.
    """
    return (
        orders.withWatermark("order_at", delay)
        .where(F.col("order_amt") > 0)
        .groupBy(F.window("order_at", "1 minute").alias("span"), "goods_code", "media_code")
        .agg(F.sum("order_amt").cast("decimal(18,2)").alias("price"))
        .select("goods_code", "media_code", wall_clock("span.start").alias("minute"), "price")
    )


def write_revenue(
    sums: DataFrame,
    programmes: DataFrame,
    store: str,
    checkpoint: str,
    air_back: timedelta = timedelta(minutes=120),
    air_ahead: timedelta = timedelta(minutes=10),
    compact_every: int = 32,
    keep: timedelta = timedelta(days=1),
) -> DataStreamWriter:
    """Stream of :func:`stream_order_sums` to the tables ``store/sums`` and ``store/stats``.

    A micro-batch brings the new totals of the minutes it changed.  They replace those stored by hour, and the
    revenue statistics of just these minutes are computed again, from the programmes of their days.  A polling job
    takes the programmes around its run time; here the order minute stands in for it.  Both tables appear
    together, and a batch that is run again replaces what it wrote.  Many small writes are joined every
    ``compact_every`` batches; versions older than ``keep`` go.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # Spark runs the session of a batch without adaptive execution, where writes are not rebalanced by partition and
        # every task adds a file to every folder: all but storing the batch is done in the session of the programmes.
        spark, held = programmes.sparkSession, f"{store}-changed/batch_id={batch_id}"
        counted = f"{store}-counted/batch_id={batch_id}"
        create_store(spark, store)
        batch.withColumns(
            {"order_day": F.col("minute").cast("date"), "order_hour": F.hour("minute")}
        ).write.mode("overwrite").parquet(held)
        changed = spark.read.schema(ORDER_SUMS).parquet(held)
        with Change(spark, store) as change:
            stats = revenue_of(changed, change.read("sums", ORDER_SUMS), programmes, air_back, air_ahead)
            if stats is not None:
                upsert_table(
                    spark, f"{store}/sums", ORDER_SUMS, changed, SUM_KEY, SUM_PARTITION, key_in_partition=True, change=change
                )
                # Stored, since its keys are read before its rows.
                stats.withColumn("init_day", F.col("init_date").cast("date")).write.mode("overwrite").parquet(counted)
                stats = spark.read.schema(LIVE_STAT_TABLE).parquet(counted)
                upsert_table(
                    spark, f"{store}/stats", LIVE_STAT_TABLE, stats, REVENUE_KEY, STAT_PARTITION, key_in_partition=True, change=change
                )
        remove_folder(spark, held)
        remove_folder(spark, counted)
        if batch_id % compact_every == compact_every - 1:
            compact_table(spark, f"{store}/sums", ORDER_SUMS)
            compact_table(spark, f"{store}/stats", LIVE_STAT_TABLE)
            expire(spark, f"{store}/sums", datetime.now(timezone.utc) - keep)

    return sums.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)


def revenue_of(
    changed: DataFrame, stored: DataFrame, programmes: DataFrame, air_back: timedelta, air_ahead: timedelta
) -> DataFrame | None:
    """Revenue statistics of the minutes in ``changed``, from its totals and the ``stored`` ones of these minutes.

    The hours and days involved are literals, so both tables are read in part.  Minutes and airings meet by cells as
    long as the range of a minute, which reaches into two of them; an airing lies in one.  None without changes.
    """
    first, last = changed.agg(F.min("minute"), F.max("minute")).first()
    if first is None:
        return None
    hours = [r[0] for r in changed.select("order_hour").distinct().collect()]
    days = F.col("order_day").between(F.lit(first.date()), F.lit(last.date()))
    others = (
        stored.where(days & F.col("order_hour").isin(hours))
        .join(stored_side(changed.select("minute").distinct(), "changed-minutes"), "minute", "left_semi")
        .join(stored_side(changed.select(*SUM_KEY).distinct(), "changed-sums"), list(SUM_KEY), "left_anti")
    )
    sums = others.select(*SUM_KEY, "price").unionByName(changed.select(*SUM_KEY, "price"))
    airings = programmes.where(F.col("bd_btime").between(ntz(first - air_back), ntz(last + air_ahead)))
    if "bd_date" in programmes.columns:
        # A broadcasting day may reach into the next.
        low, high = (first - air_back).date() - timedelta(days=1), (last + air_ahead).date() + timedelta(days=1)
        airings = airings.where(F.col("bd_date").between(F.lit(low), F.lit(high)))
    airings = airings.select("bd_btime", "tape_code", "goods_code", "media_code").distinct()
    airings = airings.withColumn("cell", _cell("bd_btime", air_back + air_ahead))
    low, high = F.col("minute") - F.lit(air_back), F.col("minute") + F.lit(air_ahead)
    cells = F.sequence(_cell(low, air_back + air_ahead), _cell(high, air_back + air_ahead))
    revenue = (
        sums.withColumn("cell", F.explode(cells))
        .join(stored_side(airings, "changed-airings"), ["goods_code", "media_code", "cell"])
        .where(F.col("bd_btime").between(low, high))
        .groupBy("bd_btime", "tape_code", minute_text("minute").alias("order_mi"))
        .agg(F.sum("price").alias("price"))
    )
    return revenue_stats(revenue)


def _cell(at: Column | str, length: timedelta) -> Column:
    """The number of the cell of ``length``, a minute at least, that a wall clock lies in."""
    return F.floor(epoch_minutes(at) / F.lit(max(1, length // timedelta(minutes=1)))).cast("bigint")
