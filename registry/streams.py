"""Structured Streaming jobs, run over the whole events file until it is used up."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registry.analytics import CONNECTED, LAST_DAY
from registry.common import AS_OF, plain, query
from registry.loads import RATINGS_SQL, ratings
from slotwise import testmap as t
from slotwise.functions.timeops import event_time, wall_clock
from slotwise.operators.live import active_from_minutes
from slotwise.sources import schemas
from slotwise.sources.scratch import new_folder
from slotwise.sources.tables import read_table
from slotwise.sources.writers import export_csv
from slotwise.streaming import arrival, live

EVERY = "10 minutes"

# Every tick of ten minutes that the watermark, a minute behind the last event, has passed: the users heard of in the
# hour before it, without those who left in it and did not come back.
TICKS_SQL = """
    ticks AS (
        SELECT DISTINCT unnest(range(
            time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE, time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 70 MINUTE,
            INTERVAL 10 MINUTE)) AS as_of
        FROM events),
    heard AS (
        SELECT as_of, c.* FROM ticks JOIN connection_log c
          ON c.log_time < as_of AND c.log_time >= as_of - INTERVAL 1 HOUR
        WHERE as_of + INTERVAL 1 MINUTE <= (SELECT max(ts) FROM events)),
    gone AS (
        SELECT as_of, pn, uid FROM heard d WHERE status = 'disconnect' AND NOT EXISTS (
            SELECT 1 FROM heard k
            WHERE k.as_of = d.as_of AND k.pn = d.pn AND k.uid = d.uid AND k.status = 'connect' AND k.st > d.st)),
    viewers AS (
        SELECT as_of, pn AS media_code, count(*) AS unique_viewers
        FROM (SELECT as_of, pn, uid FROM heard EXCEPT SELECT as_of, pn, uid FROM gone) GROUP BY as_of, pn)"""


def _viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = t.connection_log(t.stream(spark, sf_dir)).withColumn("log_time", event_time("log_time"))
    return live.stream_active_viewers(log, every=EVERY)


@query(f"{t.with_sql('connection_log')}, {TICKS_SQL} SELECT * FROM viewers")
def stream_active_viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "viewers")
    run = (
        _viewers(spark, sf_dir)
        .withColumn("as_of", wall_clock("as_of"))
        .writeStream.outputMode("append")
        .option("checkpointLocation", new_folder(spark, "viewers-checkpoint"))
        .trigger(availableNow=True)
        .format("parquet")
        .start(out)
    )
    run.awaitTermination()
    return spark.read.parquet(out)


@query(f"{t.with_sql('connection_log')}, {CONNECTED.format(LAST_DAY)} SELECT * FROM viewers")
def stream_minute_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folds stored by a stream; a tick with a look-back of a day reads those of its minutes."""
    log = t.connection_log(t.stream(spark, sf_dir)).withColumn("log_time", event_time("log_time"))
    out = new_folder(spark, "folds")
    run = (
        live.stream_minute_folds(log)
        .writeStream.outputMode("append")
        .option("checkpointLocation", new_folder(spark, "folds-checkpoint"))
        .trigger(availableNow=True)
        .format("parquet")
        .partitionBy("log_dt")
        .start(out)
    )
    run.awaitTermination()
    return active_from_minutes(spark.read.parquet(out), AS_OF, timedelta(hours=24))


@query(
    f"""{t.with_sql('connection_log', 'programmes', 'frames')}, {TICKS_SQL},
    on_air AS (
        SELECT k.as_of, max(p.bd_btime) AS start
        FROM (SELECT DISTINCT as_of, CAST(as_of AS DATE) AS day FROM viewers) k
        JOIN (SELECT DISTINCT bd_date, bd_btime FROM programmes) p
          ON p.bd_date BETWEEN k.day - 1 AND k.day AND p.bd_btime <= k.as_of
        GROUP BY k.as_of)
    SELECT o.as_of AS init_date, f.tape_code, 'DA001' AS data_type,
           CAST(coalesce(sum(v.unique_viewers), 0) AS DOUBLE) AS data_value, f.bd_btime
    FROM on_air o JOIN frames f
      ON f.bd_btime = o.start AND f.bd_date BETWEEN CAST(o.as_of AS DATE) - 1 AND CAST(o.as_of AS DATE)
    LEFT JOIN viewers v ON v.as_of = o.as_of AND v.media_code = f.media_code
    GROUP BY o.as_of, f.tape_code, f.bd_btime"""
)
def stream_airing_viewers(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, out = t.events(spark, sf_dir), new_folder(spark, "airing")
    run = (
        live.write_airing_viewers(
            _viewers(spark, sf_dir), t.frames(e), t.programmes(e), out, new_folder(spark, "airing-checkpoint")
        )
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return plain(spark.read.schema(schemas.LIVE_STAT).parquet(out).select(*schemas.LIVE_STAT.fieldNames()))


@query(
    f"""{t.with_sql('order_lines', 'programmes')},
    airings AS (SELECT DISTINCT bd_btime, tape_code, goods_code, media_code FROM programmes),
    minutes AS (SELECT *, date_trunc('minute', order_date) AS init_date FROM order_lines WHERE order_amt > 0)
    SELECT m.init_date, a.tape_code, 'DA002' AS data_type, CAST(sum(m.order_amt) AS DOUBLE) AS data_value, a.bd_btime
    FROM minutes m JOIN airings a ON m.goods_code = a.goods_code AND m.media_code = a.media_code
    WHERE a.bd_btime >= m.init_date - INTERVAL 120 MINUTE AND a.bd_btime <= m.init_date + INTERVAL 10 MINUTE
    GROUP BY ALL"""
)
def stream_airing_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t.order_lines(t.stream(spark, sf_dir)).withColumn("order_at", event_time("order_date"))
    programmes = t.programmes(t.events(spark, sf_dir))
    store = new_folder(spark, "revenue")
    run = (
        live.write_revenue(live.stream_order_sums(orders), programmes, store, new_folder(spark, "revenue-checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    return plain(read_table(spark, f"{store}/stats", schemas.LIVE_STAT))


@query(RATINGS_SQL)
def stream_file_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings files in two deliveries; the second run loads only the new files."""
    rows = ratings(t.events(spark, sf_dir))
    landing, table, checkpoint = (new_folder(spark, f"arrival-{n}") for n in ("in", "table", "checkpoint"))
    purchase = F.col("pgm_nm").endswith("purchase")
    for delivery in (rows.where(purchase), rows.where(~purchase)):
        export_csv(delivery, landing, header=False, compress=False, mode="append")
        arriving = arrival.arriving_csv(spark, landing, schemas.RATINGS, file_glob="*.csv")
        arrival.load_arrived(arriving, table, checkpoint).start().awaitTermination()
    return spark.read.schema(schemas.RATINGS).parquet(table)
