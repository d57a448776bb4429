from collections import defaultdict
from datetime import datetime, timedelta
from decimal import Decimal
from pathlib import Path

from conftest import rows
from slotwise.functions.timeops import event_time, wall_clock
from slotwise.operators import live as batch
from slotwise.sources import schemas
from slotwise.sources.readers import read_ratings
from slotwise.sources.tables import read_table
from slotwise.sources.versions import manifest
from slotwise.streaming import arrival, live

START = datetime(2024, 1, 15, 12, 0)
LOG = "log_time timestamp_ntz, pn string, uid string, status string, st timestamp_ntz"
SCHEDULE = "bd_date date, bd_btime timestamp_ntz, media_code string, tape_code string"


def deliver(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def run(writer, out=None):
    started = writer.trigger(availableNow=True)
    (started.start(out) if out else started.start()).awaitTermination()


def viewers_stream(spark, landing, schema, lookback, every):
    log = spark.readStream.schema(schema).parquet(landing).withColumn("log_time", event_time("log_time"))
    return live.stream_active_viewers(log, lookback, every, delay="0 seconds")


def log_rows(count=240):
    kinds = ("connect", "ping", "disconnect", "ping", "connect")
    out = []
    for i in range(count):
        when = START + timedelta(seconds=i * 37)
        out.append((when, f"TV{i % 2}", f"u{i * 7 % 11}", kinds[i * 3 % 5], when))
    return out


def test_stream_equals_batch_on_closed_windows(spark, frame, folder):
    """Three deliveries, each processed by its own restart from the checkpoint."""
    landing, out, checkpoint = folder(), folder(), folder()
    log = log_rows()
    schema = frame(log[:1], LOG).schema
    for i in range(3):
        deliver(frame(log[i * 80:(i + 1) * 80], LOG), landing)
        stream = viewers_stream(spark, landing, schema, "20 minutes", "5 minutes")
        run(stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint), out)
    got = defaultdict(dict)
    for row in spark.read.parquet(out).withColumn("as_of", wall_clock("as_of")).collect():
        assert row["media_code"] not in got[row["as_of"]], "published twice"
        got[row["as_of"]][row["media_code"]] = row["unique_viewers"]
    last = max(r[0] for r in log)
    tick, checked = START + timedelta(minutes=5), 0
    while tick <= last:
        expected = batch.active_viewers(frame(log, LOG), tick, timedelta(minutes=20))
        assert got.get(tick, {}) == {r[0]: r[1] for r in rows(expected)}, tick
        tick, checked = tick + timedelta(minutes=5), checked + 1
    assert checked == 29 and all(t <= last for t in got)


def test_ticks_from_stored_minute_folds(spark, frame, folder):
    landing, out, checkpoint = folder(), folder(), folder()
    log = log_rows()
    schema = frame(log[:1], LOG).schema
    for part in (log[:150], log[150:]):
        deliver(frame(part, LOG), landing)
        rows_ = spark.readStream.schema(schema).parquet(landing).withColumn("log_time", event_time("log_time"))
        folds = live.stream_minute_folds(rows_, delay="0 seconds").writeStream.outputMode("append").format("parquet")
        run(folds.partitionBy("log_dt").option("checkpointLocation", checkpoint), out)
    stored = spark.read.parquet(out)
    for minutes in (1, 17, 60, 140):
        tick = START + timedelta(minutes=minutes)
        expected = batch.active_viewers(frame(log, LOG), tick, timedelta(minutes=20))
        assert rows(batch.active_from_minutes(stored, tick, timedelta(minutes=20))) == rows(expected)


def test_airing_viewers_equal_the_batch_form(spark, frame, folder):
    codes = frame([(START.date(), START - timedelta(minutes=29), "TV0", "A"), (START.date(), START + timedelta(minutes=31), "TV1", "B")], SCHEDULE)
    out = folder()
    landing, checkpoint = folder(), folder()
    log = log_rows(200)
    deliver(frame(log, LOG), landing)
    stream = viewers_stream(spark, landing, frame(log[:1], LOG).schema, "20 minutes", "10 minutes")
    run(live.write_airing_viewers(stream, codes, codes, out, checkpoint))
    stored = spark.read.schema(schemas.LIVE_STAT).parquet(out)
    by_tick = {r["init_date"]: (r["tape_code"], r["bd_btime"]) for r in stored.collect()}
    assert stored.count() == len(by_tick) == 12
    assert by_tick[START + timedelta(minutes=30)] == ("A", START - timedelta(minutes=29))
    assert by_tick[START + timedelta(minutes=40)] == ("B", START + timedelta(minutes=31))
    for row in stored.collect():
        viewers = batch.active_viewers(frame(log, LOG), row["init_date"], timedelta(minutes=20))
        expected = batch.airing_viewers(codes, codes, viewers, row["init_date"])
        assert rows(expected, "tape_code", "data_value") == [(row["tape_code"], row["data_value"])]


ORDERS = "goods_code string, media_code string, order_date timestamp_ntz, order_amt decimal(18,2)"
AIRED = "bd_btime timestamp_ntz, tape_code string, goods_code string, media_code string, bd_date date"


def order(seconds, amount, goods="G"):
    return goods, "TV0", START + timedelta(seconds=seconds), Decimal(amount)


def test_revenue_totals_grow_over_deliveries(spark, frame, folder):
    far, minute = START + timedelta(minutes=11), START + timedelta(minutes=1)
    aired = [(START, "A", "G", "TV0"), (START, "A", "G", "TV0"), (far, "far", "G", "TV0"), (START, "A", "H", "TV0")]
    programmes = frame([(*p, p[0].date()) for p in aired], AIRED)
    landing, store, checkpoint = folder(), folder(), folder()
    schema = frame([], ORDERS).schema
    deliveries = (
        [order(5, "1.00"), order(20, "2.00")],
        [order(50, "4.00"), order(55, "-1.00"), order(70, "8.00")],
        [order(40, "16.00", "H")],
        [order(30, "-5.00")],
    )
    for delivery in deliveries:
        deliver(frame(delivery, ORDERS), landing)
        orders = spark.readStream.schema(schema).parquet(landing).withColumn("order_at", event_time("order_date"))
        run(live.write_revenue(live.stream_order_sums(orders, "5 minutes"), programmes, store, checkpoint, compact_every=2))
    got = rows(read_table(spark, f"{store}/stats", schemas.LIVE_STAT), "init_date", "tape_code", "data_value", "bd_btime")
    assert got == [
        (START, "A", Decimal("23.00"), START),
        (minute, "A", Decimal("8.00"), START),
        (minute, "far", Decimal("8.00"), far),
    ]
    # What a reader opens is bounded by hours and the writes between two compactions.
    held = manifest(spark, store).tables
    assert sum(len(w or [1]) for t in ("sums", "stats") for w in held[t].writes.values()) <= 6


def test_a_long_revenue_batch_writes_a_file_a_folder(spark, frame, folder):
    """Orders of three days in one batch, against brute force over all pairs of minutes and airings."""
    orders = [order(i * 611, "1.50", f"G{i % 3}") for i in range(400)]
    aired = [(START + timedelta(minutes=37 * i), f"T{i}", f"G{i % 3}", "TV0") for i in range(-5, 120)]
    programmes = frame([(*a, a[0].date()) for a in aired], AIRED)
    landing, store = folder(), folder()
    deliver(frame(orders, ORDERS), landing)
    stream = spark.readStream.schema(frame([], ORDERS).schema).parquet(landing).withColumn("order_at", event_time("order_date"))
    run(live.write_revenue(live.stream_order_sums(stream), programmes, store, folder()))
    totals = defaultdict(Decimal)
    for goods, media, at, amount in orders:
        minute = at.replace(second=0)
        for start, tape, of, on in aired:
            if (goods, media) == (of, on) and minute - timedelta(minutes=120) <= start <= minute + timedelta(minutes=10):
                totals[minute, tape, start] += amount
    got = read_table(spark, f"{store}/stats", schemas.LIVE_STAT).select("init_date", "tape_code", "bd_btime", "data_value").collect()
    assert sorted(map(tuple, got)) == sorted((*k, v) for k, v in totals.items())
    for table in ("sums", "stats"):
        files = [p.parent for p in Path(store, "rows", table).rglob("*.parquet")]
        assert len(files) == len(set(files)) > 2


def test_a_repeated_revenue_batch_changes_nothing(spark, frame, folder):
    from slotwise.streaming.live import revenue_of

    programmes = frame([(START, "A", "G", "TV0", START.date())], AIRED)
    store, captured = folder(), []

    class Caught:
        def outputMode(self, _):
            return self

        def option(self, *_):
            return self

        def foreachBatch(self, function):
            captured.append(function)

    class Sums:
        writeStream = Caught()

    live.write_revenue(Sums(), programmes, store, folder())
    sums = frame([("G", "TV0", START, Decimal("7.00"))], "goods_code string, media_code string, minute timestamp_ntz, price decimal(18,2)")
    for batch_id in (0, 0, 1):
        captured[0](sums if batch_id == 0 else sums.limit(0), batch_id)
        assert rows(read_table(spark, f"{store}/stats", schemas.LIVE_STAT), "tape_code", "data_value") == [("A", Decimal("7.00"))]
    assert revenue_of(schemas.conform(sums, schemas.ORDER_SUMS).limit(0), None, programmes, timedelta(0), timedelta(0)) is None


def test_a_hot_goods_is_one_state_row_a_minute(spark, frame, folder):
    landing, schema = folder(), frame([], ORDERS).schema
    deliver(frame([order(i % 60, "1.00") for i in range(500)], ORDERS), landing)
    orders = spark.readStream.schema(schema).parquet(landing).withColumn("order_at", event_time("order_date"))
    query = live.write_revenue(live.stream_order_sums(orders), frame([], AIRED), folder(), folder()).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress][-1] == 1


def test_ticks_are_joined_with_their_days_only(spark, frame, folder):
    stored = folder()
    days = [START + timedelta(days=d) for d in range(-5, 5)]
    frame([(d.date(), d - timedelta(minutes=29), "TV0", "A") for d in days], SCHEDULE).write.partitionBy("bd_date").parquet(stored)
    schedule = spark.read.parquet(stored)
    counts = frame([(START, "TV0", 3)], "as_of timestamp_ntz, media_code string, unique_viewers long")
    stats = live.airing_stats(counts, schedule, schedule)
    assert rows(stats, "tape_code", "data_value") == [("A", Decimal("3.00"))]
    plan = stats._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line and "bd_date" in line]
    assert scans and all("PartitionFilters: [isnotnull(bd_date" in line for line in scans)
    assert live.airing_stats(counts.limit(0), schedule, schedule) is None


def test_the_state_behind_a_batch_is_evaluated_once(spark, frame, folder):
    """What the join reads is the stored micro-batch, not the stream."""
    landing, log = folder(), log_rows(50)
    deliver(frame(log, LOG), landing)
    codes = frame([(START.date(), START - timedelta(minutes=29), "TV0", "A")], SCHEDULE)
    plans, real = [], live.airing_stats
    live.airing_stats = lambda counts, *others: plans.append(counts._jdf.queryExecution().executedPlan().toString()) or real(counts, *others)
    try:
        out = folder()
        run(live.write_airing_viewers(viewers_stream(spark, landing, frame(log[:1], LOG).schema, "20 minutes", "10 minutes"), codes, codes, out, folder()))
    finally:
        live.airing_stats = real
    assert plans and all("StateStore" not in p and "FileScan parquet" in p for p in plans)


def test_files_are_loaded_once_whatever_the_case(spark, folder, tmp_path):
    numbers = ",".join(["1.5,10"] * len(schemas.AUDIENCES))
    table, checkpoint = folder(), folder()

    def load():
        arriving = arrival.arriving_csv(spark, str(tmp_path), schemas.RATINGS)
        arrival.load_arrived(arriving, table, checkpoint).start().awaitTermination()
        return rows(spark.read.schema(schemas.RATINGS).parquet(table), "pgm_nm", "over60s_viewers")

    def land(name, programme):
        (tmp_path / name).write_bytes(f'Home,0007,"{programme}",0900,1000,{numbers}\r\n'.encode())

    land("20241214A.CSV", "one,\r\n two")
    land("20241214B.csv", "another kind")
    assert load() == [("one, two", 10)]
    land("20241215A.csv", "three")
    assert load() == load() == [("one, two", 10), ("three", 10)]
    assert read_ratings(spark, f"{tmp_path}/20241215A.csv", schemas.RATINGS).count() == 1
