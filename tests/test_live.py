from collections import defaultdict
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from slotwise.functions.timeops import event_time, instant, ntz, wall_clock
from slotwise.operators import live

LOG = "log_time timestamp_ntz, pn string, uid string, status string, st timestamp_ntz"
AS_OF = datetime(2024, 12, 15, 12, 0)
MINUTE = timedelta(minutes=1)


def ev(minutes_ago, uid, status="ping", pn="TV01", st=None):
    when = AS_OF - minutes_ago * MINUTE
    return (when, pn, uid, status, st or when)


CASES = [
    ("connected", [ev(30, "u", "connect")], True, True),
    ("only pings", [ev(30, "u")], True, True),
    ("left", [ev(30, "u", "connect"), ev(20, "u", "disconnect")], False, False),
    ("came back", [ev(30, "u", "disconnect"), ev(20, "u", "connect")], True, True),
    ("left without connecting", [ev(20, "u", "disconnect")], False, False),
    ("same moment", [ev(20, "u", "connect"), ev(20, "u", "disconnect")], False, False),
    ("at the tick", [ev(0, "u", "connect")], False, False),
    ("at the far edge", [ev(60, "u", "connect")], True, True),
    ("beyond the far edge", [ev(61, "u", "connect")], False, False),
    ("old disconnect, fresh ping", [ev(61, "u", "disconnect"), ev(1, "u")], True, False),
    ("old connect, fresh ping", [ev(90, "u", "connect"), ev(1, "u")], True, True),
    ("status time decides, not log time", [ev(5, "u", "connect", st=AS_OF - 50 * MINUTE), ev(40, "u", "disconnect")], False, False),
]


@pytest.mark.parametrize("name, log, windowed, history", CASES, ids=[c[0] for c in CASES])
def test_who_is_connected(frame, name, log, windowed, history):
    df = frame(log, LOG)
    seen = lambda d: bool(rows(d.where("unique_viewers > 0")))
    assert seen(live.active_viewers(df, AS_OF)) is windowed
    assert seen(live.active_viewers(df, AS_OF, lookback=None)) is history


def test_users_count_once_per_media(frame):
    log = [ev(9, "a"), ev(8, "a"), ev(8, "b"), ev(7, "a", pn="TV02"), ev(7, None, pn="TV03"), ev(6, None)]
    got = live.active_viewers(frame(log, LOG), AS_OF)
    assert rows(got, "media_code", "unique_viewers") == [("TV01", 2), ("TV02", 1), ("TV03", 0)]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_instants_are_compared_on_the_business_clock(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        log = spark.range(1).select(
            instant(AS_OF - MINUTE).alias("log_time"), F.lit("TV01").alias("pn"), F.lit("u").alias("uid"),
            F.lit("ping").alias("status"), instant(AS_OF - MINUTE).alias("st"),
        )
        assert rows(live.active_viewers(log, AS_OF)) == [("TV01", 1)]
        assert rows(live.active_viewers(log, AS_OF, tz="UTC")) == []
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_stored_folds_give_the_history_form(frame):
    log = [e for _, events, *_ in CASES for e in events]
    log = [(t, pn, f"{uid}{i}", status, s) for i, (t, pn, uid, status, s) in enumerate(log * 2)]
    half = len(log) // 2
    whole = live.active_viewers(frame(log, LOG), AS_OF, lookback=None)
    folds = live.latest_events(frame(log[:half], LOG)).unionByName(live.latest_events(frame(log[half:], LOG)))
    before = folds.where(F.col("last_activity") < ntz(AS_OF))
    assert rows(live.active_from_latest(live.merge_latest(before), AS_OF)) == rows(whole)


# ---- programmes on air -----------------------------------------------------------

CODES = "bd_date date, bd_btime timestamp_ntz, media_code string, tape_code string"


def code(start, media, tape, day="2024-12-15"):
    return (date.fromisoformat(day), datetime.fromisoformat(f"{day} {start}"), media, tape)


SCHEDULE = [
    code("23:31:00", "TV00", "0000026036", "2024-12-14"),
    code("00:31:00", "TV00", "0000026036"),
    code("11:31:00", "TV00", "0000026063"),
    code("11:31:00", "TV01", "0000026063"),
    code("11:31:00", "TV50", "0000026290"),
    code("11:31:00", "TV02", None),
    code("12:01:00", "TV00", "0000026076"),
]
VIEWERS = [("TV00", 1419), ("TV01", 384), ("TV02", 5)]


def airing(frame, as_of, viewers=VIEWERS, codes=SCHEDULE):
    got = live.airing_viewers(
        frame(codes, CODES), frame(SCHEDULE, CODES), frame(viewers, "media_code string, unique_viewers bigint"), as_of
    )
    return rows(got, *live.STAT)


def test_viewers_add_up_per_tape_on_air(frame):
    start = datetime(2024, 12, 15, 11, 31)
    assert airing(frame, AS_OF) == [
        (AS_OF, "0000026063", "DA001", Decimal(1803), start),
        (AS_OF, "0000026290", "DA001", Decimal(0), start),
    ]


def test_start_is_compared_by_minute(frame):
    late = datetime(2024, 12, 15, 12, 1, 20)
    assert [r[1] for r in airing(frame, late)] == ["0000026076"]


def test_night_looks_at_yesterday_and_no_further(frame):
    night = datetime(2024, 12, 15, 0, 10)
    assert [r[4] for r in airing(frame, night)] == [datetime(2024, 12, 14, 23, 31)]
    assert airing(frame, datetime(2024, 12, 17, 0, 10)) == []


def test_nothing_started_yet_gives_nothing(frame):
    assert airing(frame, datetime(2024, 12, 14, 12, 0)) == []


def test_repeated_codes_count_again_and_missing_media_match(frame):
    codes = [code("11:31:00", "TV00", "A"), code("11:31:00", "TV00", "A"), code("11:31:00", None, "B")]
    got = airing(frame, AS_OF, VIEWERS + [(None, 7)], codes)
    assert [(r[1], int(r[3])) for r in got] == [("A", 2838), ("B", 7)]


# ---- revenue ---------------------------------------------------------------------

ORDERS = "goods_code string, media_code string, order_date timestamp_ntz, order_amt decimal(18,2)"
PROGRAMMES = "bd_btime timestamp_ntz, tape_code string, goods_code string, media_code string, bd_etime timestamp_ntz"


def order(minutes_ago, amount, goods="G", media="TV00", seconds=0):
    return (goods, media, AS_OF - minutes_ago * MINUTE + timedelta(seconds=seconds), Decimal(amount))


def slot(minutes_ago, tape, goods="G", media="TV00", end=None):
    return (AS_OF - minutes_ago * MINUTE, tape, goods, media, end)


def revenue(frame, orders, programmes, now=AS_OF):
    got = live.airing_revenue(frame(orders, ORDERS), frame(programmes, PROGRAMMES), now)
    return rows(got, "tape_code", "order_mi", "price")


def test_bounds_are_whole_minutes_and_closed(frame):
    orders = [order(30, "1.00"), order(0, "2.00"), order(31, "4.00", seconds=59), order(0, "8.00", seconds=1)]
    got = revenue(frame, orders, [slot(0, "A")], AS_OF + timedelta(seconds=40))
    assert got == [("A", "2024-12-15 11:30", Decimal("1.00")), ("A", "2024-12-15 12:00", Decimal("2.00"))]
    slots = [slot(121, "out"), slot(120, "in"), slot(-10, "ahead"), slot(-11, "far")]
    assert [r[0] for r in revenue(frame, orders[:1], slots)] == ["ahead", "in"]


def test_only_positive_amounts(frame):
    assert revenue(frame, [order(5, "0"), order(5, "-3.00")], [slot(0, "A")]) == []


def test_order_counts_for_every_airing_of_its_goods(frame):
    got = revenue(frame, [order(5, "3.10"), order(5, "0.20")], [slot(100, "A"), slot(0, "A"), slot(60, "B"), slot(0, "C", "H")])
    assert [(r[0], r[2]) for r in got] == [("A", Decimal("3.30")), ("A", Decimal("3.30")), ("B", Decimal("3.30"))]


def test_programmes_are_deduplicated_first(frame):
    twice = [slot(0, "A"), slot(0, "A", end=AS_OF)]
    assert [r[2] for r in revenue(frame, [order(5, "3.00")], twice)] == [Decimal("3.00")]


def test_goods_of_one_tape_add_up(frame):
    got = revenue(frame, [order(5, "1.00"), order(5, "2.00", "H")], [slot(0, "A"), slot(0, "A", "H")])
    assert [r[2] for r in got] == [Decimal("3.00")]


def test_stats_skip_zero_totals(frame):
    df = frame(
        [(AS_OF, "A", "2024-12-15 11:55", Decimal("1.00")), (AS_OF, "B", "2024-12-15 11:55", Decimal(0))],
        "bd_btime timestamp_ntz, tape_code string, order_mi string, price decimal(18,2)",
    )
    assert rows(live.revenue_stats(df), *live.STAT) == [
        (datetime(2024, 12, 15, 11, 55), "A", "DA002", Decimal("1.00"), AS_OF)
    ]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.integers(0, 90), st.sampled_from("abc"), st.sampled_from(["connect", "disconnect", "ping"])), max_size=40)
)
def test_viewers_agree_with_brute_force(frame, events):
    log = [ev(m, uid, status) for m, uid, status in events]
    by_user = defaultdict(list)
    for when, _, uid, status, _ in log:
        if AS_OF - 60 * MINUTE <= when < AS_OF:
            by_user[uid].append((when, status))
    connected = 0
    for seen in by_user.values():
        came = max((w for w, s in seen if s == "connect"), default=None)
        left = max((w for w, s in seen if s == "disconnect"), default=None)
        connected += left is None or (came is not None and came > left)
    got = rows(live.active_viewers(frame(log, LOG), AS_OF), "unique_viewers")
    assert sum(r[0] for r in got) == connected


def test_event_time_round_trip(frame):
    moment = datetime(2024, 3, 10, 2, 30, 0, 123456)
    df = frame([(moment,)], "t timestamp_ntz")
    assert df.select(wall_clock(event_time("t"))).first()[0] == moment
