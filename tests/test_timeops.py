from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slotwise.functions import text, timeops
from slotwise.functions.fixed import DURATION_CLASSES

CLOCKS = st.datetimes(datetime(1900, 1, 1), datetime(2100, 1, 1))


@pytest.fixture(params=["UTC", "Asia/Seoul", "America/New_York"])
def any_zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield
    spark.conf.set("spark.sql.session.timeZone", before)


def clock_frame(frame, *values):
    return frame([(v,) for v in values], "ts timestamp_ntz")


@pytest.mark.parametrize(
    "start, end, minutes, seconds",
    [
        ("2024-01-01 10:00:59", "2024-01-01 10:01:00", 1, 1),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:59", 0, 59),
        ("2024-01-01 10:01:00", "2024-01-01 10:00:59", -1, -1),
        ("2024-01-01 10:00:00.900", "2024-01-01 10:00:01.100", 0, 1),
        # Spring forward in New York: wall clocks do not care.
        ("2024-03-10 01:59:30", "2024-03-10 03:00:30", 61, 3660),
    ],
)
def test_differences_count_boundaries(frame, any_zone, start, end, minutes, seconds):
    df = frame([(datetime.fromisoformat(start), datetime.fromisoformat(end))], "a timestamp_ntz, b timestamp_ntz")
    row = df.select(timeops.minutes_between("a", "b"), timeops.seconds_between("a", "b")).first()
    assert tuple(row) == (minutes, seconds)


def test_text_and_truncation_do_not_move_wall_clocks(frame, any_zone):
    gap = datetime(2024, 3, 10, 2, 30, 45, 500000)
    row = clock_frame(frame, gap).select(
        timeops.minute_text("ts"),
        timeops.compact_minute_text("ts"),
        timeops.day_text("ts"),
        timeops.trunc_second("ts"),
        timeops.trunc_minute("ts"),
        timeops.trunc_hour("ts"),
    ).first()
    assert tuple(row) == (
        "2024-03-10 02:30",
        "202403100230",
        "20240310",
        gap.replace(microsecond=0),
        gap.replace(second=0, microsecond=0),
        gap.replace(minute=0, second=0, microsecond=0),
    )


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(CLOCKS, min_size=20, max_size=50))
def test_expressions_agree_with_python(frame, values):
    df = clock_frame(frame, *values).select(
        "ts",
        timeops.epoch_seconds("ts").alias("s"),
        timeops.epoch_minutes("ts").alias("m"),
        timeops.epoch_hours("ts").alias("h"),
        timeops.wall_clock(timeops.event_time("ts")).alias("back"),
        timeops.parse_minute(timeops.minute_text("ts")).alias("spaced"),
        timeops.parse_minute(timeops.compact_minute_text("ts")).alias("compact"),
    )
    for row in df.collect():
        seconds = (row["ts"] - datetime(1970, 1, 1)) // timedelta(seconds=1)
        minute = row["ts"].replace(second=0, microsecond=0)
        assert (row["s"], row["m"], row["h"]) == (seconds, seconds // 60, seconds // 3600)
        assert (row["back"], row["spaced"], row["compact"]) == (row["ts"], minute, minute)


@pytest.mark.parametrize("bad", ["", "2024", "2024-13-01 00:00", "20240101000000", "x"])
def test_parse_minute_of_garbage_is_null(frame, bad):
    assert frame([(bad,)], "t string").select(timeops.parse_minute("t")).first()[0] is None


def test_instant_and_wall_clock_of_a_zone(spark, any_zone):
    noon = datetime(2024, 1, 15, 12, 0)
    row = spark.range(1).select(
        timeops.wall_clock_in(timeops.instant(noon, "Asia/Seoul"), "Asia/Seoul"),
        timeops.wall_clock_in(timeops.instant(noon, "Asia/Seoul"), "UTC"),
        timeops.wall_clock(timeops.instant(noon, "Asia/Seoul")),
    ).first()
    assert tuple(row) == (noon, datetime(2024, 1, 15, 3), datetime(2024, 1, 15, 3))


@pytest.mark.parametrize(
    "seconds, first_character",
    [(-5, "0"), (0, "0"), (1, "1"), (9, "1"), (10, "2"), (29, "2"), (30, "3"), (59, "3"), (60, "4"),
     (119, "4"), (120, "5"), (179, "5"), (180, "6"), (239, "6"), (240, "7"), (299, "7"), (300, "8"),
     (10**9, "8")],
)
def test_duration_classes(frame, seconds, first_character):
    label = frame([(seconds,)], "d bigint").select(timeops.duration_class("d")).first()[0]
    assert label[0] == first_character
    assert label in {name for name, _ in DURATION_CLASSES}


def test_unknown_duration_has_no_class(frame):
    assert frame([(None,)], "d bigint").select(timeops.duration_class("d")).first()[0] is None


def test_bounds_match_the_column_type():
    noon = datetime(2024, 1, 15, 12, 0)
    with pytest.raises(TypeError):
        timeops.bound_for(T.StringType(), noon)
    with pytest.raises(ValueError):
        timeops.ntz(noon.replace(tzinfo=timezone.utc))


def test_run_dates():
    run = datetime(2024, 1, 31, 7, 12, 45)
    assert timeops.trailing_minutes(run) == (datetime(2024, 1, 31, 6, 42), datetime(2024, 1, 31, 7, 12))
    assert timeops.schedule_days(run) == (datetime(2024, 1, 30), datetime(2024, 2, 2))
    assert timeops.since_previous_month(run) == (datetime(2023, 12, 1), datetime(2024, 1, 31))
    assert timeops.previous_day(run) == (datetime(2024, 1, 30), datetime(2024, 1, 31))
    assert timeops.shift_month(run, 1) == datetime(2024, 2, 1)
    assert timeops.shift_month(run, 12) == datetime(2025, 1, 1)
    utc = datetime(2024, 1, 31, 22, 0, tzinfo=timezone.utc)
    assert timeops.local_run_time(utc) == datetime(2024, 2, 1, 7, 0)
    assert timeops.local_run_time(run) == run


@pytest.mark.parametrize(
    "raw, with_parentheses_dropped, with_cut_first",
    [
        ("2023.05.31.00", ("2023-05-31", True), ("2023-05-31", True)),
        ("2023/05/31", ("2023-05-31", True), ("2023-05-31", True)),
        ("(2023.05.31.00)", ("2023-05-31", True), ("(2023-05-3", False)),
        ("2023.02.30", ("2023-02-30", False), ("2023-02-30", False)),
        ("soon", ("soon", False), ("soon", False)),
    ],
)
def test_clean_date(frame, raw, with_parentheses_dropped, with_cut_first):
    df = frame([(raw,)], "t string")
    for drop, expected in ((True, with_parentheses_dropped), (False, with_cut_first)):
        cleaned = text.clean_date(F.col("t"), drop)
        assert tuple(df.select(cleaned, text.is_day(cleaned)).first()) == expected


def test_strip_newlines_only_pairs_and_only_text(frame):
    df = frame([("a\r\nb\nc", Decimal("1.50"), date(2024, 1, 1))], "`20s x` string, n decimal(18,2), d date")
    assert tuple(text.strip_newlines(df).first()) == ("ab\nc", Decimal("1.50"), date(2024, 1, 1))


@pytest.mark.parametrize("low, high, inside", [((14, 23, 45), (15, 0, 15), [15]), ((15, 11, 30), (15, 12, 0), []), ((14, 0, 0), (16, 0, 0), [14, 15])])
def test_a_day_is_its_midnight_to_bounds_within_days(frame, low, high, inside):
    low, high = (datetime(2024, 1, d, h, m) for d, h, m in (low, high))
    days = frame([(date(2024, 1, d),) for d in range(13, 18)], "day date")
    kind = days.schema["day"].dataType
    got = days.where((days.day >= timeops.bound_for(kind, low)) & (days.day < timeops.bound_for(kind, high)))
    assert [r.day.day for r in got.orderBy("day").collect()] == inside
    as_sql = days.where((days.day.cast("timestamp_ntz") >= timeops.ntz(low)) & (days.day.cast("timestamp_ntz") < timeops.ntz(high)))
    assert as_sql.count() == len(inside)
