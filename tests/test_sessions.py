from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from slotwise.operators import sessions
from slotwise.operators.dims import second_dim

LOG = "log_dt date, pn string, sid string, start_time timestamp_ntz, end_time timestamp_ntz, ec_type string"
SCHEDULE = "bd_date date, bd_btime timestamp_ntz, media_code string, tape_code string, goods_code string"
DAY = date(2024, 1, 15)
HOUR = timedelta(hours=1)


def at(text, day=DAY):
    return datetime.fromisoformat(f"{day} {text}")


def event(sid, start, end=None, kind="page", pn="TV01", day=DAY):
    return (day, pn, sid, at(start, day), at(end, day) if end else None, kind)


def programme(start, tape="T1", media="TV01", day=DAY, goods="G1"):
    return (day, at(start, day), media, tape, goods)


@pytest.fixture
def seconds(spark):
    return second_dim(spark, date(2024, 1, 14), date(2024, 1, 17), datetime(2024, 1, 1))


@pytest.fixture(params=[None, 0], ids=["broadcast", "shuffled"])
def limit(request):
    """Both sides of every size check."""
    return request.param


def view_times(frame, seconds, limit, log, schedule, days=None):
    df = sessions.view_time_histogram(frame(log, LOG), frame(schedule, SCHEDULE), seconds, days, limit)
    return rows(df, "bd_btime", "tape_code", "base_mi", "view_time_cd", "view_cnt")


def test_fold_takes_last_start_when_no_end(frame):
    log = [event("s", "10:00:00"), event("s", "10:05:00"), event("t", "10:00:00", "10:00:30"), event("t", "10:09:00")]
    folded = rows(sessions.fold_sessions(frame(log, LOG)), "sid", "enter_time", "exit_time", "order_time")
    assert folded == [
        ("s", at("10:00:00"), at("10:05:00"), None),
        ("t", at("10:00:00"), at("10:00:30"), None),
    ]


def test_entry_before_the_programme_is_minute_zero(frame, seconds, limit):
    got = view_times(frame, seconds, limit, [event("s", "09:50:00", "10:00:00")], [programme("10:00:00")])
    assert got == [(at("10:00:00"), "T1", 0, "8.5분이상", 1)]


def test_minutes_count_boundaries_and_can_reach_sixty(frame, seconds, limit):
    log = [event("s", "10:01:00", "10:01:00"), event("t", "11:00:30", "11:00:31")]
    got = view_times(frame, seconds, limit, log, [programme("10:00:59")])
    assert got == [(at("10:00:59"), "T1", 1, "0.1초미만", 1), (at("10:00:59"), "T1", 60, "1.1-10초", 1)]


def test_reach_is_closed_at_the_start_and_open_after_an_hour(frame, seconds, limit):
    log = [
        event("early", "09:00:00", "09:59:59"),
        event("edge", "09:00:00", "10:00:00"),
        event("last", "10:59:59", "11:30:00"),
        event("late", "11:00:00", "11:30:00"),
    ]
    got = view_times(frame, seconds, limit, log, [programme("10:00:00")])
    assert [(mi, n) for _, _, mi, _, n in got] == [(0, 1), (59, 1)]


def test_session_counts_in_every_programme_it_overlaps(frame, seconds, limit):
    log = [event("s", "10:10:00", "12:10:00")]
    schedule = [programme("10:00:00", "A"), programme("11:00:00", "B"), programme("12:00:00", "C"), programme("13:00:00", "D")]
    got = view_times(frame, seconds, limit, log, schedule)
    assert [tape for _, tape, *_ in got] == ["A", "B", "C"]


def test_end_before_start_still_matches_like_the_condition_says(frame, seconds, limit):
    got = view_times(frame, seconds, limit, [event("s", "10:30:00", "10:05:00")], [programme("10:00:00"), programme("10:10:00")])
    assert got == [(at("10:00:00"), "T1", 30, "0.1초미만", 1)]


def test_programmes_are_deduplicated_and_media_is_summed_away(frame, seconds, limit):
    log = [event("s", "10:00:00", "10:00:05"), event("s", "10:00:00", "10:00:05", pn="TV02")]
    schedule = [programme("10:00:00", goods="G1"), programme("10:00:00", goods="G2"), programme("10:00:00", media="TV02")]
    got = view_times(frame, seconds, limit, log, schedule)
    assert got == [(at("10:00:00"), "T1", 0, "1.1-10초", 2)]


def test_other_day_or_media_does_not_match(frame, seconds, limit):
    other = date(2024, 1, 16)
    log = [event("s", "10:00:00", "10:00:05", pn="TV09"), event("t", "10:00:00", "10:00:05", day=other)]
    assert view_times(frame, seconds, limit, log, [programme("10:00:00")]) == []


def test_second_dimension_filters_and_multiplies(frame, seconds, limit):
    log, schedule = [event("s", "10:00:00", "10:00:05")], [programme("10:00:00")]
    twice = seconds.unionByName(seconds)
    assert view_times(frame, twice, limit, log, schedule)[0][-1] == 2
    assert view_times(frame, seconds.where("hh <> '10'"), limit, log, schedule) == []


def test_days_restrict_both_inputs(frame, seconds, limit):
    other = date(2024, 1, 16)
    log = [event("s", "10:00:00", "10:00:05"), event("s", "10:00:00", "10:00:05", day=other)]
    schedule = [programme("10:00:00"), programme("10:00:00", day=other)]
    assert [r[0] for r in view_times(frame, seconds, limit, log, schedule, [other])] == [at("10:00:00", other)]
    assert view_times(frame, seconds, limit, log, schedule, [date(2024, 2, 1)]) == []


def test_orders_need_a_later_second(frame, seconds, limit):
    log = [
        event("none", "10:00:00", "10:30:00"),
        event("at once", "10:00:00", "10:30:00", "begin_checkout"),
        event("later", "10:00:00", "10:30:00"),
        event("later", "10:01:00", None, "checkout_progress"),
        event("later", "10:20:00", None, "begin_checkout"),
    ]
    df = sessions.order_time_histogram(frame(log, LOG), frame([programme("10:00:00")], SCHEDULE), seconds, broadcast_limit=limit)
    assert rows(df, "base_mi", "dif_order_time_cd", "order_cnt") == [(0, "4.1분-2분", 1)]


def test_order_events_are_a_parameter(frame, seconds):
    log = [event("s", "10:00:00", "10:30:00"), event("s", "10:00:05", None, "paid")]
    df = sessions.order_time_histogram(frame(log, LOG), frame([programme("10:00:00")], SCHEDULE), seconds, order_events=["paid"])
    assert rows(df, "dif_order_time_cd", "order_cnt") == [("1.1-10초", 1)]


def test_crowd_entering_together_is_counted_whole(frame, seconds, limit):
    log = [event(f"s{i}", "10:00:00", "10:00:05") for i in range(500)]
    got = view_times(frame, seconds, limit, log, [programme("10:00:00"), programme("09:30:00", "T2")])
    assert [r[-1] for r in got] == [500, 500]


CLOCK = st.integers(0, 30 * 3600)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(st.sampled_from(["TV1", "TV2"]), CLOCK, CLOCK), min_size=1, max_size=25),
    st.lists(st.tuples(st.sampled_from(["TV1", "TV2"]), CLOCK), min_size=1, max_size=12),
    st.sampled_from([None, 0]),
)
def test_viewers_agree_with_brute_force(frame, spans, starts, limit):
    midnight = at("00:00:00")
    log = [
        (DAY, pn, f"s{i}", midnight + timedelta(seconds=enter), midnight + timedelta(seconds=leave), "page")
        for i, (pn, enter, leave) in enumerate(spans)
    ]
    schedule = [(DAY, midnight + timedelta(seconds=s), media, f"T-{media}", "G") for media, s in starts]
    per_programme, per_minute = Counter(), Counter()
    for _, begin, media, tape, _ in set(schedule):
        for _, pn, _, enter, leave, _ in log:
            if pn == media and leave >= begin and enter < begin + HOUR:
                per_programme[DAY, begin, media, tape] += 1
                minute = lambda ts: (ts - datetime(1970, 1, 1)) // timedelta(minutes=1)
                first = max(0, minute(enter) - minute(begin))
                last = min(minute(leave), minute(begin + HOUR - timedelta(seconds=1))) - minute(begin)
                for m in range(first, max(first, last) + 1):
                    per_minute[DAY, begin, media, tape, m] += 1
    inputs = frame(log, LOG), frame(schedule, SCHEDULE)
    got = sessions.programme_viewers(*inputs, broadcast_limit=limit)
    assert {tuple(r)[:-1]: r["viewers"] for r in got.collect()} == dict(per_programme)
    got = sessions.minute_viewers(*inputs, broadcast_limit=limit)
    assert {tuple(r)[:-1]: r["viewers"] for r in got.collect()} == dict(per_minute)


def test_plan_broadcasts_only_what_was_measured(frame, seconds, capsys):
    log = frame([event("s", "10:00:00", "10:00:05")], LOG)
    schedule = frame([programme("10:00:00")], SCHEDULE)
    sessions.view_time_histogram(log, schedule, seconds.limit(10)).explain()
    small = capsys.readouterr().out
    sessions.view_time_histogram(log, schedule, seconds, broadcast_limit=0).explain()
    large = capsys.readouterr().out
    assert small.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in small
    # Beyond the limit only the cells in use, one row per day, are broadcast.
    assert large.count("BroadcastHashJoin") == 1 and large.count("SortMergeJoin") == 2
    assert "CartesianProduct" not in small + large and "BroadcastNestedLoopJoin" not in small + large


def test_one_day_reads_one_partition_and_few_columns(spark, frame, seconds, folder, capsys):
    from slotwise.sources.tables import overwrite_table, read_table

    log_path, schedule_path = folder("log"), folder("schedule")
    wide = frame([event("s", "10:00:00", "10:00:05")], LOG).selectExpr("*", "'x' AS never_read")
    overwrite_table(wide, log_path, "log_dt")
    overwrite_table(frame([programme("10:00:00")], SCHEDULE), schedule_path, "bd_date")
    schedule = read_table(spark, schedule_path, frame([], SCHEDULE).schema)
    got = sessions.view_time_histogram(read_table(spark, log_path, wide.schema), schedule, seconds, [DAY])
    assert rows(got, "view_cnt") == [(1,)]
    got.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(log_dt" in plan
    assert "never_read" not in plan and "goods_code" not in plan and "ec_type" not in plan
    # One shuffle for the fold, one for the counts; programmes and runs are stored as they were measured.
    assert plan.count("ENSURE_REQUIREMENTS") == 2
