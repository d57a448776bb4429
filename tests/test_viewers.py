"""Viewers kept up to date by windows of the log equal those of the whole log."""

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from slotwise.operators import sessions
from slotwise.plans import viewers
from slotwise.sources.versions import Change

LOG = "log_dt date, pn string, sid string, start_time timestamp_ntz, end_time timestamp_ntz, ec_type string"
SCHEDULE = "bd_date date, bd_btime timestamp_ntz, media_code string, tape_code string"
DAYS = [date(2024, 1, 15), date(2024, 1, 16)]


def at(day, minutes):
    return datetime(day.year, day.month, day.day) + timedelta(minutes=minutes)


def made(seed):
    chance = random.Random(seed)
    log = []
    for i in range(60):
        day, media = chance.choice(DAYS), chance.choice(["TV1", "TV2"])
        begin = chance.randrange(600)
        for _ in range(chance.randrange(1, 4)):
            start = at(day, begin + chance.randrange(90))
            end = None if chance.random() < 0.5 else start + timedelta(minutes=chance.randrange(-30, 120))
            log.append((day, media, f"s{i % 40}", start, end, "page"))
    schedule = [(d, at(d, m), media, f"T{m}") for d in DAYS for m in range(0, 600, 45) for media in ("TV1", "TV2")]
    return log, schedule


WINDOWS = [(0, 300), (200, 500), (100, 250), (400, 24 * 60 + 100), (24 * 60, 48 * 60), (450, 500)]


@pytest.mark.parametrize("seed", range(3))
def test_overlapping_windows_equal_a_full_run(spark, frame, folder, seed):
    log, schedule = made(seed)
    whole, shown = frame(log, LOG), frame(schedule, SCHEDULE)
    store = folder("viewers")
    for low, high in WINDOWS:
        viewers.run_programme_viewers(spark, store, whole, shown, at(DAYS[0], low), at(DAYS[0], high))
        seen = [r for r in log if any(at(DAYS[0], a) <= r[3] < at(DAYS[0], b) for a, b in WINDOWS[: WINDOWS.index((low, high)) + 1])]
        assert rows(viewers.programme_viewers_table(spark, store)) == rows(sessions.programme_viewers(frame(seen, LOG), shown))


def test_minutes_equal_a_full_run_and_only_reached_programmes_are_counted(spark, frame, folder):
    log, schedule = made(7)
    whole, shown = frame(log, LOG), frame(schedule, SCHEDULE)
    store, first, last = folder("viewers"), at(DAYS[0], 0), at(DAYS[1], 24 * 60)
    early = frame([r for i, r in enumerate(log) if i % 10], LOG)
    viewers.run_minute_viewers(spark, store, early, shown, first, last)
    late = [(DAYS[0], "TV1", "late", at(DAYS[0], 100), None, "page")]
    again = viewers.run_minute_viewers(spark, store, frame(late, LOG), shown, first, last)
    # The programmes of that media that began at minutes 45 and 90.
    assert again == 2
    viewers.run_minute_viewers(spark, store, whole, shown, first, last)
    assert rows(viewers.minute_viewers_table(spark, store)) == rows(sessions.minute_viewers(frame(log + late, LOG), shown))
    assert viewers.run_minute_viewers(spark, store, whole.limit(0), shown, first, last) == 0


def test_a_programme_that_loses_its_viewer_goes(spark, frame, folder):
    shown = frame([(DAYS[0], at(DAYS[0], 100), "TV1", "A")], SCHEDULE)
    store, window = folder("viewers"), (at(DAYS[0], 0), at(DAYS[0], 600))
    log = [(DAYS[0], "TV1", "s", at(DAYS[0], 50), None, "page"), (DAYS[0], "TV1", "s", at(DAYS[0], 110), None, "page")]
    viewers.run_programme_viewers(spark, store, frame(log, LOG), shown, *window)
    assert viewers.programme_viewers_table(spark, store).count() == 1
    # The end comes late, and lies before the programme.
    viewers.run_programme_viewers(spark, store, frame([(DAYS[0], "TV1", "s", at(DAYS[0], 50), at(DAYS[0], 60), "page")], LOG), shown, *window)
    assert viewers.programme_viewers_table(spark, store).count() == 0


def test_a_failed_run_leaves_marks_and_viewers_as_they_were(spark, frame, folder, monkeypatch):
    log, schedule = made(1)
    shown, store, window = frame(schedule, SCHEDULE), folder("viewers"), (at(DAYS[0], 0), at(DAYS[1], 24 * 60))
    viewers.run_programme_viewers(spark, store, frame(log[:20], LOG), shown, *window)
    before, add = rows(viewers.programme_viewers_table(spark, store)), Change.add
    with monkeypatch.context() as patch:
        patch.setattr(Change, "add", lambda self, name, *a: add(self, name, *a) if name != "marks" else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            viewers.run_programme_viewers(spark, store, frame(log, LOG), shown, *window)
    assert rows(viewers.programme_viewers_table(spark, store)) == before
    viewers.run_programme_viewers(spark, store, frame(log, LOG), shown, *window)
    assert rows(viewers.programme_viewers_table(spark, store)) == rows(sessions.programme_viewers(frame(log, LOG), shown))
