"""History folds in growing sets of days, and instants read by the days of any zone."""

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from slotwise.functions import timeops
from slotwise.operators import live
from slotwise.plans import folds
from slotwise.sources import tables
from slotwise.sources.schemas import CONNECTION_FOLDS
from slotwise.sources.versions import manifest

LOG = "log_time timestamp_ntz, pn string, uid string, status string, st timestamp_ntz"
FIRST = date(2024, 2, 20)


def made(days, seed=1):
    chance = random.Random(seed)
    found = []
    for _ in range(days * 25):
        at = datetime(2024, 2, 20) + timedelta(minutes=chance.randrange(days * 1440))
        found.append((at, f"TV{chance.randrange(2)}", f"u{chance.randrange(40)}", chance.choice(["connect", "disconnect", "ping"]), at))
    return found


def test_twenty_days_one_by_one(spark, frame, folder):
    log, table = made(21), folder("sets")
    whole = frame(log, LOG)
    as_of = datetime(2024, 3, 11, 9, 30)
    expected = rows(live.active_viewers(whole, as_of, None, timedelta(days=2)))
    for i in range(20):
        folds.add_days(spark, table, whole, FIRST + timedelta(days=i), FIRST + timedelta(days=i + 1))
    held = manifest(spark, table).tables["table"].writes
    read = sum(len(w) if w is not None else 1 for w in held.values())
    assert read <= 7
    assert rows(folds.active_viewers_from_folds(spark, table, whole, as_of, timedelta(days=2))) == expected
    sets = {(r.level, r.first_day) for r in tables.read_table(spark, table, CONNECTION_FOLDS).select("level", "first_day").distinct().collect()}
    assert sets == folds.blocks(FIRST, FIRST + timedelta(days=20)) and max(level for level, _ in sets) >= 3
    # Rows that come late, or again, merge into their set.
    late = frame([(datetime(2024, 2, 21, 5), "TV1", "late", "connect", datetime(2024, 3, 11, 9)), *log[:10]], LOG)
    folds.add_days(spark, table, late, FIRST, FIRST + timedelta(days=2))
    again = live.active_viewers(whole.unionByName(late), as_of, None, timedelta(days=30))
    assert rows(folds.active_viewers_from_folds(spark, table, whole, as_of, timedelta(days=30))) == rows(again)


def test_a_tick_before_the_newest_set_takes_the_log(spark, frame, folder):
    table, whole = folder("sets"), frame(made(8), LOG)
    folds.add_days(spark, table, whole, FIRST, FIRST + timedelta(days=8))
    for as_of in (datetime(2024, 2, 20, 12), datetime(2024, 2, 24, 12)):
        assert rows(folds.active_viewers_from_folds(spark, table, whole, as_of)) == rows(live.active_viewers(whole, as_of, None))


@pytest.mark.parametrize("zone", ["America/New_York", "UTC", "Asia/Seoul"])
def test_instants_are_read_by_the_days_of_their_zone(spark, frame, folder, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        log = made(25)
        whole = frame(log, LOG)
        instants = whole.withColumns({c: timeops.instant_in(c) for c in ("log_time", "st")})
        instants = instants.withColumn("log_day", timeops.wall_clock_in("log_time", zone).cast("date"))
        table = folder("instants")
        tables.overwrite_table(instants, table, "log_day")
        stored = tables.read_table(spark, table, instants.schema)
        # Around the night in which New York loses an hour, and at midnight in Seoul.
        for as_of in (datetime(2024, 3, 10, 16, 30), datetime(2024, 3, 10), datetime(2024, 2, 25, 9)):
            for back in (timedelta(hours=5), None):
                got = live.active_viewers(stored, as_of, back, day="log_day", day_zone=zone)
                assert rows(got) == rows(live.active_viewers(whole, as_of, back))
                plan = got._jdf.queryExecution().executedPlan().toString()
                assert "PartitionFilters: [isnotnull(log_day" in plan
        days = timeops.days_between(datetime(2024, 3, 10, 2), datetime(2024, 3, 10, 7), day_zone=zone)
        assert [d.day for d in days] == {"America/New_York": [9, 9], "UTC": [9, 9], "Asia/Seoul": [10, 10]}[zone]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
