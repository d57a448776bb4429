from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from slotwise.operators import extract, upsert
from slotwise.sources import tables

SCHEMA = T.StructType(
    [T.StructField("k", T.StringType()), T.StructField("day", T.DateType()), T.StructField("v", T.LongType())]
)
DDL = "k string, day date, v bigint"
D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


@pytest.fixture(params=[None, 0], ids=["broadcast", "shuffled"])
def limit(request):
    return request.param


def test_missing_keys_match_nothing_and_work_is_not_deduplicated(frame, limit):
    target = frame([("a", D1, 1), ("a", D2, 2), ("b", D1, 3), (None, D1, 4)], DDL)
    work = frame([("a", D3, 10), ("a", D3, 10), (None, D3, 11)], DDL)
    assert rows(upsert.upsert_by_key(target, work, "k", broadcast_limit=limit)) == [
        (None, D1, 4), (None, D3, 11), ("a", D3, 10), ("a", D3, 10), ("b", D1, 3),
    ]


def test_empty_work_changes_nothing(frame, limit):
    target = frame([("a", D1, 1)], DDL)
    assert rows(upsert.upsert_by_key(target, target.limit(0), "k", broadcast_limit=limit)) == [("a", D1, 1)]


def test_insert_filter_does_not_save_old_rows(frame, limit):
    target = frame([("a", D1, 1), ("b", D1, 2), ("c", D1, 3)], DDL)
    work = frame([("a", D2, 99), ("b", D2, 99), ("b", D2, 5), ("c", D2, None)], DDL)
    got = upsert.upsert_by_key(target, work, "k", F.col("v") != 99, limit)
    assert rows(got) == [("b", D2, 5)]


def test_columns_are_matched_by_name(frame):
    target, work = frame([("a", D1, 1)], DDL), frame([(7, "b", D2, "x")], "v bigint, k string, day date, extra string")
    assert rows(upsert.upsert_by_key(target, work, "k")) == [("a", D1, 1), ("b", D2, 7)]


KEY = st.one_of(st.none(), st.sampled_from("abcd"))
ROW = st.tuples(KEY, st.sampled_from([D1, D2, D3]), st.integers(0, 5))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=15), st.lists(ROW, max_size=10), st.sampled_from([None, 0]))
def test_upsert_agrees_with_brute_force(frame, target, work, limit):
    gone = {k for k, *_ in work if k is not None}
    expected = [r for r in target if r[0] not in gone] + work
    got = upsert.upsert_by_key(frame(target, DDL), frame(work, DDL), "k", broadcast_limit=limit)
    assert rows(got) == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])


def test_replace_day_keeps_rows_without_a_day(frame):
    target = frame([("a", D1, 1), ("b", D2, 2), ("c", None, 3)], DDL)
    got = upsert.replace_day(target, frame([("n", D1, 9)], DDL), D1, "day")
    assert rows(got, "k") == [("b",), ("c",), ("n",)]


def test_replace_range_is_half_open(frame):
    ddl = "k string, t timestamp_ntz"
    low, high = datetime(2024, 1, 1), datetime(2024, 1, 2)
    target = frame([("low", low), ("high", high), ("none", None), ("in", datetime(2024, 1, 1, 23, 59, 59))], ddl)
    new = frame([("n1", low), ("n2", high)], ddl)
    assert rows(upsert.replace_range(target, new, "t", low, high), "k") == [("high",), ("n1",), ("none",)]


def test_extract_window_reaches_the_scan(spark, frame, folder, capsys):
    path = folder()
    frame([("a", datetime(2024, 1, d), 1) for d in (1, 2, 3)], "k string, t timestamp_ntz, unused bigint").write.parquet(path)
    got = extract.extract_window(spark.read.parquet(path), ["k", "t"], "t", datetime(2024, 1, 2), datetime(2024, 1, 3))
    assert rows(got, "t") == [(datetime(2024, 1, 2),)]
    got.explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThanOrEqual(t" in plan and "LessThan(t" in plan
    assert "unused" not in plan


# ---- stored tables ---------------------------------------------------------------


@pytest.fixture
def stored(spark, frame, folder):
    """A partitioned table and a function that reads it back."""
    path = folder("table")
    tables.overwrite_table(frame([("a", D1, 1), ("b", D1, 2), ("c", D2, 3), (None, None, 4)], DDL), path, "day")
    return path, lambda: rows(tables.read_table(spark, path, SCHEMA))


def test_keyed_upsert_moves_rows_between_partitions(spark, frame, stored):
    path, read = stored
    work = frame([("c", D3, 30), ("a", D1, 10), ("n", None, 40)], DDL)
    tables.upsert_table(spark, path, SCHEMA, work, "k", "day")
    assert read() == [(None, None, 4), ("a", D1, 10), ("b", D1, 2), ("c", D3, 30), ("n", None, 40)]


def test_upsert_repeated_gives_the_same(spark, frame, stored):
    path, read = stored
    work = frame([("c", D3, 30), ("a", D1, 10)], DDL)
    tables.upsert_table(spark, path, SCHEMA, work, "k", "day")
    once = read()
    tables.upsert_table(spark, path, SCHEMA, work, "k", "day")
    assert read() == once


def test_untouched_partitions_keep_their_files(spark, frame, stored):
    path, _ = stored
    files = lambda: {r[0] for r in tables.read_table(spark, path, SCHEMA).where(F.col("day") == F.lit(D2)).select("_metadata.file_path").collect()}
    before = files()
    tables.upsert_table(spark, path, SCHEMA, frame([("a", D1, 10)], DDL), "k", "day")
    assert files() == before


def test_slice_upsert_empties_slices_whose_rows_are_all_filtered(spark, frame, stored):
    path, read = stored
    work = frame([("x", D1, 99), ("y", D2, 5), ("z", None, 6)], DDL)
    tables.upsert_table(spark, path, SCHEMA, work, "day", "day", F.col("v") != 99)
    assert read() == [(None, None, 4), ("y", D2, 5), ("z", None, 6)]


def test_key_known_to_stay_in_its_partition(spark, frame, stored):
    path, read = stored
    tables.upsert_table(spark, path, SCHEMA, frame([("a", D1, 10)], DDL), ["day", "k"], "day", key_in_partition=True)
    assert read() == [(None, None, 4), ("a", D1, 10), ("b", D1, 2), ("c", D2, 3)]


def test_unpartitioned_upsert(spark, frame, folder):
    path = folder("dim")
    tables.create_table(spark, path, SCHEMA)
    for value in (1, 2):
        tables.upsert_table(spark, path, SCHEMA, frame([("a", D1, value), ("b", D1, value)], DDL), "k")
    assert rows(tables.read_table(spark, path, SCHEMA), "k", "v") == [("a", 2), ("b", 2)]


def test_replace_day_in_table(spark, frame, stored):
    path, read = stored
    tables.replace_day_in_table(frame([("n", D1, 9)], DDL), path, D1, "day")
    assert read() == [(None, None, 4), ("c", D2, 3), ("n", D1, 9)]
    tables.replace_day_in_table(frame([], DDL), path, D1, "day")
    assert read() == [(None, None, 4), ("c", D2, 3)]


def test_replace_range_in_table(spark, frame, stored):
    path, read = stored
    low, high = datetime(2024, 1, 1), datetime(2024, 1, 3)
    tables.replace_range_in_table(spark, path, SCHEMA, frame([("n", D2, 9), ("o", D3, 9)], DDL), "day", low, high, "day")
    assert read() == [(None, None, 4), ("n", D2, 9)]


def test_create_table_truncates(spark, stored):
    path, read = stored
    tables.create_table(spark, path, SCHEMA, "day")
    assert read() == []
