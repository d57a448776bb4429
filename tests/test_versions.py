"""Versions of stored tables: what appears together, what a failed job leaves, what is removed."""

from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from slotwise.operators import sizing
from slotwise.plans import analytics, warehouse
from slotwise.plans.warehouse import LoadSpec
from slotwise.sources import schemas, tables, versions
from slotwise.sources.versions import Change

DDL = "k string, day date, v int"
SCHEMA = StructType([StructField("k", StringType()), StructField("day", DateType()), StructField("v", IntegerType())])
D1, D2, D3 = (date(2024, 1, d) for d in (1, 2, 3))
SPEC = LoadSpec(SCHEMA, key="k", partition="day")


@pytest.fixture
def store(spark, frame, folder):
    """A store of two tables, and what they hold."""
    root = folder("store")
    versions.create_store(spark, root)
    paths = [f"{root}/a", f"{root}/b"]
    for path in paths:
        tables.overwrite_table(frame([("x", D1, 1), ("y", D2, 2)], DDL), path, "day")
    return root, paths, lambda: [rows(tables.read_table(spark, p, SCHEMA)) for p in paths]


def staged(frame, folder, *given):
    path = folder("stage")
    tables.overwrite_table(frame(list(given), DDL), path)
    return path


def test_two_targets_appear_together(spark, frame, folder, store):
    root, paths, read = store
    before = versions.manifest(spark, root).version
    warehouse.apply_stage(spark, SPEC, staged(frame, folder, ("x", D3, 9)), paths)
    assert read() == [[("x", D3, 9), ("y", D2, 2)]] * 2
    assert versions.manifest(spark, root).version == before + 1


def test_a_job_killed_between_two_targets_leaves_the_old_state(spark, frame, folder, store, monkeypatch):
    root, paths, read = store
    old, add = read(), Change.add

    def dies(self, name, *args):
        if name == "b":
            raise KeyboardInterrupt
        return add(self, name, *args)

    stage = staged(frame, folder, ("x", D3, 9), ("y", D1, 8))
    with monkeypatch.context() as patch:
        patch.setattr(Change, "add", dies)
        with pytest.raises(KeyboardInterrupt):
            warehouse.apply_stage(spark, SPEC, stage, paths)
    assert read() == old
    warehouse.apply_stage(spark, SPEC, stage, paths)
    assert read() == [[("x", D3, 9), ("y", D1, 8)]] * 2


def test_a_write_that_fails_half_way_leaves_the_old_state(spark, frame, folder, store):
    root, (path, _), read = store
    old = read()
    broken = frame([("x", D3, 9), ("z", D1, 8)], DDL).withColumn(
        "v", F.when(F.col("k") == "z", F.raise_error(F.lit("dead")).cast("int")).otherwise(F.col("v"))
    )
    with pytest.raises(Exception, match="dead"):
        tables.append_table(broken, path, "day")
    assert read() == old


def test_the_later_of_two_jobs_fails(spark, frame, store):
    root, (path, _), read = store
    first, second = Change(spark, root), Change(spark, root)
    first.add("a", frame([("f", D1, 1)], DDL), ["day"])
    second.add("a", frame([("s", D1, 1)], DDL), ["day"])
    first.publish()
    with pytest.raises(versions.ConcurrentChange):
        second.publish()
    assert ("f", D1, 1) in read()[0] and ("s", D1, 1) not in read()[0]


def test_a_version_is_readable_until_it_expires(spark, frame, folder, store):
    root, (path, _), read = store
    held = versions.manifest(spark, root).version
    tables.upsert_table(spark, path, SCHEMA, frame([("x", D1, 5)], DDL), "k", "day")
    assert rows(versions.read_version(spark, path, SCHEMA, held)) == [("x", D1, 1), ("y", D2, 2)]
    now = datetime.now(timezone.utc)
    assert versions.expire(spark, path, now - timedelta(hours=1)) == (0, 0)
    # Of the first write of table a, a folder is still in use; another job's unpublished write goes once it is old.
    Change(spark, root).add("a", frame([("u", D1, 1)], DDL), ["day"])
    removed = versions.expire(spark, path, now + timedelta(hours=1))
    assert removed == (held, 1) and versions.manifest(spark, root).version == held + 1
    assert read() == [[("x", D1, 5), ("y", D2, 2)], [("x", D1, 1), ("y", D2, 2)]]
    tables.overwrite_table(frame([("n", D1, 1)], DDL), path, "day")
    assert versions.expire(spark, path, now + timedelta(hours=1)) == (1, 2)
    assert read()[0] == [("n", D1, 1)]


def test_nothing_is_left_beside_the_table(spark, frame, store):
    root, (path, _), _ = store
    tables.upsert_table(spark, path, SCHEMA, frame([("x", D1, 5)], DDL), "k", "day")
    around = [p.name for p in Path(root).parent.iterdir()]
    assert not [n for n in around if n.startswith("rewrite")]
    assert sorted(p.name for p in Path(root).iterdir()) == ["_versions", "rows"]
    assert not [p.name for p in (Path(root) / "_versions").iterdir() if "-" in p.name[:2] and not p.name.startswith(("v-", ".v-"))]


@pytest.mark.parametrize("odd", ["a:b", "a/b", "x=1", "50%", "ü ñ", "{a,b}", "[1]", "*", None, ""])
def test_several_partition_columns_of_any_name(spark, frame, folder, odd):
    path, schema = folder("odd"), StructType.fromDDL("k string, v int, p string, q int")
    tables.overwrite_table(frame([("k1", 1, odd, 1), ("k2", 2, "plain", 1), ("k3", 3, odd, 2)], schema), path, ["p", "q"])
    tables.upsert_table(spark, path, schema, frame([("k1", 9, "plain", 2)], schema), "k", ["p", "q"])
    same = None if odd == "" else odd
    read = lambda: rows(tables.read_table(spark, path, schema), "k", "v", "p", "q")
    assert read() == [("k1", 9, "plain", 2), ("k2", 2, "plain", 1), ("k3", 3, same, 2)]
    tables.upsert_table(spark, path, schema, frame([("k3", 7, odd, 2), ("k2", 8, "plain", 1)], schema), "k", ["p", "q"], key_in_partition=True)
    assert read() == [("k1", 9, "plain", 2), ("k2", 8, "plain", 1), ("k3", 7, same, 2)]


def test_compaction_joins_many_writes(spark, frame, folder):
    path = folder("many")
    for i in range(5):
        tables.append_table(frame([(str(i), D1, i), *([("o", D2, 0)] if i == 0 else [])], DDL), path, "day")
    old = rows(tables.read_table(spark, path, SCHEMA))
    tables.compact_table(spark, path, SCHEMA, most=5)
    assert len(versions.manifest(spark, path).tables["table"].writes) == 5
    tables.compact_table(spark, path, SCHEMA, most=4)
    held = versions.manifest(spark, path).tables["table"].writes
    assert len(held) == 2 and ["day=2024-01-02"] in held.values()
    assert rows(tables.read_table(spark, path, SCHEMA)) == old


def test_a_tick_leaves_other_days_alone(spark, frame, folder):
    path = folder("stat")
    tables.create_table(spark, path, schemas.LIVE_STAT_TABLE, analytics.STAT_PARTITION)
    stat = lambda day, minute, value: (datetime(2024, 1, day, 12, minute), "T", "DA002", value, datetime(2024, 1, day, 11))
    ddl = "init_date timestamp_ntz, tape_code string, data_type string, data_value double, bd_btime timestamp_ntz"
    stats = lambda *given: schemas.conform(frame(list(given), ddl), schemas.LIVE_STAT)
    files = lambda: {
        r[0] for r in tables.read_table(spark, path, schemas.LIVE_STAT_TABLE).where("day(init_day) = 1").select("_metadata.file_path").collect()
    }
    analytics.store_stats(stats(stat(1, 0, 1.0), stat(2, 0, 1.0), stat(2, 1, 1.0)), path, "upsert")
    before = files()
    analytics.store_stats(stats(stat(2, 0, 5.0), stat(3, 0, 1.0)), path, "upsert")
    assert files() == before and len(before) == 1
    got = rows(tables.read_table(spark, path, schemas.LIVE_STAT), "init_date", "data_value")
    assert [(r[0].day, r[0].minute, float(r[1])) for r in got] == [(1, 0, 1.0), (2, 0, 5.0), (2, 1, 1.0), (3, 0, 1.0)]


# ---- measured while written ------------------------------------------------------


def test_sizes_are_counted_by_the_write(spark, frame, folder):
    path = folder("sized")
    given = frame([("x", D1, 1), ("yy", D2, 2)], DDL)
    assert tables.overwrite_table(given, path, "day") == 2
    assert versions.table_size(spark, path) == (2, sizing.measured_bytes(given))
    assert tables.append_table(given.limit(0), path, "day") == 0
    assert versions.table_size(spark, path)[0] == 2


def test_the_work_of_an_upsert_is_computed_once_for_its_keys(spark, frame, folder):
    path, reads = folder("counted"), spark.sparkContext.accumulator(0)
    tables.overwrite_table(frame([("x", D1, 1), ("y", D2, 2)], DDL), path, "day")

    def counting(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    work = frame([("x", D3, 5), ("z", D1, 6)], DDL).coalesce(1).mapInArrow(counting, DDL)
    tables.upsert_table(spark, path, SCHEMA, work, "k", "day")
    # Once for the keys, once for the rows.
    assert reads.value == 4
    assert rows(tables.read_table(spark, path, SCHEMA)) == [("x", D3, 5), ("y", D2, 2), ("z", D1, 6)]


def test_nested_values_count(spark):
    flat = spark.sql("select 1 as a")
    nested = spark.sql("select array_repeat(1.5D, 1000) as a, map('k', repeat('x', 500)) as m, struct(repeat('y', 300) as s) as t, cast(1 as decimal(38,0)) as d")
    assert sizing.measured_bytes(flat) == 40
    assert sizing.measured_bytes(nested) > 8 * 1000 + 500 + 300
