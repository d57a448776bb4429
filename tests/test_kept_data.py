"""Nothing is lost or kept by accident: cases that no registered query covers."""

from datetime import date, datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from slotwise.operators.upsert import replace_range
from slotwise.sources import tables
from slotwise.sources.readers import flatten_pages, read_csv, read_pages
from slotwise.sources.writers import export_csv


def test_instants_keep_microseconds(spark, folder):
    path = folder("instants")
    given = spark.sql("select timestamp '2024-01-15 10:00:00.123456' as at, 1 as n")
    export_csv(given, path)
    assert rows(read_csv(spark, path, given.schema)) == rows(given)


def test_a_broken_page_fails_the_read(spark, folder):
    path = folder("pages")
    whole = '{"set": {"list_total_count": 2, "row": [{"A": "1"}, {"A": "2"}]}}'
    spark.createDataFrame([(whole,), (whole[:40],)], "value string").repartition(2).write.text(path)
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        flatten_pages(read_pages(spark, path, ["A"])).collect()


def test_an_error_page_is_skipped(spark, folder):
    path = folder("pages")
    spark.createDataFrame([('{"RESULT": {"CODE": "E1", "MESSAGE": "no"}}',)], "value string").write.text(path)
    assert flatten_pages(read_pages(spark, path, ["A"])).count() == 0


@pytest.mark.parametrize("odd", ["a:b", "a/b", "x=1", "50%", "ü ñ"])
def test_emptied_partitions_with_odd_names_are_empty(spark, folder, odd):
    path, schema = folder("odd"), StructType.fromDDL("k string, v int, p string")
    tables.overwrite_table(spark.createDataFrame([("k1", 1, odd), ("k2", 2, "plain")], schema), path, "p")
    tables.upsert_table(spark, path, schema, spark.createDataFrame([("k1", 3, "plain")], schema), "k", "p")
    assert rows(tables.read_table(spark, path, schema)) == [("k1", 3, "plain"), ("k2", 2, "plain")]


def test_rows_outside_a_range_are_refused(spark):
    schema = "at timestamp_ntz, n int"
    target = spark.createDataFrame([(datetime(2024, 1, 1, 9), 1)], schema)
    late = spark.createDataFrame([(datetime(2024, 1, 1, 12), 2)], schema)
    with pytest.raises(Exception, match="outside"):
        replace_range(target, late, "at", datetime(2024, 1, 1, 9), datetime(2024, 1, 1, 10), refuse_outside=True).collect()


def seconds(spark, low, high):
    """Seconds number ``low`` to ``high`` of 2024."""
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))
    return spark.range(low, high).select(at.alias("dhms")).withColumn("date", F.to_date("dhms"))


def test_a_stored_second_dimension_is_pruned_by_day(spark, folder):
    from slotwise.operators.sessions import _listed_runs

    path = folder("seconds")
    seconds(spark, 0, 4 * 86400).write.partitionBy("date").parquet(path)
    log = spark.createDataFrame([(datetime(2024, 1, 2, 3),)], "start_time timestamp_ntz")
    listed = _listed_runs(log, spark.read.parquet(path), True)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(date" in plan
    assert rows(listed) == [(date(2024, 1, 2), datetime(2024, 1, 2, 3), datetime(2024, 1, 2, 3), 1)]


def test_runs_of_seconds_with_gaps_and_copies(spark):
    from slotwise.operators.dims import hourly_runs, runs_of_days, second_runs

    at = lambda text: datetime.fromisoformat(f"2024-01-{text}")
    listed = seconds(spark, 0, 10).unionByName(seconds(spark, 4, 6)).unionByName(seconds(spark, 20, 21))
    listed = listed.unionByName(seconds(spark, 86398, 86402)).unionByName(seconds(spark, 0, 1).select(F.lit(None).cast("timestamp_ntz").alias("dhms"), "date"))
    got = second_runs(listed)
    assert rows(got, "first_second", "last_second", "copies") == [
        (at("01 00:00:00"), at("01 00:00:03"), 1), (at("01 00:00:04"), at("01 00:00:05"), 2),
        (at("01 00:00:06"), at("01 00:00:09"), 1), (at("01 00:00:20"), at("01 00:00:20"), 1),
        (at("01 23:59:58"), at("01 23:59:59"), 1), (at("02 00:00:00"), at("02 00:00:01"), 1),
    ]
    whole = runs_of_days(seconds(spark, 0, 86401))
    assert rows(whole, "first_second", "last_second") == [(at("01 00:00:00"), at("01 23:59:59")), (at("02 00:00:00"), at("02 23:59:59"))]
    cut = hourly_runs(whole)
    assert cut.count() == 48 and cut.where("hour(first_second) <> hour(last_second)").count() == 0
    assert cut.agg(F.sum(F.unix_seconds(F.col("last_second").cast("timestamp")) - F.unix_seconds(F.col("first_second").cast("timestamp")) + 1)).first()[0] == 2 * 86400


def test_histograms_by_runs_read_no_single_seconds(spark, folder):
    from slotwise.operators.dims import runs_of_days
    from slotwise.operators.sessions import view_time_histogram

    log = spark.createDataFrame(
        [(date(2024, 1, 2), "TV", "s", datetime(2024, 1, 2, 3), None, "page")],
        "log_dt date, pn string, sid string, start_time timestamp_ntz, end_time timestamp_ntz, ec_type string",
    )
    schedule = spark.createDataFrame(
        [(date(2024, 1, 2), datetime(2024, 1, 2, 3), "TV", "T")], "bd_date date, bd_btime timestamp_ntz, media_code string, tape_code string"
    )
    days = runs_of_days(seconds(spark, 0, 4 * 86400))
    for limit in (None, 0):
        got = view_time_histogram(log, schedule, days, [date(2024, 1, 2)], limit)
        assert rows(got, "view_cnt") == [(1,)]
        assert "Range" not in got._jdf.queryExecution().executedPlan().toString()


def test_carriage_returns_at_the_end_of_a_row_are_kept(spark, folder):
    schema = "n int, t string"
    given = spark.createDataFrame([(1, "a\r"), (2, "\r"), (3, "x\r\ny"), (4, "x\r\n"), (5, None), (6, ""), (7, "b")], schema)
    # Without a header line the first row tells, so it ends plainly here.
    given = given.where("n > 2").unionByName(given.where("n <= 2"))
    for header in (True, False):
        for compress in (True, False):
            path = folder("returns")
            export_csv(given.coalesce(1), path, header=header, compress=compress)
            assert rows(read_csv(spark, path, given.schema, header=header, multi_line=True), "n", "t") == rows(given, "n", "t")
    probe = spark.createDataFrame([(1, "a\r"), (2, "\r")], schema)
    path = folder("returns")
    export_csv(probe, path)
    assert rows(read_csv(spark, path, probe.schema, multi_line=True)) == [(1, "a\r"), (2, "\r")]


def test_both_row_ends_side_by_side(spark, tmp_path):
    from pyspark.sql.types import IntegerType, StringType, StructField

    schema = StructType([StructField("n", IntegerType()), StructField("t", StringType())])
    (tmp_path / "crlf.csv").write_bytes(b'n,t\r\n1,a\r\n2,"b\r\nc"\r\n3,\r\n')
    (tmp_path / "lf.csv").write_bytes(b'n,t\n4,a\r\n5,"b\r\nc"\n6,\n')
    got = read_csv(spark, str(tmp_path), schema, multi_line=True)
    assert rows(got, "n", "t") == [(1, "a"), (2, "b\r\nc"), (3, None), (4, "a\r"), (5, "b\r\nc"), (6, None)]
    (tmp_path / "bare").mkdir()
    (tmp_path / "bare" / "crlf.csv").write_bytes(b'1,"x\r\ny"\r\n2,b\r\n')
    (tmp_path / "bare" / "lf.csv").write_bytes(b'3,"x\r\ny"\n4,b\r\n5,c\n')
    bare = read_csv(spark, str(tmp_path / "bare"), schema, header=False, multi_line=True)
    assert rows(bare, "n", "t") == [(1, "x\r\ny"), (2, "b"), (3, "x\r\ny"), (4, "b\r"), (5, "c")]
