import glob
import gzip
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from conftest import rows
from slotwise.operators import quality
from slotwise.plans import reaimed, warehouse
from slotwise.sources import readers, schemas, scratch, tables, writers

SCHEMA = T.StructType(
    [
        T.StructField("code", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("day", T.DateType()),
        T.StructField("amount", T.DecimalType(18, 2)),
        T.StructField("n", T.LongType()),
    ]
)
AT = datetime(2024, 3, 10, 2, 30, 1, 5)
ROWS = [
    ("0001", 'say "hi", all', AT, date(2024, 1, 1), Decimal("1.50"), 1),
    ("", "", None, None, None, None),
    (None, None, AT, None, None, 2),
    (" lead", "trail ", AT, None, None, 3),
    ("back\\slash", "tail\\", AT, None, None, 4),
    ("한글", "a;b\tc", AT, None, None, 5),
]


@pytest.fixture
def values(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize("sep", [",", "\t", "|"])
@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("multi_line", [True, False])
def test_csv_round_trip(spark, values, folder, sep, header, multi_line):
    path = folder()
    writers.export_csv(values, path, sep=sep, header=header)
    assert rows(readers.read_csv(spark, path, SCHEMA, sep, header, multi_line)) == rows(values)
    assert glob.glob(f"{path}/*.csv.gz")


def test_line_breaks_survive_in_multi_line_mode(spark, folder):
    path, texts = folder(), ["a\r\nb", "a\nb", "\r\n", 'q"\r\n"q']
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "t string, i int")
    writers.export_csv(df, path)
    assert rows(readers.read_csv(spark, path, df.schema, multi_line=True)) == rows(df)


def test_fully_quoted_file_reads_empty_as_null(spark, values, folder):
    path = folder()
    writers.export_csv(values, path, quote_all=True)
    files = glob.glob(f"{path}/*.csv.gz")
    lines = [x for f in files for x in gzip.open(f, "rt", encoding="utf-8").read().splitlines()]
    assert len(lines) == len(ROWS) + len(files)
    assert lines[0] == '"code","name","at","day","amount","n"'
    assert all(line.startswith('"') and line.endswith('"') for line in lines)
    expected = values.replace("", None)
    assert rows(readers.read_csv(spark, path, SCHEMA, empty_as_null=True)) == rows(expected)


@pytest.mark.parametrize("multi_line", [True, False])
@pytest.mark.parametrize("line", ["1,2,,,5,six", "only,two", "a,b,yesterday,,,1"])
def test_malformed_rows_fail_the_read(spark, folder, line, multi_line):
    path = folder()
    spark.createDataFrame([(line,)], "value string").write.text(path)
    with pytest.raises(Exception, match="MALFORMED|CAST_INVALID_INPUT"):
        readers.read_csv(spark, path, SCHEMA, header=False, multi_line=multi_line).collect()


# ---- ratings ---------------------------------------------------------------------

NUMBERS = ",".join(["1.5,10"] * len(schemas.AUDIENCES))


def land(tmp_path, name, content):
    (tmp_path / name).write_bytes(content.encode("utf-8"))
    return str(tmp_path / name)


@pytest.mark.parametrize("end", ["\n", "\r\n"], ids=["lf", "crlf"])
def test_ratings_file(spark, folder, tmp_path, end):
    content = f'Home,0007,"News,\r\n at 9",0900,1000,{NUMBERS}{end}Home,0007,"two\nlines",1000,1100,{NUMBERS}{end}'
    path, table = land(tmp_path, "20241214A.csv", content), folder()
    for _ in range(2):
        warehouse.load_ratings(spark, path, table)
    stored = tables.read_table(spark, table, schemas.RATINGS)
    assert len(stored.columns) == 27
    got = rows(stored, "ch", "pgm_nm", "start_time", "`20s_viewership`", "over60s_viewers")
    assert got == [("0007", "News, at 9", "0900", 1.5, 10)] * 2 + [("0007", "two\nlines", "1000", 1.5, 10)] * 2


def test_header_line_is_data_when_names_are_given(spark, tmp_path):
    text = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    path = land(tmp_path, "x.csv", "a,b\n1,2\n")
    assert rows(readers.read_ratings(spark, path, text)) == [("1", "2"), ("a", "b")]


def test_file_name_in_either_case(spark, tmp_path):
    text = T.StructType([T.StructField("a", T.StringType())])
    land(tmp_path, "20241214A.CSV", "1\n")
    land(tmp_path, "20241215A.csv", "2\n")
    for day, value in (("14", "1"), ("15", "2")):
        path = readers.either_case(f"{tmp_path}/202412{day}A.csv")
        assert rows(readers.read_ratings(spark, path, text)) == [(value,)]


def test_load_csv_replaces_or_appends(spark, values, folder):
    landed, table = folder(), folder()
    writers.export_csv(values, landed)
    for replace, copies in ((False, 1), (False, 2), (True, 1)):
        warehouse.load_csv(spark, landed, table, SCHEMA, replace=replace)
        assert tables.read_table(spark, table, SCHEMA).count() == copies * len(ROWS)


# ---- staged loads ----------------------------------------------------------------


def dim(spark, rows_):
    return spark.createDataFrame([(h, datetime(2024, 1, 1, v)) for h, v in rows_], schemas.HOUR_DIM)


def test_one_stage_two_targets_and_an_empty_stage(spark, folder):
    landed, empty, stage, first, second = (folder() for _ in range(5))
    tables.overwrite_table(dim(spark, [("00", 1), ("01", 1)]), first)
    tables.create_table(spark, second, schemas.HOUR_DIM)
    writers.export_csv(dim(spark, [("01", 2), ("02", 2)]), landed)
    assert warehouse.load(spark, warehouse.HOUR_DIM, landed, stage, [first, second]) == 2
    read = lambda path: [(h, at.hour) for h, at in rows(tables.read_table(spark, path, schemas.HOUR_DIM))]
    assert read(first) == [("00", 1), ("01", 2), ("02", 2)]
    assert read(second) == [("01", 2), ("02", 2)]
    writers.export_csv(dim(spark, []), empty)
    assert warehouse.load(spark, warehouse.HOUR_DIM, empty, stage, [first]) == 0
    assert read(first) == [("00", 1), ("01", 2), ("02", 2)]


def test_competitor_day_of_ignored_slots_becomes_empty(spark, folder):
    day = date(2024, 1, 15)
    landed, stage, table = folder(), folder(), folder()

    def schedule(*rows_):
        df = spark.createDataFrame(rows_, "brd_dt string, brd_stt_tslot_cd string, brd_titl string")
        return schemas.conform(df, schemas.COMPETITOR_SCHEDULE)

    tables.overwrite_table(schedule(("20240113", "99", "old"), ("20240114", "01", "old"), ("20240115", "01", "old")), table, "brd_dt")
    new = schedule(("20240114", "99", "new"), ("20240115", "99", "new"), ("20240115", "02", "new"), ("20240115", None, "new"))
    new.write.parquet(writers.day_folder(landed, day))
    assert warehouse.load(spark, warehouse.COMPETITOR_SCHEDULE, landed, stage, [table], day) == 4
    stored = tables.read_table(spark, table, schemas.COMPETITOR_SCHEDULE)
    assert rows(stored, "brd_dt", "brd_stt_tslot_cd", "brd_titl") == [("20240113", "99", "old"), ("20240115", "02", "new")]


def test_column_lists():
    counts = {
        "PROGRAMME": 40, "SCHEDULE_FRAME": 35, "BROADCAST_GOODS": 27, "BROADCAST_NO_GOODS": 16,
        "ORDER_PROMOTION": 19, "CALENDAR": 18, "COMPETITOR_SCHEDULE": 19, "GUIDE_SCHEDULE": 13,
        "SECOND_DIM": 7, "RATINGS": 27,
    }
    for name, count in counts.items():
        names = getattr(schemas, name).fieldNames()
        assert (name, len(names), len(set(names))) == (name, count, count)


def test_generated_seconds(spark, folder):
    table = folder()
    tables.create_table(spark, table, schemas.SECOND_DIM, "date")
    for load_dt in (datetime(2024, 1, 1), datetime(2024, 2, 1)):
        reaimed.run_second_dim(spark, table, date(2024, 2, 28), date(2024, 3, 2), load_dt)
    stored = tables.read_table(spark, table, schemas.SECOND_DIM)
    assert stored.count() == stored.select("dhms").distinct().count() == 3 * 86400
    last = stored.where("dhms = timestamp_ntz'2024-02-29 23:59:59'").first()
    assert tuple(last) == (datetime(2024, 2, 29, 23, 59, 59), date(2024, 2, 29), "235959", "23", "59", "59", datetime(2024, 2, 1))


# ---- pages and freshness ---------------------------------------------------------


def page(rows_, name="TbStatus"):
    import json

    return json.dumps({name: {"list_total_count": len(rows_), "RESULT": {"CODE": "INFO-000", "MESSAGE": "ok"}, "row": rows_}})


def test_pages_are_flattened_in_any_dataset(spark, tmp_path):
    land(tmp_path, "p1.json", page([{"S_DT": "2023.05.31.00", "S_CARE": ""}, {"S_DT": "2023.05.30.00", "S_CARE": "0"}]))
    land(tmp_path, "p2.json", page([{"S_DT": "2023.05.29.00", "S_CARE": "1", "unknown": "x"}]))
    land(tmp_path, "p3.json", '{"RESULT": {"CODE": "INFO-200", "MESSAGE": "no data"}}')
    pages = readers.read_pages(spark, str(tmp_path), ["S_DT", "S_CARE"])
    assert rows(readers.flatten_pages(pages)) == [("2023.05.29.00", "1"), ("2023.05.30.00", "0"), ("2023.05.31.00", "")]
    assert {r["dataset"] for r in pages.where("total is not null").collect()} == {"TbStatus"}


@pytest.mark.parametrize(
    "first, day_off, expected",
    [
        ("2023.05.31.00", 0, ("2023-05-31", "2023-05-31", True, True)),
        ("(2023.05.31.00)", 0, ("2023-05-31", "2023-05-31", True, True)),
        ("2023/05/30", 0, ("2023-05-30", "2023-05-31", True, False)),
        ("2023/05/30", -1, ("2023-05-30", "2023-05-30", True, True)),
        ("pending", 0, ("pending", "2023-05-31", False, True)),
    ],
)
def test_freshness_looks_at_the_first_row_only(spark, tmp_path, first, day_off, expected):
    land(tmp_path, "p1.json", page([{"S_DT": first}, {"S_DT": "2030.01.01"}]))
    land(tmp_path, "p2.json", page([{"S_DT": "2031.01.01"}]))
    pages = readers.read_pages(spark, str(tmp_path), ["S_DT"])
    assert rows(quality.freshness_of_pages(pages, "S_DT", date(2023, 5, 31), day_off)) == [expected]


def test_freshness_of_a_table_and_of_nothing(frame):
    df = frame([(date(2024, 1, 1),), (date(2024, 1, 3),)], "d date")
    assert rows(quality.freshness_of_table(df, "d", date(2024, 1, 3))) == [("2024-01-03", "2024-01-03", True, True)]
    assert rows(quality.freshness_of_table(df.limit(0), "d", date(2024, 1, 3))) == [(None, "2024-01-03", False, False)]


def test_audit_appends(spark, folder):
    path = folder()
    for run in ("1", "2"):
        quality.append_audit(spark, path, "job", "task", run, "done")
    assert rows(spark.read.parquet(path), "run_id") == [("1",), ("2",)]


# ---- database reads and the shared folder ----------------------------------------


def test_database_read_is_bounded_and_parallel():
    options = readers.jdbc_window_options(
        "jdbc:x", "db.frames", ["a", "b"], "bd_date", datetime(2024, 1, 14), datetime(2024, 1, 17), 8
    )
    assert options["dbtable"].startswith("(SELECT a, b FROM db.frames WHERE bd_date >= TIMESTAMP '2024-01-14 00:00:00'")
    assert (options["numPartitions"], options["partitionColumn"]) == ("8", "bd_date")


def test_database_write_is_bounded_and_keeps_the_table():
    options = writers.jdbc_write_options("jdbc:x", "db.ratings", 4)
    assert (options["dbtable"], options["numPartitions"], options["truncate"]) == ("db.ratings", "4", "true")


def test_coming_year():
    assert reaimed.coming_year(datetime(2024, 12, 1)) == (date(2025, 1, 1), date(2025, 12, 1))
    assert reaimed.coming_year(datetime(2024, 2, 29)) == (date(2024, 3, 1), date(2025, 2, 28))


def test_shared_folder_comes_from_the_session(spark):
    assert scratch.new_folder(spark, "x").startswith(spark.conf.get(scratch.SETTING))


class SessionWithoutFolder:
    def __init__(self, master):
        self.conf = {"spark.master": master}


def test_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        scratch.shared_folder(SessionWithoutFolder("yarn"))


def test_local_session_without_a_shared_folder_gets_its_own():
    session = SessionWithoutFolder("local[2]")
    assert scratch.shared_folder(session) == scratch.shared_folder(session)


def test_gaps_of_paged_deliveries(spark, folder):
    from slotwise.operators.quality import page_gaps
    from slotwise.sources.readers import read_pages

    def page(folder_, number, rows_, total, name="set"):
        listed = ", ".join('{"A": "%d"}' % i for i in range(rows_))
        text = '{"%s": {"list_total_count": %d, "row": [%s]}}' % (name, total, listed)
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{folder_}/{name}-page={number}")

    first, second = folder("pages"), folder("pages")
    for number, count in ((1, 10), (2, 9), (4, 10), (6, 4), (7, 1)):
        page(first, number, count, 53)
    page(second, 1, 10, 54)
    page(second, 1, 3, 3, "other")
    spark.createDataFrame([('{"RESULT": {"CODE": "E", "MESSAGE": "x"}}',)], "value string").write.text(f"{first}/set-page=3")
    delivered = read_pages(spark, f"{first}/*", ["A"]).unionByName(read_pages(spark, f"{second}/*", ["A"]))
    got = {(r.dataset, r.problem, r.page, r.expected, r.found) for r in page_gaps(delivered, 10).collect()}
    assert got == {
        ("set", "doubled", 1, 1, 2), ("set", "short", 2, 10, 9), ("set", "missing", 3, 10, 0), ("set", "missing", 5, 10, 0),
        ("set", "unexpected", 7, 0, 1), ("set", "total", None, 54, 53),
    }
    assert page_gaps(delivered.limit(0), 10).count() == 0


def test_freshness_looks_at_the_newest_day_folder(spark, folder):
    from slotwise.operators.quality import freshness_of_pages
    from slotwise.sources.readers import read_pages

    root = folder("days")
    for day in ("20231231", "20240102", "20240101"):
        for page in (1, 2):
            shown = f"{day[:4]}.{day[4:6]}.{day[6:]}" if page == 1 else "2030.01.01"
            text = '{"set": {"list_total_count": 1, "row": [{"D": "%s"}]}}' % shown
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{root}/{day}/page={page}")
    row = freshness_of_pages(read_pages(spark, f"{root}/*/*", ["D"]), "D", date(2024, 1, 2)).first()
    assert (row.last_date, row.is_fresh) == ("2024-01-02", True)
