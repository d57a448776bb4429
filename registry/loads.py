"""Staged loads, exports, open-data pages, freshness and audit."""

from __future__ import annotations

from functools import reduce
from operator import and_

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from registry.common import LOAD_AT, RUN, plain, query
from registry.keyed import PROMOTIONS_SQL, promotions
from slotwise import testmap as t
from slotwise.functions.timeops import day_text, ntz
from slotwise.operators import quality
from slotwise.operators.dims import seconds_of_days
from slotwise.operators.extract import sample_rows as sample
from slotwise.plans import warehouse
from slotwise.sources import schemas
from slotwise.sources.readers import flatten_pages, read_csv, read_pages
from slotwise.sources.scratch import new_folder
from slotwise.sources.tables import create_table, overwrite_table, read_table
from slotwise.sources.writers import day_folder, export_csv, export_day_csv

OLD_LOAD = datetime(2024, 1, 1)
OLD_SQL, NEW_SQL = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-02-01 07:00:00'"


def both(spark: SparkSession, spec: warehouse.LoadSpec, targets: list[str]) -> DataFrame:
    """The two target tables of a load, told apart by ``target``."""
    first, second = (read_table(spark, path, spec.schema) for path in targets)
    return first.withColumn("target", F.lit(1)).unionByName(second.withColumn("target", F.lit(2)))


# ---- time dimensions -------------------------------------------------------------


def _load_dim(spark: SparkSession, sf_dir: str, spec: warehouse.LoadSpec, part: Column) -> DataFrame:
    """Parts of the purchase times, loaded over those of all events and into an empty table."""
    e = t.events(spark, sf_dir).withColumn(spec.key, F.lpad(part.cast("string"), 2, "0"))
    old = e.select(spec.key, ntz(OLD_LOAD).alias("load_dt")).distinct()
    work = e.where(F.col("event_type") == "purchase").select(spec.key, ntz(LOAD_AT).alias("load_dt")).distinct()
    landed, stage, first, second = (new_folder(spark, f"{spec.key}-{n}") for n in ("csv", "stage", "a", "b"))
    warehouse.export_snapshot(work, spec.schema, landed)
    overwrite_table(old, first)
    create_table(spark, second, spec.schema)
    warehouse.load(spark, spec, landed, stage, [first, second])
    return both(spark, spec, [first, second])


def _dim_sql(key: str, part: str) -> str:
    return f"""
        WITH parts AS (SELECT lpad(CAST(extract({part} FROM ts) AS VARCHAR), 2, '0') AS {key}, event_type FROM events),
        work AS (SELECT DISTINCT {key} FROM parts WHERE event_type = 'purchase')
        SELECT DISTINCT {key}, {OLD_SQL} AS load_dt, 1 AS target FROM parts
        WHERE {key} NOT IN (SELECT {key} FROM work)
        UNION ALL SELECT {key}, {NEW_SQL}, 1 FROM work
        UNION ALL SELECT {key}, {NEW_SQL}, 2 FROM work"""


@query(_dim_sql("hh", "hour"))
def load_hour_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_dim(spark, sf_dir, warehouse.HOUR_DIM, F.hour("ts"))


@query(_dim_sql("mi", "minute"))
def load_minute_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_dim(spark, sf_dir, warehouse.MINUTE_DIM, F.minute("ts"))


@query(_dim_sql("sec", "second"))
def load_sec_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load_dim(spark, sf_dir, warehouse.SEC_DIM, F.second("ts"))


@query(
    f"""
    WITH days AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events),
    fresh AS (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events WHERE event_type = 'purchase' AND value > 200)
    SELECT date, {OLD_SQL} AS load_dt, CAST(86400 AS BIGINT) AS seconds, 1 AS target FROM days
    WHERE date NOT IN (SELECT date FROM fresh)
    UNION ALL SELECT date, {NEW_SQL}, 86400, 1 FROM fresh
    UNION ALL SELECT date, {NEW_SQL}, 86400, 2 FROM fresh"""
)
def load_second_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds of the days with a large purchase, loaded over those of all event days."""
    spec, e = warehouse.SECOND_DIM, t.events(spark, sf_dir)
    large = e.where((F.col("event_type") == "purchase") & (F.col("value") > 200))
    landed, stage, first, second = (new_folder(spark, f"dhms-{n}") for n in ("csv", "stage", "a", "b"))
    overwrite_table(seconds_of_days(t.event_days(e), ntz(OLD_LOAD)), first, spec.partition)
    create_table(spark, second, spec.schema, spec.partition)
    warehouse.export_snapshot(seconds_of_days(t.event_days(large), ntz(LOAD_AT)), spec.schema, landed)
    warehouse.load(spark, spec, landed, stage, [first, second])
    loaded = both(spark, spec, [first, second])
    return loaded.groupBy("target", "date", "load_dt").agg(F.count("dhms").alias("seconds"))


@query(
    """
    SELECT CAST(ts AS DATE) AS date, lpad(CAST(extract(hour FROM ts) AS VARCHAR), 2, '0') AS hh,
           CAST(3600 AS BIGINT) AS seconds,
           lpad(CAST(extract(hour FROM ts) AS VARCHAR), 2, '0') || '5959' AS last_hms
    FROM (SELECT unnest(range(d, d + INTERVAL 1 DAY, INTERVAL 1 HOUR)) AS ts
          FROM (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS d FROM events))"""
)
def export_second_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole second dimension as gzip CSV, many files, read back and summed up per hour."""
    seconds, landed = seconds_of_days(t.event_days(t.events(spark, sf_dir)), ntz(LOAD_AT)), new_folder(spark, "dhms")
    warehouse.export_snapshot(seconds, schemas.SECOND_DIM, landed)
    back = read_csv(spark, landed, schemas.SECOND_DIM)
    return back.groupBy("date", "hh").agg(F.count("dhms").alias("seconds"), F.max("hms").alias("last_hms"))


CALENDAR_HAVE = "date_id date year month day quarter month_id weekend_flag holiday_flag day_no"


def calendar(days: DataFrame, holiday: str) -> DataFrame:
    d = F.col("date")
    return t.filled(
        days.select(
            day_text("date").alias("date_id"),
            d,
            F.year(d).alias("year"),
            F.month(d).alias("month"),
            F.dayofmonth(d).alias("day"),
            F.quarter(d).alias("quarter"),
            F.substring(day_text("date"), 1, 6).alias("month_id"),
            F.when(F.dayofweek(d).isin(1, 7), "Y").otherwise("N").alias("weekend_flag"),
            F.lit(holiday).alias("holiday_flag"),
            F.dayofyear(d).alias("day_no"),
        ),
        schemas.CALENDAR,
        "date_id",
    )


CALENDAR_SQL = f"""
    SELECT {t.filled_sql(schemas.CALENDAR, CALENDAR_HAVE, "date_id")}, {{1}} FROM (
    SELECT strftime(date, '%Y%m%d') AS date_id, date, CAST(year(date) AS VARCHAR) AS year,
           CAST(month(date) AS VARCHAR) AS month, CAST(day(date) AS VARCHAR) AS day,
           CAST(quarter(date) AS VARCHAR) AS quarter, strftime(date, '%Y%m') AS month_id,
           CASE WHEN dayofweek(date) IN (0, 6) THEN 'Y' ELSE 'N' END AS weekend_flag,
           {{0}} AS holiday_flag, CAST(dayofyear(date) AS VARCHAR) AS day_no FROM ({{2}}))"""
ORDER_DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders"
SHIP_DAYS = "SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem"


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("date")).distinct()


def ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("date")).distinct()


@query(
    f"""{CALENDAR_SQL.format("'N'", "1 AS target", f"SELECT date FROM ({ORDER_DAYS}) WHERE date NOT IN ({SHIP_DAYS})")}
    UNION ALL {CALENDAR_SQL.format("'S'", "1 AS target", SHIP_DAYS)}
    UNION ALL {CALENDAR_SQL.format("'S'", "2 AS target", SHIP_DAYS)}"""
)
def load_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = warehouse.CALENDAR
    landed, stage, first, second = (new_folder(spark, f"calendar-{n}") for n in ("csv", "stage", "a", "b"))
    warehouse.export_snapshot(calendar(ship_days(spark, sf_dir), "S"), spec.schema, landed)
    overwrite_table(calendar(order_days(spark, sf_dir), "N"), first)
    create_table(spark, second, spec.schema)
    warehouse.load(spark, spec, landed, stage, [first, second])
    return plain(both(spark, spec, [first, second]))


@query(f"SELECT * EXCLUDE (target) FROM ({CALENDAR_SQL.format(chr(39) + 'N' + chr(39), '1 AS target', ORDER_DAYS)})")
def export_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = new_folder(spark, "calendar")
    warehouse.export_snapshot(calendar(order_days(spark, sf_dir), "N"), schemas.CALENDAR, landed)
    return plain(read_csv(spark, landed, schemas.CALENDAR))


def _export_dim(spark: SparkSession, sf_dir: str, schema: StructType, part: Column) -> DataFrame:
    key = schema.fieldNames()[0]
    parts = t.events(spark, sf_dir).select(
        F.lpad(part.cast("string"), 2, "0").alias(key), ntz(LOAD_AT).alias("load_dt")
    )
    landed = new_folder(spark, f"{key}-csv")
    warehouse.export_snapshot(parts.distinct(), schema, landed)
    return read_csv(spark, landed, schema)


def _parts_sql(key: str, part: str) -> str:
    return f"SELECT DISTINCT lpad(CAST(extract({part} FROM ts) AS VARCHAR), 2, '0') AS {key}, {NEW_SQL} AS load_dt FROM events"


@query(_parts_sql("hh", "hour"))
def export_hour_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export_dim(spark, sf_dir, schemas.HOUR_DIM, F.hour("ts"))


@query(_parts_sql("mi", "minute"))
def export_minute_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export_dim(spark, sf_dir, schemas.MINUTE_DIM, F.minute("ts"))


@query(_parts_sql("sec", "second"))
def export_sec_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _export_dim(spark, sf_dir, schemas.SEC_DIM, F.second("ts"))


# ---- programmes and schedules ----------------------------------------------------


def programme_rows(e: DataFrame, days_later: int = 0) -> DataFrame:
    """One programme per event; its name holds a comma and quotes."""
    return t.filled(
        e.select(
            F.lpad(F.col("event_id").cast("string"), 10, "0").alias("seq_frame_no"),
            F.date_add(F.col("ts").cast("date"), days_later).alias("bd_date"),
            t.media().alias("media_code"),
            F.concat(F.lit('The "'), "event_type", F.lit('", live')).alias("tape_name"),
            F.col("ts").alias("bd_btime"),
            (F.col("ts") + F.expr("INTERVAL 40 MINUTES")).alias("bd_etime"),
            F.concat(F.lit("T"), F.hour("ts")).alias("tape_code"),
            t.goods().alias("goods_code"),
            (F.col("value").cast("decimal(18,2)") + days_later).alias("sale_price"),
        ),
        schemas.PROGRAMME,
        "seq_frame_no",
    )


PROGRAMME_HAVE = "seq_frame_no bd_date media_code tape_name bd_btime bd_etime tape_code goods_code sale_price"
PROGRAMME_SQL = f"""
    SELECT {t.filled_sql(schemas.PROGRAMME, PROGRAMME_HAVE, "seq_frame_no")} FROM (
    SELECT lpad(CAST(event_id AS VARCHAR), 10, '0') AS seq_frame_no, CAST(ts AS DATE) + {{0}} AS bd_date,
           'TV' || lpad(CAST(user_id % 5 AS VARCHAR), 2, '0') AS media_code,
           'The "' || event_type || '", live' AS tape_name, ts AS bd_btime, ts + INTERVAL 40 MINUTE AS bd_etime,
           'T' || CAST(extract(hour FROM ts) AS VARCHAR) AS tape_code,
           regexp_extract(props, '[0-9]+') AS goods_code,
           CAST(value AS DECIMAL(18, 2)) + {{0}} AS sale_price
    FROM events {{1}})"""


@query(
    f"""{PROGRAMME_SQL.format(0, "WHERE event_type <> 'purchase'")}
    UNION ALL {PROGRAMME_SQL.format(1, "WHERE event_type = 'purchase'")}"""
)
def load_programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fully quoted CSV over a stored table; the reloaded programmes have moved to the next day."""
    spec, e = warehouse.PROGRAMME, t.events(spark, sf_dir)
    landed, stage, table = (new_folder(spark, f"programmes-{n}") for n in ("csv", "stage", "table"))
    overwrite_table(programme_rows(e), table, spec.partition)
    moved = programme_rows(e.where(F.col("event_type") == "purchase"), days_later=1)
    warehouse.export_snapshot(moved, spec.schema, landed, quote_all=True)
    warehouse.load(spark, spec, landed, stage, [table])
    return plain(read_table(spark, table, spec.schema))


@query(PROGRAMME_SQL.format(0, ""))
def export_programmes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole programme table as fully quoted gzip CSV, read back."""
    landed = new_folder(spark, "programmes")
    rows = programme_rows(t.events(spark, sf_dir))
    warehouse.export_snapshot(rows, schemas.PROGRAMME, landed, quote_all=True)
    back = read_csv(spark, landed, schemas.PROGRAMME, empty_as_null=True)
    return plain(back)


def competitor_rows(e: DataFrame, title: str) -> DataFrame:
    return t.filled(
        e.select(
            F.concat(F.lit("C"), F.col("user_id").cast("string")).alias("brdcomp_cd"),
            day_text("ts").alias("brd_dt"),
            F.lpad(t.goods(), 2, "0").alias("brd_stt_tslot_cd"),
            F.lit(title).alias("brd_titl"),
            F.col("value").alias("sale_prc"),
            F.col("ts").alias("inst_dttm"),
        ),
        schemas.COMPETITOR_SCHEDULE,
        "brdcomp_cd",
    )


COMPETITOR_HAVE = "brdcomp_cd brd_dt brd_stt_tslot_cd brd_titl sale_prc inst_dttm"
COMPETITOR_SQL = f"""
    SELECT {t.filled_sql(schemas.COMPETITOR_SCHEDULE, COMPETITOR_HAVE, "brdcomp_cd")} FROM (
    SELECT 'C' || CAST(user_id AS VARCHAR) AS brdcomp_cd, strftime(ts, '%Y%m%d') AS brd_dt,
           lpad(regexp_extract(props, '[0-9]+'), 2, '0') AS brd_stt_tslot_cd, '{{0}}' AS brd_titl,
           CAST(value AS DECIMAL(18, 2)) AS sale_prc, ts AS inst_dttm
    FROM events WHERE {{1}})"""
RELOADED = "ts >= TIMESTAMP '2024-01-20'"


@query(
    f"""{COMPETITOR_SQL.format('old', 'NOT ' + RELOADED)}
    UNION ALL SELECT * FROM ({COMPETITOR_SQL.format('new', RELOADED)}) WHERE brd_stt_tslot_cd <> '99'"""
)
def load_competitor_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Parquet day folder holding the days since the 20th; slot 99 is deleted but not inserted."""
    spec, e = warehouse.COMPETITOR_SCHEDULE, t.events(spark, sf_dir)
    landed, stage, table = (new_folder(spark, f"competitor-{n}") for n in ("in", "stage", "table"))
    overwrite_table(competitor_rows(e, "old"), table, spec.partition)
    since = e.where(F.col("ts") >= ntz(datetime(2024, 1, 20)))
    overwrite_table(competitor_rows(since, "new"), day_folder(landed, RUN.date()))
    warehouse.load(spark, spec, landed, stage, [table], RUN.date())
    return plain(read_table(spark, table, spec.schema))


def guide_rows(e: DataFrame, name: str) -> DataFrame:
    return t.filled(
        e.select(
            F.concat(day_text("ts"), F.lpad(F.hour("ts").cast("string"), 2, "0")).alias("brd_stt_dhm"),
            F.lit(name).alias("pgm_nm"),
            day_text("ts").alias("brd_dt"),
            F.lpad(F.hour("ts").cast("string"), 2, "0").alias("brd_stt_tslot_cd"),
            F.col("user_id").cast("string").alias("chnl_no"),
        ),
        schemas.GUIDE_SCHEDULE,
        "chnl_no",
    )


GUIDE_SQL = f"""
    SELECT {t.filled_sql(schemas.GUIDE_SCHEDULE, "brd_stt_dhm pgm_nm brd_dt brd_stt_tslot_cd chnl_no", "chnl_no")} FROM (
    SELECT strftime(ts, '%Y%m%d%H') AS brd_stt_dhm, '{{0}}' AS pgm_nm, strftime(ts, '%Y%m%d') AS brd_dt,
           strftime(ts, '%H') AS brd_stt_tslot_cd, CAST(user_id AS VARCHAR) AS chnl_no
    FROM events WHERE {{1}})"""


@query(f"{GUIDE_SQL.format('old', 'NOT ' + RELOADED)} UNION ALL {GUIDE_SQL.format('new', RELOADED)}")
def load_guide_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec, e = warehouse.GUIDE_SCHEDULE, t.events(spark, sf_dir)
    landed, stage, table = (new_folder(spark, f"guide-{n}") for n in ("in", "stage", "table"))
    overwrite_table(guide_rows(e, "old"), table, spec.partition)
    since = e.where(F.col("ts") >= ntz(datetime(2024, 1, 20)))
    overwrite_table(guide_rows(since, "new"), day_folder(landed, RUN.date()))
    warehouse.load(spark, spec, landed, stage, [table], RUN.date())
    return plain(read_table(spark, table, spec.schema))


# ---- extracts --------------------------------------------------------------------


def _extracted(table: DataFrame, schema: StructType, key: str) -> DataFrame:
    return plain(warehouse.extract_schedule(t.filled(table, schema, key), schema, RUN))


IN_DAYS = "bd_date >= DATE '2024-01-19' AND bd_date < DATE '2024-01-22'"
AIRING_HAVE = "bd_date bd_btime media_code tape_code goods_code"


@query(
    f"""{t.with_sql('frames')} SELECT {t.filled_sql(schemas.SCHEDULE_FRAME, "bd_date bd_btime media_code tape_code", "tape_code")}
    FROM frames WHERE {IN_DAYS}"""
)
def extract_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(t.frames(t.events(spark, sf_dir)), schemas.SCHEDULE_FRAME, "tape_code")


@query(
    f"""{t.with_sql('programmes')} SELECT {t.filled_sql(schemas.BROADCAST_GOODS, AIRING_HAVE, "goods_code")}
    FROM programmes WHERE {IN_DAYS}"""
)
def extract_broadcast_goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(t.programmes(t.events(spark, sf_dir)), schemas.BROADCAST_GOODS, "goods_code")


@query(
    f"""{t.with_sql('programmes')} SELECT {t.filled_sql(schemas.BROADCAST_NO_GOODS, AIRING_HAVE, "goods_code")}
    FROM programmes WHERE {IN_DAYS}"""
)
def extract_broadcast_no_goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _extracted(t.programmes(t.events(spark, sf_dir)), schemas.BROADCAST_NO_GOODS, "goods_code")


@query(
    PROMOTIONS_SQL.format(
        "CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END",
        "WHERE o_orderdate >= TIMESTAMP '1997-05-01' AND o_orderdate < TIMESTAMP '1997-06-15'",
    )
)
def extract_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warehouse.extract_promotions(promotions(spark, sf_dir), datetime(1997, 6, 15, 7, 0))
    return plain(rows)


# ---- plain files -----------------------------------------------------------------


@query("SELECT * FROM orders")
def export_csv_gz(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, landed = t.table(spark, sf_dir, "orders"), new_folder(spark, "orders")
    export_csv(orders, landed)
    return read_csv(spark, landed, orders.schema)


@query("SELECT * FROM documents")
def export_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with commas, quotes and line breaks survive the round trip."""
    documents, landed = t.table(spark, sf_dir, "documents"), new_folder(spark, "texts")
    export_csv(documents, landed)
    return read_csv(spark, landed, documents.schema, multi_line=True)


@query("SELECT * FROM supplier")
def export_day_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers, landed = t.table(spark, sf_dir, "supplier"), new_folder(spark, "suppliers")
    export_day_csv(suppliers, landed, RUN.date())
    return read_csv(spark, day_folder(landed, RUN.date()), suppliers.schema)


@query("SELECT c_custkey, c_name, c_mktsegment, CAST(2 AS BIGINT) AS copies FROM customer")
def load_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file three times: appended to old rows, replacing all, appended again."""
    customers = t.table(spark, sf_dir, "customer")
    landed, table = new_folder(spark, "customers"), new_folder(spark, "customers")
    export_csv(customers, landed)
    for replace in (False, True, False):
        warehouse.load_csv(spark, landed, table, customers.schema, replace=replace)
    stored = read_table(spark, table, customers.schema)
    return stored.groupBy("c_custkey", "c_name", "c_mktsegment").agg(F.count(F.lit(1)).alias("copies"))


@query("SELECT * FROM part")
def load_delimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = t.table(spark, sf_dir, "part")
    landed, table = new_folder(spark, "parts"), new_folder(spark, "parts")
    export_csv(parts, landed, sep="\t", compress=False)
    warehouse.load_csv(spark, landed, table, parts.schema, sep="\t", replace=True)
    return read_table(spark, table, parts.schema)


@query("SELECT count(*) AS staged FROM events")
def load_stage_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows staged from a fully quoted file."""
    landed, stage = new_folder(spark, "stage-csv"), new_folder(spark, "stage")
    rows = programme_rows(t.events(spark, sf_dir))
    warehouse.export_snapshot(rows, schemas.PROGRAMME, landed, quote_all=True)
    warehouse.load_stage(spark, warehouse.PROGRAMME, landed, stage)
    return quality.row_count(read_table(spark, stage, schemas.PROGRAMME)).withColumnRenamed("row_count", "staged")


def ratings(e: DataFrame) -> DataFrame:
    """Viewer counts per media, hour and audience; the programme name holds a line break."""
    measures = []
    for index, audience in enumerate(schemas.AUDIENCES):
        viewers = F.count(F.when(F.col("user_id") % len(schemas.AUDIENCES) >= index, 1))
        measures += [
            (viewers / 4).alias(f"{audience}_viewership"),
            viewers.alias(f"{audience}_viewers"),
        ]
    return e.groupBy(
        t.media().alias("ch_nm"),
        F.concat(F.lit("0"), (F.col("user_id") % 5).cast("string")).alias("ch"),
        F.concat(F.lit("News,\r\n"), "event_type").alias("pgm_nm"),
        F.substring(F.col("ts").cast("string"), 12, 2).alias("start_time"),
        F.concat(F.substring(F.col("ts").cast("string"), 12, 2), F.lit(":59")).alias("end_time"),
    ).agg(*measures)


RATINGS_SQL = f"""
    SELECT 'TV' || lpad(CAST(user_id % 5 AS VARCHAR), 2, '0') AS ch_nm, '0' || CAST(user_id % 5 AS VARCHAR) AS ch,
           'News,' || event_type AS pgm_nm, strftime(ts, '%H') AS start_time, strftime(ts, '%H') || ':59' AS end_time,
           {', '.join(
               f'count(CASE WHEN user_id % {len(schemas.AUDIENCES)} >= {i} THEN 1 END) / 4.0e0 AS "{a}_viewership", '
               f'count(CASE WHEN user_id % {len(schemas.AUDIENCES)} >= {i} THEN 1 END) AS "{a}_viewers"'
               for i, a in enumerate(schemas.AUDIENCES)
           )}
    FROM events GROUP BY ALL"""


@query(RATINGS_SQL)
def load_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two headerless files, one after the other, into one table."""
    rows, table = ratings(t.events(spark, sf_dir)), new_folder(spark, "ratings")
    purchase = F.col("pgm_nm").endswith("purchase")
    for part in (rows.where(purchase), rows.where(~purchase)):
        landed = new_folder(spark, "ratings-csv")
        export_csv(part, landed, header=False, compress=False)
        warehouse.load_ratings(spark, landed, table)
    return read_table(spark, table, schemas.RATINGS)


# ---- open data -------------------------------------------------------------------

PAGE_ROWS = 1000


def _land_pages(rows: DataFrame, page: Column, dataset: str, newest: str | None = None) -> DataFrame:
    """JSON documents as an open-data service pages them, one per ``page`` value.

    A page holds at most ``PAGE_ROWS`` rows; with ``newest`` its rows run from the largest value
    of that column down.
    """
    names = rows.columns
    first = [newest] if newest else []
    row = F.struct(*first, *[n for n in names if n not in first])
    listed = F.sort_array(F.collect_list(row), asc=newest is None)
    body = F.struct(
        F.count(F.lit(1)).alias("list_total_count"),
        F.struct(F.lit("INFO-000").alias("CODE"), F.lit("ok").alias("MESSAGE")).alias("RESULT"),
        listed.alias("row"),
    )
    pages = rows.groupBy(page.alias("page")).agg(body.alias("body"))
    return pages.select("page", F.to_json(F.struct(F.col("body").alias(dataset))).alias("value"))


def _write_pages(pages: DataFrame, landed: str) -> None:
    """One document per file, and an error page that has no rows."""
    pages.repartition("page").write.partitionBy("page").text(landed)
    error = pages.sparkSession.range(0, 1, 1, 1).select(
        F.lit('{"RESULT": {"CODE": "INFO-200", "MESSAGE": "no data"}}').alias("value")
    )
    error.write.text(f"{landed}/page=999999")


CUSTOMER_FIELDS = ("c_custkey", "c_name", "c_mktsegment", "c_note")


GAP_ROWS = 200


@query(
    f"""
    WITH whole AS (SELECT count(*) AS n FROM customer),
    expected AS (
        SELECT page, least({GAP_ROWS}, n - (page - 1) * {GAP_ROWS}) AS rows_ FROM whole, (
            SELECT unnest(range(1, CAST(ceil(n / {GAP_ROWS}.0) AS BIGINT) + 1)) AS page FROM whole)),
    delivered AS (
        SELECT c_custkey // {GAP_ROWS} + 1 AS page, count(*) AS found FROM customer
        WHERE c_custkey // {GAP_ROWS} <> 2 AND c_custkey % 977 <> 5 GROUP BY 1)
    SELECT 'CustomerStatus' AS dataset, 'missing' AS problem, page, CAST(rows_ AS BIGINT) AS expected, CAST(0 AS BIGINT) AS found
    FROM expected WHERE page NOT IN (SELECT page FROM delivered)
    UNION ALL SELECT 'CustomerStatus', 'short', page, rows_, found FROM expected JOIN delivered USING (page) WHERE found < rows_
    UNION ALL SELECT 'CustomerStatus', 'doubled', page, 1, 2 FROM delivered WHERE page = 1"""
)
def page_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered pages of which one is missing, one came twice and some lack rows."""
    customers = t.table(spark, sf_dir, "customer")
    total = customers.count()
    number = F.floor(F.col("c_custkey") / GAP_ROWS) + 1
    kept = customers.where((number != 3) & (F.col("c_custkey") % 977 != 5)).select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name")
    body = F.struct(
        F.lit(total).alias("list_total_count"),
        F.struct(F.lit("INFO-000").alias("CODE"), F.lit("ok").alias("MESSAGE")).alias("RESULT"),
        F.collect_list(F.struct("c_custkey", "c_name")).alias("row"),
    )
    page = F.floor(F.col("c_custkey").cast("bigint") / GAP_ROWS) + 1
    pages = kept.groupBy(page.alias("page")).agg(F.to_json(F.struct(body.alias("CustomerStatus"))).alias("value"))
    landed = new_folder(spark, "gaps")
    _write_pages(pages, f"{landed}/first")
    pages.where("page = 1").repartition("page").write.partitionBy("page").text(f"{landed}/second")
    delivered = read_pages(spark, f"{landed}/*/*", ["c_custkey", "c_name"])
    return quality.page_gaps(delivered, GAP_ROWS)


@query(
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment, '' AS c_note FROM customer"""
)
def flatten_open_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to rows to a CSV in the folder of the day; blanks stay blank."""
    customers = t.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment", F.lit("").alias("c_note")
    )
    landed, out = new_folder(spark, "pages"), new_folder(spark, "flat")
    page = F.floor(F.col("c_custkey").cast("bigint") / PAGE_ROWS)
    _write_pages(_land_pages(customers, page, "CustomerStatus"), landed)
    flat = flatten_pages(read_pages(spark, landed, CUSTOMER_FIELDS))
    export_day_csv(flat, out, RUN.date())
    return read_csv(spark, day_folder(out, RUN.date()), flat.schema)


@query(
    """SELECT strftime(max(l_shipdate), '%Y-%m-%d') AS last_date, '1998-12-02' AS search_date, true AS is_valid,
              strftime(max(l_shipdate), '%Y-%m-%d') >= '1998-12-02' AS is_fresh
    FROM lineitem"""
)
def freshness_of_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments per day, one page per month, newest month and day first."""
    shipped = t.table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").cast("date").alias("d")).count()
    rows = shipped.select(
        F.concat(F.lit("("), F.translate(F.col("d").cast("string"), "-", "."), F.lit(".00)")).alias("S_DT"),
        F.col("count").cast("string").alias("S_CNT"),
    )
    month = F.translate(F.substring("S_DT", 2, 7), ".", "").cast("int")
    landed = new_folder(spark, "pages")
    _write_pages(_land_pages(rows, F.lit(999998) - month, "ShipmentStatus", newest="S_DT"), landed)
    pages = read_pages(spark, landed, ["S_DT", "S_CNT"])
    return quality.freshness_of_pages(pages, "S_DT", date(1998, 12, 1), day_off=1)


@query(
    """SELECT strftime(max(o_orderdate), '%Y-%m-%d') AS last_date, '2024-01-20' AS search_date, true AS is_valid,
              strftime(max(o_orderdate), '%Y-%m-%d') >= '2024-01-20' AS is_fresh
    FROM orders"""
)
def freshness_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness_of_table(t.table(spark, sf_dir, "orders"), "o_orderdate", RUN.date())


# ---- counts, samples, audit ------------------------------------------------------

COUNTED = ("customer", "orders", "lineitem", "events", "documents", "pages")


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS row_count FROM {n}" for n in COUNTED))
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        quality.row_count(t.table(spark, sf_dir, name)).select(F.lit(name).alias("name"), "row_count")
        for name in COUNTED
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


@query("SELECT count(*) AS row_count FROM lineitem")
def line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a landed CSV without header: its rows."""
    landed = new_folder(spark, "lines")
    export_csv(t.table(spark, sf_dir, "lineitem"), landed, compress=False, header=False)
    return quality.line_count(spark, landed)


@query(
    """SELECT 'load_events' AS dag_id, 'count' AS task_id, 'run-1' AS run_id, CAST(count(*) AS VARCHAR) AS msg FROM events
    UNION ALL
    SELECT 'load_orders', 'count', 'run-1', CAST(count(*) AS VARCHAR) FROM orders"""
)
def append_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of two loads, written to the audit."""
    audit = new_folder(spark, "audit")
    for name in ("events", "orders"):
        counted = t.table(spark, sf_dir, name).count()
        quality.append_audit(spark, audit, f"load_{name}", "count", "run-1", str(counted))
    return spark.read.schema(quality.AUDIT_SCHEMA).parquet(audit)


@query("SELECT 10::BIGINT AS sampled, 10::BIGINT AS found")
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any ten orders: which ones is not defined, so they are counted, and found again by all their columns."""
    orders = t.table(spark, sf_dir, "orders")
    path = new_folder(spark, "sample")
    sample(orders).write.parquet(path)
    picked = spark.read.parquet(path)
    same = [picked[c].eqNullSafe(orders[c]) for c in orders.columns]
    found = picked.join(orders, reduce(and_, same), "left_semi")
    counts = picked.select(F.lit(1).alias("s"), F.lit(0).alias("f")).unionByName(
        found.select(F.lit(0).alias("s"), F.lit(1).alias("f"))
    )
    return counts.agg(F.sum("s").alias("sampled"), F.sum("f").alias("found"))
