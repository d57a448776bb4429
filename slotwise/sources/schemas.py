"""Column lists and types of the domain tables.

Codes stay text because they are zero-padded; types are never inferred.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


MONEY = DecimalType(18, 2)
RATE = DecimalType(18, 6)
CLOCK = TimestampNTZType()
DAY = DateType()
TEXT = StringType()


def _schema(columns: str, **types: DataType) -> StructType:
    """Text columns named in ``columns``, except those given a type."""
    names = columns.split()
    unknown = set(types) - set(names)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    return StructType([StructField(n, types.get(n, TEXT)) for n in names])


def _typed(data_type: DataType, names: str) -> dict[str, DataType]:
    return dict.fromkeys(names.split(), data_type)


SESSION_LOG = _schema(
    "log_dt pn sid start_time end_time ec_type", log_dt=DAY, start_time=CLOCK, end_time=CLOCK
)
CONNECTION_LOG = _schema("log_time pn uid status st", log_time=CLOCK, st=CLOCK)
ORDER_LINES = _schema(
    "goods_code media_code order_date order_amt", order_date=CLOCK, order_amt=MONEY
)

# --- fixed values: column lists ---------------------------------------------------

PROGRAMME = _schema(
    """seq_frame_no bd_date channel_code media_code prog_code run_time tape_name tape_no
    bd_btime bd_etime seq_testtape_no callmulti seq_no main_pd sub_pd md_code
    showhost1 showhost2 showhost3 tape_code goods_code sale_price dc_price brand_code
    lmsd_code main_yn analysis_contract_amt infimum_amt supremum_amt weights_time goods_rate
    real_plan_sale_amt real_plan_margin_amt pgm_plan_order_amt pgm_plan_margin_amt change_rate
    auto_plan_sale_amt auto_plan_margin_amt modify_date md_kind""",
    bd_date=DAY, **_typed(CLOCK, "bd_btime bd_etime modify_date"),
    **_typed(
        MONEY,
        """sale_price dc_price analysis_contract_amt infimum_amt supremum_amt real_plan_sale_amt
        real_plan_margin_amt pgm_plan_order_amt pgm_plan_margin_amt auto_plan_sale_amt
        auto_plan_margin_amt""",
    ),
    **_typed(RATE, "weights_time goods_rate change_rate"),
)

SCHEDULE_FRAME = _schema(
    """seq_frame_no bd_date media_code prog_code bd_btime bd_etime main_pd sub_pd pc_userid
    camera_team sub_team live_flag tape_code plan_amt plan_order_amt plan_margin_amt weights_time
    main_pd_rate sub_pd_rate model guest broad_fixed_amt_yn broad_fixed_amt subtitle_yn insert_date
    modify_date analysis_contract_amt broad_display_yn channel_code seq_testtape_no callmulti
    infimum_amt supremum_amt etc sub_pd2""",
    bd_date=DAY, **_typed(CLOCK, "bd_btime bd_etime insert_date modify_date"),
    **_typed(
        MONEY,
        """plan_amt plan_order_amt plan_margin_amt broad_fixed_amt analysis_contract_amt infimum_amt
        supremum_amt""",
    ),
    **_typed(RATE, "weights_time main_pd_rate sub_pd_rate"),
)

BROADCAST_GOODS = _schema(
    """seq_frame_no seq_no bd_date media_code bd_btime prog_code btime etime run_time sale_end_time
    goods_code bd_flag main_yn broad_yn pdin_yn sale_tg_qty insert_date modify_date weights_time
    goods_rate real_plan_sale_amt real_plan_margin_amt pgm_plan_order_amt pgm_plan_margin_amt
    change_rate channel_code auto_plan_sale_amt""",
    bd_date=DAY, sale_tg_qty=LongType(), **_typed(CLOCK, "bd_btime insert_date modify_date"),
    **_typed(
        MONEY,
        """real_plan_sale_amt real_plan_margin_amt pgm_plan_order_amt pgm_plan_margin_amt
        auto_plan_sale_amt""",
    ),
    **_typed(RATE, "weights_time goods_rate change_rate"),
)

BROADCAST_NO_GOODS = _schema(
    """seq_frame_no seq_no bd_date media_code bd_btime btime etime goods_code tape_code channel_code
    change_rate seq_testtape_no insert_id insert_date modify_id modify_date""",
    bd_date=DAY, change_rate=RATE, **_typed(CLOCK, "bd_btime insert_date modify_date"),
)

ORDER_PROMOTION = _schema(
    """seq promo_no do_type order_no order_g_seq order_d_seq order_w_seq proc_amt cancel_amt calim_amt
    proc_cost own_proc_cost entp_proc_cost entp_code receipt_no cancel_yn cancel_date insert_date
    alliance_proc_cost""",
    **_typed(CLOCK, "cancel_date insert_date"),
    **_typed(
        MONEY,
        """proc_amt cancel_amt calim_amt proc_cost own_proc_cost entp_proc_cost
        alliance_proc_cost""",
    ),
)

# Promotions as stored: partitioned by the month of their insertion.
ORDER_PROMOTION_TABLE = StructType(
    [*ORDER_PROMOTION.fields, StructField("insert_month", TEXT)]
)

SECOND_DIM = _schema("dhms date hms hh mi sec load_dt", dhms=CLOCK, date=DAY, load_dt=CLOCK)
HOUR_DIM = _schema("hh load_dt", load_dt=CLOCK)
MINUTE_DIM = _schema("mi load_dt", load_dt=CLOCK)
SEC_DIM = _schema("sec load_dt", load_dt=CLOCK)

CALENDAR = _schema(
    """date_id date sday year month day quarter week_ori week month_week day_name month_name month_id
    week_ori_id week_id holiday_flag weekend_flag day_no""",
    date=DAY,
)

COMPETITOR_SCHEDULE = _schema(
    """brdcomp_cd ctgr_nm brd_dt brd_stt_tslot_cd brd_stt_hmi brd_end_hmi brd_titl sale_prc
    brdcomp_hngl_nm o01_brdcomp_gb_nm o02_brdcomp_gb_nm instr_id inst_dttm mdfr_id mdf_dttm
    etl_load_dttm dc_aft_prc cnsl_rsrv_gds_yn main_yn""",
    **_typed(CLOCK, "inst_dttm mdf_dttm etl_load_dttm"), **_typed(MONEY, "sale_prc dc_aft_prc"),
)

GUIDE_SCHEDULE = _schema(
    """brd_stt_dhm brd_end_dhm pgm_nm brd_dt brd_lcl_nm brd_mdcl_nm brd_sclsf_nm brd_stt_tslot_cd
    pltf_gb_cd chnl_no instr_id inst_dttm etl_load_dttm""",
    **_typed(CLOCK, "inst_dttm etl_load_dttm"),
)

# Audience groups of the ratings file, in file order; each has a rating and a viewer count.
AUDIENCES = (
    "household", "personal", "male", "female", "under10s", "teenagers", "20s", "30s", "40s", "50s",
    "over60s",
)

# --- end of fixed values ----------------------------------------------------------

RATINGS = StructType(
    [StructField(n, TEXT) for n in ("ch_nm", "ch", "pgm_nm", "start_time", "end_time")]
    + [
        StructField(f"{audience}_{measure}", data_type)
        for audience in AUDIENCES
        for measure, data_type in (("viewership", DoubleType()), ("viewers", LongType()))
    ]
)

LIVE_STAT = _schema(
    "init_date tape_code data_type data_value bd_btime", data_value=MONEY, **_typed(CLOCK, "init_date bd_btime")
)

# Session marks, and viewers per programme and per minute of it, as windows of the log keep them.
SESSION_MARKS = _schema(
    "log_dt pn sid enter_time last_start last_end", log_dt=DAY, **_typed(CLOCK, "enter_time last_start last_end")
)
PROGRAMME_VIEWERS = _schema(
    "bd_date bd_btime media_code tape_code viewers", bd_date=DAY, bd_btime=CLOCK, viewers=LongType()
)
MINUTE_VIEWERS = _schema(
    "bd_date bd_btime media_code tape_code base_mi viewers", bd_date=DAY, bd_btime=CLOCK, base_mi=LongType(), viewers=LongType()
)

# Folds of the connection log, in sets of 1, 2, 4, ... days.
CONNECTION_FOLDS = _schema(
    "media_code user_id last_activity last_connect last_disconnect level first_day",
    level=IntegerType(), first_day=DAY, **_typed(CLOCK, "last_activity last_connect last_disconnect"),
)

# Live statistics as stored: partitioned by type and by the day of ``init_date``.
LIVE_STAT_TABLE = StructType([*LIVE_STAT.fields, StructField("init_day", DAY)])

# Order amounts of a stream, per minute, stored by the hour they lie in.
ORDER_SUMS = _schema(
    "goods_code media_code minute price order_day order_hour",
    price=MONEY, order_day=DAY, order_hour=IntegerType(), **_typed(CLOCK, "minute"),
)


def columns(schema: StructType) -> list[str]:
    return schema.fieldNames()


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select a schema's columns in its order and types; columns ``df`` lacks become null."""
    present = set(df.columns)
    return df.select(
        [
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )

