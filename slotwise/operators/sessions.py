"""Viewer sessions against the programme schedule.

A session is the fold of all log rows with one (day, media, session id).  It overlaps a
programme of its day and media when it ended at or after the start and began before the start
plus one hour.  A session may overlap several programmes and counts in each.

A daily histogram shuffles twice: the session fold, partially aggregated, so that a session id
holding a third of the log reaches the reducer as one row per map task; and the counts, of which
there are few.  Schedule and second dimension are broadcast when they have been measured to
fit.  Beyond that, :func:`match_programmes` joins on hour cells, so that one busy media is spread
over the day, and the dimension is joined with counts rather than sessions.  The dimension takes part as runs of
consecutive seconds, a few rows a day; a table of single seconds is turned into them first.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from slotwise.functions.fixed import ORDER_EVENTS
from slotwise.functions.timeops import duration_class, epoch_hours, minutes_between, ntz, seconds_between
from slotwise.operators.dims import hourly_runs, second_runs
from slotwise.operators.sizing import broadcast_if_small, fits, stored_measured

SESSION_KEY = ("log_dt", "pn", "sid")
SPAN = ("log_dt", "pn", "enter_time", "exit_time")
PROGRAMME = ("bd_date", "bd_btime", "media_code", "tape_code")
# A programme without a trusted end is taken to collect viewers for this long.
REACH = "INTERVAL 1 HOUR"


def fold_sessions(log: DataFrame, order_events: Sequence[str] = ORDER_EVENTS) -> DataFrame:
    """One row per session: entry, exit and first order.

    Exit is the last end, or the last start when no row has an end.  ``order_time`` is null
    for a session without an order event; the column costs nothing when nobody reads it.
    """
    ordered = F.when(F.col("ec_type").isin(list(order_events)), F.col("start_time"))
    return log.groupBy(*SESSION_KEY).agg(
        F.min("start_time").alias("enter_time"),
        F.coalesce(F.max("end_time"), F.max("start_time")).alias("exit_time"),
        F.min(ordered).alias("order_time"),
    )


def session_marks(log: DataFrame) -> DataFrame:
    """One row per session with what its entry and exit are taken from.

    Least of least and latest of latest are again that: marks of some rows can be stored, and
    :func:`merge_marks` of any of them, also of rows that both have seen, equals the marks of all rows.
    """
    return log.groupBy(*SESSION_KEY).agg(
        F.min("start_time").alias("enter_time"), F.max("start_time").alias("last_start"), F.max("end_time").alias("last_end")
    )


def merge_marks(marks: DataFrame) -> DataFrame:
    return marks.groupBy(*SESSION_KEY).agg(
        F.min("enter_time").alias("enter_time"), F.max("last_start").alias("last_start"), F.max("last_end").alias("last_end")
    )


def sessions_of(marks: DataFrame) -> DataFrame:
    """Sessions as :func:`fold_sessions` makes them, without orders."""
    return marks.select(*SESSION_KEY, "enter_time", F.coalesce("last_end", "last_start").alias("exit_time"))


def distinct_programmes(schedule: DataFrame) -> DataFrame:
    return schedule.select(*PROGRAMME).distinct()


def match_programmes(
    sessions: DataFrame,
    programmes: DataFrame,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Every overlapping (session, programme) pair, with a weight ``n``.

    ``sessions`` needs ``log_dt, pn, enter_time, exit_time``; further columns are carried.
    Equal session rows may come back as one row with a larger ``n``.
    """
    overlaps = (
        (F.col("log_dt") == F.col("bd_date"))
        & (F.col("pn") == F.col("media_code"))
        & (F.col("exit_time") >= F.col("bd_btime"))
        & (F.col("enter_time") < F.col("reach_end"))
    )
    # The end of the reach is computed once per programme rather than once per candidate pair.
    reaching, size = stored_measured(programmes.withColumn("reach_end", F.col("bd_btime") + F.expr(REACH)), "programmes")
    if fits(size, broadcast_limit):
        pairs = sessions.withColumn("n", F.lit(1).cast("bigint")).join(F.broadcast(reaching), overlaps)
    else:
        pairs = _match_by_hour_cell(sessions, reaching, overlaps)
    return pairs.drop("reach_end")


def _match_by_hour_cell(sessions: DataFrame, programmes: DataFrame, overlaps: Column) -> DataFrame:
    """The overlap as a shuffled equi join on (day, media, hour cell of the programme start).

    The starts a session can meet are those in ``(entry - 1 h, exit]``.  Each session is put in
    every cell of that span and each programme in exactly one, so a pair meets once and nothing
    has to be de-duplicated.  Spans are clipped to the cells that day's schedule uses (one row per
    day, broadcast), which bounds the copies of a session that never ended.  Equal sessions are counted before they
    are copied, so a crowd entering and leaving together is one row.
    """
    starts = programmes.withColumn("cell", epoch_hours("bd_btime"))
    used = starts.groupBy(F.col("bd_date").alias("used_day")).agg(
        F.min("cell").alias("first_cell"), F.max("cell").alias("last_cell")
    )
    counted = sessions.groupBy(*sessions.columns).agg(F.count(F.lit(1)).alias("n"))
    first = F.greatest(epoch_hours(F.col("enter_time") - F.expr(REACH)), F.col("first_cell"))
    last = F.least(epoch_hours("exit_time"), F.col("last_cell"))
    spread = (
        counted.join(broadcast_if_small(used), F.col("log_dt") == F.col("used_day"))
        .withColumn("from_cell", first)
        .withColumn("to_cell", last)
        .where(F.col("from_cell") <= F.col("to_cell"))
        .withColumn("cell", F.explode(F.sequence("from_cell", "to_cell")))
        .drop("used_day", "first_cell", "last_cell", "from_cell", "to_cell")
    )
    same_cell = spread["cell"] == starts["cell"]
    return spread.join(starts.hint("merge"), same_cell & overlaps).drop("cell")


def base_minute() -> Column:
    """Minute of the programme at entry; zero for viewers who were already there."""
    return F.greatest(F.lit(0).cast("bigint"), minutes_between("bd_btime", "enter_time"))


def view_time_histogram(
    log: DataFrame,
    schedule: DataFrame,
    seconds_dim: DataFrame,
    days: Iterable[date] | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Sessions per programme start, tape, minute of the programme and viewing-time class.

    ``seconds_dim`` has either single seconds (``dhms``) or runs of them, as ``second_runs`` makes.
    """
    log, schedule = _for_days(log, schedule, days)
    listed = _listed_runs(log, seconds_dim, days is not None)
    sessions = fold_sessions(log).withColumn(
        "view_time_cd", duration_class(seconds_between("enter_time", "exit_time"))
    )
    return _histogram(sessions, schedule, listed, "view_time_cd", "view_cnt", broadcast_limit)


def order_time_histogram(
    log: DataFrame,
    schedule: DataFrame,
    seconds_dim: DataFrame,
    days: Iterable[date] | None = None,
    order_events: Sequence[str] = ORDER_EVENTS,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """The same for the time from entry to first order.

    Only orders after the entry second count: sessions without an order and sessions that order
    in their first second are left out.
    """
    log, schedule = _for_days(log, schedule, days)
    listed = _listed_runs(log, seconds_dim, days is not None)
    waited = seconds_between("enter_time", F.coalesce("order_time", "enter_time"))
    sessions = (
        fold_sessions(log, order_events)
        .withColumn("waited", waited)
        .where(F.col("waited") > 0)
        .withColumn("dif_order_time_cd", duration_class("waited"))
    )
    return _histogram(sessions, schedule, listed, "dif_order_time_cd", "order_cnt", broadcast_limit)


def _histogram(
    sessions: DataFrame,
    schedule: DataFrame,
    listed: DataFrame,
    class_column: str,
    count_column: str,
    broadcast_limit: int | None,
) -> DataFrame:
    sessions = sessions.select("log_dt", "pn", "enter_time", "exit_time", class_column)
    pairs = match_programmes(sessions, distinct_programmes(schedule), broadcast_limit)
    keys = ["bd_date", "bd_btime", "tape_code", "base_mi", class_column]
    pairs = pairs.withColumn("base_mi", base_minute())
    # The second dimension only decides how often an entry second counts: not at all, once, or
    # more if it is listed more than once.
    listed, size = stored_measured(hourly_runs(listed), "listed-runs")
    if fits(size, broadcast_limit):
        listed = F.broadcast(listed)
    else:
        # Counting per entry second first keeps a second in which a third of all viewers arrive
        # from travelling as that many rows.
        pairs = pairs.groupBy(*keys, "enter_time").agg(F.sum("n").alias("n"))
        listed = listed.hint("merge")
    inside = (epoch_hours("enter_time") == F.col("cell")) & F.col("enter_time").between(F.col("first_second"), F.col("last_second"))
    # The dimension lists whole seconds.
    inside = inside & (F.date_trunc("second", "enter_time").cast("timestamp_ntz") == F.col("enter_time"))
    counted = pairs.join(listed, inside)
    return counted.groupBy(*keys).agg(F.sum(F.col("n") * F.col("copies")).alias(count_column))


def _listed_runs(log: DataFrame, seconds_dim: DataFrame, few_days: bool) -> DataFrame:
    """The runs of the dimension that can matter.

    A run over few days first asks the log for its earliest and latest start, which bound every entry; other
    days of the dimension are not read.
    """
    single = "dhms" in seconds_dim.columns
    if few_days:
        first, last = log.agg(F.min("start_time"), F.max("start_time")).first()
        if first is None:
            return second_runs(seconds_dim.where(F.lit(False))) if single else seconds_dim.where(F.lit(False))
        if "date" in seconds_dim.columns:
            # The day of the seconds, by which a stored dimension is partitioned.
            days = F.col("date").between(F.lit(first.date()), F.lit(last.date()))
            seconds_dim = seconds_dim.where(days)
        if single:
            seconds_dim = seconds_dim.where(F.col("dhms").between(ntz(first), ntz(last)))
        else:
            seconds_dim = seconds_dim.where((F.col("first_second") <= ntz(last)) & (F.col("last_second") >= ntz(first)))
    return second_runs(seconds_dim.select("dhms")) if single else seconds_dim


def programme_viewers(
    log: DataFrame,
    schedule: DataFrame,
    days: Iterable[date] | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Distinct sessions per programme.

    A session id is unique within its day and media after the fold, so counting pairs counts
    distinct sessions.
    """
    log, schedule = _for_days(log, schedule, days)
    return programme_viewers_of(fold_sessions(log), distinct_programmes(schedule), broadcast_limit)


def programme_viewers_of(sessions: DataFrame, programmes: DataFrame, broadcast_limit: int | None = None) -> DataFrame:
    """The same from folded sessions and distinct programmes."""
    pairs = match_programmes(sessions.select(*SPAN), programmes, broadcast_limit)
    return pairs.groupBy(*PROGRAMME).agg(F.sum("n").alias("viewers"))


def minute_viewers(
    log: DataFrame,
    schedule: DataFrame,
    days: Iterable[date] | None = None,
    broadcast_limit: int | None = None,
) -> DataFrame:
    """Distinct sessions per programme and minute of the programme, minutes with viewers only.

    Instead of one row per session and minute, each pair adds its weight at its first minute
    and takes it back after its last; the running sum over a programme's minutes (an hour at
    most) gives the viewers.
    """
    log, schedule = _for_days(log, schedule, days)
    return minute_viewers_of(fold_sessions(log), distinct_programmes(schedule), broadcast_limit)


def minute_viewers_of(sessions: DataFrame, programmes: DataFrame, broadcast_limit: int | None = None) -> DataFrame:
    """The same from folded sessions and distinct programmes."""
    pairs = match_programmes(sessions.select(*SPAN), programmes, broadcast_limit)
    final_second = F.col("bd_btime") + F.expr(REACH) - F.expr("INTERVAL 1 SECOND")
    left = F.least(
        minutes_between("bd_btime", "exit_time"), minutes_between("bd_btime", final_second)
    )
    changes = (
        pairs.withColumn("first_mi", base_minute())
        .withColumn("after_mi", F.greatest(F.col("first_mi"), left) + 1)
        .select(*PROGRAMME, F.expr("stack(2, first_mi, n, after_mi, -n)").alias("base_mi", "change"))
        .groupBy(*PROGRAMME, "base_mi")
        .agg(F.sum("change").alias("change"))
    )
    by_minute = W.partitionBy(*PROGRAMME).orderBy("base_mi")
    return (
        changes.withColumn("viewers", F.sum("change").over(by_minute.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("next_mi", F.lead("base_mi").over(by_minute))
        .where(F.col("viewers") > 0)
        .select(
            *PROGRAMME,
            F.explode(F.sequence(F.col("base_mi"), F.col("next_mi") - 1)).alias("base_mi"),
            "viewers",
        )
    )


def _for_days(
    log: DataFrame, schedule: DataFrame, days: Iterable[date] | None
) -> tuple[DataFrame, DataFrame]:
    """Restrict both inputs to ``days``; both columns are partition columns, so files are pruned."""
    if days is None:
        return log, schedule
    days = list(days)
    return log.where(F.col("log_dt").isin(days)), schedule.where(F.col("bd_date").isin(days))
