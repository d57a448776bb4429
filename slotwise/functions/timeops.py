"""Time expressions that do not depend on ``spark.sql.session.timeZone``.

Wall-clock columns are ``TIMESTAMP_NTZ``.  Several Spark functions (``date_format``,
``timestampdiff``, ``date_trunc``) first cast such a column to an instant in the session
zone, which shifts wall clocks that fall in a daylight-saving gap.  The expressions here stay
on NTZ arithmetic and string casts, all of which run inside whole-stage codegen.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

from slotwise.functions.fixed import DURATION_CLASSES, TIME_ZONE

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_ORIGIN = "TIMESTAMP_NTZ'0001-01-01 00:00:00'"
_ORIGIN_TO_EPOCH = 62_135_596_800


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---- literals --------------------------------------------------------------------


def ntz(value: datetime) -> Column:
    """A wall-clock literal.  ``F.lit(datetime)`` would make an instant in the driver's zone."""
    if value.tzinfo is not None:
        raise ValueError("a wall-clock value carries no time zone")
    return F.expr(f"TIMESTAMP_NTZ'{value.isoformat(sep=' ')}'")


def instant(value: datetime, tz: str = TIME_ZONE) -> Column:
    """The instant at which the wall clock of ``tz`` shows ``value``."""
    aware = value if value.tzinfo is not None else value.replace(tzinfo=ZoneInfo(tz))
    utc = aware.astimezone(timezone.utc).replace(tzinfo=None)
    return F.expr(f"TIMESTAMP'{utc.isoformat(sep=' ')}Z'")


def bound_for(data_type, value: datetime, tz: str = TIME_ZONE) -> Column:
    """``value`` as a literal comparable with a column of ``data_type`` without casting it.

    Keeping the cast off the column is what lets the comparison reach the Parquet reader.  A date stands for its
    midnight, so a bound later in the day lies before the next date: true of ``>=`` and ``<``, which ranges use.
    """
    kind = data_type.typeName()
    if kind == "timestamp_ntz":
        return ntz(value)
    if kind == "timestamp":
        return instant(value, tz)
    if kind == "date":
        later = value.time() != datetime.min.time()
        return F.lit(value.date() + timedelta(days=int(later)))
    raise TypeError(f"no time bound for {kind}")


# ---- differences -----------------------------------------------------------------


def _units(ts: Column | str, unit: str) -> Column:
    """Whole seconds, minutes or hours since the origin.

    The cast of an interval to a number cuts its fraction off; as every date lies after the
    origin, that is a floor.
    """
    return (_col(ts) - F.expr(_ORIGIN)).cast(f"interval {unit}").cast("bigint")


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a wall clock."""
    return _units(ts, "second") - F.lit(_ORIGIN_TO_EPOCH)


def epoch_minutes(ts: Column | str) -> Column:
    return _units(ts, "minute") - F.lit(_ORIGIN_TO_EPOCH // 60)


def epoch_hours(ts: Column | str) -> Column:
    return _units(ts, "hour") - F.lit(_ORIGIN_TO_EPOCH // 3600)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Number of second boundaries crossed from ``start`` to ``end``."""
    return _units(end, "second") - _units(start, "second")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Number of minute boundaries crossed: 10:00:59 to 10:01:00 is one."""
    return _units(end, "minute") - _units(start, "minute")


# ---- truncation and text ---------------------------------------------------------


def _trunc(ts: Column | str, unit: str) -> Column:
    return F.expr(_ORIGIN) + _units(ts, unit) * F.expr(f"INTERVAL '1' {unit}")


def trunc_second(ts: Column | str) -> Column:
    return _trunc(ts, "second")


def trunc_minute(ts: Column | str) -> Column:
    return _trunc(ts, "minute")


def trunc_hour(ts: Column | str) -> Column:
    return _trunc(ts, "hour")


def minute_text(ts: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm``."""
    return F.substring(_col(ts).cast("string"), 1, 16)


def compact_minute_text(ts: Column | str) -> Column:
    """``yyyyMMddHHmm``."""
    return F.translate(minute_text(ts), "- :", "")


def day_text(day: Column | str) -> Column:
    """``yyyyMMdd``."""
    return F.translate(_col(day).cast("date").cast("string"), "-", "")


def parse_minute(text: Column | str) -> Column:
    """Wall clock of ``yyyy-MM-dd HH:mm`` or ``yyyyMMddHHmm``; anything else is null."""
    digits = F.translate(_col(text), "- :", "")
    spaced = F.regexp_replace(digits, r"(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})", "$1-$2-$3 $4:$5:00")
    return F.when(digits.rlike(r"^\d{12}$"), spaced.try_cast("timestamp_ntz"))


# ---- event time of streams -------------------------------------------------------


def event_time(ts: Column | str) -> Column:
    """A wall clock as the ``TIMESTAMP`` that streams need; read as UTC, so never shifted."""
    since = (_col(ts) - F.expr(_EPOCH)).cast("interval second").cast("decimal(20,6)")
    return F.timestamp_micros((since * F.lit(1000000)).cast("bigint"))


def wall_clock(ts: Column | str) -> Column:
    """Inverse of :func:`event_time`."""
    micros = F.unix_micros(_col(ts)).cast("decimal(20,0)")
    return F.expr(_EPOCH) + F.make_dt_interval(secs=(micros / F.lit(1000000)).cast("decimal(18,6)"))


def wall_clock_in(ts: Column | str, tz: str = TIME_ZONE) -> Column:
    """Wall clock of ``tz`` at an instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), wall_clock(ts))


def instant_in(ts: Column | str, tz: str = TIME_ZONE) -> Column:
    """The instant at which the wall clock of ``tz`` shows ``ts``; of a wall clock that is shown twice, the earlier."""
    return event_time(F.convert_timezone(F.lit(tz), F.lit("UTC"), _col(ts)))


def days_between(low: datetime, high: datetime, tz: str = TIME_ZONE, day_zone: str = TIME_ZONE) -> tuple[date, date]:
    """First and last day, in ``day_zone``, of the instants between two wall clocks of ``tz``."""
    there = ZoneInfo(day_zone)
    first, last = (v.replace(tzinfo=ZoneInfo(tz)).astimezone(there).date() for v in (low, high))
    return first, last


# ---- duration classes ------------------------------------------------------------


def duration_class(seconds: Column | str) -> Column:
    """Label of the class a duration falls in; edges are closed below and open above."""
    seconds = _col(seconds)
    label = F.lit(None).cast("string")
    for name, first in DURATION_CLASSES:
        label = F.when(seconds.isNotNull() if first is None else seconds >= first, F.lit(name)).otherwise(label)
    return label


# ---- run dates -------------------------------------------------------------------


def local_run_time(run: datetime, tz: str = TIME_ZONE) -> datetime:
    """Wall clock of a run: an aware value is moved to ``tz``, a naive one already is there."""
    return run.astimezone(ZoneInfo(tz)).replace(tzinfo=None) if run.tzinfo is not None else run


def at_midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day)


def trailing_minutes(run: datetime, minutes: int = 30) -> tuple[datetime, datetime]:
    """``[run - minutes, run)`` at whole minutes."""
    end = run.replace(second=0, microsecond=0)
    return end - timedelta(minutes=minutes), end


def schedule_days(run: datetime) -> tuple[datetime, datetime]:
    """From yesterday up to, without, the day after tomorrow."""
    today = at_midnight(run.date())
    return today - timedelta(days=1), today + timedelta(days=2)


def since_previous_month(run: datetime) -> tuple[datetime, datetime]:
    """From the first day of the previous month up to, without, today."""
    return shift_month(run, -1), at_midnight(run.date())


def previous_day(run: datetime) -> tuple[datetime, datetime]:
    today = at_midnight(run.date())
    return today - timedelta(days=1), today


def shift_month(run: datetime, months: int) -> datetime:
    """First day of the month ``months`` away."""
    index = run.year * 12 + (run.month - 1) + months
    return datetime(index // 12, index % 12 + 1, 1)
