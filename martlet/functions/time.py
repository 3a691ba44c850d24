"""Time functions in the report zone (section 2.7, P6, P11-P13, P20).

Source timestamps are UTC without a zone (TIMESTAMP_NTZ). ``convert_timezone``
keeps them NTZ, so every derived value stays independent of the session zone.
Every job takes an explicit ``as_of`` instead of calling ``now()``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlet.session import REPORT_TZ


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_lit(value: str) -> Column:
    """A pinned instant, as TIMESTAMP_NTZ like the source columns."""
    return F.lit(value).cast("timestamp_ntz")


def local_ts(ts, tz: str = REPORT_TZ) -> Column:
    """Wall clock in ``tz`` of a UTC instant stored without zone (NTZ in, NTZ out)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), _c(ts))


def local_date(ts, tz: str = REPORT_TZ) -> Column:
    """``toDate(x, tz)`` / ``date(convert_tz(x, 'UTC', tz))``."""
    return F.to_date(local_ts(ts, tz))


def local_date_or(ts, fallback, tz: str = REPORT_TZ) -> Column:
    """Local date of ``ts``, else of ``fallback`` (``coalesce(shipped_at, starts_at)``)."""
    return F.coalesce(local_date(ts, tz), local_date(fallback, tz))


def between_local(ts, start: str, end: str, fallback=None, tz: str = REPORT_TZ) -> Column:
    """Local date of ``ts`` within [start, end], both inclusive; where ``ts``
    is NULL, that of ``fallback`` (if given). Each branch carries a bound on its
    own raw column, a day wider than the zone can shift, so that a scan can skip
    by it without losing a row."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")

    def within(c) -> Column:
        raw = (c >= F.date_sub(lo, 1).cast("timestamp_ntz")) & (c < F.date_add(hi, 2).cast("timestamp_ntz"))
        return raw & local_date(c, tz).between(lo, hi)

    t = _c(ts)
    return within(t) if fallback is None else within(t) | (t.isNull() & within(_c(fallback)))


def month_start(c) -> Column:
    """``toStartOfMonth``."""
    return F.trunc(_c(c), "MM")


def week_start(c) -> Column:
    """``toStartOfWeek(x, 1)``: the Monday of the week, as a date."""
    return F.to_date(F.date_trunc("week", _c(c)))


def prior_full_week(as_of) -> Column:
    """Monday of the last complete week before ``as_of``."""
    return F.date_sub(week_start(as_of), 7)


def months_diff(start, end) -> Column:
    """``dateDiff('month', a, b)``: month boundaries crossed (not full months)."""
    return F.months_between(month_start(end), month_start(start)).cast("int")


def next_business_day(day) -> Column:
    """Friday -> Monday (+3 days), else the next day. ``weekday`` is 0 on Monday."""
    d = F.to_date(_c(day))
    return F.date_add(d, F.when(F.weekday(d) == 4, 3).otherwise(1))


def hourly_lookback(as_of) -> Column:
    """Start of the look-back of an hourly job. At Monday 00:xx it reaches
    back over the weekend (49 h), otherwise one hour."""
    t = _c(as_of)
    monday_midnight = (F.weekday(t) == 0) & (F.hour(t) == 0)
    return F.when(monday_midnight, t - F.expr("interval 49 hours")).otherwise(t - F.expr("interval 1 hour"))


def lookback(ts, as_of, interval: str) -> Column:
    """``ts > as_of - interval`` (e.g. ``'14 days'``, ``'1 month'``)."""
    return _c(ts) > (_c(as_of) - F.expr(f"interval {interval}"))


def same_local_day(ts, as_of, tz: str = REPORT_TZ) -> Column:
    """"today" in the report zone."""
    return local_date(ts, tz) == local_date(as_of, tz)


def format_period(c, with_day: bool = False) -> Column:
    """``formatDateTime('%Y-%m[-%d]')``."""
    return F.date_format(_c(c), "yyyy-MM-dd" if with_day else "yyyy-MM")


def delivery_slot_text(start, end) -> Column:
    """'dd.MM.yy HH:mm - HH:mm' of a delivery window."""
    return F.concat(F.date_format(_c(start), "dd.MM.yy HH:mm"), F.lit(" - "),
                    F.date_format(_c(end), "HH:mm"))


def safe_date(text) -> Column:
    """P20: parse or NULL, keep the date (ANSI mode raises on a plain cast)."""
    return F.to_date(F.try_to_timestamp(_c(text)))
