"""Date and time Column helpers (FN-01..FN-11).

All business dates are *local* calendar dates derived explicitly from an
instant; nothing here depends on the session time zone. Naive timestamps
(``timestamp_ntz``) are read as UTC wall clock unless told otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The business zone and the mid-year anchor used for ages.
BUSINESS_ZONE = "Asia/Seoul"
AGE_ANCHOR_MONTH = 7
AGE_ANCHOR_DAY = 1
DAYS_PER_YEAR = "365.25"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def local_timestamp(ts: Column | str, zone: str = BUSINESS_ZONE,
                    naive_zone: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` of an instant stored naive in ``naive_zone``."""
    return F.convert_timezone(F.lit(naive_zone), F.lit(zone), _c(ts))


def local_date(ts: Column | str, zone: str = BUSINESS_ZONE, naive_zone: str = "UTC") -> Column:
    """FN-01: calendar date of an instant in ``zone`` (``(ts at time zone z)::date``).

    Uses the zone database, so historic offset changes are honoured; an event
    at 15:00-23:59 UTC lands on the next Seoul day.
    """
    return F.to_date(local_timestamp(ts, zone, naive_zone))


def parse_ymd(text: Column | str) -> Column:
    """FN-02: 'YYYYMMDD' text to DATE. Under ANSI mode a malformed value raises
    (by design: a bad source date must fail the job, not become NULL)."""
    return F.to_date(_c(text), "yyyyMMdd")


def trunc_date(unit: str, d: Column | str) -> Column:
    """FN-03: ``date_trunc(unit, d)::date``; weeks start on Monday."""
    return F.date_trunc(unit, _c(d)).cast("date")


def iso_day_of_week(d: Column | str) -> Column:
    """FN-04: ISO weekday, Monday = 1 .. Sunday = 7."""
    return F.extract(F.lit("DAYOFWEEK_ISO"), _c(d))


def month_label(d: Column | str) -> Column:
    """FN-05: 'YYYY-MM'."""
    return F.date_format(_c(d), "yyyy-MM")


def month_name(d: Column | str) -> Column:
    """FN-05: English month name, unpadded (the reference pads to 9 chars)."""
    return F.date_format(_c(d), "MMMM")


def day_name(d: Column | str) -> Column:
    """FN-05: English weekday name, unpadded."""
    return F.date_format(_c(d), "EEEE")


def _months_forward(later: Column, earlier: Column) -> Column:
    months = (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))
    return months - F.when(F.dayofmonth(later) < F.dayofmonth(earlier), 1).otherwise(0)


def whole_months(a: Column | str, b: Column | str) -> Column:
    """FN-06: ``extract(year from age(a,b))*12 + extract(month from age(a,b))``.

    Whole calendar months from ``b`` to ``a``: a month counts once the day of
    month is reached. For ``a < b`` the result is minus the months from ``a``
    to ``b``. ``months_between`` is not used: it treats month ends specially.
    """
    a, b = _c(a).cast("date"), _c(b).cast("date")
    return (F.when(a >= b, _months_forward(a, b))
            .otherwise(-_months_forward(b, a))).cast("int")


def days_between(a: Column | str, b: Column | str) -> Column:
    """FN-07: ``a - b`` in whole days (date minus date)."""
    return F.datediff(_c(a), _c(b))


def mid_year(birth_year: Column | str) -> Column:
    """FN-08: ``make_date(birth_year, 7, 1)``."""
    return F.make_date(_c(birth_year), F.lit(AGE_ANCHOR_MONTH), F.lit(AGE_ANCHOR_DAY))


def age_years(on: Column | str, birth_year: Column | str) -> Column:
    """FN-07: age in years on a date, as ``numeric(5,2)`` (NULL without a birth year)."""
    days = F.datediff(_c(on), mid_year(birth_year))
    return F.when(_c(birth_year).isNotNull(),
                  (days / F.expr(f"CAST({DAYS_PER_YEAR} AS DECIMAL(6,2))")).cast("decimal(5,2)"))


def age_band(on: Column | str, birth_year: Column | str, width: int = 5) -> Column:
    """FN-07: ``floor(age / width) * width`` as int."""
    days = F.datediff(_c(on), mid_year(birth_year))
    years = days / F.expr(f"CAST({DAYS_PER_YEAR} AS DECIMAL(6,2))")
    return F.when(_c(birth_year).isNotNull(), (F.floor(years / width) * width).cast("int"))


def epoch_seconds(end: Column | str, start: Column | str) -> Column:
    """FN-09: ``extract(epoch from (end - start))`` as decimal seconds."""
    return (_c(end) - _c(start)).cast("decimal(18,6)")


def month_end(d: Column | str) -> Column:
    """FN-11: ``month_start + interval '1 month - 1 day'``."""
    return F.last_day(_c(d))


def date_series(lo: Column | str, hi: Column | str) -> Column:
    """FN-10: ``generate_series(lo, hi, 1 day)`` as an array of dates; empty when
    ``lo > hi`` (``sequence`` alone would count down)."""
    lo, hi = _c(lo), _c(hi)
    return F.when(lo <= hi, F.sequence(lo, hi)).otherwise(F.array().cast("array<date>"))


def two_digit_year(yy: Column, as_of_year: int) -> Column:
    """FN-16: century pivot for a two-digit year relative to ``as_of_year``:
    values up to the current two-digit year are 20xx, others 19xx."""
    pivot = as_of_year % 100
    return F.when(yy <= pivot, yy + 2000).otherwise(yy + 1900)


def birth_year_from_yymmdd(birth: Column | str, as_of_year: int) -> Column:
    """FN-16: ``birth ~ '^\\d{6}$'`` then the century pivot; anything else NULL."""
    b = _c(birth)
    yy = F.substring(b, 1, 2).cast("int")
    return F.when(b.rlike(r"^\d{6}$"), two_digit_year(yy, as_of_year))


def naive_to_instant(ts: Column | str, zone: str = "UTC") -> Column:
    """A naive wall-clock timestamp read in ``zone`` as an instant (TIMESTAMP),
    independent of the session time zone (a plain cast would use it)."""
    c = _c(ts)
    micros = F.second(c).cast("long") * 1000000 + F.date_format(c, "SSSSSS").cast("long")
    secs = (micros.cast("decimal(14,0)") / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(8,6)")
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            secs, F.lit(zone))


def instant_to_naive(ts: Column | str, zone: str = "UTC") -> Column:
    """Inverse of ``naive_to_instant``: the wall clock of an instant in ``zone``.
    (The instant is first rendered in the session zone, then converted from the
    session zone, so the session setting cancels out.)"""
    return F.convert_timezone(None, F.lit(zone), _c(ts))
