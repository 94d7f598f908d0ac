"""Dates, deadlines and time ranges."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import rules


#: Date, time, fraction and zone of an ISO 8601 text, with separators or without.
_ISO = r"^(\d{4})-?(\d{2})-?(\d{2})[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,9}))?)?)?(?:(Z)|([+-]\d{2})(?::?(\d{2}))?)$"


def zoned(c: Column) -> Column:
    """The instant of an ISO 8601 text (calendar dates, basic or extended) that names its zone, else null."""
    t = F.trim(c)
    part = lambda i: F.regexp_extract(t, _ISO, i)
    or_zero = lambda i: F.when(part(i) == "", F.lit("00")).otherwise(part(i))
    offset = F.when(part(8) == "Z", F.lit("+00:00")).otherwise(F.concat(part(9), F.lit(":"), or_zero(10)))
    fraction = F.when(part(7) == "", F.lit("")).otherwise(F.concat(F.lit("."), F.substring(part(7), 1, 6)))
    text = F.concat(F.concat_ws("-", part(1), part(2), part(3)), F.lit("T"), F.concat_ws(":", part(4), or_zero(5), or_zero(6)), fraction, offset)
    return F.when(t.rlike(_ISO), F.try_to_timestamp(text))


def deadline(c: Column) -> Column:
    """The timestamp of a date or an ISO time without zone or seconds; null for the string null and others."""
    return F.try_to_timestamp(F.when(c != "null", c))


def days_left(until: Column, as_of: Column) -> Column:
    return F.greatest(F.datediff(until, as_of), F.lit(0))


def overdue(status: Column, until: Column, as_of: Column) -> Column:
    return F.coalesce((status == "active") & (deadline(until) < as_of), F.lit(False))


def time_range(value: str | None, today: datetime.date) -> str | None:
    """The range of a search: the last days up to today (45d), two dates (A..B), or a word that the search knows.

    Blank and `none` set no limit; anything else, also two dates the wrong way round, is refused.
    """
    wanted = (value or "").strip()
    if wanted in {"", "none", *rules.TIME_RANGES}:
        return wanted if wanted in rules.TIME_RANGES else None
    if wanted[-1] == "d" and wanted[:-1].isdecimal():
        return _range(today - datetime.timedelta(days=int(wanted[:-1])), today)
    try:
        given = _range(*map(datetime.date.fromisoformat, wanted.split("..")))
    except (TypeError, ValueError) as e:
        raise ValueError(f"{wanted} is no time range") from e
    if given != wanted:
        raise ValueError(f"{wanted} is no time range")
    return given


def _range(first: datetime.date, last: datetime.date) -> str:
    if last < first:
        raise ValueError("a range ends before it begins")
    return f"{first}..{last}"


def stale(number: Column, publish_date: Column, until: Column, as_of: Column, years: int = 2) -> Column:
    """Whether a filing number's year is well before now and the page has no dates."""
    year = F.regexp_extract(number, r"((?:19|20)\d{2})", 1).try_cast("int")
    none = lambda c: F.coalesce(c, F.lit("null")) == "null"
    return F.coalesce((year <= F.year(as_of) - years) & none(publish_date) & none(until), F.lit(False))
