"""Lenient parsing of dates, timestamps and load references."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def br_date(c: Column) -> Column:
    """``dd/MM/yyyy`` text to date; anything else (also impossible days) is null."""
    return F.try_to_date(c, "dd/MM/yyyy")


def iso_date(c: Column) -> Column:
    return c.try_cast("date")


def to_int(c: Column) -> Column:
    return c.try_cast("int")


def br_timestamp(c: Column) -> Column:
    """``dd/MM/yyyy HH:mm:ss`` text (a fraction may follow) to a timestamp without zone, else null.

    The text is rearranged to ISO and cast, so that the session time zone plays no part.
    """
    shape = r"^(\d{2})/(\d{2})/(\d{4}) (\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)$"
    iso = F.when(c.rlike(shape), F.regexp_replace(c, shape, "$3-$2-$1 $4"))
    return iso.try_cast("timestamp_ntz")


def counter_timestamp(c: Column, marker: str = "desde") -> Column:
    """Time shown after ``marker``: the part up to the next marker, without blanks and commas."""
    after = F.get(F.split(c, marker), F.lit(1))
    return br_timestamp(F.trim(F.replace(F.trim(after), F.lit(","), F.lit(""))))


def monthly_ref(day: Column, explicit: Column | None = None) -> Column:
    """Load reference of the monthly feed: the given one, else the month 30 days before ``day``."""
    default = F.date_format(F.date_sub(day, 30), "yyyy-MM")
    return default if explicit is None else _explicit_or(explicit, default)


def daily_ref(day: Column, explicit: Column | None = None) -> Column:
    """Load reference of the daily feed: the given one, else ``day`` itself."""
    default = F.date_format(day, "yyyyMMdd")
    return default if explicit is None else _explicit_or(explicit, default)


def _explicit_or(explicit: Column, default: Column) -> Column:
    return F.when(F.trim(explicit) != "", explicit).otherwise(default)


def scheduled_ref(feed: str, today: date, explicit: str = "") -> str:
    """The same for a scheduler, as text: ``feed`` is ``monthly`` or ``daily``."""
    if explicit.strip():
        return explicit.strip()
    if feed == "monthly":
        return (today - timedelta(days=30)).strftime("%Y-%m")
    return today.strftime("%Y%m%d")
