"""Date and time expressions. All of them give null where the text is no date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def long_date(text: Column) -> Column:
    """``21 September 2026 - 08:58 AM`` as a timestamp."""
    return F.try_to_timestamp(text, F.lit("d MMMM yyyy - hh:mm a"))


def loose_date(text: Column) -> Column:
    """Issue times with optional comma, ``Sept`` for ``Sep`` and either order of time and date."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(text), ",", " "), r"(?i)\bsept\b", "Sep")
    plain = F.regexp_replace(plain, r"\s+", " ")
    time_first = F.regexp_replace(plain, r"^(\d{1,2}:\d{2} [AaPp][Mm]) (.*)$", "$2 $1")
    return F.coalesce(F.try_to_timestamp(time_first, F.lit("d MMM yyyy h:mm a")), F.try_to_timestamp(time_first, F.lit("d MMMM yyyy h:mm a")))


def clock12(year: Column, month: Column, day: Column, hour: Column, minute: Column, half: Column) -> Column:
    """A 12-hour clock time as a timestamp; 12 AM is midnight."""
    hour24 = hour % 12 + F.when(F.upper(half) == "PM", 12).otherwise(0)
    fine = hour.between(1, 12) & minute.between(0, 59)
    return F.when(fine, F.try_to_timestamp(F.format_string("%04d-%02d-%02d %02d:%02d", year, month, day, hour24, minute), F.lit("yyyy-MM-dd HH:mm")))


def assumed_year(day: Column, month: Column, today: Column) -> Column:
    """A day without a year: this year's, or last year's if that lies more than two days ahead."""
    this = F.make_date(F.year(today), month, day)
    return F.when(F.datediff(this, today) > 2, F.add_months(this, -12)).otherwise(this)


def slot(at: Column, minutes: int = 10, back: int = 10) -> Column:
    """The start of the slot that ``back`` minutes before ``at`` lie in."""
    seconds = F.unix_timestamp(at.cast("timestamp")) - back * 60
    return F.timestamp_seconds(F.floor(seconds / (minutes * 60)) * (minutes * 60))


def valid_hours(text: Column, default: int = 3) -> Column:
    """The longest of all ``N to M hours``, ``N hours`` and ``an hour`` in a text, or ``default``."""
    counts = F.transform(F.regexp_extract_all(F.lower(text), F.lit(r"(?:\d+\s*to\s*)?(\d+|an)\s*hours?"), F.lit(1)), lambda x: F.when(x == "an", 1).otherwise(x.try_cast("int")))
    return F.coalesce(F.array_max(counts), F.lit(default))


def add_month(month: Column, k: int) -> Column:
    """``yyyy-MM`` moved by ``k`` months."""
    return F.date_format(F.add_months(F.to_date(F.concat(month, F.lit("-01"))), k), "yyyy-MM")


def age_minutes(then: Column, now: Column) -> Column:
    return F.floor((F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(then.cast("timestamp"))) / 60)


def local_time(utc: Column, offset: str = "+08:00") -> Column:
    """A UTC time as the local ISO text that row files hold, with its offset."""
    return F.concat(F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(offset), utc.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(offset))
