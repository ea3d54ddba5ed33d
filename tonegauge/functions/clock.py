"""Dates from epoch seconds. All of them ignore the session time zone."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# Shape of a full date and time as accepted by the live trend.
_DATE_TIME = r"^(\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{1,2}:\d{1,2})$"


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a TIMESTAMP_NTZ column."""
    days = F.unix_date(ts.cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def event_date(time: Column) -> Column:
    """UTC calendar date of epoch seconds; null where the value is not a whole number or out of range."""
    days = F.floor(time.try_cast("bigint") / 86400)
    return F.date_from_unix_date(days.try_cast("int"))


def event_time(time: Column) -> Column:
    """UTC date and time of epoch seconds as ``yyyy-MM-dd HH:mm:ss`` text."""
    seconds = time.try_cast("bigint").try_cast("decimal(18,6)")
    return (F.expr(_EPOCH) + F.make_dt_interval(secs=seconds)).cast("string")


def parsed_date(text: Column) -> Column:
    """Date from the first 19 characters of ``Y-m-d H:M:S`` or ``Y-m-dTH:M:S`` text, else null."""
    whole = F.regexp_extract(F.substring(F.trim(text), 1, 19), _DATE_TIME, 1)
    return whole.try_cast("timestamp_ntz").cast("date")


def month_label(date: Column) -> Column:
    """``Oct'12``."""
    return F.date_format(date, "MMM''yy")


def month_start(year: Column, month: Column) -> Column:
    """First day of a month; null for a month that does not exist."""
    return F.concat(year.cast("string"), F.lit("-"), month.cast("string"), F.lit("-1")).try_cast("date")
