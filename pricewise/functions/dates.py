"""Sale-time parsing and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday and month abbreviations accepted in sale-time text
WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
_SUFFIX = r" \([A-Z]{3}\)$"
_WEEKDAY = r"^(?i:" + "|".join(WEEKDAYS) + r") "


def parse_sale_time(col: Column) -> Column:
    """'Tue Dec 16 2014 12:30:00 GMT-0800 (PST)' -> UTC timestamp, bad -> null.

    The weekday must be one of the seven names but, as with strptime, it is
    not checked against the date; names may have any letter case and day and
    time parts one digit. Spark refuses the pattern letter E when
    parsing, so the token is checked by regex and cut off first.
    """
    s = F.regexp_replace(col, _SUFFIX, "")
    ok = s.rlike(_WEEKDAY)
    body = F.regexp_replace(s, _WEEKDAY, "")
    ts = F.try_to_timestamp(body, F.lit("MMM d yyyy H:m:s 'GMT'Z"))
    return F.when(ok, ts)


def utc_text(ts: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss+0000' text of a timestamp (session zone is UTC)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ssxx")


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_start(ym: Column) -> Column:
    """'yyyy-MM' -> first day of the month as a date."""
    return F.to_date(F.concat(ym, F.lit("-01")))
