"""Times and dates. Text columns in, text or timestamp columns out.

Text follows the session time zone, which the package pins to UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the data model.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"

# The clickstream writes hours without a leading zero; one H reads both widths.
_LENIENT_TIME_FORMAT = "yyyy-MM-dd H:mm:ss"


def parse_time(text: Column | str) -> Column:
    """Timestamp of a text time; null when the text is not a time."""
    return F.try_to_timestamp(_col(text), F.lit(_LENIENT_TIME_FORMAT))


def format_time(ts: Column | str) -> Column:
    return F.date_format(_col(ts), TIME_FORMAT)


def format_date(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DATE_FORMAT)


def date_key(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DATE_KEY_FORMAT)


def minute_key(ts: Column | str) -> Column:
    return F.date_format(_col(ts), MINUTE_KEY_FORMAT)


def parse_date_key(text: Column | str) -> Column:
    """Date of a `yyyyMMdd` text; null when the text is not a date."""
    return F.to_date(F.try_to_timestamp(_col(text), F.lit(DATE_KEY_FORMAT)))


def date_hour(text: Column | str) -> Column:
    """`yyyy-MM-dd_H` of a text time. The hour keeps the width it was written with."""
    c = _col(text)
    clock = F.substring_index(F.substring_index(c, " ", 2), " ", -1)
    return F.concat(F.substring_index(c, " ", 1), F.lit("_"), F.substring_index(clock, ":", 1))


def is_before(a: Column | str, b: Column | str) -> Column:
    return parse_time(a) < parse_time(b)


def is_after(a: Column | str, b: Column | str) -> Column:
    return parse_time(a) > parse_time(b)


def seconds_between(end: Column | str, start: Column | str) -> Column:
    """Whole seconds from the text time `start` to the text time `end`."""
    return F.unix_seconds(parse_time(end)) - F.unix_seconds(parse_time(start))


def today(as_of: Column | None = None) -> Column:
    """Today as text; `as_of` fixes the day so that a result can be repeated."""
    return F.date_format(F.current_date() if as_of is None else as_of, DATE_FORMAT)


def yesterday(as_of: Column | None = None) -> Column:
    return F.date_format(F.date_sub(F.current_date() if as_of is None else as_of, 1), DATE_FORMAT)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
