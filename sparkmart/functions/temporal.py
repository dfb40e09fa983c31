"""Date and time functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: English names of months and weekdays, whole or cut
MONTHS = ("jan(?:uary)?", "feb(?:ruary)?", "mar(?:ch)?", "apr(?:il)?", "may", "june?", "july?", "aug(?:ust)?", "sept?(?:ember)?", "oct(?:ober)?", "nov(?:ember)?", "dec(?:ember)?")
WEEKDAYS = r"(?i)\b(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?\b\.?"
# orders of day D, month by number M or by name N, and year Y or, of two digits as well, y; the first that fits counts
ORDERS = ("NDy", "DNy", "YND", "NYD", "DYN", "YDN", "YMD", "mby", "DMy")
_CLASSES = {
    "D": r"(?<d>\d{1,2})", "M": r"(?<m>\d{1,2})", "N": r"#(?<m>\d{1,2})", "Y": r"(?<y>\d{4})", "y": r"(?<y>\d{4}|\d{2})",
    "m": "(?<m>0?[1-9]|1[0-2])", "b": r"(?<d>1[3-9]|[2-9]\d)",  # a month, and a day that can't be one
}
# a time of day at the end: hour, minute, second, half of the day, zone
_CLOCK = r"(?i)[ T,]+(\d{1,2}):(\d{2})(?::(\d{2}(?:\.\d{1,6})?)\d*)?(?: ?([ap])\.?m\.?)?(?: ?(z|utc|gmt|[+-]\d{2}(?::?\d{2})?))?$"
DATE_NAME_PARTS = ("date", "timestamp")


def _text(column: Column) -> Column:
    return F.regexp_replace(F.trim(column), r"\s+", " ")


def _day(text: Column) -> Column:
    """The date of a text, by the classes of its tokens.

    Weekdays are passed over. A month by name leaves a day and a year, the year being the one of four digits or the
    last; without a name a first number of four digits is a year, else the order is day, month, year, and month, day,
    year where only that gives a month. Each step rewrites the text, so the expression stays small.
    """
    rest = F.regexp_replace(F.regexp_replace(text, _CLOCK, ""), WEEKDAYS, " ")
    rest = F.regexp_replace(rest, r"(?i)(\d)(?:st|nd|rd|th)\b", "$1")
    for number, name in enumerate(MONTHS, 1):
        rest = F.regexp_replace(rest, rf"(?i)\b(?:{name})\b\.?", f"#{number}")
    rest = F.regexp_replace(rest, r"^[ ,]*(\d{4})(\d{2})(\d{2})[ ,]*$", "=$1-$2-$3")
    for order in ORDERS:
        shape = "[ ,./-]+".join(_CLASSES[token] for token in order)
        rest = F.regexp_replace(rest, f"^[ ,]*{shape}[ ,]*$", "=${y}-${m}-${d}")
    rest = F.regexp_replace(F.regexp_replace(rest, r"^=([0-5]\d|6[0-8])-", "=20$1-"), r"^=(69|[7-9]\d)-", "=19$1-")
    return F.try_to_date(rest, "=yyyy-M-d").cast("date")


def parse_day_first(column: str | Column) -> Column:
    """Parse a date text, reading ambiguous values day first; what is no date is NULL.

    Two-digit years 69 to 99 are of the last century. A time of day and its zone are left out, the day stays as written.
    """
    return _day(_text(F.col(column) if isinstance(column, str) else column))


def parse_timestamp(column: str | Column) -> Column:
    """The same with the time of day, midnight if there is none; an impossible time gives NULL.

    A time with a zone or an offset is moved to UTC.
    """
    text = _text(F.col(column) if isinstance(column, str) else column)
    hour, minute, second, half, zone = (F.regexp_extract(text, _CLOCK, i) for i in (1, 2, 3, 4, 5))
    number = hour.try_cast("int")
    clock = F.when(half == "", number).when(number.between(1, 12), number % 12 + F.when(F.lower(half) == "p", 12).otherwise(0))
    time = F.when(hour == "", "00:00:00").otherwise(F.concat_ws(":", F.coalesce(clock, F.lit(99)), minute, F.when(second == "", "00").otherwise(second)))
    local = F.concat_ws(" ", F.date_format(_day(text), "yyyy-MM-dd"), time).try_cast("timestamp_ntz")
    part = lambda i: F.coalesce(F.regexp_extract(zone, r"^[+-](\d{2}):?(\d{2})?$", i).try_cast("int"), F.lit(0))
    shift = F.when(zone.startswith("-"), -1).otherwise(1) * (part(1) * 60 + part(2))
    return local - F.make_dt_interval(mins=shift)


def is_date_name(name: str) -> bool:
    return any(part in name.lower() for part in DATE_NAME_PARTS)


def coerce_dates(df: DataFrame) -> DataFrame:
    """Turn text columns whose name contains 'date' or 'timestamp' into timestamps, bad values into NULL."""
    changed = {
        f.name: parse_timestamp(F.col(f"`{f.name}`"))
        for f in df.schema.fields
        if is_date_name(f.name) and isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(changed) if changed else df


def date_parts(column: Column) -> dict[str, Column]:
    return {"day": F.dayofmonth(column), "month": F.month(column), "year": F.year(column)}


def floor_to_second(column: str | Column) -> Column:
    return F.date_trunc("second", column)


def floor_to_minute(column: str | Column) -> Column:
    return F.date_trunc("minute", column)


def shift_zone_minus_day(column: Column, zone: str = "Asia/Jakarta") -> Column:
    """UTC time shown in ``zone``, one day earlier, as ``YYYY-MM-DD HH:MM:SS`` text."""
    return F.date_format(F.from_utc_timestamp(column, zone) - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd HH:mm:ss")


def parse_minus_day(column: str | Column, fmt: str) -> Column:
    """Parse a timestamp text with ``fmt`` and go one day back."""
    return F.try_to_timestamp(column, F.lit(fmt)) - F.expr("INTERVAL 1 DAY")


def interval_labels(start: Column, end: Column) -> dict[str, Column]:
    """The labels of a data interval: its day, its ISO start and its two bounds."""
    iso = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
    return {
        "ds": F.date_format(start, "yyyy-MM-dd"),
        "ts_label": F.date_format(start, iso),
        "interval_start": F.date_format(start, iso),
        "interval_end": F.date_format(end, iso),
    }


def even_minute(column: str | Column) -> Column:
    return F.minute(column) % 2 == 0


def epoch_micros(column: str) -> Column:
    """Microseconds since the epoch of a timestamp without zone, independent of the session zone."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(`{column}` AS TIMESTAMP_NTZ))")
