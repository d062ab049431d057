"""Date and time expressions. All are built-in Spark expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

from casewright.functions.base import as_column

_DAY_MICROS = 86_400_000_000


def elapsed_days(start, end) -> Column:
    """Whole days between two instants, floored (minus 1.5 days gives -2)."""
    micros = F.timestamp_diff("MICROSECOND", as_column(start), as_column(end))
    return F.floor(micros / F.lit(float(_DAY_MICROS))).cast("bigint")


def fractional_days(start, end) -> Column:
    micros = F.timestamp_diff("MICROSECOND", as_column(start), as_column(end))
    return micros / F.lit(float(_DAY_MICROS))


def calendar_days(start, end) -> Column:
    """Difference of the two calendar dates, time of day ignored."""
    return F.datediff(as_column(end), as_column(start)).cast("bigint")


def day_start(instant) -> Column:
    return F.date_trunc("day", as_column(instant)).cast("timestamp_ntz")


def from_epoch_millis(millis) -> Column:
    """Naive UTC wall time of an epoch-millisecond number.

    Built from a fixed epoch so that the session time zone plays no part.
    """
    return F.timestamp_add("MILLISECOND", as_column(millis), ntz("1970-01-01 00:00:00"))


def weekday_name(instant) -> Column:
    return F.date_format(as_column(instant), "EEEE")


def month_name(instant) -> Column:
    return F.date_format(as_column(instant), "MMMM")


def ntz(value: str | datetime) -> Column:
    """Timestamp literal without time zone from a string or datetime."""
    return F.lit(str(value)).cast("timestamp_ntz")


def instant(value: Column | str | datetime) -> Column:
    """A point in time given as a column, or as text or datetime without time zone."""
    return value if isinstance(value, Column) else ntz(value)


def days_before(now: Column | str | datetime, days: int) -> Column:
    """The instant ``days`` days before ``now``."""
    return F.timestamp_add("DAY", F.lit(-days), instant(now))


def local_to_utc(naive, zone: str) -> Column:
    """UTC wall time of a naive timestamp that was taken in ``zone``."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), as_column(naive))


# --- lax parsing of source strings ------------------------------------------------------

#: Full date and time in the usual form; read by the built-in cast.
_USUAL = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}$"
#: ISO dates and date-times, extended or compact in either part. Groups: year, month and
#: day (2), hour, then minute, second and fraction (2), offset.
_ISO = (
    r"^(\d{4})(?:-(\d{2})-(\d{2})|(\d{2})(\d{2}))"
    r"(?:.(\d{2})(?::(\d{2})(?::(\d{2})(?:[.,](\d+))?)?|(\d{2})(?:(\d{2})(?:[.,](\d+))?)?)?"
    r"(Z|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?)?)?$"
)
_PARTS = "$1-$2$4-$3$5|$6|$7$10|$8$11|$9$12|$13"
_ONE_DIGIT = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}$"
_ACTION = r"^\s*(\d{1,2})-([A-Za-z]{3})-(\d{4})\s+(\d{1,2}):(\d{1,2})\s+([AaPp][Mm])\s*$"

# --- Fixed values: English month abbreviations ---
_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


def parse_iso(text) -> Column:
    """ISO date or date-time as a naive timestamp; anything else gives null.

    Date and time are each extended (``2024-06-01``, ``12:00:00``) or compact
    (``20240601``, ``120000``), with any one separator character; minutes, seconds, fraction
    (cut to microseconds) and offset (``Z``, ``+05``, ``+0530``, ``+05:30``, with seconds)
    may be left out. One-digit parts are read in a full ``2024-6-1T1:2:3``. An offset is
    subtracted, so the result is UTC wall time whatever the session zone. Not read: week
    dates (``2024-W22-6``), ordinal dates and hour 24.
    """
    text = as_column(text)
    parts = F.split(F.regexp_replace(text, _ISO, _PARTS), r"\|")

    def part(i: int) -> Column:
        return F.try_element_at(parts, F.lit(i))

    def two(i: int) -> Column:
        return F.when(part(i) == "", F.lit("00")).otherwise(part(i))

    micros = F.rpad(F.substring(part(5), 1, 6), 6, "0")
    wall = F.concat(part(1), F.lit(" "), two(2), F.lit(":"), two(3), F.lit(":"), two(4), F.lit("."), micros)
    digits = F.rpad(F.substring(F.regexp_replace(part(6), "[Z:+-]", ""), 1, 6), 6, "0")
    seconds = sum(
        F.substring(digits, at, 2).cast("int") * weight for at, weight in ((1, 3600), (3, 60), (5, 1))
    )
    seconds = F.when(F.startswith(part(6), F.lit("-")), -seconds).otherwise(seconds)
    naive = F.timestamp_add("SECOND", -seconds, wall.try_cast("timestamp_ntz"))
    return (
        F.when(text.rlike(_USUAL) | text.rlike(_ONE_DIGIT), text.try_cast("timestamp_ntz"))
        .when(text.rlike(_ISO), naive)
    )


def _pick(text: Column, group: int) -> Column:
    return F.regexp_extract(text, _ACTION, group)


def parse_action_time(text, fix_meridiem: bool = False) -> Column:
    """ISO text, else ``dd-Mon-yyyy HH:MM AM`` with the AM/PM mark ignored.

    The source mixes 24-hour clocks with AM/PM marks and published results ignore the
    mark. ``fix_meridiem=True`` honours it for hours up to 12 instead.
    """
    text = as_column(text)
    month = F.array_position(F.lit(list(_MONTHS)), F.lower(_pick(text, 2)))
    hour = _pick(text, 4).try_cast("int")
    if fix_meridiem:
        mark = F.lower(_pick(text, 6))
        hour = (
            F.when((mark == "pm") & (hour < 12), hour + 12)
            .when((mark == "am") & (hour == 12), F.lit(0))
            .otherwise(hour)
        )
    stamp = F.concat(
        _pick(text, 3), F.lit("-"),
        F.lpad(month.cast("string"), 2, "0"), F.lit("-"),
        F.lpad(_pick(text, 1), 2, "0"), F.lit(" "),
        F.lpad(hour.cast("string"), 2, "0"), F.lit(":"),
        F.lpad(_pick(text, 5), 2, "0"), F.lit(":00"),
    )
    return F.coalesce(parse_iso(text), F.when(text.rlike(_ACTION), stamp.try_cast("timestamp_ntz")))
