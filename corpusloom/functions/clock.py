"""Time stamps of run logs and file listings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "Europe/Istanbul"
# The zone's clock has been +03 without daylight saving since this instant;
# before it the abbreviations were EET (two hours) and EEST (three hours).
_ISTANBUL_FIXED_SINCE = "2016-09-06T21:00:00Z"

# A full date, alone or followed by a time; shorter forms are not times of a listing.
_DATED = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ].+)?\z"


def parse_stamp(col: Column) -> Column:
    """``20240131_235959`` to a timestamp, null when malformed."""
    return F.try_to_timestamp(col, F.lit("yyyyMMdd_HHmmss"))


def format_stamp(col: Column) -> Column:
    return F.date_format(col, "yyyyMMdd_HHmmss")


def _offset_label(minutes: Column) -> Column:
    sign = F.when(minutes < 0, "-").otherwise("+")
    hours = F.lpad((F.abs(minutes) / 60).cast("int").cast("string"), 2, "0")
    rest = F.abs(minutes) % 60
    tail = F.when(rest == 0, "").otherwise(F.lpad(rest.cast("string"), 2, "0"))
    return F.concat(sign, hours, tail)


def _once(value: Column, made: Callable[[Column], Column]) -> Column:
    """``made(value)`` with the value worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), made), F.lit(0))


def local_time(col: Column, zone: str = DEFAULT_ZONE) -> Column:
    """ISO-8601 text to ``yyyy-MM-dd HH:mm:ss <zone>``; unparsable text passes through, null is ''.

    Text without an offset is read in the session time zone.
    """

    def wall_clock(instant: Column) -> Column:
        # Wall clocks without a zone: nothing here is rendered in the session's zone.
        seconds = F.unix_seconds(instant).cast("decimal(18,6)")
        return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)

    def labelled(instant: Column, local: Column, apart: Column) -> Column:
        minutes = (F.extract(F.lit("HOUR"), apart) * 60 + F.extract(F.lit("MINUTE"), apart)).cast("int")

        def label(m: Column) -> Column:
            if zone != DEFAULT_ZONE:
                return _offset_label(m)
            old = F.when(m == 120, "EET").otherwise("EEST")
            return F.when(instant < F.lit(_ISTANBUL_FIXED_SINCE).cast("timestamp"), old).otherwise(_offset_label(m))

        return F.concat(F.substring(local.cast("string"), 1, 19), F.lit(" "), _once(minutes, label))

    def shown(instant: Column) -> Column:
        return _once(
            wall_clock(instant),
            lambda utc: _once(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc), lambda local: labelled(instant, local, local - utc)),
        )

    parsed = F.when(col.rlike(_DATED), F.try_to_timestamp(col))
    return F.when(col.isNull() | (col == ""), "").otherwise(F.coalesce(_once(parsed, shown), col))
