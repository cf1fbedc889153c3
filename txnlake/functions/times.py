"""Dates and timestamps. Sessions run with the time zone set to UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms of a datetime. The first needs no rewriting
# before the cast: an offset there always follows seconds.
_ISO_PLAIN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?)?)?\z"
)
_ISO_LAX = (
    r"^(\d{4}-\d{2}-\d{2})[Tt _](\d{2}:\d{2})(:\d{2}(?:\.\d{1,6})?)?\d*"
    r"(?:([Zz])|([+-]\d{2}):?(\d{2}))?\z"
)
_EPOCH = r"^[+-]?\d{1,20}(\.\d+)?\z"

# Fixed value: epoch numbers up to here are seconds, above it milliseconds.
_EPOCH_SECONDS_MAX = 20_000_000_000


def date_key(event_time: Column) -> Column:
    """UTC calendar date."""
    return F.to_date(event_time)


def iso_date(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def to_utc(text: Column) -> Column:
    """Parse ISO text or an epoch number; text without an offset is UTC.

    The pattern comes before the cast because the cast alone also takes words
    such as `now` and bare times. Null when the text is no datetime.
    """
    part = lambda i: F.regexp_extract(text, _ISO_LAX, i)
    seconds_part = F.when(part(3) != "", part(3)).otherwise(":00")
    offset = F.when(part(5) != "", F.concat(part(5), F.lit(":"), part(6))).otherwise("Z")
    rewritten = F.concat(part(1), F.lit(" "), part(2), seconds_part, offset)
    number = text.try_cast("decimal(38,9)")
    seconds = F.when(F.abs(number) <= _EPOCH_SECONDS_MAX, number).otherwise(number / 1000)
    micros = F.floor(seconds * 1_000_000).try_cast("bigint")
    # Outside years 1 to 9999 there is no such datetime.
    in_range = micros.between(-62_135_596_800_000_000, 253_402_300_799_999_999)
    return (
        F.when(text.rlike(_ISO_PLAIN), text.try_cast("timestamp"))
        .when(text.rlike(_ISO_LAX), rewritten.try_cast("timestamp"))
        .when(text.rlike(_EPOCH), F.when(in_range, F.timestamp_micros(micros)))
    )
