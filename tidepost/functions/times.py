"""Post dates, epochs and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepost import rules

# Zone names that are dropped, and the form of a post date without weekday and zone.
ZONE_NAMES = "PDT|UTC|PST|EST|CST"
DATE_FORM = "MMM dd HH:mm:ss yyyy"
ZONED_DATE_FORM = "MMM dd HH:mm:ss z yyyy"


def parse_post_date(date: Column, convert_zone: bool = False) -> Column:
    """``Mon May 11 03:17:40 UTC 2009`` -> timestamp; null where it cannot be read.

    The zone name is dropped by default; ``convert_zone`` shifts the time by it instead.
    The weekday is cut off first because Spark does not parse weekday names.
    """
    plain = F.regexp_replace(date, r"^\s*\p{L}{3}\s+", "")
    if convert_zone:
        return F.try_to_timestamp(plain, F.lit(ZONED_DATE_FORM))
    plain = F.regexp_replace(plain, rf"\s*({ZONE_NAMES})\s*", " ")
    return F.try_to_timestamp(plain, F.lit(DATE_FORM))


def post_timestamp(date: Column, convert_zone: bool = False) -> Column:
    """As :func:`parse_post_date`, with a fixed timestamp in place of null."""
    fallback = F.to_timestamp(F.lit(rules.FALLBACK_TIMESTAMP))
    return F.coalesce(parse_post_date(date, convert_zone), fallback)


def lenient_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)
