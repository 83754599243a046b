"""Expressions over tick columns: exact integer time, sentinels, flags, calendar."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from decimal import Decimal
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import UNDEF_TIMESTAMP

MINUTE_NS = 60 * 10**9
ZONE = "America/New_York"
#: Sessions whose source is known to be degraded.
DEGRADED = ("2024-09-18", "2025-09-17", "2025-09-24", "2025-11-28", "2026-03-16", "2026-04-10")
#: Fixed value: the name of a source file.
FILE_NAME = r"GC\.v\.0_(\d{4}-\d{2}-\d{2})_0700-1200_NY_mbp-1\.dbn\.zst"


def iso_date(text: str) -> date:
    """A date from YYYY-MM-DD and nothing else; ValueError otherwise."""
    if not isinstance(text, str) or not re.fullmatch(r"\d{4}-\d{2}-\d{2}", text):
        raise ValueError(f"not a YYYY-MM-DD date: {text!r}")
    return date.fromisoformat(text)


def is_iso_date(text: Column) -> Column:
    """Whether a string is a real YYYY-MM-DD date."""
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).isNotNull(), F.lit(False))


def session_bounds(day: str) -> tuple[int, int]:
    """The [07:00, 12:00) New York window of a day in UTC nanoseconds, on the driver."""
    at = datetime.combine(iso_date(day), datetime.min.time(), ZoneInfo(ZONE))
    return tuple(int(at.replace(hour=h).timestamp()) * 10**9 for h in (7, 12))


def bound_ns(day: Column, hour: int) -> Column:
    """An hour of a New York day in UTC nanoseconds."""
    local = day.cast("timestamp_ntz").cast("timestamp") + F.expr(f"INTERVAL {hour} HOURS")
    return F.unix_micros(F.to_utc_timestamp(local, ZONE)) * 1000


def wrap64(raw: Column) -> Column:
    """An unsigned 64-bit value as the signed value of the same bits."""
    return F.when(raw > F.lit(2**63 - 1), raw - F.lit(Decimal(2**64))).otherwise(raw).cast("long")


def is_undefined(raw: Column) -> Column:
    """Whether a raw timestamp is the sentinel."""
    return raw == F.lit(Decimal(UNDEF_TIMESTAMP))


def defined_ns(raw: Column) -> Column:
    """A raw timestamp as BIGINT: null for the sentinel, an error for any other value that does not fit."""
    return (
        F.when(is_undefined(raw), F.lit(None).cast("long"))
        .when(raw > F.lit(2**63 - 1), F.raise_error(F.concat(F.lit("timestamp does not fit 63 bits: "), raw.cast("string"))).cast("long"))
        .otherwise(raw.try_cast("long"))
    )


def floor_div(x: Column, by: int) -> Column:
    """Exact floor division of integers; Spark's own division truncates or goes through DOUBLE."""
    return F.call_function("div", x - F.pmod(x, F.lit(by)), F.lit(by).cast("long"))


def has_bit(flags: Column, bit: int) -> Column:
    return flags.bitwiseAND(F.lit(bit)) != 0


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """session_date_ny: the weekdays from ``first`` to ``last``, both included."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(iso_date(first)), F.lit(iso_date(last)))).alias("session_date_ny"))
    return days.where(F.weekday("session_date_ny") < 5)


def weekdays(first: date, last: date) -> list[date]:
    return [d for i in range((last - first).days + 1) if (d := first + timedelta(days=i)).weekday() < 5]


def degraded(day: Column) -> Column:
    return F.coalesce(day.cast("string").isin(*DEGRADED), F.lit(False))
