"""From native records to the stored table: sentinels, exact offsets, contract columns, and the check that they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import MINUTE_NS, ZONE, bound_ns, defined_ns, floor_div
from ..schema import NATIVE_COLUMNS, TABLE_NOTES
from .order import with_roll_segment

ADDED = ["ts_event_ns", "ts_recv_ns", "ts_event_ny", "ns_from_0700", "minute_from_0700", "contract_change", "roll_segment"]


def with_times(ticks: DataFrame) -> DataFrame:
    """ts_*_ns (null for the sentinel), the New York wall clock, and the offset from 07:00 in ns and whole minutes.

    Offsets before 07:00 stay negative, and minutes are floored.
    """
    found = ticks.withColumns({"ts_event_ns": defined_ns(F.col("ts_event_raw")), "ts_recv_ns": defined_ns(F.col("ts_recv_raw"))})
    micros = floor_div(F.col("ts_event_ns"), 1000)
    found = found.withColumn("ts_event_ny", F.from_utc_timestamp(F.timestamp_micros(micros), ZONE).cast("timestamp_ntz"))
    found = found.withColumn("ns_from_0700", F.col("ts_event_ns") - bound_ns(F.col("session_date_ny"), 7))
    return found.withColumn("minute_from_0700", floor_div(F.col("ns_from_0700"), MINUTE_NS))


def normalize(ticks: DataFrame, incoming_segment: int = 1, incoming_id: int | None = None) -> DataFrame:
    """The stored table: session and place, native fields, additive columns; the notes go with the first column."""
    found = with_times(with_roll_segment(ticks, incoming_segment, incoming_id))
    noted = F.col("session_date_ny").alias("session_date_ny", metadata=TABLE_NOTES)
    return found.select(noted, "event_idx_day", *NATIVE_COLUMNS, *ADDED)


def differing_rows(stored: DataFrame, incoming_segment: int = 1, incoming_id: int | None = None) -> DataFrame:
    """The stored rows whose additive columns are not what their native fields give; ``differs`` names the columns."""
    fresh = normalize(stored.select("session_date_ny", "event_idx_day", *NATIVE_COLUMNS), incoming_segment, incoming_id)
    fresh = fresh.select("session_date_ny", "event_idx_day", *(F.col(c).alias(f"new_{c}") for c in ADDED))
    both = stored.join(fresh, ["session_date_ny", "event_idx_day"], "left")
    wrong = F.filter(F.array(*(F.when(~F.col(c).eqNullSafe(F.col(f"new_{c}")), F.lit(c)) for c in ADDED)), lambda x: x.isNotNull())
    return both.select("session_date_ny", "event_idx_day", wrong.alias("differs")).where(F.size("differs") > 0)
