"""Delivery order: the row before, contract changes, roll segments, contiguity.

A session's rows are dealt over slices of ``SLICE`` places, each slice with the row before it, so no window ever holds
a whole session, let alone the whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = 1 << 20


def with_previous(ticks: DataFrame, columns: list[str], size: int = SLICE) -> DataFrame:
    """``ticks`` with prev_<column> of the row before in the same session (null on a session's first row).

    The last row of a slice is also sent to the next one, where it only serves as a predecessor.
    """
    slice_ = F.col("event_idx_day").cast("long") / F.lit(size)
    own = F.floor(slice_).cast("long")
    ends = F.pmod("event_idx_day", F.lit(size)) == size - 1
    dealt = ticks.withColumn("slice_", F.explode(F.when(ends, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy("session_date_ny", "slice_").orderBy("event_idx_day")
    found = dealt.withColumns({f"prev_{c}": F.lag(c).over(w) for c in columns})
    return found.where(F.col("slice_") == own).drop("slice_")


def boundaries(ticks: DataFrame) -> DataFrame:
    """session_date_ny, first_id, last_id, before_id: each session with the id that the session before ended on."""
    ends = ticks.groupBy("session_date_ny").agg(F.min_by("instrument_id", "event_idx_day").alias("first_id"), F.max_by("instrument_id", "event_idx_day").alias("last_id"))
    # one row a session: a few thousand in a decade
    return ends.withColumn("before_id", F.lag("last_id").over(Window.orderBy("session_date_ny")))


def with_contract_change(ticks: DataFrame, incoming_id: int | None = None) -> DataFrame:
    """``ticks`` with contract_change: the instrument differs from the row delivered before, across sessions.

    ``incoming_id``: the instrument that an earlier part of the table ended on.
    """
    edges = boundaries(ticks).select("session_date_ny", F.coalesce("before_id", F.lit(incoming_id).cast("long")).alias("before_"))
    found = with_previous(ticks, ["instrument_id"]).join(edges, "session_date_ny")
    before = F.coalesce("prev_instrument_id", F.when(F.col("event_idx_day") == 0, F.col("before_")))
    return found.withColumn("contract_change", F.coalesce(F.col("instrument_id") != before, F.lit(False))).drop("before_", "prev_instrument_id")


def with_roll_segment(ticks: DataFrame, incoming_segment: int = 1, incoming_id: int | None = None, size: int = SLICE) -> DataFrame:
    """``ticks`` with contract_change and roll_segment, the running number of changes over the whole table.

    Changes are counted by slice, the counts are added up over slices (a row each), then inside each slice.
    """
    changed = with_contract_change(ticks, incoming_id)
    own = F.floor(F.col("event_idx_day").cast("long") / F.lit(size)).cast("long")
    sliced = changed.withColumn("slice_", own)
    counts = sliced.groupBy("session_date_ny", "slice_").agg(F.count_if("contract_change").alias("changes_"))
    order = Window.orderBy("session_date_ny", "slice_").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("session_date_ny", "slice_", F.coalesce(F.sum("changes_").over(order), F.lit(0)).alias("start_"))
    inside = Window.partitionBy("session_date_ny", "slice_").orderBy("event_idx_day").rowsBetween(Window.unboundedPreceding, 0)
    running = sliced.withColumn("here_", F.sum(F.col("contract_change").cast("long")).over(inside))
    joined = running.join(starts, ["session_date_ny", "slice_"])
    return joined.withColumn("roll_segment", F.lit(incoming_segment) + F.col("start_") + F.col("here_")).drop("slice_", "start_", "here_")


def outgoing_state(ticks: DataFrame, incoming_segment: int = 1, incoming_id: int | None = None) -> dict[str, int | None]:
    """What the next part of the table starts from: the last instrument and the last roll segment."""
    row = with_roll_segment(ticks, incoming_segment, incoming_id).agg(F.max_by(F.struct("instrument_id", "roll_segment"), F.struct("session_date_ny", "event_idx_day")).alias("x")).first()
    return {"last_id": row["x"]["instrument_id"], "roll_segment": row["x"]["roll_segment"]} if row["x"] else {"last_id": incoming_id, "roll_segment": incoming_segment}


def contract_segments(ticks: DataFrame) -> DataFrame:
    """The first row of each session and every row where the contract changes."""
    rows = with_roll_segment(ticks).where((F.col("event_idx_day") == 0) | F.col("contract_change"))
    return rows.select("session_date_ny", "event_idx_day", "instrument_id", "roll_segment", "contract_change", F.col("ts_recv_raw").alias("ts_recv_raw"))


def roll_segment_summary(segments: DataFrame) -> DataFrame:
    """One row a segment: its first row, its last session, and whether its instrument was seen in an earlier segment."""
    place = F.struct("session_date_ny", "event_idx_day")
    first = lambda c: F.min_by(c, place)
    found = segments.groupBy("roll_segment").agg(
        first("instrument_id").alias("instrument_id"),
        F.min("session_date_ny").alias("first_session"),
        first("event_idx_day").alias("first_event_idx_day"),
        first("contract_change").alias("contract_change"),
        F.max("session_date_ny").alias("last_session"),
    )
    again = F.row_number().over(Window.partitionBy("instrument_id").orderBy("roll_segment")) > 1
    return found.withColumn("previously_observed_id", again)


def segment_transitions(segments: DataFrame) -> DataFrame:
    """Each segment after the first with the instrument before it."""
    w = Window.orderBy("roll_segment")
    found = roll_segment_summary(segments).select("roll_segment", "instrument_id", "first_session", F.lag("instrument_id").over(w).alias("from_instrument_id"))
    return found.where("from_instrument_id is not null")


def index_contiguity(ticks: DataFrame) -> DataFrame:
    """session_date_ny, records, contiguous: the places are exactly 0 to n - 1."""
    n = F.count(F.lit(1))
    whole = (F.min("event_idx_day") == 0) & (F.max("event_idx_day") == n - 1) & (F.countDistinct("event_idx_day") == n)
    return ticks.groupBy("session_date_ny").agg(n.alias("records"), whole.alias("contiguous"))


def require(found: DataFrame, wrong: Column, message: str) -> None:
    """ValueError if any row is ``wrong``; the first such row is named."""
    row = found.where(wrong).limit(1).collect()
    if row:
        raise ValueError(f"{message}: {row[0].asDict()}")
