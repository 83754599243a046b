"""What is made from audits and ordered rows: gaps, activity flags, clocks, examples, totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ticks import bound_ns, is_undefined, wrap64
from .audit import GAP_NS, RECV_STEP, status
from .order import require, with_previous

HISTORY, NEEDED, LOW, HIGH = 20, 10, 0.1, 10


def coverage_gaps(ticks: DataFrame, audit: DataFrame | None = None) -> DataFrame:
    """Stretches of over 60 s without a record: before the first, after the last, and between two rows.

    With an ``audit`` the internal gaps are counted against it; ValueError if they differ.
    """
    day = F.col("session_date_ny")
    ends = ticks.groupBy("session_date_ny").agg(
        F.min_by("ts_recv_raw", "event_idx_day").alias("first_"), F.max_by("ts_recv_raw", "event_idx_day").alias("last_"), F.count(F.lit(1)).alias("n_")
    )
    ends = ends.withColumns({"start_": bound_ns(day, 7).cast("decimal(20,0)"), "end_": bound_ns(day, 12).cast("decimal(20,0)")})
    no_id = F.lit(None).cast("long").alias("instrument_id")
    leading = ends.where(f"first_ - start_ > {GAP_NS}").select(day, F.lit("leading").alias("kind"), F.col("start_").alias("left_recv_ns"), F.col("first_").alias("right_recv_ns"), F.lit(0).cast("long").alias("right_event_idx_day"), no_id)
    trailing = ends.where(f"end_ - last_ > {GAP_NS}").select(day, F.lit("trailing").alias("kind"), F.col("last_").alias("left_recv_ns"), F.col("end_").alias("right_recv_ns"), F.col("n_").alias("right_event_idx_day"), no_id)
    steps = with_previous(ticks, ["ts_recv_raw"]).where(F.expr(f"{RECV_STEP} > {GAP_NS}"))
    internal = steps.select(day, F.lit("internal").alias("kind"), F.col("prev_ts_recv_raw").alias("left_recv_ns"), F.col("ts_recv_raw").alias("right_recv_ns"), F.col("event_idx_day").alias("right_event_idx_day"), "instrument_id")
    if audit is not None:
        told = audit.select("session_date_ny", F.coalesce(F.try_element_at("checks", F.lit("recv_gap_over_60s")), F.lit(0)).alias("told"))
        counted = internal.groupBy("session_date_ny").agg(F.count(F.lit(1)).alias("counted"))
        both = told.join(counted, "session_date_ny", "full_outer")
        require(both, F.coalesce("told", F.lit(0)) != F.coalesce("counted", F.lit(0)), "internal gaps differ from the audit")
    return leading.unionByName(trailing).unionByName(internal).withColumn("duration_ns", F.col("right_recv_ns") - F.col("left_recv_ns"))


def activity_flags(sessions: DataFrame, columns: tuple[str, ...] = ("record_count", "trade_volume")) -> DataFrame:
    """``sessions`` with <column>_median and <column>_outlier.

    The median of the HISTORY nonempty sessions before, if there are NEEDED; an outlier is under LOW or over HIGH times
    it. Empty sessions are tested but are no history. The frame counts nonempty sessions, so it is a range, not rows.
    """
    # one row a session: a few thousand in a decade, so one ordered window over them is small
    order = Window.orderBy("session_date_ny")
    before = F.coalesce(F.sum((F.col("record_count") > 0).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    found = sessions.withColumn("before_", before)
    frame = Window.orderBy("before_").rangeBetween(-HISTORY, -1)
    for c in columns:
        history = F.when(F.col("record_count") > 0, F.col(c))
        median = F.when(F.col("before_") >= NEEDED, F.percentile(history, 0.5).over(frame))
        found = found.withColumn(f"{c}_median", median)
        odd = (F.col(f"{c}_median") > 0) & ((F.col(c) < LOW * F.col(f"{c}_median")) | (F.col(c) > HIGH * F.col(f"{c}_median")))
        found = found.withColumn(f"{c}_outlier", F.coalesce(odd, F.lit(False)))
    return found.drop("before_")


def with_activity(audit: DataFrame) -> DataFrame:
    """The audit with activity outliers among its warnings and its status told anew.

    A flagged session that passed all else keeps the word PASS before WARNING.
    """
    flagged = activity_flags(audit)
    extra = F.filter(F.array(*(F.when(F.col(f"{c}_outlier"), F.lit(f"{c}_outlier")) for c in ("record_count", "trade_volume"))), lambda x: x.isNotNull())
    known = F.contains("validation_status", F.lit("WARNING"))
    said = F.when((F.size(extra) > 0) & ~known, F.concat("validation_status", F.lit(" | WARNING"))).otherwise(F.col("validation_status"))
    return flagged.withColumns({"validation_status": said, "warnings": F.concat("warnings", extra)})


def clock_diagnostics(ticks: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """Least and most latency (receive - event, on rows that define both) and ts_in_delta (all rows) of each session.

    ``flagged`` (session_date_ny): only these sessions.
    """
    rows = ticks if flagged is None else ticks.join(flagged.select("session_date_ny").distinct(), "session_date_ny", "left_semi")
    defined = ~is_undefined(F.col("ts_event_raw")) & ~is_undefined(F.col("ts_recv_raw"))
    latency = F.when(defined, wrap64(F.col("ts_recv_raw")) - wrap64(F.col("ts_event_raw")))
    return rows.groupBy("session_date_ny").agg(
        F.min(latency).alias("min_latency_ns"), F.max(latency).alias("max_latency_ns"), F.min("ts_in_delta").alias("min_ts_in_delta"), F.max("ts_in_delta").alias("max_ts_in_delta")
    )


def example_targets(audit: DataFrame, names: list[str]) -> DataFrame:
    """session_date_ny, check_name, target: the first hit of each named check that is no gap."""
    long = audit.select("session_date_ny", F.explode("first_example_event_idx").alias("check_name", "target"))
    return long.where(F.col("check_name").isin([n for n in names if "gap" not in n]))


def warning_context(ticks: DataFrame, targets: DataFrame, reach: int = 2) -> DataFrame:
    """The rows within ``reach`` places of a target, once each, by an equality join on the places themselves."""
    places = targets.select("session_date_ny", F.explode(F.sequence(F.col("target") - reach, F.col("target") + reach)).alias("event_idx_day")).distinct()
    return ticks.join(places, ["session_date_ny", "event_idx_day"], "left_semi")


def totals(audit: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """One row: sessions, empty sessions, records, trades, volume, sessions with errors and with warnings, and the dates
    of the empty, faulty and warned ones; with an inventory (file_bytes) also its files and bytes."""
    dates = lambda which: F.sort_array(F.collect_list(F.when(which, F.col("session_date_ny"))))
    wrong, warned = F.size("errors") > 0, F.size("warnings") > 0
    found = audit.agg(
        F.count(F.lit(1)).alias("sessions"), F.count_if("empty").alias("empty_sessions"), F.sum("record_count").alias("records"), F.sum("trade_event_count").alias("trades"),
        F.sum("trade_volume").alias("volume"), F.count_if(wrong).alias("error_sessions"), F.count_if(warned).alias("warning_sessions"),
        dates(F.col("empty")).alias("empty_dates"), dates(wrong).alias("error_dates"), dates(warned).alias("warning_dates"),
    )
    if inventory is None:
        return found
    return found.join(inventory.agg(F.count(F.lit(1)).alias("raw_files"), F.sum("file_bytes").alias("raw_bytes")))  # a row each


def records_per_day(ticks: DataFrame) -> DataFrame:
    return ticks.groupBy("session_date_ny").agg(F.count(F.lit(1)).alias("records"))


def restated(audit: DataFrame) -> DataFrame:
    """The status told from the stored classes: equal to the stored one where nothing was changed."""
    return audit.withColumn("validation_status", status(F.col("errors"), F.col("warnings"), F.col("degraded_source"), F.col("unusual")))


def enrich(inventory: DataFrame, audit: DataFrame) -> DataFrame:
    """The inventory with the audit of each session; where both have a column, the audit's counts."""
    rest = [c for c in inventory.columns if c == "session_date_ny" or c not in audit.columns]
    return inventory.select(*rest).join(audit, "session_date_ny")


def counts_equal(left: DataFrame, right: DataFrame, key: str, value: str, message: str) -> None:
    """ValueError unless both tables have the same keys with the same values."""
    a, b = left.select(key, F.col(value).alias("a_")), right.select(key, F.col(value).alias("b_"))
    require(a.join(b, key, "full_outer"), ~F.col("a_").eqNullSafe(F.col("b_")), message)
