"""The session audit: every check in one pass, flags and never filters.

A check is a name, a class and a predicate over a row (and, for order checks, the row before it in the session). One
aggregation counts all of them and keeps the place of each one's first hit. Sessions without rows come from a calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ticks import bound_ns, degraded
from ..schema import NATIVE_COLUMNS, RECORD_BYTES, UNDEF_ORDER_SIZE, UNDEF_PRICE, UNDEF_TIMESTAMP
from .order import with_previous

GAP_NS = 60 * 10**9

#: The classes of checks; all others are "unusual".
ERRORS = ["invalid_layout", "invalid_trade_price", "invalid_trade_size", "recv_outside_session", "undefined_timestamp", "unknown_action", "unknown_side"]
WARNINGS = [
    "bad_ts_recv",
    "crossed_bbo_last",
    "intraday_instrument_change",
    "invalid_bbo_price",
    "leading_gap_over_60s",
    "locked_bbo_last",
    "mapping_mismatch",
    "maybe_bad_book",
    "quote_size_count_mismatch",
    "recv_gap_over_60s",
    "recv_reversal",
    "sequence_reversal",
    "trailing_gap_over_60s",
]

_price, _quote = f"price = {UNDEF_PRICE}", "({0}_px_00 <> %d)" % UNDEF_PRICE
_bid, _ask = _quote.format("bid"), _quote.format("ask")
_both = f"({_bid} AND {_ask})"


def _bad_side(side: str) -> str:
    there, size, count = _quote.format(side), f"{side}_sz_00", f"{side}_ct_00"
    return f"({there} AND ({size} = 0 OR {count} = 0 OR {count} > {size})) OR (NOT {there} AND ({size} <> 0 OR {count} <> 0))"


#: Predicates over one row, with start_ns and end_ns of its session and ``mapped`` (its instrument is mapped that day).
ROW_CHECKS = {
    "invalid_layout": f"length * 4 <> {RECORD_BYTES} OR rtype <> 1",
    "undefined_timestamp": f"ts_event_raw = {UNDEF_TIMESTAMP} OR ts_recv_raw = {UNDEF_TIMESTAMP}",
    "recv_outside_session": "ts_recv_raw < start_ns OR ts_recv_raw >= end_ns",
    "event_outside_session": "ts_event_raw < start_ns OR ts_event_raw >= end_ns",
    "unknown_action": "action NOT IN ('A', 'C', 'M', 'R', 'T', 'F', 'N')",
    "unknown_side": "side NOT IN ('A', 'B', 'N')",
    "invalid_trade_price": f"action = 'T' AND (price <= 0 OR {_price})",
    "invalid_trade_size": f"action = 'T' AND (size = 0 OR size = {UNDEF_ORDER_SIZE})",
    "nontrade_undefined_price": f"action <> 'T' AND {_price}",
    "nontrade_nonpositive_price": "action <> 'T' AND price <= 0",
    "nontrade_zero_size": "action <> 'T' AND size = 0",
    "fill_or_none": "action IN ('F', 'N')",
    "mapping_mismatch": "NOT mapped",
    "bad_ts_recv": "(flags & 8) <> 0",
    "maybe_bad_book": "(flags & 4) <> 0",
    "snapshot": "(flags & 32) <> 0",
    "negative_ts_in_delta": "ts_in_delta < 0",
    "clamped_ts_in_delta": "ts_in_delta IN (-2147483648, 2147483647)",
    "recv_before_event": "ts_recv_raw < ts_event_raw",
    "absent_bbo": f"NOT {_both}",
    "invalid_bbo_price": f"({_bid} AND bid_px_00 <= 0) OR ({_ask} AND ask_px_00 <= 0)",
    "locked_bbo_last": f"{_both} AND bid_px_00 = ask_px_00 AND (flags & 128) <> 0",
    "locked_bbo_partial": f"{_both} AND bid_px_00 = ask_px_00 AND (flags & 128) = 0",
    "crossed_bbo_last": f"{_both} AND bid_px_00 > ask_px_00 AND (flags & 128) <> 0",
    "crossed_bbo_partial": f"{_both} AND bid_px_00 > ask_px_00 AND (flags & 128) = 0",
    "bid_undefined_size": f"bid_sz_00 = {UNDEF_ORDER_SIZE}",
    "ask_undefined_size": f"ask_sz_00 = {UNDEF_ORDER_SIZE}",
    "quote_size_count_mismatch": f"{_bad_side('bid')} OR {_bad_side('ask')}",
}
_same = "instrument_id = prev_instrument_id"
#: Predicates over a row and the one before it (prev_*); null, so no hit, on a session's first row.
ORDER_CHECKS = {
    f"{name}_{kind}": f"{_same} AND {column} {sign} prev_{column}"
    for name, column in (("recv", "ts_recv_raw"), ("event", "ts_event_raw"), ("sequence", "sequence"))
    for kind, sign in (("reversal", "<"), ("equal", "="))
} | {
    "recv_gap_over_60s": f"recv_step > {GAP_NS}",
    "sequence_forward_gap": f"{_same} AND sequence - prev_sequence > 1",
    "intraday_instrument_change": "instrument_id <> prev_instrument_id",
    "adjacent_exact_duplicates": " AND ".join(f"{c} = prev_{c}" for c in NATIVE_COLUMNS),
}
#: Counted by session, without the place of a first hit.
SESSION_CHECKS = ["exact_duplicates", "leading_gap_over_60s", "trailing_gap_over_60s"]
CHECKS = [*ROW_CHECKS, *ORDER_CHECKS, *SESSION_CHECKS]


def _signed(column: str) -> str:
    return f"CASE WHEN {column} > {2**63 - 1} THEN {column} - {2**64} ELSE {column} END"


RECV_STEP = f"({_signed('ts_recv_raw')}) - ({_signed('prev_ts_recv_raw')})"


def checked_rows(ticks: DataFrame, mappings: DataFrame | None = None, order: bool = True) -> DataFrame:
    """``ticks`` with what the predicates need: session bounds, ``mapped`` and, if ``order``, the row before and recv_step.

    ``mappings``: session_date_ny and instrument_id of every mapped instrument; not given: all are mapped.
    """
    rows = with_previous(ticks, NATIVE_COLUMNS).withColumn("recv_step", F.expr(f"cast({RECV_STEP} as bigint)")) if order else ticks
    rows = rows.withColumns({"start_ns": bound_ns(F.col("session_date_ny"), 7), "end_ns": bound_ns(F.col("session_date_ny"), 12)})
    if mappings is None:
        return rows.withColumn("mapped", F.lit(True))
    known = mappings.select("session_date_ny", "instrument_id").distinct().withColumn("mapped", F.lit(True))
    return rows.join(known, ["session_date_ny", "instrument_id"], "left").withColumn("mapped", F.coalesce("mapped", F.lit(False)))


def mapped_instruments(mappings: DataFrame, sessions: DataFrame) -> DataFrame:
    """session_date_ny, instrument_id for mappings (start_date, end_date, instrument_id) open on a session: [start, end)."""
    inside = (mappings["start_date"] <= sessions["session_date_ny"]) & (sessions["session_date_ny"] < mappings["end_date"])
    return sessions.join(mappings, inside).select("session_date_ny", "instrument_id").distinct()


def exact_duplicates(rows: DataFrame, keys: list[str], columns: list[str], name: str = "exact_duplicates") -> DataFrame:
    """For each value of ``keys``: rows that repeat an earlier row in all ``columns`` (compared themselves, not hashed)."""
    groups = rows.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("n_"))
    return groups.groupBy(*keys).agg(F.sum(F.col("n_") - 1).alias(name))


def histogram(ticks: DataFrame, column: str) -> DataFrame:
    """session_date_ny, value (as text), n."""
    return ticks.groupBy("session_date_ny", F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def trade_activity(ticks: DataFrame) -> DataFrame:
    """session_date_ny, record_count, trade_event_count, trade_volume: one aggregation, nothing else is read."""
    trade = F.col("action") == "T"
    volume = F.sum(F.when(trade, F.col("size")).otherwise(0))
    return ticks.groupBy("session_date_ny").agg(F.count(F.lit(1)).alias("record_count"), F.count_if(trade).alias("trade_event_count"), volume.alias("trade_volume"))


def _endpoints() -> list[Column]:
    ends = [f(c, "event_idx_day") for c in ("ts_event_raw", "ts_recv_raw") for f in (F.min_by, F.max_by)]
    named = [x.alias(n) for x, n in zip(ends, ("first_event_ns", "last_event_ns", "first_recv_ns", "last_recv_ns"), strict=True)]
    return [*named, F.min("ts_event_raw").alias("min_event_ns"), F.max("ts_event_raw").alias("max_event_ns")]


def session_endpoints(ticks: DataFrame) -> DataFrame:
    """session_date_ny with the first and last timestamps by place, and the smallest and largest event time."""
    return ticks.groupBy("session_date_ny").agg(*_endpoints())


def instrument_sets(ticks: DataFrame) -> DataFrame:
    """session_date_ny, instrument_ids in order."""
    return ticks.groupBy("session_date_ny").agg(F.sort_array(F.collect_set("instrument_id")).alias("instrument_ids"))


def _largest_gap() -> Column:
    return F.greatest(F.coalesce(F.max("recv_step"), F.lit(0)), F.lit(0)).alias("max_recv_gap_ns")


def largest_gaps(ticks: DataFrame) -> DataFrame:
    """session_date_ny, max_recv_gap_ns: the row before is looked up for its receive time alone."""
    rows = with_previous(ticks.select("session_date_ny", "event_idx_day", "ts_recv_raw"), ["ts_recv_raw"])
    return rows.withColumn("recv_step", F.expr(f"cast({RECV_STEP} as bigint)")).groupBy("session_date_ny").agg(_largest_gap())


def count_checks(ticks: DataFrame, names: list[str], mappings: DataFrame | None = None) -> DataFrame:
    """session_date_ny, check_name, n, first_event_idx for these row and order checks alone, as :func:`check_rows` tells
    them; without order checks no row before is looked up."""
    rows = checked_rows(ticks, mappings, order=any(n in ORDER_CHECKS for n in names))
    known = ROW_CHECKS | ORDER_CHECKS
    hit = {n: F.coalesce(F.expr(known[n]), F.lit(False)) for n in names}
    counted = [x for n in names for x in (F.count_if(hit[n]).alias(f"c_{n}"), F.min(F.when(hit[n], F.col("event_idx_day"))).alias(f"e_{n}"))]
    told = F.explode(F.array(*(F.struct(F.lit(n).alias("check_name"), F.col(f"c_{n}").alias("n"), F.col(f"e_{n}").alias("first_event_idx")) for n in names)))
    return rows.groupBy("session_date_ny").agg(*counted).select("session_date_ny", told.alias("x")).select("session_date_ny", "x.*")


def _map(names: list[str], column: str) -> Column:
    return F.create_map(*(x for n in names for x in (F.lit(n), F.col(f"{column}{n}"))))


def session_audit(ticks: DataFrame, sessions: DataFrame | None = None, mappings: DataFrame | None = None) -> DataFrame:
    """One row a session: counts, endpoints, checks (map), first_example_event_idx (map), classes and status.

    ``sessions`` (session_date_ny): sessions that must appear even if they have no row.
    """
    rows = checked_rows(ticks, mappings)
    marked = [*ROW_CHECKS, *ORDER_CHECKS]
    hits = {f"h_{n}": F.coalesce(F.expr(p), F.lit(False)) for n, p in (ROW_CHECKS | ORDER_CHECKS).items()}
    trade = F.col("action") == "T"
    one = rows.withColumns(hits).groupBy("session_date_ny").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(trade).alias("trade_event_count"),
        F.sum(F.when(trade, F.col("size")).otherwise(0)).alias("trade_volume"),
        *_endpoints(),
        _largest_gap(),
        F.sort_array(F.collect_set("instrument_id")).alias("instrument_ids"),
        F.min("start_ns").alias("start_ns"),
        F.min("end_ns").alias("end_ns"),
        *(F.count_if(f"h_{n}").alias(f"c_{n}") for n in marked),
        *(F.min(F.when(F.col(f"h_{n}"), F.col("event_idx_day"))).alias(f"e_{n}") for n in marked),
    )
    repeats = exact_duplicates(ticks, ["session_date_ny"], NATIVE_COLUMNS, "c_exact_duplicates")
    whole = one.join(repeats, "session_date_ny").withColumns(
        {
            "c_leading_gap_over_60s": (F.col("first_recv_ns") - F.col("start_ns") > GAP_NS).cast("long"),
            "c_trailing_gap_over_60s": (F.col("end_ns") - F.col("last_recv_ns") > GAP_NS).cast("long"),
        }
    )
    if sessions is not None:
        whole = sessions.select("session_date_ny").join(whole, "session_date_ny", "left")
    whole = whole.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("record_count", "trade_event_count", "trade_volume", "max_recv_gap_ns")})
    empty = F.col("record_count") == 0
    named = lambda names: F.filter(F.array(*(F.when(F.col(f"c_{n}") > 0, F.lit(n)) for n in sorted(names))), lambda x: x.isNotNull())
    unusual = [n for n in CHECKS if n not in ERRORS and n not in WARNINGS]
    found = whole.select(
        "session_date_ny", "record_count", "trade_event_count", "trade_volume", empty.alias("empty"), degraded(F.col("session_date_ny")).alias("degraded_source"),
        "first_event_ns", "last_event_ns", "min_event_ns", "max_event_ns", "first_recv_ns", "last_recv_ns", "max_recv_gap_ns",
        F.coalesce("instrument_ids", F.array().cast("array<bigint>")).alias("instrument_ids"),
        F.when(empty, F.create_map().cast("map<string,bigint>")).otherwise(_map(CHECKS, "c_")).alias("checks"),
        F.when(empty, F.create_map().cast("map<string,bigint>")).otherwise(F.map_filter(_map(marked, "e_"), lambda _, v: v.isNotNull())).alias("first_example_event_idx"),
        named(ERRORS).alias("errors"), named(WARNINGS).alias("warnings"),
        F.when(empty, F.array(F.lit("empty_session"))).otherwise(named(unusual)).alias("unusual"),
        F.coalesce(F.col("c_recv_reversal") == 0, F.lit(True)).alias("duplicate_coverage_complete"),
    )
    return found.withColumn("validation_status", status(F.col("errors"), F.col("warnings"), F.col("degraded_source"), F.col("unusual")))


def status(errors: Column, warnings: Column, known: Column, unusual: Column) -> Column:
    """The classes that a session falls in, in order, or PASS."""
    said = F.concat_ws(
        " | ",
        F.when(F.size(errors) > 0, F.lit("ERROR")),
        F.when(F.size(warnings) > 0, F.lit("WARNING")),
        F.when(known, F.lit("KNOWN DEGRADED SOURCE DATA")),
        F.when(F.size(unusual) > 0, F.lit("VALID BUT UNUSUAL")),
    )
    return F.when(said == "", F.lit("PASS")).otherwise(said)


def check_rows(audit: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The audit in long form: session_date_ny, check_name, n, first_event_idx (null where there is none)."""
    long = audit.select("session_date_ny", F.explode("checks").alias("check_name", "n"), "first_example_event_idx")
    long = long.withColumn("first_event_idx", F.try_element_at("first_example_event_idx", F.col("check_name"))).drop("first_example_event_idx")
    return long.where(F.col("check_name").isin(names)) if names else long


def anomaly_summary(audit: DataFrame) -> DataFrame:
    """check_name, observations, sessions for every check with a hit."""
    long = audit.select(F.explode("checks").alias("check_name", "n")).where("n > 0")
    return long.groupBy("check_name").agg(F.sum("n").alias("observations"), F.count(F.lit(1)).alias("sessions"))
