"""The library's queries over the driver's tables, and the same results in ANSI SQL for the oracle engine."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import ticks as tf
from .operators import audit as A
from .operators import native, normalize, order, products, store
from .plans import policy, resources
from .schema import FLAG_BITS, NATIVE, NATIVE_COLUMNS, UNDEF_TIMESTAMP, column_of
from .session import shared_folder
from .sources import access
from .sources.adapters import TICKS_SQL, ticks_from_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

FIRST, LAST = "2021-09-27", "2026-09-25"


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def _long(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("long") for c in columns})


def _text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


# ---- the pieces of the oracle's SQL -------------------------------------------------------------------------------

TICKS = f"WITH {TICKS_SQL}"


def _bound(day: str, hour: int) -> str:
    return f"epoch_us(timezone('America/New_York', CAST({day} AS TIMESTAMP) + INTERVAL {hour} HOUR)) * 1000"


_W = "(PARTITION BY session_date_ny ORDER BY event_idx_day)"
_PREV = ", ".join(f"lag({c}) OVER {_W} AS prev_{c}" for c in NATIVE_COLUMNS)
_MAPPED = "instrument_id < 150"
ROWS = f"""{TICKS}, lagged AS (SELECT *, {_PREV}, {_bound('session_date_ny', 7)} AS start_ns, {_bound('session_date_ny', 12)} AS end_ns, {_MAPPED} AS mapped FROM ticks),
rows_ AS (SELECT *, {A.RECV_STEP} AS recv_step FROM lagged)"""


def _check_sql(names: list[str]) -> str:
    checks = A.ROW_CHECKS | A.ORDER_CHECKS
    parts = [
        f"SELECT session_date_ny, '{n}' AS check_name, CAST(count(*) FILTER (WHERE {checks[n]}) AS BIGINT) AS n, CAST(min(event_idx_day) FILTER (WHERE {checks[n]}) AS BIGINT) AS first_event_idx FROM rows_ GROUP BY session_date_ny"
        for n in names
    ]
    return " UNION ALL ".join(parts)


_DUP = f"SELECT session_date_ny, CAST(sum(n - 1) AS BIGINT) AS exact_duplicates FROM (SELECT session_date_ny, count(*) AS n FROM ticks GROUP BY session_date_ny, {', '.join(NATIVE_COLUMNS)}) GROUP BY session_date_ny"
_ENDS = "ends AS (SELECT session_date_ny, arg_min(ts_recv_raw, event_idx_day) AS first_, arg_max(ts_recv_raw, event_idx_day) AS last_, count(*) AS n_ FROM ticks GROUP BY session_date_ny)"
_ALL_CHECKS = f"""{ROWS}, {_ENDS}, dup AS ({_DUP}),
long_ AS ({_check_sql([*A.ROW_CHECKS, *A.ORDER_CHECKS])}
UNION ALL SELECT session_date_ny, 'exact_duplicates', exact_duplicates, NULL FROM dup
UNION ALL SELECT session_date_ny, 'leading_gap_over_60s', CAST(first_ - {_bound('session_date_ny', 7)} > {A.GAP_NS} AS BIGINT), NULL FROM ends
UNION ALL SELECT session_date_ny, 'trailing_gap_over_60s', CAST({_bound('session_date_ny', 12)} - last_ > {A.GAP_NS} AS BIGINT), NULL FROM ends)"""
_SEGMENTS = f"""{TICKS}, flagged AS (SELECT *, coalesce(instrument_id <> lag(instrument_id) OVER (ORDER BY session_date_ny, event_idx_day), false) AS contract_change FROM ticks),
seg AS (SELECT *, CAST(1 + sum(CAST(contract_change AS INT)) OVER (ORDER BY session_date_ny, event_idx_day ROWS UNBOUNDED PRECEDING) AS BIGINT) AS roll_segment FROM flagged),
segments AS (SELECT * FROM seg WHERE event_idx_day = 0 OR contract_change)"""
_SUMMARY = """SELECT roll_segment, arg_min(instrument_id, event_idx_day) FILTER (WHERE session_date_ny = f) AS instrument_id, min(session_date_ny) AS first_session,
min(event_idx_day) FILTER (WHERE session_date_ny = f) AS first_event_idx_day, arg_min(contract_change, event_idx_day) FILTER (WHERE session_date_ny = f) AS contract_change, max(session_date_ny) AS last_session
FROM (SELECT *, min(session_date_ny) OVER (PARTITION BY roll_segment) AS f FROM segments) GROUP BY roll_segment"""
_CALENDAR = f"cal AS (SELECT CAST(d AS DATE) AS session_date_ny FROM generate_series(DATE '{FIRST}', DATE '{LAST}', INTERVAL 1 DAY) t(d) WHERE isodow(d) < 6)"
_SPLIT = "CASE " + " ".join(f"WHEN session_date_ny BETWEEN DATE '{s.start}' AND DATE '{s.end}' THEN '{s.name}'" for s in policy.SPLITS.values()) + " END"
#: An inventory made of the calendar: every tenth session or so is empty.
_COUNT = "CASE WHEN day(session_date_ny) % 11 = 0 THEN 0 ELSE 1000 + day(session_date_ny) * 37 END"
_STATUS_SETS = {c: ", ".join(f"'{n}'" for n in names) for c, names in (("errors", A.ERRORS), ("warnings", A.WARNINGS))}


def _mappings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = ticks_from_events(spark, sf_dir)
    return ticks.where(_MAPPED).select("session_date_ny", "instrument_id").distinct()


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.session_audit(ticks_from_events(spark, sf_dir), mappings=_mappings(spark, sf_dir))


def _calendar_inventory(spark: SparkSession) -> DataFrame:
    days = tf.calendar(spark, FIRST, LAST)
    return days.select(F.col("session_date_ny").cast("string").alias("session_date"), F.expr(_COUNT).cast("long").alias("record_count"), F.concat(F.lit("f-"), F.col("session_date_ny").cast("string")).alias("raw_file"), F.sha2(F.col("session_date_ny").cast("string"), 256).alias("sha256"))


# ---- scans, projections, expressions ------------------------------------------------------------------------------


@query("records_per_day", f"{TICKS} SELECT session_date_ny, CAST(count(*) AS BIGINT) AS records FROM ticks GROUP BY session_date_ny")
def _records_per_day(spark, sf_dir):
    return products.records_per_day(ticks_from_events(spark, sf_dir))


_STORES: dict[tuple[str, str], str] = {}


def _store(spark: SparkSession, sf_dir: str) -> str:
    """A published store of the ticks in the shared folder, built once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORES:
        ticks = ticks_from_events(spark, sf_dir)
        months = [r["m"] for r in ticks.select(F.date_format("session_date_ny", "yyyy-MM").alias("m")).distinct().collect()]  # a row a month
        root = f"{store.local_path(shared_folder(spark))}/store-{uuid.uuid4().hex}"
        store.build_store(ticks, months, root, {}, config={})
        _STORES[key] = root
    return _STORES[key]


@query("scan_project", f"{TICKS} SELECT CAST(ts_event_raw AS VARCHAR) AS ts_event, instrument_id, price, bid_px_00, ask_px_00 FROM ticks")
def _scan_project(spark, sf_dir):
    rows = access.scan_development(spark, _store(spark, sf_dir), columns=["ts_event_raw", "instrument_id", "price", "bid_px_00", "ask_px_00"])
    return _text(rows, "ts_event_raw").withColumnRenamed("ts_event_raw", "ts_event")


@query("scan_date_range", f"{TICKS} SELECT session_date_ny, event_idx_day, sequence, action, size FROM ticks WHERE session_date_ny BETWEEN DATE '2024-01-08' AND DATE '2024-01-12'")
def _scan_date_range(spark, sf_dir):
    return access.scan(spark, _store(spark, sf_dir), "2024-01-08", "2024-01-12", ["session_date_ny", "event_idx_day", "sequence", "action", "size"])


@query("scan_one_day_all_columns", f"{TICKS} SELECT session_date_ny, event_idx_day, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' if c.endswith('_raw') else c for c in NATIVE_COLUMNS)} FROM ticks WHERE session_date_ny = DATE '2024-01-03'")
def _scan_one_day(spark, sf_dir):
    rows = access.scan(spark, _store(spark, sf_dir), "2024-01-03", "2024-01-03").drop(*normalize.ADDED)
    return _long(_text(rows, "ts_event_raw", "ts_recv_raw"), "length", "rtype", "publisher_id", "flags", "depth", "ts_in_delta")


@query("month_predicate", f"{TICKS} SELECT strftime(session_date_ny, '%Y-%m') AS month, CAST(count(*) AS BIGINT) AS records FROM ticks WHERE strftime(session_date_ny, '%Y-%m') BETWEEN '2023-12' AND '2024-01' GROUP BY 1")
def _month_predicate(spark, sf_dir):
    rows = ticks_from_events(spark, sf_dir).withColumn("month", F.date_format("session_date_ny", "yyyy-MM"))
    return rows.where(F.col("month").between("2023-12", "2024-01")).groupBy("month").agg(F.count(F.lit(1)).alias("records"))


@query("session_bounds", f"WITH {_CALENDAR} SELECT session_date_ny, CAST({_bound('session_date_ny', 7)} AS BIGINT) AS start_ns, CAST({_bound('session_date_ny', 12)} AS BIGINT) AS end_ns FROM cal")
def _session_bounds(spark, sf_dir):
    day = F.col("session_date_ny")
    return tf.calendar(spark, FIRST, LAST).select(day, tf.bound_ns(day, 7).alias("start_ns"), tf.bound_ns(day, 12).alias("end_ns"))


_DEFINED = f"CASE WHEN ts_event_raw = {UNDEF_TIMESTAMP} THEN NULL ELSE CAST(ts_event_raw AS BIGINT) END"


@query(
    "ns_offset_minute_bucket",
    f"{TICKS}, o AS (SELECT session_date_ny, event_idx_day, {_DEFINED} - {_bound('session_date_ny', 7)} AS ns FROM ticks) SELECT session_date_ny, event_idx_day, CAST(ns AS BIGINT) AS ns_from_0700, CAST((ns - ((ns % 60000000000) + 60000000000) % 60000000000) // 60000000000 AS BIGINT) AS minute_from_0700 FROM o",
)
def _offsets(spark, sf_dir):
    return normalize.with_times(ticks_from_events(spark, sf_dir)).select("session_date_ny", "event_idx_day", "ns_from_0700", "minute_from_0700")


@query("sentinel_to_null", f"{TICKS} SELECT session_date_ny, event_idx_day, {_DEFINED} AS ts_event_ns FROM ticks")
def _sentinel(spark, sf_dir):
    return ticks_from_events(spark, sf_dir).select("session_date_ny", "event_idx_day", tf.defined_ns(F.col("ts_event_raw")).alias("ts_event_ns"))


@query("flag_bits", f"{TICKS} SELECT session_date_ny, " + ", ".join(f"CAST(count(*) FILTER (WHERE (flags & {b}) <> 0) AS BIGINT) AS {n}" for n, b in FLAG_BITS.items()) + " FROM ticks GROUP BY session_date_ny")
def _flag_bits(spark, sf_dir):
    return ticks_from_events(spark, sf_dir).groupBy("session_date_ny").agg(*(F.count_if(tf.has_bit(F.col("flags"), b)).alias(n) for n, b in FLAG_BITS.items()))


@query("degraded_overlay", f"WITH {_CALENDAR} SELECT session_date_ny FROM cal WHERE CAST(session_date_ny AS VARCHAR) IN ({', '.join(repr(d) for d in tf.DEGRADED)})")
def _degraded(spark, sf_dir):
    return tf.calendar(spark, FIRST, LAST).where(tf.degraded(F.col("session_date_ny")))


_ODD_DATES = "o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') WHEN 2 THEN strftime(o_orderdate, '%Y-%m-') || '32' ELSE '2024-W40-1' END AS said FROM orders"


@query("iso_date_guard", f"WITH t AS (SELECT {_ODD_DATES}) SELECT o_orderkey, said, regexp_full_match(said, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast(said AS DATE) IS NOT NULL AS valid FROM t")
def _iso_guard(spark, sf_dir):
    day, m = F.col("o_orderdate"), F.col("o_orderkey") % 4
    said = F.when(m == 0, F.date_format(day, "yyyy-MM-dd")).when(m == 1, F.date_format(day, "yyyyMMdd")).when(m == 2, F.concat(F.date_format(day, "yyyy-MM-"), F.lit("32"))).otherwise("2024-W40-1")
    rows = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", said.alias("said"))
    return rows.withColumn("valid", tf.is_iso_date(F.col("said")))


@query("filename_dates", f"WITH {_CALENDAR}, n AS (SELECT CASE WHEN day(session_date_ny) % 5 = 0 THEN 'x_' ELSE '' END || 'GC.v.0_' || session_date_ny || '_0700-1200_NY_mbp-1.dbn.zst' AS raw_file FROM cal) SELECT raw_file, nullif(regexp_extract(raw_file, '^GC\\.v\\.0_([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})_0700-1200_NY_mbp-1\\.dbn\\.zst$', 1), '') AS session_date FROM n")
def _filenames(spark, sf_dir):
    day = F.col("session_date_ny")
    name = F.concat(F.when(F.day(day) % 5 == 0, F.lit("x_")).otherwise(""), F.lit("GC.v.0_"), day.cast("string"), F.lit("_0700-1200_NY_mbp-1.dbn.zst")).alias("raw_file")
    found = F.regexp_extract("raw_file", f"^{tf.FILE_NAME}$", 1)
    return tf.calendar(spark, FIRST, LAST).select(name).withColumn("session_date", F.when(found != "", found))


# ---- order, segments, products ------------------------------------------------------------------------------------


@query("contract_change", f"{_SEGMENTS} SELECT session_date_ny, event_idx_day, contract_change FROM seg")
def _contract_change(spark, sf_dir):
    return order.with_contract_change(ticks_from_events(spark, sf_dir)).select("session_date_ny", "event_idx_day", "contract_change")


@query("roll_segment", f"{_SEGMENTS} SELECT session_date_ny, event_idx_day, roll_segment FROM seg")
def _roll_segment(spark, sf_dir):
    return order.with_roll_segment(ticks_from_events(spark, sf_dir)).select("session_date_ny", "event_idx_day", "roll_segment")


@query("contract_segments", f"{_SEGMENTS} SELECT session_date_ny, event_idx_day, instrument_id, roll_segment, contract_change, CAST(ts_recv_raw AS VARCHAR) AS ts_recv_raw FROM segments")
def _contract_segments(spark, sf_dir):
    return _text(order.contract_segments(ticks_from_events(spark, sf_dir)), "ts_recv_raw")


@query("roll_segment_summary", f"{_SEGMENTS}, s AS ({_SUMMARY}) SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY roll_segment) > 1 AS previously_observed_id FROM s")
def _roll_summary(spark, sf_dir):
    return order.roll_segment_summary(order.contract_segments(ticks_from_events(spark, sf_dir)))


@query("segment_transitions", f"{_SEGMENTS}, s AS ({_SUMMARY}), t AS (SELECT roll_segment, instrument_id, first_session, lag(instrument_id) OVER (ORDER BY roll_segment) AS from_instrument_id FROM s) SELECT * FROM t WHERE from_instrument_id IS NOT NULL")
def _transitions(spark, sf_dir):
    return order.segment_transitions(order.contract_segments(ticks_from_events(spark, sf_dir)))


@query("index_contiguity", f"{TICKS} SELECT session_date_ny, CAST(count(*) AS BIGINT) AS records, min(event_idx_day) = 0 AND max(event_idx_day) = count(*) - 1 AND count(DISTINCT event_idx_day) = count(*) AS contiguous FROM ticks GROUP BY session_date_ny")
def _contiguity(spark, sf_dir):
    return order.index_contiguity(ticks_from_events(spark, sf_dir))


_GAP_BOUNDS = f"b AS (SELECT *, {_bound('session_date_ny', 7)} AS s_, {_bound('session_date_ny', 12)} AS e_ FROM ends)"


@query(
    "coverage_gaps",
    f"""{ROWS}, {_ENDS}, {_GAP_BOUNDS}, g AS (
SELECT session_date_ny, 'leading' AS kind, CAST(s_ AS HUGEINT) AS l, CAST(first_ AS HUGEINT) AS r, 0 AS place_, NULL AS instrument_id FROM b WHERE first_ - s_ > {A.GAP_NS}
UNION ALL SELECT session_date_ny, 'trailing', last_, e_, n_, NULL FROM b WHERE e_ - last_ > {A.GAP_NS}
UNION ALL SELECT session_date_ny, 'internal', prev_ts_recv_raw, ts_recv_raw, event_idx_day, instrument_id FROM rows_ WHERE recv_step > {A.GAP_NS})
SELECT session_date_ny, kind, CAST(l AS VARCHAR) AS left_recv_ns, CAST(r AS VARCHAR) AS right_recv_ns, CAST(place_ AS BIGINT) AS right_event_idx_day, CAST(instrument_id AS BIGINT) AS instrument_id, CAST(r - l AS VARCHAR) AS duration_ns FROM g""",
)
def _gaps(spark, sf_dir):
    return _text(products.coverage_gaps(ticks_from_events(spark, sf_dir)), "left_recv_ns", "right_recv_ns", "duration_ns")


@query("max_gap", f"{ROWS} SELECT session_date_ny, CAST(greatest(coalesce(max(recv_step), 0), 0) AS BIGINT) AS max_recv_gap_ns FROM rows_ GROUP BY session_date_ny")
def _max_gap(spark, sf_dir):
    return A.largest_gaps(ticks_from_events(spark, sf_dir))


# ---- the audit ----------------------------------------------------------------------------------------------------


@query("row_checks", f"{ROWS} {_check_sql(list(A.ROW_CHECKS))}")
def _row_checks(spark, sf_dir):
    return A.count_checks(ticks_from_events(spark, sf_dir), list(A.ROW_CHECKS), _mappings(spark, sf_dir))


@query("lag_checks", f"{ROWS} {_check_sql(list(A.ORDER_CHECKS))}")
def _lag_checks(spark, sf_dir):
    return A.count_checks(ticks_from_events(spark, sf_dir), list(A.ORDER_CHECKS))


@query("exact_duplicates", f"{TICKS} {_DUP}")
def _exact(spark, sf_dir):
    return A.exact_duplicates(ticks_from_events(spark, sf_dir), ["session_date_ny"], NATIVE_COLUMNS)


@query("adjacent_duplicates", f"{ROWS} SELECT session_date_ny, CAST(count(*) FILTER (WHERE {A.ORDER_CHECKS['adjacent_exact_duplicates']}) AS BIGINT) AS n FROM rows_ GROUP BY session_date_ny")
def _adjacent(spark, sf_dir):
    return A.count_checks(ticks_from_events(spark, sf_dir), ["adjacent_exact_duplicates"]).select("session_date_ny", "n")


@query("natural_key_duplicates", "SELECT day, CAST(sum(n - 1) AS BIGINT) AS repeats FROM (SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem GROUP BY 1, l_partkey, l_suppkey) GROUP BY day")
def _natural(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("day", F.col("l_shipdate").cast("date"))
    return A.exact_duplicates(rows, ["day"], ["l_partkey", "l_suppkey"], "repeats")


for _column in ("action", "side", "flags", "instrument_id"):

    @query(f"{_column}_histogram", f"{TICKS} SELECT session_date_ny, CAST({_column} AS VARCHAR) AS value, CAST(count(*) AS BIGINT) AS n FROM ticks GROUP BY session_date_ny, {_column}")
    def _histogram(spark, sf_dir, column=_column):
        return A.histogram(ticks_from_events(spark, sf_dir), column)


@query("trade_volume", f"{TICKS} SELECT session_date_ny, CAST(count(*) FILTER (WHERE action = 'T') AS BIGINT) AS trade_event_count, CAST(coalesce(sum(size) FILTER (WHERE action = 'T'), 0) AS BIGINT) AS trade_volume FROM ticks GROUP BY session_date_ny")
def _volume(spark, sf_dir):
    return A.trade_activity(ticks_from_events(spark, sf_dir)).drop("record_count")


_END_COLUMNS = ["first_event_ns", "last_event_ns", "min_event_ns", "max_event_ns", "first_recv_ns", "last_recv_ns"]


@query(
    "session_endpoints",
    f"{TICKS} SELECT session_date_ny, "
    + ", ".join(f"CAST({f} AS VARCHAR) AS {n}" for n, f in zip(_END_COLUMNS, ("arg_min(ts_event_raw, event_idx_day)", "arg_max(ts_event_raw, event_idx_day)", "min(ts_event_raw)", "max(ts_event_raw)", "arg_min(ts_recv_raw, event_idx_day)", "arg_max(ts_recv_raw, event_idx_day)"), strict=True))
    + " FROM ticks GROUP BY session_date_ny",
)
def _endpoints(spark, sf_dir):
    return _text(A.session_endpoints(ticks_from_events(spark, sf_dir)), *_END_COLUMNS)


@query("instrument_sets", f"{TICKS} SELECT session_date_ny, string_agg(CAST(instrument_id AS VARCHAR), ',' ORDER BY instrument_id) AS instrument_ids FROM (SELECT DISTINCT session_date_ny, instrument_id FROM ticks) GROUP BY session_date_ny")
def _instruments(spark, sf_dir):
    return A.instrument_sets(ticks_from_events(spark, sf_dir)).withColumn("instrument_ids", F.array_join("instrument_ids", ","))


_CLASSED = f"""{_ALL_CHECKS}, classed AS (SELECT session_date_ny, check_name, CASE WHEN check_name IN ({_STATUS_SETS['errors']}) THEN 'e' WHEN check_name IN ({_STATUS_SETS['warnings']}) THEN 'w' ELSE 'u' END AS class FROM long_ WHERE n > 0),
per AS (SELECT s.session_date_ny, coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (WHERE class = 'e'), '') AS errors, coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (WHERE class = 'w'), '') AS warnings, coalesce(string_agg(check_name, ',' ORDER BY check_name) FILTER (WHERE class = 'u'), '') AS unusual
FROM (SELECT DISTINCT session_date_ny FROM ticks) s LEFT JOIN classed USING (session_date_ny) GROUP BY s.session_date_ny)"""


@query(
    "validation_status",
    f"""{_CLASSED} SELECT *, coalesce(nullif(concat_ws(' | ', CASE WHEN errors <> '' THEN 'ERROR' END, CASE WHEN warnings <> '' THEN 'WARNING' END, CASE WHEN unusual <> '' THEN 'VALID BUT UNUSUAL' END), ''), 'PASS') AS validation_status FROM per""",
)
def _status(spark, sf_dir):
    lists = ("errors", "warnings", "unusual")
    return _audit(spark, sf_dir).select("session_date_ny", *(F.array_join(c, ",").alias(c) for c in lists), "validation_status")


@query("anomaly_summary", f"{_ALL_CHECKS} SELECT check_name, CAST(sum(n) AS BIGINT) AS observations, CAST(count(*) AS BIGINT) AS sessions FROM long_ WHERE n > 0 GROUP BY check_name")
def _anomalies(spark, sf_dir):
    return A.anomaly_summary(_audit(spark, sf_dir))


_PER_DAY = f"{TICKS}, d AS (SELECT session_date_ny, count(*) AS record_count, coalesce(sum(size) FILTER (WHERE action = 'T'), 0) AS trade_volume FROM ticks GROUP BY session_date_ny), k AS (SELECT *, coalesce(sum(CAST(record_count > 0 AS INT)) OVER (ORDER BY session_date_ny ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM d)"


def _median_sql(c: str) -> str:
    return f"CASE WHEN b >= 10 THEN median({c}) OVER (ORDER BY b RANGE BETWEEN 20 PRECEDING AND 1 PRECEDING) END AS {c}_median"


@query(
    "activity_outliers",
    f"{_PER_DAY}, m AS (SELECT *, {_median_sql('record_count')}, {_median_sql('trade_volume')} FROM k) SELECT session_date_ny, CAST(record_count AS BIGINT) AS record_count, CAST(trade_volume AS BIGINT) AS trade_volume, CAST(record_count_median * 2 AS BIGINT) AS record_count_median2, CAST(trade_volume_median * 2 AS BIGINT) AS trade_volume_median2, "
    + ", ".join(f"coalesce({c}_median > 0 AND ({c} < 0.1 * {c}_median OR {c} > 10 * {c}_median), false) AS {c}_outlier" for c in ("record_count", "trade_volume"))
    + " FROM m",
)
def _activity(spark, sf_dir):
    found = products.activity_flags(A.trade_activity(ticks_from_events(spark, sf_dir)).drop("trade_event_count"))
    twice = {f"{c}_median2": (F.col(f"{c}_median") * 2).cast("long") for c in ("record_count", "trade_volume")}
    return found.withColumns(twice).drop("record_count_median", "trade_volume_median")


_LATENCY = f"CASE WHEN ts_event_raw <> {UNDEF_TIMESTAMP} AND ts_recv_raw <> {UNDEF_TIMESTAMP} THEN ts_recv_raw - ts_event_raw END"


@query("clock_diagnostics", f"{TICKS} SELECT session_date_ny, CAST(min({_LATENCY}) AS BIGINT) AS min_latency_ns, CAST(max({_LATENCY}) AS BIGINT) AS max_latency_ns, CAST(min(ts_in_delta) AS BIGINT) AS min_ts_in_delta, CAST(max(ts_in_delta) AS BIGINT) AS max_ts_in_delta FROM ticks GROUP BY session_date_ny")
def _clocks(spark, sf_dir):
    return _long(products.clock_diagnostics(ticks_from_events(spark, sf_dir)), "min_ts_in_delta", "max_ts_in_delta")


_CONTEXT_CHECKS = [n for n in A.WARNINGS if n in A.ROW_CHECKS or n in A.ORDER_CHECKS]


@query(
    "warning_context",
    f"""{ROWS}, long_ AS ({_check_sql([n for n in _CONTEXT_CHECKS if 'gap' not in n])}), places AS (SELECT DISTINCT session_date_ny, first_event_idx + d AS event_idx_day FROM long_, (VALUES (-2), (-1), (0), (1), (2)) v(d) WHERE first_event_idx IS NOT NULL)
SELECT t.session_date_ny, t.event_idx_day, t.sequence, t.action FROM ticks t JOIN places USING (session_date_ny, event_idx_day)""",
)
def _context(spark, sf_dir):
    targets = products.example_targets(_audit(spark, sf_dir), A.WARNINGS)
    return products.warning_context(ticks_from_events(spark, sf_dir), targets).select("session_date_ny", "event_idx_day", "sequence", "action")


_DATES = "(SELECT coalesce(string_agg(CAST(session_date_ny AS VARCHAR), ',' ORDER BY session_date_ny), '') FROM per WHERE {} <> '')"


@query(
    "global_totals",
    f"""{_CLASSED} SELECT (SELECT CAST(count(*) AS BIGINT) FROM per) AS sessions, CAST(0 AS BIGINT) AS empty_sessions, (SELECT CAST(count(*) AS BIGINT) FROM ticks) AS records, (SELECT CAST(count(*) AS BIGINT) FROM ticks WHERE action = 'T') AS trades,
(SELECT CAST(sum(size) AS BIGINT) FROM ticks WHERE action = 'T') AS volume, (SELECT CAST(count(*) AS BIGINT) FROM per WHERE errors <> '') AS error_sessions, (SELECT CAST(count(*) AS BIGINT) FROM per WHERE warnings <> '') AS warning_sessions,
'' AS empty_dates, {_DATES.format('errors')} AS error_dates, {_DATES.format('warnings')} AS warning_dates""",
)
def _totals(spark, sf_dir):
    found = products.totals(_audit(spark, sf_dir))
    return found.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("empty_dates", "error_dates", "warning_dates")})


@query("distinct_counts", f"{_SEGMENTS} SELECT CAST(count(DISTINCT instrument_id) AS BIGINT) AS instruments, CAST(count(DISTINCT roll_segment) AS BIGINT) AS segments FROM seg")
def _distinct(spark, sf_dir):
    rows = order.with_roll_segment(ticks_from_events(spark, sf_dir))
    return rows.agg(F.countDistinct("instrument_id").alias("instruments"), F.countDistinct("roll_segment").alias("segments"))


@query("empty_sessions", f"{TICKS}, {_CALENDAR} SELECT c.session_date_ny, CAST(count(t.price) AS BIGINT) AS record_count, count(t.price) = 0 AS empty FROM cal c LEFT JOIN ticks t USING (session_date_ny) GROUP BY 1")
def _empties(spark, sf_dir):
    return A.session_audit(ticks_from_events(spark, sf_dir), sessions=tf.calendar(spark, FIRST, LAST)).select("session_date_ny", "record_count", "empty")


# ---- joins over calendar, inventory, mappings, policy --------------------------------------------------------------


@query("calendar_missing_dates", f"{TICKS}, {_CALENDAR}, have AS (SELECT DISTINCT session_date_ny FROM ticks) SELECT 'missing' AS kind, session_date_ny FROM cal ANTI JOIN have USING (session_date_ny) UNION ALL SELECT 'unexpected', session_date_ny FROM have ANTI JOIN cal USING (session_date_ny)")
def _missing(spark, sf_dir):
    have, due = ticks_from_events(spark, sf_dir).select("session_date_ny").distinct(), tf.calendar(spark, FIRST, LAST)
    told = lambda kind, a, b: a.join(b, "session_date_ny", "left_anti").select(F.lit(kind).alias("kind"), "session_date_ny")
    return told("missing", due, have).unionByName(told("unexpected", have, due))


@query("manifest_enrich", f"{TICKS}, {_CALENDAR}, per AS (SELECT session_date_ny, count(*) AS n FROM ticks GROUP BY 1) SELECT session_date_ny, 'f-' || session_date_ny AS raw_file, CAST(n AS BIGINT) AS record_count FROM cal JOIN per USING (session_date_ny)")
def _enrich(spark, sf_dir):
    files = _calendar_inventory(spark).select(F.col("session_date").cast("date").alias("session_date_ny"), "raw_file", "record_count")
    return products.enrich(files, A.trade_activity(ticks_from_events(spark, sf_dir)).select("session_date_ny", "record_count"))


@query("mapping_interval_join", f"{TICKS}, s AS (SELECT DISTINCT session_date_ny FROM ticks), m(a, b, instrument_id) AS (VALUES (DATE '2023-12-20', DATE '2024-01-09', 100), (DATE '2024-01-09', DATE '2024-01-20', 101), (DATE '2024-01-15', DATE '2024-02-01', 102)) SELECT session_date_ny, CAST(instrument_id AS BIGINT) AS instrument_id FROM s JOIN m ON a <= session_date_ny AND session_date_ny < b")
def _mapping(spark, sf_dir):
    rows = [("2023-12-20", "2024-01-09", 100), ("2024-01-09", "2024-01-20", 101), ("2024-01-15", "2024-02-01", 102)]
    table = spark.createDataFrame(rows, "start_date string, end_date string, instrument_id long").selectExpr("date(start_date) start_date", "date(end_date) end_date", "instrument_id")
    return A.mapped_instruments(table, ticks_from_events(spark, sf_dir).select("session_date_ny").distinct())


@query("split_lookup", f"WITH {_CALENDAR} SELECT session_date_ny, {_SPLIT} AS split FROM cal")
def _split_lookup(spark, sf_dir):
    return tf.calendar(spark, FIRST, LAST).withColumn("split", policy.split_column(F.col("session_date_ny")))


@query("split_assignments", f"WITH {_CALENDAR} SELECT CAST(session_date_ny AS VARCHAR) AS session_date_ny, {_SPLIT} AS split, CAST({_COUNT} AS BIGINT) AS record_count, 'f-' || session_date_ny AS raw_file, sha256(CAST(session_date_ny AS VARCHAR)) AS raw_sha256 FROM cal")
def _assignments(spark, sf_dir):
    return policy.assignments(_calendar_inventory(spark))


@query("split_summary", f"WITH {_CALENDAR}, a AS (SELECT {_SPLIT} AS split, {_COUNT} AS record_count FROM cal) SELECT split, CAST(count(*) AS BIGINT) AS sessions, CAST(count(*) FILTER (WHERE record_count = 0) AS BIGINT) AS empty_sessions, CAST(sum(record_count) AS BIGINT) AS records FROM a GROUP BY split")
def _split_summary(spark, sf_dir):
    return policy.split_summary(policy.assignments(_calendar_inventory(spark)))


@query("count_mismatches", f"{TICKS}, {_CALENDAR}, per AS (SELECT session_date_ny, count(*) AS n FROM ticks GROUP BY 1), inv AS (SELECT session_date_ny, {_COUNT} AS n FROM cal) SELECT coalesce(a.session_date_ny, b.session_date_ny) AS session_date_ny, CAST(a.n AS BIGINT) AS records, CAST(b.n AS BIGINT) AS expected FROM per a FULL JOIN inv b ON a.session_date_ny = b.session_date_ny WHERE a.n IS DISTINCT FROM b.n")
def _mismatches(spark, sf_dir):
    due = _calendar_inventory(spark).select(F.col("session_date").cast("date").alias("session_date_ny"), F.col("record_count").alias("expected"))
    both = products.records_per_day(ticks_from_events(spark, sf_dir)).join(due, "session_date_ny", "full_outer")
    return both.where(~F.col("records").eqNullSafe(F.col("expected")))


# ---- resources, metadata, bytes ------------------------------------------------------------------------------------


@query("memory_tier", "SELECT c_custkey, CASE WHEN c_custkey % 40 >= 16 THEN 'high' WHEN c_custkey % 40 >= 8 THEN 'medium' ELSE 'low' END AS tier FROM customer")
def _tier(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return rows.select("c_custkey", resources.memory_tier_column(F.col("c_custkey") % 40).alias("tier"))


@query("chronological_chunks", f"{TICKS} SELECT session_date_ny, CAST(ntile(4) OVER (ORDER BY session_date_ny) AS INTEGER) AS chunk FROM (SELECT DISTINCT session_date_ny FROM ticks)")
def _chunks(spark, sf_dir):
    return resources.chunk_column(ticks_from_events(spark, sf_dir), "session_date_ny", 4)


@query("key_union", f"WITH {_CALENDAR} SELECT CAST(session_date_ny AS VARCHAR) AS name, CAST(day(session_date_ny) AS BIGINT) AS only_a, NULL::BIGINT AS only_b FROM cal UNION ALL SELECT n_name, NULL, CAST(n_nationkey AS BIGINT) FROM nation")
def _key_union(spark, sf_dir):
    a = tf.calendar(spark, FIRST, LAST).select(F.col("session_date_ny").cast("string").alias("name"), F.day("session_date_ny").cast("long").alias("only_a"))
    b = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("name"), F.col("n_nationkey").cast("long").alias("only_b"))
    return a.unionByName(b, allowMissingColumns=True)


@query("json_encode", f"{TICKS}, g AS (SELECT session_date_ny, instrument_id FROM ticks GROUP BY ALL) SELECT '[' || string_agg(CAST(instrument_id AS VARCHAR), ',' ORDER BY instrument_id) || ']' AS instrument_ids, session_date_ny FROM g GROUP BY session_date_ny")
def _json(spark, sf_dir):
    return store.flat(A.instrument_sets(ticks_from_events(spark, sf_dir)))


@query("content_sha256", "SELECT page_id, sha256(html) AS sha256 FROM pages")
def _content(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.sha2("html", 256).alias("sha256"))


@query("verify_added_columns", "SELECT CAST(0 AS BIGINT) AS differing")
def _verify(spark, sf_dir):
    return normalize.differing_rows(normalize.normalize(ticks_from_events(spark, sf_dir))).agg(F.count(F.lit(1)).alias("differing"))


@query("native_round_trip", f"{TICKS} SELECT session_date_ny, CAST(count(*) AS BIGINT) AS same FROM ticks GROUP BY session_date_ny")
def _round_trip(spark, sf_dir):
    ticks = ticks_from_events(spark, sf_dir)
    back = native.unpacked(native.packed(ticks))
    return back.join(ticks, back.columns).groupBy("session_date_ny").agg(F.count(F.lit(1)).alias("same"))


def _little_endian(column: str, kind: str) -> str:
    """A native field as hexadecimal text, lowest byte first."""
    if kind == "S1":
        return f"format('{{:02x}}', ascii({column}))"
    width = int(kind[2])
    whole = f"((CAST({column} AS HUGEINT) + {256**width}) % {256**width})"
    return " || ".join(f"format('{{:02x}}', CAST(({whole} // {256**k}) % 256 AS INTEGER))" for k in range(width))


_RECORD_HEX = " || ".join(_little_endian(column_of(n), k) for n, k in NATIVE)


@query("ordered_digest", f"{TICKS}, r AS (SELECT session_date_ny, event_idx_day, {_RECORD_HEX} AS h FROM ticks) SELECT session_date_ny, CAST(count(*) AS BIGINT) AS records, sha256(unhex(string_agg(h, '' ORDER BY event_idx_day))) AS sha256 FROM r GROUP BY session_date_ny")
def _digest(spark, sf_dir):
    return native.ordered_digest(ticks_from_events(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one-pass session audit: counts, endpoints, classes, status."""
    return _audit(spark, sf_dir).drop("checks", "first_example_event_idx")
