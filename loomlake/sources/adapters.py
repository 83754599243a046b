"""The driver's ``events`` table as ticks: integer expressions only, with sentinels, repeats and odd rows in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import NATIVE_COLUMNS, NATIVE_SCHEMA

#: One expression for each native column over (event_id, us, day_of_month, user_id, event_type, cents, k). The text is
#: valid in Spark and in ANSI engines alike.
EXPRESSIONS = {
    "length": "20",
    "rtype": "CASE WHEN event_id % 2003 = 0 THEN 2 ELSE 1 END",
    "publisher_id": "1",
    "instrument_id": "100 + cast(floor(day_of_month / 7) as int) + CASE WHEN event_id % 997 = 0 THEN 50 ELSE 0 END",
    "ts_event_raw": "CASE WHEN event_id % 503 = 0 THEN 18446744073709551615 ELSE us * 1000 - ((event_id % 11) - 2) * 1000 END",
    "price": "CASE WHEN event_id % 101 = 0 THEN 9223372036854775807 WHEN event_id % 131 = 0 THEN 0 ELSE cents * 10000000 END",
    "size": "CASE WHEN event_id % 113 = 0 THEN 4294967295 WHEN event_id % 59 = 0 THEN 0 ELSE k END",
    "action": "CASE event_type WHEN 'purchase' THEN 'T' WHEN 'view' THEN 'M' WHEN 'click' THEN 'A' WHEN 'error' THEN 'C' WHEN 'signup' THEN 'R' ELSE 'X' END",
    "side": "CASE user_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'N' END",
    "flags": "CASE WHEN event_id % 4 = 0 THEN 0 ELSE 128 END + CASE WHEN event_id % 211 = 0 THEN 8 ELSE 0 END + CASE WHEN event_id % 307 = 0 THEN 4 ELSE 0 END + CASE WHEN event_id % 401 = 0 THEN 32 ELSE 0 END",
    "depth": "0",
    "ts_recv_raw": "CASE WHEN event_id % 1009 = 0 THEN 18446744073709551615 ELSE us * 1000 END",
    "ts_in_delta": "CASE WHEN event_id % 601 = 0 THEN 2147483647 WHEN event_id % 17 = 0 THEN -5 ELSE event_id % 1000 END",
    "sequence": "event_id + 10 - CASE WHEN event_id % 89 = 0 THEN 3 ELSE 0 END",
    "bid_px_00": "CASE WHEN event_id % 103 = 0 THEN 9223372036854775807 ELSE cents * 10000000 - 10000000 * (event_id % 3) + CASE WHEN event_id % 97 = 0 THEN 50000000 ELSE 0 END END",
    "ask_px_00": "CASE WHEN event_id % 107 = 0 THEN 9223372036854775807 ELSE cents * 10000000 END",
    "bid_sz_00": "CASE WHEN event_id % 127 = 0 THEN 4294967295 ELSE 1 + event_id % 5 END",
    "ask_sz_00": "CASE WHEN event_id % 139 = 0 THEN 4294967295 ELSE 1 + event_id % 7 END",
    "bid_ct_00": "1 + event_id % 3",
    "ask_ct_00": "1",
}
#: Every such event is delivered twice: an exact repeat right after the first.
REPEATED = "event_id % 61 = 0"


def ticks_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in TICK_SCHEMA; the UTC day stands for the session, delivery order is (ts, event_id, repeat)."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    base = events.select(
        F.col("ts").cast("date").alias("session_date_ny"),
        "event_id",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("us"),
        F.day("ts").alias("day_of_month"),
        "user_id",
        "event_type",
        F.round(F.col("value") * 100).cast("long").alias("cents"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("long").alias("k"),
        F.explode(F.when(F.expr(REPEATED), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"),
    )
    kinds = {f.name: f.dataType for f in NATIVE_SCHEMA}
    native = base.withColumns({c: F.expr(EXPRESSIONS[c]).cast(kinds[c]) for c in NATIVE_COLUMNS})
    place = F.row_number().over(Window.partitionBy("session_date_ny").orderBy("us", "event_id", "again")) - 1
    return native.select("session_date_ny", place.cast("long").alias("event_idx_day"), *NATIVE_COLUMNS)


#: The same rows for the oracle engine.
TICKS_SQL = (
    "base AS (SELECT cast(ts AS DATE) AS session_date_ny, event_id, epoch_us(ts) AS us, day(ts) AS day_of_month, user_id, event_type, "
    "cast(round(value * 100) AS BIGINT) AS cents, cast(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, unnest(CASE WHEN "
    + REPEATED
    + " THEN [0, 1] ELSE [0] END) AS again FROM events), ticks AS (SELECT session_date_ny, cast(row_number() OVER (PARTITION BY session_date_ny ORDER BY us, event_id, again) - 1 AS BIGINT) AS event_idx_day, "
    + ", ".join(f"cast({EXPRESSIONS[c]} AS {'VARCHAR' if c in ('action', 'side') else 'HUGEINT' if c.endswith('_raw') else 'BIGINT'}) AS {c}" for c in NATIVE_COLUMNS)
    + " FROM base)"
)
