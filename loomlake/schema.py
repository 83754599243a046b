"""The tick record: its fields in order, their storage, their sentinels and flag bits."""

from __future__ import annotations

from pyspark.sql import types as T

#: Fixed values of the record format: the field names, their order and their storage in 80 little-endian bytes.
NATIVE = [
    ("length", "<u1"),
    ("rtype", "<u1"),
    ("publisher_id", "<u2"),
    ("instrument_id", "<u4"),
    ("ts_event", "<u8"),
    ("price", "<i8"),
    ("size", "<u4"),
    ("action", "S1"),
    ("side", "S1"),
    ("flags", "<u1"),
    ("depth", "<u1"),
    ("ts_recv", "<u8"),
    ("ts_in_delta", "<i4"),
    ("sequence", "<u4"),
    ("bid_px_00", "<i8"),
    ("ask_px_00", "<i8"),
    ("bid_sz_00", "<u4"),
    ("ask_sz_00", "<u4"),
    ("bid_ct_00", "<u4"),
    ("ask_ct_00", "<u4"),
]
RECORD_BYTES = 80

#: What the format writes for "undefined".
UNDEF_PRICE = 2**63 - 1
UNDEF_TIMESTAMP = 2**64 - 1
UNDEF_ORDER_SIZE = 2**32 - 1

#: The bits of ``flags``.
FLAG_BITS = {"last": 128, "top_of_book": 64, "snapshot": 32, "market_by_price": 16, "bad_ts_recv": 8, "maybe_bad_book": 4, "publisher": 2}
LAST_BIT = FLAG_BITS["last"]

_SPARK = {"<u1": T.ShortType(), "<u2": T.IntegerType(), "<u4": T.LongType(), "<i4": T.IntegerType(), "<i8": T.LongType(), "<u8": T.DecimalType(20, 0), "S1": T.StringType()}


def column_of(field: str) -> str:
    """A native field's column: the unsigned timestamps keep every bit in *_raw decimals."""
    return f"{field}_raw" if field in ("ts_event", "ts_recv") else field


NATIVE_COLUMNS = [column_of(name) for name, _ in NATIVE]
NATIVE_SCHEMA = T.StructType([T.StructField(column_of(name), _SPARK[kind]) for name, kind in NATIVE])
#: Native records with their session and their place in it.
TICK_SCHEMA = T.StructType([T.StructField("session_date_ny", T.DateType()), T.StructField("event_idx_day", T.LongType()), *NATIVE_SCHEMA])
#: What is known of a stored table beyond its columns.
TABLE_NOTES = {"price_scale": "1e-9", "ordering": "session_date_ny, event_idx_day", "session_date_semantics": "requested session, never event time"}
