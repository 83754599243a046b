"""Small synthetic sessions of native records."""

from datetime import date
from decimal import Decimal

import numpy as np

from loomlake.functions.ticks import session_bounds
from loomlake.operators.native import RECORD
from loomlake.schema import NATIVE, TICK_SCHEMA, column_of

DAY = "2024-09-02"


def records(n: int = 6, day: str = DAY) -> np.ndarray:
    """A clean session but for its trailing gap."""
    out = np.zeros(n, RECORD)
    at = np.arange(n, dtype="u8") + np.uint64(session_bounds(day)[0] + 100)
    out["length"], out["rtype"], out["publisher_id"], out["instrument_id"] = 20, 1, 1, 100
    out["ts_recv"], out["ts_event"] = at, at - np.uint64(10)
    out["price"] = out["ask_px_00"] = 2_500_100_000_000
    out["bid_px_00"] = 2_500_000_000_000
    for c in ("size", "bid_sz_00", "ask_sz_00", "bid_ct_00", "ask_ct_00"):
        out[c] = 1
    out["action"], out["side"], out["flags"], out["sequence"] = b"T", b"B", 128, np.arange(n)
    return out


def ticks(spark, *sessions: tuple[str, np.ndarray]):
    rows = []
    for day, found in sessions:
        for i, r in enumerate(found):
            row = [date.fromisoformat(day), i]
            for name, kind in NATIVE:
                v = r[name]
                row.append(Decimal(int(v)) if kind == "<u8" else v.decode() if kind == "S1" else int(v))
            assert len(row) - 2 == len([column_of(n) for n, _ in NATIVE])
            rows.append(tuple(row))
    return spark.createDataFrame(rows, TICK_SCHEMA)
