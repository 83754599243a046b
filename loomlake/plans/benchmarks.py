"""Timed scans of a store, each held against the manifest's counts."""

from __future__ import annotations

import resource
import time
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.products import records_per_day
from ..sources.access import committed_files, scan


@dataclass(frozen=True)
class Case:
    name: str
    first: str
    last: str
    columns: tuple[str, ...] | None = None
    by_day: bool = False


#: The published cases.
CASES = [
    Case("one_day_all_columns", "2024-09-03", "2024-09-03"),
    Case("one_month_selected_columns", "2024-09-01", "2024-09-30", ("ts_event_raw", "instrument_id", "price", "bid_px_00", "ask_px_00")),
    Case("one_day_selected_columns", "2024-09-03", "2024-09-03", ("ts_event_raw", "price")),
    Case("date_range_two_months", "2024-08-26", "2024-09-06", ("ts_event_raw", "sequence", "action", "size")),
    Case("records_per_day", "2024-09-01", "2024-09-30", ("session_date_ny",), True),
]


def query_benchmarks(spark: SparkSession, root: str | Path, manifest: DataFrame, cases: list[Case] = CASES, repeats: int = 2) -> list[dict]:
    """One row for each case and repeat: rows, expected rows, files, seconds, the driver's peak memory.

    ``manifest``: session_date_ny, record_count. ValueError if a scan's rows differ from it. Whole rows are read, not
    counted from footers: they go through a hash over the case's columns.
    """
    out = []
    for case in cases:
        due = manifest.where(F.col("session_date_ny").between(F.lit(case.first).cast("date"), F.lit(case.last).cast("date")))
        expected = due.agg(F.coalesce(F.sum("record_count"), F.lit(0))).first()[0]
        files = committed_files(root, case.first, case.last)
        for repeat in range(repeats):
            began = time.perf_counter()
            rows = scan(spark, root, case.first, case.last, list(case.columns) if case.columns else None)
            if case.by_day:
                n = sum(r["records"] for r in records_per_day(rows).collect())  # a row for each day of the case
            else:
                n = rows.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*rows.columns)).alias("x")).first()["n"]
            took = time.perf_counter() - began
            if n != expected:
                raise ValueError(f"{case.name}: {n} rows, the manifest has {expected}")
            told = {"query": case.name, "repeat": repeat, "start": case.first, "end": case.last, "columns": list(case.columns or rows.columns)}
            out.append(told | {"rows": n, "expected_rows": expected, "candidate_files": len(files), "seconds": took, "driver_rss_mb": resource.getrusage(resource.RUSAGE_SELF).ru_maxrss / 1024})
    return out
