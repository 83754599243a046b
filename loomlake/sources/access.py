"""Guarded scans: authorised first, then resolved through the catalog, then a plain lazy DataFrame."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.policy import SPLITS, authorize

DONE = "_SUCCESS.json"


def committed_files(root: str | Path, first: str, last: str, **allowed: bool) -> list[str]:
    """The parts of the published months that meet a range; whatever the catalog does not name stays unseen.

    Objections in order: those of :func:`authorize`, no catalog, a changed fingerprint, a changed size, no month.
    """
    a, b = authorize(first, last, **allowed)
    root = Path(root)
    if not (root / DONE).is_file():
        raise FileNotFoundError(f"{root} has no published catalog")
    found = []
    for row in json.loads((root / DONE).read_text())["partitions"]:
        if not f"{a:%Y-%m}" <= row["month"] <= f"{b:%Y-%m}":
            continue
        place = root / row["path"]
        told = json.loads((place / DONE).read_text())
        if told["fingerprint"] != row["fingerprint"]:
            raise ValueError(f"{row['month']}: the checkpoint is not the one that the catalog names")
        for f in told["files"]:
            part = place / f["name"]
            if not part.is_file() or part.stat().st_size != f["bytes"]:
                raise ValueError(f"{part} does not have the published size")
            found.append(str(part))
    if not found:
        raise ValueError("No completed partitions")
    return found


def scan(spark: SparkSession, root: str | Path, first: str, last: str, columns: list[str] | None = None, *, allow_validation: bool = False, allow_final_test: bool = False) -> DataFrame:
    """The rows of a date range, both ends included. Order is not part of a scan: sort by session and place."""
    files = committed_files(root, first, last, allow_validation=allow_validation, allow_final_test=allow_final_test)
    rows = spark.read.parquet(*files).where(F.col("session_date_ny").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return rows.select(*columns) if columns is not None else rows


def scan_development(spark: SparkSession, root: str | Path, first: str | None = None, last: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """:func:`scan` over the development split, whole by default; it has no way to open a holdout."""
    whole = SPLITS["development"]
    return scan(spark, root, first or whole.start.isoformat(), last or whole.end.isoformat(), columns)


def row_groups_met(paths: list[str], first: str, last: str) -> tuple[int, int]:
    """(row groups whose statistics meet the range, all row groups)."""
    import datetime

    import pyarrow.parquet as pq

    a, b = datetime.date.fromisoformat(first), datetime.date.fromisoformat(last)
    met = total = 0
    for path in paths:
        meta = pq.ParquetFile(path).metadata
        at = meta.schema.names.index("session_date_ny")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            met += stats is None or not stats.has_min_max or (stats.min <= b and stats.max >= a)
    return met, total
