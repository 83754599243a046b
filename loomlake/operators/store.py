"""The store: month partitions that are staged, reconciled and published whole, behind a catalog that fails closed.

Layout: <root>/year=YYYY/month=MM/{part-*.parquet, _SUCCESS.json} and <root>/_SUCCESS.json, the catalog. A month is
written by one Spark job into a stage folder, read back, compared with its source by count, order and digest, hashed
on the executors, and renamed into place; the catalog is taken away before a rebuild and written last. The state that
each month starts from is known beforehand by one pass over all of them, so months are built side by side. Renames and
locks run on the driver over a file system that it shares with the executors.
"""

from __future__ import annotations

import contextlib
import fcntl
import hashlib
import json
import os
import platform
import shutil
import time
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .native import ordered_digest
from .normalize import normalize
from .order import contract_segments, index_contiguity, outgoing_state, require, with_roll_segment

DONE, PART_ROWS, GROUP_ROWS = "_SUCCESS.json", 5_000_000, 250_000
#: Months that are built at a time.
SIDE_BY_SIDE = 4


def project_path(value: str | Path, root: str | Path | None = None) -> Path:
    """A path as given if absolute, else below the project's root."""
    path = Path(value)
    return path if path.is_absolute() else Path(root or Path(__file__).resolve().parents[2]) / path


def write_json(path: str | Path, value: object) -> None:
    """JSON with sorted keys, complete or not there at all."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    fresh = path.with_name(f"{path.name}.{uuid.uuid4().hex}.new")
    fresh.write_text(json.dumps(value, sort_keys=True, indent=2, default=str))
    os.replace(fresh, path)


def file_sha256(path: str | Path) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def file_hashes(spark: SparkSession, paths: list[Path]) -> dict[str, str]:
    """SHA-256 of each file by its path, read by the executors, a file a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([file_sha256(x) for x in names], pa.string())], names=["path", "sha256"])

    if not paths:
        return {}
    table = spark.createDataFrame([(str(p),) for p in paths], "path string").repartition(len(paths), "path")
    return {r["path"]: r["sha256"] for r in table.mapInArrow(run, "path string, sha256 string").collect()}  # a row a file


def local_path(folder: str) -> str:
    """A folder's path without the scheme file:; ValueError for stores that cannot rename and lock."""
    if folder.startswith("file:"):
        return "/" + folder.removeprefix("file:").lstrip("/")
    if "://" in folder:
        raise ValueError(f"{folder} is not on a file system that can rename and lock")
    return folder


def identity() -> dict:
    """What a stored month depends on besides its sources: versions, the code of this package, sizes."""
    import numpy
    import pyarrow
    import pyspark

    code = Path(__file__).resolve().parents[1]
    modules = sorted(p for d in ("operators", "functions") for p in (code / d).glob("*.py"))
    return {
        "versions": {"python": platform.python_version(), "pyspark": pyspark.__version__, "numpy": numpy.__version__, "pyarrow": pyarrow.__version__},
        "code": {p.relative_to(code).as_posix(): file_sha256(p) for p in [*modules, code / "schema.py"]},
        "part_rows": PART_ROWS,
        "group_rows": GROUP_ROWS,
    }


def fingerprint(config: dict, sources: list[dict], state: dict) -> str:
    """SHA-256 over the sorted JSON of configuration, sources and incoming state."""
    told = json.dumps({"config": config, "sources": sources, "incoming_state": state}, sort_keys=True, default=str)
    return hashlib.sha256(told.encode()).hexdigest()


def migration_fingerprint(review: dict, config: dict, sources: list[dict], state: dict) -> str | None:
    """The fingerprint under the original build's configuration, if ``config`` is exactly the reviewed one; else None."""
    if review.get("schema_version") != 1 or review.get("reviewed_runtime_config") != config:
        return None
    return fingerprint(review["original_build_config"], sources, state)


@contextlib.contextmanager
def writer_lock(root: str | Path) -> Iterator[None]:
    """The only writer of a store; RuntimeError at once if there is another."""
    Path(root).mkdir(parents=True, exist_ok=True)
    with open(Path(root) / ".writer.lock", "w") as f:
        try:
            fcntl.flock(f, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except BlockingIOError:
            raise RuntimeError(f"another writer holds {root}") from None
        yield


def publish(stage: str | Path, place: str | Path, tries: int = 10) -> None:
    """Rename a folder into place; a busy file system gets more tries, each after a longer pause."""
    for n in range(tries):
        try:
            Path(place).parent.mkdir(parents=True, exist_ok=True)
            os.replace(stage, place)
            return
        except OSError:
            if n + 1 == tries:
                raise
            time.sleep(min(0.25 * (n + 1), 2))


def write_parts(table: DataFrame, folder: str | Path, part_rows: int = PART_ROWS, group_rows: int = GROUP_ROWS) -> None:
    """Parquet in delivery order: zstd, page checksums, capped parts and row groups, none of which crosses a session.

    Parts are numbered in order of session and place.
    """
    folder = Path(folder)
    ordered = table.withColumn("day_", F.col("session_date_ny").cast("string")).repartitionByRange("session_date_ny", "event_idx_day").sortWithinPartitions("day_", "event_idx_day")
    writer = ordered.write.option("compression", "zstd").option("parquet.page.write-checksum.enabled", "true").partitionBy("day_")
    writer.option("parquet.block.row.count.limit", group_rows).option("maxRecordsPerFile", part_rows).parquet(str(folder / "_days"))
    for n, part in enumerate(sorted((folder / "_days").glob("day_=*/part-*.parquet"))):
        os.replace(part, folder / f"part-{n:05d}.parquet")
    shutil.rmtree(folder / "_days")


def require_order(folder: str | Path, schema: T.StructType, spark: SparkSession) -> None:
    """ValueError unless each stored part holds one session's rows, each at the place after the row before it."""
    rows = spark.read.schema(schema).parquet(str(folder)).select("session_date_ny", "event_idx_day", F.col("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("row"))
    shift = F.col("event_idx_day") - F.col("row")
    parts = rows.groupBy("part").agg(F.min("session_date_ny").alias("a"), F.max("session_date_ny").alias("b"), F.min(shift).alias("low"), F.max(shift).alias("high"), F.max("event_idx_day").alias("last"))
    require(parts, (F.col("a") != F.col("b")) | (F.col("low") != F.col("high")), "a part is not in delivery order")
    before = Window.orderBy("part")  # a row a part
    after = parts.select("part", "a", "low", F.lag("b").over(before).alias("day"), F.lag("last").over(before).alias("place"))
    require(after, (F.col("a") < F.col("day")) | ((F.col("a") == F.col("day")) & (F.col("low") != F.col("place") + 1)), "parts are not in delivery order")


def reconcile(stored: DataFrame, source: DataFrame) -> None:
    """ValueError unless both have the same sessions with the same counts and native bytes, in gapless order."""
    require(index_contiguity(stored), ~F.col("contiguous"), "stored places are not 0 to n - 1")
    a, b = ordered_digest(stored), ordered_digest(source).toDF("session_date_ny", "source_records", "source_sha256")
    both = a.join(b, "session_date_ny", "full_outer")
    require(both, ~F.col("records").eqNullSafe(F.col("source_records")), "record counts differ")
    require(both, ~F.col("sha256").eqNullSafe(F.col("source_sha256")), "native-byte digests differ")


def _month_dir(root: Path, month: str) -> Path:
    return root / f"year={month[:4]}" / f"month={month[5:7]}"


def footer_rows(path: str | Path) -> int:
    return pq.ParquetFile(path).metadata.num_rows


def valid_checkpoint(spark: SparkSession, place: Path, accepted: list[str | None]) -> dict | None:
    """The month's checkpoint if it carries an accepted fingerprint; ValueError if its parts were modified since."""
    done = place / DONE
    if not done.is_file():
        return None
    told = json.loads(done.read_text())
    if told["fingerprint"] not in [x for x in accepted if x]:
        return None
    parts = {place / f["name"]: f for f in told["files"]}
    there = {p for p, f in parts.items() if p.is_file() and p.stat().st_size == f["bytes"]}
    hashes = file_hashes(spark, sorted(there))
    for part, f in parts.items():
        if hashes.get(str(part)) != f["sha256"]:
            raise ValueError(f"{part} was modified after it was published")
    return told


def build_month(ticks: DataFrame, month: str, root: str | Path, sources: list[dict], state: dict | None = None, config: dict | None = None, *, review: dict | None = None, reuse_only: bool = False) -> dict:
    """Build or reuse one month (YYYY-MM) of the store; returns its checkpoint, with the outgoing state.

    A checkpoint with the same fingerprint is reused as it is. ``reuse_only``: RuntimeError rather than a rebuild.
    """
    root = Path(root)
    state, config = state or {"last_id": None, "roll_segment": 1}, config if config is not None else identity()
    mark, place = fingerprint(config, sources, state), _month_dir(root, month)
    told = valid_checkpoint(ticks.sparkSession, place, [mark, migration_fingerprint(review, config, sources, state) if review else None])
    if told:
        return told
    if reuse_only:
        raise RuntimeError(f"{month} would have to be built anew")
    (root / DONE).unlink(missing_ok=True)
    rows = ticks.where(F.date_format("session_date_ny", "yyyy-MM") == month)
    stage = root / "_stage" / f"{month}-{uuid.uuid4().hex}"
    spark = ticks.sparkSession
    write_parts(normalize(rows, state["roll_segment"], state["last_id"]), stage)
    # schema given: a month without rows has no part to tell it
    schema = normalize(rows).schema
    stored = spark.read.schema(schema).parquet(str(stage))
    reconcile(stored, rows)
    require_order(stage, schema, spark)
    parts = sorted(stage.glob("part-*.parquet"))
    hashes = file_hashes(spark, parts)
    out = outgoing_state(stored.drop("contract_change", "roll_segment"), state["roll_segment"], state["last_id"])
    told = {
        "month": month,
        "fingerprint": mark,
        "files": [{"name": p.name, "bytes": p.stat().st_size, "rows": footer_rows(p), "sha256": hashes[str(p)]} for p in parts],
        "incoming_state": state,
        "outgoing_state": out,
    }
    write_json(stage / DONE, told)
    if place.exists():
        publish(place, root / "_superseded" / f"{month}-{uuid.uuid4().hex}")
    publish(stage, place)
    return told


def write_catalog(root: str | Path, checkpoints: list[dict]) -> None:
    """The catalog of published months: what readers go by, written last."""
    rows = [{"month": c["month"], "path": _month_dir(Path(), c["month"]).as_posix(), "fingerprint": c["fingerprint"]} for c in sorted(checkpoints, key=lambda c: c["month"])]
    write_json(Path(root) / DONE, {"partitions": rows})


def month_states(ticks: DataFrame, months: list[str]) -> dict[str, dict]:
    """The state each month starts from, by one pass over all months: the last instrument and roll segment before it."""
    month = F.date_format("session_date_ny", "yyyy-MM")
    rows = with_roll_segment(ticks.where(month.isin(months))).select(month.alias("month"), F.struct("session_date_ny", "event_idx_day").alias("place"), F.struct("instrument_id", "roll_segment").alias("state"))
    last = {r["month"]: r["s"] for r in rows.groupBy("month").agg(F.max_by("state", "place").alias("s")).collect()}  # a row a month
    state, out = {"last_id": None, "roll_segment": 1}, {}
    for m in sorted(months):
        out[m] = state
        if m in last:
            state = {"last_id": last[m]["instrument_id"], "roll_segment": last[m]["roll_segment"]}
    return out


def build_store(ticks: DataFrame, months: list[str], root: str | Path, sources: dict[str, list[dict]], **how) -> list[dict]:
    """All months, each from the state that the ones before it leave, some of them at a time, then the catalog; a status
    file tells RUNNING, COMPLETE or FAILED with the error."""
    root = Path(root)
    with writer_lock(root):
        write_json(root / "_run.json", {"status": "RUNNING"})
        try:
            states = month_states(ticks, months)
            with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
                done = list(pool.map(lambda m: build_month(ticks, m, root, sources.get(m, []), states[m], **how), sorted(months)))
            for a, b in zip(done, done[1:], strict=False):
                if a["outgoing_state"] != b["incoming_state"]:
                    raise ValueError(f"{b['month']} does not start from the state that {a['month']} leaves")
            write_catalog(root, done)
        except BaseException as error:
            write_json(root / "_run.json", {"status": "FAILED", "error": f"{type(error).__name__}: {error}"})
            raise
        write_json(root / "_run.json", {"status": "COMPLETE", "months": len(done), "records": sum(f["rows"] for c in done for f in c["files"])})
    return done


def flat(table: DataFrame) -> DataFrame:
    """Nested values as JSON text, columns in name order."""
    nested = {f.name for f in table.schema if f.dataType.typeName() in ("array", "map", "struct")}
    return table.select(*(F.to_json(c).alias(c) if c in nested else F.col(c) for c in sorted(table.columns)))


def write_metadata(table: DataFrame, folder: str | Path, name: str) -> None:
    """A small table as Parquet and CSV twins; they are metadata, so one file each."""
    one = flat(table).coalesce(1)
    one.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    one.write.mode("overwrite").option("header", "true").csv(f"{folder}/{name}.csv")


def freeze(path: str | Path, rows: list[dict]) -> str:
    """An immutable ledger: written once; the same rows again are fine, others raise. Returns its SHA-256."""
    body = json.dumps(rows, sort_keys=True, indent=1, default=str)
    try:
        with open(path, "x") as f:
            f.write(body)
    except FileExistsError:
        if Path(path).read_text() != body:
            raise ValueError(f"{path} is frozen with other rows") from None
    return hashlib.sha256(body.encode()).hexdigest()


def _verify_files(spark: SparkSession, root: Path, hashes: bool) -> list[dict]:
    """The checkpoints that the catalog names, held against catalog, footers and, if asked for, hashes."""
    told = []
    for row in json.loads((root / DONE).read_text())["partitions"]:
        done = json.loads((root / row["path"] / DONE).read_text())
        if done["fingerprint"] != row["fingerprint"]:
            raise ValueError(f"{row['month']}: catalog and checkpoint have different fingerprints")
        told.append(done)
    parts = {_month_dir(root, c["month"]) / f["name"]: f for c in told for f in c["files"]}
    found = file_hashes(spark, sorted(parts)) if hashes else {}
    for part, f in parts.items():
        if footer_rows(part) != f["rows"] or part.stat().st_size != f["bytes"]:
            raise ValueError(f"{part} has {footer_rows(part)} rows in {part.stat().st_size} bytes, its checkpoint {f['rows']} in {f['bytes']}")
        if hashes and found[str(part)] != f["sha256"]:
            raise ValueError(f"{part} was modified after it was published")
    return told


def _verify_pruning(root: Path, stored: DataFrame) -> dict | None:
    """Row groups that a scan of one session reads, of all of its month; None if no month has two sessions."""
    from ..sources.access import committed_files, row_groups_met

    months = stored.groupBy(F.date_format("session_date_ny", "yyyy-MM").alias("m")).agg(F.min("session_date_ny").alias("a"), F.max("session_date_ny").alias("b"))
    row = months.where("a < b").orderBy("m").first()
    if not row:
        return None
    a, b = row["a"].isoformat(), row["b"].isoformat()
    met, total = row_groups_met(committed_files(root, a, b, allow_validation=True, allow_final_test=True), a, a)
    if not 0 < met < total:
        raise ValueError(f"a scan of {a} reads {met} of {total} row groups")
    return {"session": a, "row_groups": met, "of": total}


def _verify_boundary(root: Path, stored: DataFrame) -> list[dict]:
    """The first row of the session where the contract first changes and of the one before, as a scan gives them."""
    from ..sources.access import scan

    keys = ["session_date_ny", "event_idx_day", "instrument_id", "roll_segment", "contract_change"]
    change = stored.where("contract_change").agg(F.min("session_date_ny").alias("d")).first()["d"]
    before = stored.where(F.col("session_date_ny") < F.lit(change)).agg(F.max("session_date_ny").alias("d")).first()["d"] if change else None
    told = []
    for day in [d for d in (before, change) if d]:
        rows = scan(stored.sparkSession, root, day.isoformat(), day.isoformat(), keys, allow_validation=True, allow_final_test=True)
        first, due = (x.where(F.col("session_date_ny") == F.lit(day)).select(*keys).orderBy("event_idx_day").first() for x in (rows, contract_segments(stored.drop("contract_change", "roll_segment"))))
        if first["event_idx_day"] != 0 or first["instrument_id"] != due["instrument_id"]:
            raise ValueError(f"the scan of {day} does not begin with its first row")
        told.append(first.asDict())
    return told


def _verify_guards(root: Path) -> dict[str, str]:
    from ..plans.policy import ROLES, SPLITS
    from ..sources.access import committed_files

    for name in ROLES[1:]:
        day = SPLITS[name].start.isoformat()
        try:
            committed_files(root, day, day)
        except PermissionError:
            continue
        raise ValueError(f"{name} can be read without its flag")
    return dict.fromkeys(ROLES[1:], "PASS")


def verify(stored: DataFrame, source: DataFrame, root: str | Path, incoming_segment: int = 1, incoming_id: int | None = None, hashes: bool = True) -> dict:
    """PASS with what was found, or the first failure as a ValueError: fingerprints, footers, sizes and hashes against
    checkpoints and catalog, native bytes and order, additive columns, pruning, the first roll boundary, the guards."""
    from .normalize import differing_rows

    root = Path(root)
    done = _verify_files(stored.sparkSession, root, hashes)
    reconcile(stored, source)
    require(differing_rows(stored, incoming_segment, incoming_id), F.lit(True), "additive columns differ")
    files = [f for c in done for f in c["files"]]
    return {
        "status": "PASS",
        "months": len(done),
        "records": sum(f["rows"] for f in files),
        "bytes": sum(f["bytes"] for f in files),
        "parts": len(files),
        "pruning": _verify_pruning(root, stored),
        "roll_boundary": _verify_boundary(root, stored),
        "guards": _verify_guards(root),
    }


def report(title: str, tables: dict[str, list[dict]]) -> str:
    """Small collected tables as Markdown."""
    out = [f"# {title}"]
    for name, rows in tables.items():
        out += ["", f"## {name}", ""]
        if rows:
            keys = sorted({k for r in rows for k in r})
            out += ["| " + " | ".join(keys) + " |", "|" + "---|" * len(keys)]
            out += ["| " + " | ".join(str(r.get(k, "")) for k in keys) + " |" for r in rows]
    return "\n".join(out) + "\n"
