"""Source files: one session per zstd-compressed record file with a completion marker.

The header follows the public record format, version 3: 8 bytes of prefix, 100 bytes of fixed fields, then symbol
lists and mappings. Files are inspected and decoded on the executors, one partition a file.
"""

from __future__ import annotations

import hashlib
import io
import re
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date
from pathlib import Path
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.ticks import DEGRADED, FILE_NAME, session_bounds, weekdays
from ..operators.native import RECORD, unpack
from ..schema import NATIVE_COLUMNS, RECORD_BYTES, TICK_SCHEMA

#: Rows of a decoded batch, and bytes of a file that are read at once.
CHUNK, BLOCK = 250_000, 64 << 10
#: The header's fixed fields (dataset, schema, start, end, limit, stype in and out, ts_out, symbol width).
FIXED = struct.Struct("<16sHQQQBBBH53x")
VERSION, SYMBOL_WIDTH = 3, 71
#: What the frozen request looks like in a header.
REQUEST = {"dataset": "GLBX.MDP3", "schema": 1, "stype_in": 3, "stype_out": 0, "symbols": ["GC.v.0"], "limit": 0, "ts_out": 0}


@dataclass
class Header:
    version: int
    dataset: str
    schema: int
    start: int
    end: int
    limit: int
    stype_in: int
    stype_out: int
    ts_out: int
    symbols: list[str]
    partial: list[str]
    not_found: list[str]
    mappings: dict[str, list[tuple[date, date, str]]]


def _text(raw: bytes) -> str:
    return raw.split(b"\0", 1)[0].decode()


def encode_header(header: Header) -> bytes:
    """The bytes of a header: for tests and for writing sources of one's own."""
    pad = lambda s, n: s.encode().ljust(n, b"\0")
    names = lambda xs: struct.pack("<I", len(xs)) + b"".join(pad(x, SYMBOL_WIDTH) for x in xs)
    day = lambda d: d.year * 10000 + d.month * 100 + d.day
    body = FIXED.pack(pad(header.dataset, 16), header.schema, header.start, header.end, header.limit, header.stype_in, header.stype_out, header.ts_out, SYMBOL_WIDTH)
    body += struct.pack("<I", 0) + names(header.symbols) + names(header.partial) + names(header.not_found) + struct.pack("<I", len(header.mappings))
    for symbol, spans in header.mappings.items():
        body += pad(symbol, SYMBOL_WIDTH) + struct.pack("<I", len(spans))
        body += b"".join(struct.pack("<II", day(a), day(b)) + pad(s, SYMBOL_WIDTH) for a, b, s in spans)
    return b"DBN" + bytes([header.version]) + struct.pack("<I", len(body)) + body


def decode_header(raw: bytes) -> tuple[Header, int]:
    """The header and its length in bytes."""
    if raw[:3] != b"DBN":
        raise ValueError("not a record file")
    version, size = raw[3], struct.unpack_from("<I", raw, 4)[0]
    if version != VERSION:
        raise ValueError(f"record format version {version} is not supported")
    dataset, schema, start, end, limit, stype_in, stype_out, ts_out, width = FIXED.unpack_from(raw, 8)
    at = 8 + FIXED.size
    at += 4 + struct.unpack_from("<I", raw, at)[0]

    def number() -> int:
        nonlocal at
        at += 4
        return struct.unpack_from("<I", raw, at - 4)[0]

    def name() -> str:
        nonlocal at
        at += width
        return _text(raw[at - width : at])

    def day() -> date:
        n = number()
        return date(n // 10000, n // 100 % 100, n % 100)

    symbols, partial, not_found = ([name() for _ in range(number())] for _ in range(3))
    mappings = {}
    for _ in range(number()):
        symbol = name()
        mappings[symbol] = [(day(), day(), name()) for _ in range(number())]
    return Header(version, _text(dataset), schema, start, end, limit, stype_in, stype_out, ts_out, symbols, partial, not_found, mappings), 8 + size


class Inflated:
    """A zstd file of any number of frames, read and decompressed in blocks; sizes and hash are known at the end."""

    def __init__(self, file: BinaryIO):
        self.file, self.digest = file, hashlib.sha256()
        self.read = self.size = self.frames = 0

    def __iter__(self) -> Iterator[bytes]:
        frame = None
        while block := self.file.read(BLOCK):
            self.read += len(block)
            self.digest.update(block)
            while block:
                frame = frame or zstandard.ZstdDecompressor().decompressobj()
                out, block = frame.decompress(block), b""
                self.size += len(out)
                if out:
                    yield out
                if frame.eof:
                    frame, block, self.frames = None, frame.unused_data, self.frames + 1
        if frame:
            raise ValueError("Incomplete Zstandard frame: the file was cut off")


def decompress(raw: bytes) -> tuple[bytes, int]:
    """All frames of a zstd file and their number; ValueError if the last one is cut off."""
    file = Inflated(io.BytesIO(raw))
    return b"".join(file), file.frames


def read_header(blocks: Iterator[bytes]) -> tuple[bytes, bytes]:
    """(the header's bytes, what was read beyond them); ValueError if the file ends before the header does."""
    held, size = b"", 8
    for block in blocks:
        held += block
        if len(held) >= 8:
            size = 8 + struct.unpack_from("<I", held, 4)[0]
        if len(held) >= size and size > 8:
            return held[:size], held[size:]
    raise ValueError("the header is cut off")


def _known(path: str, file: BinaryIO, marker: bytes | None, changed: Callable[[], bool]) -> dict:
    """What can be told of a file without judging it; reading stops at a fault, which is told as ``fault``."""
    name, row = Path(path).name, dict.fromkeys(INVENTORY_NAMES)
    match = re.fullmatch(FILE_NAME, name)
    row |= {"raw_file": name, "session_date": match[1] if match else None, "done_marker": marker is not None, "folder": Path(path).parent.name, "head": None, "fault": None}
    if marker is not None:
        row |= {"marker_bytes": len(marker), "marker_sha256": hashlib.sha256(marker).hexdigest()}
    inflated = Inflated(file)
    try:
        blocks = iter(inflated)
        row["header"], _ = read_header(blocks)
        row["head"] = decode_header(row["header"])[0]
        for _ in blocks:  # only counted
            pass
        row |= {"uncompressed_bytes": inflated.size, "zstd_frames": inflated.frames}
    except Exception as error:  # any fault of a file belongs in its row
        row["fault"] = f"{type(error).__name__}: {error}"
        while block := file.read(BLOCK):
            inflated.read += len(block)
            inflated.digest.update(block)
    return row | {"file_bytes": inflated.read, "sha256": inflated.digest.hexdigest(), "degraded_source": row["session_date"] in DEGRADED if match else None, "changed": changed()}


#: What must hold of a source file, and what is said where it does not; the first of them is the file's error.
JUDGEMENTS: list[tuple[str, Callable[[dict], bool]]] = [
    ("its name is not that of a session's file", lambda f: f["session_date"] is not None),
    ("it lies in the folder of another year", lambda f: f["folder"] == f["session_date"][:4]),
    ("Missing completion marker", lambda f: f["done_marker"]),
    ("{fault}", lambda f: f["fault"] is None),
    ("the header tells of another request", lambda f: all(getattr(f["head"], k) == v for k, v in REQUEST.items())),
    ("the header's window is not the session's", lambda f: (f["head"].start, f["head"].end) == session_bounds(f["session_date"])),
    ("the last record is not whole", lambda f: (f["uncompressed_bytes"] - len(f["header"])) % RECORD_BYTES == 0),
    ("it changed while it was read", lambda f: not f["changed"]),
]


def inspect(path: str, file: BinaryIO | bytes, marker: bytes | None, changed: Callable[[], bool] = lambda: False) -> dict:
    """One file's inventory row; a fault is told in ``error``, never raised. The file is read in blocks."""
    found = _known(path, io.BytesIO(file) if isinstance(file, bytes) else file, marker, changed)
    wrong = next((said.format(**found) for said, holds in JUDGEMENTS if not holds(found)), None)
    if wrong is None:
        found["record_count"] = (found["uncompressed_bytes"] - len(found["header"])) // RECORD_BYTES
        found["empty"] = found["record_count"] == 0
    return {k: found[k] for k in INVENTORY_NAMES} | {"error": wrong}


def inspect_path(path: str | Path) -> dict:
    """:func:`inspect` for a file on a mounted file system; it must not change meanwhile."""
    path, marker = Path(path), Path(f"{path}.done")
    state = lambda: (path.stat().st_size, path.stat().st_mtime_ns)
    before = state()
    with path.open("rb") as file:
        return inspect(str(path), file, marker.read_bytes() if marker.is_file() else None, lambda: state() != before)


INVENTORY = (
    "raw_file string, file_bytes long, session_date string, done_marker boolean, sha256 string, marker_sha256 string, marker_bytes long, header binary, "
    "uncompressed_bytes long, zstd_frames int, record_count long, empty boolean, degraded_source boolean, error string"
)
INVENTORY_NAMES = [x.split()[0] for x in INVENTORY.split(", ")]


def inventory(spark: SparkSession, root: str) -> DataFrame:
    """One row for each record file below ``root``, inspected on the executors."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    markers = files.where(F.col("path").endswith(".done")).select(F.expr("substring(path, 1, length(path) - 5)").alias("path"), F.col("content").alias("marker"))
    data = files.where(F.col("path").endswith(".dbn.zst")).select("path", "length", "content").join(markers, "path", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, length, content, marker in zip(*batch.columns, strict=True):
                raw, listed = content.as_py(), length.as_py()
                row = inspect(path.as_py(), raw, marker.as_py(), lambda raw=raw, listed=listed: len(raw) != listed)
                yield pa.RecordBatch.from_pylist([row], schema=_INVENTORY_ARROW)

    return data.select("path", "length", "content", "marker").mapInArrow(run, INVENTORY)


_ARROW_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
_INVENTORY_ARROW = pa.schema([(n, _ARROW_KINDS[k]) for n, k in (x.split() for x in INVENTORY.split(", "))])


def inventory_issues(spark: SparkSession, root: str, rows: DataFrame, first: date, last: date) -> DataFrame:
    """kind, name: unexpected files, orphan markers, missing, unexpected and repeated dates, and files with errors."""
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
    data, marks = paths.where(F.col("name").endswith(".dbn.zst")), paths.where(F.col("name").endswith(".dbn.zst.done"))
    told = lambda kind, names: names.select(F.lit(kind).alias("kind"), F.col("name").cast("string"))
    due = spark.createDataFrame([(d.isoformat(),) for d in weekdays(first, last)], "name string")
    seen = rows.where("session_date is not null").select(F.col("session_date").alias("name"))
    marked = marks.select(F.expr("substring(name, 1, length(name) - 5)").alias("name"))
    parts = [
        told("unexpected_file", paths.where(~F.col("name").rlike(r"\.dbn\.zst(\.done)?$"))),
        told("orphan_marker", marked.join(data, "name", "left_anti")),
        told("missing_date", due.join(seen, "name", "left_anti")),
        told("unexpected_date", seen.join(due, "name", "left_anti").distinct()),
        told("duplicate_date", seen.groupBy("name").count().where("count > 1")),
        told("file_error", rows.where("error is not null").select(F.col("raw_file").alias("name"))),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def header_audit(spark: SparkSession, root: str, expected: DataFrame) -> DataFrame:
    """raw_file, header_same, marker_same against stored header bytes and marker text (raw_file, header, marker)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    named = files.select(F.regexp_extract("path", "([^/]*)$", 1).alias("raw_file"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = []
            for raw in batch.column("content").to_pylist():
                heads.append(read_header(iter(Inflated(io.BytesIO(raw))))[0])  # no more than the first blocks
            yield pa.RecordBatch.from_arrays([batch.column("raw_file"), pa.array(heads, pa.binary())], names=["raw_file", "found_header"])

    heads = named.where(F.col("raw_file").endswith(".dbn.zst")).mapInArrow(run, "raw_file string, found_header binary")
    marks = named.where(F.col("raw_file").endswith(".done")).select(F.expr("substring(raw_file, 1, length(raw_file) - 5)").alias("raw_file"), F.col("content").cast("string").alias("found_marker"))
    both = expected.join(heads, "raw_file", "left").join(marks, "raw_file", "left")
    return both.select("raw_file", F.col("header").eqNullSafe(F.col("found_header")).alias("header_same"), F.col("marker").eqNullSafe(F.col("found_marker")).alias("marker_same"))


def decoded(path: str, file: BinaryIO) -> Iterator[pa.RecordBatch]:
    """One file's ticks in delivery order, CHUNK rows at a time; no more of the file is held than a chunk."""
    day = date.fromisoformat(re.fullmatch(FILE_NAME, Path(path).name)[1])
    blocks = iter(Inflated(file))
    head, first = read_header(blocks)
    decode_header(head)
    held, size, start = [first], len(first), 0

    def ticks(body: bytes) -> pa.RecordBatch:
        found, n = unpack(body), len(body) // RECORD_BYTES
        places = pa.array(np.arange(start, start + n))
        return pa.RecordBatch.from_arrays([pa.array([day] * n, pa.date32()), places, *(found[c] for c in NATIVE_COLUMNS)], names=["session_date_ny", "event_idx_day", *NATIVE_COLUMNS])

    for block in blocks:
        held.append(block)
        size += len(block)
        while size >= CHUNK * RECORD_BYTES:
            body = b"".join(held)
            yield ticks(body[: CHUNK * RECORD_BYTES])
            held, size, start = [body[CHUNK * RECORD_BYTES :]], size - CHUNK * RECORD_BYTES, start + CHUNK
    while size:
        body = b"".join(held)
        yield ticks(body[: CHUNK * RECORD_BYTES])  # ValueError for a record that is not whole
        held = [body[CHUNK * RECORD_BYTES :]]
        size, start = len(held[0]), start + CHUNK


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, root: str):
        self.root = root

    def partitions(self) -> list[InputPartition]:
        return [_File(str(p)) for p in sorted(Path(self.root).rglob("*.dbn.zst"))]

    def read(self, partition: _File) -> Iterator[pa.RecordBatch]:
        with open(partition.path, "rb") as file:
            yield from decoded(partition.path, file)


class BronzeSource(DataSource):
    """spark.read.format("bronze").load(root): ticks of every record file, one partition a file, delivery order kept.

    For a file system that the driver and all executors mount; :func:`read_bronze` reads any store.
    """

    @classmethod
    def name(cls) -> str:
        return "bronze"

    def schema(self):
        return TICK_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


def read_bronze(spark: SparkSession, root: str) -> DataFrame:
    """Ticks of every record file below ``root`` on any store that Spark reads; a task holds one file, compressed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.dbn.zst").load(root)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(*batch.columns, strict=True):
                yield from decoded(path.as_py(), io.BytesIO(content.as_py()))

    return files.select("path", "content").mapInArrow(run, TICK_SCHEMA)


def write_bronze(root: str | Path, day: str, records: np.ndarray, instruments: list[tuple[date, date, str]], marker: str = "done\n") -> Path:
    """A source file with its marker: for tests and for sources of one's own."""
    start, end = session_bounds(day)
    header = Header(VERSION, "GLBX.MDP3", 1, start, end, 0, 3, 0, 0, ["GC.v.0"], [], [], {"GC.v.0": instruments})
    path = Path(root) / day[:4] / f"GC.v.0_{day}_0700-1200_NY_mbp-1.dbn.zst"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(zstandard.ZstdCompressor().compress(encode_header(header) + np.ascontiguousarray(records, RECORD).tobytes()))
    Path(f"{path}.done").write_text(marker)
    return path
