"""Native bytes: packing rows into 80-byte records, unpacking them, and the digest of a session in delivery order."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import NATIVE, NATIVE_COLUMNS, NATIVE_SCHEMA, RECORD_BYTES, column_of

RECORD = np.dtype(NATIVE)
assert RECORD.itemsize == RECORD_BYTES


ARROW = {"<u1": pa.int16(), "<u2": pa.int32(), "<u4": pa.int64(), "<i4": pa.int32(), "<i8": pa.int64(), "<u8": pa.decimal128(20, 0), "S1": pa.string()}


def _unsigned(column: pa.Array) -> np.ndarray:
    """The low 64 bits of decimals, from their buffer."""
    whole = np.frombuffer(column.cast(ARROW["<u8"]).buffers()[1], "<u8").reshape(-1, 2)
    return whole[column.offset : column.offset + len(column), 0]


def _letters(column: pa.Array) -> np.ndarray:
    """One byte a value, from the buffer where each value has one."""
    offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1]
    if (np.diff(offsets) == 1).all():
        return np.frombuffer(column.buffers()[2], "S1")[offsets[0] : offsets[-1]]
    return np.array(column.to_pylist(), "S1")


def pack(columns: dict[str, pa.Array]) -> np.ndarray:
    """Native records from Arrow columns named as NATIVE_COLUMNS."""
    out = np.zeros(len(columns[NATIVE_COLUMNS[0]]), RECORD)
    for name, kind in NATIVE if len(out) else ():
        column = columns[column_of(name)]
        out[name] = _unsigned(column) if kind == "<u8" else _letters(column) if kind == "S1" else column.to_numpy(zero_copy_only=False)
    return out


def _binary(raw: bytes, width: int, kind: pa.DataType) -> pa.Array:
    """Values of ``width`` bytes each, laid one after the other in ``raw``."""
    n = len(raw) // width
    return pa.Array.from_buffers(kind, n, [None, pa.py_buffer((width * np.arange(n + 1)).astype("<i4").tobytes()), pa.py_buffer(raw)])


def unpack(body: bytes) -> dict[str, pa.Array]:
    """The columns of NATIVE_COLUMNS from packed records."""
    if len(body) % RECORD_BYTES:
        raise ValueError("incomplete native record")
    rows, out = np.frombuffer(body, RECORD), {}
    for name, kind in NATIVE:
        values = np.ascontiguousarray(rows[name])
        if kind == "<u8":
            both = np.stack([values, np.zeros_like(values)], axis=1).tobytes()
            array = pa.Array.from_buffers(ARROW[kind], len(rows), [None, pa.py_buffer(both)])
        elif kind == "S1":
            plain = len(rows) and 0 < values.view("u1").min() and values.view("u1").max() < 128
            array = _binary(values.tobytes(), 1, ARROW[kind]) if plain else pa.array([x.decode() for x in values.tolist()], ARROW[kind])
        else:
            array = pa.array(values).cast(ARROW[kind])
        out[column_of(name)] = array
    return out


def packed(ticks: DataFrame) -> DataFrame:
    """session_date_ny, event_idx_day, record: each row's 80 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = _binary(pack({c: batch.column(c) for c in NATIVE_COLUMNS}).tobytes(), RECORD_BYTES, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), body], names=["session_date_ny", "event_idx_day", "record"])

    return ticks.select("session_date_ny", "event_idx_day", *NATIVE_COLUMNS).mapInArrow(run, "session_date_ny date, event_idx_day long, record binary")


def unpacked(records: DataFrame) -> DataFrame:
    """The inverse of :func:`packed`."""
    schema = "session_date_ny date, event_idx_day long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in NATIVE_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = unpack(b"".join(batch.column("record").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(found[c] for c in NATIVE_COLUMNS)], names=["session_date_ny", "event_idx_day", *NATIVE_COLUMNS])

    return records.select("session_date_ny", "event_idx_day", "record").mapInArrow(run, schema)


def ordered_digest(ticks: DataFrame) -> DataFrame:
    """session_date_ny, records, sha256 of each session's records in delivery order.

    Rows are sorted in their partition and hashed as they stream by, a session's run of a batch at once: a session must
    pass one task, because the digest is one chain of bytes, but it is never held in memory.
    """
    rows = packed(ticks).repartition("session_date_ny").sortWithinPartitions("session_date_ny", "event_idx_day")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        day, digest, n = None, None, 0
        out: list[tuple] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            days, body = np.asarray(batch.column(0).cast(pa.int32())), batch.column(2)
            offsets = np.frombuffer(body.buffers()[1], "<i4")[body.offset : body.offset + len(body) + 1]
            raw = memoryview(body.buffers()[2])
            cuts = [0, *(np.flatnonzero(days[1:] != days[:-1]) + 1).tolist(), len(days)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if days[a] != day:
                    if digest:
                        out.append((day, n, digest.hexdigest()))
                    day, digest, n = int(days[a]), hashlib.sha256(), 0
                digest.update(raw[offsets[a] : offsets[b]])
                n += b - a
        if digest:
            out.append((day, n, digest.hexdigest()))
        day, n, told = zip(*out, strict=True) if out else ((), (), ())
        columns = [pa.array(day, pa.int32()).cast(pa.date32()), pa.array(n, pa.int64()), pa.array(told, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["session_date_ny", "records", "sha256"])

    return rows.mapInArrow(run, "session_date_ny date, records long, sha256 string")


def loose_checksum(ticks: DataFrame) -> DataFrame:
    """session_date_ny, records, checksum: quick, spreads over all tasks, but blind to order and only 64 bits."""
    row = F.xxhash64("event_idx_day", *NATIVE_COLUMNS).cast("decimal(20,0)")
    return ticks.groupBy("session_date_ny").agg(F.count(F.lit(1)).alias("records"), F.sum(row).cast("string").alias("checksum"))
