"""Suffix-array dedup: remove bytes covered by a repeat of LENGTH bytes that an earlier document also has.

Documents travel in compressed blocks. Every window of LENGTH bytes has an anchor: its k-mer of least hash, leftmost on
ties, so equal windows have equal anchors, wherever they stand. Step 1 finds the anchors that two documents or more
have; windows at other anchors cannot repeat. Step 2 sends the stretches of text around shared anchors, equal stretches
of a block once, to the shard of their anchor; so all windows that could be equal meet in one shard. Each shard sorts
the suffixes of its stretches by external induced sorting (:mod:`.induced_sort`), but for stretches that have their
anchor to themselves; suffixes whose common prefix is LENGTH or more share a window, and the smallest doc_id among them
is known. Step 3 brings the spans back to the blocks,
and the bytes go. Nothing is decided by hashes alone: they only choose where exact comparisons take place.

A shard streams through its task: its rows go to a scratch file, and what is held is its distinct stretches. A shard with
more than MEMORY bytes of them is cut on disk into parts that are sorted one after the other: first by anchor, so that
equal windows stay together; where one anchor alone has too much (a passage in a third of all documents has different
edges in each), by anchors of other hashes, which the edges' own k-mers share; where RECUTS of them do not help (windows
may have all k-mers in common), by the hash of whole windows, again and again until a part fits. So a task's memory does
not depend on the shard's size or on hot anchors. Blocks times shards grow faster than the text, and what one block sends
to one shard shrinks, so a shard's rows are put together before anything is done to them, its parts hold such pieces, and
their spans go back once for each block. Other things held in one task: a block, and the shared anchors of one hash
bucket, 6 bytes for each block that has them.

Defined results: null text is empty; a null doc_id counts as larger than all others, and null ids are no larger than
each other; rows that repeat an id are one document and remove nothing from each other; documents shorter than LENGTH
lose nothing; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import cut, documents, pieces
from .induced_sort import suffix_order

LENGTH, KMER = 50, 20
BLOCK, SEGMENT = 4 << 20, 1 << 18
#: Bytes of distinct stretches that are sorted at once; the sort takes some 40 times as much.
MEMORY = 4 << 20
#: Parts that a shard is cut into at once, each a scratch file; cuts by anchors; bytes of spans that are held.
PARTS, RECUTS, SPANS = 64, 8, 8 << 20
NO_ID = (1 << 63) - 1
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


def _pack(*arrays: np.ndarray | bytes) -> bytes:
    """Arrays as one compressed body; their lengths and kinds are known to the reader."""
    raw = [x if isinstance(x, bytes) else x.tobytes() for x in arrays]
    head = np.array([len(raw), *map(len, raw)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(raw))


def _unpack(body: bytes, *kinds: str) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body)
    sizes = np.frombuffer(raw, "<i8", 1 + len(kinds))[1:]
    ends = 8 * (1 + len(kinds)) + np.cumsum(sizes)
    return [np.frombuffer(raw[b - n : b], kind) for n, b, kind in zip(sizes.tolist(), ends.tolist(), kinds, strict=True)]


def blocks(docs: DataFrame) -> DataFrame:
    """block, body: the rows of ``docs`` in compressed blocks, kept in the shared folder.

    Neither is ever null, and the schema says so: both later joins then deal the blocks alike and share one exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = np.array([NO_ID if i is None else i for i, _ in held], "i8")
            null = np.array([i is None for i, _ in held], "u1")
            body = _pack(ids, null, np.array([len(t) for _, t in held], "i8"), b"".join(t for _, t in held))
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([body], pa.binary())], names=["block", "body"])

        for batch in pieces(batches, max_bytes=BLOCK):
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if held and (size + len(text or "") > BLOCK or len(held) >= 65_536):
                    yield block()
                    held, size, number = [], 0, number + 1
                held.append((i, (text or "").encode()))
                size += len(held[-1][1])
        if held:
            yield block()

    schema = T.StructType([T.StructField("block", T.LongType(), False), T.StructField("body", T.BinaryType(), False)])
    return cut(docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, schema))


def windows(text: np.ndarray, sizes: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, first place in the block, windows, anchor hash) of each run of windows with one anchor, in the text's
    order. Another ``seed``, other hashes: a window's anchor is then any of its k-mers."""
    ends = np.cumsum(sizes)
    last = np.uint64((int(_ODD[3]) + 2 * seed * int(_ODD[0])) % (1 << 64))
    out = []
    low = np.uint64((1 << 24) - 1)
    for start in range(0, len(text) - LENGTH + 1, SEGMENT):
        part = text[start : start + SEGMENT + LENGTH - 1]
        n = len(part) - 7
        word = np.ndarray((n,), "<u8", part.tobytes(), strides=(1,)).copy()
        mixed = word[: n - KMER + 8] * _ODD[0] + word[8 : n - KMER + 16] * _ODD[1] + word[KMER - 8 :] * _ODD[2]
        mixed ^= mixed >> np.uint64(32)
        mixed *= last
        mixed ^= mixed >> np.uint64(29)
        least = (mixed & ~low) | np.arange(len(mixed), dtype="u8")
        span, width = LENGTH - KMER + 1, 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
        anchor = (least & low).astype("i8")
        place = np.arange(start, start + len(anchor))
        doc = np.searchsorted(ends, place, side="right")
        whole = np.flatnonzero(place + LENGTH <= ends[doc])
        if not len(whole):
            continue
        anchor, doc, place = anchor[whole], doc[whole], place[whole]
        first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]))
        count = np.diff(np.concatenate([first, [len(whole)]]))
        # the least of many hashes is small: mixed once more, anchors spread evenly
        even = mixed[anchor[first]] * _ODD[1]
        out.append((doc[first], place[first], count, (even ^ even >> np.uint64(31)) * _ODD[2]))
    if not out:
        return np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, "u8")
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _six(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view("u1").reshape(-1, 8)[:, :6]).tobytes()


def _from_six(body: bytes) -> np.ndarray:
    out = np.zeros((len(body) // 6, 8), "u1")
    out[:, :6] = np.frombuffer(body, "u1").reshape(-1, 6)
    return out.view("<u8").ravel()


def _bucketed(bits: int):
    """Blocks -> bucket, block, body: the anchors of a block by their leading ``bits``, 47 more bits and a flag each
    (set if two of the block's documents have it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist(), strict=True):
                _, _, sizes, text = _unpack(body, "i8", "u1", "i8", "u1")
                doc, _, _, anchor = windows(text, sizes)
                if not len(doc):
                    continue
                order = np.argsort(anchor, kind="stable")
                anchor, doc = anchor[order], doc[order]
                first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
                last = np.concatenate([first[1:], [len(anchor)]]) - 1
                shared, anchor = doc[first] != doc[last], anchor[first]  # documents ascend within an anchor
                value = (anchor >> np.uint64(17 - bits) if bits <= 17 else anchor << np.uint64(bits - 17)) & np.uint64((1 << 47) - 1)
                bucket = (anchor >> np.uint64(64 - bits)).astype("i8")
                value = value << np.uint64(1) | shared.astype("u8")
                cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
                bodies = [_six(value[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cuts[:-1]].astype("i4")), pa.array(np.full(len(bodies), block)), pa.array(bodies, pa.binary())], names=["bucket", "block", "body"]
                )

    return run


def _shared(table: pa.Table) -> pa.Table:
    """The anchors of one bucket that two blocks, or two documents of a block, have; a row for each block with any."""
    block = table.column("block").to_pylist()
    each = [_from_six(x) for x in table.column("body").to_pylist()]
    value, of = np.concatenate(each), np.repeat(np.arange(len(block)), [len(x) for x in each])
    order = np.argsort(value >> np.uint64(1), kind="stable")
    value, of = value[order], of[order]
    anchor = value >> np.uint64(1)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    count = np.diff(np.concatenate([first, [len(anchor)]]))
    keep = np.repeat((count > 1) | np.logical_or.reduceat((value & np.uint64(1)) > 0, first), count)
    anchor, of = anchor[keep], of[keep]
    order = np.argsort(of, kind="stable")
    anchor, of = anchor[order], of[order]
    cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else np.zeros(1, "i8")
    out = [_six(np.sort(anchor[a:b])) for a, b in zip(cuts, cuts[1:], strict=False)]
    bucket = table.column("bucket")[0].as_py()
    return pa.table([pa.array([block[i] for i in of[cuts[:-1]]] if len(of) else [], pa.int64()), pa.array([bucket] * len(out), pa.int32()), pa.array(out, pa.binary())], names=["block", "bucket", "body"])


def _stretches(bits: int, shards: int):
    """Blocks with their shared anchors -> shard, block, body: distinct stretches and where they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body, told in zip(batch.column("block").to_pylist(), batch.column("body").to_pylist(), batch.column("told").to_pylist(), strict=True):
                ids, _, sizes, text = _unpack(body, "i8", "u1", "i8", "u1")
                doc, place, count, anchor = windows(text, sizes)
                known = np.sort(np.concatenate([_from_six(x["body"]) | np.uint64(x["bucket"]) << np.uint64(47) for x in told]))
                value = (anchor >> np.uint64(17 - bits) if bits <= 17 else anchor << np.uint64(bits - 17)) & np.uint64((1 << 47) - 1)
                key = (anchor >> np.uint64(64 - bits)) << np.uint64(47) | value
                at = np.searchsorted(known, key)
                keep = known[np.minimum(at, len(known) - 1)] == key
                doc, place, count, anchor = doc[keep], place[keep], count[keep], anchor[keep]
                shard = ((anchor * _ODD[0]) >> np.uint64(32)).astype("i8") % shards
                order = np.argsort(shard, kind="stable")
                doc, place, count, shard = doc[order], place[order], count[order], shard[order]
                base = (np.cumsum(sizes) - sizes)[doc]
                raw = text.tobytes()
                cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]])) if len(shard) else np.zeros(1, "i8")
                names, bodies = [], []
                for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
                    found: dict[bytes, int] = {}
                    which = [found.setdefault(raw[p : p + n + LENGTH - 1], len(found)) for p, n in zip(place[a:b].tolist(), count[a:b].tolist(), strict=True)]
                    names.append(int(shard[a]))
                    bodies.append(_told(np.array(which, "i8"), doc[a:b], (place - base)[a:b], ids[doc[a:b]], list(found)))
                if names:
                    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([block] * len(names), pa.int64()), pa.array(bodies, pa.binary())], names=["shard", "block", "body"])

    return run


def first_owners(texts: list[bytes], owner: np.ndarray, memory: int = 64 << 20) -> tuple[np.ndarray, np.ndarray]:
    """(least owner of the window at each place, start of each text) for the texts laid one after the other, one place
    between; places without a whole window hold NO_ID. ``owner``: each text's least doc_id."""
    sizes = np.fromiter(map(len, texts), "i8", len(texts))
    starts = np.cumsum(sizes + 1) - sizes - 1
    joined = np.frombuffer(b"\xff".join([*texts, b""]), "u1") + np.uint8(1)  # UTF-8 has no byte 0xFF; it becomes the end 0
    of = np.repeat(np.arange(len(texts)), sizes + 1)
    whole = np.arange(len(joined)) + LENGTH <= (starts + sizes)[of]
    least = np.where(whole, owner[of], NO_ID)
    for at, common in suffix_order(joined, LENGTH, memory=memory):
        head = np.concatenate([[True], common[1:] < LENGTH])
        first = np.flatnonzero(head)
        tied = np.diff(np.concatenate([first, [len(at)]]))
        if (tied > 1).any():
            least[at] = np.repeat(np.minimum.reduceat(least[at], first), tied)
    new = np.concatenate([[True], joined[1:] != joined[:-1]])
    run = np.flatnonzero(new)
    length = np.diff(np.concatenate([run, [len(joined)]]))
    for symbol in np.unique(joined[run[(length >= LENGTH) & (joined[run] > 0)]]):  # such a suffix may be of either type
        same = [np.arange(a, a + n - LENGTH + 1) for a, n in zip(run, length, strict=True) if n >= LENGTH and joined[a] == symbol]
        places = np.concatenate(same)
        least[places] = least[places].min()
    return least, starts


def _occurrences(body: bytes) -> tuple[np.ndarray, ...]:
    """(stretch, document, place, doc_id) of each occurrence, then the stretches' sizes and bytes."""
    which, steps, far, own, ids, sizes, raw = _unpack(body, "i4", "u4", "i8", "u4", "i8", "u4", "u1")
    at = np.cumsum(steps, dtype="i8")
    total = np.cumsum(far)
    first = np.flatnonzero(np.concatenate([[True], steps[1:] > 0]))
    before = np.repeat(total[first] - far[first], np.diff(np.concatenate([first, [len(far)]])))
    return np.cumsum(which, dtype="i8"), own[at], total - before, ids[at], sizes, raw


#: The block, or the block of each occurrence, and the occurrences as _occurrences tells them.
Record = tuple[int | np.ndarray, tuple[np.ndarray, ...]]


class Spool:
    """Records in a scratch file of the task, unnamed, read from the start as often as wanted."""

    def __init__(self):
        self.file, self.ends, self.blocks, self.read = tempfile.TemporaryFile(), [0], [], 0

    def add(self, block: int | None, body: bytes) -> None:
        """A record of one block, packed by _told; without a block, a piece packed by add_piece."""
        self.file.seek(self.ends[-1])
        self.file.write(body)
        self.blocks.append(block)
        self.ends.append(self.ends[-1] + len(body))

    def add_piece(self, block: np.ndarray, which: np.ndarray, doc: np.ndarray, place: np.ndarray, ids: np.ndarray, texts: list[bytes]) -> None:
        sizes = np.fromiter(map(len, texts), "u4", len(texts))
        self.add(None, _pack(block.astype("i8"), which.astype("i4"), doc.astype("u4"), place.astype("i8"), ids.astype("i8"), sizes, b"".join(texts)))

    def __iter__(self) -> Iterator[Record]:
        for i, block in enumerate(self.blocks):
            self.file.seek(self.ends[i])
            body, self.read = self.file.read(self.ends[i + 1] - self.ends[i]), self.ends[i + 1]
            if block is not None:
                yield block, _occurrences(body)
            else:
                blocks, *told = _unpack(body, "i8", "i4", "u4", "i8", "i8", "u4", "u1")
                yield blocks, tuple(told)


def _pieces(records: Iterable[Record], size: int) -> Iterator[Record]:
    """The records put together to some ``size`` bytes: what is done to a piece is worth its while."""

    def joined() -> Record:
        shift = np.cumsum([0, *(len(told[4]) for _, told in held)])
        which = np.concatenate([told[0] + k for (_, told), k in zip(held, shift.tolist(), strict=False)])
        return np.concatenate([np.broadcast_to(block, len(told[0])) for block, told in held]), (which, *(np.concatenate([told[k] for _, told in held]) for k in range(1, 6)))

    held, total = [], 0
    for block, told in records:
        held.append((block, told))
        total += len(told[5]) + 8 * len(told[0])
        if total >= size:
            yield joined()
            held, total = [], 0
    if held:
        yield joined()


def _told(which: np.ndarray, doc: np.ndarray, place: np.ndarray, ids: np.ndarray, texts: list[bytes]) -> bytes:
    """The body of a record: documents ascend, and places within a document."""
    own, at = np.unique(doc, return_inverse=True)
    first = np.searchsorted(doc, own)
    steps = np.diff(at, prepend=0)
    far = np.diff(place, prepend=0)
    far[steps > 0] = place[steps > 0]
    sizes = np.fromiter(map(len, texts), "u4", len(texts))
    return _pack(np.diff(which, prepend=0).astype("i4"), steps.astype("u4"), far.astype("i8"), own.astype("u4"), ids[first], sizes, b"".join(texts))


def _cut_texts(sizes: np.ndarray, raw: np.ndarray) -> list[bytes]:
    body, ends = raw.tobytes(), np.cumsum(sizes.astype("i8")).tolist()
    return [body[b - n : b] for n, b in zip(sizes.tolist(), ends, strict=True)]


def _places(counts: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, first[row], first[row] + 1, ...): counts[row] numbers for each row."""
    row = np.repeat(np.arange(len(counts)), counts)
    return row, np.arange(len(row)) + np.repeat(first - np.cumsum(counts) + counts, counts)


def _cut_shard(records: Iterable[Record], parts: int, level: int) -> list[Spool]:
    """The records in parts that share no window: by anchor at level 1, by anchors of another hash at each level after
    it, by whole windows after RECUTS levels. A stretch becomes a stretch for each of its anchors, or for each window."""
    out = [Spool() for _ in range(parts)]
    for block, (which, doc, place, ids, sizes, raw) in records:
        sizes, body = sizes.astype("i8"), raw.tobytes()
        starts = np.cumsum(sizes) - sizes
        if level <= RECUTS:
            of, at, count, anchor = windows(raw, sizes, level - 1)
        else:
            of, at = _places(sizes - LENGTH + 1, starts)
            count = np.ones(len(of), "i8")
            seed = level.to_bytes(8, "little")
            anchor = np.array([int.from_bytes(hashlib.blake2b(body[p : p + LENGTH], digest_size=8, key=seed).digest(), "little") for p in at.tolist()], "u8")
        names: dict[bytes, int] = {}
        name = np.array([names.setdefault(body[a:b], len(names)) for a, b in zip(at.tolist(), (at + count + LENGTH - 1).tolist(), strict=True)], "i8")
        texts = list(names)
        runs = np.bincount(of, minlength=len(sizes))
        row, run = _places(runs[which], (np.cumsum(runs) - runs)[which])
        far = (at - starts[of])[run]
        part_of = ((anchor * _ODD[3] >> np.uint64(32)).astype("i8") % parts)[run]
        order = np.argsort(part_of, kind="stable")
        cuts = np.searchsorted(part_of[order], np.arange(parts + 1)).tolist()
        for part, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b:
                own = order[a:b]
                used, new = np.unique(name[run[own]], return_inverse=True)
                own, far_ = row[own], far[own]
                out[part].add_piece(block[own], new, doc[own], place[own] + far_, ids[own], [texts[i] for i in used.tolist()])
    return out


def _distinct(records: Spool, memory: int) -> tuple[dict[bytes, int], np.ndarray, int]:
    """(distinct stretches, least doc_id of each, 0), or if they come to more than ``memory`` bytes, (none, none, about
    the bytes of all records)."""
    found: dict[bytes, int] = {}
    least = np.full(1 << 10, NO_ID)
    held = total = 0
    for _, (which, _, _, ids, sizes, raw) in _pieces(records, memory // 4):
        total += len(raw)
        names = np.empty(len(sizes), "i8")
        for i, text in enumerate(_cut_texts(sizes, raw)):
            before = len(found)
            names[i] = found.setdefault(text, before)
            held += len(text) if len(found) > before else 0
        while len(least) < len(found):
            least = np.concatenate([least, np.full(len(least), NO_ID)])
        np.minimum.at(least, names[which], ids)
        if held > memory and len(found) > 1:
            return {}, least[:0], -(-total * records.ends[-1] // records.read)
    return found, least[: len(found)], 0


def _met(texts: list[bytes], seed: int) -> np.ndarray:
    """The texts that have an anchor in common with another one: only their windows can stand in another one too."""
    of, _, _, anchor = windows(np.frombuffer(b"".join(texts), "u1"), np.fromiter(map(len, texts), "i8", len(texts)), seed)
    order = np.argsort(anchor, kind="stable")
    anchor, of = anchor[order], of[order]
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [len(anchor)]]) - 1
    return np.unique(of[np.repeat(of[first] != of[last], last - first + 1)])


def _removals(records: Spool, memory: int, level: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(block, document, start, end) to remove, some at a time."""
    found, owner, total = _distinct(records, memory)
    if total:
        parts = _cut_shard(_pieces(records, memory // 4), min(PARTS, max(2, -(-2 * total // memory))), level + 1)
        while parts:
            yield from _removals(parts.pop(), memory, level + 1)
        return
    if not found:
        return
    texts = list(found)
    lengths = np.fromiter(map(len, texts), "i8", len(texts))
    n_windows = lengths - LENGTH + 1
    low, high, starts = owner.copy(), owner.copy(), np.zeros(len(texts), "i8")
    met = _met(texts, max(0, min(level, RECUTS) - 1))
    if len(met):
        least, starts[met] = first_owners([texts[i] for i in met.tolist()], owner[met])
        bounds = np.stack([starts[met], starts[met] + n_windows[met]], axis=1).ravel()
        low[met], high[met] = np.minimum.reduceat(least, bounds)[::2], np.maximum.reduceat(least, bounds)[::2]
    for block, (which, doc, place, ids, sizes, raw) in _pieces(records, memory // 4):
        w = np.array([found[x] for x in _cut_texts(sizes, raw)], "i8")[which]
        all_ = high[w] < ids
        some = np.flatnonzero(~all_ & (low[w] < ids))
        parts = [(block[all_], doc[all_], place[all_], place[all_] + lengths[w[all_]])]
        if len(some):
            row, step = _places(n_windows[w[some]], np.zeros(len(some), "i8"))
            row = some[row]
            gone = least[starts[w[row]] + step] < ids[row]
            row, step = row[gone], step[gone]
            first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (step[1:] != step[:-1] + 1)])) if len(row) else np.zeros(0, "i8")
            last = np.concatenate([first[1:], [len(row)]]).astype("i8") - 1
            parts.append((block[row[first]], doc[row[first]], place[row[first]] + step[first], place[row[first]] + step[last] + LENGTH))
        yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def shard_spans(records: Spool, memory: int = MEMORY) -> Iterator[tuple[int, bytes]]:
    """(block, packed (document, start, end) to remove) for the records of a shard, some ``memory`` bytes sorted at once;
    a block comes once, or again after each SPANS bytes."""

    def gathered() -> Iterator[tuple[int, bytes]]:
        block, doc, start, end = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(block, kind="stable")
        block, doc, start, end = block[order], doc[order].astype("u4"), start[order], end[order]
        cuts = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]])).tolist() if len(block) else []
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield int(block[a]), _pack(doc[a:b], start[a:b], end[a:b])

    held, size = [], 0
    for some in _removals(records, memory, 0):
        held.append(some)
        size += sum(x.nbytes for x in some)
        if size > SPANS:
            yield from gathered()
            held, size = [], 0
    if held:
        yield from gathered()


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard -> block, body: what :func:`shard_spans` tells."""
    now, held = None, Spool()

    def done() -> Iterator[pa.RecordBatch]:
        told = shard_spans(held)
        while rows := list(itertools.islice(told, 256)):
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["block", "body"])

    for batch in batches:
        shards, numbers, bodies = (batch.column(c) for c in ("shard", "block", "body"))
        for i in range(batch.num_rows):
            if shards[i].as_py() != now:
                yield from done()
                now, held = shards[i].as_py(), Spool()
            held.add(numbers[i].as_py(), bodies[i].as_py())
    yield from done()


def removed(text: np.ndarray, sizes: np.ndarray, told: list[bytes]) -> np.ndarray:
    """For each byte of a block, whether a span covers it."""
    steps = np.zeros(len(text) + 1, "i4")
    base = np.cumsum(sizes) - sizes
    for body in told:
        doc, start, end = _unpack(body, "u4", "i8", "i8")
        np.add.at(steps, base[doc] + start, 1)
        np.add.at(steps, base[doc] + end, -1)
    return np.cumsum(steps[:-1]) > 0


def _results(keep_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body, told in zip(batch.column("body").to_pylist(), batch.column("told").to_pylist(), strict=True):
                ids, null, sizes, text = _unpack(body, "i8", "u1", "i8", "u1")
                gone = removed(text, sizes, told or [])
                ends = np.cumsum(sizes)
                total = np.concatenate([[0], np.cumsum(gone)])
                lost = total[ends] - total[ends - sizes]
                heads = gone.copy()
                heads[1:] &= ~gone[:-1]
                filled = (ends - sizes)[sizes > 0]
                heads[filled] = gone[filled]
                total = np.concatenate([[0], np.cumsum(heads)])
                spans = total[ends] - total[ends - sizes]
                rest = text[~gone].tobytes()
                stop = np.cumsum(sizes - lost).tolist()
                kept = [rest[b - n : b] for n, b in zip((sizes - lost).tolist(), stop, strict=True)]
                columns = [pa.array(ids, mask=null > 0), pa.array(sizes), pa.array(lost.astype("i8")), pa.array(spans.astype("i8")), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                if keep_bytes:
                    columns.append(pa.array(kept, pa.binary()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def dedup_bytes(docs: DataFrame, keep_bytes: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, the kept bytes of every row of ``docs``."""
    held = blocks(docs)
    n = max(1, held.count())
    bits = int(np.ceil(np.log2(max(512, 16 * n**0.5))))
    shards = int(max(64, 11 * n**0.5))
    anchors = held.mapInArrow(_bucketed(bits), "bucket int, block long, body binary")
    shared = anchors.groupBy("bucket").applyInArrow(_shared, "block long, bucket int, body binary")
    by_block = shared.groupBy("block").agg(F.collect_list(F.struct("bucket", "body")).alias("told"))
    sent = held.join(by_block, "block").mapInArrow(_stretches(bits, shards), "shard int, block long, body binary")
    spans = sent.repartition("shard").sortWithinPartitions("shard").mapInArrow(_spans, "block long, body binary")
    told = spans.groupBy("block").agg(F.collect_list("body").alias("told"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_bytes
    return held.join(told, "block", "left").select("body", "told").mapInArrow(_results(keep_bytes), schema)


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_bytes(documents(spark, sf_dir), keep_bytes=False)


OP8_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
      FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS p FROM d)),
o AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT w.doc_id, w.p FROM w JOIN o ON w.s = o.s WHERE o.least < w.doc_id),
new AS (SELECT doc_id, p, CAST(coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 50, true) AS INTEGER) AS n FROM hit),
grp AS (SELECT doc_id, p, sum(n) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM new),
span AS (SELECT doc_id, min(p) AS a, max(p) + 50 AS b FROM grp GROUP BY doc_id, g),
part AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
cut AS (SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
               string_agg(substr(d.h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept
        FROM part p JOIN d ON p.doc_id = d.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut ON d.doc_id = cut.doc_id
"""
