"""SimHash near-dedup by covering anchors.

Two fingerprints that differ in at most 3 bits differ in at most 1 bit in one of two halves (31 bits of each; the two
bits left over only loosen the test). The codewords of the perfect Hamming code on 31 bits are each half's anchors:
covering radius 1, so every half has a home anchor within 1 bit. A fingerprint is sent to every anchor within covering
radius plus threshold = 2 bits: its own codeword alone, or 16 of the 2^26 anchors. At an anchor, those at home there
are compared with all that came. The homes of one of a linked pair always hold the other, so no link is lost.

Equal fingerprints travel once. An anchor with more than ``CELL`` guests is dealt out as a grid of (homes x guests)
cells, each of bounded size. A cell tells a spanning forest of its links, never all pairs.

Defined results: null text or no word gives fingerprint zero, linked like any other; a null doc_id never names a
component unless all of its ids are null (then null); repeated rows give repeated rows; an empty table gives an empty
result; extra columns are ignored by :func:`near_components` and kept by :func:`keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import cut, documents, give_back, pieces
from .components import components

THRESHOLD, SHINGLE, SEED = 3, 3, 42
#: Guests of an anchor, or rows of a cell and side, that one step compares at most.
CELL = 4096
#: Hot anchors up to this many rows are broadcast; more are joined by shuffle.
BROADCAST_ROWS = 50_000
LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str, k: int = SHINGLE) -> list[int]:
    """XXH64 (seed 42) of every run of k words; of all words if fewer; none if there is no word."""
    words = text.encode().lower().split()  # on bytes: A-Z only, and exactly the blanks \x20 \x09-\x0D
    if len(words) <= k:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), "i8", len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts[: 1 - k].tolist(), ends[k - 1 :].tolist(), strict=True)]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For runs of ``counts`` hashes: a uint64 with the bits that over half of a run have. Empty runs give 0."""
    out = np.zeros(len(counts), "u8")
    full = counts > 0
    if not full.any():
        return out
    n = counts[full]
    parts = -(-n // 255)  # a lane of 8 bits counts to 255
    first = np.repeat(np.cumsum(n) - n, parts)
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    cuts, joins = first + 255 * step, np.cumsum(parts) - parts
    bits = np.zeros(len(n), "u8")
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & LANES, cuts)
        sums = np.add.reduceat(lanes.view("u1").reshape(-1, 8).astype("i8"), joins, axis=0)
        for byte in range(8):
            bits |= (2 * sums[:, byte] > n).astype("u8") << np.uint64(8 * byte + k)
    out[full] = bits
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (long, the 64 bits) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [shingle_hashes(x or "") for x in batch.column("text").to_pylist()]
            counts = np.array([len(x) for x in found], "i8")
            flat = np.fromiter((h for x in found for h in x), "u8", counts.sum())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(majority_bits(flat, counts).view("i8"))], names=["doc_id", "fp"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, "doc_id long, fp long")


def syndromes(x: np.ndarray) -> np.ndarray:
    """The Hamming syndrome of 31-bit words: 0, or the place (from 1) of the bit whose flip gives a codeword."""
    out = np.zeros(len(x), "i8")
    for k in range(5):
        mask = sum(1 << (p - 1) for p in range(1, 32) if p >> k & 1)
        out |= (np.bitwise_count(x & mask) & 1).astype("i8") << k
    return out


def anchors(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index into x, anchor, at home) for all codewords within 2 bits of each 31-bit word."""
    s = syndromes(x)
    bit = np.concatenate([[0], 1 << np.arange(31)])  # bit[p]: place p from 1; 0 flips nothing
    index, found, home = [np.arange(len(x))], [x ^ bit[s]], [np.ones(len(x), bool)]
    off = np.flatnonzero(s)
    for p in range(1, 32):  # two flips at p and p ^ s add up to the syndrome
        other = s[off] ^ p
        use = other > p
        at = off[use]
        index.append(at)
        found.append(x[at] ^ bit[p] ^ bit[other[use]])
        home.append(np.zeros(len(at), bool))
    return np.concatenate(index), np.concatenate(found), np.concatenate(home)


def _to_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 8192):
            fp = np.asarray(batch.column("fp"))[start : start + 8192]
            for half in (0, 1):
                at, anchor, home = anchors(fp >> (32 * half) & 0x7FFFFFFF)
                yield pa.RecordBatch.from_arrays([pa.array(anchor | half << 31), pa.array(fp[at]), pa.array(home)], names=["anchor", "fp", "home"])
    give_back()


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether signed words differ in few bits. Counted unsigned: of signed words the bits of the absolute value count."""
    return np.bitwise_count((a ^ b).view("u8")) <= THRESHOLD


def cell_links(fp: np.ndarray, home: np.ndarray) -> tuple[list[int], list[int]]:
    """A spanning forest of the links in one cell; only fingerprints linked to one at home there take part."""
    nodes, at = np.unique(fp, return_inverse=True)
    homes = np.unique(fp[home])
    near = np.zeros(len(nodes), bool)
    for start in range(0, len(homes), 256):
        part = homes[start : start + 256]
        met = _near(part[:, None], nodes[None, :])
        linked = met.sum(axis=1) > 1  # each meets itself
        near |= met[linked].any(axis=0)
    rest, u, v = nodes[near], [], []
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            met = _near(rest, node)
            new = rest[met]
            u += [int(node)] * len(new)
            v += new.tolist()
            queue += list(new)
            rest = rest[~met]
    return u, v


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell (anchor, i, j) -> links. Cells of up to 8 rows are compared by shifts, others one by one."""

    def links(cell: np.ndarray, fp: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]).any(axis=1)]))
        size = np.diff(np.concatenate([first, [len(fp)]]))
        us, vs = [], []
        group = np.repeat(np.arange(len(first)), size)
        small = size[group] <= 8
        for d in range(1, 8):
            i = np.flatnonzero((group[d:] == group[:-d]) & small[d:])
            i = i[_near(fp[i], fp[i + d]) & (fp[i] != fp[i + d]) & (home[i] | home[i + d])]
            us.append(fp[i])
            vs.append(fp[i + d])
        for g in np.flatnonzero(size > 8):
            part = slice(first[g], first[g] + size[g])
            if home[part].any():
                u, v = cell_links(fp[part], home[part])
                us.append(np.array(u, "i8"))
                vs.append(np.array(v, "i8"))
        u, v = np.concatenate(us), np.concatenate(vs)
        both = np.unique(np.stack([np.minimum(u, v), np.maximum(u, v)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["u", "v"])

    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cell = np.stack([np.asarray(batch.column(c)).astype("i8") for c in ("anchor", "i", "j")], axis=1)
        now = (cell, np.asarray(batch.column("fp")), np.asarray(batch.column("home").to_numpy(zero_copy_only=False)))
        whole = np.flatnonzero((cell != cell[-1]).any(axis=1))
        if len(whole):  # all cells but the last are complete
            end = whole[-1] + 1
            yield links(*(np.concatenate([*(h[k] for h in held), now[k][:end]]) for k in range(3)))
            held, now = [], tuple(x[end:] for x in now)
        held.append(now)
    if held:
        yield links(*(np.concatenate([h[k] for h in held]) for k in range(3)))
    give_back()


def near_links(fps: DataFrame, cell: int = CELL) -> DataFrame:
    """u, v: links between distinct fingerprints (column fp) that keep the components of all links at 3 bits or fewer."""
    sent = fps.select("fp").mapInArrow(_to_anchors, "anchor long, fp long, home boolean")
    crowded = cut(sent.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell))
    n = crowded.count()
    if n:
        sides = crowded.select("anchor", F.ceil(F.col("n") / cell).cast("int").alias("k"))
        dealt = sent.join(F.broadcast(sides) if n <= BROADCAST_ROWS else sides, "anchor", "left").withColumn("k", F.coalesce("k", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
        steps = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
        guests = dealt.select("anchor", "fp", F.lit(False).alias("home"), own.alias("j"), steps.alias("i"))
        homes = dealt.where("home").select("anchor", "fp", "home", own.alias("i"), steps.alias("j"))
        cells = guests.unionByName(homes).repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j")
    else:
        cells = sent.repartition("anchor").sortWithinPartitions("anchor").withColumns({"i": F.lit(0), "j": F.lit(0)})
    return cells.mapInArrow(_compare, "u long, v long")


def near_components(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable by links of 3 bits or fewer) for every row."""
    prints = cut(fingerprints(docs))
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(near_links(distinct, cell)).toDF("fp", "root")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose doc_id names their component; rows that repeat its id, once.

    Where all ids of a component are null its rows stay: nothing tells them apart.
    """
    near = near_components(docs, cell).where("doc_id = component_id or component_id is null")
    heads = cut(near.groupBy(F.col("doc_id").alias("head")).agg(F.count(F.lit(1)).alias("rows")))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    held = docs.select(row.alias("row"), F.col("doc_id").alias("id"))
    of_head = F.col("id").eqNullSafe(F.col("head"))
    kept = held.join(heads.where("rows = 1 or head is null"), of_head, "left_semi").select("row.*")
    several = heads.where("rows > 1 and head is not null")
    n = several.count()
    if n:
        repeated = held.join(F.broadcast(several) if n <= BROADCAST_ROWS else several, of_head, "left_semi")
        kept = kept.unionByName(repeated.groupBy("id").agg(F.min("row").alias("row")).select("row.*"))
    return kept


def op3_simhash_cover(spark, sf_dir: str) -> DataFrame:
    found = near_components(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
