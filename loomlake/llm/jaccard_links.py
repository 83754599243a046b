"""Links between documents whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

BANDS keys of ROWS min-hashes each bring candidates together: a pair of similarity 0.8 shares none of them with
probability (1 - 0.8 ** ROWS) ** BANDS = 3e-6, a closer pair with less. Nothing is linked by hashes of keys alone:
every link is checked on the whole sets. First all members of a bucket are compared with its least; only buckets that
this leaves in more than one component are compared all with all, in cells of bounded size, each telling a forest.

Documents of equal sets are one node. A document of fewer than 5 words is one shingle; without a word it has no node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import cut, pieces, tidy
from .components import components
from .simhash_cover import BROADCAST_ROWS, SEED, shingle_hashes

WORDS, BANDS, ROWS = 5, 24, 4
#: Bytes of a shingle's hash that travel with a set: two different shingles of a pair agree in them once in 10^6 pairs.
WIDTH = 5
#: Rows of a bucket that one cell compares with each other, by side.
CELL = 256
_rng = np.random.default_rng(SEED)
_FLIP, _TIMES = (_rng.integers(0, 1 << 64, BANDS * ROWS, "u8") for _ in range(2))
_TIMES |= np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: str) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(text, WORDS), "u8"))


def set_key(found: np.ndarray) -> int | None:
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), SEED)).astype("i8")) if len(found) else None


def packed_set(found: np.ndarray) -> bytes:
    """The low WIDTH bytes of each hash, in order of what they are."""
    low = np.unique(found & np.uint64((1 << 8 * WIDTH) - 1))
    return np.ascontiguousarray(low.astype("<u8").view("u1").reshape(-1, 8)[:, :WIDTH]).tobytes()


def unpacked_set(body: bytes) -> np.ndarray:
    out = np.zeros((len(body) // WIDTH, 8), "u1")
    out[:, :WIDTH] = np.frombuffer(body, "u1").reshape(-1, WIDTH)
    return out.view("<u8").ravel()


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """BANDS keys for each set, none of them empty."""
    flat = np.concatenate(sets)
    counts = np.fromiter(map(len, sets), "i8", len(sets))
    starts = np.cumsum(counts) - counts
    out = np.empty((len(sets), BANDS), "u8")
    for band in range(BANDS):
        key = np.full(len(sets), band + 1, "u8") * _MIX
        for k in range(band * ROWS, (band + 1) * ROWS):
            key = (key ^ np.minimum.reduceat((flat ^ _FLIP[k]) * _TIMES[k], starts)) * _MIX
            key ^= key >> np.uint64(29)
        out[:, band] = key
    return out.view("i8")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 9 * both >= 4 * (len(a) + len(b))  # both / (a + b - both) >= 0.8, in whole numbers


def forest(keys: np.ndarray, sets: list[np.ndarray]) -> tuple[list[int], list[int]]:
    """A spanning forest of all links among the sets."""
    sizes = np.fromiter(map(len, sets), "i8", len(sets))
    names, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    rest, u, v = np.arange(len(sets)), [], []
    marked = np.zeros(len(names), "i8")
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            node = queue.pop()
            own = flat[starts[node] : starts[node] + sizes[node]]
            marked[own] = 1
            met = 9 * np.add.reduceat(marked[flat], starts)[rest] >= 4 * (sizes[rest] + sizes[node])
            marked[own] = 0
            u += [int(keys[node])] * int(met.sum())
            v += keys[rest[met]].tolist()
            queue += rest[met].tolist()
            rest = rest[~met]
    return u, v


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (a hash of the text), set (its key, null without a word), bands for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = [shingle_set(x or "") for x in batch.column("text").to_pylist()]
            full = [s for s in sets if len(s)]
            found = iter(band_keys(full).tolist() if full else [])
            bands = [next(found) if len(s) else [] for s in sets]
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array([set_key(s) for s in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "set", "bands"])

    told = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"), F.xxhash64(docs["text"].cast("string")).alias("text_key"))
    return told.mapInArrow(run, "doc_id long, text_key long, set long, bands array<long>")


def _sets(docs: DataFrame) -> DataFrame:
    """set, hashes of the rows that have a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            sets = [s for x in batch.column("text").to_pylist() if len(s := shingle_set(x or ""))]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in sets], pa.int64()), pa.array([packed_set(s) for s in sets], pa.binary())], names=["set", "hashes"])

    return docs.select(docs["text"].cast("string")).mapInArrow(run, "set long, hashes binary")


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "a"):
        told = zip(*(batch.column(c).to_pylist() for c in ("a", "b")), strict=True)
        yield batch.select(["u", "v"]).filter(pa.array([similar(*map(unpacked_set, row)) for row in told], pa.bool_()))


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell (bucket, i, j) -> links."""

    def links(held: dict[int, bytes]) -> pa.RecordBatch:
        u, v = forest(np.array(list(held), "i8"), [unpacked_set(x) for x in held.values()])
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    now, held = None, {}
    for batch in pieces(batches, "hashes"):
        for bucket, i, j, key, hashes in zip(*(batch.column(c).to_pylist() for c in ("bucket", "i", "j", "set", "hashes")), strict=True):
            if (bucket, i, j) != now:
                if held:
                    yield links(held)
                now, held = (bucket, i, j), {}
            held[key] = hashes
    if held:
        yield links(held)


def jaccard_links(docs: DataFrame, prints: DataFrame, cell: int = CELL) -> DataFrame:
    """u, v: links between keys of sets that keep the components of all pairs of similarity 0.8 or more.

    ``prints``: what :func:`signed` tells of ``docs``.
    """
    sent = prints.where("set is not null").dropDuplicates(["set"]).select("set", F.explode("bands").alias("bucket"))
    shared = sent.groupBy("bucket").agg(F.min("set").alias("least"), F.max("set").alias("most")).where("least < most")
    met = cut(sent.join(shared, "bucket"))
    # buckets of the same members are one
    told = met.groupBy("bucket", "least", "most").agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(set))").alias("x"))
    buckets = told.groupBy("least", "most", "n", "x").agg(F.min("bucket").alias("bucket")).select("bucket", "n")
    members = cut(met.join(buckets, "bucket").select("bucket", "n", "least", "set"))
    wanted = members.select("set").distinct()
    ids = prints.join(wanted, "set", "left_semi").select(F.col("doc_id").alias("id_")).distinct()
    rows = docs.select("doc_id", "text").join(ids, docs["doc_id"].cast("long").eqNullSafe(ids["id_"]), "left_semi")
    sets = cut(_sets(rows).join(wanted, "set", "left_semi").dropDuplicates(["set"]))
    side = lambda c, h: sets.select(F.col("set").alias(c), F.col("hashes").alias(h))
    pairs = members.where("set <> least").select(F.col("set").alias("u"), F.col("least").alias("v")).distinct()
    sure = cut(pairs.join(side("u", "a"), "u").join(side("v", "b"), "v").mapInArrow(_checked, "u long, v long"))
    rooted = members.join(components(sure).toDF("set", "root"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    parted = rooted.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a < b").select("bucket")
    k = F.ceil(F.col("n") / cell).cast("int")
    own = F.pmod(F.xxhash64("set"), F.col("k")).cast("int")
    dealt = members.join(parted, "bucket", "left_semi").withColumn("k", k).withColumn("own", own).withColumn("to", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    dealt = dealt.select("bucket", F.least("own", "to").alias("i"), F.greatest("own", "to").alias("j"), "set").join(sets, "set")
    more = dealt.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(_cells, "u long, v long")
    return sure.unionByName(more)


def keep_one(docs: DataFrame, cell: int = CELL) -> DataFrame:
    """The rows of ``docs``, all columns as they are, but one document alone of each component: that of the smallest
    doc_id (null last), of the smallest hash of the text among texts of one id. Rows alike in both stay or go together;
    rows without a word stay."""
    prints = cut(signed(docs))
    roots = cut(components(jaccard_links(docs, prints, cell)).toDF("set", "root"))
    tidy(docs.sparkSession)
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    known = prints.where("set is not null").select("set", row.alias("row"))
    rooted = known.join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    heads = rooted.groupBy("root").agg(F.min("row").alias("head"), F.max("row").alias("last")).where("head <> last").select("root", "head")
    gone = cut(rooted.join(heads, "root").where("row <> head").select(F.col("row.doc_id").alias("id_"), F.col("row.text_key").alias("key_")).distinct())
    own = docs["doc_id"].cast("long").eqNullSafe(gone["id_"]) & (F.xxhash64(docs["text"].cast("string")) == gone["key_"])
    return docs.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, own, "left_anti")
