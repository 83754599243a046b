"""Exact top-k by inner product with M-tree best-first search.

Vectors are floor(SCALE * x). Inner product is no metric, so within a tree every vector x gets one more coordinate,
sqrt(M - |x|^2) with M the tree's largest squared length, and every query a zero: then distance^2 = |q|^2 + M - 2 q.x,
and the nearest are those of the highest inner product.

The root is one page of at most CELLS pivots, from a bounded sample: each vector belongs to its nearest pivot, and each
cell has a covering radius. A cell is cut by hash into trees of at most TREE_BYTES; each tree is built once, in the task
that searches it, of pages that keep their entries' distances to the page's pivot and a covering radius. The k-th best
score of a query among the sample bounds its result from below, so a query goes only to the cells that can still reach
it (q.pivot + |q| radius); the vectors travel once, whatever the number of queries. A search takes pages in order of
their lowest possible distance and ends when that exceeds the k-th best so far; an entry is skipped without computing
its distance when |d(q, parent) - d(entry, parent)| already exceeds the bound plus the entry's radius. Bounds are kept
in floating point with a margin, scores are exact integers. The trees' k best of a query meet in a final top-k.

Defined results: a null vector, one without components, with null or non-finite components (before or after scaling) or
of another length than most takes no part, as query or candidate; a null vec_id takes no part; of repeated ids every row
is a candidate of other ids' queries, and each distinct (id, vector) is a query of its own (told apart by ``nth``), of
which no row of the same id is a candidate; ties go to the smaller vec_id; with fewer than k candidates, all; an empty
table gives an empty result; extra columns are ignored. Components may have any size: where a product could leave 64
bits, vectors are compared with Python's integers; a score beyond 64 bits is told as the nearest of -(2^63 - 1) and
2^63 - 1, while ranks follow the exact score.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._shared import cut

SCALE, K, EVERY, PAGE = 1024, 10, 100, 64
#: Bytes of a tree's vectors, and of the sample that pivots and first bounds come from, at most.
TREE_BYTES = 8 << 20
#: Pivots of the root page, and rows a pivot is worth.
CELLS, CELL_ROWS = 256, 2048
MARGIN = 1e-6
#: The largest score that is told as it is.
TOP = (1 << 63) - 1
#: The cell of vectors whose products may leave 64 bits; it has no pivot, every query goes there.
WIDE = -1


class Page:
    """Entries near a pivot: vectors (a leaf) or child pages, with their distances to the pivot and their radii."""

    __slots__ = ("children", "gap", "pivots", "radii", "rows")

    def __init__(self, pivots: np.ndarray, gap: np.ndarray, radii: np.ndarray, rows: np.ndarray | None, children: list[Page] | None):
        self.pivots, self.gap, self.radii, self.rows, self.children = pivots, gap, radii, rows, children


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((a - b) ** 2).sum(axis=-1), 0))


def build(points: np.ndarray, rows: np.ndarray, pivot: np.ndarray, page: int = PAGE) -> Page:
    """An M-tree over points[rows]: pivots far from each other take the points nearest to them."""
    own = points[rows]
    if len(rows) <= page:
        return Page(own, _far(own, pivot), np.zeros(len(rows)), rows, None)
    fan = min(page, -(-len(rows) // page))
    chosen, best, at = [0], _far(own, own[0]), np.zeros(len(rows), "i8")
    while len(chosen) < max(2, fan):
        new = int(best.argmax())
        d = _far(own, own[new])
        at[d < best] = len(chosen)
        best = np.minimum(best, d)
        chosen.append(new)
    if not best.any() and not at.any():  # all points are equal: even cuts
        at = np.arange(len(rows)) % len(chosen)
    heads, children, radii = [], [], []
    for j, c in enumerate(chosen):
        part = at == j
        if part.any():
            heads.append(own[c])
            radii.append(best[part].max())
            children.append(build(points, rows[part], own[c], page))
    return Page(np.array(heads), _far(np.array(heads), pivot), np.array(radii), None, children)


def widest(d: int) -> int:
    """Components up to this size in d dimensions: no sum of products leaves 62 bits."""
    return int(np.sqrt((1 << 62) / max(d, 1))) - 1


class MTree:
    """A tree over whole-number vectors given as doubles; ``copies``: how many rows each stands for."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, copies: np.ndarray | None = None, page: int = PAGE):
        self.ids, self.copies = ids, np.ones(len(ids), "i8") if copies is None else copies
        self.plain = bool(np.abs(vectors).max(initial=0) <= widest(vectors.shape[1]))
        self.computed = 0
        if not self.plain:
            self.vectors = _exact(vectors)
            return
        self.vectors = vectors.astype("i8")
        lengths = (self.vectors**2).sum(axis=1)
        self.most = int(lengths.max())
        self.points = np.concatenate([vectors, np.sqrt(self.most - lengths)[:, None]], axis=1)
        self.pivot = self.points[0]
        self.root = build(self.points, np.arange(len(ids)), self.pivot, page)

    def search(self, query: np.ndarray, own: int | None, k: int = K, least: float = -np.inf) -> list[tuple[int, int]]:
        """[(score, id)], best first; ``own``: an id that doesn't count; ``least``: scores below it don't either."""
        best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst first

        def meet(rows: np.ndarray, scores: list[int]) -> None:
            self.computed += len(rows)
            for score, i, n in zip(scores, self.ids[rows].tolist(), self.copies[rows].tolist(), strict=True):
                for _ in range(min(n, k) if i != own else 0):
                    if len(best) < k:
                        heapq.heappush(best, (score, -i))
                    elif (score, -i) > best[0]:
                        heapq.heapreplace(best, (score, -i))

        if not self.plain or np.abs(query).max(initial=0) > widest(len(query)):
            rows = np.arange(len(self.ids))
            vectors = self.vectors if not self.plain else self.vectors.astype(object)
            meet(rows, list(vectors @ _exact(query)))
            return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))
        whole, q = query.astype("i8"), np.append(query, 0.0)
        floor_ = float(query @ query) + self.most
        bound = np.inf if least == -np.inf else float(np.sqrt(max(floor_ - 2 * least, 0)))
        slack = MARGIN * (1 + np.sqrt(floor_))
        heap = [(0.0, 0, float(_far(q, self.pivot)), self.root)]
        n = 0
        while heap:
            low, _, parent, page = heapq.heappop(heap)
            if low > bound + slack:
                break
            near = np.flatnonzero(np.abs(parent - page.gap) - page.radii <= bound + slack)
            if not len(near):
                continue
            if page.children is None:
                rows = page.rows[near]
                meet(rows, (self.vectors[rows] @ whole).tolist())
                if len(best) == k:
                    bound = min(bound, float(np.sqrt(max(floor_ - 2 * best[0][0], 0))))
            else:
                self.computed += len(near)
                d = _far(page.pivots[near], q)
                for i, x in zip(near.tolist(), d.tolist(), strict=True):
                    lowest = max(0.0, x - page.radii[i])
                    if lowest <= bound + slack:
                        n += 1
                        heapq.heappush(heap, (lowest, n, x, page.children[i]))
        return sorted(((s, -i) for s, i in best), key=lambda x: (-x[0], x[1]))


def _exact(x: np.ndarray) -> np.ndarray:
    """Whole doubles of any size as Python's integers."""
    return np.array([int(v) for v in x.ravel().tolist()], object).reshape(x.shape)


def told(score: int) -> tuple[int, bytes]:
    """(score within 64 bits, a key that puts scores beyond them in order)."""
    if abs(score) < TOP:
        return score, b""
    return (TOP if score > 0 else -TOP), (score + (1 << 2175)).to_bytes(272, "big")


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, d, x: floor(scale * component) as doubles in bytes, and wide: products may leave 64 bits; rows that take
    no part are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0)).astype("i8")
            with np.errstate(over="ignore", invalid="ignore"):
                x = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype("f8")) + 0.0  # no -0.0
            rows = np.flatnonzero(sizes)
            if not len(rows):
                continue
            first = (np.cumsum(sizes) - sizes)[rows]
            fine = np.logical_and.reduceat(np.isfinite(x), first)
            top = np.maximum.reduceat(np.abs(np.nan_to_num(x, posinf=0, neginf=0)), first)
            wide = top > np.array([widest(d) for d in sizes[rows].tolist()])
            rows, first, wide = rows[fine], first[fine], wide[fine]
            body = [x[a : a + n].tobytes() for a, n in zip(first.tolist(), sizes[rows].tolist(), strict=True)]
            columns = [batch.column("vec_id").take(pa.array(rows)), pa.array(sizes[rows].astype("i4")), pa.array(body, pa.binary()), pa.array(wide)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "d", "x", "wide"])

    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).where("vec_id is not null")
    return known.mapInArrow(run, "vec_id long, d int, x binary, wide boolean")


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "f8").reshape(-1, d)


def _cells(pivots: np.ndarray):
    """Rows -> vec_id, x, cell of the nearest pivot, gap to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x, wide = _matrix(part.column("x"), pivots.shape[1]), part.column("wide").to_numpy(zero_copy_only=False)
                cell, gap = np.full(len(x), WIDE), np.zeros(len(x))
                plain = np.flatnonzero(~wide)
                if len(plain) and len(pivots):
                    own = x[plain]
                    cell[plain] = ((pivots**2).sum(axis=1) - 2 * own @ pivots.T).argmin(axis=1)
                    gap[plain] = _far(own, pivots[cell[plain]])
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("x"), pa.array(cell.astype("i4")), pa.array(gap)], names=["vec_id", "x", "cell", "gap"])

    return run


def _reach(pivots: np.ndarray, radii: dict[int, float], sample: np.ndarray, ids: np.ndarray, k: int):
    """Queries -> vec_id, nth, x, least (a bound that the k-th best score does not fall below), cells that can hold more."""
    cells = np.array(sorted(radii), "i8")
    known = cells[cells != WIDE]
    heads, radius = pivots[known], np.array([radii[c] for c in known])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, asked = _matrix(batch.column("x"), pivots.shape[1]), batch.column("vec_id").to_pylist()
            wide = batch.column("wide").to_numpy(zero_copy_only=False)
            least, reached = np.full(len(x), -np.inf), []
            for i, (q, own) in enumerate(zip(x, asked, strict=True)):
                if wide[i]:
                    reached.append(cells.tolist())
                    continue
                scores = (sample @ q)[ids != own]
                long = np.sqrt(q @ q)
                if len(scores) >= k:
                    least[i] = np.partition(scores, -k)[-k] - 1e-9 * (1 + long * np.sqrt((sample**2).sum(axis=1).max()))
                most = heads @ q + long * radius
                room = 1e-9 * (1 + long * (np.sqrt((heads**2).sum(axis=1)) + radius))
                reached.append([*([WIDE] if WIDE in radii else []), *known[most + room >= least[i]].tolist()])
            columns = [batch.column("vec_id"), batch.column("nth"), batch.column("x"), pa.array(least), pa.array(reached, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "nth", "x", "least", "cells"])

    return run


def _search(d: int, k: int, page: int):
    """Rows sorted by tree (cell, sub), vectors before queries -> the k best of each query in each tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tree = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([np.asarray(batch.column(c)).astype("i8") for c in ("cell", "sub", "kind")], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(key)]
            out: list[tuple] = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                part, (cell, sub, kind) = batch.slice(a, b - a), key[a].tolist()
                if (cell, sub) != now:
                    now, held, tree = (cell, sub), [], None
                x, ids, n = _matrix(part.column("x"), d), np.asarray(part.column("vec_id")), np.asarray(part.column("n"))
                if not kind:
                    held.append((x, ids, n))
                elif held or tree:
                    if tree is None:
                        tree, held = MTree(*(np.concatenate(y) for y in zip(*held, strict=True)), page=page), []
                    least = np.asarray(part.column("least"))
                    for q, own, nth, low in zip(x, ids.tolist(), n.tolist(), least.tolist(), strict=True):
                        out += [(own, nth, i, *told(int(score))) for score, i in tree.search(q, own, k, low)]
            q, nth, i, score, over = zip(*out, strict=True) if out else ((),) * 5
            columns = [pa.array(q, pa.int64()), pa.array(nth, pa.int64()), pa.array(i, pa.int64()), pa.array(score, pa.int64()), pa.array(over, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "nth", "vec_id", "score", "over"])

    return run


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY, page: int = PAGE, tree_bytes: int = TREE_BYTES, cell_rows: int = CELL_ROWS) -> DataFrame:
    """query_id, nth (of the distinct vectors of that id), rank, vec_id, score: for every vec_id divisible by ``every``
    its ``k`` best among the rows of all other ids."""
    rows = cut(integers(vectors))
    most = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if most is None:
        return rows.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("nth"), F.lit(0).alias("rank"), "vec_id", F.col("vec_id").alias("score")).where("false")
    d, n_rows = most["d"], most["n"]
    same = rows.where(F.col("d") == d).drop("d")
    n_sample = max(4 * k, min(8 * CELLS, tree_bytes // (8 * d)))
    drawn = same.where("not wide").orderBy(F.xxhash64("vec_id", "x"), "vec_id", "x").limit(n_sample).collect()  # tree_bytes at most
    sample = np.array([np.frombuffer(r["x"], "f8") for r in drawn]).reshape(-1, d)
    ids = np.array([r["vec_id"] for r in drawn], "i8")
    pivots = np.array([np.frombuffer(x, "f8") for x in dict.fromkeys(bytes(r["x"]) for r in drawn)]).reshape(-1, d)[: min(CELLS, -(-n_rows // cell_rows))]
    celled = same.mapInArrow(_cells(pivots), "vec_id long, x binary, cell int, gap double")
    # rows alike in id and vector are one entry with a count
    distinct = celled.groupBy("cell", "vec_id", "x").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("gap"))
    stats = distinct.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("gap")).collect()  # a row a cell
    entries = max(page, tree_bytes // (8 * d))
    subs = vectors.sparkSession.createDataFrame([(r["cell"], -(-r["n"] // entries)) for r in stats], "cell int, subs int")
    radii = {r["cell"]: r["gap"] * (1 + 1e-12) for r in stats}
    asked = same.where(F.col("vec_id") % every == 0).distinct()
    asked = asked.withColumn("nth", F.row_number().over(Window.partitionBy("vec_id").orderBy("x")).cast("long"))
    reached = asked.mapInArrow(_reach(pivots, radii, sample, ids, k), "vec_id long, nth long, x binary, least double, cells array<int>")
    queries = reached.select("vec_id", F.col("nth").alias("n"), "x", "least", F.explode("cells").alias("cell")).join(F.broadcast(subs), "cell")  # CELLS + 1 rows
    queries = queries.select("cell", F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub"), F.lit(1).alias("kind"), "vec_id", "x", "n", "least")
    own = F.pmod(F.xxhash64("vec_id", "x"), F.col("subs")).cast("int")
    entries = distinct.join(F.broadcast(subs), "cell").select("cell", own.alias("sub"), F.lit(0).alias("kind"), "vec_id", "x", "n", F.lit(None).cast("double").alias("least"))
    met = entries.unionByName(queries).repartition("cell", "sub").sortWithinPartitions("cell", "sub", "kind")
    found = met.mapInArrow(_search(d, k, page), "query_id long, nth long, vec_id long, score long, over binary")
    order = Window.partitionBy("query_id", "nth").orderBy(F.desc("score"), F.desc("over"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("nth").cast("int"), F.col("rank").cast("int"), "vec_id", "score")


def op9_mtree(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).drop("nth")


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
