"""Resharding by minimum-cost flow: the fewest bytes change shards, then only affected shards are written anew.

Rows of each old shard fall by hash into a fixed number of blocks; only the blocks' sizes, whose number is a
parameter, reach the driver. A flow network (old shard -> same new shard at cost 0, old shard -> hub -> any new shard at
cost 1 a byte) is solved by successive shortest paths; blocks follow the flow, largest first, and a last pass moves
blocks from the fullest to the emptiest shard while that evens them out: first blocks that have left their old shard
anyway, which costs no more bytes, others only when none of those helps. Rows get their slot from their block's offset
and their place in the block, so no task ever holds a whole shard.

Rows alike in id, size and crc are counted first and dealt over blocks in up to ``LOTS`` lots, so that a row that
repeats in a third of the table is spread like any other, and no task holds its copies.

Defined results: null text has size 8 and crc 0; a null doc_id is a value like any other; repeated rows get slots of
their own; an empty table gives an empty result; extra columns are ignored by :func:`assign`. Equal texts are not kept
together: the law is equal bytes, and one text may hold more than a shard's share. Sizes are near equal up to the
largest block, or the largest row where a row outweighs a block; beyond the least bytes that the flow finds, at most
that much of a shard moves.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import cut, documents, fresh_names

OLD_SHARDS, NEW_SHARDS, BLOCKS = 16, 24, 512
#: Lots that the copies of one row are dealt in at most.
LOTS = 4096


class Flow:
    """Minimum-cost flow on a small graph by successive shortest paths with node potentials; costs are not negative."""

    def __init__(self, nodes: int):
        self.ends: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        """An arc and, next to it, its residual twin; returns the arc's number."""
        for start, end, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[start].append(len(self.ends))
            self.ends.append(end)
            self.room.append(r)
            self.cost.append(c)
        return len(self.ends) - 2

    def flow_on(self, arc: int) -> int:
        return self.room[arc ^ 1]

    def run(self, source: int, sink: int) -> int:
        """Send all that fits from source to sink; returns the cost."""
        height, total = [0] * len(self.out), 0
        while True:
            best, via, heap = {source: 0}, {}, [(0, source)]
            while heap:
                d, a = heapq.heappop(heap)
                if d > best[a]:
                    continue
                for e in self.out[a]:
                    b = self.ends[e]
                    if self.room[e] and (far := d + self.cost[e] + height[a] - height[b]) < best.get(b, far + 1):
                        best[b], via[b] = far, e
                        heapq.heappush(heap, (far, b))
            if sink not in best:
                return total
            height = [h + best.get(i, best[sink]) for i, h in enumerate(height)]
            path, at = [], sink
            while at != source:
                path.append(via[at])
                at = self.ends[via[at] ^ 1]
            sent = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= sent
                self.room[e ^ 1] += sent
                total += sent * self.cost[e]


def transfers(old: list[int], new: list[int]) -> dict[tuple[int, int], int]:
    """{(old shard, new shard): bytes} moving the fewest bytes from ``old`` sizes into ``new`` capacities.

    Old shard i continues as new shard i where both exist. The capacities must hold all bytes.
    """
    if sum(new) < sum(old):
        raise ValueError("the new capacities are too small")
    source, hub, sink = range(len(old) + len(new), len(old) + len(new) + 3)
    net = Flow(len(old) + len(new) + 3)
    stay, leave, come = {}, {}, {}
    for i, size in enumerate(old):
        net.arc(source, i, size, 0)
        leave[i] = net.arc(i, hub, size, 1)
        if i < len(new):
            stay[i] = net.arc(i, len(old) + i, size, 0)
    for j, room in enumerate(new):
        net.arc(len(old) + j, sink, room, 0)
        come[j] = net.arc(hub, len(old) + j, room, 0)
    net.run(source, sink)
    out = {(i, i): n for i, e in stay.items() if (n := net.flow_on(e))}
    wanted = [[j, net.flow_on(e)] for j, e in come.items() if net.flow_on(e)]
    for i, e in leave.items():
        left = net.flow_on(e)
        while left:
            n = min(left, wanted[-1][1])
            out[i, wanted[-1][0]] = out.get((i, wanted[-1][0]), 0) + n
            left -= n
            wanted[-1][1] -= n
            if not wanted[-1][1]:
                wanted.pop()
    return out


def place_blocks(blocks: dict[tuple[int, int], tuple[int, int]], capacities: list[int], rounds: int = 20_000) -> dict[tuple[int, int], int]:
    """{block: new shard}; ``blocks`` is {(old shard, block number): (bytes, rows)}."""
    old = [0] * (max((i for i, _ in blocks), default=-1) + 1)
    of = defaultdict(list)
    for (i, b), (size, _) in sorted(blocks.items()):
        old[i] += size
        of[i].append((size, (i, b)))
    need = defaultdict(dict)
    for (i, j), n in transfers(old, capacities).items():
        need[i][j] = n
    placed, load, held = {}, [0] * len(capacities), defaultdict(list)
    for i, own in of.items():
        heap = [(-n, j != i, j) for j, n in need[i].items()] or [(0, False, i % len(capacities))]
        heapq.heapify(heap)
        for size, block in sorted(own, reverse=True):
            n, moved, j = heapq.heappop(heap)
            heapq.heappush(heap, (n + size, moved, j))
            placed[block] = j
            load[j] += size
            held[j].append((size, block))
    for _ in range(rounds):
        over = [n - c for n, c in zip(load, capacities, strict=True)]
        high, low = over.index(max(over)), over.index(min(over))
        half = (over[high] - over[low]) / 2
        # moved bytes: fewer if the block goes home, the same if it has left home, more if it is at home
        trades = ((block[0] == high, block[0] != low, abs(half - size), size, block) for size, block in held[high] if 0 < size < 2 * half)
        best = min(trades, default=None)
        if best is None:
            break
        *_, size, block = best
        held[high].remove((size, block))
        held[low].append((size, block))
        placed[block] = low
        load[high] -= size
        load[low] += size
    return placed


def _even(total: int, n: int) -> list[int]:
    return [total // n + (i < total % n) for i in range(n)]


def assign(
    rows: DataFrame, old_shard: Column, n_new: int = NEW_SHARDS, weights: list[float] | None = None, blocks: int = BLOCKS, place: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, size, text_crc32, old_shard, block, shard, slot for every row of ``rows`` (doc_id, text).

    ``weights``: the new shards' shares of the bytes, equal if not given. ``place``: columns that tell rows apart; they
    are returned too. At most old shards x ``blocks`` sums come to the driver, and as many rows are broadcast.
    """
    spark, text = rows.sparkSession, F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = ["doc_id", "size", "text_crc32", "old_shard", *place]
    sized = rows.select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), old_shard.cast("int").alias("old_shard"), *place
    )
    alike = sized.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    each = F.ceil(F.col("copies") / LOTS)
    lots = alike.select(*key, "copies", each.alias("each"), F.explode(F.sequence(F.lit(0), F.ceil(F.col("copies") / each) - 1)).alias("lot"))
    lots = lots.withColumn("n", F.least("each", F.col("copies") - F.col("lot") * F.col("each"))).withColumn("mixed", F.xxhash64(*key, "lot"))
    dealt = cut(lots.select(*key, "n", "mixed", F.pmod(F.shiftright("mixed", 17), F.lit(blocks)).cast("int").alias("block")))
    sums = dealt.groupBy("old_shard", "block").agg(F.sum(F.col("size") * F.col("n")).alias("bytes"), F.sum("n").alias("n")).collect()
    stats = {(r["old_shard"], r["block"]): (r["bytes"], r["n"]) for r in sums}
    total = sum(b for b, _ in stats.values())
    capacities = _even(total, n_new)
    if weights:
        capacities = [int(total * w / sum(weights)) for w in weights]
        capacities[0] += total - sum(capacities)
    plan, filled = [], [0] * len(capacities)
    for block, j in sorted(place_blocks(stats, capacities).items()):
        plan.append((*block, j, filled[j]))
        filled[j] += stats[block][1]
    table = spark.createDataFrame(plan, "old_shard int, block int, shard int, first long")
    before = Window.partitionBy("old_shard", "block").orderBy("mixed", *key).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0))).join(F.broadcast(table), ["old_shard", "block"])
    nth = F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1))
    return placed.select(*key, "block", "shard", (F.col("first") + F.col("at")).alias("from_"), nth.alias("nth_")).select(
        "doc_id", "size", "text_crc32", "old_shard", "block", "shard", (F.col("from_") + F.col("nth_")).alias("slot"), *place
    )


def hash_shard(n: int) -> Column:
    """The layout that rows are taken to be in: by hash of the id (and of the text, so that null ids spread)."""
    return F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(n))


def reshard_files(spark: SparkSession, old_dir: str, out_dir: str, n_new: int, weights: list[float] | None = None, blocks: int = BLOCKS) -> DataFrame:
    """Reshard a table kept as ``old_dir``/shard=<i>/*.parquet; returns shard, action ("kept" or "written"), bytes, rows.

    A shard that neither loses nor gains a row stays where it is; all others are written to ``out_dir``/shard=<j>,
    ordered by slot, by as many tasks as the bytes ask for. Rows are known by their file and place in it; the text is
    read again only from old shards that lose or gain rows. ``out_dir`` must not lie in ``old_dir``, or the other way
    round: a lost executor's tasks read the old files again.
    """
    a, b = (x.rstrip("/") + "/" for x in (old_dir, out_dir))
    if a.startswith(b) or b.startswith(a):
        raise ValueError("the new shards need a folder apart from the old ones")
    old = spark.read.parquet(old_dir)
    name = [c for c in old.columns if c not in ("shard", "slot")]
    file, row = fresh_names(old.columns, "file", "row")
    own = [F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)]
    placed = cut(assign(old.select("doc_id", "text", F.col("shard").alias("old"), *own), F.col("old"), n_new, weights, blocks, (file, row)))
    moved = placed.where("shard <> old_shard").select(F.explode(F.array("shard", "old_shard")).alias("shard")).distinct()
    touched = sorted(r["shard"] for r in moved.collect())  # at most one row for each old or new shard
    left = old.where(F.col("shard").isin(touched)).select(F.struct(*(F.col(f"`{c}`") for c in name)).alias("whole"), *own)
    right = placed.where(F.col("shard").isin(touched)).select("shard", "slot", file, row)
    rows = left.join(right, [file, row]).select("shard", "slot", "whole")
    rows.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").select("shard", "slot", "whole.*").write.mode("overwrite").partitionBy("shard").parquet(out_dir)
    told = placed.groupBy("shard").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    return told.select("shard", F.when(F.col("shard").isin(touched), "written").otherwise("kept").alias("action"), "bytes", "rows")


def op1_reshard_flow(spark, sf_dir: str) -> DataFrame:
    """All documents from 16 hash shards into 24 shards of near equal bytes."""
    placed = assign(documents(spark, sf_dir), hash_shard(OLD_SHARDS))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard", "block"
    )
