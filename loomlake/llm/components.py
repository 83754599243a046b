"""Connected components of a link table by alternating large-star and small-star steps.

Every round is a pair of joins on aggregated minima, so a node with a third of all links splits like any skewed join.
Each round's links go to the shared folder; nothing but two numbers a round comes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._shared import cut, give_back

LINKS = "u long, v long"


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each batch of links (u, v), links from every node to its smallest node within the batch."""
    for batch in batches:
        u, v = (np.asarray(batch.column(i)) for i in (0, 1))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        a, b = at[: len(u)], at[len(u) :]
        root = np.arange(len(nodes))
        while True:
            low = np.minimum(root[a], root[b])
            new = root.copy()
            np.minimum.at(new, a, low)
            np.minimum.at(new, b, low)
            np.minimum.at(new, root[a], low)
            np.minimum.at(new, root[b], low)
            new = new[new]
            if (new == root).all():
                break
            root = new
        own = root != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(nodes[root[own]])], names=["u", "v"])
    give_back()


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v"), F.col("u"))).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).toDF("u", "v")


def components(links: DataFrame) -> DataFrame:
    """u, v with v the smallest node that u reaches, for every node that has a link to a smaller one.

    ``links``: u, v (long, not null, u <> v), in any order, repeats allowed. No links: an empty result.
    """
    now = cut(links.where("u <> v").mapInArrow(forest, LINKS).where("u <> v").distinct())
    seen = None
    while True:
        told = now.agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if not told["n"] or (told["n"], told["x"]) == seen:
            return now
        seen = (told["n"], told["x"])
        large = _large_star(now).distinct()
        now = cut(_small_star(large).where("u <> v").distinct())
