"""How much to process at once: memory tiers, the number of chronological chunks, and the shuffle width they imply."""

from __future__ import annotations

import math
import os
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The least GB of each tier; the share of free memory to plan with; its floor in GB; the most chunks.
TIERS = {"high": 16, "medium": 8, "low": 0}
SAFETY, FLOOR_GB, MOST_CHUNKS = 0.6, 0.25, 16


def machine_memory_gb() -> tuple[float, float]:
    """(total, available) memory of the driver's machine in GB."""
    page = os.sysconf("SC_PAGE_SIZE")
    return os.sysconf("SC_PHYS_PAGES") * page / 2**30, os.sysconf("SC_AVPHYS_PAGES") * page / 2**30


def memory_tier(total_gb: float) -> str:
    return next(name for name, least in TIERS.items() if total_gb >= least)


def memory_tier_column(total_gb: Column) -> Column:
    return F.when(total_gb >= TIERS["high"], "high").when(total_gb >= TIERS["medium"], "medium").otherwise("low")


@dataclass(frozen=True)
class MemoryPlan:
    estimated_gb: float
    budget_gb: float
    chunks: int
    tier: str

    @property
    def chunked(self) -> bool:
        return self.chunks > 1

    def shuffle_partitions(self, cores: int) -> int:
        """At least one task for each core and chunk."""
        return max(1, cores * self.chunks)

    def describe(self) -> str:
        return f"{self.tier} memory: {self.estimated_gb:.2f} GB estimated, {self.budget_gb:.2f} GB usable, {self.chunks} chunk(s)"


def plan_processing(estimated_gb: float, *, total_gb: float | None = None, available_gb: float | None = None, safety: float = SAFETY, most_chunks: int = MOST_CHUNKS) -> MemoryPlan:
    """How many chunks keep an estimated peak inside the safe share of the memory that is free."""
    if not estimated_gb > 0:
        raise ValueError("the estimate must be positive")
    total, free = machine_memory_gb()
    total, free = total if total_gb is None else total_gb, free if available_gb is None else available_gb
    budget = max(free * safety, FLOOR_GB)
    return MemoryPlan(estimated_gb, budget, min(max(math.ceil(estimated_gb / budget), 1), most_chunks), memory_tier(total))


def chronological_chunks(days: list[date], n: int) -> list[list[date]]:
    """The distinct days in order, in ``n`` parts as even as possible, the longer ones first; empty parts are left out."""
    order, out, at = sorted(set(days)), [], 0
    for i in range(n):
        size = len(order) // n + (i < len(order) % n)
        if size:
            out.append(order[at : at + size])
        at += size
    return out


def chunk_column(days: DataFrame, day: str, n: int) -> DataFrame:
    """Distinct days with their chunk from 1; days are few, so one ordered window over them is small."""
    return days.select(day).distinct().withColumn("chunk", F.ntile(n).over(Window.orderBy(day)))
