"""Research splits: a frozen policy, and guards that speak before any file is touched."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from datetime import date, timedelta
from types import MappingProxyType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ticks import iso_date, weekdays

ROLES = ("development", "validation", "final_test")
#: The frozen policy, byte by byte, as its hash is taken over the text.
POLICY_TEXT = """{
  "schema_version": 1,
  "policy_id": "gc-mbp1-chronological-v1",
  "frozen_on": "2026-10-01",
  "assignment_key": "session_date_ny",
  "timezone": "America/New_York",
  "coverage_start": "2021-09-27",
  "coverage_end": "2026-09-25",
  "selection_basis": "Approximately 60/20/20 elapsed time, whole sessions and month-end boundaries; no outcome-based selection",
  "splits": [
    {"name": "development", "start": "2021-09-27", "end": "2024-09-30"},
    {"name": "validation", "start": "2024-10-01", "end": "2025-09-30"},
    {"name": "final_test", "start": "2025-10-01", "end": "2026-09-25"}
  ]
}
"""
POLICY = json.loads(POLICY_TEXT)


@dataclass(frozen=True)
class Split:
    name: str
    start: date
    end: date

    def holds(self, day: date) -> bool:
        return self.start <= day <= self.end

    def meets(self, first: date, last: date) -> bool:
        return first <= self.end and self.start <= last


def _spans(policy: dict) -> list[Split]:
    return [Split(s["name"], iso_date(s["start"]), iso_date(s["end"])) for s in policy["splits"]]


#: What a policy must hold to, by name; each rule gets the policy and its splits.
RULES = {
    "its days run from the start of the coverage to its end, each in one split": lambda p, s: (
        [x.start for x in s] + [s[-1].end + timedelta(days=1)] == [iso_date(p["coverage_start"]), *(x.end + timedelta(days=1) for x in s)] and s[-1].end == iso_date(p["coverage_end"])
    ),
    "no split ends before it starts": lambda p, s: all(x.start <= x.end for x in s),
    "the splits are development, validation and final_test": lambda p, s: tuple(x.name for x in s) == ROLES,
    "a holdout starts with a month": lambda p, s: {x.start.day for x in s[1:]} == {1},
    "sessions are assigned by their New York date, under version 1": lambda p, s: (p["schema_version"], p["assignment_key"], p["timezone"]) == (1, "session_date_ny", "America/New_York"),
}


def parse_policy(policy: dict) -> MappingProxyType[str, Split]:
    """The splits of a policy by name; ValueError with all the rules that it breaks."""
    splits = _spans(policy)
    broken = [rule for rule, holds in RULES.items() if not holds(policy, splits)]
    if broken:
        raise ValueError("the policy breaks: " + "; ".join(broken))
    return MappingProxyType({s.name: s for s in splits})


SPLITS = parse_policy(POLICY)
POLICY_ID = POLICY["policy_id"]
POLICY_SHA256 = hashlib.sha256(POLICY_TEXT.encode()).hexdigest()


def split_of(day: str, splits: MappingProxyType[str, Split] = SPLITS) -> str:
    """The split that a session belongs to; ValueError outside the coverage."""
    found = [s.name for s in splits.values() if s.holds(iso_date(day))]
    if not found:
        raise ValueError(f"{day} lies outside the frozen coverage")
    return found[0]


def split_column(day: Column, splits: MappingProxyType[str, Split] = SPLITS) -> Column:
    """The split as an expression: a few comparisons, no join; null outside the coverage."""
    out = F.lit(None).cast("string")
    for s in splits.values():
        out = F.when(day.between(F.lit(s.start), F.lit(s.end)), F.lit(s.name)).otherwise(out)
    return out


def authorize(first: str, last: str, *, allow_validation: bool = False, allow_final_test: bool = False, splits: MappingProxyType[str, Split] = SPLITS) -> tuple[date, date]:
    """The range as dates, or the first objection: flags that are no booleans, bad dates, order, coverage, holdouts."""
    allowed = {"validation": allow_validation, "final_test": allow_final_test}
    for name, flag in allowed.items():
        if not isinstance(flag, bool):
            raise TypeError(f"allow_{name} must be True or False")
    a, b = iso_date(first), iso_date(last)
    if b < a:
        raise ValueError("the range ends before it starts")
    if a < splits[ROLES[0]].start or b > splits[ROLES[-1]].end:
        raise ValueError("the range leaves the frozen coverage")
    for name, flag in allowed.items():
        if splits[name].meets(a, b) and not flag:
            raise PermissionError(f"{name} is held out ({splits[name].start} to {splits[name].end}); it takes allow_{name}=True")
    return a, b


def assignments(inventory: DataFrame, splits: MappingProxyType[str, Split] = SPLITS) -> DataFrame:
    """session_date_ny, split, record_count, raw_file, raw_sha256 for an inventory (session_date string, ...).

    ValueError for repeated dates, dates other than the weekdays of the coverage, and counts that are null or negative.
    """
    spark = inventory.sparkSession
    days = inventory.groupBy("session_date").agg(F.count(F.lit(1)).alias("n"), F.min("record_count").alias("least"), F.count("record_count").alias("known"))
    expected = spark.createDataFrame([(d.isoformat(),) for d in weekdays(splits[ROLES[0]].start, splits[ROLES[-1]].end)], "session_date string")
    seen = days.join(F.broadcast(expected.withColumn("due", F.lit(True))), "session_date", "full_outer")
    for wrong, message in (
        (F.col("n") > 1, "repeated session dates"),
        (F.col("n").isNull() | F.col("due").isNull(), "dates differ from the weekdays of the coverage"),
        ((F.col("least") < 0) | (F.col("known") < F.col("n")), "record counts must be whole and not negative"),
    ):
        if found := seen.where(wrong).limit(1).collect():
            raise ValueError(f"{message}: {found[0]['session_date']}")
    day = F.col("session_date").cast("date")
    return inventory.select(F.col("session_date").alias("session_date_ny"), split_column(day, splits).alias("split"), F.col("record_count").cast("long"), "raw_file", F.col("sha256").alias("raw_sha256"))


def split_summary(assigned: DataFrame) -> DataFrame:
    """split, sessions, empty_sessions, records."""
    return assigned.groupBy("split").agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("record_count") == 0).alias("empty_sessions"), F.sum("record_count").alias("records"))


def policy_table(spark: SparkSession, splits: MappingProxyType[str, Split] = SPLITS) -> DataFrame:
    """split, start, end: three rows, for joins."""
    return spark.createDataFrame([(s.name, s.start, s.end) for s in splits.values()], "split string, start date, end date")
