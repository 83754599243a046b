from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from loomlake.functions.ticks import iso_date, weekdays
from loomlake.plans import policy, resources


@pytest.mark.parametrize("bad", ["20240930", "2024-W40-1", "2024-09-31", "", "2024-9-1", None])
def test_only_plain_dates(bad):
    with pytest.raises(ValueError):
        iso_date(bad)


def test_guards_in_order():
    with pytest.raises(TypeError):
        policy.authorize("bad", "bad", allow_validation="false")
    for a, b in (("2024-09-30", "2024-09-01"), ("2021-09-26", "2021-09-27"), ("2026-09-25", "2026-09-26"), ("20240930", "2024-10-01")):
        with pytest.raises(ValueError):
            policy.authorize(a, b, allow_validation=True, allow_final_test=True)
    with pytest.raises(PermissionError, match="validation"):
        policy.authorize("2024-09-30", "2025-10-01")
    with pytest.raises(PermissionError, match="final_test"):
        policy.authorize("2024-09-30", "2025-10-01", allow_validation=True)
    with pytest.raises(PermissionError, match="validation"):
        policy.authorize("2024-09-30", "2024-10-01", allow_final_test=True)
    assert policy.authorize("2021-09-27", "2024-09-30") == (date(2021, 9, 27), date(2024, 9, 30))


@pytest.mark.parametrize("change", [("validation", "start", "2024-09-30"), ("validation", "start", "2024-10-02"), ("final_test", "start", "2025-09-01"), ("final_test", "end", "2026-09-24")])
def test_bad_policies(change):
    name, key, value = change
    bad = policy.POLICY | {"splits": [s | ({key: value} if s["name"] == name else {}) for s in policy.POLICY["splits"]]}
    with pytest.raises(ValueError):
        policy.parse_policy(bad)
    with pytest.raises(ValueError):
        policy.parse_policy(policy.POLICY | {"splits": policy.POLICY["splits"][::-1]})
    with pytest.raises(ValueError):
        policy.parse_policy(policy.POLICY | {"schema_version": 2})


def test_holdouts_begin_with_a_month():
    splits = [dict(s) for s in policy.POLICY["splits"]]
    splits[0]["end"], splits[1]["start"] = "2024-10-01", "2024-10-02"
    with pytest.raises(ValueError, match="month"):
        policy.parse_policy(policy.POLICY | {"splits": splits})


def _inventory(spark, days):
    return spark.createDataFrame([(d.isoformat(), 0 if i % 5 == 0 else i, f"f{i}", f"h{i}") for i, d in enumerate(days)], "session_date string, record_count long, raw_file string, sha256 string")


def test_assignments(spark):
    days = weekdays(date(2021, 9, 27), date(2026, 9, 25))
    found = policy.assignments(_inventory(spark, days))
    assert {r["split"]: r["sessions"] for r in policy.split_summary(found).collect()} == {"development": 786, "validation": 261, "final_test": 258}
    for wrong in (days[1:], [*days, days[0]], [*days, date(2026, 9, 26)], [*days, days[-1] + timedelta(days=30)]):
        with pytest.raises(ValueError):
            policy.assignments(_inventory(spark, wrong))
    with pytest.raises(ValueError, match="counts"):
        policy.assignments(_inventory(spark, days).withColumn("record_count", F.when(F.col("raw_file") == "f3", -1).otherwise(F.col("record_count"))))
    assert policy.split_of("2024-10-01") == "validation"
    with pytest.raises(ValueError):
        policy.split_of("2026-09-26")
    assert policy.policy_table(spark).count() == 3


def test_plans():
    assert resources.plan_processing(4.2, total_gb=32, available_gb=24).chunks == 1
    plan = resources.plan_processing(4.2, total_gb=8, available_gb=2.4)
    assert 3 <= plan.chunks <= 16 and plan.tier == "medium" and plan.chunked
    assert resources.plan_processing(4.2, total_gb=16, available_gb=3.0).tier == "high"
    assert resources.plan_processing(500, total_gb=8, available_gb=1).chunks == 16
    assert "chunk" in plan.describe() and plan.shuffle_partitions(4) == 4 * plan.chunks
    for bad in (0, -1):
        with pytest.raises(ValueError):
            resources.plan_processing(bad)
    assert [resources.memory_tier(x) for x in (16, 15.9, 8, 7.9)] == ["high", "medium", "medium", "low"]
    assert min(resources.machine_memory_gb()) > 0


def test_chunks(spark):
    days = weekdays(date(2024, 1, 1), date(2024, 1, 15))
    chunks = resources.chronological_chunks([*days, days[0]], 4)
    assert [d for c in chunks for d in c] == days and max(map(len, chunks)) - min(map(len, chunks)) <= 1
    assert resources.chronological_chunks(days[:2], 5) == [[days[0]], [days[1]]]
    table = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r["chunk"] for r in resources.chunk_column(table, "d", 4).orderBy("d").collect()] == [i + 1 for i, c in enumerate(chunks) for _ in c]
