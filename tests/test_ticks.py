import hashlib
import itertools
import os
from datetime import date
from statistics import median

import numpy as np
import pytest
from helpers import DAY, records, ticks
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomlake import queries
from loomlake.functions import ticks as tf
from loomlake.operators import audit, native, normalize, order, products
from loomlake.schema import UNDEF_PRICE, UNDEF_TIMESTAMP

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def one(spark, found, **how):
    return audit.session_audit(ticks(spark, (DAY, found)), **how).first()


def test_bounds_follow_daylight_saving(spark):
    winter, summer = tf.session_bounds("2024-01-08"), tf.session_bounds("2024-07-08")
    assert winter[1] - winter[0] == summer[1] - summer[0] == 18_000 * 10**9
    assert (winter[0] // 10**9 % 86_400, summer[0] // 10**9 % 86_400) == (12 * 3600, 11 * 3600)
    days = spark.createDataFrame([(date(2024, 1, 8),), (date(2024, 7, 8),)], "d date")
    assert [tuple(r) for r in days.select(tf.bound_ns(F.col("d"), 7), tf.bound_ns(F.col("d"), 12)).collect()] == [winter, summer]


def test_normalize_keeps_native_bytes_and_continues_state(spark):
    found = records()
    found["price"][0], found["ts_event"][1], found["instrument_id"][3:] = UNDEF_PRICE, UNDEF_TIMESTAMP, 200
    table = normalize.normalize(ticks(spark, (DAY, found)), 3, 99)
    rows = table.orderBy("event_idx_day").collect()
    assert [r["roll_segment"] for r in rows] == [4, 4, 4, 5, 5, 5]
    assert [r["contract_change"] for r in rows] == [True, False, False, True, False, False]
    assert [r["ts_event_ns"] is None for r in rows] == [False, True, False, False, False, False]
    assert order.outgoing_state(table, 3, 99) == {"last_id": 200, "roll_segment": 5}
    body = b"".join(r["record"] for r in native.packed(table).orderBy("event_idx_day").collect())
    assert body == found.tobytes()
    assert native.ordered_digest(table).first()["sha256"] == hashlib.sha256(found.tobytes()).hexdigest()
    assert normalize.differing_rows(table, 3, 99).count() == 0
    assert normalize.differing_rows(table.withColumn("roll_segment", F.col("roll_segment") + 1), 3, 99).count() == 6
    back = native.unpacked(native.packed(table))
    assert back.exceptAll(table.select(back.columns)).count() == 0


def test_first_row_of_the_data_is_no_change(spark):
    rows = order.with_roll_segment(ticks(spark, (DAY, records(3)))).collect()
    assert [(r["contract_change"], r["roll_segment"]) for r in rows] == [(False, 1)] * 3


def test_offsets_before_the_session_are_floored(spark):
    found = records(3)
    start = tf.session_bounds(DAY)[0]
    found["ts_event"] = [start - 1, start, start + 60 * 10**9]
    rows = normalize.with_times(ticks(spark, (DAY, found))).orderBy("event_idx_day").collect()
    assert [(r["ns_from_0700"], r["minute_from_0700"]) for r in rows] == [(-1, -1), (0, 0), (60 * 10**9, 1)]


def test_a_timestamp_beyond_63_bits_that_is_no_sentinel_raises(spark):
    found = records(2)
    found["ts_event"][0] = 2**63 + 5
    with pytest.raises(Exception, match="does not fit"):
        normalize.with_times(ticks(spark, (DAY, found))).collect()


def test_exact_duplicates_are_complete(spark):
    found = records()
    found["ts_recv"] = found["ts_recv"][0]
    found[3:] = found[[0, 1, 0]]
    row = one(spark, found)
    assert row["checks"]["exact_duplicates"] == 3
    assert row["checks"]["adjacent_exact_duplicates"] == 0
    assert row["duplicate_coverage_complete"]


def test_anomalies_are_flagged(spark):
    found = records()
    found["ts_recv"][3] -= np.uint64(2)
    found["bid_px_00"][2], found["flags"][2] = found["ask_px_00"][2] + 1, 0
    found["bid_px_00"][4], found["bid_sz_00"][4], found["bid_ct_00"][4] = UNDEF_PRICE, 0, 0
    row = one(spark, found)
    assert not row["duplicate_coverage_complete"]
    assert (row["checks"]["crossed_bbo_partial"], row["checks"]["crossed_bbo_last"], row["checks"]["quote_size_count_mismatch"]) == (1, 0, 0)
    assert row["first_example_event_idx"]["recv_reversal"] == 3
    assert row["validation_status"] == "WARNING | VALID BUT UNUSUAL"
    assert set(row["warnings"]) == {"recv_reversal", "trailing_gap_over_60s"}


def test_counters_cover_all_checks_and_zero_is_there(spark):
    row = one(spark, records())
    assert sorted(row["checks"]) == sorted(audit.CHECKS) and len(audit.CHECKS) == 41
    assert row["checks"]["unknown_side"] == 0


def test_sentinel_receive_times(spark):
    found = records(3)
    found["ts_recv"][0] = UNDEF_TIMESTAMP
    row = one(spark, found)
    assert row["checks"]["undefined_timestamp"] == 1 and row["checks"]["recv_outside_session"] == 1
    assert row["checks"]["recv_gap_over_60s"] == 1  # as signed bits the sentinel is -1
    assert row["checks"]["recv_reversal"] == 1  # as unsigned it is the largest value


def test_empty_sessions_come_from_the_calendar(spark):
    days = tf.calendar(spark, "2024-09-02", "2024-09-03")
    rows = audit.session_audit(ticks(spark, (DAY, records())), days).orderBy("session_date_ny").collect()
    assert [r["record_count"] for r in rows] == [6, 0]
    assert rows[1]["validation_status"] == "VALID BUT UNUSUAL" and rows[1]["checks"] == {} and rows[1]["unusual"] == ["empty_session"]


def test_degraded_session_is_told(spark):
    row = audit.session_audit(ticks(spark, ("2024-09-18", records(6, "2024-09-18")))).first()
    assert "KNOWN DEGRADED SOURCE DATA" in row["validation_status"]


def test_unmapped_instruments(spark):
    mapping = spark.createDataFrame([(date(2024, 9, 2), date(2024, 9, 3), 100)], "start_date date, end_date date, instrument_id long")
    days = tf.calendar(spark, "2024-09-02", "2024-09-03")
    mapped = audit.mapped_instruments(mapping, days)
    assert [tuple(r) for r in mapped.collect()] == [(date(2024, 9, 2), 100)]
    found = records()
    found["instrument_id"][5] = 7
    assert one(spark, found, mappings=mapped)["checks"]["mapping_mismatch"] == 1


@quick
@given(st.lists(st.lists(st.integers(1, 3), max_size=9), min_size=1, max_size=4), st.integers(1, 4))
def test_segments_equal_a_fold_whatever_the_slice(spark, sessions, size):
    days = ["2024-09-02", "2024-09-03", "2024-09-04", "2024-09-05"]
    made, expected, last, segment = [], [], None, 1
    for day, ids in zip(days, sessions, strict=False):
        found = records(len(ids), day)
        found["instrument_id"] = ids
        made.append((day, found))
        for i, x in enumerate(ids):
            segment += last is not None and x != last
            expected.append((date.fromisoformat(day), i, last is not None and x != last, segment))
            last = x
    rows = order.with_roll_segment(ticks(spark, *made), size=size).orderBy("session_date_ny", "event_idx_day")
    assert [(r["session_date_ny"], r["event_idx_day"], r["contract_change"], r["roll_segment"]) for r in rows.collect()] == expected
    previous = order.with_previous(ticks(spark, *made), ["instrument_id"], size).orderBy("session_date_ny", "event_idx_day").collect()
    own = [None if not i else ids[i - 1] for ids in sessions for i in range(len(ids))]
    assert [r["prev_instrument_id"] for r in previous] == own


@quick
@given(st.lists(st.integers(0, 60), min_size=1, max_size=60))
def test_activity_equals_a_trailing_median(spark, counts):
    days = list(itertools.islice((d for d in tf.weekdays(date(2024, 1, 1), date(2024, 12, 31))), len(counts)))
    table = spark.createDataFrame(list(zip(days, counts, counts, strict=True)), "session_date_ny date, record_count long, trade_volume long")
    expected, history = [], []
    for n in counts:
        m = median(history[-20:]) if len(history) >= 10 else None
        expected.append(bool(m and m > 0 and (n < 0.1 * m or n > 10 * m)))
        if n:
            history.append(n)
    assert [r["record_count_outlier"] for r in products.activity_flags(table).orderBy("session_date_ny").collect()] == expected


def test_activity_changes_the_status(spark):
    base = [(d, 100 if i < 12 else 1) for i, d in enumerate(tf.weekdays(date(2024, 1, 1), date(2024, 1, 17)))]
    table = spark.createDataFrame([(d, n, n, [], "PASS") for d, n in base], "session_date_ny date, record_count long, trade_volume long, warnings array<string>, validation_status string")
    rows = products.with_activity(table).orderBy("session_date_ny").collect()
    assert rows[0]["validation_status"] == "PASS" and rows[-1]["validation_status"] == "PASS | WARNING"


def test_gaps_agree_with_the_audit(spark):
    found = records(4)
    found["ts_recv"][2:] += np.uint64(61 * 10**9)
    rows = ticks(spark, (DAY, found))
    gaps = products.coverage_gaps(rows, audit.session_audit(rows)).collect()
    assert sorted(g["kind"] for g in gaps) == ["internal", "trailing"]
    assert next(g for g in gaps if g["kind"] == "internal")["right_event_idx_day"] == 2
    wrong = audit.session_audit(ticks(spark, (DAY, records(4))))
    with pytest.raises(ValueError, match="internal gaps"):
        products.coverage_gaps(rows, wrong)


def test_context_rows_come_once(spark):
    rows = ticks(spark, (DAY, records(10)))
    targets = spark.createDataFrame([(date(2024, 9, 2), "a", 1), (date(2024, 9, 2), "b", 2)], "session_date_ny date, check_name string, target long")
    assert sorted(r["event_idx_day"] for r in products.warning_context(rows, targets).collect()) == [0, 1, 2, 3, 4]


def test_empty_table(spark):
    none = ticks(spark)
    assert audit.session_audit(none).count() == 0
    assert normalize.normalize(none).count() == 0
    assert native.ordered_digest(none).count() == 0
    assert products.coverage_gaps(none).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are not here")
def test_sentinels_of_all_rows_are_converted(spark):
    found = queries.QUERIES["sentinel_to_null"](spark, "/root/testdata/sf0.001")
    raw = queries.ticks_from_events(spark, "/root/testdata/sf0.001").select("session_date_ny", "event_idx_day", "ts_event_raw").collect()
    want = {(r[0], r[1]): None if int(r[2]) == UNDEF_TIMESTAMP else int(r[2]) for r in raw}
    mine = {(r["session_date_ny"], r["event_idx_day"]): r["ts_event_ns"] for r in found.collect()}
    assert mine == want and {i % 7 for _, i in mine} == set(range(7))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are not here")
def test_empty_sessions_of_the_whole_calendar(spark):
    found = {r["session_date_ny"] for r in queries.QUERIES["empty_sessions"](spark, "/root/testdata/sf0.001").collect()}
    assert found == {r[0] for r in tf.calendar(spark, queries.FIRST, queries.LAST).collect()} and max(found) > date(2024, 3, 29) and min(found) < date(2024, 1, 1)
