import json
from datetime import date
from pathlib import Path

import pytest
from helpers import DAY, records, ticks
from pyspark.sql import functions as F

from loomlake.operators import native, store
from loomlake.operators.normalize import normalize
from loomlake.sources import access, bronze
from loomlake.sources.access import committed_files, row_groups_met, scan, scan_development
from loomlake.streaming.sessions import audit_stream, tick_stream


@pytest.fixture()
def built(spark, tmp_path):
    rows = ticks(spark, (DAY, records()), ("2024-09-03", records(4, "2024-09-03")), ("2024-10-01", records(3, "2024-10-01")))
    done = store.build_store(rows, ["2024-09", "2024-10"], tmp_path / "s", {}, config={})
    return rows, tmp_path / "s", done


def test_store_round_trip_and_guards(spark, built):
    rows, root, done = built
    assert sum(f["rows"] for c in done for f in c["files"]) == 13
    assert scan_development(spark, root).count() == 10
    assert scan(spark, root, "2024-09-03", "2024-09-03", ["price"]).columns == ["price"]
    assert scan(spark, root, "2024-09-04", "2024-09-04").count() == 0
    with pytest.raises(PermissionError):
        scan(spark, root, "2024-10-01", "2024-10-01")
    assert scan(spark, root, "2024-09-03", "2024-10-01", allow_validation=True).count() == 7
    with pytest.raises(TypeError):
        scan_development(spark, root, allow_validation=True)
    with pytest.raises(ValueError, match="No completed"):
        scan(spark, root, "2024-01-02", "2024-01-03")
    assert json.loads((root / "_run.json").read_text())["status"] == "COMPLETE"
    stored = scan(spark, root, "2024-09-01", "2024-10-31", allow_validation=True)
    assert store.verify(stored, rows, root)["records"] == 13
    plan = stored._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(session_date_ny)" in plan
    met, total = row_groups_met(committed_files(root, "2024-09-01", "2024-09-30"), "2024-09-03", "2024-09-03")
    assert 1 <= met <= total


def test_parts_hold_one_session_each_in_order(spark, built):
    import pyarrow.parquet as pq

    _, root, done = built
    parts = [root / f"year=2024/month={c['month'][5:]}" / f["name"] for c in done for f in c["files"]]
    days = [pq.read_table(p, columns=["session_date_ny"])["session_date_ny"].to_pylist() for p in parts]
    assert [set(d) for d in days] == [{date(2024, 9, 2)}, {date(2024, 9, 3)}, {date(2024, 10, 1)}]
    schema = spark.read.parquet(str(parts[0])).schema
    store.require_order(parts[0].parent, schema, spark)
    turned = pq.read_table(parts[0])
    pq.write_table(turned.take(list(range(turned.num_rows))[::-1]), parts[0])
    with pytest.raises(ValueError, match="delivery order"):
        store.require_order(parts[0].parent, schema, spark)


def test_parts_and_groups_are_capped(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = ticks(spark, (DAY, records(50)), ("2024-09-03", records(45, "2024-09-03")))
    store.write_parts(normalize(rows), tmp_path / "s", part_rows=20, group_rows=8)
    parts = sorted((tmp_path / "s").glob("part-*.parquet"))
    tables = [pq.read_table(p) for p in parts]
    assert all(t.num_rows <= 20 for t in tables) and sum(t.num_rows for t in tables) == 95
    places = [(d, i) for t in tables for d, i in zip(t["session_date_ny"].to_pylist(), t["event_idx_day"].to_pylist(), strict=True)]
    assert places == sorted(places) and all(len(set(t["session_date_ny"].to_pylist())) == 1 for t in tables)
    store.require_order(tmp_path / "s", normalize(rows).schema, spark)


def test_months_start_from_the_state_before_them(spark, tmp_path):
    days = ["2024-07-30", "2024-07-31", "2024-08-01", "2024-10-01"]
    sessions = [(d, records(3, d)) for d in days]
    for (_, found), i in zip(sessions, (100, 101, 101, 102), strict=True):
        found["instrument_id"] = i
    rows = ticks(spark, *sessions)
    months = ["2024-10", "2024-07", "2024-09", "2024-08"]
    states = store.month_states(rows, months)
    assert [tuple(states[m].values()) for m in sorted(months)] == [(None, 1), (101, 2), (101, 2), (101, 2)]
    done = store.build_store(rows, months, tmp_path / "s", {}, config={})
    assert [c["month"] for c in done] == sorted(months) and done[-1]["outgoing_state"] == {"last_id": 102, "roll_segment": 3}
    stored = scan(spark, tmp_path / "s", "2024-07-01", "2024-10-31", allow_validation=True)
    told = store.verify(stored, rows, tmp_path / "s")
    assert told["guards"] == {"validation": "PASS", "final_test": "PASS"} and told["pruning"]["row_groups"] == 1 and (told["months"], told["records"]) == (4, 12)
    assert [(str(r["session_date_ny"]), r["instrument_id"], r["roll_segment"], r["contract_change"]) for r in told["roll_boundary"]] == [("2024-07-30", 100, 1, False), ("2024-07-31", 101, 2, True)]


def test_verification_finds_each_fault(spark, built):
    rows, root, _ = built
    stored = scan(spark, root, "2024-09-01", "2024-10-31", allow_validation=True)
    with pytest.raises(ValueError, match="native-byte"):
        store.verify(stored, rows.withColumn("price", F.col("price") + 1), root)
    with pytest.raises(ValueError, match="additive"):
        store.verify(stored, rows, root, incoming_segment=4)
    with pytest.raises(ValueError, match="additive"):
        store.verify(stored, rows, root, incoming_id=99)
    place = root / "year=2024/month=09/_SUCCESS.json"
    told = json.loads(place.read_text())
    store.write_json(place, told | {"files": [f | {"rows": f["rows"] + 1} for f in told["files"]]})
    with pytest.raises(ValueError, match="checkpoint"):
        store.verify(stored, rows, root)
    store.write_json(place, told | {"files": [f | {"sha256": "0"} for f in told["files"]]})
    with pytest.raises(ValueError, match="modified"):
        store.verify(stored, rows, root)
    assert store.verify(stored, rows, root, hashes=False)["status"] == "PASS"
    store.write_json(place, told | {"fingerprint": "other"})
    with pytest.raises(ValueError, match="fingerprints"):
        store.verify(stored, rows, root)


def test_hashes_on_executors(spark, tmp_path):
    paths = [tmp_path / str(i) for i in range(3)]
    for i, p in enumerate(paths):
        p.write_bytes(b"x" * i)
    assert store.file_hashes(spark, paths) == {str(p): store.file_sha256(p) for p in paths} and store.file_hashes(spark, []) == {}
    assert store.local_path("file:/a/b") == "/a/b" and store.local_path("/a") == "/a"
    with pytest.raises(ValueError):
        store.local_path("hdfs://x/y")


def test_reuse_leaves_files_alone_and_finds_changes(spark, built):
    rows, root, done = built
    part = next(root.glob("year=2024/month=09/part-*.parquet"))
    before = part.stat().st_mtime_ns
    again = store.build_store(rows, ["2024-09", "2024-10"], root, {}, config={}, reuse_only=True)
    assert again == done and part.stat().st_mtime_ns == before
    with pytest.raises(RuntimeError):
        store.build_month(rows, "2024-09", root, [{"sha256": "new"}], None, {}, reuse_only=True)
    with part.open("ab") as f:
        f.write(b"x")
    with pytest.raises(ValueError, match="modified"):
        store.build_month(rows, "2024-09", root, [], None, {})
    with pytest.raises(ValueError, match="size"):
        committed_files(root, "2024-09-02", "2024-09-02")


def test_rebuild_supersedes(spark, built):
    rows, root, _ = built
    store.build_month(rows, "2024-09", root, [{"sha256": "new"}], None, {})
    assert len(list((root / "_superseded").iterdir())) == 1
    with pytest.raises(FileNotFoundError):  # the catalog is gone until it is written anew
        committed_files(root, "2024-09-02", "2024-09-02")


def test_catalog_and_checkpoint_must_agree(built):
    _, root, _ = built
    place = root / "year=2024/month=09/_SUCCESS.json"
    told = json.loads(place.read_text())
    store.write_json(place, told | {"fingerprint": "other"})
    with pytest.raises(ValueError, match="catalog"):
        committed_files(root, "2024-09-02", "2024-09-02")


def test_reconcile_sees_one_changed_bit(spark):
    found = records()
    changed = found.copy()
    changed["price"][2] += 1
    with pytest.raises(ValueError, match="native-byte"):
        store.reconcile(ticks(spark, (DAY, changed)), ticks(spark, (DAY, found)))
    with pytest.raises(ValueError, match="counts"):
        store.reconcile(ticks(spark, (DAY, found[:5])), ticks(spark, (DAY, found)))


def test_a_flipped_byte_is_found_on_reading(spark, tmp_path):
    spark.range(2000).selectExpr("id * 7919 % 1009 as x").coalesce(1).write.parquet(str(tmp_path / "t"))
    part = next((tmp_path / "t").glob("part-*.parquet"))
    raw = bytearray(part.read_bytes())
    raw[len(raw) // 3] ^= 1
    part.write_bytes(bytes(raw))
    next((tmp_path / "t").glob(".part-*.crc")).unlink()
    with pytest.raises(Exception):  # noqa: B017
        spark.read.parquet(str(tmp_path / "t")).selectExpr("sum(x)").collect()


def test_fingerprints_and_review():
    config, sources, state = {"a": 1}, [{"sha256": "x"}], {"roll_segment": 1}
    review = {"schema_version": 1, "original_build_config": {"a": 0}, "reviewed_runtime_config": config}
    assert store.migration_fingerprint(review, config, sources, state) == store.fingerprint({"a": 0}, sources, state)
    assert store.migration_fingerprint(review, {"a": 2}, sources, state) is None
    assert store.fingerprint(config, [{"sha256": "y"}], state) != store.fingerprint(config, sources, state)


def test_failures_are_recorded_and_writers_exclude_each_other(spark, tmp_path):
    root = tmp_path / "s"
    with store.writer_lock(root), pytest.raises(RuntimeError, match="another writer"), store.writer_lock(root):
        pass
    with pytest.raises(RuntimeError):
        store.build_store(ticks(spark, (DAY, records())), ["2024-09"], root, {}, config={}, reuse_only=True)
    assert json.loads((root / "_run.json").read_text())["status"] == "FAILED"


def test_ledger_is_immutable(tmp_path):
    path = tmp_path / "ledger.json"
    assert store.freeze(path, [{"a": 1}]) == store.freeze(path, [{"a": 1}])
    with pytest.raises(ValueError, match="frozen"):
        store.freeze(path, [{"a": 2}])


def test_metadata_twins_and_report(spark, tmp_path):
    table = spark.createDataFrame([(1, {"k": 2}), (2, {})], "b long, a map<string,long>")
    store.write_metadata(table, tmp_path, "quality")
    assert spark.read.parquet(f"{tmp_path}/quality.parquet").columns == ["a", "b"]
    assert spark.read.option("header", "true").csv(f"{tmp_path}/quality.csv").count() == 2
    assert "| a | b |" in store.report("t", {"x": [{"b": 1, "a": 2}]})


def test_bronze_decodes_what_was_written(spark, tmp_path):
    found = records()
    span = [(date(2024, 9, 2), date(2024, 9, 3), "100")]
    bronze.write_bronze(tmp_path, DAY, found, span)
    bronze.write_bronze(tmp_path, "2024-09-03", found[:0], span)
    rows = bronze.read_bronze(spark, str(tmp_path))
    assert rows.exceptAll(ticks(spark, (DAY, found))).count() == 0 and rows.count() == 6
    spark.dataSource.register(bronze.BronzeSource)
    assert spark.read.format("bronze").load(str(tmp_path)).count() == 6
    told = {r["session_date"]: r for r in bronze.inventory(spark, str(tmp_path)).collect()}
    assert (told[DAY]["record_count"], told["2024-09-03"]["empty"], told[DAY]["error"]) == (6, True, None)


def test_bronze_faults_are_told(spark, tmp_path):
    span = [(date(2024, 9, 2), date(2024, 9, 3), "100")]
    cut, bare, odd = (bronze.write_bronze(tmp_path, d, records(2, d), span) for d in ("2024-09-02", "2024-09-03", "2024-09-04"))
    cut.write_bytes(cut.read_bytes()[:-1])
    Path(f"{bare}.done").unlink()
    odd.unlink()
    (tmp_path / "2024" / "note.txt").write_text("x")
    rows = bronze.inventory(spark, str(tmp_path))
    errors = {r["session_date"]: r["error"] for r in rows.collect()}
    assert "Incomplete" in errors["2024-09-02"] and "marker" in errors["2024-09-03"]
    issues = bronze.inventory_issues(spark, str(tmp_path), rows, date(2024, 9, 2), date(2024, 9, 5))
    kinds = sorted((r["kind"], r["name"]) for r in issues.collect() if r["kind"] != "file_error")
    assert kinds == [("missing_date", "2024-09-04"), ("missing_date", "2024-09-05"), ("orphan_marker", odd.name), ("unexpected_file", "note.txt")]


def test_files_are_decoded_in_chunks(tmp_path, monkeypatch):
    import io

    import numpy as np
    import zstandard

    found = np.concatenate([records(50)] * 4)
    path = bronze.write_bronze(tmp_path, DAY, found, [])
    raw, _ = bronze.decompress(path.read_bytes())
    pack = zstandard.ZstdCompressor().compress
    several = b"".join(pack(raw[i : i + 700]) for i in range(0, len(raw), 700))
    for chunk, block in ((7, 5), (200, 64), (250_000, 1 << 16)):
        monkeypatch.setattr(bronze, "CHUNK", chunk)
        monkeypatch.setattr(bronze, "BLOCK", block)
        batches = list(bronze.decoded(str(path), io.BytesIO(several)))
        assert all(b.num_rows <= chunk for b in batches) and [i for b in batches for i in b.column("event_idx_day").to_pylist()] == list(range(200))
        assert b"".join(native.pack({c: b.column(c) for c in native.NATIVE_COLUMNS}).tobytes() for b in batches) == found.tobytes()
    with pytest.raises(ValueError, match="incomplete"):
        list(bronze.decoded(str(path), io.BytesIO(pack(raw[:-1]))))
    with pytest.raises(ValueError, match="Incomplete Zstandard"):
        list(bronze.decoded(str(path), io.BytesIO(several[:-1])))
    with pytest.raises(ValueError, match="cut off"):
        list(bronze.decoded(str(path), io.BytesIO(pack(raw[:90]))))


def test_inspection_tells_all_fields_and_each_fault(tmp_path):
    import hashlib

    import zstandard

    path = bronze.write_bronze(tmp_path, "2024-09-18", records(3, "2024-09-18"), [], "marked\n")
    good, pack = bronze.inspect_path(path), zstandard.ZstdCompressor().compress
    raw, _ = bronze.decompress(path.read_bytes())
    head, size = bronze.decode_header(raw)
    assert (good["error"], good["record_count"], good["empty"], good["degraded_source"], good["zstd_frames"]) == (None, 3, False, True, 1)
    assert good["marker_sha256"] == hashlib.sha256(b"marked\n").hexdigest() and good["marker_bytes"] == 7 and good["header"] == raw[:size]
    assert good["sha256"] == hashlib.sha256(path.read_bytes()).hexdigest() and good["uncompressed_bytes"] == len(raw) and good["file_bytes"] == path.stat().st_size
    body, at = path.read_bytes(), str(path)
    head.limit = 5
    faults = {
        "name": bronze.inspect(at + "x", body, b""),
        "another year": bronze.inspect(at.replace("/2024/", "/2023/"), body, b""),
        "Missing completion marker": bronze.inspect(at, body, None),
        "Incomplete Zstandard": bronze.inspect(at, body[:-1], b""),
        "another request": bronze.inspect(at, pack(bronze.encode_header(head)), b""),
        "window": bronze.inspect(at.replace("09-18", "09-19"), body, b""),
        "not whole": bronze.inspect(at, pack(raw[:-1]), b""),
        "not a record file": bronze.inspect(at, pack(b"x" * 500_000), b""),
        "changed": bronze.inspect(at, body, b"", lambda: True),
    }
    for said, row in faults.items():
        assert said in row["error"] or said == "not a record file" and "cut off" in row["error"], (said, row["error"])
        assert row["record_count"] is None and row["sha256"] is not None


def test_header_audit(spark, tmp_path):
    path = bronze.write_bronze(tmp_path, DAY, records(1), [], "a\nb\n")
    raw, _ = bronze.decompress(path.read_bytes())
    head = raw[: bronze.decode_header(raw)[1]]
    stored = spark.createDataFrame([(path.name, bytearray(head), "a\nb\n")], "raw_file string, header binary, marker string")
    assert tuple(bronze.header_audit(spark, str(tmp_path), stored).first())[1:] == (True, True)


def test_several_frames_are_one_file(tmp_path):
    import zstandard

    one = zstandard.ZstdCompressor().compress(b"abc")
    assert bronze.decompress(one + one) == (b"abcabc", 2)


def test_stream_gives_the_batch_audit(spark, tmp_path):
    from loomlake.operators.audit import session_audit

    rows = ticks(spark, (DAY, records()), ("2024-09-03", records(4, "2024-09-03")))
    rows.write.parquet(str(tmp_path / "in"))
    audit_stream(tick_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    streamed = spark.read.parquet(f"{tmp_path}/out/*")
    assert streamed.select("session_date_ny", "checks").exceptAll(store.flat(session_audit(rows)).select("session_date_ny", "checks")).count() == 0
    assert streamed.count() == 2


def test_native_bytes_round_trip_by_buffers():
    import numpy as np
    import pyarrow as pa

    found = records(7)
    found["ts_event"][2], found["price"][3], found["ts_in_delta"][1], found["ts_recv"][0] = 2**64 - 1, -(2**63), -5, 2**63
    found["action"][4] = b""
    back = native.unpack(found.tobytes())
    assert native.pack(back).tobytes() == found.tobytes()
    assert [int(x) for x in back["ts_event_raw"].to_pylist()] == found["ts_event"].tolist() and back["action"].to_pylist()[4] == ""
    whole = pa.record_batch(list(back.values()), names=list(back)).slice(2, 4)
    assert native.pack({c: whole.column(c) for c in whole.schema.names}).tobytes() == found[2:6].tobytes()
    assert len(native.pack(native.unpack(b""))) == 0 and native.unpack(np.zeros(0, native.RECORD).tobytes())["size"].to_pylist() == []
    with pytest.raises(ValueError):
        native.unpack(b"x")


def test_totals_tell_dates_and_bytes(spark):
    from loomlake.functions.ticks import calendar
    from loomlake.operators.audit import session_audit
    from loomlake.operators.products import totals

    bad = records(4, "2024-09-03")
    bad["rtype"][1] = 2
    audit = session_audit(ticks(spark, (DAY, records()), ("2024-09-03", bad)), sessions=calendar(spark, "2024-09-02", "2024-09-04"))
    files = spark.createDataFrame([("a", 10), ("b", 5)], "raw_file string, file_bytes long")
    row = totals(audit, files).first()
    assert (row["sessions"], row["raw_files"], row["raw_bytes"]) == (3, 2, 15)
    assert (row["empty_dates"], row["error_dates"], row["warning_dates"]) == ([date(2024, 9, 4)], [date(2024, 9, 3)], [date(2024, 9, 2), date(2024, 9, 3)])


def test_loose_checksum_moves_with_a_value(spark):
    found = records()
    a = native.loose_checksum(ticks(spark, (DAY, found))).first()
    found["price"][1] += 1
    assert native.loose_checksum(ticks(spark, (DAY, found))).first()["checksum"] != a["checksum"]


def test_publish_gives_up_after_its_tries(tmp_path):
    with pytest.raises(OSError):
        store.publish(tmp_path / "none", tmp_path / "there", tries=1)


def test_project_path():
    assert store.project_path("/a/b") == Path("/a/b")
    assert store.project_path("x", "/r") == Path("/r/x")
    assert access.DONE == store.DONE


def test_benchmarks_hold_scans_against_the_manifest(spark, built):
    from loomlake.operators.products import records_per_day
    from loomlake.plans.benchmarks import CASES, query_benchmarks

    rows, root, _ = built
    manifest = records_per_day(rows).withColumnRenamed("records", "record_count")
    found = query_benchmarks(spark, root, manifest)
    assert [r["query"] for r in found] == [c.name for c in CASES for _ in range(2)]
    assert {r["query"]: r["rows"] for r in found} == {"one_day_all_columns": 4, "one_month_selected_columns": 10, "one_day_selected_columns": 4, "date_range_two_months": 10, "records_per_day": 10}
    with pytest.raises(ValueError, match="manifest"):
        query_benchmarks(spark, root, manifest.selectExpr("session_date_ny", "record_count + 1 as record_count"))
