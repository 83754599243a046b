import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from conftest import SCHEMA, bag, document, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomlake.llm import components, induced_sort, line_dedup, simhash_cover, suffix_dedup


def sha(raw) -> str:
    return hashlib.sha256(raw.encode() if isinstance(raw, str) else raw).hexdigest()


# ---- lines --------------------------------------------------------------------------------------------------------


def line_key(line: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))


def brute_lines(rows, min_docs):
    texts = {(r[0], r[1] or "") for r in rows}
    count = {}
    for t in texts:
        for key in {line_key(x) for x in t[1].split("\n")} - {""}:
            count[key] = count.get(key, 0) + 1
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if count.get(line_key(x), 0) < min_docs]
        out.append((r[0], len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return out


@pytest.mark.parametrize("min_docs", [2, 10])
def test_lines_equal_brute_force(docs, rows, min_docs):
    found = line_dedup.dedup_lines(docs, min_docs=min_docs).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256))
    assert bag(tuple(r) for r in found.collect()) == bag(brute_lines(rows, min_docs))


def test_line_query_equals_its_sql_on_odd_rows(spark, rows, tmp_path):
    import duckdb

    again = [document(7000, f"hot\nrow {i}") for i in range(12)] + [document(None, f"cold\nrow {i % 9}") for i in range(40)] + [document(8000, "\n".join(["Hot", "x"] * 100))]
    spark.createDataFrame([*rows, *again], SCHEMA).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    found = line_dedup.op7_line_dedup(spark, str(tmp_path))
    oracle = duckdb.connect()
    oracle.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    told = oracle.execute(line_dedup.OP7_SQL)
    names = [d[0] for d in told.description]
    assert bag(tuple(r[c] for c in names) for r in found.collect()) == bag(told.fetchall())
    hot = found.where("doc_id = 8000").first()  # a document is a distinct pair of id and text: twelve of id 7000 hold the line
    assert hot["n_dropped"] == 100 and hot["keep"].startswith("0:aaaaaaaaaaaaaaaa,1:") and found.where("doc_id is null and keep <> ''").count() == 0


def test_lines_keep_the_first(spark):
    made = spark.createDataFrame([document(2, "b\na\nb"), document(1, "a\nc\n a"), document(3, None)], SCHEMA)
    found = {r["doc_id"]: r["kept_text"] for r in line_dedup.dedup_lines(made, "first").collect()}
    assert found == {1: "a\nc", 2: "b", 3: ""}
    with pytest.raises(ValueError):
        line_dedup.dedup_lines(made, "other")


def test_bitmaps_are_sparse_and_lines_many(spark):
    text = "\n".join("hot" if i % 1000 == 500 else f"line {i}" for i in range(3000))
    made = spark.createDataFrame([document(i, text if i == 1 else f"hot\n{i}") for i in range(1, 12)], SCHEMA)
    row = line_dedup.dedup_lines(made).where("doc_id = 1").first()
    assert (row["n_lines"], row["n_dropped"], len(row["keep"])) == (3000, 3, 3)
    assert row["kept_text"] == text.replace("hot\n", "")


def test_apply_keeps_all_columns_and_rows(docs, rows):
    found = line_dedup.apply(docs)
    assert found.columns == docs.columns and found.count() == len(rows)
    assert found.where("doc_id = 1 and text is null").count() == 1
    changed = found.where("doc_id = 21").first()
    assert "\n  " not in changed["text"] and changed["n_chars"] == len(changed["text"]) and changed["row"] == "r"
    same = found.where("doc_id between 5 and 12").exceptAll(docs.where("doc_id between 5 and 12"))
    assert same.count() == 0


def test_lines_of_nothing(none):
    assert line_dedup.dedup_lines(none).count() == 0 and line_dedup.apply(none).count() == 0


# ---- fingerprints -------------------------------------------------------------------------------------------------


def fingerprint(text) -> int:
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(prints: np.ndarray) -> np.ndarray:
    root = np.arange(len(prints))
    while True:
        new = np.array([root[np.bitwise_count(prints ^ p) <= 3].min() for p in prints])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def brute_components(rows):
    prints = np.array([fingerprint(r[1]) for r in rows], "u8")
    root = groups(prints)
    out = []
    for r, p, g in zip(rows, prints, root, strict=True):
        ids = [rows[i][0] for i in np.flatnonzero(root == g) if rows[i][0] is not None]
        out.append((r[0], format(int(p), "016x"), min(ids, default=None)))
    return out


def test_components_equal_brute_force(docs, rows):
    found = simhash_cover.near_components(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id")
    assert bag(tuple(r) for r in found.collect()) == bag(brute_components(rows))


def test_majority_needs_more_than_half():
    h = np.array([0b11, 0b01, 0b10, 0b00], "u8")
    assert simhash_cover.majority_bits(h, np.array([2, 0, 2])).tolist() == [0b01, 0, 0]
    rng = np.random.default_rng(1)
    many = rng.integers(0, 1 << 63, 3000).astype("u8") * np.uint64(2)
    counts = np.array([1, 254, 255, 256, 0, 700, 1534])
    out, at = simhash_cover.majority_bits(many, counts), 0
    for n, got in zip(counts, out, strict=True):
        part = many[at : at + n]
        assert int(got) == sum(1 << b for b in range(64) if 2 * int((part >> np.uint64(b) & np.uint64(1)).sum()) > n)
        at += n


def test_anchors_cover_every_close_pair():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 31, 400)
    assert (simhash_cover.syndromes(x ^ np.concatenate([[0], 1 << np.arange(31)])[simhash_cover.syndromes(x)]) == 0).all()
    at, anchor, home = simhash_cover.anchors(x)
    assert (np.bitwise_count(x[at] ^ anchor) <= 2).all() and (simhash_cover.syndromes(anchor) == 0).all()
    assert np.bincount(at[home], minlength=len(x)).tolist() == [1] * len(x)
    y = x ^ (1 << rng.integers(0, 31, len(x)))
    at_y, anchor_y, _ = simhash_cover.anchors(y)
    sent = set(zip(at_y.tolist(), anchor_y.tolist(), strict=True))
    assert all((i, a) in sent for i, a in zip(at[home].tolist(), anchor[home].tolist(), strict=True))


@pytest.mark.parametrize("cell", [5, 4096])
def test_links_of_crowded_anchors_are_whole(spark, cell):
    rng = np.random.default_rng(3)
    made = {0, 3 | 1 << 63, 1 << 40 | 1 << 63, (1 << 64) - (1 << 40)}
    for centre in rng.integers(0, 1 << 64, 25, "u8").tolist():
        now = centre
        for _ in range(12):  # a chain of steps of up to 3 bits, and stars
            for b in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                now ^= 1 << b
            made.add(now)
            made.add(now ^ 1 << int(rng.integers(0, 64)))
    values = np.array(sorted(made), "u8").view("i8")
    fps = spark.createDataFrame([(int(v),) for v in values], "fp long")
    links = simhash_cover.near_links(fps, cell)
    assert links.where("bit_count(u ^ v) > 3 or u = v").count() == 0
    roots = {r["u"]: r["v"] for r in components.components(links).collect()}
    root = groups(values.view("u8"))
    mine = [roots.get(int(v), int(v)) for v in values]
    assert len(set(zip(mine, root.tolist(), strict=True))) == len(set(mine)) == len(set(root.tolist()))


def test_every_bit_counts_as_one(spark):
    rng = np.random.default_rng(8)
    for base in (0, (1 << 64) - 1, int(rng.integers(0, 1 << 64, dtype="u8"))):
        for wide in (3, 4):  # each bit flipped along with others: linked at 3, not at 4
            flips = [sum(1 << (b + 21 * k) % 64 for k in range(wide - 1)) ^ 1 << (b + 11) % 64 for b in range(64)]
            assert all(f.bit_count() == wide for f in flips)
            near = simhash_cover._near(np.array([base ^ f for f in flips], "u8").view("i8"), np.array([base] * 64, "u8").view("i8"))
            assert near.tolist() == [wide <= 3] * 64
        values = np.array([base, *(base ^ 1 << b for b in range(64))], "u8").view("i8")
        links = simhash_cover.near_links(spark.createDataFrame([(int(v),) for v in values], "fp long")).collect()
        assert {int(values[0])} | {r["u"] for r in links} | {r["v"] for r in links} == set(values.tolist())


def test_components_of_the_tables_equal_brute_force(spark):
    import os

    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("the tables are not there")
    table = spark.read.parquet(path)
    want = brute_components([(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()])
    found = simhash_cover.op3_simhash_cover(spark, "/root/testdata/sf0.01")
    assert bag(tuple(r) for r in found.collect()) == bag(want)


def test_cells_tell_no_more_than_a_forest():
    fp = np.array([a | b << 5 for a in range(4) for b in range(64)], "i8")
    u, _ = simhash_cover.cell_links(fp, np.ones(len(fp), bool))
    assert len(u) < len(fp)


def test_components_of_a_long_chain(spark):
    rng = random.Random(4)
    chain = rng.sample(range(1000), 300)
    links = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)), "u long, v long").repartition(7)
    found = {r["u"]: r["v"] for r in components.components(links).collect()}
    assert found == {x: min(chain) for x in chain if x != min(chain)}
    assert components.components(links.where("false")).count() == 0


def test_keep_one_of_each_group(docs, rows):
    found = simhash_cover.keep_one(docs)
    assert found.columns == docs.columns
    heads = {c for _, _, c in brute_components(rows) if c is not None}
    assert bag(r["doc_id"] for r in found.collect()) == bag(heads)
    assert found.exceptAll(docs).count() == 0


def test_fingerprints_of_nothing(none):
    assert simhash_cover.near_components(none).count() == 0 and simhash_cover.keep_one(none).count() == 0


# ---- repeated bytes ------------------------------------------------------------------------------------------------


def brute_bytes(rows):
    n = suffix_dedup.LENGTH
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    first = {}
    for r in order:
        b = (r[1] or "").encode()
        for p in range(len(b) - n + 1):
            first.setdefault(b[p : p + n], r[0])
    out = []
    for r in rows:
        b = (r[1] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - n + 1):
            owner = first[b[p : p + n]]
            if owner is not None and (r[0] is None or owner < r[0]):
                gone[p : p + n] = b"\1" * n
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((r[0], len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def test_bytes_equal_brute_force(docs, rows):
    found = suffix_dedup.dedup_bytes(docs)
    assert bag(tuple(r)[:5] for r in found.collect()) == bag(brute_bytes(rows))
    assert all(sha(bytes(r["kept"])) == r["kept_sha256"] for r in found.collect())


def test_bytes_of_planted_passages(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 3000)  # many blocks
    rng = random.Random(5)
    passages = [words(100 + i, 12)[: rng.randint(45, 90)] for i in range(6)]
    made = []
    for i in range(60):
        parts = [words(1000 + i * 7 + j, rng.randint(1, 9)) for j in range(5)]
        made.append(document(i, "é ".join(x for p in parts for x in (p, rng.choice(passages)))))
    found = suffix_dedup.dedup_bytes(spark.createDataFrame(made, SCHEMA).repartition(5), keep_bytes=False)
    assert bag(tuple(r) for r in found.collect()) == bag(brute_bytes(made))


@pytest.mark.parametrize("memory", [60, 400, 4000])
def test_bytes_of_shards_larger_than_memory(monkeypatch, memory):
    """A hot passage with edges of its own in every document, in one shard that is cut by anchors, then by windows."""
    rng = random.Random(memory)
    hot, warm = words(50, 20), [words(60 + i, 9) for i in range(4)]
    made = [document(i, words(2000 + i, 3) + hot + words(3000 + i, 3) + rng.choice(warm) + (words(70, 12) if i % 3 else "")) for i in range(50)]
    records = suffix_dedup.Spool()
    cuts = []
    cut = suffix_dedup._cut_shard
    monkeypatch.setattr(suffix_dedup, "_cut_shard", lambda r, n, level: cuts.append(level) or cut(r, n, level))
    blocks = {}
    for number in range(10):
        own = made[5 * number : 5 * number + 5]
        raw, sizes = b"".join(r[1].encode() for r in own), np.array([len(r[1].encode()) for r in own])
        doc, place, count, _ = suffix_dedup.windows(np.frombuffer(raw, "u1"), sizes)
        base, names = (np.cumsum(sizes) - sizes)[doc], {}
        which = np.array([names.setdefault(raw[p : p + n + suffix_dedup.LENGTH - 1], len(names)) for p, n in zip(place.tolist(), count.tolist(), strict=True)])
        ids = np.array([r[0] for r in own])
        records.add(number, suffix_dedup._told(which, doc, place - base, ids[doc], list(names)))
        blocks[number] = (np.frombuffer(raw, "u1"), sizes, [])
    for number, body in suffix_dedup.shard_spans(records, memory):
        blocks[number][2].append(body)
    lost = []
    for text, sizes, told in blocks.values():
        gone = suffix_dedup.removed(text, sizes, told)
        lost += [int(x.sum()) for x in np.split(gone, np.cumsum(sizes)[:-1])]
    assert lost == [n for _, _, n, _, _ in brute_bytes(made)] and sum(lost) > 3000
    assert {1, 2} <= set(cuts) if memory < 4000 else 1 in cuts


def test_memory_does_not_follow_the_shard():
    import tracemalloc

    peaks = []
    for n in (4, 16):
        records = suffix_dedup.Spool()
        for number in range(n):
            own = [words(1000 * number + i, 40).encode() for i in range(300)]
            own += own[:30]
            names = list(dict.fromkeys(own))
            which = np.array([names.index(x) for x in own])
            records.add(number, suffix_dedup._told(which, np.arange(len(own)), np.zeros(len(own), "i8"), np.arange(len(own)) + 10_000 * number, names))
        size = sum(len(raw) for _, (*_, raw) in records)
        tracemalloc.start()
        found = sum(1 for _ in suffix_dedup.shard_spans(records, 40_000))
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert found and size > n * 40_000
    assert peaks[1] < 1.5 * peaks[0]  # four times the shard, at a limit that is a small part of it


def shard_of(made, per):
    """The records of one shard that holds all anchors, ``per`` documents a block, and the blocks' texts."""
    records, blocks = suffix_dedup.Spool(), []
    for number in range(0, len(made), per):
        own = made[number : number + per]
        raw, sizes = b"".join(r[1].encode() for r in own), np.array([len(r[1].encode()) for r in own])
        doc, place, count, _ = suffix_dedup.windows(np.frombuffer(raw, "u1"), sizes)
        names = {}
        which = np.array([names.setdefault(raw[p : p + n + suffix_dedup.LENGTH - 1], len(names)) for p, n in zip(place.tolist(), count.tolist(), strict=True)])
        ids = np.array([r[0] for r in own])
        records.add(number // per, suffix_dedup._told(which, doc, place - (np.cumsum(sizes) - sizes)[doc], ids[doc], list(names)))
        blocks.append((np.frombuffer(raw, "u1"), sizes, []))
    return records, blocks


def lost_by(blocks, spans):
    for number, body in spans:
        blocks[number][2].append(body)
    return [int(x.sum()) for text, sizes, told in blocks for x in np.split(suffix_dedup.removed(text, sizes, told), np.cumsum(sizes)[:-1])]


def test_small_records_are_put_together(monkeypatch):
    """Many blocks, each with little for the shard: neither the parts' records nor the spans are blocks times parts."""
    warm = [words(400 + i, 14) for i in range(30)]
    made = [document(i, words(5000 + i, 8) + warm[i % 30] + words(6000 + i, 4)) for i in range(300)]
    records, blocks = shard_of(made, 2)
    added, add = [], suffix_dedup.Spool.add
    monkeypatch.setattr(suffix_dedup.Spool, "add", lambda self, block, body: added.append(len(body)) or add(self, block, body))
    spans = list(suffix_dedup.shard_spans(records, 24_000))
    assert lost_by(blocks, spans) == [n for _, _, n, _, _ in brute_bytes(made)]
    assert 2 < len(added) < 5 * len(blocks) and len(spans) == len({number for number, _ in spans})


def test_hot_anchors_are_cut_by_other_hashes(monkeypatch):
    """A passage too short for a window of its own, in every document: cut apart without writing all its windows."""
    hot = words(51, 30)[:36]
    made = [document(i, words(7000 + i, 8) + hot + words(8000 + i % 40, 8)) for i in range(400)]
    records, blocks = shard_of(made, 20)
    read, written, cut = {}, {}, suffix_dedup._cut_shard

    def told(r, n, level):
        r = list(r)
        parts = cut(r, n, level)
        for size, of in ((read, [r]), (written, parts)):
            size[level] = size.get(level, 0) + sum(len(raw) for part in of for _, (*_, raw) in part)
        return parts

    monkeypatch.setattr(suffix_dedup, "_cut_shard", told)
    assert lost_by(blocks, suffix_dedup.shard_spans(records, 8000)) == [n for _, _, n, _, _ in brute_bytes(made)]
    assert read[2] and written[2] < 4 * read[2]


@pytest.mark.parametrize("memory", [60, 200])
def test_windows_of_the_same_kmers_are_cut(monkeypatch, memory):
    """Windows of one period have all k-mers in common, so that no choice of anchors tells them apart."""
    made = [document(i, ("abcdefghijklm" * 9)[i % 13 :] + words(i, 3)) for i in range(8)]
    records, blocks = shard_of(made, 2)
    levels, cut = [], suffix_dedup._cut_shard
    monkeypatch.setattr(suffix_dedup, "_cut_shard", lambda r, n, level: levels.append(level) or cut(r, n, level))
    assert lost_by(blocks, suffix_dedup.shard_spans(records, memory)) == [n for _, _, n, _, _ in brute_bytes(made)]
    assert max(levels) > suffix_dedup.RECUTS


def test_anchors_spread_evenly():
    text = np.frombuffer(words(13, 60_000).encode(), "u1")
    anchor = np.unique(suffix_dedup.windows(text, np.array([len(text)]))[3])
    share = np.bincount((anchor >> np.uint64(60)).astype("i8"), minlength=16) / len(anchor)
    assert share.max() < 0.08 and share.min() > 0.05


def test_windows_do_not_depend_on_where_they_stand():
    a, b = words(7, 400).encode(), words(8, 100).encode()
    texts = [a, b + a[300:900] + b, a[10:]]
    text, sizes = np.frombuffer(b"".join(texts), "u1"), np.array([len(t) for t in texts])
    anchor = {}
    for d, p, n, h in zip(*(x.tolist() for x in suffix_dedup.windows(text, sizes)), strict=True):
        for q in range(p, p + n):
            window = bytes(text[q : q + suffix_dedup.LENGTH])
            assert anchor.setdefault(window, h) == h and d == np.searchsorted(np.cumsum(sizes), q, "right")
    assert len(anchor) == len({t[i : i + 50] for t in texts for i in range(len(t) - 49)})


def test_segments_do_not_matter(monkeypatch):
    text, sizes = np.frombuffer(words(9, 900).encode(), "u1"), np.array([100, 0, 30, 2000])
    text = text[: sizes.sum()]

    def flat():
        return sorted((d, q, h) for d, p, n, h in zip(*(x.tolist() for x in suffix_dedup.windows(text, sizes)), strict=True) for q in range(p, p + n))

    whole = flat()
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 64)
    assert flat() == whole


def test_bytes_of_nothing(none):
    assert suffix_dedup.dedup_bytes(none).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=0, max_size=25).map(lambda b: bytes(1 + x % 3 for x in b)), min_size=1, max_size=8), st.sampled_from([0, 4, 1 << 20]), st.sampled_from([8, 1 << 20]))
def test_suffixes_are_sorted_with_their_common_prefixes(texts, base, memory):
    raw = b"".join(t + b"\0" for t in texts)
    parts = list(induced_sort.suffix_order(np.frombuffer(raw, "u1"), 300, base, memory))
    order = np.concatenate([x for x, _ in parts[::-1]]).tolist()

    def key(i):
        end = raw.index(b"\0", i)
        return raw[i : end + 1], end

    assert order == sorted(range(len(raw)), key=key)
    for at, common in parts:
        for a, b, n in zip(at.tolist(), at[1:].tolist(), common[1:].tolist(), strict=False):
            x, y = key(a)[0][:-1], key(b)[0][:-1]
            assert n == next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


def edited(text: str, every: int) -> str:
    return " ".join("edited" + w if i % every == every // 2 else w for i, w in enumerate(text.split()))


@pytest.mark.parametrize("cell", [3, 256])
def test_jaccard_links_equal_brute_force(spark, docs, rows, cell):
    from loomlake.llm import jaccard_links as jl

    found = [(r[0], r[1]) for r in rows] + [(1000 + 10 * i + k, edited(words(500 + i, 400), every)) for i in range(6) for k, every in enumerate((1000, 300, 90, 60, 45, 30))]
    table = spark.createDataFrame(found, "doc_id long, text string").repartition(4)
    sets = {}
    for _, text in found:
        s = jl.shingle_set(text or "")
        if len(s):
            sets[jl.set_key(s)] = set(s.tolist())
    keys = sorted(sets)
    root = {k: k for k in keys}
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {k: new if r == old else r for k, r in root.items()}
    links = [(r["u"], r["v"]) for r in jl.jaccard_links(table, jl.signed(table).cache(), cell).collect()]
    mine = {k: k for k in keys}
    for u, v in links:
        assert len(sets[u] & sets[v]) >= 0.8 * len(sets[u] | sets[v])
        old, new = max(mine[u], mine[v]), min(mine[u], mine[v])
        mine = {k: new if r == old else r for k, r in mine.items()}
    assert mine == root and sum(k != r for k, r in root.items()) >= 12
