import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from conftest import SCHEMA, bag, document, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomlake.llm import budget_mix, byte_bpe, mtree, shard_flow

# ---- resharding -----------------------------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 50), min_size=1, max_size=7), st.integers(1, 9), st.integers(0, 3))
def test_transfers_move_the_fewest_bytes(old, n, slack):
    new = shard_flow._even(sum(old), n)
    new[-1] += slack
    moved = shard_flow.transfers(old, new)
    for i, size in enumerate(old):
        assert sum(v for (a, _), v in moved.items() if a == i) == size
    for j, room in enumerate(new):
        assert sum(v for (_, b), v in moved.items() if b == j) <= room
    least = sum(max(0, size - (new[i] if i < n else 0)) for i, size in enumerate(old))
    assert sum(v for (a, b), v in moved.items() if a != b) == least


def test_too_little_room():
    with pytest.raises(ValueError):
        shard_flow.transfers([5], [4])


def test_flow_prefers_the_cheap_way():
    net = shard_flow.Flow(4)
    cheap, dear = net.arc(0, 1, 3, 1), net.arc(0, 2, 9, 5)
    net.arc(1, 3, 9, 0)
    net.arc(2, 3, 4, 0)
    assert net.run(0, 3) == 3 * 1 + 4 * 5 and (net.flow_on(cheap), net.flow_on(dear)) == (3, 4)


def test_shards_are_whole_even_and_gapless(docs, rows):
    found = shard_flow.assign(docs, shard_flow.hash_shard(4), 6).collect()
    want = [(r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows]
    assert bag((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == bag(want)
    for j in range(6):
        own = sorted(r["slot"] for r in found if r["shard"] == j)
        assert own == list(range(len(own)))


def test_shards_of_many_rows_are_near_equal(spark):
    rng = random.Random(1)
    made = spark.createDataFrame([document(i, "x" * rng.randint(0, 400)) for i in range(3000)], SCHEMA)
    found = shard_flow.assign(made, shard_flow.hash_shard(16))
    sums = [r["b"] for r in found.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    total = sum(sums)
    moved = found.where("shard <> old_shard").agg(F.sum("size")).first()[0]
    assert len(sums) == 24 and max(sums) - min(sums) < 0.02 * total / 24 + 400 and moved < 0.36 * total


def test_shards_of_repeated_rows_are_near_equal(spark):
    same = spark.range(2000).selectExpr("cast(null as long) as doc_id", "'again' as text")
    made = same.union(spark.range(2000).selectExpr("id", "concat('x', id)"))
    found = shard_flow.assign(made, shard_flow.hash_shard(16)).collect()
    load = {}
    for r in found:
        load.setdefault(r["shard"], []).append(r)
    sums = [sum(r["size"] for r in own) for own in load.values()]
    assert len(found) == 4000 and len(sums) == 24 and max(sums) - min(sums) < 0.05 * sum(sums) / 24
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in load.values())


def test_copies_beyond_the_lots(spark, monkeypatch):
    monkeypatch.setattr(shard_flow, "LOTS", 7)
    made = spark.range(1000).selectExpr("1L as doc_id", "'again' as text").union(spark.range(3).selectExpr("id", "'b'"))
    found = shard_flow.assign(made, F.lit(0), 3).collect()
    own = {j: sorted(r["slot"] for r in found if r["shard"] == j) for j in range(3)}
    assert len(found) == 1003 and all(s == list(range(len(s))) for s in own.values()) and len(own[0]) < 1000


@pytest.mark.parametrize("old_shards,new_shards", [(4, 6), (6, 4), (1, 3)])
def test_placement_moves_the_fewest_bytes_but_for_a_block_a_shard(spark, old_shards, new_shards):
    rng = random.Random(old_shards)
    blocks = {(i, b): (rng.randint(50, 150), 1) for i in range(old_shards) for b in range(60)}
    old = [sum(n for (i, _), (n, _) in blocks.items() if i == k) for k in range(old_shards)]
    new = shard_flow._even(sum(old), new_shards)
    placed = shard_flow.place_blocks(blocks, new)
    moved = sum(n for (i, b), (n, _) in blocks.items() if placed[i, b] != i)
    least = sum(max(0, n - (new[i] if i < new_shards else 0)) for i, n in enumerate(old))  # by counting, no flow
    load = [sum(n for key, (n, _) in blocks.items() if placed[key] == j) for j in range(new_shards)]
    assert max(load) - min(load) <= 150 and moved <= least + 150 * max(old_shards, new_shards)


def test_weights(spark):
    made = spark.createDataFrame([document(i, "x" * 92) for i in range(1000)], SCHEMA)
    found = shard_flow.assign(made, shard_flow.hash_shard(2), 3, [2, 1, 1])
    sums = {r["shard"]: r["count"] for r in found.groupBy("shard").count().collect()}
    assert abs(sums[0] - 500) < 10 and abs(sums[1] - 250) < 10


def test_only_affected_files_are_written(spark, tmp_path):
    made = spark.createDataFrame([(i, "x" * 100, i % 4, "e") for i in range(400)] + [(1, "x" * 100, 1, "e"), (None, None, 2, "e")], "doc_id long, text string, shard int, extra string")
    made.write.partitionBy("shard").parquet(str(tmp_path / "old"))
    told = {r["shard"]: r for r in shard_flow.reshard_files(spark, str(tmp_path / "old"), str(tmp_path / "new"), 5, [10800, 10908, 10808, 5400, 5400]).collect()}
    kept = [j for j, r in told.items() if r["action"] == "kept"]
    new = spark.read.parquet(str(tmp_path / "new"))
    assert not new.where(F.col("shard").isin(kept)).count() and new.columns[-1] == "shard"
    with pytest.raises(ValueError):
        shard_flow.reshard_files(spark, str(tmp_path / "old"), str(tmp_path / "old/new"), 4)
    assert sorted(kept) == [0, 1, 2] and new.groupBy("shard").agg(F.count("*").alias("n"), F.countDistinct("slot").alias("d"), F.max("slot").alias("m")).where("n <> d or m <> n - 1").count() == 0
    whole = new.select("doc_id", "text", "extra").unionByName(made.where(F.col("shard").isin(kept)).select("doc_id", "text", "extra"))
    assert whole.exceptAll(made.select("doc_id", "text", "extra")).count() == 0 and whole.count() == 402


def test_copies_are_written_as_often_as_they_were(spark, tmp_path):
    made = spark.range(500).selectExpr("cast(null as long) as doc_id", "'same' as text", "'e' as file", "cast(0 as int) as shard")
    made = made.union(spark.range(300).selectExpr("id", "concat('t', id)", "'f'", "cast(1 + id % 2 as int)"))
    made.write.partitionBy("shard").parquet(str(tmp_path / "old"))
    told = shard_flow.reshard_files(spark, str(tmp_path / "old"), str(tmp_path / "new"), 5).collect()
    new = spark.read.parquet(str(tmp_path / "new")).select("doc_id", "text", "file")
    assert {r["action"] for r in told} == {"written"} and len(told) == 5
    assert new.count() == 800 and new.exceptAll(made.select("doc_id", "text", "file")).count() == 0


def test_shards_of_nothing(none):
    assert shard_flow.assign(none, shard_flow.hash_shard(4)).count() == 0


# ---- mixing ----------------------------------------------------------------------------------------------------------


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 300), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 60)), min_size=1, max_size=6))
def test_shares_are_whole_and_fit(total, children):
    weights, rooms = zip(*children, strict=True)
    given_ = budget_mix.share_out(total, list(weights), list(rooms))
    assert sum(given_) == min(total, sum(rooms)) and all(0 <= g <= r for g, r in zip(given_, rooms, strict=True))


def test_siblings_come_before_ancestors():
    leaf = lambda w, n: budget_mix.Node(w, n)
    a = budget_mix.Node(1, 0, {"x": leaf(1, 10), "y": leaf(1, 1000)})
    b = budget_mix.Node(1, 0, {"z": leaf(1, 1000)})
    root = budget_mix.Node(1, 0, {"a": a, "b": b})
    budget_mix.budget(root, 400)
    assert [n.budget for n in (a.children["x"], a.children["y"], b.children["z"])] == [10, 190, 200]
    a.children["y"].supply = 50
    budget_mix.budget(root, 400)
    assert [n.budget for n in (a.children["x"], a.children["y"], b.children["z"])] == [10, 50, 340]


def brute_budgets(weight, rooms, total):
    """Exact shares by halving: the level at which each child gets min(its room, level x weight), then whole numbers."""
    total = min(total, sum(rooms))
    given, open_ = [0] * len(rooms), [i for i, r in enumerate(rooms) if r]
    while open_:
        left = Fraction(total - sum(given))
        whole = sum(weight[i] for i in open_)
        part = {i: left * weight[i] / whole for i in open_}
        full = [i for i in open_ if part[i] >= rooms[i]]
        if not full:
            floors = {i: int(part[i]) for i in open_}
            rest = total - sum(given) - sum(floors.values())
            for i in sorted(open_, key=lambda i: (floors[i] - part[i], i))[: int(rest)]:
                floors[i] += 1
            for i in open_:
                given[i] = floors[i]
            break
        for i in full:
            given[i] = rooms[i]
        open_ = [i for i in open_ if i not in full]
    return given


def brute_mix(spark, docs, take, epochs, seed=20):
    """[(row, tokens taken, times taken)] by the definition: budgets by exact fractions, one sorted list a leaf."""
    name = lambda c: F.coalesce(F.col(c), F.lit("null"))
    keyed = docs.select("doc_id", "text", name("lang").alias("lang"), name("source").alias("source"), F.xxhash64("text").alias("text_key")).withColumn("domain", budget_mix.domain_of(F.col("source")))
    for e in range(epochs):
        keyed = keyed.withColumn(f"order{e}", F.xxhash64(F.lit(seed), F.lit(e), "source", "doc_id", "text_key"))
    rows = [r.asDict() | {"n_tokens": len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))} for r in keyed.collect()]
    tree = {}
    for r in rows:
        tree.setdefault(r["domain"], {}).setdefault(r["lang"], {}).setdefault(r["source"], []).append(r)
    supply = lambda node: sum(map(supply, node.values())) if isinstance(node, dict) else epochs * sum(r["n_tokens"] for r in node)
    weights = (budget_mix.DOMAIN_WEIGHTS, budget_mix.LANGUAGE_WEIGHTS, {})
    out = []

    def share(node, level, total):
        if isinstance(node, list):
            left, got = total, {id(r): [r, 0, 0] for r in node}
            for e in range(epochs):
                for r in sorted(node, key=lambda r: (r[f"order{e}"] % (1 << 64), r["doc_id"] or 0, r["text_key"])):
                    got[id(r)][1] += min(max(left, 0), r["n_tokens"])
                    got[id(r)][2] += left > 0
                    left -= r["n_tokens"]
            out.extend(map(tuple, got.values()))
            return
        names = sorted(node)
        parts = brute_budgets([Fraction(weights[level].get(n, budget_mix.DEFAULT)) for n in names], [supply(node[n]) for n in names], total)
        for n, part in zip(names, parts, strict=True):
            share(node[n], level + 1, part)

    share(tree, 0, int(take * sum(r["n_tokens"] for r in rows)))
    return out


@pytest.mark.parametrize("size", [3, 2048])
@pytest.mark.parametrize("take,epochs", [(0.3, 1), (0.7, 2), (1.6, 2)])
def test_mix_equals_brute_force(spark, docs, monkeypatch, take, epochs, size):
    monkeypatch.setattr(budget_mix, "SLICE", size)
    found = budget_mix.select(docs, take, epochs).collect()
    told = bag((r["doc_id"], r["n_tokens"], r["epochs"], r["tokens_taken"]) for r in found)
    assert told == bag((r["doc_id"], r["n_tokens"], times, taken) for r, taken, times in brute_mix(spark, docs, take, epochs))


@pytest.mark.parametrize("take", [0.1, 0.5, 0.9])
def test_mixed_keeps_copies_by_count(spark, take):
    rows = [document(1, "same " * 10, "en", "s")] * 50 + [document(i, f"t{i} " * 10, "en", "s") for i in range(2, 52)] + [document(1, "same " * 10, None, "s")] * 20
    rows += [document(None, None)] * 5 + [(1, "same " * 10, "en", "s", 7, *rows[0][5:])] * 4
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = budget_mix.mixed(docs, take)
    taken = [r for r, _, times in brute_mix(spark, docs, take, 1) if times]
    assert bag((r["doc_id"], r["text"], r["lang"] or "null") for r in out.collect()) == bag((r["doc_id"], r["text"], r["lang"]) for r in taken)
    assert out.exceptAll(docs).count() == 0


def test_mix_takes_what_was_asked_for(docs, rows):
    found = budget_mix.select(docs, 0.5, 2)
    assert found.count() == len(rows)
    told = found.agg(F.sum("tokens_taken").alias("t"), F.sum("n_tokens").alias("n")).first()
    assert told["t"] == int(0.5 * told["n"])
    assert found.where("tokens_taken > n_tokens * epochs or (epochs = 0 and tokens_taken > 0)").count() == 0


def test_mixed_keeps_columns(docs, none):
    found = budget_mix.mixed(docs, 0.5)
    assert found.columns == docs.columns and 0 < found.count() < docs.count() and found.exceptAll(docs).count() == 0
    assert budget_mix.mixed(none).count() == 0 and budget_mix.select(none).count() == 0


# ---- byte-level BPE ---------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def reference():
    import base64

    import public_tokenizers as P
    import tiktoken

    body = open(P.path(byte_bpe.VOCABULARY), "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, body.splitlines())}
    return byte_bpe.ByteBpe(body, P.PATTERN), tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.characters(exclude_categories=["Cs", "Cn", "Co"]), max_size=60))
def test_any_text_encodes_as_the_reference_library(reference, text):
    mine, theirs = reference
    ids = mine.encode(text)
    assert ids == theirs.encode_ordinary(text) and mine.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["", " ", "  a", "a" * 3000, "it's <unk> ▁x <0x41>", "\x00\x1c\x1d\x85  　x", "12345 67", "\r\n\t mixed\n"])
def test_odd_texts_encode_as_the_reference_library(reference, text):
    assert reference[0].encode(text) == reference[1].encode_ordinary(text)


def test_forgetting_changes_nothing(reference, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 5)
    for i in range(20):
        text = words(i, 20)
        assert reference[0].encode(text) == reference[1].encode_ordinary(text)


def test_digests(docs, rows, reference):
    want = []
    for r in rows:
        ids = reference[1].encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert bag(tuple(r) for r in byte_bpe.digests(docs).collect()) == bag(want)


def test_encoded_keeps_other_columns(docs, none, reference):
    found = byte_bpe.encoded(docs)
    assert found.columns == [c for c in docs.columns if c != "text"] + ["token_ids", "n_tokens", "round_trip"]
    assert found.where("not round_trip or n_tokens <> size(token_ids)").count() == 0
    row = found.where("doc_id = 5").first()
    assert row["token_ids"] == reference[1].encode_ordinary(docs.where("doc_id = 5").first()["text"])
    assert byte_bpe.encoded(none).count() == 0 and byte_bpe.digests(none).count() == 0


def test_broken_vocabularies_are_refused():
    with pytest.raises(ValueError):
        byte_bpe.read_ranks(b"YQ== 0\n")


# ---- top-k --------------------------------------------------------------------------------------------------------------


def brute_top(vectors: dict[int, np.ndarray], asked: list[int], k: int):
    return {q: sorted(((int(v @ vectors[q]), i) for i, v in vectors.items() if i != q), key=lambda x: (-x[0], x[1]))[:k] for q in asked}


@pytest.mark.parametrize("kind", ["random", "clustered", "ties"])
def test_tree_search_is_exact(kind):
    rng = np.random.default_rng(6)
    if kind == "random":
        x = rng.integers(-1000, 1000, (900, 8))
    elif kind == "clustered":
        x = rng.integers(-3, 3, (900, 8)) + np.repeat(rng.integers(-900, 900, (9, 8)), 100, axis=0)
    else:
        x = np.repeat(rng.integers(-2, 3, (30, 8)), 30, axis=0)
    ids = rng.permutation(5000)[:900]
    tree = mtree.MTree(x.astype("f8"), ids, page=16)
    vectors = dict(zip(ids.tolist(), x, strict=True))
    want = brute_top(vectors, ids[::40].tolist(), 10)
    for q in want:
        assert tree.search(vectors[q].astype("f8"), q) == want[q]
        assert tree.search(vectors[q].astype("f8"), q, least=want[q][-1][0] - 0.5) == want[q]
    if kind == "clustered":
        assert tree.computed < 0.7 * len(want) * len(ids)


def test_top_k_over_partitions_and_blocks(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=6).astype("f4").tolist(), 1, "e") for i in range(400)]
    rows += [(400, None, 1, "e"), (500, [None, *[0.1] * 5], 1, "e"), (600, [float("nan")] * 6, 1, "e"), (None, [0.1] * 6, 1, "e"), (700, [1.0], 1, "e"), (800, [], 1, "e"), (41, rows[41][1], 1, "e")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x string").repartition(5)
    found = {}
    for r in mtree.top_k(table, page=8, tree_bytes=40 * 48, cell_rows=90).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    vectors = {i: np.floor(1024 * np.array(v, "f8")).astype("i8") for i, v, _, _ in rows[:400]}
    for q in (0, 100, 200, 300):
        pairs = [(int(v @ vectors[q]), i) for i, v in vectors.items() if i != q] + [(int(vectors[41] @ vectors[q]), 41)]
        assert found[q] == sorted(pairs, key=lambda x: (-x[0], x[1]))[:10]
    assert set(found) == {0, 100, 200, 300}


def brute_rows(rows, k=10, every=100):
    """{(id, vector): [(score, id)]} by Python's integers."""
    whole = [(i, tuple(int(np.floor(1024 * float(np.float32(c)))) for c in v)) for i, v in rows]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    return {(i, v): sorted(((dot(v, w), j) for j, w in whole if j != i), key=lambda x: (-x[0], x[1]))[:k] for i, v in whole if i % every == 0}


def test_top_k_of_repeated_ids_and_large_components(spark):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=3).astype("f4").tolist()) for i in range(1, 60)]
    rows += [(0, [1.0, 0.0, 0.0]), (0, [0.0, -1.0, 0.0]), (0, [0.0, -1.0, 0.0]), (100, [5e6, 4e6, 1.0]), (200, [-3e38, 3e38, 0.0]), (201, [3e38, 3e38, 1.0]), (202, [4e6, 5e6, 0.0])]
    rows += [(7, rows[7][1])] * 40 + [(203, [2.0, 2.0, 2.0])] * 30
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    found = {}
    for r in mtree.top_k(table, page=4, tree_bytes=24 * 20, cell_rows=10).orderBy("query_id", "nth", "rank").collect():
        found.setdefault((r["query_id"], r["nth"]), []).append((r["score"], r["vec_id"]))
    clip = lambda s: max(-mtree.TOP, min(mtree.TOP, s))
    want = brute_rows(rows)
    assert {q for q, _ in found} == {0, 100, 200} and len(found) == len(want) == 4
    for i in (0, 100, 200):
        mine = sorted(v for (q, _), v in found.items() if q == i)
        assert mine == sorted([(clip(s), j) for s, j in v] for (q, _), v in want.items() if q == i)


def test_vectors_travel_once_and_bounds_prune(spark):
    rng = np.random.default_rng(10)
    centres = 30 * rng.normal(size=(12, 8))
    rows = [(i, (centres[i % 12] + 0.01 * rng.normal(size=8)).astype("f4").tolist()) for i in range(2400)]
    plain = [(i, v) for i, v in rows]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = {}
    for r in mtree.top_k(table, cell_rows=100).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    assert found == {i: v for (i, _), v in brute_rows(plain).items()}
    x = np.floor(1024 * np.array([v for _, v in rows], "f8"))
    pivots, radii = x[:12], {c: 2000.0 for c in range(12)}
    asked = pa.record_batch([pa.array([0], pa.int64()), pa.array([1], pa.int64()), pa.array([x[0].tobytes()], pa.binary()), pa.array([False])], names=["vec_id", "nth", "x", "wide"])
    (out,) = mtree._reach(pivots, radii, x[:600], np.arange(600), 10)(iter([asked]))
    assert 0 < len(out.column("cells")[0]) < 6


def test_top_k_of_few_and_of_nothing(spark):
    schema = "vec_id long, embedding array<float>"
    assert mtree.top_k(spark.createDataFrame([], schema)).count() == 0
    few = mtree.top_k(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [0.5, 0.0])], schema)).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in few] == [(0, 1, 1, 512 * 1024), (0, 2, 2, 512 * 1024)]
    assert mtree.top_k(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
