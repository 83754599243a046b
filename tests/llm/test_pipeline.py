"""Each stage of the pipeline on its own input against brute force, on made rows and on the smallest tables."""

import os

import numpy as np
import pytest
from conftest import SCHEMA, bag, document, words
from pyspark.sql import functions as F
from test_classifiers import brute_odds, brute_views, made
from test_dedup import brute_components, brute_lines, edited
from test_others import brute_mix

import corpus_pipeline as pipeline
from loomlake.llm import _shared, budget_mix, cotrain, jaccard_links

DATA = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Labels of made documents, some of them null, repeated or of no document."""
    place = tmp_path_factory.mktemp("tables")
    base = made(200, 11)
    labels = [(1000 + i, int(not j), int(x), "clash") for i, _, j, x in base] + [(1003, None, None, "n"), (1004, 0, 0, "again"), (None, 1, 1, "n"), (999_999, 1, 0, "none")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string").write.parquet(str(place / "labels.parquet"))
    return str(place), [document(1000 + i, t) for i, t, _, _ in base]


@pytest.fixture(scope="module")
def hostile(spark, rows, folder):
    """The odd rows of all tests, labelled ones, edited copies."""
    copies = [document(2000 + 10 * i + k, t if not k else edited(t, 60)) for i in range(6) for t in [words(900 + i, 500)] for k in (0, 1)]
    found = [*rows, *folder[1], *copies]
    return spark.createDataFrame(found, SCHEMA).repartition(3).cache(), found


def texts(found):
    return bag((r["doc_id"], r["text"], r["lang"], r["source"], r["row"]) for r in found.collect())


def test_quality_equals_brute_force(spark, hostile, folder):
    docs, found = hostile
    out = pipeline.quality(spark, docs, folder[0])
    assert out.columns == docs.columns
    model = cotrain.fit(docs, spark.read.parquet(f"{folder[0]}/labels.parquet"))

    def score(r):
        a, b = brute_odds(model, brute_views(r[1], r[2], r[3], r[4]))
        return 1 / (1 + np.exp(-(a * model.combine[0] + b * model.combine[1] + model.combine[2])))

    want = [r for r in found if score(r) >= cotrain.KEEP]
    assert texts(out) == bag((r[0], r[1], r[2], r[3], r[7]) for r in want) and len(want) < len(found)


def test_lines_equal_brute_force(spark, hostile):
    docs, found = hostile
    out = pipeline.lines(spark, docs, "")
    assert out.columns == docs.columns
    told = out.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256)).collect()
    assert bag(map(tuple, told)) == bag((i, sha) for i, _, _, sha in brute_lines(found, 10))
    assert out.where("n_chars is distinct from char_length(text)").count() == 0


def brute_near(found):
    """Doc ids that stay: the least of each group by fingerprints, then of each group by whole sets of shingles."""
    kept, seen = [], set()
    for r, (_, _, head) in zip(found, brute_components(found), strict=True):
        if head is None or r[0] == head and head not in seen:
            seen.add(head)
            kept.append(r)
    sets = [set(jaccard_links.shingle_set(r[1] or "").tolist()) for r in kept]
    root = list(range(len(kept)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if x == old else x for x in root]
    heads = {}
    for i, r in enumerate(kept):
        if sets[i]:
            heads[root[i]] = min(heads.get(root[i], (True, 0)), (r[0] is None, r[0] or 0))
    return [r for i, r in enumerate(kept) if not sets[i] or (r[0] is None, r[0] or 0) == heads[root[i]]]


def test_near_duplicates_equal_brute_force(spark, hostile):
    docs, found = hostile
    out = pipeline.near_duplicates(spark, docs, "")
    want = brute_near(found)
    assert out.columns == docs.columns and bag(r["doc_id"] for r in out.collect()) == bag(r[0] for r in want)
    ids = {r[0] for r in want}
    assert {2000 + 10 * i for i in range(6)} <= ids and not {2001 + 10 * i for i in range(6)} & ids
    assert out.exceptAll(docs).count() == 0


def test_mixture_equals_brute_force(spark, hostile):
    docs, found = hostile
    out = pipeline.mixture(spark, docs, "")
    assert out.columns == docs.columns
    taken = [r for r, _, epochs in brute_mix(spark, docs, budget_mix.TAKE, 1) if epochs]
    assert bag(r["doc_id"] for r in out.collect()) == bag(r["doc_id"] for r in taken) and len(taken) < len(found)
    assert out.exceptAll(docs).count() == 0


def test_encoding_equals_the_library(spark, hostile):
    import base64

    import public_tokenizers
    import tiktoken

    docs, found = hostile
    body = open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read()
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, body.splitlines())}, special_tokens={})
    out = pipeline.encoding(spark, docs, "")
    assert bag((r["doc_id"], list(r["token_ids"])) for r in out.collect()) == bag((r[0], bpe.encode_ordinary(r[1] or "")) for r in found)
    assert out.where("not round_trip").count() == 0


def test_stages_of_nothing(spark, none, folder):
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, folder[0]).count() == 0


def test_run_over_odd_rows_leaves_one_table(spark, hostile, folder):
    docs, found = hostile
    docs.write.mode("overwrite").parquet(f"{folder[0]}/documents.parquet")
    before = set(os.listdir(_shared.shared_path(spark).removeprefix("file:")))
    out = pipeline.run(spark, folder[0])
    (place,) = [x for x in set(os.listdir(_shared.shared_path(spark).removeprefix("file:"))) - before if x.startswith("pipeline-")]
    assert os.listdir(os.path.join(_shared.shared_path(spark).removeprefix("file:"), place)) == [str(len(pipeline.STAGES) - 2)]
    assert 0 < out.count() < len(found) and out.where("not round_trip").count() == 0


@tables
def test_stages_of_the_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    for n, (_, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
        now = {r["doc_id"]: r for r in docs.collect()}
        assert len(now) == docs.count() and now.keys() <= before.keys() and now
        if n < 4:
            assert docs.columns == columns
        if n == 0:
            good = [i for i in before if labels.get(i) == 1]
            assert sum(i in now for i in good) >= 0.97 * len(good) and len(now) < len(before)
        if n == 1:
            want = {i: sha for i, _, _, sha in brute_lines([(r["doc_id"], r["text"]) for r in before.values()], 10)}
            assert {r["doc_id"]: r["s"] for r in docs.select("doc_id", F.sha2("text", 256).alias("s")).collect()} == want
        if n == 2:
            assert sorted(now) == sorted(r[0] for r in brute_near([(r["doc_id"], r["text"]) for r in before.values()]))
        if n == 3:
            assert all(now[i] == before[i] for i in now)
        if n == 4:
            assert docs.where("not round_trip").count() == 0 and now.keys() == before.keys()
        before = now
