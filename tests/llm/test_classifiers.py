import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SCHEMA, document, words
from pyspark.sql import functions as F

from loomlake.llm import cotrain, crf_toxicity, fertility

LABELS = "doc_id long, quality int, toxic int, text string"


def made(n: int, seed: int = 1):
    """Documents of which a fifth are junk and a fifth have words that only toxic ones have."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = ". ".join(words(seed * 100_000 + i * 10 + j, rng.randint(4, 14)) for j in range(6))
        junk, toxic = i % 5 == 0, i % 5 == 1
        if junk:
            text = " ".join(w + rng.choice(["%%%", "&&&", "***"]) for w in text.split())
        if toxic:
            w = text.split()
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["zzbad", "qqworse"]))
            text = " ".join(w)
        out.append((i, text, junk, toxic))
    return out


@pytest.fixture(scope="module")
def corpus(spark):
    base = made(400)
    docs = spark.createDataFrame([document(i, t) for i, t, _, _ in base], SCHEMA)
    labels = spark.createDataFrame([(i, int(not j), int(x), "clash") for i, _, j, x in base] + [(3, None, None, "n"), (None, 1, 1, "n")], LABELS)
    return base, docs, labels


def test_quality_on_rows_not_trained_on(spark, corpus):
    _, docs, labels = corpus
    model = cotrain.fit(docs, labels)
    fresh = made(200, 2)
    found = cotrain.score(spark.createDataFrame([document(i, t) for i, t, _, _ in fresh], SCHEMA), model)
    kept = {r["doc_id"]: r["kept"] for r in found.collect()}
    right = [kept[i] != junk for i, _, junk, _ in fresh]
    assert np.mean(right) > 0.97 and all(kept[i] for i, _, junk, _ in fresh if not junk)


def test_quality_of_odd_rows(docs, none, rows, corpus, spark):
    _, trained, labels = corpus
    model = cotrain.fit(trained, labels)
    found = cotrain.score(docs, model)
    assert found.count() == len(rows) and found.where("score is null or score not between 0 and 1").count() == 0
    kept = cotrain.accepted(docs, model, -1.0)
    assert kept.columns == docs.columns and kept.exceptAll(docs).count() == 0 and kept.count() == len(rows)
    assert cotrain.score(none, model).count() == 0
    assert cotrain.score(docs, cotrain.fit(none, labels)).where("not kept").count() == 0
    assert cotrain.score(docs, cotrain.fit(docs, spark.createDataFrame([], LABELS))).where("score <> 1").count() == 0


def brute_views(text, lang, source, size):
    """What the views see of one document, counted one by one."""
    found, before, slots = (text or "").encode().split(), None, {}
    for w in found:
        own = cotrain.word_slot(w)
        slot = cotrain.REPEAT if own == before else own
        before, slots[slot] = own, slots.get(slot, 0) + 1
    raw = (text or "").encode()
    shares = [min(1.0, 5 * sum(raw.count(c) for c in cls) / max(len(raw), 1)) for cls in cotrain.CLASSES.values()]
    bits = cotrain.SIZES - 1 if size is None or size < 0 else min(size.bit_length(), cotrain.SIZES - 2)
    page = [zlib.crc32(repr(lang).encode()) % cotrain.LANGS, cotrain.LANGS + zlib.crc32(repr(source).encode()) % cotrain.SOURCES, cotrain.LANGS + cotrain.SOURCES + bits]
    return slots, shares, page


def brute_odds(model, views):
    slots, shares, page = views
    n = max(sum(slots.values()), 1)
    mean = sum(k * model.content_ratio[t] for t, k in slots.items()) / n
    telling = sum(k for t, k in slots.items() if model.content_ratio[t] < -1) / n
    content = [mean, telling, slots.get(cotrain.REPEAT, 0) / n, *shares, 1.0]
    return sum(a * b for a, b in zip(content, model.content, strict=True)), sum(model.page_ratio[t] * c for t, c in zip(page, model.page, strict=False)) + model.page[-1]


def told_by(i, junk):
    """Metadata that tells most junk: half of its rows have a source of their own."""
    return ("en", "dump" if junk and i % 2 else f"s{i % 3}", 100 if junk else 5000)


@pytest.fixture(scope="module")
def exchanged(spark):
    base = made(400, 3)
    rows = [(i, t, *told_by(i, j)[:2], told_by(i, j)[2]) for i, t, j, _ in base]
    docs = spark.createDataFrame([*rows, (None, "", None, None, None), (None, None, "xx", "dump", -1)], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    labels = spark.createDataFrame([(i, int(not j)) for i, _, j, _ in base[:200]], "doc_id long, quality int")
    return docs, labels, cotrain.fit(docs, labels), cotrain.fit(docs, labels, 0)


def test_scores_of_both_views_equal_brute_force(spark, exchanged):
    docs, _, model, _ = exchanged
    found = {(r["doc_id"], r["lang"]): r for r in cotrain.score(docs, model).join(docs, "doc_id").collect() if r["doc_id"] is not None}
    for r in found.values():
        a, b = brute_odds(model, brute_views(r["text"], r["lang"], r["source"], r["n_chars"]))
        logistic = lambda v: 1 / (1 + np.exp(-v))
        assert abs(r["content_score"] - logistic(a)) < 1e-9 and abs(r["page_score"] - logistic(b)) < 1e-9
        assert abs(r["score"] - logistic(a * model.combine[0] + b * model.combine[1] + model.combine[2])) < 1e-9
        assert r["kept"] == (r["score"] >= cotrain.KEEP)


def test_views_exchange_what_they_are_sure_of(spark, exchanged):
    docs, labels, model, alone = exchanged
    known = labels.select(F.col("doc_id").alias("id_"))
    tokens, pages = cotrain.exchange_over(cotrain.bags(docs, known))(model)
    want = {0: {}, 1: {}}, {0: {}, 1: {}}
    ids = {r["id_"] for r in known.collect()}
    passed = [0, 0]
    for r in docs.collect():
        if r["doc_id"] in ids:
            continue
        views = brute_views(r["text"], r["lang"], r["source"], r["n_chars"])
        for k, odds in enumerate(reversed(brute_odds(model, views))):
            p = 1 / (1 + np.exp(-odds))
            label = 1 if p >= cotrain.SURE[1] else 0 if 1 - p >= cotrain.SURE[0] else None
            if label is not None:
                passed[k] += 1
                for slot, n in views[0].items() if not k else [(s, 1) for s in views[2]]:
                    want[k][label][slot] = want[k][label].get(slot, 0) + n
    for k, got in enumerate((tokens, pages)):
        for y in (0, 1):
            assert {int(t): int(got[y, t]) for t in np.flatnonzero(got[y])} == want[k][y]
    assert min(passed) > 20  # both ways
    assert not np.allclose(model.content_ratio, alone.content_ratio) and not np.allclose(model.page_ratio, alone.page_ratio)


def test_ratios_bound_what_was_passed_on():
    known, passed = np.array([[6, 2, 5], [1, 7, 0]]), np.array([[0, 100, 1], [300, 100, 0]])
    out = cotrain.ratios(known, passed, [slice(0, 2), slice(2, 3)])
    poor, good = np.array([6, 2 + 100 * 8 / 100]) + 1, np.array([1 + 300 * 8 / 400, 7 + 100 * 8 / 400]) + 1
    assert np.allclose(out[:2], np.log(good / good.sum()) - np.log(poor / poor.sum())) and out[2] == 0


def test_dense_fits_are_the_optimum():
    rng = np.random.default_rng(4)
    x, weight = rng.normal(size=(200, 3)), rng.uniform(0.5, 4, 200)
    y = (x[:, 0] + rng.normal(size=200) > 0).astype(float)
    w = cotrain.fit_dense(x, y, weight, 1e-2)

    def loss(v):
        z = x @ v
        return (weight * (np.logaddexp(0, z) - y * z)).sum() / weight.sum() + 0.005 * v @ v

    assert all(loss(w) < loss(w + d) for d in rng.normal(size=(200, 3)) * 0.01)


def test_rounds_end_when_nothing_changes():
    base = made(120, 5)
    asked = []

    def exchange(model):
        asked.append(model)
        return np.zeros((2, cotrain.WORDS), "i8"), np.zeros((2, cotrain.PAGE), "i8")

    views = cotrain.Bags.of(cotrain.Views(), [t for _, t, _, _ in base], ["en"] * 120, ["s"] * 120, [None] * 120)
    model = cotrain.co_train(views, np.array([int(not j) for _, _, j, _ in base]), np.arange(120) // 5 % 5, np.ones(120), exchange)
    assert len(asked) == 1 and model.prior is None


def test_training_rows_are_one_an_id_and_bounded_by_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * 100, "a") for i in range(50)] + [(3, "aaa", "b"), (3, "zzz", "c"), (7, None, "n"), (8, "y" * 200_000, "long")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 2)) for i in range(50)] + [(9, 0), (None, 1), (4, None)], "doc_id long, quality int")
    rows, totals = crf_toxicity.training_rows(docs, labels, "quality", 1000, 1 << 30, None)
    assert [r["id_"] for r in rows] == list(range(50)) and totals == {0: 25, 1: 25}
    assert rows[3]["text"] == "aaa" and rows[3]["lang"] == "b" and rows[7]["text"] == "" and len(rows[8]["text"]) == 100
    few, _ = crf_toxicity.training_rows(docs, labels, "quality", 10, 1 << 30, None)
    assert [sum(r["y_"] == y for r in few) for y in (0, 1)] == [10, 10]
    small, _ = crf_toxicity.training_rows(docs, labels, "quality", 1000, 450, None)
    assert all(1 <= sum(r["y_"] == y for r in small) <= 7 for y in (0, 1)) and {r["id_"] for r in small} <= set(range(50))
    folded, _ = crf_toxicity.training_rows(docs, labels, "quality", 1000, 1 << 30)
    assert {r["id_"] for r in folded} == {i for i in range(50) if zlib.crc32(str(i).encode()) % 5}


def test_toxicity_on_the_held_out_fold(spark, corpus):
    base, docs, labels = corpus
    found = crf_toxicity.score(docs, crf_toxicity.fit(docs, labels))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    out = found.where(fold == 0).collect()
    truth = {i: x for i, _, _, x in base}
    assert len(out) > 50 and np.mean([(r["score"] >= 0.5) == truth[r["doc_id"]] for r in out]) > 0.97
    texts = {i: t for i, t, _, _ in base}
    for r in out:
        for s in r["spans"]:
            if truth[r["doc_id"]]:
                assert any(w in texts[r["doc_id"]].lower()[s["start"] : s["end"]] for w in ("zzbad", "qqworse"))


def test_toxicity_learns_nothing_from_the_held_out_fold(spark, corpus):
    _, docs, labels = corpus
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    turned = labels.withColumn("toxic", F.when(fold == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = crf_toxicity.fit(docs, labels), crf_toxicity.fit(docs, turned)
    assert np.array_equal(a.here, b.here) and np.array_equal(a.scale, b.scale)


def test_toxicity_of_odd_rows(docs, none, rows, corpus, spark):
    _, trained, labels = corpus
    chain = crf_toxicity.fit(trained, labels)
    found = crf_toxicity.score(docs, chain)
    assert found.count() == len(rows) and found.where("score is null or score not between 0 and 1").count() == 0
    empty = {r["score"] for r in found.where("doc_id in (1, 2, 3)").collect()}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert crf_toxicity.score(none, chain).count() == 0
    assert {r["score"] for r in crf_toxicity.score(docs, crf_toxicity.fit(docs, spark.createDataFrame([], LABELS))).collect()} == {0.0}


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(5)
    for lengths in ([1], [2, 5], [7, 1, 3]):
        emit, move, begin = rng.normal(size=sum(lengths)), rng.normal(size=(2, 2)), 0.3
        starts = np.cumsum(lengths) - lengths
        p, pairs = crf_toxicity.marginals(emit, starts, np.array(lengths), move, begin)
        want, seen = np.zeros(len(emit)), np.zeros((2, 2))
        for s, n in zip(starts, lengths, strict=True):
            weights = {}
            for state in range(1 << n):
                y = [state >> i & 1 for i in range(n)]
                weights[tuple(y)] = np.exp(sum(e for e, v in zip(emit[s : s + n], y, strict=True) if v) + begin * y[0] + sum(move[a, b] for a, b in zip(y, y[1:], strict=False)))
            total = sum(weights.values())
            for y, w in weights.items():
                want[s : s + n] += np.array(y) * w / total
                for a, b in zip(y, y[1:], strict=False):
                    seen[a, b] += w / total
        assert np.allclose(p, want) and np.allclose(pairs, seen)


def test_marginals_do_not_depend_on_the_pieces():
    rng = np.random.default_rng(6)
    lengths = np.array([1, 40, 3, 25, 8, 129])
    emit, move = 3 * rng.normal(size=lengths.sum()), rng.normal(size=(2, 2))
    starts = np.cumsum(lengths) - lengths
    whole, pairs = crf_toxicity.marginals(emit, starts, lengths, move, 0.3, 1000)
    for span in (1, 2, 3, 8, 64, 128):
        p, q = crf_toxicity.marginals(emit, starts, lengths, move, 0.3, span)
        assert np.allclose(p, whole) and np.allclose(q, pairs)


def test_sentences_are_chains_however_long():
    ends = np.array([False] * 200 + [True] + [False] * 3)
    starts, lengths = crf_toxicity.chains(ends, np.array([0] * 150 + [1] * 54))
    assert starts.tolist() == [0, 150, 201] and lengths.tolist() == [150, 50, 3]


def brute_score(chain, text):
    """(score, spans) of a text by a field's weights: one token after the other, logs of sums of products."""
    import re

    found = list(re.finditer(r"\w+|[.!?\n]", text))
    p = [0.0] * len(found)
    i = 0
    while i < len(found):
        j = i
        while j < len(found) and found[j][0] not in ".!?\n":
            j += 1
        words_ = [m[0].lower() for m in found[i:j]]
        slot = [[chain.index.get(f, 0) for f in crf_toxicity.features(w)] for w in words_]
        emit = [chain.bias + sum(chain.here[s] for s in own) + (chain.before[slot[t - 1][0]] if t else 0) + (chain.after[slot[t + 1][0]] if t + 1 < len(slot) else 0) for t, own in enumerate(slot)]
        weight = lambda t, y: emit[t] if y else 0.0  # noqa: E731, B023
        ahead, back = [], [[0.0, 0.0] for _ in words_]
        for t in range(len(words_)):
            if not t:
                ahead.append([weight(0, 0), weight(0, 1) + chain.begin])
            else:
                ahead.append([weight(t, y) + np.logaddexp(ahead[-1][0] + chain.move[0, y], ahead[-1][1] + chain.move[1, y]) for y in (0, 1)])
        for t in range(len(words_) - 2, -1, -1):
            back[t] = [np.logaddexp(chain.move[y, 0] + weight(t + 1, 0) + back[t + 1][0], chain.move[y, 1] + weight(t + 1, 1) + back[t + 1][1]) for y in (0, 1)]
        for t in range(len(words_)):
            p[i + t] = 1 / (1 + np.exp(ahead[t][0] + back[t][0] - ahead[t][1] - back[t][1]))
        i = j + 1
    top = min(max([1e-6, *p]), 1 - 1e-6)
    odds = chain.scale[0] * np.log(top / (1 - top)) + chain.scale[1] * np.log1p(sum(x for x in p if x > 0.5)) + chain.scale[2]
    spans, last = [], -2
    for t, m in enumerate(found):
        if p[t] >= 0.5:
            if t == last + 1:
                spans[-1] = (spans[-1][0], m.end())
            else:
                spans.append((m.start(), m.end()))
            last = t
    return 1 / (1 + np.exp(-odds)), spans


def test_scores_and_spans_equal_brute_force(spark, corpus):
    base, docs, labels = corpus
    chain = crf_toxicity.fit(docs, labels)
    texts = [t for _, t, _, _ in base[:40]] + ["", "İİ zzbad İ. QQworse now", words(5, 300) + " zzbad " + words(6, 200), "zzbad qqworse! \n? ZZBAD", "1 2 3 zz-bad"]
    found = {r["doc_id"]: r for r in crf_toxicity.score(spark.createDataFrame([document(i, t) for i, t in enumerate(texts)], SCHEMA), chain).collect()}
    for i, text in enumerate(texts):
        score, spans = brute_score(chain, text)
        assert abs(found[i]["score"] - score) < 1e-6
        assert [(s["start"], s["end"]) for s in found[i]["spans"]] == spans
    hit = found[41]["spans"]
    assert [texts[41][s["start"] : s["end"]] for s in hit] == ["zzbad", "QQworse"]


def test_words_that_tell_by_recount(corpus):
    base, _, _ = corpus
    toxic, clean = ([[w.lower() for w in x] for x in crf_toxicity.tokens([t for _, t, _, bad in base if bad == y])] for y in (True, False))
    found = {f for f in crf_toxicity.telling_features(toxic, clean) if f.startswith("w=")}
    n, m = len(toxic), len(clean)
    words_ = {w for x in toxic for w in x} - crf_toxicity.ENDS
    want = set()
    for w in words_:
        k, j = sum(w in x for x in toxic), sum(w in x for x in clean)
        often = (k + 0.5) / (n + 1) >= crf_toxicity.TIMES * (j + 0.5) / (m + 1)
        share = (k + j) / (n + m)
        ratio = 2 * (k * np.log(k / (n * share)) + (j * np.log(j / (m * share)) if j else 0))
        if often and ratio >= 2 * np.log(len(words_)) + crf_toxicity.SURE:
            want.add("w=" + w)
    assert found == want == {"w=zzbad", "w=qqworse"}


def test_rows_without_an_id_are_not_held_out(spark, corpus, tmp_path):
    base, docs, labels = corpus
    docs.select("doc_id", "text").union(spark.createDataFrame([(None, "zzbad qqworse")], "doc_id long, text string")).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = crf_toxicity.op10_crf_toxicity(spark, str(tmp_path)).collect()
    (odd,) = [r for r in out if r["doc_id"] is None]
    assert odd["held_out"] is False and odd["predicted"] == 1 and len(out) == len(base) + 1
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out if r["doc_id"] is not None)


# ---- fertility ------------------------------------------------------------------------------------------------------


def brute(text: str):
    import re

    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = {}
    for i in range(len(w) - 7):
        places.setdefault(tuple(w[i : i + 8]), []).append(i)
    again = {j for v in places.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    seen, repeats = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeats += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), repeats, len(again)


def test_base_counts_equal_brute_force(spark, docs, rows):
    loop = document(99, ("one two three four five six seven eight nine " * 4 + "\nsame\nsame\n \n \n") * 3 + "# $")
    both = docs.unionByName(spark.createDataFrame([loop], SCHEMA))
    found = fertility.judge(both).collect()
    want = sorted(str((r[0], *brute(r[1]))) for r in [*rows, loop])
    assert sorted(str(tuple(r)[:6]) for r in found) == want
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_bands_reject_by_language_and_script(spark):
    plain = "the quick brown fox jumps over the lazy dog while the old man reads his paper near the river and the boats go by slowly in the sun"
    noise = " ".join(f"x{i}q#{i * 7919 % 997}zz|" for i in range(40))
    emoji = " ".join(chr(0x1F300 + i) * 3 for i in range(40))
    made_ = spark.createDataFrame([document(1, plain), document(2, noise), document(3, emoji), document(4, plain, None)], SCHEMA)
    found = {r["doc_id"]: r for r in fertility.judge(made_).collect()}
    assert found[1]["kept"] and not found[2]["kept"] and not found[3]["kept"]
    assert found[3]["fallback_share"] > 0.5 and found[4]["band"] == "latin" and found[4]["kept"]


def test_memory_starts_anew_without_other_results(monkeypatch, spark, docs):
    whole = sorted(map(str, fertility.judge(docs).collect()))
    ranks, model = (open(public_tokenizers.path(n), "rb").read() for n in (fertility.VOCABULARY, fertility.PIECES))
    monkeypatch.setattr(fertility, "REMEMBERED", 50)
    small = fertility.Fertility(ranks, public_tokenizers.PATTERN, model)
    texts = [words(i, 30) for i in range(5)]
    one = [fertility.measure(small, [t], ["en"], fertility.BANDS) for t in texts]
    all_ = fertility.measure(fertility.Fertility(ranks, public_tokenizers.PATTERN, model), texts, ["en"] * 5, fertility.BANDS)
    assert [[x[0] for x in o[:9]] for o in one] == [[x[i] for x in all_[:9]] for i in range(5)]
    assert whole == sorted(map(str, fertility.judge(docs.repartition(1)).collect()))


def brute_entropy(run, span):
    total = 0.0
    for i in range(0, len(run), span):
        part = run[i : i + span]
        h = -sum(part.count(x) / len(part) * np.log2(part.count(x) / len(part)) for x in set(part))
        total += len(part) * (h / np.log2(len(part)) if len(part) > 1 else 1.0)
    return total / len(run) if run else 1.0


@pytest.mark.parametrize("span", [4, 256])
def test_entropy_equals_its_definition(span):
    rng = random.Random(1)
    runs = [[1, 1, 2], [], [5], list(range(600)), [3] * 50, [rng.randrange(40) for _ in range(700)], [7] * 257]
    out = fertility.entropies(np.array([x for r in runs for x in r], "i8"), np.array([len(r) for r in runs]), span)
    assert np.allclose(out, [brute_entropy(r, span) for r in runs])


def test_entropy_does_not_tell_length(spark):
    rng = random.Random(2)
    vocabulary = [words(i, 1) + words(i + 9000, 1) for i in range(8000)]
    rank = [1 / (i + 1) for i in range(8000)]
    texts = [" ".join(rng.choices(vocabulary, rank, k=n)) for n in (300, 1000, 3000, 20_000, 400_000)]
    found = sorted(fertility.judge(spark.createDataFrame([document(i, t, "xx") for i, t in enumerate(texts)], SCHEMA)).collect(), key=lambda r: r["doc_id"])
    assert all(r["kept"] for r in found) and max(r["entropy"] for r in found) - min(r["entropy"] for r in found) < 0.05


def test_measures_and_verdict_equal_brute_force(spark, docs, rows):
    import base64
    import re

    import sentencepiece
    import tiktoken

    body = open(public_tokenizers.path(fertility.VOCABULARY), "rb").read()
    bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, body.splitlines())}, special_tokens={})
    model = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path(fertility.PIECES)))
    more = [document(200, "日本語 テキスト の 例 " * 12, "ja"), document(201, "ελληνικά και λίγο " * 9, None), document(202, "<|endoftext|> a b c " * 12), document(203, words(1, 25), "tlh")]
    found = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in fertility.judge(docs.unionByName(spark.createDataFrame(more, SCHEMA))).collect()}
    for row in [*rows, *more]:
        text = row[1] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        r = found[row[0], len(w), sum(map(len, w))]
        ids = bpe.encode_ordinary(text)
        parts = [x for v in w for x in model.encode(v)]
        per_token, share, entropy = sum(map(len, w)) / max(len(ids), 1), sum(map(model.is_byte, parts)) / max(len(parts), 1), brute_entropy(ids, fertility.SPAN)
        assert abs(r["chars_per_token"] - per_token) < 1e-9 and abs(r["fallback_share"] - share) < 1e-9 and abs(r["entropy"] - entropy) < 1e-9
        letters = {n: sum(a <= ord(c) <= b for c in text for a, b in blocks) for n, blocks in fertility.SCRIPTS.items()}
        script = next((n for n, k in letters.items() if k and k == max(letters.values())), "other")
        band = row[2] if row[2] in fertility.BANDS else script
        low, high, most, least, top = fertility.BANDS[band]
        assert r["band"] == band and r["kept"] == (not r["base_failed"] and low <= per_token <= high and share <= most and least <= entropy <= top)


def test_fertility_of_nothing(none):
    assert fertility.judge(none).count() == 0
