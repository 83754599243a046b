"""Toxicity by a linear-chain conditional random field.

Labelled documents give labelled tokens: words and beginnings of words that toxic documents use far more often than clean
ones, by a likelihood-ratio test, mark their tokens in toxic documents. A two-state chain over the tokens of a sentence,
with the word, its beginnings, its length, its shape and its neighbours as features, is trained on these by stochastic
gradients of the exact likelihood (forward-backward). Scoring runs forward-backward over every sentence of every document;
the marginals give the offending spans, and a logistic calibration of their maximum and their sum gives the document's
score.

The training sample alone is bounded: of each label the first TRAIN_DOCS ids by hash, until their texts come to
TRAIN_BYTES; its rows train with all their sentences. Scoring covers all rows and whole texts. Sentences end at . ! ? or
a line end and are one chain, however long: a chain is computed in pieces of SPAN tokens, whose messages are exact.

Defined results: null or empty text, or text without words, gets the score of a document without any toxic token;
labels that are null are left out, and of several labels of one id the highest counts, as of several rows of a labelled
id the smallest text; without labels of both classes every score is the share of toxic labels (0 if there is none); a
null doc_id is in no fold, so not held out, and trains nothing; repeated rows give repeated rows; an empty table gives an
empty result; extra columns are ignored. Offsets of spans are code points of the text as it is: tokens are found in it
and lower-cased one by one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import documents, pieces, small_batches

TRAIN_DOCS, TRAIN_BYTES, SPAN = 1500, 16 << 20, 64
FOLDS = 5
#: A word or beginning marks tokens of toxic documents from this many times the clean rate on, and from a likelihood
#: ratio that chance reaches for one in exp(SURE / 2) of samples, all features that are tried taken together.
TIMES, SURE = 8.0, 6.0
#: Sentences of one training step, and steps that training takes at least: few sentences are gone through more often.
BATCH, STEPS = 128, 1500
BEGINNINGS = (9, 8, 7, 6, 5, 4, 3)
TELLING = slice(0, 1 + len(BEGINNINGS))
#: The slot of all features that training has not met or does not use; its weight stays 0.
SPARE = 0
REMEMBERED = 400_000
TOKENS = re.compile(r"\w+|[.!?\n]")
ENDS = frozenset(".!?\n")


def features(word: str) -> list[str]:
    """What the chain sees of the word itself, in lower case: the word, its beginnings from the longest on, its length,
    its shape; "" where it is too short for a beginning. Neighbours see the word alone."""
    word = word.lower()
    shape = "digit" if word.isdigit() else "mixed" if not word.isalpha() else "plain"
    return [f"w={word}", *(f"{k}={word[:k]}" if len(word) > k else "" for k in BEGINNINGS), f"n={min(len(word), 12)}", shape]


def chains(ends: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, lengths) of the chains among tokens: runs without sentence ends, within a document."""
    word = np.flatnonzero(~ends)
    if not len(word):
        return word, word
    first = np.flatnonzero(np.concatenate([[True], (np.diff(word) > 1) | (np.diff(docs[word]) > 0)]))
    return word[first], np.diff(np.concatenate([first, [len(word)]]))


def _messages(w: np.ndarray, m: np.ndarray, starts: np.ndarray, lengths: np.ndarray, parts: np.ndarray, pre: np.ndarray, post: np.ndarray) -> None:
    """Set what comes into each piece from the left (``pre``) and the right (``post``), for chains of several pieces.

    A piece is a 2 x 2 matrix; the matrices of all pieces are computed side by side, their chains piece by piece.
    """
    first = np.cumsum(parts) - parts
    long = np.flatnonzero(parts > 1)
    of = np.concatenate([np.arange(first[c], first[c] + parts[c]) for c in long])
    order = of[np.argsort(-lengths[of], kind="stable")]
    at, size = starts[order], lengths[order]
    through = np.zeros((len(order), 2, 2))
    through[:, 0, 0], through[:, 1, 1] = 1, w[at]
    for t in range(1, int(size[0])):
        n = int(np.searchsorted(-size, -t, side="left"))
        step = through[:n] @ m
        step[:, :, 1] *= w[at[:n] + t, None]
        through[:n] = step / step.sum(axis=(1, 2))[:, None, None]
    matrix = np.empty((len(lengths), 2, 2))
    matrix[order] = through / through.sum(axis=(1, 2))[:, None, None]
    long = long[np.argsort(-parts[long], kind="stable")]
    for r in range(1, int(parts[long[0]])):
        own = first[long[parts[long] > r]] + r
        v = ((pre[own - 1][:, None, :] @ matrix[own - 1]) @ m)[:, 0, :]
        pre[own] = v / v.sum(axis=1)[:, None]
        own = first[long[parts[long] > r]] + parts[long[parts[long] > r]] - r
        v = (m @ (matrix[own] @ post[own][:, :, None]))[:, :, 0]
        post[own - 1] = v / v.sum(axis=1)[:, None]


def marginals(emit: np.ndarray, starts: np.ndarray, lengths: np.ndarray, move: np.ndarray, begin: float, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains of two states.

    emit: log-odds of state 1 for each token; move: 2 x 2 log-weights; begin: log-odds of state 1 at a chain's start.
    Returns P(state 1) of each token (0 outside chains) and the expected number of each transition. Chains of over
    ``span`` tokens are computed in pieces of that many; the results do not depend on it.
    """
    p, pairs = np.zeros(len(emit)), np.zeros((2, 2))
    if not len(starts):
        return p, pairs
    w, m = np.exp(np.clip(emit, -30, 30)), np.exp(move)
    parts = -(-lengths // span)
    chain = np.repeat(np.arange(len(parts)), parts)
    step = np.arange(parts.sum()) - (np.cumsum(parts) - parts)[chain]
    starts, lengths = starts[chain] + span * step, np.minimum(lengths[chain] - span * step, span)
    pre, post = np.tile([1.0, np.exp(begin)], (len(starts), 1)), np.full((len(starts), 2), 0.5)
    if parts.max() > 1:
        _messages(w, m, starts, lengths, parts, pre, post)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths, pre, post, inner = starts[order], lengths[order], pre[order], post[order], step[order] > 0
    alive = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(int(lengths[0]))]  # pieces of more than t tokens
    one = np.zeros(len(emit))  # forward, scaled: P(state 1 | tokens so far)
    now = pre[:, 1] * w[starts]
    now = now / (pre[:, 0] + now)
    one[starts] = now
    for t in range(1, len(alive)):
        n = alive[t]
        now = now[:n]
        a0, a1 = (1 - now) * m[0, 0] + now * m[1, 0], ((1 - now) * m[0, 1] + now * m[1, 1]) * w[starts[:n] + t]
        now = a1 / (a0 + a1)
        one[starts[:n] + t] = now
    b1 = post[:, 1] / post.sum(axis=1)  # backward, scaled: share of state 1
    for t in range(len(alive) - 1, -1, -1):
        n = alive[t]
        at = starts[:n] + t
        x1, x0 = one[at] * b1[:n], (1 - one[at]) * (1 - b1[:n])
        p[at] = x1 / (x0 + x1)
        use = slice(0, n) if t else np.flatnonzero(inner)  # tokens that have one before them in the chain
        f1, e1, e0 = one[starts[use] + t - 1], w[starts[use] + t] * b1[use], 1 - b1[use]
        joint = np.stack([(1 - f1) * m[0, 0] * e0, (1 - f1) * m[0, 1] * e1, f1 * m[1, 0] * e0, f1 * m[1, 1] * e1])
        pairs += (joint / joint.sum(axis=0)).sum(axis=1).reshape(2, 2)
        if t:
            c0, c1 = m[0, 0] * e0 + m[0, 1] * e1, m[1, 0] * e0 + m[1, 1] * e1
            b1[:n] = c1 / (c0 + c1)
    return p, pairs


def tokens(texts: list[str]) -> list[list[str]]:
    return [TOKENS.findall(x) for x in texts]


class Chain:
    """The trained field: weights of a word's features and of its neighbours, transitions, and the calibration."""

    def __init__(self):
        self.know([])
        self.move, self.begin, self.bias = np.zeros((2, 2)), 0.0, 0.0
        self.scale, self.prior = np.zeros(3), None
        self.forget()

    def know(self, used: list[str]) -> None:
        """Give these features a slot each, and all weights the value 0."""
        self.index = {f: i for i, f in enumerate(used, SPARE + 1)}
        self.here, self.before, self.after = (np.zeros(len(used) + 1) for _ in range(3))

    def forget(self) -> None:
        self.ids: dict[str, int] = {}
        self.table = np.zeros((1 << 12, 4))  # a word's weight here, as the left and as the right neighbour, is an end

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("ids", "table")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.forget()

    def slots(self, word: str) -> list[int]:
        return [self.index.get(f, SPARE) for f in features(word)]

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > REMEMBERED:
            self.forget()
            new = list(words)
        n = len(self.ids)
        while n + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        for i, word in enumerate(new, n):
            own = self.slots(word)
            self.table[i] = self.bias + self.here[own].sum(), self.before[own[0]], self.after[own[0]], word in ENDS
        self.ids.update(zip(new, range(n, n + len(new)), strict=True))

    def emissions(self, found: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(log-odds of each token, document of each token, chain starts, chain lengths)."""
        counts = np.fromiter(map(len, found), "i8", len(found))
        self.learn(set().union(*found))
        rows = self.table[np.fromiter((self.ids[w] for x in found for w in x), "i8", counts.sum())]
        docs = np.repeat(np.arange(len(found)), counts)
        starts, lengths = chains(rows[:, 3] > 0, docs)
        left, right = np.ones(len(rows), bool), np.ones(len(rows), bool)  # has a neighbour in its chain
        left[starts] = False
        right[starts + lengths - 1] = False
        emit = rows[:, 0].copy()
        emit[1:] += np.where(left[1:], rows[:-1, 1], 0)
        emit[:-1] += np.where(right[:-1], rows[1:, 2], 0)
        return emit, docs, starts, lengths

    def summary(self, found: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(marginals, document of each token, [log-odds of the highest marginal, log of their clear sum, 1] a document)."""
        emit, docs, starts, lengths = self.emissions(found)
        p, _ = marginals(emit, starts, lengths, self.move, self.begin)
        top, clear = np.full(len(found), 1e-6), np.zeros(len(found))
        np.maximum.at(top, docs, p)
        np.add.at(clear, docs, np.where(p > 0.5, p, 0))
        top = np.clip(top, 1e-6, 1 - 1e-6)
        return p, docs, np.stack([np.log(top / (1 - top)), np.log1p(clear), np.ones(len(found))], axis=1)

    def scores(self, seen: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(seen), self.prior)
        return 1 / (1 + np.exp(-np.clip(seen @ self.scale, -30, 30)))


def telling_features(toxic: list[list[str]], clean: list[list[str]]) -> set[str]:
    """Words and beginnings that tell toxic documents from clean ones, by the numbers of documents that have them.

    Words come first, then beginnings from the longest on. A beginning must tell over all its words, and still do so,
    in two documents or more, over those that nothing longer covers: not by one word that has it.
    """
    n, m, found = len(toxic), len(clean), set()
    pure = lambda k, j: (k + 0.5) / (n + 1) >= TIMES * (j + 0.5) / (m + 1)
    both = [[[features(w)[TELLING] for w in set(x) - ENDS] for x in side] for side in (toxic, clean)]
    for level in range(1 + len(BEGINNINGS)):
        a, b = (Counter(g for x in side for g in {f[level] for f in x} if g) for side in both)
        rest_a, rest_b = (Counter(g for x in side for g in {f[level] for f in x if found.isdisjoint(f[:level])} if g) for side in both)
        least = 2 * np.log(max(len(a), 1)) + SURE
        new = set()
        for f, k in a.items():
            j = b[f]
            if pure(k, j) and (not level or rest_a[f] > 1 and pure(rest_a[f], rest_b[f])):
                share = (k + j) / (n + m)
                if 2 * (k * np.log(k / (n * share)) + (j * np.log(j / (m * share)) if j else 0)) >= least:
                    new.add(f)
        found |= new
    return found


def one_of_copies(found: list[list[str]], size: int = 4) -> list[int]:
    """The places of documents of which no earlier one is a near copy: half of a sketch of rare-looking words agrees.

    Copies would make the accidents of one text look like evidence from many.
    """
    import zlib

    kept, seen = [], {}
    for i, words in enumerate(found):
        sketch = sorted({zlib.crc32(w.encode()) for w in words if len(w) > 5})[:size]
        near = Counter(j for h in sketch for j in seen.get(h, ()))
        if not sketch or max(near.values(), default=0) * 2 < len(sketch):
            kept.append(i)
            for h in sketch:
                seen[h] = (*seen.get(h, ()), i)
    return kept


def train(texts: list[str], labels: list[int], epochs: int = 6, seed: int = 7) -> Chain:
    """Fit the field on token labels made from document labels, then the calibration on the documents."""
    chain = Chain()
    y = np.array(labels, int)
    if len(set(labels)) < 2:
        chain.prior = float(y.mean()) if len(y) else 0.0
        return chain
    found = [[w.lower() for w in x] for x in tokens(texts)]
    alone = one_of_copies(found)
    if len({labels[i] for i in alone}) == 2:
        found, y = [found[i] for i in alone], y[alone]
    aside, own = [], []  # every fourth document of each class calibrates and trains nothing
    for label in (0, 1):
        of = np.flatnonzero(y == label).tolist()
        aside += of[::4] if len(of) > 3 else of
        own += [i for i in of if i not in set(of[::4])] if len(of) > 3 else of
    calibrating, said = [found[i] for i in sorted(aside)], y[sorted(aside)]
    found, y = [found[i] for i in sorted(own)], y[sorted(own)]
    telling = telling_features([x for x, t in zip(found, y, strict=True) if t], [x for x, t in zip(found, y, strict=True) if not t])
    marked = {w for w in set().union(*found) - ENDS if not telling.isdisjoint(features(w)[TELLING])}
    rng = np.random.default_rng(seed)
    sentences = []
    for words, toxic in zip(found, y, strict=True):
        ends = np.array([w in ENDS for w in words], bool)
        starts, lengths = chains(ends, np.zeros(len(words), int))
        own = [words[s : s + n] for s, n in zip(starts, lengths, strict=True)]
        sentences += [(x, [int(bool(toxic) and w in marked) for w in x]) for x in own]
    # words met once stay without a slot, as words never met have none; beginnings are used if they tell something
    often = Counter(w for x, _ in sentences for w in x)
    own = {w: features(w) for w in often}
    chain.know(sorted({own[w][0] for w, n in often.items() if n > 1} | {f for x in own.values() for f in x[TELLING.stop :]} | {f for x in own.values() for f in x[TELLING] if f in telling}))
    slots = {w: chain.slots(w) for w in often}
    weights = (chain.here, chain.before, chain.after)
    grown = [np.full(len(w), 1e-3) for w in weights]
    width = len(features("x"))
    for _ in range(max(epochs, -(-STEPS * BATCH // max(len(sentences), 1)))):
        order = rng.permutation(len(sentences))
        for start in range(0, len(order), BATCH):
            part = [sentences[i] for i in order[start : start + BATCH]]
            lengths = np.array([len(x) for x, _ in part])
            starts = np.cumsum(lengths) - lengths
            here = np.array([slots[w] for x, _ in part for w in x])
            gold = np.array([v for _, x in part for v in x])
            n = len(gold)
            left, right = np.ones(n, bool), np.ones(n, bool)
            left[starts], right[starts + lengths - 1] = False, False
            i, j = np.flatnonzero(left), np.flatnonzero(right)
            emit = chain.bias + chain.here[here].sum(axis=1)
            emit[i] += chain.before[here[i - 1, 0]]
            emit[j] += chain.after[here[j + 1, 0]]
            p, pairs = marginals(emit, starts, lengths, chain.move, chain.begin)
            step = gold - p
            for w, g, at, by in ((weights[0], grown[0], here.ravel(), np.repeat(step, width)), (weights[1], grown[1], here[i - 1, 0], step[i]), (weights[2], grown[2], here[j + 1, 0], step[j])):
                uniq, back = np.unique(at, return_inverse=True)
                grad = np.bincount(back, by, len(uniq)) - 1e-3 * w[uniq]
                g[uniq] += grad**2
                w[uniq] += 0.2 * grad / np.sqrt(g[uniq])
                w[SPARE] = 0
            seen = np.zeros((2, 2))
            np.add.at(seen, (gold[i - 1], gold[i]), 1)
            chain.move += 0.2 * (seen - pairs) / n
            chain.move -= chain.move[0, 0]
            chain.begin += 0.2 * step[starts].sum() / n
            chain.bias += 0.2 * step.sum() / n
    x, y = chain.summary(calibrating)[2], said
    plain = np.array([0.7, 1.5, -0.5])  # what few documents are drawn to: more than one clear token
    chain.scale = plain
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    ridge = 1e-3 + 1 / len(y)
    for _ in range(400):  # Newton steps
        s = chain.scores(x)
        grad = x.T @ (weight * (y - s)) / len(y) - ridge * (chain.scale - plain)
        curve = (x * (weight * s * (1 - s))[:, None]).T @ x / len(y) + ridge * np.eye(3)
        step = np.linalg.solve(curve, grad)
        chain.scale = chain.scale + step / max(1, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return chain


def training_rows(docs: DataFrame, labels: DataFrame, column: str, per_class: int, most_bytes: int, folds: int | None = FOLDS) -> tuple[list, dict[int, int]]:
    """(rows: id_, y_ and the columns of docs, one for each chosen id; numbers of ids by label, before choosing).

    Of each label the first ``per_class`` ids by hash, until their texts come to ``most_bytes``; no text is left out for
    its length. Ids whose crc32 (as text) is 0 modulo ``folds`` are left out (None: all take part). Of several rows of
    an id that of the smallest text counts. The chosen ids, at most 2 x ``per_class``, are broadcast.
    """
    spark = docs.sparkSession
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds if folds else F.lit(1)
    known = labels.select(F.col("doc_id").cast("long").alias("id_"), "doc_id", F.col(column).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)").where(fold != 0)
    known = known.groupBy("id_").agg(F.max("y").alias("y_"))
    order = F.xxhash64("id_", F.lit("train"))
    totals = {0: 0, 1: 0} | {r["y_"]: r["n"] for r in known.groupBy("y_").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = [(r["id_"], r["y_"]) for y in (0, 1) for r in known.where(F.col("y_") == y).orderBy(order, "id_").limit(per_class).collect()]
    table = spark.createDataFrame(chosen, "id_ long, y_ int")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(text.alias("text"), *(F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")))
    rows = docs.join(F.broadcast(table), F.col("doc_id").cast("long") == F.col("id_")).groupBy("id_", "y_").agg(F.min(row).alias("row"))
    before = Window.partitionBy("y_").orderBy(order, "id_").rowsBetween(Window.unboundedPreceding, -1)
    fitting = rows.withColumn("before_", F.coalesce(F.sum(F.octet_length("row.text")).over(before), F.lit(0))).where(F.col("before_") < most_bytes)
    return sorted(fitting.select("id_", "y_", "row.*").collect(), key=lambda r: r["id_"]), totals


def spans(text: str, p: list[float], least: float = 0.5) -> list[tuple[int, int, float]]:
    """(start, end, highest marginal) in code points of the runs of tokens at ``least`` or more."""
    out: list[tuple[int, int, float]] = []
    last = -2
    for i, m in enumerate(TOKENS.finditer(text)):
        if p[i] >= least:
            if i == last + 1:
                out[-1] = (out[-1][0], m.end(), max(out[-1][2], p[i]))
            else:
                out.append((m.start(), m.end(), p[i]))
            last = i
    return out


SCHEMA = "doc_id long, score double, spans array<struct<start: int, end: int, p: double>>"


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, score and the offending spans (code points of the text) of every row of ``docs``."""
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(chain)  # bounded by the training sample, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, max_bytes=2 << 20):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            p, of, seen = shipped.value.summary(tokens(texts))
            first = np.searchsorted(of, np.arange(len(texts) + 1))
            hit = np.zeros(len(texts), bool)
            hit[of[p >= 0.5]] = True
            told = [[dict(zip(("start", "end", "p"), s, strict=True)) for s in spans(t, p[a:b].tolist())] if h else [] for t, h, a, b in zip(texts, hit, first, first[1:], strict=False)]
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(shipped.value.scores(seen)), pa.array(told, kind)], names=["doc_id", "score", "spans"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, SCHEMA)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_DOCS) -> Chain:
    rows, _ = training_rows(docs.select("doc_id", "text"), labels, "toxic", per_class, TRAIN_BYTES)
    return train([r["text"] for r in rows], [r["y_"] for r in rows])


def op10_crf_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("spans").alias("n_spans"), "spans")
