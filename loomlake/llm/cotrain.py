"""Quality by co-training two views of a document.

The content view is the text alone: its tokens (hashed words with the shape of their marks), repeats and shares of classes
of bytes. The page view is the metadata alone: language, source and the stated size (n_chars, where there is such a
column). Each view is a table of log-likelihood ratios, of token slots or of metadata values, counted over the rows that
it knows a label of, and a small logistic fit over what a document draws from it, on labelled rows that nothing was
counted on; so its odds are calibrated.

In every round, until a round changes nothing, each view scores all unlabelled rows of the corpus, and the rows that it is sure of (calibrated
probability of SURE or more for either class) are counted, with that label, for the other view. The counts are sums over
partitions, so a round is one pass over the corpus and the exchange grows with it; whatever their number, they weigh at
most as much as the labelled rows of their class. Last, the calibrated log-odds of the views are combined by a third
logistic fit on the labelled rows set aside, and every document is scored by the combination.

The labelled sample alone is bounded: LABELLED rows of each class, by hash of the id, until TRAIN_BYTES of text of that
class are reached; its rows are weighted so that classes count as in all labels. All else covers all rows and whole texts.

Defined results: null or empty text is a document of no tokens; null language, source or size is a value of its own;
labels that are null are left out, and of several labels of one id the highest counts, as of several rows of a labelled
id the smallest text; without labels of both classes every score is the share of good labels (1 if there is none), so
nothing is rejected without evidence; repeated rows give repeated rows; an empty table gives an empty result; extra
columns are ignored by :func:`score`, kept by :func:`accepted`.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import cut, documents, fresh_names, give_back, pieces, small_batches
from .crf_toxicity import training_rows
from .fertility import sums

LABELLED, TRAIN_BYTES, FOLDS = 1200, 24 << 20, 5
#: Folds of the labelled rows that calibrate; the others are counted.
ASIDE = (0, 1)
ROUNDS = 4
#: A view passes on the rows that it gives this probability of one of the classes.
SURE = {1: 0.98, 0: 0.95}
WORDS = 1 << 15
#: Slots of the page view: language, source and size each have a part of their own.
LANGS, SOURCES, SIZES = 64, 4096, 64
PAGE = LANGS + SOURCES + SIZES
#: The slot of a token that repeats the one before it.
REPEAT = 0
REMEMBERED = 100_000
#: A document is kept from this probability of good quality on.
KEEP = 0.3
MARKS = re.compile(rb"[a-z0-9\x80-\xff]+")
#: Classes of bytes whose shares the content view sees.
CLASSES = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".,;:!?", "mark": b"#*$%&|<>=+~^@_{}[]\\/", "line": b"\n", "blank": b" \t\x0b\f\r"}
_table = np.zeros((256, len(CLASSES)))
for _i, _bytes in enumerate(CLASSES.values()):
    _table[list(_bytes), _i] = 1


def word_slot(word: bytes) -> int:
    """The content feature of a token: its lower-case letters if it has no marks, else the shape of its marks."""
    low = word.lower()
    bare = low.strip(b".,;:!?\"'()")
    shape = MARKS.sub(b"a", low if bare and MARKS.fullmatch(bare) is None else bare or low)
    return zlib.crc32(bare if shape == b"a" else b"\x00" + shape[:16]) % WORDS


class Views:
    """Tokens and layout of texts, as features; remembers the slots of words."""

    def __init__(self):
        self.slots: dict[bytes, int] = {}

    def content(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(slots of all tokens, tokens of each text)."""
        found = [x.encode().split() for x in texts]
        new = {w for x in found for w in x if w not in self.slots}
        if len(self.slots) + len(new) > REMEMBERED:
            self.slots, new = {}, set().union(*found)
        self.slots.update((w, word_slot(w)) for w in new)
        counts = np.fromiter(map(len, found), "i8", len(found))
        slots = np.fromiter((self.slots[w] for x in found for w in x), "i8", counts.sum())
        again = np.concatenate([[False], slots[1:] == slots[:-1]])[: len(slots)]
        first = np.cumsum(counts) - counts
        again[first[counts > 0]] = False
        return np.where(again, REPEAT, slots), counts


def layout(texts: list[str]) -> np.ndarray:
    """Shares of the classes of bytes in each text."""
    out = np.zeros((len(texts), len(CLASSES)))
    for i, text in enumerate(texts):
        raw = np.frombuffer(text.encode(), "u1")
        out[i] = np.minimum(5 * (np.bincount(raw, minlength=256) @ _table) / max(len(raw), 1), 1)
    return out


def page_slots(langs: list[str | None], sources: list[str | None], sizes: list[int | None]) -> np.ndarray:
    """The slots of language, source and size (by powers of 2; negative like null) of each row."""
    out = np.empty((len(langs), 3), "i8")
    for i, (lang, source, size) in enumerate(zip(langs, sources, sizes, strict=True)):
        out[i, 0] = zlib.crc32(repr(lang).encode()) % LANGS
        out[i, 1] = LANGS + zlib.crc32(repr(source).encode()) % SOURCES
        out[i, 2] = LANGS + SOURCES + (SIZES - 1 if size is None or size < 0 else min(int(size).bit_length(), SIZES - 2))
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_dense(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Logistic weights by Newton steps; rows count by ``weight``."""
    w, weight = np.zeros(x.shape[1]), weight / weight.sum()
    for _ in range(steps):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (weight * (y - p)) - ridge * w)
        w += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-7:
            break
    return w


class Bags:
    """What both views see of some documents: distinct token slots with their numbers, layout, page slots."""

    def __init__(self, slot: np.ndarray, number: np.ndarray, sizes: np.ndarray, shares: np.ndarray, page: np.ndarray):
        self.slot, self.number, self.sizes, self.shares, self.page = slot, number, sizes, shares, page
        self.tokens = sums(number, sizes)

    @classmethod
    def of(cls, views: Views, texts: list[str], langs: list, sources: list, sizes: list) -> Bags:
        slots, counts = views.content(texts)
        doc = np.repeat(np.arange(len(counts)), counts)
        key, number = np.unique(doc * WORDS + slots, return_counts=True)
        return cls(key % WORDS, number, np.bincount(key // WORDS, minlength=len(texts)), layout(texts), page_slots(langs, sources, sizes))

    def content(self, ratio: np.ndarray) -> np.ndarray:
        """What the content view's fit sees: the tokens' mean ratio, the share of telling tokens, of repeats, and layout."""
        own, n = ratio[self.slot], np.maximum(self.tokens, 1)
        rows = [sums(self.number * own, self.sizes) / n, sums(self.number * (own < -1), self.sizes) / n, sums(self.number * (self.slot == REPEAT), self.sizes) / n]
        return np.column_stack([*rows, self.shares, np.ones(len(n))])

    def metadata(self, ratio: np.ndarray) -> np.ndarray:
        return np.column_stack([ratio[self.page], np.ones(len(self.page))])

    def counted(self, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, documents) of rows of label 0 and 1 by slot, in rows 0 and 1; rows of other labels count nowhere."""
        of = np.repeat(label, self.sizes)
        tokens = np.array([np.bincount(self.slot[of == y], self.number[of == y], WORDS) for y in (0, 1)])
        return tokens.astype("i8"), np.array([np.bincount(self.page[label == y].ravel(), minlength=PAGE) for y in (0, 1)])


def ratios(known: np.ndarray, passed: np.ndarray, groups: list[slice]) -> np.ndarray:
    """Log-likelihood ratios of label 1 from counts by label; what was passed on weighs no more than what was known.

    Each group of slots is a distribution of its own.
    """
    out = np.zeros(known.shape[1])
    for part in groups:
        sides = []
        for y in (0, 1):
            own, other = known[y, part].astype(float), passed[y, part].astype(float)
            sides.append(own + other * min(0.5, own.sum() / max(other.sum(), 1)) + 1)
        out[part] = np.log(sides[1] / sides[1].sum()) - np.log(sides[0] / sides[0].sum())
    return out


PAGE_GROUPS = [slice(0, LANGS), slice(LANGS, LANGS + SOURCES), slice(LANGS + SOURCES, PAGE)]


class Model:
    """Ratios and weights of both views, and the combination; ``prior`` alone where nothing could be learned."""

    def __init__(self, prior: float | None = None):
        self.prior = prior
        self.content_ratio = self.page_ratio = self.content = self.page = self.combine = None

    def odds(self, bags: Bags) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated log-odds of good quality by the content view and by the page view."""
        return bags.content(self.content_ratio) @ self.content, bags.metadata(self.page_ratio) @ self.page

    def score(self, views: Views, texts: list[str], langs: list, sources: list, sizes: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities of good quality: combined, content view, page view."""
        if self.prior is not None:
            return (np.full(len(texts), self.prior),) * 3
        a, b = self.odds(Bags.of(views, texts, langs, sources, sizes))
        return sigmoid(np.column_stack([a, b, np.ones(len(a))]) @ self.combine), sigmoid(a), sigmoid(b)


def sure(odds: np.ndarray) -> np.ndarray:
    """The label that a view is sure of, else -1."""
    p = sigmoid(odds)
    return np.where(p >= SURE[1], 1, np.where(1 - p >= SURE[0], 0, -1))


def passed_on(model: Model, bags: Bags) -> tuple[np.ndarray, np.ndarray]:
    """(tokens for the content view, documents for the page view): each view's sure rows, counted for the other."""
    content, page = model.odds(bags)
    return bags.counted(sure(page))[0], bags.counted(sure(content))[1]


def co_train(labelled: Bags, y: np.ndarray, fold: np.ndarray, weight: np.ndarray, exchange, rounds: int = ROUNDS) -> Model:
    """``exchange``: a model -> :func:`passed_on` summed over the unlabelled corpus."""
    aside = np.isin(fold, ASIDE)
    if len(set(y[aside])) < 2 or len(set(y[~aside])) < 2:
        return Model(prior=float((y * weight).sum() / weight.sum()) if len(y) else 1.0)
    own = labelled.counted(np.where(aside, -1, y))
    model, got = Model(), tuple(np.zeros_like(x) for x in own)
    for step in range(rounds + 1):
        model.content_ratio = ratios(own[0], got[0], [slice(0, WORDS)])
        model.page_ratio = ratios(own[1], got[1], PAGE_GROUPS)
        model.content = fit_dense(labelled.content(model.content_ratio)[aside], y[aside], weight[aside])
        model.page = fit_dense(labelled.metadata(model.page_ratio)[aside], y[aside], weight[aside], 1e-2)
        if step < rounds:
            before, got = got, exchange(model)
            if all(np.array_equal(a, b) for a, b in zip(before, got, strict=True)):
                break  # the views pass on what they did before: more rounds would change nothing
    odds = np.column_stack([*model.odds(labelled), np.ones(len(y))])
    model.combine = fit_dense(odds[aside], y[aside], weight[aside], 1e-2)
    return model


def _size(docs: DataFrame) -> Column:
    """The stated size where there is one that is a number; else null."""
    return F.expr("try_cast(n_chars as bigint)") if "n_chars" in docs.columns else F.lit(None).cast("long")


BAGS = "slots binary, numbers binary, shares binary, page binary"


def bags(docs: DataFrame, known: DataFrame) -> DataFrame:
    """What both views see of the rows whose id is not among ``known`` (id_), kept in the shared folder for all rounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views = Views()
        for batch in pieces(batches):
            found = Bags.of(views, [x or "" for x in batch.column("text").to_pylist()], *(batch.column(n).to_pylist() for n in ("lang", "source", "size_")))
            ends = np.cumsum(found.sizes).tolist()
            slot, number = found.slot.astype("<u2"), found.number.astype("<u4")
            parts = [(slot[b - n : b].tobytes(), number[b - n : b].tobytes()) for n, b in zip(found.sizes.tolist(), ends, strict=True)]
            shares, page = ([x.tobytes() for x in rows] for rows in (found.shares.astype("<f4"), found.page.astype("<u2")))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in ([a for a, _ in parts], [b for _, b in parts], shares, page)], names=["slots", "numbers", "shares", "page"])

    base = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), _size(docs).alias("size_"))
    return cut(base.join(F.broadcast(known), F.col("doc_id") == F.col("id_"), "left_anti").select("text", "lang", "source", "size_").mapInArrow(run, BAGS))


def exchange_over(rows: DataFrame):
    """The exchange of a round: one pass over ``rows`` (:func:`bags`), sums by slot; WORDS + PAGE rows reach the driver."""

    def ask(model: Model) -> tuple[np.ndarray, np.ndarray]:
        shipped = rows.sparkSession.sparkContext.broadcast(model)  # WORDS + PAGE ratios, whatever the input

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((2, WORDS + PAGE), "i8")
            for batch in batches:
                for start in range(0, batch.num_rows, 2048):
                    columns = [batch.slice(start, 2048).column(c).to_pylist() for c in ("slots", "numbers", "shares", "page")]
                    slot, number, shares, page = (np.frombuffer(b"".join(c), kind) for c, kind in zip(columns, ("<u2", "<u4", "<f4", "<u2"), strict=True))
                    sizes = np.array([len(x) // 2 for x in columns[0]], "i8")
                    part = Bags(slot.astype("i8"), number.astype("i8"), sizes, shares.reshape(-1, len(CLASSES)).astype("f8"), page.reshape(-1, 3).astype("i8"))
                    total += np.concatenate(passed_on(shipped.value, part), axis=1)
            give_back()
            at = np.flatnonzero(total.any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], names=["slot", "poor", "good"])

        found = rows.mapInArrow(run, "slot long, poor long, good long").groupBy("slot").agg(F.sum("poor").alias("poor"), F.sum("good").alias("good")).collect()
        out = np.zeros((2, WORDS + PAGE), "i8")
        for r in found:
            out[:, r["slot"]] = r["poor"], r["good"]
        shipped.destroy()
        return out[:, :WORDS], out[:, WORDS:]

    return ask


def fit(docs: DataFrame, labels: DataFrame, rounds: int = ROUNDS) -> Model:
    """Train on a bounded sample of labelled rows and, by exchange, on all others."""
    base = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), _size(docs).alias("size_"))
    rows, totals = training_rows(base, labels, "quality", LABELLED, TRAIN_BYTES, None)
    y = np.array([r["y_"] for r in rows], int)
    seen = np.bincount(y, minlength=2)
    weight = np.array([totals[c] / seen[c] for c in y.tolist()])
    fold = np.array([zlib.crc32(str(r["id_"]).encode()) % FOLDS for r in rows], int)
    labelled = Bags.of(Views(), *([r[c] or "" if c == "text" else r[c] for r in rows] for c in ("text", "lang", "source", "size_")))
    known = base.sparkSession.createDataFrame([(r["id_"],) for r in rows], "id_ long")
    held: list = []

    def exchange(model: Model) -> tuple[np.ndarray, np.ndarray]:  # the corpus is looked at only if there is a model
        if not held:
            held.append(exchange_over(bags(docs, known)))
        return held[0](model)

    return co_train(labelled, y, fold, weight, exchange, rounds)


def _scored(docs: DataFrame, model: Model, kept: list[str]) -> DataFrame:
    small_batches(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # WORDS + PAGE ratios, whatever the input
    names = fresh_names(kept, "score", "content", "page", "text", "lang", "source", "size")
    new, own = names[:3], names[3:]
    views_of = [docs["text"].cast("string"), docs["lang"].cast("string"), docs["source"].cast("string"), _size(docs)]
    held = docs.select(*(docs[f"`{c}`"] for c in kept), *(c.alias(n) for c, n in zip(views_of, own, strict=True)))
    schema = T.StructType([*(docs.schema[c] for c in kept), *(T.StructField(n, T.DoubleType()) for n in new)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        views = Views()
        for batch in pieces(batches, own[0]):
            texts = [x or "" for x in batch.column(own[0]).to_pylist()]
            out = shipped.value.score(views, texts, *(batch.column(n).to_pylist() for n in own[1:]))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(kept))), *map(pa.array, out)], names=[*kept, *new])

    return held.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """doc_id, score, content_score, page_score and kept for every row of ``docs``."""
    found = _scored(docs, model, ["doc_id"]).toDF("doc_id", "score", "content_score", "page_score")
    return found.withColumn("kept", F.col("score") >= keep)


def accepted(docs: DataFrame, model: Model, keep: float = KEEP) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the classifier keeps."""
    found = _scored(docs, model, docs.columns)
    return found.where(F.col(found.columns[-3]) >= keep).drop(*found.columns[-3:])


def op2_cotrain(spark, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
