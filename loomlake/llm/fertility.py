"""Quality rules by tokeniser fertility.

Each text goes through two public vocabularies: a byte-level BPE, with the vocabulary's own pattern of pre-tokens, gives
characters per token and the entropy of the tokens; a BPE with byte fallback gives the share of fallback tokens. A
document is rejected when a measure lies outside the band of its language, or of its script where the language has none.
Every measure runs over the whole text.

Characters per token are the code points in words over all tokens of the text. Entropy is measured in consecutive windows
of SPAN tokens (the last one may be shorter), each relative to log2 of its tokens, the most it can reach, and averaged by
tokens: so it tells how a text repeats itself and not how long it is. The words of the second vocabulary never join across
blanks, so a word's pieces are remembered.

Defined results: null or empty text has no words, all counts 0, base_failed and not kept; a text without tokens has
entropy 1 and no characters per token; null lang means the script's band; repeated rows give repeated rows; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._shared import documents, pieces, small_batches
from .byte_bpe import VOCABULARY, read_ranks

PIECES = "piece_bpe_32k.model"
BLANKS, SYMBOLS, WINDOW = " \t\n\x0b\f\r", "#*$%&|<>", 8
SPAN = 256
REMEMBERED = 400_000

#: language or script: (least and most characters a token, most byte-fallback share, least and most relative entropy)
BANDS: dict[str, tuple[float, float, float, float, float]] = {
    "en": (1.85, 6.0, 0.02, 0.68, 1.01),
    "de": (1.70, 6.0, 0.04, 0.68, 1.01),
    "fr": (1.60, 6.0, 0.04, 0.68, 1.01),
    "es": (1.70, 6.0, 0.04, 0.68, 1.01),
    "latin": (1.4, 7.0, 0.08, 0.30, 1.01),
    "cyrillic": (0.9, 7.0, 0.10, 0.30, 1.01),
    "greek": (0.7, 7.0, 0.20, 0.30, 1.01),
    "arabic": (0.7, 7.0, 0.30, 0.30, 1.01),
    "hebrew": (0.6, 7.0, 0.30, 0.30, 1.01),
    "indic": (0.2, 7.0, 0.80, 0.25, 1.01),
    "cjk": (0.3, 4.0, 0.70, 0.30, 1.01),
    "other": (0.2, 8.0, 0.95, 0.20, 1.01),
}
#: First and last code point of the blocks that name a script.
SCRIPTS = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xC0, 0x24F)],
    "greek": [(0x370, 0x3FF)],
    "cyrillic": [(0x400, 0x52F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF)],
    "indic": [(0x900, 0xDFF)],
    "cjk": [(0x3040, 0x30FF), (0x3400, 0x9FFF), (0xAC00, 0xD7AF)],
}


def script_of(text: str) -> str:
    """The script with most letters; "other" if there is none."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    counts = {name: sum(int(((points >= a) & (points <= b)).sum()) for a, b in blocks) for name, blocks in SCRIPTS.items()}
    best = max(counts, key=counts.get)
    return best if counts[best] else "other"


class Fertility:
    """The two vocabularies, and the pieces of words seen before."""

    def __init__(self, ranks: bytes, pattern: str, model: bytes):
        self.bpe = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(read_ranks(ranks))}, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.n_pieces, self.n_fallback = np.zeros(1 << 12, "i4"), np.zeros(1 << 12, "i4")

    def tokens(self, text: str) -> np.ndarray:
        return self.bpe.encode_to_numpy(text, disallowed_special=())

    def learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > REMEMBERED:
            self.clear()
            new = list(words)
        if not new:
            return
        n, found = len(self.ids), self.pieces.encode([w.decode() for w in new], num_threads=1)
        while n + len(new) > len(self.n_pieces):
            self.n_pieces, self.n_fallback = (np.resize(x, 2 * len(x)) for x in (self.n_pieces, self.n_fallback))
        self.n_pieces[n : n + len(new)] = np.fromiter(map(len, found), "i4", len(found))
        self.n_fallback[n : n + len(new)] = [int(self.fallback[x].sum()) if x else 0 for x in found]
        self.ids.update(zip(new, range(n, n + len(new)), strict=True))


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``counts`` values; 0 for empty runs."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def repeated_words(ids: np.ndarray, counts: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For runs of word ids: how many words lie in a window that the run has twice or more, the first included."""
    doc = np.repeat(np.arange(len(counts)), counts)
    n = len(ids) - window + 1
    if n <= 0:
        return np.zeros(len(counts), "i8")
    start = np.flatnonzero(doc[:n] == doc[window - 1 :])
    # rank doubling: equal ranks are equal runs of words within one document, without any hash
    rank, width = ids.astype("i8"), 1
    rank = np.unique(rank, return_inverse=True)[1] if rank.size and rank.max() >= 1 << 31 else rank
    alive = start
    marks = np.zeros(len(ids) + 1, "i8")
    wide = rank
    while width < window:
        pair = wide[: len(wide) - width] * np.int64(1 << 31) + wide[width:]
        wide, width = np.unique(pair, return_inverse=True)[1].astype("i8"), 2 * width
    if not len(alive):
        return np.zeros(len(counts), "i8")
    key = doc[alive].astype("i8") << 32 | wide[alive]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    at = alive[again]
    np.add.at(marks, at, 1)
    np.add.at(marks, at + window, -1)
    return sums((np.cumsum(marks[:-1]) > 0).astype("i8"), counts)


def entropies(tokens: np.ndarray, counts: np.ndarray, span: int = SPAN) -> np.ndarray:
    """Relative entropy of runs of tokens, by windows; a window of one token, and a run of none, has 1."""
    n_windows = -(-counts // span)
    of = np.repeat(np.arange(len(counts)), n_windows)
    step = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    sizes = np.minimum(counts[of] - span * step, span)
    key = np.sort(np.repeat(np.arange(len(sizes), dtype="i8"), sizes) << 32 | tokens)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, "i8")
    n = np.diff(np.concatenate([first, [len(key)]]))
    h = np.bincount(key[first] >> 32, n * np.log2(n), len(sizes))
    room = np.log2(np.maximum(sizes, 2))
    relative = np.where(sizes < 2, 1.0, (room - h / np.maximum(sizes, 1)) / room)
    return np.where(counts > 0, np.bincount(of, relative * sizes, len(counts)) / np.maximum(counts, 1), 1.0)


SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType())]
    + [T.StructField(c, T.LongType()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [T.StructField(c, T.BooleanType()) for c in ("base_failed", "kept")]
    + [T.StructField(c, T.DoubleType()) for c in ("chars_per_token", "fallback_share", "entropy")]
    + [T.StructField("band", T.StringType())]
)

_made: dict[int, Fertility] = {}


def measure(fertility: Fertility, texts: list[str], langs: list[str | None], bands: dict) -> list[np.ndarray]:
    """The columns of SCHEMA after doc_id for some documents."""
    found = [x.encode().split() for x in texts]  # on bytes: exactly the blanks \x20 \x09-\x0D
    counts = np.fromiter(map(len, found), "i8", len(found))
    chars = np.array([len(x) - sum(map(x.count, BLANKS)) for x in texts], "i8")
    symbols = np.array([sum(map(x.count, SYMBOLS)) for x in texts], "i8")
    lines = [[y for y in x.split("\n") if y.strip(BLANKS)] for x in texts]
    repeats = np.array([len(x) - len(set(x)) for x in lines], "i8")
    fertility.learn(set().union(*found))
    ids = np.fromiter((fertility.ids[w] for x in found for w in x), "i8", counts.sum())
    again = repeated_words(ids, counts)
    tokens = [fertility.tokens(x) for x in texts]
    n_tokens = np.fromiter(map(len, tokens), "i8", len(tokens))
    entropy = entropies(np.concatenate(tokens), n_tokens)
    per_token = chars / np.maximum(n_tokens, 1)
    share = sums(fertility.n_fallback[ids].astype("i8"), counts) / np.maximum(sums(fertility.n_pieces[ids].astype("i8"), counts), 1)
    names = [lang if lang in bands else script_of(text) for lang, text in zip(langs, texts, strict=True)]
    low, high, most, least, top = np.array([bands.get(x, BANDS["other"]) for x in names]).T
    inside = (per_token >= low) & (per_token <= high) & (share <= most) & (entropy >= least) & (entropy <= top)
    failed = (counts < 20) | (100 * again > 30 * counts)
    return [counts, chars, symbols, repeats, again, failed, ~failed & inside, per_token, share, entropy, names]


def judge(docs: DataFrame, bands: dict = BANDS, ranks_path: str | None = None, pieces_path: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text, lang) with the columns of SCHEMA."""
    import public_tokenizers

    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    files = []
    for name in (ranks_path or public_tokenizers.path(VOCABULARY), pieces_path or public_tokenizers.path(PIECES)):
        with open(name, "rb") as f:
            files.append(f.read())
    shipped = context.broadcast((files[0], pattern or public_tokenizers.PATTERN, files[1]))  # two fixed files of under 1 MB each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = hash(shipped.value)
        if key not in _made:
            _made[key] = Fertility(*shipped.value)
        for batch in pieces(batches, max_bytes=2 << 20):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            columns = measure(_made[key], texts, batch.column("lang").to_pylist(), bands)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c) for c in columns)], names=SCHEMA.names)

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"), docs["lang"].cast("string")).mapInArrow(run, SCHEMA)


def op4_fertility(spark, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))
