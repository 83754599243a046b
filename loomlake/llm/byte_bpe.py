"""Byte-level BPE through a sentencepiece model written straight from a rank file.

Each of the 256 bytes stands for one printable code point, so every ranked byte string is a piece of ordinary text.
The pieces go into a BPE model with score ``-rank`` and identity normalisation (no prefix, no blank handling); the
highest score merges first, leftmost on ties, which is the order of the ranks. Pre-tokens come from the public
pattern; one that is itself a ranked string is that one token, the rest go through the model. Decoding looks up the
pieces of the ids and maps their code points back to bytes.

Defined results: null text is empty text with no tokens; an empty table gives an empty result; exact repeats give
equal rows; extra columns are ignored by :func:`digests` and kept by :func:`encoded`. Text of any length is encoded
whole: a pre-token is the longest thing that is held apart from the text itself.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import struct
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._shared import documents, pieces, small_batches

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: White space as the White_Space property has it; the regex module's \s differs on U+001C to U+001F.
WHITE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Pre-tokens whose ids are remembered in a worker, in each of two generations: when one is full, the younger takes over what
#: it meets again from the older. The results are the same whatever is remembered.
REMEMBERED = 100_000


def byte_letters() -> list[str]:
    """The code point of each byte: printable Latin-1 stands for itself, the others follow from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    moved = {b: chr(0x100 + i) for i, b in enumerate(others)}
    return [moved.get(b, chr(b)) for b in range(256)]


def read_ranks(body: bytes) -> list[bytes]:
    """The byte strings of a rank file in rank order."""
    rows = [line.split() for line in body.splitlines() if line]
    ranked = {int(rank): base64.b64decode(token) for token, rank in rows}
    if sorted(ranked) != list(range(len(ranked))) or not {bytes([b]) for b in range(256)} <= set(ranked.values()):
        raise ValueError("ranks must be gapless from 0 and hold all single bytes")
    return [ranked[i] for i in range(len(ranked))]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int | float) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialise_model(ranked: list[bytes]) -> bytes:
    """A sentencepiece ModelProto whose piece i is ranked[i]; the unknown piece, which never matches, comes last."""
    letters = byte_letters()
    normal, unknown, bpe = 1, 2, 2  # SentencePiece.Type and TrainerSpec.ModelType
    out = [_field(1, _field(1, "".join(letters[b] for b in token).encode()) + _field(2, -float(rank)) + _field(3, normal)) for rank, token in enumerate(ranked)]
    out.append(_field(1, _field(1, b" unknown ") + _field(2, -float(len(ranked))) + _field(3, unknown)))
    size = len(ranked) + 1
    absent = (1 << 64) - 1
    out.append(_field(2, _field(3, bpe) + _field(4, size) + _field(40, size - 1) + b"".join(_field(n, absent) for n in (41, 42, 43)) + _field(45, b" unknown ")))
    out.append(_field(3, _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)))
    return b"".join(out)


class ByteBpe:
    """Encodes and decodes by the ranks; remembers the codes of pre-tokens it has seen."""

    def __init__(self, ranks: bytes, pattern: str):
        ranked = read_ranks(ranks)
        self.rank = {token: i for i, token in enumerate(ranked)}
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise_model(ranked))
        self.split = regex.compile(pattern.replace(r"[^\s", rf"[^{WHITE}").replace(r"(?!\S)", rf"(?![^{WHITE}])").replace(r"\s", f"[{WHITE}]")).findall
        self.letters = "".join(byte_letters())
        back = {c: b for b, c in enumerate(self.letters)}
        self.token_bytes = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(ranked))]
        self.told = pa.array([b"%d," % i for i in range(len(ranked))], pa.large_binary())
        self.meant = pa.array(self.token_bytes, pa.large_binary())
        self.codes: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, found: set[str]) -> None:
        """Have the ids (int32) of these pre-tokens ready."""
        new = found.difference(self.codes)
        if len(self.codes) + len(new) > REMEMBERED:
            self.older, self.codes, new = self.codes, {}, found
        rest, letters = [], []
        for piece in new:
            if (code := self.older.get(piece)) is None:
                raw = piece.encode()
                if (rank := self.rank.get(raw)) is None:
                    rest.append(piece)
                    letters.append(codecs.charmap_decode(raw, "strict", self.letters)[0])
                    continue
                code = array("i", (rank,)).tobytes()
            self.codes[piece] = code
        for piece, ids in zip(rest, self.model.encode(letters, out_type=int, num_threads=1) if rest else (), strict=True):
            self.codes[piece] = array("i", ids).tobytes()

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin (and the last one's end)."""
        found = [self.split(x) for x in texts]
        self.learn(set().union(*found))
        codes = [b"".join(map(self.codes.__getitem__, x)) for x in found]
        return np.frombuffer(b"".join(codes), "i4"), np.cumsum([0, *(len(x) // 4 for x in codes)])

    def encode(self, text: str) -> list[int]:
        return self.ids([text])[0].tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids))


def strung(rows: pa.LargeBinaryArray, ids: np.ndarray, starts: np.ndarray) -> list[memoryview]:
    """For each text the rows of its ids, put together."""
    taken = rows.take(pa.array(ids))
    ends = np.frombuffer(taken.buffers()[1], "i8")[starts] if len(ids) else starts
    body = memoryview(taken.buffers()[2] or b"").cast("B")
    return [body[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


_made: dict[bytes, ByteBpe] = {}


def shared_encoder(ranks: bytes, pattern: str) -> ByteBpe:
    """One encoder for each vocabulary in a worker process."""
    key = hashlib.sha256(ranks + pattern.encode()).digest()
    if key not in _made:
        _made[key] = ByteBpe(ranks, pattern)
    return _made[key]


def _vocabulary(path: str | None, pattern: str | None) -> tuple[bytes, str]:
    import public_tokenizers

    with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
        return f.read(), pattern or public_tokenizers.PATTERN


DIGESTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def digests(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded bytes for each document."""
    small_batches(docs.sparkSession)
    ranks, pattern = _vocabulary(path, pattern)
    ranks = docs.sparkSession.sparkContext.broadcast(ranks)  # a fixed file of under 1 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared_encoder(ranks.value, pattern)
        for batch in pieces(batches):
            ids, starts = bpe.ids([x or "" for x in batch.column("text").to_pylist()])
            told = [hashlib.sha256(x[:-1]).hexdigest() for x in strung(bpe.told, ids, starts)]  # without the last comma
            decoded = [hashlib.sha256(x).hexdigest() for x in strung(bpe.meant, ids, starts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(starts)), pa.array(told), pa.array(decoded)], names=DIGESTS.names)

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, DIGESTS)


def encoded(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Every column of ``docs`` but text, then token_ids (array<int>), n_tokens, and round_trip: decoding gives the text.

    The three new names replace columns of ``docs`` that clash with them.
    """
    small_batches(docs.sparkSession)
    ranks, pattern = _vocabulary(path, pattern)
    ranks = docs.sparkSession.sparkContext.broadcast(ranks)  # a fixed file of under 1 MB
    new = ("token_ids", "n_tokens", "round_trip")
    kept = [c for c in docs.columns if c not in new and c != "text"]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField("token_ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = shared_encoder(ranks.value, pattern)
        for batch in pieces(batches):
            texts = [x or "" for x in batch.column("text").to_pylist()]
            ids, starts = bpe.ids(texts)
            same = [x == t.encode() for x, t in zip(strung(bpe.meant, ids, starts), texts, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(starts.astype("i4")), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), lists, pa.array(np.diff(starts)), pa.array(same)], names=schema.names)

    return docs.select(*(docs[f"`{c}`"] for c in kept), docs["text"].cast("string")).mapInArrow(run, schema)


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(documents(spark, sf_dir))
