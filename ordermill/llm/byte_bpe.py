"""Byte-level BPE: texts to token ids and back, by the ranks of a public vocabulary.

A text is cut into pre-tokens by the classes of its code points, which gives the
matches of the tokenizers' pattern (tested against it).  Each distinct
pre-token is then looked up in two tiers.  First, a minimal perfect hash over
the vocabulary answers for pre-tokens that are tokens themselves: levels of bit
arrays, a key being settled at the first level where no other key shares its
bit, and the rank of that bit being its index; the key found there is compared.
Second, other pre-tokens are merged: their bytes form a linked list, and a heap
gives the pair of neighbours with the smallest rank, leftmost first.

Each worker keeps the ids of pre-tokens seen before, up to a bound; the bound
costs time only.  The driver reads the vocabulary (about one megabyte, its size
does not depend on the data) and broadcasts it.

Defined results: a null text is treated as empty; an empty text has no ids.
Repeated rows are encoded one by one.  Special tokens are plain text.  Other
columns pass through untouched; ids are packed little-endian, four bytes each.
"""

from __future__ import annotations

import base64
import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm import codepoints as cp

#: The contractions that the pattern takes off on their own.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_MASK = (1 << 64) - 1


class PerfectHash:
    """A minimal perfect hash of byte strings: each key has an index of its own below their number."""

    GAMMA = 2.0

    def __init__(self, keys: list[bytes]) -> None:
        hashes = np.array([xxhash.xxh3_64_intdigest(key) for key in keys], dtype=np.uint64)
        left = np.arange(len(keys))
        self.levels: list[tuple[int, int, bytes, list[int]]] = []
        self.index = np.zeros(len(keys), dtype=np.int64)
        settled = 0
        while len(left):
            size = max(8, int(self.GAMMA * len(left)))
            factor = (2 * len(self.levels) + 1) * 0x9E3779B97F4A7C15 & _MASK
            at = ((hashes[left] * np.uint64(factor)) >> np.uint64(20)) % np.uint64(size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            rank = settled + np.cumsum(alone) - alone
            mine = alone[at.astype(np.int64)]
            self.index[left[mine]] = rank[at[mine].astype(np.int64)]
            self.levels.append((size, factor, alone.astype(np.uint8).tobytes(), rank.tolist()))
            settled += int(alone.sum())
            left = left[~mine]

    def find(self, key: bytes) -> int:
        """The index of a key; for other strings any index, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        for size, factor, alone, rank in self.levels:
            at = ((h * factor & _MASK) >> 20) % size
            if alone[at]:
                return rank[at]
        return -1


@dataclass
class Vocabulary:
    """Tokens by id, their ranks, and the perfect hash with the key and id at each index."""

    tokens: list[bytes]
    ranks: dict[bytes, int]
    perfect: PerfectHash = field(repr=False)
    keys: list[bytes] = field(repr=False)
    ids: list[int] = field(repr=False)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        """A rank file: on each line a token in base64 and its id."""
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        listed = list(ranks)
        perfect = PerfectHash(listed)
        keys = [b""] * len(listed)
        for token, index in zip(listed, perfect.index.tolist(), strict=True):
            keys[index] = token
        return cls(tokens, ranks, perfect, keys, [ranks[key] for key in keys])

    def whole(self, piece: bytes) -> int | None:
        index = self.perfect.find(piece)
        return self.ids[index] if index >= 0 and self.keys[index] == piece else None


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the pair with the smallest rank is joined, leftmost first, until no pair is a token."""
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that begins here ends; 0: no part begins here
    before = list(range(-1, n - 1))
    heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two parts has gone or grown
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (rank := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if i and (rank := ranks.get(piece[before[i]:stop])) is not None:
            heapq.heappush(heap, (rank, before[i], stop))
    return [ranks[piece[i:end[i]]] for i in range(n) if end[i]]


def pretoken_spans(part: cp.Block) -> tuple[np.ndarray, np.ndarray]:
    """Where the pre-tokens of a block start and end."""
    codes, size = part.codes, len(part.codes)
    kind = cp.class_table()[codes]
    kind[part.marks] = cp.MARK
    start = np.empty(size, dtype=bool)
    start[0] = True
    np.not_equal(kind[1:], kind[:-1], out=start[1:])
    # The last of several blanks before other text stands alone, or joins what follows if it is a plain blank.
    last = np.flatnonzero((kind[:-1] == cp.SPACE) & (kind[1:] < cp.SPACE))
    start[last] = True
    start[last[codes[last] == 32] + 1] = False
    # An apostrophe where a pre-token starts takes one or two letters with it.
    quotes = np.flatnonzero((codes == ord("'")) & start)
    quotes = quotes[quotes + 1 < size]
    if len(quotes):
        following = codes[quotes + 1]
        then = codes[np.minimum(quotes + 2, size - 1)]
        taken = np.zeros(len(quotes), dtype=np.int64)
        for text in CONTRACTIONS:
            fits = following == ord(text[1])
            if len(text) == 3:
                fits &= then == ord(text[2])
            taken[fits & (taken == 0)] = len(text)
        quotes, taken = quotes[taken > 0], taken[taken > 0]
        start[quotes + 1] = False
        start[quotes[taken == 3] + 2] = False
        after = quotes + taken
        start[after] = start[after] | (kind[after] == cp.LETTER)
    start[part.marks] = True
    starts = np.flatnonzero(start)
    ends = np.append(starts[1:], size)
    real = kind[starts] != cp.MARK
    return starts[real], ends[real]


class Encoder:
    """Texts to packed ids, with a bounded memory of pre-tokens in two generations.

    When the younger generation is full it becomes the older one, which goes;
    what is met again in the meantime is taken over.
    """

    REMEMBERED = 350_000

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def piece_ids(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "replace")
        whole = self.vocabulary.whole(raw)
        ids = merge(raw, self.vocabulary.ranks) if whole is None else [whole]
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = []
        for _, part in cp.blocks(texts):
            out += self._encode_block(part)
        return out

    def _encode_block(self, part: cp.Block) -> list[bytes]:
        starts, ends = pretoken_spans(part)
        if not len(starts):
            return [b""] * len(part.begins)
        first, kind = cp.distinct_spans(part, starts, ends)
        if len(self.known) > self.REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, text, pieces = self.known, self.older, part.text, []
        for begin, end in zip(starts[first].tolist(), ends[first].tolist(), strict=True):
            piece = text[begin:end]
            ids = known.get(piece)
            if ids is None:
                ids = known[piece] = older.get(piece) or self.piece_ids(piece)
            pieces.append(ids)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) // 4
        values = np.frombuffer(b"".join(pieces), dtype="<u4")
        counts = lengths[kind]
        ids = cp.ragged(values, (np.cumsum(lengths) - lengths)[kind], counts)
        # Ids before each text: those of all pre-tokens that start before it.
        total = np.concatenate([[0], np.cumsum(counts)])
        low, high = total[np.searchsorted(starts, part.begins)], total[np.searchsorted(starts, part.ends)]
        raw = ids.tobytes()
        return [raw[4 * a:4 * b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]


class Decoder:
    def __init__(self, vocabulary: Vocabulary) -> None:
        self.raw = np.frombuffer(b"".join(vocabulary.tokens), dtype=np.uint8)
        self.lengths = np.fromiter(map(len, vocabulary.tokens), dtype=np.int64, count=len(vocabulary.tokens))
        self.offsets = np.cumsum(self.lengths) - self.lengths

    def decode(self, packed: bytes | None) -> bytes:
        ids = np.frombuffer(packed or b"", dtype="<u4")
        return cp.ragged(self.raw, self.offsets[ids], self.lengths[ids]).tobytes()


_workers: dict[tuple[type, str], Encoder | Decoder] = {}


def _worker(kind: type, key: str, vocabulary) -> Encoder | Decoder:
    """One encoder and one decoder of a vocabulary for each Python worker."""
    if (kind, key) not in _workers:
        _workers.clear() if len(_workers) > 4 else None
        _workers[kind, key] = kind(vocabulary.value)
    return _workers[kind, key]


class Tokenizer:
    """Encodes and decodes columns; the vocabulary is read here, on the driver, and broadcast."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        vocabulary, key = spark.sparkContext.broadcast(Vocabulary.read(path)), path

        @F.arrow_udf(T.BinaryType())
        def encode(texts: pa.Array) -> pa.Array:
            return pa.array(_worker(Encoder, key, vocabulary).encode(texts.to_pylist()), pa.binary())

        @F.arrow_udf(T.BinaryType())
        def decode(packed: pa.Array) -> pa.Array:
            one = _worker(Decoder, key, vocabulary)
            return pa.array([one.decode(ids) for ids in packed.to_pylist()], pa.binary())

        self._encode, self._decode = encode, decode

    def encode(self, text: Column) -> Column:
        """Packed ids of a text."""
        return self._encode(text)

    def decode(self, packed: Column) -> Column:
        """The bytes that packed ids stand for."""
        return self._decode(packed)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids",
                     bytes_col: str = "token_bytes") -> DataFrame:
    """``docs`` with the packed ids of each text, and the bytes that these give when decoded."""
    tokenizer = Tokenizer(docs.sparkSession, path)
    packed = tokenizer.encode(F.col(text_col))
    return docs.withColumns({ids_col: packed, bytes_col: tokenizer.decode(packed)})
