"""Texts as arrays of code points: tokens, hashes and grouped sums over many texts at a time.

Helpers that run inside tasks.  A task's batch is cut into blocks of whole
texts; each block is one array with a mark before and after every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

LETTER, NUMBER, OTHER, SPACE, MARK = range(5)
#: The white space of the word rules: blank and the controls 9 to 13.
WORD_SPACE = np.array([9, 10, 11, 12, 13, 32], dtype=np.uint32)
_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Block:
    """``text`` is all texts joined, each with a mark before it and one at the end; text i is [begins[i], ends[i])."""

    text: str
    codes: np.ndarray
    begins: np.ndarray
    ends: np.ndarray

    @property
    def marks(self) -> np.ndarray:
        return np.append(self.begins - 1, len(self.codes) - 1)


def block(texts: list[str]) -> Block:
    joined = "\0" + "\0".join(texts) + "\0" if texts else "\0"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    begins = 1 + np.concatenate([[0], np.cumsum(lengths + 1)])[:-1].astype(np.int64)
    return Block(joined, codes, begins, begins + lengths)


def blocks(texts: list[str | None], size: int = 1 << 20) -> Iterator[tuple[int, Block]]:
    """(place of its first text, block) for runs of whole texts of about ``size`` code points; null counts as empty."""
    first, total = 0, 0
    for i, text in enumerate(texts):
        if i > first and total + len(text or "") > size:
            yield first, block([t or "" for t in texts[first:i]])
            first, total = i, 0
        total += len(text or "")
    if first < len(texts):
        yield first, block([t or "" for t in texts[first:]])


@cache
def class_table() -> np.ndarray:
    """The class of each code point, as the pattern of the public tokenizers tells them apart."""
    import regex

    points = np.arange(0x110000, dtype=np.uint32)
    everything = "".join(map(chr, points.tolist()))
    table = np.full(len(points), OTHER, dtype=np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for run in regex.finditer(pattern, everything):
            table[run.start():run.end()] = kind
    return table


def word_spans(part: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, words per text) of the runs without white space of the word rules."""
    gap = (part.codes == 32) | ((part.codes >= 9) & (part.codes <= 13))
    gap[part.marks] = True
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1  # the first and the last code are marks
    starts, ends = edges[::2], edges[1::2]
    return starts, ends, np.searchsorted(starts, part.ends) - np.searchsorted(starts, part.begins)


def places_in_runs(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... within each of consecutive runs of these lengths."""
    before = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(before, lengths)


def ragged(values: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs values[offset : offset + length], one after the other."""
    return values[np.repeat(offsets, lengths) + places_in_runs(lengths)]


_powers = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        powers = np.full(1 << int(n).bit_length(), _BASE, dtype=np.uint64)
        powers[0] = 1
        _powers = np.cumprod(powers, dtype=np.uint64)
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit of its input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of code points; spans are not empty."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    at = places_in_runs(lengths)
    inside = codes[np.repeat(starts, lengths) + at].astype(np.uint64)
    inside *= np.uint64(0xD6E8FEB86659FD93)
    inside ^= inside >> np.uint64(32)
    inside *= _powers_to(int(lengths.max()))[at]
    sums = np.add.reduceat(inside, np.cumsum(lengths) - lengths)
    return mixed(sums + lengths.astype(np.uint64))


def distinct_spans(part: Block, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of one span of each kind, kind of each span): equal texts, equal kind; exact.

    Spans are told apart by a hash, and then compared with the first of their
    kind; a span that differs from it gets a kind of its own.
    """
    hashes = span_hashes(part.codes, starts, ends)
    _, first, kind = np.unique(hashes, return_index=True, return_inverse=True)
    lengths, twin = ends - starts, starts[first][kind]
    same = (ends - starts) == (ends[first] - starts[first])[kind]
    if same.all():
        at = places_in_runs(lengths)
        differs = part.codes[np.repeat(starts, lengths) + at] != part.codes[np.repeat(twin, lengths) + at]
        if differs.any():
            same[np.repeat(np.arange(len(starts)), lengths)[differs]] = False
    odd = np.flatnonzero(~same)
    if len(odd):
        kind = kind.copy()
        kind[odd] = len(first) + np.arange(len(odd))
        first = np.concatenate([first, odd])
    return first, kind
