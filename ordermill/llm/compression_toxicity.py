"""Toxicity by compression distance: which of two zstandard dictionaries makes a window shorter?

Two dictionaries are trained on a bounded sample of labelled texts.  The toxic
one holds fragments of words that toxic texts share and ordinary texts lack,
chosen greedily until each toxic text is covered several times.  The ordinary
one holds as much ordinary text in their place.  Both also hold a common part:
ordinary words, the pieces of the fragments that ordinary words contain, and
ordinary words that gained by the toxic dictionary in an earlier round, so that
what is ordinary costs the same under both.

A window is one lower-case word between blanks, two bytes to a code point, so that short
fragments outweigh the cost of a match.  It follows a fixed lead-in that both dictionaries
know, since a block that zstandard stores uncompressed would show no difference.
The difference of the two lengths is the window's sign; a text's sign is its
largest.  A logistic curve, fitted on labelled texts kept apart from those the
dictionaries were made of, turns the sign into a score; its middle is the threshold.

Defined results: null and empty texts have the sign 0.  Without labels of both
classes there are no dictionaries and every score is 0.  Repeated rows score
alike.  Whole texts are read; other columns pass through untouched.
"""

from __future__ import annotations

import heapq
from collections import Counter, defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm import codepoints as cp

#: The lead-in of every window: bytes that no text has in this order.
LEAD = bytes(range(128, 224))
PUNCTUATION = ".,;:!?\"'()"


@dataclass(frozen=True)
class Shape:
    """Sizes of the training; none depends on the data.

    ``times``: fragments wanted for each toxic text.  ``least``: the share of toxic texts a fragment is found in.
    ``stray``: how much rarer, of its own rate, a fragment has to be in ordinary texts.
    """

    grams: tuple[int, ...] = (4, 5, 6, 7, 8)
    times: int = 8
    least: float = 0.004
    stray: float = 0.02
    common_words: int = 400
    gained_words: int = 300
    rounds: int = 3
    gain: int = 2
    fit_share: float = 0.7


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    slope: float
    middle: float


def encoded(text: str) -> bytes:
    return text.encode("utf-16-le", "surrogatepass")


class Lengths:
    """How much shorter a word gets by the toxic dictionary than by the ordinary one; remembers words, up to a bound."""

    REMEMBERED = 250_000

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        # A deep search, so that the best match is found and lengths depend on content alone.
        settings = zs.ZstdCompressionParameters.from_level(
            3, strategy=zs.STRATEGY_LAZY2, min_match=5, search_log=9, hash_log=17, chain_log=17, target_length=64,
            window_log=18, **plain)
        self._sides = []
        for content in (toxic, ordinary):
            trained = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
            trained.precompute_compress(compression_params=settings)
            self._sides.append(zs.ZstdCompressor(dict_data=trained, compression_params=settings))
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def gain(self, word: str) -> int:
        window = LEAD + encoded(f" {word} ")
        toxic, ordinary = self._sides
        return len(ordinary.compress(window)) - len(toxic.compress(window))

    def gains(self, words: list[str]) -> list[int]:
        if len(self.known) > self.REMEMBERED:
            self.known, self.older = {}, self.known
        known, older, out = self.known, self.older, []
        for word in words:
            found = known.get(word)
            if found is None:
                found = older.get(word)
                known[word] = found = self.gain(word) if found is None else found
            out.append(found)
        return out

    def signs(self, texts: list[str | None]) -> np.ndarray:
        """The largest gain of the words of each text, 0 at least."""
        out = np.zeros(len(texts), dtype=np.int64)
        for at, part in cp.blocks([(t or "").lower() for t in texts]):
            starts, ends, words = cp.word_spans(part)
            if not len(starts):
                continue
            first, kind = cp.distinct_spans(part, starts, ends)
            spans = zip(starts[first].tolist(), ends[first].tolist(), strict=True)
            gains = np.array(self.gains([part.text[a:b] for a, b in spans]), dtype=np.int64)
            full = np.flatnonzero(words)
            best = np.maximum.reduceat(gains[kind], (np.cumsum(words) - words)[full])
            out[at + full] = np.maximum(best, 0)
        return out


def _word_grams(text: str, sizes: tuple[int, ...]) -> set[str]:
    """Runs inside the words of a text; a blank stands for a word's edge."""
    found: set[str] = set()
    for word in set(text.split()):
        word = word.strip(PUNCTUATION)
        if 3 <= len(word) <= 24:
            found.add(f" {word} ")
            for n in sizes:
                found.update(word[i:i + n] for i in range(len(word) - n + 1))
                if len(word) >= n:
                    found.add(" " + word[:n])
    return found


def fragments(toxic: list[str], ordinary: list[str], shape: Shape) -> list[str]:
    """Fragments that tell toxic texts from ordinary ones, the most telling first."""
    inside, outside = Counter(), Counter()
    for text in toxic:
        inside.update(_word_grams(text, shape.grams))
    for text in ordinary:
        outside.update(_word_grams(text, shape.grams))
    least = max(3, shape.least * len(toxic))
    scale = len(toxic) / len(ordinary)
    telling = {g for g, n in inside.items() if n >= least and outside.get(g, 0) * scale <= shape.stray * n}
    del inside, outside
    where: dict[str, list[int]] = defaultdict(list)
    for i, text in enumerate(toxic):
        for gram in _word_grams(text, shape.grams) & telling:
            where[gram].append(i)
    wanted = np.full(len(toxic), shape.times)
    queue = [(-len(found), -len(gram), gram) for gram, found in where.items()]
    heapq.heapify(queue)
    chosen: list[str] = []
    while queue:
        count, length, gram = heapq.heappop(queue)
        now = int((wanted[where[gram]] > 0).sum())
        if now < least:
            continue
        if now < -count:  # others have covered some of its texts meanwhile
            heapq.heappush(queue, (-now, length, gram))
            continue
        longest = gram
        for other in sorted((g for g in telling if gram in g and len(where[g]) >= 0.9 * len(where[gram])), key=lambda g: (len(g), g)):
            longest = other if longest in other else longest
        wanted[where[gram]] -= 1
        if not any(longest.strip() in c for c in chosen):
            chosen.append(longest)
    return chosen


def _ordinary_pieces(chosen: list[str], ordinary: list[str]) -> list[str]:
    """The longest pieces of the fragments that ordinary texts contain."""
    everything = "\n".join(ordinary)
    pieces: list[str] = []
    for fragment in chosen:
        for n in range(len(fragment) - 1, 2, -1):
            for i in range(len(fragment) - n + 1):
                piece = fragment[i:i + n]
                if not any(piece in p for p in pieces) and piece in everything:
                    pieces.append(piece)
    return pieces


def _chance(signs: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """(slope, middle) of the logistic curve over signs; classes weigh the same."""
    weight = np.where(labels == 1, 0.5 / max(1, labels.sum()), 0.5 / max(1, (1 - labels).sum()))
    slope, offset = 1.0, -1.0
    for _ in range(2000):
        error = (1 / (1 + np.exp(-np.clip(slope * signs + offset, -30, 30))) - labels) * weight
        slope -= 0.5 * float((error * signs).sum() + 1e-4 * slope)
        offset -= 0.5 * float(error.sum())
    return (slope, -offset / slope) if slope > 0.05 else (0.05, float(signs.max(initial=0)) + 1)


def dictionaries(toxic: list[str], ordinary: list[str], shape: Shape) -> tuple[bytes, bytes]:
    """Contents of the toxic and of the ordinary dictionary, from lower-case texts."""
    chosen = fragments(toxic, ordinary, shape)
    content = "".join((g if g[0] == " " else " " + g) for g in reversed(chosen))
    counts = Counter(w for t in ordinary for w in set(t.split()))
    frequent = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:shape.common_words]]
    filler = (" " + " ".join(frequent))[:len(content)].ljust(len(content))
    common = " ".join(sorted(frequent)) + "\n" + "\n".join(sorted(_ordinary_pieces(chosen, ordinary)))

    def sides() -> tuple[bytes, bytes]:
        toxic_side, ordinary_side = (encoded(own + "\n" + common + " ") + LEAD for own in (content, filler))
        return toxic_side, ordinary_side

    clean = [word for word in counts if not any(g.strip() in word for g in chosen)]
    for _ in range(shape.rounds):
        lengths = Lengths(*sides())
        gained = sorted((gain, word) for word in clean if (gain := lengths.gain(word)) >= shape.gain)
        if not gained:
            break
        common += " " + " ".join(word for _, word in gained[::-1][:shape.gained_words])
    return sides()


def train(texts: list[str], labels: list[int], shape: Shape = Shape()) -> Model | None:
    """The curve comes from texts that its dictionaries did not see; the dictionaries of the model are made of all."""
    if len(set(labels)) < 2:
        return None
    texts = [t.lower() for t in texts]
    split = {c: [t for t, own in zip(texts, labels, strict=True) if own == c] for c in (0, 1)}
    cut = {c: max(1, round(shape.fit_share * len(split[c]))) for c in split}
    kept = {c: split[c][cut[c]:] or split[c] for c in split}
    trial = Lengths(*dictionaries(split[1][:cut[1]], split[0][:cut[0]], shape))
    signs = trial.signs(kept[0] + kept[1]).astype(float)
    slope, middle = _chance(signs, np.array([0] * len(kept[0]) + [1] * len(kept[1])))
    return Model(*dictionaries(split[1], split[0], shape), slope, middle)


_lengths: dict[bytes, Lengths] = {}


def scores(texts: list[str | None], model: Model | None) -> np.ndarray:
    if model is None:
        return np.zeros(len(texts))
    if model.toxic not in _lengths:
        _lengths.clear()  # one model at a time in a worker
        _lengths[model.toxic] = Lengths(model.toxic, model.ordinary)
    signs = _lengths[model.toxic].signs(texts)
    return 1 / (1 + np.exp(-np.clip(model.slope * (signs - model.middle), -30, 30)))


class Scorer:
    """Scores a text column by a trained model, which is broadcast; its dictionaries are some kilobytes."""

    def __init__(self, spark: SparkSession, model: Model | None) -> None:
        sent = spark.sparkContext.broadcast(model)

        @F.arrow_udf(T.DoubleType())
        def score(texts: pa.Array) -> pa.Array:
            return pa.array(scores(texts.to_pylist(), sent.value), pa.float64())

        self._score = score

    def score(self, text: Column) -> Column:
        return self._score(text)
