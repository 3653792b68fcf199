"""Secrets in texts: three fixed patterns, and a linear-chain conditional random field that adds what they miss.

Tokens are runs of letters and digits, and single other signs.  Each is tagged
as the begin of a secret, inside one, or outside, from its shape, the words
around it and features of the whole text.  The tags of a text are decoded by
Viterbi.  Most tokens are outside by so wide a margin that no neighbour can
change it: with m the most that two transitions can favour another tag, a
token whose margin exceeds m is outside in every best path, so the chain falls
apart there and only the stretches between are decoded.  This is exact.

The field is trained on a bounded sample (``Sample``) by its likelihood, in
numpy on the driver.  Its labels are what the patterns find in these texts,
and made-up secrets of many shapes set into them beside look-alikes that are
none (``planted``), so that it learns what the patterns don't know.  Its tags
outside a secret get ``caution`` on top.  Spans of the
field that lie within those of the patterns are left to the patterns; one that
reaches further, be it into the next sign, is kept whole beside them.

Spans are (kind, start, end) in code points, end exclusive.  The kind of the
field's spans is ``field``.

Defined results: null and empty texts have no spans.  Without a sample of
texts with words the field adds nothing.  Repeated rows are scanned one by one.
Whole texts are read; other columns pass through untouched.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm import codepoints as cp
from ordermill.llm import planted

#: The patterns, with the fewest characters of the part that counts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]+")
HEX_LEAST = 24
#: In the order of spans that start together.
KINDS = ("assign", "access", "hex", "field")
#: A text without any of these, in lower case, has no assignment.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SHAPES, WORDS, FILES, TEXTURES = 512, 2048, 64, 128
BEGIN, INSIDE, OUTSIDE = range(3)
Span = tuple[str, int, int]


def pattern_spans(text: str) -> list[Span]:
    """Spans of the three patterns, by start and kind."""
    found: list[Span] = []
    lower = text.lower()
    if any(hint in lower for hint in ASSIGN_HINTS):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found, key=_order)


#: Whole runs of hexadecimal digits that are long enough; a shorter run cannot hide a longer one.
_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)


def _order(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


@dataclass
class Tokens:
    """The tokens of a block and their features; texts own consecutive tokens."""

    starts: np.ndarray
    ends: np.ndarray
    counts: np.ndarray
    features: list[np.ndarray] = field(repr=False)


def tokens(part: cp.Block) -> Tokens:
    codes = part.codes
    kind = cp.class_table()[codes]
    kind[part.marks] = cp.MARK
    joined = kind <= cp.NUMBER
    other = kind == cp.OTHER
    start = joined.copy()
    start[1:] &= ~joined[:-1]
    starts = np.flatnonzero(start | other)
    stop = joined.copy()
    stop[:-1] &= ~joined[1:]
    ends = np.flatnonzero(stop | other) + 1
    counts = np.searchsorted(starts, part.ends) - np.searchsorted(starts, part.begins)
    n = len(starts)
    if not n:
        return Tokens(starts, ends, counts, [])
    # Flags of each code point, added up over each token.
    digit = (codes >= 48) & (codes <= 57)
    upper = (codes >= 65) & (codes <= 90)
    lower = (codes >= 97) & (codes <= 122)
    hexadecimal = digit | ((codes >= 97) & (codes <= 102))

    def total(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[ends] - sums[starts]

    length = ends - starts
    digits, uppers, lowers = total(digit), total(upper), total(lower)
    bucket = np.searchsorted([2, 3, 6, 12, 18, 24, 40], length, side="right")
    shape = (bucket * 64 + (digits > 0) * 32 + (digits * 4 >= length) * 16 + (uppers > 0) * 8 + (lowers > 0) * 4
             + (total(hexadecimal) == length) * 2 + (digits + uppers + lowers < length))
    # How often a token changes between digits, capitals and small letters, and whether signs or letters touch it.
    kinds = digit + 2 * upper + 4 * lower
    changed = np.zeros(len(codes), dtype=bool)
    changed[1:] = kinds[1:] != kinds[:-1]
    changes = total(changed) - changed[starts]
    solid = np.concatenate([[False], joined | (kind == cp.OTHER), [False]])
    texture = (bucket * 16 + np.searchsorted([1, 3, 6], changes, side="right") * 4 + solid[starts] * 2 + solid[ends + 1])
    folded = codes + np.uint32(32) * upper.astype(np.uint32)
    word = 1 + (cp.span_hashes(folded, starts, ends) % np.uint64(WORDS - 1)).astype(np.int64)
    word[(digits > 0) | (length > 16)] = 0  # not words: their shape has to tell
    text = np.repeat(np.arange(len(counts)), counts)

    def neighbour(values: np.ndarray, step: int) -> np.ndarray:
        """The value ``step`` tokens on in the same text, else 0."""
        out = np.zeros(n, dtype=np.int64)
        if n > abs(step):
            near, far = (slice(-step, None), slice(None, step)) if step < 0 else (slice(None, -step), slice(step, None))
            out[near] = np.where(text[near] == text[far], values[far], 0)
        return out

    # Of the whole text: how common tokens with digits are, how common equals signs, how long lines are.
    full = np.maximum(counts, 1)
    share = np.bincount(text, weights=digits > 0, minlength=len(counts)) / full
    equals = np.bincount(text, weights=codes[starts] == 61, minlength=len(counts)) / full
    lines = np.bincount(np.searchsorted(part.begins, np.flatnonzero(codes == 10), side="right") - 1,
                        minlength=len(counts))[:len(counts)] + 1
    traits = (np.searchsorted([1e-9, 0.01, 0.1], share, side="right") * 16
              + np.searchsorted([1e-9, 0.01, 0.1], equals, side="right") * 4
              + np.searchsorted([8, 24, 96], counts / lines))
    return Tokens(starts, ends, counts, [
        shape, SHAPES + word, SHAPES + WORDS + neighbour(word, -1), SHAPES + 2 * WORDS + neighbour(word, -2),
        SHAPES + 3 * WORDS + neighbour(word, -3), SHAPES + 4 * WORDS + neighbour(word, 1),
        SHAPES + 5 * WORDS + neighbour(shape, -1), 2 * SHAPES + 5 * WORDS + traits[text],
        TEXTURE + texture, TEXTURE + TEXTURES + neighbour(texture, 1)])


TRAITS = 2 * SHAPES + 5 * WORDS
TEXTURE = TRAITS + FILES
N_FEATURES = TEXTURE + 2 * TEXTURES


@dataclass
class Field:
    """Weights of (feature, tag) and of (tag, next tag)."""

    emission: np.ndarray
    transition: np.ndarray

    def margin(self) -> float:
        """The most by which two transitions favour another tag than OUTSIDE."""
        t = self.transition
        gains = [t[p, x] + t[x, n] - t[p, OUTSIDE] - t[OUTSIDE, n]
                 for p in range(3) for n in range(3) for x in (BEGIN, INSIDE)]
        alone = [t[p, x] - t[p, OUTSIDE] for p in range(3) for x in (BEGIN, INSIDE)]
        first = [t[x, n] - t[OUTSIDE, n] for n in range(3) for x in (BEGIN, INSIDE)]
        return float(max(0.0, *gains, *alone, *first))


def viterbi(emission: np.ndarray, transition: np.ndarray) -> list[int]:
    """The best tags of a chain; its first and last tokens have no other neighbours."""
    best, back = emission[0], []
    for row in emission[1:]:
        ways = best[:, None] + transition
        back.append(ways.argmax(axis=0))
        best = ways.max(axis=0) + row
    tags = [int(best.argmax())]
    for choice in reversed(back):
        tags.append(int(choice[tags[-1]]))
    return tags[::-1]


def decode(found: Tokens, model: Field) -> np.ndarray:
    """The tag of every token of a block."""
    n = len(found.starts)
    tags = np.full(n, OUTSIDE, dtype=np.int8)
    if not n:
        return tags
    emission = model.emission[found.features[0]]
    for column in found.features[1:]:
        emission += model.emission[column]
    open_ = emission[:, OUTSIDE] - np.maximum(emission[:, BEGIN], emission[:, INSIDE]) <= model.margin() + 1e-3
    last = np.cumsum(found.counts) - 1
    ends_text = np.zeros(n, dtype=bool)
    ends_text[last[found.counts > 0]] = True
    at = np.flatnonzero(open_)
    if not len(at):
        return tags
    breaks = np.flatnonzero((np.diff(at) > 1) | ends_text[at[:-1]]) + 1
    starts_text = np.zeros(n, dtype=bool)
    starts_text[1:] = ends_text[:-1]
    starts_text[0] = True
    for run in np.split(at, breaks):
        a, b = int(run[0]), int(run[-1]) + 1
        # The settled tokens at both sides take part, as they are outside.
        low, high = a - (not starts_text[a]), b + (not ends_text[b - 1])
        chain = emission[low:high].astype(np.float64)
        if low < a:
            chain[0, :OUTSIDE] = -1e9
        if high > b:
            chain[-1, :OUTSIDE] = -1e9
        tags[low:high] = viterbi(chain, model.transition)
    return tags


def _tag_spans(tags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    spans: list[tuple[int, int]] = []
    previous = -2
    for i in np.flatnonzero(tags != OUTSIDE).tolist():
        if spans and previous == i - 1 and tags[i] == INSIDE:
            spans[-1] = spans[-1][0], int(ends[i])
        else:
            spans.append((int(starts[i]), int(ends[i])))
        previous = i
    return spans


def _reaches_beyond(text: str, span: Span, fixed: list[Span]) -> bool:
    """If more of a span than spaces lies outside the spans of the patterns, which are by start."""
    _, at, stop = span
    for _, start, end in fixed:
        if text[at:min(start, stop)].strip():
            return True
        at = max(at, end)
    return bool(text[at:stop].strip())


def scan(texts: list[str | None], model: Field | None) -> list[list[Span]]:
    """All spans of each text, by start and kind."""
    out: list[list[Span]] = []
    for _, part in cp.blocks(texts):
        fixed = [pattern_spans(part.text[a:b]) for a, b in zip(part.begins.tolist(), part.ends.tolist(), strict=True)]
        if model is not None:
            found = tokens(part)
            tags = decode(found, model)
            stop = np.cumsum(found.counts)
            for i in np.unique(np.searchsorted(stop, np.flatnonzero(tags != OUTSIDE), side="right")).tolist():
                own = slice(stop[i] - found.counts[i], stop[i])
                begin = int(part.begins[i])
                added = [("field", a - begin, b - begin) for a, b in _tag_spans(tags[own], found.starts[own], found.ends[own])]
                whole = part.text[begin:int(part.ends[i])]
                added = [x for x in added if _reaches_beyond(whole, x, fixed[i])]
                fixed[i] = sorted(fixed[i] + added, key=_order)
        out += fixed
    return out


def redact(text: str, spans: list[Span], mark: str) -> str:
    """The text with each stretch of overlapping spans replaced by a mark."""
    pieces, at = [], 0
    for _, start, end in spans:
        if start >= at:
            pieces += [text[at:start], mark]
        at = max(at, end)
    return "".join(pieces) + text[at:] if spans else text


# --- training ---


@dataclass(frozen=True)
class Sample:
    """What the field is trained on: this many texts with a hint of a secret, and this many of all texts."""

    hinted: int = 400
    plain: int = 400
    max_chars: int = 30_000
    #: Tokens of a training chain, and chains without a secret for each one with.
    chain: int = 24
    outside: int = 4
    rounds: int = 16
    batch: int = 256
    rate: float = 0.2
    #: Penalties on weights over the whole sample, greater on words, so that unknown names don't speak against a secret.
    decay: float = 0.3
    word_decay: float = 6.0
    #: The greatest weight of a transition: the smaller, the more tokens are settled without their neighbours.
    transition: float = 1.0
    seed: int = 5
    #: Secrets set into each text, beside twice as many look-alikes, and the kinds they are of.
    planted_each: int = 3
    kinds: tuple[str, ...] = tuple(planted.SECRETS)
    #: Log odds that a token has to be a secret's by, beyond what was learned: planted texts hold more secrets than others.
    caution: float = 0.5


@dataclass
class _Labelled:
    """A training text: its secrets, and places to cut chains around beside them; None for those found by shape."""

    text: str
    secrets: list[tuple[int, int]]
    centres: list[int] | None = None


def _training_texts(texts: list[str], sample: Sample) -> list[_Labelled]:
    found = []
    for text in texts:
        # Of an assignment the secret itself, without the name it is assigned to.
        found.append(_Labelled(text, [
            (ASSIGN.match(text, a).start(2) if kind == "assign" else a, b) for kind, a, b in pattern_spans(text)]))
    for text, a, b, secret in planted.examples(texts, sample.planted_each, sample.seed, sample.kinds):
        found.append(_Labelled(text, [(a, b)] if secret else [], [a]))
    return found


def _chains(texts: list[str], sample: Sample) -> tuple[np.ndarray, np.ndarray]:
    """(features, tags) of chains of tokens: around secrets and look-alikes, around other digits, and elsewhere."""
    random = np.random.default_rng(sample.seed)
    features, tags = [], []
    labelled = _training_texts(texts, sample)
    for at, part in cp.blocks([x.text for x in labelled]):
        found = tokens(part)
        stop = np.cumsum(found.counts)
        for i, a in enumerate(part.begins.tolist()):
            n = int(found.counts[i])
            if n < sample.chain:
                continue
            own = slice(stop[i] - n, stop[i])
            starts, ends = found.starts[own] - a, found.ends[own] - a
            one = labelled[at + i]
            label = np.full(n, OUTSIDE)
            for start, end in one.secrets:
                inside = np.flatnonzero((starts >= start) & (ends <= end))
                label[inside] = INSIDE
                label[inside[:1]] = BEGIN
            table = np.stack([column[own] for column in found.features], axis=1)
            if one.centres is None:
                hits = np.flatnonzero(label == BEGIN)
                digits = np.flatnonzero((table[:, 0] & 32 > 0) & (label == OUTSIDE))
                centres = np.concatenate([hits, digits[:8], random.integers(0, n, sample.outside * max(1, len(hits)))])
            else:
                centres = np.clip(np.searchsorted(starts, one.centres), 0, n - 1)
            for centre in centres[:64]:
                low = int(np.clip(centre - random.integers(2, sample.chain - 2), 0, n - sample.chain))
                features.append(table[low:low + sample.chain])
                tags.append(label[low:low + sample.chain])
    if not tags:
        return np.zeros((0, sample.chain, 10), dtype=np.int64), np.zeros((0, sample.chain), dtype=np.int64)
    known, tags = np.array(features), np.array(tags)
    # Once more with the words unknown, so that shapes and the text have to tell as well.
    unknown = known.copy()
    unknown[:, :, 1:6] = SHAPES + WORDS * np.arange(5)
    return np.concatenate([known, unknown]), np.concatenate([tags, tags])


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (np.log(np.exp(x - top).sum(axis=axis, keepdims=True)) + top).squeeze(axis)


def _expected(emission: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chance of each tag at each token, expected number of each transition) over all chains, by forward and backward sums."""
    n, length, _ = emission.shape
    forward, backward = np.zeros_like(emission), np.zeros_like(emission)
    forward[:, 0] = emission[:, 0]
    for t in range(1, length):
        forward[:, t] = emission[:, t] + _log_sum(forward[:, t - 1, :, None] + transition, 1)
    for t in range(length - 2, -1, -1):
        backward[:, t] = _log_sum(transition + (emission[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
    whole = _log_sum(forward[:, -1], 1)[:, None, None]
    chance = np.exp(forward + backward - whole)
    moves = np.zeros((3, 3))
    for t in range(1, length):
        moves += np.exp(forward[:, t - 1, :, None] + transition + (emission[:, t] + backward[:, t])[:, None, :] - whole).sum(axis=0)
    return chance, moves


def train(texts: list[str], sample: Sample = Sample()) -> Field | None:
    """A field that maximises the likelihood of the tags, less a penalty on weights; None where there is no text to learn from."""
    features, tags = _chains(texts, sample)
    if not (tags == BEGIN).any():
        return None
    n, length = tags.shape
    emission, transition = np.zeros((N_FEATURES, 3)), np.zeros((3, 3))
    decay = np.full((N_FEATURES, 1), sample.decay)
    decay[SHAPES:SHAPES + 5 * WORDS] = sample.word_decay
    squares = [np.full_like(emission, 1e-2), np.full_like(transition, 1e-2)]
    random = np.random.default_rng(sample.seed)
    for _ in range(sample.rounds):
        for some in np.array_split(random.permutation(n), max(1, n // sample.batch)):
            flat, truth = features[some].reshape(-1, features.shape[-1]), tags[some]
            moves = np.bincount((truth[:, :-1] * 3 + truth[:, 1:]).ravel(), minlength=9).reshape(3, 3)
            chance, expected = _expected(emission[flat].sum(axis=1).reshape(len(some), length, 3), transition)
            error = (np.eye(3)[truth] - chance).reshape(-1, 3)
            push = np.stack([
                np.bincount(flat.ravel(), weights=np.repeat(error[:, tag], flat.shape[1]), minlength=N_FEATURES)
                for tag in range(3)], axis=1)
            for weights, gradient, square, shrink in zip(
                    (emission, transition), (push, moves - expected), squares, (decay, sample.decay), strict=True):
                gradient = gradient - shrink * len(some) / n * weights
                square += gradient**2
                weights += sample.rate * gradient / np.sqrt(square)
            np.clip(transition, -sample.transition, sample.transition, out=transition)
    emission[TRAITS:TEXTURE, OUTSIDE] += sample.caution  # every token has one of these features
    return Field(emission.astype(np.float32), transition)


def secret_sample(docs: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """A bounded sample of texts, chosen by a hash of their ids; only hashes are sorted, texts of the chosen are read again."""
    text = F.col("text")
    rows = docs.select(F.xxhash64(id_col, text_col).alias("order"), F.col(text_col).alias("text")).filter(
        text.isNotNull() & (F.length(text) <= sample.max_chars))
    hint = text.contains("AKIA")
    for word in ASSIGN_HINTS:
        hint = hint | text.contains(word)
    chosen = rows.filter(hint).select("order").orderBy("order").limit(sample.hinted).unionByName(
        rows.select("order").orderBy("order").limit(sample.plain)).distinct()
    found = rows.join(F.broadcast(chosen), "order").groupBy("order").agg(F.min("text").alias("text")).collect()
    return [r["text"] for r in sorted(found, key=lambda r: r["order"])]


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))


class Scanner:
    """Scans text columns with the patterns and a trained field, which is broadcast; its size is fixed."""

    def __init__(self, spark: SparkSession, model: Field | None, mark: str = "<secret>") -> None:
        sent = spark.sparkContext.broadcast(model)

        @F.arrow_udf(SPANS)
        def spans(texts: pa.Array) -> pa.Array:
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
            rows = [[{"kind": k, "start": a, "end": b} for k, a, b in found] for found in scan(texts.to_pylist(), sent.value)]
            return pa.array(rows, kind)

        @F.arrow_udf(T.StringType())
        def cleaned(texts: pa.Array) -> pa.Array:
            given = texts.to_pylist()
            found = scan(given, sent.value)
            return pa.array([t if t is None else redact(t, s, mark) for t, s in zip(given, found, strict=True)], pa.string())

        self._spans, self._cleaned = spans, cleaned

    def spans(self, text: Column) -> Column:
        return self._spans(text)

    def redacted(self, text: Column) -> Column:
        return self._cleaned(text)


def scanner(docs: DataFrame, sample: Sample = Sample(), id_col: str = "doc_id", text_col: str = "text") -> Scanner:
    """A scanner whose field is trained on a sample of ``docs``."""
    return Scanner(docs.sparkSession, train(secret_sample(docs, sample, id_col, text_col), sample))
