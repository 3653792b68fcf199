"""Supervised subword embeddings: a text's class from the mean of hashed word and character n-gram vectors.

Each word is a feature, so is each run of 3 to 5 code points of the word between
marks for its start and end, and so is each pair of neighbouring words, where a
word that only repeats the one before it makes the same pair whatever the word.
Features are hashed into a fixed number of vectors.  A text is the mean over all features of all its words.  A softmax over
two classes is trained on it by stochastic gradient descent, in numpy, on a
bounded sample on the driver.

Afterwards the classes differ by one number per vector, so scoring adds up one
number per feature.  Words that come again in a block of texts are hashed once.

Defined results: null and empty texts have no features and score what the bias
says; without labels of both classes every text scores 0.5.  Repeated rows
score alike.  Whole texts are read; other columns pass through untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.llm import codepoints as cp


@dataclass(frozen=True)
class Shape:
    """Sizes of the model and of its training; none depends on the data."""

    buckets: int = 1 << 18
    grams: tuple[int, ...] = (3, 4, 5)
    dims: int = 8
    epochs: int = 6
    rate: float = 0.5
    seed: int = 11


@dataclass
class Model:
    shape: Shape
    #: By feature, how much it speaks for class 1.
    weights: np.ndarray
    bias: float


def word_features(part: cp.Block, starts: np.ndarray, ends: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(features of the words one after the other, features per word)."""
    lengths = ends - starts
    inner = cp.ragged(part.codes, starts, lengths)
    # Each word between two marks that no text holds in a word.
    wide = lengths + 2
    first = np.cumsum(wide) - wide
    codes = np.full(int(wide.sum()), 32, dtype=np.uint64)
    codes[np.repeat(first + 1, lengths) + cp.places_in_runs(lengths)] = inner
    codes[first + wide - 1] = 10
    spread = cp.mixed(codes + np.uint64(1))
    word = cp.span_hashes(part.codes, starts, ends)
    columns = [(word, np.ones(len(starts), dtype=np.int64))]
    for n in shape.grams:
        counts = np.maximum(wide - n + 1, 0)
        at = np.repeat(first, counts) + cp.places_in_runs(counts)
        value = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            value = (value ^ spread[at + k]) * np.uint64(0x9E3779B97F4A7C15)
        columns.append((cp.mixed(value), counts))
    counts = np.sum([c for _, c in columns], axis=0)
    out = np.empty(int(counts.sum()), dtype=np.int64)
    place = np.cumsum(counts) - counts
    for values, each in columns:
        out[np.repeat(place, each) + cp.places_in_runs(each)] = (values % np.uint64(shape.buckets)).astype(np.int64)
        place = place + each
    return out, counts


def pair_features(part: cp.Block, starts: np.ndarray, first: np.ndarray, kind: np.ndarray, ends: np.ndarray,
                  words: np.ndarray, shape: Shape) -> np.ndarray:
    """A feature for each word: its pair with the word before it in the text, or -1 for the first word."""
    word = cp.span_hashes(part.codes, starts[first], ends[first])[kind]
    pair = np.full(len(word), -1, dtype=np.int64)
    value = cp.mixed(word[:-1] * np.uint64(3) + word[1:])
    value[kind[1:] == kind[:-1]] = 0
    pair[1:] = (value % np.uint64(shape.buckets)).astype(np.int64)
    pair[(np.cumsum(words) - words)[words > 0]] = -1
    return pair


def train(texts: list[str], labels: list[int], shape: Shape = Shape()) -> Model:
    if len(set(labels)) < 2:
        return Model(shape, np.zeros(shape.buckets, dtype=np.float32), 0.0)
    examples: list[tuple[np.ndarray, np.ndarray]] = []
    for _, part in cp.blocks(texts):
        starts, ends, words = cp.word_spans(part)
        first, kind = cp.distinct_spans(part, starts, ends) if len(starts) else (starts, starts)
        features, counts = word_features(part, starts[first], ends[first], shape)
        pairs = pair_features(part, starts, first, kind, ends, words, shape) if len(starts) else starts
        offsets = np.cumsum(counts) - counts
        at = 0
        for n in words.tolist():
            own, linked = kind[at:at + n], pairs[at + 1:at + n]
            at += n
            found, times = np.unique(
                np.concatenate([cp.ragged(features, offsets[own], counts[own]), linked]), return_counts=True)
            examples.append((found.astype(np.int32), (times / max(1, times.sum())).astype(np.float32)))
    random = np.random.default_rng(shape.seed)
    vectors = random.uniform(-1, 1, (shape.buckets, shape.dims)).astype(np.float32) / shape.dims
    output = np.zeros((shape.dims, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    share = np.bincount(labels, minlength=2) / len(labels)
    step, steps = 0, shape.epochs * len(examples)
    for _ in range(shape.epochs):
        for i in random.permutation(len(examples)):
            found, mean = examples[i]
            rate = np.float32(shape.rate * (1 - step / steps) * 0.5 / share[labels[i]])
            step += 1
            hidden = mean @ vectors[found]
            scores = hidden @ output + bias
            chance = np.exp(scores - scores.max())
            chance /= chance.sum()
            chance[labels[i]] -= 1
            back = output @ chance
            output -= rate * np.outer(hidden, chance)
            bias -= rate * chance * np.float32(0.1)
            # A mean over thousands of features moves each by little: steps are those of the sum of a few.
            vectors[found] -= np.outer(mean * rate * np.float32(len(found) ** 0.5), back)
    toward = (output[:, 1] - output[:, 0]).astype(np.float32)
    return Model(shape, vectors @ toward, float(bias[1] - bias[0]))


def scores(texts: list[str | None], model: Model) -> np.ndarray:
    """The chance of class 1 for each text."""
    out = np.empty(len(texts))
    for at, part in cp.blocks(texts):
        starts, ends, words = cp.word_spans(part)
        logit = np.zeros(len(words))
        if len(starts):
            first, kind = cp.distinct_spans(part, starts, ends)
            features, counts = word_features(part, starts[first], ends[first], model.shape)
            weight = np.add.reduceat(model.weights[features].astype(np.float64), np.cumsum(counts) - counts)
            pairs = pair_features(part, starts, first, kind, ends, words, model.shape)
            linked = pairs >= 0
            value = weight[kind] + np.where(linked, model.weights[pairs], 0)
            full = np.flatnonzero(words)
            begin = (np.cumsum(words) - words)[full]
            logit[full] = np.add.reduceat(value, begin) / np.add.reduceat(counts[kind] + linked, begin)
        out[at:at + len(words)] = 1 / (1 + np.exp(-np.clip(logit + model.bias, -30, 30)))
    return out


class Scorer:
    """Scores a text column by a trained model, which is broadcast; its size is that of ``Shape``."""

    def __init__(self, spark: SparkSession, model: Model) -> None:
        sent = spark.sparkContext.broadcast(model)

        @F.arrow_udf(T.DoubleType())
        def score(texts: pa.Array) -> pa.Array:
            return pa.array(scores(texts.to_pylist(), sent.value), pa.float64())

        self._score = score

    def score(self, text: Column) -> Column:
        return self._score(text)
