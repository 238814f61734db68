"""Quality by positive-unlabelled learning.

Trusted positives are rows labelled as good; the unlabelled set is web text as it comes,
whatever its labels. The class prior, the share of good texts among the unlabelled, is
estimated as the least ratio of unlabelled to positive texts above any score of a first
classifier (with a margin for chance). A small network is then trained to minimise the
non-negative unbiased risk: the positive part weighs by the prior, the negative part is
the unlabelled risk less what the positives among them cause, and never falls below zero.

Inputs are shares of kinds of characters, shapes of words and lines, and repetition; no
label, language, source or id. A null or empty text has zeros for all. Repeated rows are
each scored. Without trusted positives or unlabelled texts every score is one half.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField

from eclusa.llm import words as W
from eclusa.llm.frames import free_name, held_out, id_and_text, map_texts

# Rows that are learned from, at most: trusted positives, and unlabelled ones.
POSITIVES, UNLABELLED = 4_000, 6_000
HIDDEN, EPOCHS, BATCH, RATE = 16, 60, 512, 0.01
THRESHOLD = 0.7

# Kinds of bytes: each ASCII sign by itself, then letters, digits, white space and the rest.
_KIND = np.zeros(256, dtype=np.int64)
_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]
for _i, _c in enumerate(_SIGNS):
    _KIND[_c] = _i
_UPPER, _LOWER, _DIGIT, _SPACE, _LINE, _HIGH, _CONTROL = range(len(_SIGNS), len(_SIGNS) + 7)
_KIND[:32] = _CONTROL
_KIND[127] = _CONTROL
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[32], _KIND[10] = _UPPER, _LOWER, _DIGIT, _SPACE, _LINE
_KIND[128:] = _HIGH
_KINDS = len(_SIGNS) + 7


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of inputs for each text."""
    n, size = len(offsets) - 1, np.diff(offsets)
    text = np.repeat(np.arange(n), size)
    kinds = np.bincount(text * _KINDS + _KIND[data], minlength=n * _KINDS).reshape(n, _KINDS)
    bytes_ = np.maximum(size, 1)[:, None]
    shares = kinds / bytes_
    # A sign that follows another one, and one that ends a word.
    sign = _KIND[data] < len(_SIGNS)
    doubled = np.zeros(len(data), dtype=bool)
    doubled[1:] = sign[1:] & sign[:-1] & (text[1:] == text[:-1])
    found = W.scan(data, offsets)
    words = np.diff(found.first)
    per = np.maximum(words, 1)
    length = (found.end - found.start).astype(float)
    total = lambda x: np.bincount(found.text, weights=x, minlength=n)
    mean = total(length) / per
    spread = np.sqrt(np.maximum(total(length**2) / per - mean**2, 0))
    upper = data[found.start] - 65 < 26 if len(found.start) else np.zeros(0, dtype=bool)
    # Words that the text has had before, by hash, and runs of three words.
    fresh = np.zeros(n)
    threes = np.zeros(n)
    for k, into in ((1, fresh), (3, threes)):
        grams, at = W.windows(found, k)
        own = found.text[at]
        _, first = np.unique(grams + W.mix(own.astype(np.uint64)), return_index=True)
        have = np.bincount(own, minlength=n)
        into[:] = np.bincount(own[first], minlength=n) / np.maximum(have, 1)
    lines = kinds[:, _LINE] + 1
    ends = shares[:, _KIND[ord(".")]] + shares[:, _KIND[ord("!")]] + shares[:, _KIND[ord("?")]]
    rest = [
        np.bincount(text, weights=doubled, minlength=n) / bytes_[:, 0],
        mean / 10,
        spread / 10,
        total(upper.astype(float)) / per,
        total((length <= 3).astype(float)) / per,
        total((length >= 12).astype(float)) / per,
        fresh,
        threes,
        np.log1p(size) / 10,
        np.log1p(words) / 10,
        np.log1p(words / lines) / 5,
        np.log1p(words / (1 + ends * bytes_[:, 0])) / 5,
        shares[:, : len(_SIGNS)].sum(axis=1),
    ]
    # Roots spread the small shares out.
    return np.hstack([np.sqrt(shares), np.stack(rest, axis=1)])


@dataclass
class Model:
    """Inputs' means and scales, weights of the two layers, and the class prior."""

    mean: np.ndarray
    scale: np.ndarray
    w: list[np.ndarray]
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.w
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 0.5 * np.tanh(0.5 * self.logits(x)) + 0.5


def _start(x: np.ndarray, seed: int) -> Model:
    r = np.random.default_rng(seed)
    mean, scale = (x.mean(axis=0), x.std(axis=0)) if len(x) else np.zeros((2, x.shape[1]))
    w = [
        r.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)),
        np.zeros(HIDDEN),
        r.normal(0, HIDDEN**-0.5, HIDDEN),
        np.zeros(1),
    ]
    return Model(mean, np.where(scale > 1e-9, scale, 1.0), w, 0.5)


def _back(model: Model, x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
    """Gradients of the weights, from the loss's slope in each row's logit."""
    a, b, c, _ = model.w
    z = (x - model.mean) / model.scale
    h = np.tanh(z @ a + b)
    d = slope[:, None] * c * (1 - h * h)
    return [z.T @ d, d.sum(axis=0), h.T @ slope, np.array([slope.sum()])]


def _train(model: Model, epochs: int, positives: np.ndarray, unlabelled: np.ndarray, slopes, seed: int) -> None:
    r = np.random.default_rng(seed)
    m = [np.zeros_like(w) for w in model.w]
    v = [np.zeros_like(w) for w in model.w]
    t = 0
    for _ in range(epochs):
        pick = r.permutation(len(unlabelled))
        for at in range(0, len(pick), BATCH):
            xu = unlabelled[pick[at : at + BATCH]]
            xp = positives[r.integers(0, len(positives), min(BATCH, len(positives)))]
            gp, gu = slopes(model.logits(xp), model.logits(xu))
            t += 1
            for i, (p, u) in enumerate(zip(_back(model, xp, gp), _back(model, xu, gu), strict=True)):
                g = p + u + (1e-3 * model.w[i] if i in (0, 2) else 0)
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                step = m[i] / (1 - 0.9**t) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
                model.w[i] = model.w[i] - RATE * step


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def plain_slopes(p: np.ndarray, u: np.ndarray):
    """Positives against unlabelled, as if these were negative."""
    return -_sigmoid(-p) / len(p), _sigmoid(u) / len(u)


def non_negative_slopes(prior: float):
    """Slopes of the non-negative unbiased risk with logistic loss.

    Where the negative part falls below zero on a batch, its slope is turned round.
    """

    def slopes(p: np.ndarray, u: np.ndarray):
        as_negative = np.logaddexp(0, u).mean() - prior * np.logaddexp(0, p).mean()
        gp, gu = -prior * _sigmoid(-p) / len(p), _sigmoid(u) / len(u)
        less = -prior * _sigmoid(p) / len(p)
        if as_negative < 0:
            return -less, -gu
        return gp + less, gu

    return slopes


def class_prior(positives: np.ndarray, unlabelled: np.ndarray, delta: float = 0.1) -> float:
    """Greatest share of positives among the unlabelled that their scores allow.

    For every score s, prior <= P(unlabelled >= s) / P(positive >= s). The least of these
    ratios, each with a margin for its chance error, chooses s; its ratio is the estimate.
    """
    cuts = np.unique(positives)
    above = lambda x: 1 - np.searchsorted(np.sort(x), cuts) / len(x)
    p, u = above(positives), above(unlabelled)
    error = np.sqrt(np.log(4 / delta) / 2) * (len(positives) ** -0.5 + len(unlabelled) ** -0.5)
    best = int(np.argmin((u + error) / p))
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def train(positives: np.ndarray, unlabelled: np.ndarray, seed: int = 11) -> Model:
    """The prior from rows that the first classifier hasn't learned from, then the network."""
    both = np.vstack([positives, unlabelled])
    model = _start(both, seed)
    half = lambda x, k: x[np.arange(len(x)) % 2 == k]
    if min(len(positives), len(unlabelled)) < 4:
        model.w[2][:] = 0
        return model
    first = _start(both, seed)
    _train(first, EPOCHS // 2, half(positives, 0), half(unlabelled, 0), plain_slopes, seed)
    prior = class_prior(first.logits(half(positives, 1)), first.logits(half(unlabelled, 1)))
    model.prior = prior
    _train(model, EPOCHS, positives, unlabelled, non_negative_slopes(prior), seed)
    return model


def inputs(rows: DataFrame, most: int) -> np.ndarray:
    """Inputs of the whole texts of at most so many rows, by ``doc_id``; only these numbers are collected."""

    def make():
        return lambda data, offsets: [pa.array(list(features(data, offsets)))]

    made = map_texts(rows, "text", make, [StructField("inputs", ArrayType(DoubleType()))])
    made = made.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("digest"), "inputs")
    got = made.orderBy("doc_id", "digest").limit(most).select("inputs").toArrow()["inputs"].to_pylist()
    none = features(np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64))
    return np.vstack([none, *(np.array(x)[None] for x in got)])


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Learn from samples of trusted positives and of all texts, by hash of their ids.

    No label of a row that is held out is read, and of the others only the positive ones.
    """
    rows = id_and_text(documents)
    order = F.md5(F.col("doc_id").cast("string"))
    good = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    good = good.filter((F.col("y") > 0) & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    some = good.orderBy(order).limit(POSITIVES)
    # Ids alone are ranked; at most so many are broadcast.
    any_ = rows.select("doc_id").filter(F.col("doc_id").isNotNull()).distinct()
    any_ = any_.orderBy(F.md5(F.concat(F.lit("u"), F.col("doc_id").cast("string")))).limit(UNLABELLED)
    positives = inputs(rows.join(F.broadcast(some), "doc_id"), POSITIVES)
    unlabelled = inputs(rows.join(F.broadcast(any_), "doc_id"), UNLABELLED)
    return train(positives, unlabelled)


def scored(documents: DataFrame, model: Model, text: str = "text") -> tuple[DataFrame, str]:
    """The documents with the column ``score``, or the next free name, which comes second."""
    name = free_name(documents.columns, "score")
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def make():
        known = shared.value
        return lambda data, offsets: [pa.array(known.scores(features(data, offsets)))]

    return map_texts(documents, text, make, [StructField(name, DoubleType())]), name
