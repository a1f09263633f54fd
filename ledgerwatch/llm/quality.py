"""Quality classifier: naive Bayes support vectors over n-gram indicators.

A text's features are indicators of hashed n-grams: words, word pairs, runs of
one repeated word, and 3- and 5-grams of character classes (which tell shouting,
table rows and symbol noise from prose in any language). Each indicator is
scaled by its log-count ratio between the classes, the vector is brought to unit
length, and a linear hinge-loss model is fitted by dual coordinate descent. A
logistic curve over its margins gives the score.

The fit uses at most ``per_class`` labelled rows of either class, those with the
smallest hash of their id: a documented bound, so the sample may be broadcast
and one task may fit it. Every whole text is scored.

Defined results: null and empty texts have no features and get the score of the
bias alone. Without labels of both classes every score is the smoothed share of
label 1 among the labels (0.5 if none). A doc_id with contradicting or null
labels teaches nothing; repeated label rows count once. Of several texts with one
doc_id the first by code point teaches. Equal texts get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import may_learn, slices, tidy, with_columns

BUCKET_BITS = 18
PER_CLASS = 4000
LEAST_SCORE = 0.7
_MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_STEP = 0x5851F42D4C957F2D


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray  # of the scaled, not yet normalised indicators
    squares: np.ndarray  # squared scale of each indicator
    bias: float
    slope: float
    offset: float


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: its class, its lower-case form, and whether it is white space."""
    kinds, lower, space = np.arange(0x110000), np.arange(0x110000), np.zeros(0x110000, bool)
    for c in range(0x110000):
        char = chr(c)
        if char.isalpha():
            kinds[c] = 65 if char.isupper() else 97
            small = char.lower()
            lower[c] = ord(small) if len(small) == 1 else c
        elif char.isdigit():
            kinds[c] = 48
        elif char.isspace():
            space[c] = True
            kinds[c] = 10 if char == "\n" else 32
    return kinds.astype(np.uint64), lower.astype(np.uint64), space


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    inverse = pow(_STEP, -1, 1 << 64)
    out = []
    for base in (_STEP, inverse):
        factors = np.full(max(n, 1), base, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors))
    return out[0], out[1]


def _bucket(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * _MIX_B
    return (values >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def feature_sets(texts: list[str | None]) -> Iterator[np.ndarray]:
    """For each text the sorted numbers of the n-grams it holds."""
    kinds_of, lower_of, space_of = _tables()
    flags = np.zeros(1 << BUCKET_BITS, bool)
    repeats = _bucket(np.array([3, 5], np.uint64) * _MIX_A)
    for first, last in slices(texts):
        framed = [f" {t} " if t else "  " for t in texts[first:last]]
        codes = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in framed])])
        kinds = kinds_of[codes] * _MIX_A
        power, inverse = _powers(len(codes))
        prefix = np.concatenate([[np.uint64(0)], np.cumsum((lower_of[codes] + np.uint64(1)) * _MIX_A * power)])
        space = space_of[codes]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        start, stop = edge[0::2], edge[1::2]  # every text begins and ends with a space
        word = (prefix[stop] - prefix[start]) * inverse[start]
        word ^= word >> np.uint64(29)
        of_words = np.searchsorted(start, bounds)
        single = _bucket(word)
        double = _bucket(word[:-1] * _MIX_B + word[1:])
        same = word[:-1] == word[1:]
        thrice = same[:-1] & same[1:]
        grams = []
        value = kinds
        for n in range(2, 6):
            value = (value[:-1] ^ (value[:-1] >> np.uint64(27))) * _MIX_B + kinds[n - 1 :]
            if n in (3, 5):
                grams.append((n, _bucket(value + np.uint64(n))))
        for i in range(len(framed)):
            a, b, v, w = bounds[i], bounds[i + 1], of_words[i], of_words[i + 1]
            flags[single[v:w]] = True
            flags[double[v : max(w - 1, v)]] = True
            flags[repeats[0]] |= same[v : max(w - 1, v)].any()
            flags[repeats[1]] |= thrice[v : max(w - 2, v)].any()
            if w > v:
                for n, gram in grams:
                    flags[gram[a : max(b - n + 1, a)]] = True
            found = np.flatnonzero(flags)
            flags[found] = False
            yield found.astype(np.int32)


def _descend(sets: list[np.ndarray], scale: np.ndarray, target: np.ndarray, cost: float, epochs: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Dual coordinate descent for the L1 hinge loss: weights, bias and margins.

    Both classes share the total cost evenly. The bias is a feature of value 1.
    """
    rows = [scale[s] for s in sets]
    rows = [r / max(float(np.sqrt(r @ r)), 1e-12) for r in rows]
    lengths = np.array([float(r @ r) + 1.0 for r in rows])
    share = {sign: len(target) / (2.0 * max(int((target == sign).sum()), 1)) for sign in (-1, 1)}
    top = np.array([cost * share[int(sign)] for sign in target])
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(len(scale)), 0.0
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            gradient = target[i] * (weights[sets[i]] @ rows[i] + bias) - 1.0
            new = min(max(alpha[i] - gradient / lengths[i], 0.0), top[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * target[i]
                weights[sets[i]] += step * rows[i]
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return weights, bias, np.array([weights[s] @ r + bias for s, r in zip(sets, rows, strict=True)])


def _calibrate(margins: np.ndarray, target: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve of label 1 over the margin; both classes weigh the same."""
    good = target > 0
    weight = np.where(good, 0.5 / max(good.sum(), 1), 0.5 / max((~good).sum(), 1))
    goal = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    slope, offset = 1.0, 0.0
    for _ in range(50):  # Newton steps, kept short by a ridge
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))
        gap, bend = weight * (goal - p), weight * p * (1 - p)
        gradient = np.array([gap @ margins - 1e-3 * slope, gap.sum() - 1e-3 * offset])
        hessian = np.array([[bend @ margins**2 + 1e-3, bend @ margins], [bend @ margins, bend.sum() + 1e-3]])
        step = np.linalg.solve(hessian, gradient)
        slope, offset = slope + step[0], offset + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(offset)


def fit_sample(sets: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, epochs: int = 30, least_texts: int = 4) -> QualityModel:
    """The model of a bounded sample; labels are 0 and 1."""
    good = int(labels.sum())
    bad = len(labels) - good
    if not good or not bad:
        share = (good + 1) / (len(labels) + 2)
        nothing = np.zeros(1 << BUCKET_BITS)
        return QualityModel(nothing, nothing, 0.0, 1.0, float(np.log(share / (1 - share))))
    counts = np.zeros((2, 1 << BUCKET_BITS))
    for found, label in zip(sets, labels, strict=True):
        counts[int(label), found] += 1
    ratio = np.log((counts[1] + 1) / (good + 2)) - np.log((counts[0] + 1) / (bad + 2))
    ratio[counts.sum(axis=0) < least_texts] = 0.0
    target = np.where(labels > 0, 1, -1)
    weights, bias, margins = _descend(sets, ratio, target, cost, epochs)
    slope, offset = _calibrate(margins, target)
    return QualityModel(weights * ratio, ratio**2, float(bias), slope, offset)


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> QualityModel:
    """A model from labels (doc_id, quality) of rows that may be learned from."""
    usable = labels.where(may_learn(F.col("doc_id")) & F.col("quality").isin(0, 1)).groupBy("doc_id")
    agreed = usable.agg(F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other").drop("other")
    # The sample is over labelled documents that are there; both tables are read without their texts.
    there = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id")
    hashed = agreed.join(there, "doc_id", "left_semi").withColumn("at", F.xxhash64("doc_id"))
    sample = hashed.where("label = 0").orderBy("at").limit(per_class).unionByName(hashed.where("label = 1").orderBy("at").limit(per_class))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = pa.array(list(feature_sets(batch.column("text").to_pylist())), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("at"), batch.column("label"), sets], names=["at", "label", "found"])

    def train(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        found = table.column("found").combine_chunks()
        values, cuts = found.values.to_numpy(), found.offsets.to_numpy()
        sets = [values[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        model = fit_sample(sets, table.column("label").to_numpy())
        return pa.table(
            {
                "weights": pa.array([model.weights.tobytes()], pa.binary()),
                "squares": pa.array([model.squares.tobytes()], pa.binary()),
                "bias": [model.bias],
                "slope": [model.slope],
                "offset": [model.offset],
            }
        )

    labelled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    texts = labelled.groupBy("doc_id", "at", "label").agg(F.min("text").alias("text"))
    fitted = (
        texts.select("at", "label", "text")
        .mapInArrow(tidy(extract), "at long, label int, found array<int>")
        .groupBy()
        .applyInArrow(train, "weights binary, squares binary, bias double, slope double, offset double")
        .collect()
    )
    if not fitted:
        return fit_sample([], np.zeros(0))
    row = fitted[0]
    return QualityModel(np.frombuffer(row.weights), np.frombuffer(row.squares), row.bias, row.slope, row.offset)


def judge(texts: list[str | None], model: QualityModel) -> np.ndarray:
    """The score of each text, from 0 to 1, higher where label 1 is likelier."""
    margins = np.empty(len(texts))
    for i, found in enumerate(feature_sets(texts)):
        margins[i] = model.weights[found].sum() / max(float(np.sqrt(model.squares[found].sum())), 1e-12) + model.bias
    return 1 / (1 + np.exp(-np.clip(model.slope * margins + model.offset, -700, 700)))


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows with ``score`` and ``predicted``; input columns of these names are replaced."""
    rows = docs.drop("score", "predicted")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = judge(batch.column("text").to_pylist(), sent.value)
            yield with_columns(batch, {"score": pa.array(scores, pa.float64()), "predicted": pa.array((scores >= LEAST_SCORE).astype(np.int32))})

    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(tidy(run), schema)


def keep_good(docs: DataFrame, model: QualityModel, least: float = LEAST_SCORE) -> DataFrame:
    """The rows, unchanged, with a score of at least ``least``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(judge(batch.column("text").to_pylist(), sent.value) >= least))

    return docs.mapInArrow(tidy(run), docs.schema)
