"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning is one pass that counts hashed 1-, 2- and 3-grams of letters per
language in numpy and sums the counts in Spark. The log-probability matrix
(languages x buckets) has a fixed size and is broadcast; scoring is another pass
that gathers each text's n-grams from it. Log-probabilities are fixed-point
integers, so a score never depends on the order of a sum.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
and so is every text if nothing could be learned. Ties go to the language first
by code point. Rows are judged one by one, so repeated rows get equal results;
null ids and sources are carried along. Texts are read whole.
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

from .base import may_learn, segment_sums, slices, stored, tidy, with_columns

UNKNOWN = "und"
BUCKET_BITS = 16
# A model of more languages than this would outgrow its broadcast (256 KB each).
MAX_LANGUAGES = 256
FIXED_POINT = 1 << 16


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    weights: np.ndarray  # languages x buckets, fixed-point log-probabilities
    priors: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point, itself if it is a letter, else 0 (white space and all else)."""
    codes = np.arange(0x110000, dtype=np.uint32)
    return codes * np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def hashed_ngrams(texts: list[str | None]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For n = 1, 2, 3: buckets and where each text's begin (and the last ends); and which texts have a letter.

    A text is lower-cased, everything but letters is one class of its own, and
    the text has one such character added at either end. No n-gram spans two
    texts, and each holds a letter.
    """
    framed = [f" {text.lower()} " if text else "  " for text in texts]
    codes = np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _letters()[codes].astype(np.uint64)
    ends = np.cumsum([len(t) for t in framed])
    starts = np.concatenate([[0], ends])
    is_letter = codes != 0
    has_letter = segment_sums(is_letter, starts) > 0

    mixed = codes * np.uint64(0x9E3779B97F4A7C15)
    shift = np.uint64(64 - BUCKET_BITS)
    orders = []
    for n in (1, 2, 3):
        size = max(len(codes) - n + 1, 0)
        keep = is_letter[:size].copy() if n < 3 else is_letter[1 : size + 1].copy()
        if n == 2:
            keep |= is_letter[1 : size + 1]
        for back in range(1, n):  # starts too late in its text
            keep[np.clip(ends - back, 0, max(size - 1, 0))[ends - back < size]] = False
        value = mixed[:size]
        for j in range(1, n):
            value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + mixed[j : size + j]
        value = (value ^ (value >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        before = np.concatenate([[0], np.cumsum(keep)])
        orders.append(((value[keep] >> shift).astype(np.int64), before[np.minimum(starts, size)]))
    return orders, has_letter


def learn(docs: DataFrame, smoothing: float = 1.0) -> LanguageModel:
    """A model from the text and non-null lang of all rows that may be learned from."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in batches:
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            order = sorted(range(len(langs)), key=langs.__getitem__)
            langs, texts = [langs[i] for i in order], [texts[i] for i in order]
            for start, stop in slices(texts):
                orders, _ = hashed_ngrams(texts[start:stop])
                some = np.array(langs[start:stop], object)
                for lang in dict.fromkeys(langs[start:stop]):
                    own = np.flatnonzero(some == lang)
                    rows[lang] = rows.get(lang, 0) + len(own)
                    held = counts.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
                    for buckets, at in orders:  # sorted by language, so one range
                        held += np.bincount(buckets[at[own[0]] : at[own[-1] + 1]], minlength=1 << BUCKET_BITS)
        for lang, held in counts.items():
            seen = np.flatnonzero(held)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": [lang] * (len(seen) + 1),
                    "bucket": pa.array(np.append(seen, -1), pa.int32()),
                    "n": pa.array(np.append(held[seen], rows[lang]), pa.int64()),
                }
            )

    labelled = docs.where(may_learn(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    partial = labelled.select("lang", "text").mapInArrow(tidy(count), "lang string, bucket int, n long")
    totals = partial.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # At most MAX_LANGUAGES x (buckets + 1) rows reach the driver, whatever the input.
    totals = stored(totals, "language-counts")
    languages = sorted(r.lang for r in totals.where("bucket = -1").select("lang").limit(MAX_LANGUAGES + 1).collect())
    if len(languages) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    gathered = totals.toArrow()
    place = {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((len(languages), 1 << BUCKET_BITS))
    documents = np.zeros(len(languages))
    which = np.array([place[x] for x in gathered.column("lang").to_pylist()], np.int64)
    bucket, n = gathered.column("bucket").to_numpy(), gathered.column("n").to_numpy()
    documents[which[bucket < 0]] = n[bucket < 0]
    counts[which[bucket >= 0], bucket[bucket >= 0]] = n[bucket >= 0]
    logs = np.log(counts + smoothing) - np.log(counts.sum(axis=1, keepdims=True) + smoothing * (1 << BUCKET_BITS))
    priors = np.log(documents / max(documents.sum(), 1.0))
    return LanguageModel(tuple(languages), np.rint(logs * FIXED_POINT).astype(np.int32), np.rint(priors * FIXED_POINT).astype(np.int64))


def judge(texts: list[str | None], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """For each text the place of its language in the model, -1 for none, and the posterior."""
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    if not model.languages:
        return best, score
    for start, stop in slices(texts):
        orders, has_letter = hashed_ngrams(texts[start:stop])
        logs = np.empty((len(model.languages), stop - start), np.int64)
        for i, weights in enumerate(model.weights):
            logs[i] = model.priors[i] + sum(segment_sums(weights[buckets], at) for buckets, at in orders)
        top = logs.max(axis=0)
        posterior = 1.0 / np.exp(np.maximum((logs - top) / FIXED_POINT, -700.0)).sum(axis=0)
        best[start:stop] = np.where(has_letter, logs.argmax(axis=0), -1)
        score[start:stop] = np.where(has_letter, posterior, 0.0)
    return best, score


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows with ``lang_pred`` and ``score``; input columns of these names are replaced."""
    rows = docs.drop("lang_pred", "score")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*sent.value.languages, UNKNOWN], object)
        for batch in batches:
            best, score = judge(batch.column("text").to_pylist(), sent.value)
            yield with_columns(batch, {"lang_pred": pa.array(names[best], pa.string()), "score": pa.array(score, pa.float64())})

    schema = T.StructType([*rows.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(tidy(run), schema)


def keep_identified(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """The rows, unchanged, whose text has a language with a posterior of at least ``least``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = judge(batch.column("text").to_pylist(), sent.value)
            yield batch.filter(pa.array((best >= 0) & (score >= least)))

    return docs.mapInArrow(tidy(run), docs.schema)
