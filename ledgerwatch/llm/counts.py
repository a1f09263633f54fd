"""Token counts: count-only Viterbi over the matches of an Aho-Corasick automaton.

The automaton holds the whole unigram vocabulary and lists every match in one run
over each distinct chunk of a slice; relaxing these matches carries the best score
and the number of tokens on its path, under the tokenizer's rule for ties, without
any back pointers or pieces.

Defined results: null counts null tokens, the empty text none. An unknown
character counts as its UTF-8 bytes where the vocabulary has byte pieces, else as
one. Equal texts count alike; texts of any length are counted whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .base import segment_sums, slices, with_columns
from .vocabulary import Lattice, Vocabulary, chunked, lay_out, relax, unknown_edges

SLICE_CHARS = 2 << 20
_BUILT: dict = {}


def automaton_of(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    """Built once in a worker; its values are places in the vocabulary."""
    if _BUILT.get("vocabulary") is not vocabulary:
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, piece in enumerate(vocabulary.pieces):
            automaton.add_word(piece, i)
        automaton.make_automaton()
        lengths = np.fromiter(map(len, vocabulary.pieces), np.int64, len(vocabulary.pieces))
        _BUILT.update(vocabulary=vocabulary, automaton=automaton, lengths=lengths)
    return _BUILT["automaton"]


def matches(lattice: Lattice, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Last character and piece of every match; no piece holds the NUL between chunks."""
    found = np.fromiter(chain.from_iterable(automaton_of(vocabulary).iter(lattice.text)), np.int64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def count_slice(texts: list[str | None], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and best score of each text."""
    chunks, place, text_starts = chunked(texts)
    if not chunks:
        return np.zeros(len(texts), np.int64), np.zeros(len(texts))
    lattice = lay_out(chunks)
    last, piece = matches(lattice, vocabulary)
    length = _BUILT["lengths"][piece]
    start = last - length + 1
    lone = unknown_edges(lattice, start, length)
    width = np.array([len(vocabulary.unknown_ids(lattice.text[i])) for i in lone], np.int64)
    start, length = np.concatenate([start, lone]), np.concatenate([length, np.ones(len(lone), np.int64)])
    score = np.concatenate([vocabulary.scores[piece], np.full(len(lone), vocabulary.unknown_score)])
    tokens = np.concatenate([np.ones(len(piece), np.int64), width])
    best, counts, _ = relax(lattice, start, length, score, tokens)
    per_text = segment_sums(counts[lattice.ends][place], text_starts)
    # Totals of whole numbers below 2**53 are exact in any order.
    return per_text, segment_sums(best[lattice.ends][place], text_starts)


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """The rows with ``n_tokens`` and ``best_score``; input columns of these names are replaced."""
    rows = docs.drop("n_tokens", "best_score")
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text_col)
            texts = column.to_pylist()
            parts = [count_slice(texts[a:b], sent.value) for a, b in slices(texts, SLICE_CHARS)]
            tokens = np.concatenate([np.zeros(0, np.int64), *(p[0] for p in parts)])
            scores = np.concatenate([np.zeros(0), *(p[1] for p in parts)])
            null = column.is_null().to_numpy(zero_copy_only=False)
            yield with_columns(batch, {"n_tokens": pa.array(tokens, mask=null), "best_score": pa.array(scores, mask=null)})

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *T.StructType.fromDDL("n_tokens long, best_score double").fields]))
