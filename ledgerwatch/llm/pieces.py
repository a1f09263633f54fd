"""SentencePiece encoding and decoding by suffix-array matching.

A slice of a batch is cut into chunks; each distinct chunk is laid out once in one
text, of which a suffix array is built (prefix doubling, as deep as the longest
piece). Every piece of the vocabulary is binary-searched character by character
along its prefixes, so a range of the array is all its occurrences. These edges
are sorted by position and relaxed; walking back gives the pieces.

Defined results: null encodes to null, the empty text to no pieces. Characters
outside the vocabulary become byte pieces and decode to themselves. A text with
U+2581 itself decodes with blanks in their place, as the model demands. Repeated
texts encode alike; a text of any length is encoded whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .base import give_back, slices, with_columns
from .vocabulary import BLANK, Vocabulary, chunked, lay_out, relax, unknown_edges

SLICE_CHARS = 1 << 19


class Prefixes:
    """All prefixes of all pieces, one level for each length."""

    def __init__(self, vocabulary: Vocabulary):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        known: dict[str, int] = {"": 0}
        depth = 0
        longest = max(map(len, vocabulary.pieces), default=0)
        whole = {p: i for i, p in enumerate(vocabulary.pieces)}
        while depth < longest:
            depth += 1
            here = {p[:depth]: 0 for p in vocabulary.pieces if len(p) >= depth}
            parents = np.fromiter((known[p[:-1]] for p in here), np.int64, len(here))
            chars = np.fromiter((ord(p[-1]) for p in here), np.int64, len(here))
            pieces = np.fromiter((whole.get(p, -1) for p in here), np.int64, len(here))
            self.levels.append((parents, chars, pieces))
            known = {p: i for i, p in enumerate(here)}


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Start positions ordered by the next ``depth`` codes at least; codes are small integers."""
    n = len(codes)
    bits = max(int(codes.max()).bit_length(), 1) if n else 1
    covered = min(max(62 // bits, 1), depth)
    padded = np.concatenate([codes.astype(np.int64), np.zeros(covered, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(covered):
        key = (key << bits) | padded[j : j + n]
    order = np.argsort(key, kind="stable")
    while covered < depth:
        rank = np.empty(n, np.int64)
        ranked = key[order]
        rank[order] = np.concatenate([[1], 1 + np.cumsum(ranked[1:] != ranked[:-1])])
        later = np.zeros(n, np.int64)
        later[: max(n - covered, 0)] = rank[covered:]
        key = rank * (n + 1) + later
        order = np.argsort(key, kind="stable")
        covered *= 2
    return order


def _first_at_least(codes: np.ndarray, order: np.ndarray, shift: int, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """In each range of the array the first suffix whose code at ``shift`` is not below the wanted one."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) >> 1
        below = np.zeros(len(low), bool)
        below[open_] = codes[np.minimum(order[middle[open_]] + shift, len(codes) - 1)] < wanted[open_]
        low = np.where(open_ & below, middle + 1, low)
        high = np.where(open_ & ~below, middle, high)


def occurrences(codes: np.ndarray, alphabet: np.ndarray, prefixes: Prefixes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and piece of every place where a piece occurs."""
    order = suffix_array(codes, len(prefixes.levels))
    low, high = np.array([0]), np.array([len(codes)])
    starts, lengths, pieces = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for depth, (parents, chars, ends) in enumerate(prefixes.levels):
        code = np.minimum(np.searchsorted(alphabet, chars), len(alphabet) - 1)
        live = np.flatnonzero((alphabet[code] == chars) & (low[parents] < high[parents]))
        new_low, new_high = np.zeros(len(parents), np.int64), np.zeros(len(parents), np.int64)
        new_low[live] = _first_at_least(codes, order, depth, low[parents[live]], high[parents[live]], code[live])
        new_high[live] = _first_at_least(codes, order, depth, new_low[live], high[parents[live]], code[live] + 1)
        low, high = new_low, new_high
        found = np.flatnonzero((ends >= 0) & (low < high))
        count = high[found] - low[found]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        starts.append(order[np.repeat(low[found], count) + within])
        lengths.append(np.full(len(within), depth + 1))
        pieces.append(np.repeat(ends[found], count))
    return np.concatenate(starts), np.concatenate(lengths), np.concatenate(pieces)


def _ragged(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenated runs of values."""
    within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return values[np.repeat(starts, counts) + within]


def encode_slice(texts: list[str | None], vocabulary: Vocabulary, prefixes: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in order, and where each text's begin (and the last ends)."""
    chunks, place, text_starts = chunked(texts)
    if not chunks:
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    lattice = lay_out(chunks)
    points = np.frombuffer(lattice.text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points.astype(np.int64)
    points[lattice.ends] = -1  # apart from a NUL in the text
    alphabet, codes = np.unique(points, return_inverse=True)
    start, length, piece = occurrences(codes, alphabet, prefixes)
    lone = unknown_edges(lattice, start, length)
    start, length = np.concatenate([start, lone]), np.concatenate([length, np.ones(len(lone), np.int64)])
    score = np.concatenate([vocabulary.scores[piece], np.full(len(lone), vocabulary.unknown_score)])
    _, by, order = relax(lattice, start, length, score)

    node, path = lattice.ends, []
    while len(node):
        edge = order[by[node]]
        path.append(edge)
        node = start[edge]
        node = node[lattice.offset[node] > 0]
    path = np.concatenate(path)
    path = path[np.argsort(start[path])]  # by chunk, then by place

    known = path < len(piece)
    width = np.ones(len(path), np.int64)
    lists: dict[int, list[int]] = {}
    for point in np.unique(points[start[path[~known]]]):
        lists[int(point)] = vocabulary.unknown_ids(chr(point))
    if lists:
        own = points[start[path[~known]]]
        width[~known] = [len(lists[int(p)]) for p in own]
    ids = np.empty(int(width.sum()), np.int32)
    at = np.cumsum(width) - width
    ids[at[known]] = vocabulary.ids[piece[path[known]]]
    if lists:
        ids[_ragged(np.arange(len(ids)), at[~known], width[~known])] = np.concatenate([lists[int(p)] for p in own])

    which = np.searchsorted(lattice.begins, start[path], side="right") - 1
    counts = np.bincount(which, weights=width, minlength=len(chunks)).astype(np.int64)
    firsts = np.cumsum(counts) - counts
    out = _ragged(ids, firsts[place], counts[place])
    ends = np.concatenate([[0], np.cumsum(counts[place])])
    return out, ends[text_starts]


class _Shared:
    """The broadcast vocabulary with its prefixes, built once in a worker."""

    def __init__(self, sent: Broadcast):
        self.sent = sent

    def get(self) -> tuple[Vocabulary, Prefixes]:
        vocabulary = self.sent.value
        held = _BUILT.get("vocabulary")
        if held is not vocabulary:
            _BUILT.update(vocabulary=vocabulary, prefixes=Prefixes(vocabulary))
        return vocabulary, _BUILT["prefixes"]

    def drop(self) -> None:
        """Forget what was built; a task ends with this."""
        _BUILT.clear()
        give_back()


_BUILT: dict = {}


def encode_texts(texts: list[str | None], vocabulary: Vocabulary, prefixes: Prefixes) -> tuple[np.ndarray, np.ndarray]:
    ids, starts, base = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)], 0
    for first, last in slices(texts, SLICE_CHARS):
        some, at = encode_slice(texts[first:last], vocabulary, prefixes)
        ids.append(some)
        starts.append(at[1:] + base)
        base += len(some)
    return np.concatenate(ids), np.concatenate(starts)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", ids_col: str = "piece_ids") -> DataFrame:
    """The rows with the ids of the text's pieces; an input column of that name is replaced."""
    rows = docs.drop(ids_col)
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(text_col)
            ids, starts = encode_texts(column.to_pylist(), *shared.get())
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids), mask=column.is_null())
            yield with_columns(batch, {ids_col: lists})
        shared.drop()

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]))


def decode_ids(ids: list[int] | np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of some ids; bytes that are no UTF-8 become replacement characters."""
    data = b"".join(map(vocabulary.texts.__getitem__, ids))
    return data.decode("utf-8", "replace").removeprefix(" ")


def decode(docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "piece_ids", text_col: str = "decoded") -> DataFrame:
    """The rows with the text that the ids stand for; null for null."""
    rows = docs.drop(text_col)
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if ids is None else decode_ids(ids, sent.value) for ids in batch.column(ids_col).to_pylist()]
            yield with_columns(batch, {text_col: pa.array(texts, pa.string())})

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(text_col, T.StringType())]))


def encode_and_check(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id, piece_ids, n_pieces and round_trip: whether decoding the ids gives the text back."""
    rows = docs.select("doc_id", "text")
    shared = _Shared(docs.sparkSession.sparkContext.broadcast(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("text")
            texts = column.to_pylist()
            vocabulary, prefixes = shared.get()
            for first, last in slices(texts, SLICE_CHARS):
                some = texts[first:last]
                ids, starts = encode_slice(some, vocabulary, prefixes)
                null = column.slice(first, last - first).is_null()
                same = [
                    None if t is None else decode_ids(ids[a:b].tolist(), vocabulary) == t.replace(BLANK, " ")
                    for t, a, b in zip(some, starts[:-1], starts[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first),
                        pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids), mask=null),
                        pa.array(np.diff(starts)),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["doc_id", "piece_ids", "n_pieces", "round_trip"],
                )
        shared.drop()

    return rows.mapInArrow(run, T.StructType([docs.select("doc_id").schema[0], *T.StructType.fromDDL("piece_ids array<int>, n_pieces long, round_trip boolean").fields]))
