"""Ranked lexical search, term at a time for short lists and document at a time for long ones.

1. One pass turns each text into its term count and the numbers and frequencies of
   the terms that any item asks for: a forward index, stored. Its sums give the number of
   documents, their total length and the document frequencies.
2. A task reads its part of that index in blocks of bounded size and inverts each.
   For an item, the postings of its shortest lists are added up, term at a time, into
   one accumulator list. From there on it is an iterator like the long lists, with
   its own maximum. Document at a time, a window of documents after the other: a window
   is skipped if the maxima of all iterators in it do not reach the k-th score so far;
   else only the iterators that can lift a document over that score by themselves
   propose documents, and the others are looked up for those alone, highest maximum
   first, while documents that cannot get there any more drop out.
3. Each task returns k documents per item, and the best k of all tasks are the result.

Whole-number scores, as the formula of the ranking has them. Items are searched in
groups that hold at most ``terms`` terms (or one item), since a group's terms go to
every task; the index is built once per group. Each group is checked before it is sent.

Defined results: null and empty texts have no terms, are in no count and match
nothing. An item that repeats an item_id counts once (its smallest text stays); items
without an id, or without terms, return nothing. Rows that repeat a doc_id are documents
of their own. Documents without an id come last among equal scores. Without documents
or items there are no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import slices, stored

# After lower() of bytes, which folds A-Z only; Java's form for items.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class SearchConfig:
    k: int = 50
    terms: int = 1 << 18  # of a group of items
    # Layout only; results don't depend on these.
    rows: int = 1 << 15  # documents of a block
    postings: int = 1 << 20  # of a block
    window: int = 4096  # documents
    summed: int = 8192  # postings that go into the accumulators of an item


def item_terms(items: DataFrame) -> DataFrame:
    """item_id and the distinct terms of each item that has any."""
    one = items.where("item_id IS NOT NULL").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
    terms = F.array_distinct(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0)))
    return one.select("item_id", terms.alias("terms")).where(F.size("terms") > 0)


def grouped(items: DataFrame, most: int) -> tuple[DataFrame, int]:
    """Items with a group number, such that no group of two or more items has more than ``most`` terms."""
    groups = max(1, -(-(items.agg(F.sum(F.size("terms"))).first()[0] or 0) // most))
    while True:
        numbered = items.withColumn("group", F.pmod(F.xxhash64("item_id"), F.lit(groups)))
        sizes = numbered.groupBy("group").agg(F.sum(F.size("terms")).alias("terms"), F.count("*").alias("items"))
        if groups == 1 or sizes.where((F.col("terms") > most) & (F.col("items") > 1)).isEmpty():
            return numbered, groups
        groups *= 2


@dataclass(frozen=True)
class Queries:
    """Items of one group: their ids, and the numbers of their terms end to end."""

    ids: np.ndarray
    starts: np.ndarray
    terms: np.ndarray


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), and the numbers and frequencies of the vocabulary's terms, of each document with a term."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, b in slices(texts):
                words = [_TERM.findall(t.encode("utf-8", "surrogatepass").lower()) if t else [] for t in texts[a:b]]
                n = np.fromiter(map(len, words), np.int64, len(words))
                found = np.fromiter(map(number, chain.from_iterable(words), repeat(-1)), np.int64, int(n.sum()))
                row = np.repeat(np.arange(len(words)), n)[found >= 0]
                pairs, tf = np.unique(row << 32 | found[found >= 0], return_counts=True)
                ends = np.cumsum(np.bincount(pairs >> 32, minlength=len(words)))
                starts = np.concatenate([[0], ends]).astype(np.int32)
                lists = [pa.ListArray.from_arrays(starts, pa.array(v.astype(np.int32))) for v in (pairs & 0xFFFFFFFF, tf)]
                columns = [batch.column("doc_id").slice(a, b - a), pa.array(n), *lists]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "tfs"]).filter(pa.array(n > 0))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


class Block:
    """Inverted lists of some documents: places in ascending order, with what each posting adds to a score."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, terms: np.ndarray, tfs: np.ndarray, counts: np.ndarray, weight: np.ndarray, documents: int, length: int):
        self.ids = ids
        if int(n.max(initial=0)) * 50 * documents < 1 << 63:
            m = 50 + 50 * n * documents // length
        else:
            m = np.array([50 + 50 * v * documents // length for v in n.tolist()], np.int64)
        order = np.argsort(terms, kind="stable")  # places stay ascending within a term
        self.docs = np.repeat(np.arange(len(ids)), counts)[order]
        tf = tfs[order].astype(np.int64)
        self.adds = weight[terms[order]] * (1_000_000_000 * tf // (1000 * tf + 20 * m[self.docs]))
        self.term = terms[order]

    def span(self, term: int) -> tuple[int, int]:
        a, b = np.searchsorted(self.term, (term, term + 1))
        return int(a), int(b)


class Top:
    """The k best documents of an item so far: highest score, then smallest id."""

    def __init__(self, k: int):
        self.k = k
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.least = 1  # a score below this cannot enter

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        best = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[best], scores[best]
        if len(best) == self.k:
            self.least = max(1, int(self.scores[-1]))


def _summed(docs: list[np.ndarray], adds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct places in ascending order and the sums of what is added to each."""
    place, value = np.concatenate(docs), np.concatenate(adds)
    if not len(place):
        return place, value
    order = np.argsort(place, kind="stable")
    place, value = place[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[first], np.add.reduceat(value, first)


def search_block(block: Block, terms: np.ndarray, top: Top, config: SearchConfig) -> None:
    """Lets every document of the block that belongs among the item's best enter ``top``."""
    spans = sorted((s for s in map(block.span, terms.tolist()) if s[0] < s[1]), key=lambda s: s[1] - s[0])
    lists = [(block.docs[a:b], block.adds[a:b]) for a, b in spans]
    short, total = 0, 0
    while short < len(lists) and total + len(lists[short][0]) <= config.summed:
        total += len(lists[short][0])
        short += 1
    iterators = lists[short:]
    if short:
        iterators.append(_summed(*zip(*lists[:short], strict=True)))
    edges = np.arange(0, len(block.ids) + config.window, config.window)
    cuts = [np.searchsorted(docs, edges) for docs, _ in iterators]
    for w in range(len(edges) - 1):
        here = [(docs[c[w] : c[w + 1]], adds[c[w] : c[w + 1]]) for (docs, adds), c in zip(iterators, cuts, strict=True) if c[w] < c[w + 1]]
        bounds = np.array([int(adds.max()) for _, adds in here], np.int64)
        if int(bounds.sum()) < top.least:
            continue
        order = np.argsort(bounds, kind="stable")
        reach = np.cumsum(bounds[order])
        # The iterators before ``lead`` cannot bring a document up to the least score even together.
        lead = int(np.searchsorted(reach, top.least))
        place, score = _summed(*zip(*(here[i] for i in order[lead:]), strict=True))
        for at in range(lead - 1, -1, -1):
            alive = score + reach[at] >= top.least
            place, score = place[alive], score[alive]
            if not len(place):
                break
            docs, adds = here[order[at]]
            found = np.minimum(np.searchsorted(docs, place), len(docs) - 1)
            score = score + np.where(docs[found] == place, adds[found], 0)
        alive = score >= top.least
        if alive.any():
            top.add(block.ids[place[alive]], score[alive])


def _blocks(batches: Iterator[pa.RecordBatch], config: SearchConfig) -> Iterator[list[np.ndarray]]:
    """ids, n, terms, tfs and list lengths of bounded numbers of documents."""
    held: list[list[np.ndarray]] = []
    rows = postings = 0
    for batch in batches:
        lengths = np.diff(batch.column("terms").offsets.to_numpy()).astype(np.int64)
        ids = batch.column("doc_id").fill_null(_NO_ID).to_numpy()
        at = 0
        while at < batch.num_rows:
            room = int(np.searchsorted(np.cumsum(lengths[at:]), config.postings - postings, side="right"))
            take = min(max(room, 0 if rows else 1), config.rows - rows, batch.num_rows - at)
            if take:
                part = batch.slice(at, take)
                terms, tfs = (part.column(c).flatten().to_numpy() for c in ("terms", "tfs"))
                held.append([ids[at : at + take], part.column("n").to_numpy(), terms, tfs, lengths[at : at + take]])
                at, rows, postings = at + take, rows + take, postings + len(terms)
            if at < batch.num_rows:
                yield [np.concatenate(c) for c in zip(*held, strict=True)]
                held, rows, postings = [], 0, 0
    if held:
        yield [np.concatenate(c) for c in zip(*held, strict=True)]


def search_index(index: DataFrame, queries: Queries, weight: np.ndarray, documents: int, length: int, config: SearchConfig) -> DataFrame:
    """item_id, doc_id and score of each task's best documents, and ``part``, which spreads their merge."""
    sent = index.sparkSession.sparkContext.broadcast((queries, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weight = sent.value
        tops = [Top(config.k) for _ in asked.ids]
        for columns in _blocks(batches, config):
            block = Block(*columns, weight, documents, length)
            for i, top in enumerate(tops):
                search_block(block, asked.terms[asked.starts[i] : asked.starts[i + 1]], top, config)
        part = TaskContext.get().partitionId() % 64
        for item, top in zip(asked.ids, tops, strict=True):
            if len(top.ids):
                n = len(top.ids)
                columns = [pa.array(np.full(n, item)), pa.array(top.ids, mask=top.ids == _NO_ID), pa.array(top.scores), pa.array(np.full(n, part, np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["item_id", "doc_id", "score", "part"])

    return index.mapInArrow(run, "item_id long, doc_id long, score long, part int")


def _search_group(docs: DataFrame, items: DataFrame, config: SearchConfig) -> DataFrame:
    rows = items.select("item_id", "terms").orderBy("item_id").collect()  # a group: at most config.terms terms, or one item
    vocabulary: dict[bytes, int] = {}
    numbers = [vocabulary.setdefault(t.encode("utf-8", "surrogatepass"), len(vocabulary)) for r in rows for t in r.terms]
    starts = np.concatenate([[0], np.cumsum([len(r.terms) for r in rows])]).astype(np.int64)
    queries = Queries(np.array([r.item_id for r in rows], np.int64), starts, np.array(numbers, np.int64))
    index = stored(forward_index(docs, vocabulary), "lexical-index")
    documents, length = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counted = index.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # at most one row per term
    df = np.zeros(len(vocabulary), np.int64)
    for r in counted:
        df[r.term] = r["count"]
    return search_index(index, queries, weights(df, documents), documents, length, config)


def rank(docs: DataFrame, items: DataFrame, config: SearchConfig = SearchConfig()) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of every item."""
    asked, groups = grouped(stored(item_terms(items), "lexical-items"), config.terms)
    found = [_search_group(docs, asked.where(F.col("group") == g), config) for g in range(groups)]
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    merged = reduce(DataFrame.unionByName, found)
    # The tasks' lists of an item are first merged in parts, so no task gets them all.
    for keys in (("item_id", "part"), ("item_id",)):
        order = Window.partitionBy(*keys).orderBy(*best)
        merged = merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= config.k)
    return merged.select("item_id", "rank", "doc_id", "score")
