"""Ranked lexical search against the formula over all documents."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from ledgerwatch.llm import lexical

from .fixtures import DOCS, FOLD, awkward, awkward_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(FOLD))


def plain(docs, items, k):
    """item, rank and score of the best documents, with their ids."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    one = {}
    for item, text in items:
        if item is not None and text is not None:
            one[item] = min(one.get(item, text), text)
    out = []
    for item, text in one.items():
        scored = []
        for doc, bag, n in bags:
            m = 100 - 50 + (50 * n * n_docs) // length
            score = 0
            for t in set(terms(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=lambda r: r[:2])


def found(frame):
    return sorted((tuple(r[c] for c in ("item_id", "rank", "doc_id", "score")) for r in frame.collect()), key=lambda r: r[:2])


LAYOUTS = [
    lexical.SearchConfig(),
    lexical.SearchConfig(k=7, rows=40, postings=500, window=8, summed=10),
    lexical.SearchConfig(k=3, rows=64, window=16, summed=0),  # documents at a time only
    lexical.SearchConfig(k=3, terms=60, summed=10**9),  # terms at a time only, several groups of items
]


@pytest.mark.parametrize("config", LAYOUTS)
def test_whole_table_matches_the_formula(spark, small, config):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    want = plain([tuple(r) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], config.k)
    assert found(lexical.rank(docs.repartition(3), items, config)) == want


@pytest.mark.parametrize("config", LAYOUTS[:2])
def test_awkward_rows_ties_and_items(spark, config):
    rows = [(r[0], r[1]) for r in awkward_rows()] + [(100 + i, "the river runs") for i in range(80)] + [(90, "The RIVER runs!"), (91, "é ü É")]
    docs = awkward(spark).select("doc_id", "text").unionByName(spark.createDataFrame(rows[len(awkward_rows()) :], "doc_id long, text string"))
    items = [(1, "the river"), (1, "The river, and more"), (2, None), (3, ""), (4, "!!!"), (None, "the river"), (5, "nowhere-to-be-found zzz"), (6, "é ß 日本 W1 w1 w2"), (7, "river " * 50), (8, rows[12][1])]
    frame = spark.createDataFrame(items, ITEMS)
    clashing = frame.selectExpr("*", "'mine' AS terms", "'mine' AS doc_id", "1 AS rank", "2 AS `group`")
    ours = found(lexical.rank(awkward(spark).unionByName(docs.where("doc_id >= 90"), allowMissingColumns=True), clashing, config))
    assert ours == plain(rows, items, config.k)


def test_no_documents_and_no_items(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "a", 3)], DOCS)
    items = spark.createDataFrame([(1, "a")], ITEMS)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.limit(0), items.limit(0)), (docs, items.selectExpr("item_id", "'zzz' AS text"))):
        out = lexical.rank(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_windows_are_skipped_and_nothing_is_lost():
    """A block searched in windows with a full list of best documents gives what adding everything up gives."""
    rng = np.random.default_rng(2)
    n, vocabulary = 3000, 40
    counts = rng.integers(1, 12, n)
    words = np.concatenate([rng.choice(vocabulary, c, replace=False, p=np.arange(1, 41) / 820) for c in counts])
    tfs = rng.integers(1, 9, len(words))
    weight = rng.integers(0, 9000, vocabulary)
    block = lexical.Block(rng.permutation(n), rng.integers(20, 400, n), words, tfs, counts, weight, n, 200 * n)
    for size in (1, 5, 30):
        asked = rng.choice(vocabulary, size, replace=False)
        score = np.zeros(n, np.int64)
        for t in asked:
            a, b = block.span(int(t))
            score[block.docs[a:b]] += block.adds[a:b]
        best = np.lexsort((block.ids, -score))
        best = best[score[best] > 0][:10]
        for config in (lexical.SearchConfig(k=10, window=64, summed=200), lexical.SearchConfig(k=10, window=500, summed=0)):
            top = lexical.Top(10)
            lexical.search_block(block, asked, top, config)
            assert top.ids.tolist() == block.ids[best].tolist() and top.scores.tolist() == score[best].tolist()


def test_groups_of_items_stay_below_their_bound(spark):
    items = lexical.item_terms(spark.createDataFrame([(i, " ".join(f"t{i}x{j}" for j in range(i % 7 + 1))) for i in range(60)], ITEMS))
    numbered, groups = lexical.grouped(items, 12)
    sizes = numbered.selectExpr("group", "size(terms) AS n").groupBy("group").sum("n").collect()
    assert groups > 1 and all(r[1] <= 12 for r in sizes) and numbered.count() == 60
