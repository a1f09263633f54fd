from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import bitfilter, jaccard
from ledgerwatch.llm.base import Workspace
from ledgerwatch.llm.graph import components

from .fixtures import DOCS, awkward, awkward_rows, brute_jaccard


def _rows(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.n_links) for r in frame.collect()), key=str)


def test_awkward_rows_match_brute_force(spark):
    got = jaccard.join(awkward(spark))
    wanted = brute_jaccard([r[:2] for r in awkward_rows()], 3, 90, 100)
    assert _rows(got) == sorted(wanted, key=str)


def test_empty_table(spark):
    assert jaccard.join(spark.createDataFrame([], DOCS)).count() == 0
    assert jaccard.keep_one(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize(("words", "share"), [(3, 90), (5, 80)])
def test_random_edits_match_brute_force(spark, words, share, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)  # many tiles per component
    random.seed(words)
    rows = []
    for family in range(12):
        size = random.choice([3, 9, 10, 11, 12, 20, 40, 60, 150])
        text = [f"f{family}w{random.randrange(size)}" for _ in range(size)]
        for _ in range(random.choice([1, 2, 5, 40])):
            copy = list(text)
            for _ in range(random.randrange(4)):
                copy[random.randrange(len(copy))] = f"e{random.randrange(3)}"
            if random.random() < 0.3:
                copy = copy[: max(1, int(len(copy) * random.uniform(0.85, 1)))]
            rows.append((len(rows), " ".join(copy)))
    config = jaccard.JaccardConfig(words, share, 100)
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), config)
    assert _rows(got) == sorted(brute_jaccard(rows, words, share, 100), key=str)


def test_sizes_at_the_edge_of_the_share_meet_in_a_tile(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 1)  # every pair is dealt to size bands
    rows = []
    for low, high in [(20, 24), (20, 25), (40, 48), (57, 71), (80, 100), (100, 124), (100, 125), (163, 200), (320, 399)]:
        assert 0.8 <= low / high <= 0.85
        text = [f"s{low}and{high}w{i}" for i in range(high + 4)]
        rows += [(len(rows), " ".join(text[: low + 4])), (len(rows) + 1, " ".join(text))]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), jaccard.JaccardConfig(5, 80, 100))
    wanted = brute_jaccard(rows, 5, 80, 100)
    assert sorted(r[:3] for r in _rows(got)) == sorted(r[:3] for r in wanted)
    assert all(links == 1 for *_, links in wanted)


def test_empty_blocks_add_no_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_HASHES", 16)  # many more blocks than sets, so most are empty
    rows = []
    for family in range(6):
        text = [f"f{family}w{i}" for i in range(200)]
        rows += [(len(rows) + i, " ".join(text[: 200 - i])) for i in range(5)]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert _rows(got) == sorted(brute_jaccard(rows, 3, 90, 100), key=str)


def test_whole_table_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert _rows(got) == sorted(brute_jaccard(rows, 3, 90, 100), key=str)


def test_one_document_of_each_group_stays(spark):
    docs = awkward(spark)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    left = sorted((r.doc_id for r in kept.collect()), key=str)
    # Groups: 1 2 3 16, 7 8, and every other text by itself; the empty texts 4 5 6 link with nothing.
    assert left == sorted([1, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15, 15, None], key=str)


def test_candidates_connect_every_linked_pair(spark):
    random.seed(8)
    rows = []
    for family in range(40):
        size = random.choice([9, 10, 11, 19, 20, 50, 120])
        text = [f"f{family}w{i}" for i in range(size)]
        if family % 2:
            text[: size // 2] = [f"shared{i}" for i in range(size // 2)]
        rows.append(text)
        rows += [text[: -random.randrange(1, 1 + max(1, size // 10))] for _ in range(2)]
        edited = list(text)
        edited[random.randrange(size)] = "x"
        rows.append(edited)
    config = jaccard.JaccardConfig(words=1)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(rows)], "doc_id long, text string")
    classes = jaccard.keyed_sets(docs, config).groupBy("set_hash").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), F.first("hashes").alias("hashes"))
    work = Workspace(spark, "test")
    joined = {r.child: r.parent for r in components(jaccard._candidates(classes, config, work), work).collect()}
    nodes = {r.node for r in classes.collect()}
    sets = {i: frozenset(t) for i, t in enumerate(rows)}
    linked = 0
    for a in nodes:
        for b in nodes:
            if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                linked += 1
                assert joined.get(a, a) == joined.get(b, b)
    assert linked > 40
    # Families are not chained together by the words that half of them share.
    assert max(np.bincount([v for v in joined.values()])) < 30


def test_bit_counts_never_lose_a_pair():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 400, rng.integers(1, 300)).astype(np.uint64)) for _ in range(60)]
    config = jaccard.JaccardConfig(share=30)
    i, j = jaccard.tile_links(sets, np.zeros(60, int), config)
    got = set(zip(i.tolist(), j.tolist(), strict=True))
    wanted = set()
    for a in range(60):
        for b in range(a + 1, 60):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 30 * (len(sets[a]) + len(sets[b]) - both):
                wanted.add((a, b))
    assert got == wanted and wanted


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i + 1, i) for i in range(100, 140)] + [(i, 3) for i in range(200, 260)] + [(3, 1), (3, 1), (400, 399)]
    got = {r.child: r.parent for r in components(spark.createDataFrame(edges, "child long, parent long"), Workspace(spark, "test")).collect()}
    assert all(got[i] == 100 for i in range(101, 141))
    assert all(got[i] == 1 for i in [3, *range(200, 260)])
    assert got[400] == 399 and len(got) == 40 + 61 + 1
    assert components(spark.createDataFrame([], "child long, parent long"), Workspace(spark, "test")).count() == 0


def test_filter_passes_all_its_values(spark):
    frame = spark.range(0, 5000).select((F.col("id") * 7919).alias("v"))
    held = bitfilter.build(frame, "v")
    assert bitfilter.passes(held, np.arange(5000, dtype=np.int64) * 7919).all()
    assert bitfilter.passes(held, np.arange(1, 100001, dtype=np.int64) * -31).mean() < 0.01
    assert bitfilter.kept(frame, "v", held).count() == 5000
    assert not bitfilter.passes(bitfilter.build(frame.limit(0), "v"), np.arange(5, dtype=np.int64)).any()


def test_intermediate_tables_are_dropped(spark):
    work = Workspace(spark, "test")
    work.stored(spark.range(3), "a")
    assert spark.read.parquet(f"{work.base}/001-a").count() == 3
    work.drop()
    folder = spark._jvm.org.apache.hadoop.fs.Path(work.base)
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
