"""The pipeline, stage by stage, against plain versions of what each stage decides."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from ledgerwatch.llm import jaccard, language, mixing, pieces, quality, vocabulary

from .fixtures import DOCS, SPACE_WORD, awkward, brute_jaccard
from .test_mixing_and_pieces import brute_targets

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What goes into each stage, and what comes out of the last."""
    base = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, held[-1], SF).write.parquet(str(base / name))
        held.append(spark.read.parquet(str(base / name)))
    return held


def texts(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=str)


def test_stage_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "quality", "jaccard", "mixing", "pieces"]
    assert all(frame.columns == COLUMNS for frame in stages[:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_language_stage_keeps_what_has_a_language(stages):
    before, after = stages[0], stages[1]
    best, score = language.judge([r.text for r in before.collect()], language.learn(before))
    wanted = [(r.doc_id, r.text) for r, b, s in zip(before.collect(), best, score, strict=True) if b >= 0 and s >= 0.5]
    assert texts(after) == sorted(wanted, key=str)


def test_quality_stage_keeps_good_texts(spark, stages):
    before, after = stages[1], stages[2]
    model = quality.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = before.collect()
    wanted = [(r.doc_id, r.text) for r, s in zip(rows, quality.judge([r.text for r in rows], model), strict=True) if s >= 0.7]
    assert texts(after) == sorted(wanted, key=str)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {d for d, _ in wanted}
    good = [d for d in (r.doc_id for r in rows) if labels.get(d) == 1]
    assert sum(d in kept for d in good) > 0.97 * len(good)
    assert sum(labels.get(d) == 0 for d in kept) <= 2


def test_jaccard_stage_keeps_one_of_each_group(stages):
    rows = texts(stages[2])
    groups = {component for _, _, component, _ in brute_jaccard(rows, 5, 80, 100)}
    assert texts(stages[3]) == [r for r in rows if r[0] in groups]
    assert len(groups) < len(rows)


def test_mixing_stage_meets_its_targets(stages):
    before, after = stages[3].collect(), stages[4].collect()
    sizes, words = {}, {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + len(SPACE_WORD.findall(r.text or ""))
    own = {r.doc_id: SPACE_WORD.findall(r.text or "") for r in before}
    taken = {}
    for r in after:
        found = SPACE_WORD.findall(r.text)
        words[r.source] = words.get(r.source, 0) + len(found)
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len(found)
        assert set(found) <= set(own[r.doc_id])
    for source, target in brute_targets(sizes).items():
        assert abs(words.get(source, 0) - target) <= 128 + 0.01 * target
    assert all(n <= 3 * len(own[d]) for d, n in taken.items())


def test_pieces_stage_encodes_every_row(stages):
    own = vocabulary.load()
    before, after = stages[4], stages[5]
    wanted = sorted((r.doc_id, tuple(pieces.encode_slice([r.text], own, pieces.Prefixes(own))[0].tolist())) for r in before.limit(3).collect())
    got = sorted((r.doc_id, tuple(r.piece_ids)) for r in after.collect())
    assert set(wanted) <= set(got)
    assert len(got) == before.count() and all(r.round_trip and r.n_pieces == len(r.piece_ids) for r in after.collect())


def test_run_is_the_stages_in_turn(spark, stages):
    run = entry.queries()["pipeline"](spark, SF)
    assert sorted((r.doc_id, tuple(r.piece_ids)) for r in run.collect()) == sorted((r.doc_id, tuple(r.piece_ids)) for r in stages[-1].collect())


def test_every_stage_takes_awkward_and_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    wide = awkward(spark).withColumn("lang", F.coalesce("lang", F.lit(None).cast("string")))
    for name, stage in corpus_pipeline.STAGES:
        for docs in (empty, wide):
            out = stage(spark, docs, SF)
            if name != "pieces":
                assert out.columns == docs.columns
            rows = out.collect()
            assert docs is wide or not rows


def test_queries_are_registered_once_each():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert {"op1_topk", "op8_urls", "op12_centroids", "op13_lexical"} <= set(entry.oracle_sql())
    assert mixing.MixConfig() and jaccard.JaccardConfig().share == 90
