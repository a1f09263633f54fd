"""Source mixing, piece encoding and token counts."""

from __future__ import annotations

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ledgerwatch.llm import counts, mixing, pieces, vocabulary

from .fixtures import DOCS, SPACE_WORD, awkward, awkward_rows


def brute_targets(sizes: dict, weights=(5, 2, 1), most=3):
    """Share by weight, cut at the limit, share the excess again, until nobody is above."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode() if s else b""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        share = {s: rest * weight[s] / open_ for s in order if s not in full} if open_ else {}
        above = {s for s, t in share.items() if t > most * sizes[s]}
        if not above:
            return {s: float(most * sizes[s]) if s in full else share[s] for s in order}
        full |= above


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 1000, "b": 100, "c": 10},
        {"a": 10, "b": 5000, "é": 3, "B": 0, None: 7, "z": 1},
        {"only": 12},
        {"x": 0, "y": 0},
        {"a": 1, "b": 100, "c": 10_000, "d": 1, "e": 1, "f": 50},
        {"a": 500, "b": 200, "c": 100},  # proportional to the weights
        {"a": 1000, "b": 10, "c": 10, "d": 1000},
        {"a": 1000, "b": 900, "c": 800, "d": 1000, "e": 900, None: 800},
        {s: 7 for s in "abcdefgh"},
        {"a": 200, "b": 100, "c": 100},
    ],
)
def test_targets(spark, sizes):
    rows = [(s, part) for s, n in sizes.items() for part in (n // 2, n - n // 2)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert got == {s: pytest.approx(t) for s, t in brute_targets(sizes).items()}


def test_whole_table_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.taken(docs).collect()
    texts = {r.doc_id: r for r in docs.collect()}
    assert len(rows) == len(texts)
    sizes, taken, target = {}, {}, {}
    for r in rows:
        assert r["size"] == len(SPACE_WORD.findall(texts[r.doc_id].text or ""))
        assert 0 <= r.taken <= 3 * r["size"]
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert target == {s: pytest.approx(t) for s, t in brute_targets(sizes).items()}
    assert all(r.source_size == sizes[r.source] for r in rows)
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= 0.5
    assert sorted(map(tuple, mixing.taken(docs).collect())) == sorted(map(tuple, rows))


@pytest.mark.parametrize("sizes", [{"a": 200, "b": 100, "c": 100}, {"a": 400, "b": 150, "c": 151}, {"a": 128, "b": 256, "c": 1, None: 1}, {"x": 5}, {"a": 900, "b": 13, "c": 130, "d": 128}])
def test_small_sources_meet_their_targets(spark, sizes):
    docs = []
    for source, n in sizes.items():
        for first in range(0, n, 30):
            docs.append((len(docs), " ".join(f"w{i}" for i in range(first, min(first + 30, n))), source))
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in mixing.taken(frame).collect()}
    taken = {}
    for doc_id, text, source in docs:
        assert 0 <= rows[doc_id].taken <= 3 * len(text.split())
        assert (rows[doc_id].first_shard is None) == (rows[doc_id].taken == 0)
        taken[source] = taken.get(source, 0) + rows[doc_id].taken
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= 0.5
    words = {}
    for r in mixing.mixed(frame).collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {i: r.taken for i, r in rows.items() if r.taken}


def test_taken_follows_the_slots_word_by_word(spark):
    docs = awkward(spark).select("doc_id", "text", "source")
    config = mixing.MixConfig(block=16, docs_per_chunk=3, slots_per_shard=10)
    narrow = mixing.narrow(docs)
    shares = mixing.targets(narrow, config)
    placed = mixing.positions(narrow, shares, config).collect()
    streams, size = {}, {}
    for r in placed:
        streams.setdefault(r.source, {}).update({r.start + i: (r.doc_id, r.text_hash, r.size, r.start) for i in range(r.size)})
        size[r.source] = size.get(r.source, 0) + r.size
    taken, shard = {}, {}
    for d in mixing.draws(shares, config).collect():
        for word in range(d.block * 16, min(d.block * 16 + d.words, size[d.source])):
            owner = (d.source, *streams[d.source][word])
            taken[owner] = taken.get(owner, 0) + 1
            shard[owner] = min(shard.get(owner, d.shard), d.shard)
    want = sorted(((k[1], k[0], k[3], n, shard[k]) for k, n in taken.items()), key=str)
    got = [(r.doc_id, r.source, r["size"], r.taken, r.first_shard) for r in mixing.taken(docs, config).collect() if r.taken]
    assert sorted(got, key=str) == want and len({g[4] for g in got}) > 1


def test_blocks_are_a_permutation_and_slots_spread(spark):
    for n in (1, 2, 3, 7, 64, 1000):
        assert sorted(mixing.permuted(np.arange(n), n, 99).tolist()) == list(range(n))
    assert mixing.permuted(np.arange(1000), 1000, 1).tolist() != mixing.permuted(np.arange(1000), 1000, 2).tolist()
    shares = spark.createDataFrame([("a", 128_000, 1, 5.0, 300_000.0), (None, 64, 1, 1.0, 192.0), ("z", 10, 1, 1.0, 0.0)], "source string, source_size long, documents long, weight double, target double")
    rows = mixing.draws(shares, mixing.MixConfig(slots_per_shard=500)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    assert len(by["a"]) == -(-300_000 // 128) and len(by[None]) == 3 and "z" not in by
    assert sum(r.words for r in by["a"]) == 300_000
    times = np.bincount([r.block for r in by["a"]], minlength=1000)
    assert set(times) == {2, 3}
    assert sorted(r.slot for r in by["a"]) == list(range(len(by["a"])))
    per_shard = np.bincount([r.shard for r in rows])
    assert len(per_shard) == 5 and per_shard.min() > 300


def test_shards_are_one_multinomial_draw():
    whole = mixing.shards_of(0, 10_000, 10_000, 7, 5)
    assert (np.diff(whole) >= 0).all() and set(whole) == set(range(7))  # a shard reads a range of slots
    parts = [mixing.shards_of(a, min(a + 333, 10_000), 10_000, 7, 5) for a in range(0, 10_000, 333)]
    assert np.concatenate(parts).tolist() == whole.tolist()
    assert mixing.shards_of(0, 10_000, 10_000, 7, 6).tolist() != whole.tolist()
    counts = np.array([np.bincount(mixing.shards_of(0, 700, 700, 7, key), minlength=7) for key in range(400)])
    assert abs(counts.mean(axis=0) - 100).max() < 3 and abs(counts.std(axis=0) - (700 / 7 * 6 / 7) ** 0.5).max() < 1.5


def test_shards_hold_the_mix(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    config = mixing.MixConfig(slots_per_shard=50)
    one = mixing.mixed(docs, config, shard_col="shard").collect()
    assert len({r.shard for r in one}) > 3
    words = {}
    for r in one:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(SPACE_WORD.findall(r.text))
    taken = {r.doc_id: r for r in mixing.taken(docs, config).collect()}
    assert words == {i: r.taken for i, r in taken.items() if r.taken}
    first = {i: min(r.shard for r in one if r.doc_id == i) for i in list(words)[:20]}
    assert all(taken[i].first_shard == s for i, s in first.items())
    other = mixing.mixed(docs, mixing.MixConfig(slots_per_shard=50, seed=21), shard_col="shard").collect()
    assert sorted((r.doc_id, r.shard) for r in other) != sorted((r.doc_id, r.shard) for r in one)


def test_many_slots_are_drawn_in_many_tasks(spark):
    shares = spark.createDataFrame([("a", 10**8, 1, 5.0, 2e8), ("b", 10**6, 1, 1.0, 1e6)], "source string, source_size long, documents long, weight double, target double")
    drawn = mixing.draws(shares)
    assert drawn.rdd.getNumPartitions() >= 20 and drawn.count() == -(-(10**8) // 128) * 2 + -(-(10**6) // 128)


def test_mix_of_awkward_rows(spark):
    docs = awkward(spark).drop("size", "start", "chunk", "block", "row")
    config = mixing.MixConfig(block=16, docs_per_chunk=3)
    rows = mixing.taken(docs, config).collect()
    assert len(rows) == len(awkward_rows())
    sizes = {}
    for _, text, _, source, _ in awkward_rows():
        sizes[source] = sizes.get(source, 0) + len(SPACE_WORD.findall(text or ""))
    assert {r.source: r.target for r in rows} == {s: pytest.approx(t) for s, t in brute_targets(sizes).items()}
    mixed = mixing.mixed(docs, config)
    assert mixed.columns == docs.columns
    words = {}
    for r in mixed.collect():
        words[r.source] = words.get(r.source, 0) + len(SPACE_WORD.findall(r.text))
        assert r.n_chars == len(r.text)
    taken = {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert words == {s: n for s, n in taken.items() if n}


def test_mix_keeps_whole_texts_as_they_are(spark):
    text = " a  b\tc\n d "
    docs = spark.createDataFrame([(1, text, "en", "a", 3)], DOCS)
    assert [r.text for r in mixing.mixed(docs).collect()] == [text]  # one source: its target is its size
    assert mixing.taken(docs).first().taken == 4


def test_mix_of_clashing_columns_and_no_rows(spark):
    docs = awkward(spark)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.taken(docs).columns == ["doc_id", "source", "size", "source_size", "target", "taken", "first_shard"]
    assert mixing.taken(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The public vocabulary as a unigram model for the library, with scores that float32 can add."""
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    model = pb.ModelProto.FromString(open(vocabulary.MODEL, "rb").read())
    model.trainer_spec.model_type = 1
    for piece in model.pieces:
        piece.score = max(piece.score, -35_000.0)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def texts_of(spark):
    return [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()] + [
        "", " ", "  lead", "trail  ", "a\n\n日本語\t\U0001f600é", "\0nul\0", "x" * 3000, "ab" * 700, "▁▁", "the the  the", "it's 12,345.67!",
    ]


def test_pieces_and_counts_equal_the_library(spark, unigram):
    library = sentencepiece.SentencePieceProcessor(model_file=unigram)
    own = vocabulary.load(unigram)
    texts = texts_of(spark)
    ids, starts = pieces.encode_texts(texts, own, pieces.Prefixes(own))
    numbers, scores = counts.count_slice(texts, own)
    prices = {int(i): s for i, s in zip(own.ids, own.scores, strict=True)}
    for text, a, b, n, score in zip(texts, starts[:-1], starts[1:], numbers, scores, strict=True):
        got = ids[a:b].tolist()
        assert got == library.encode(text)
        assert pieces.decode_ids(got, own) == library.decode(got) == text.replace("▁", " ")
        assert n == len(got)
        if all(i in prices for i in got):
            assert score == sum(prices[i] for i in got)


def test_equal_scores_take_the_longer_last_piece():
    own = vocabulary.Vocabulary(("▁", "a", "aa", "▁a"), np.arange(4, dtype=np.int32), np.array([-1.0, -1.0, -2.0, -2.0]), None, 9, (b" ", b"a", b"aa", b" a"))
    ids, _ = pieces.encode_slice(["aaa", "b"], own, pieces.Prefixes(own))
    # All segmentations of the first text cost 4; the second has an unknown character.
    assert ids.tolist() == [3, 2, 0, 9]
    assert counts.count_slice(["aaa", "b"], own)[0].tolist() == [2, 2]


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 3, 500)
    order = pieces.suffix_array(codes, 40)
    tails = [tuple(codes[i : i + 40]) for i in order]
    assert tails == sorted(tails) and sorted(order.tolist()) == list(range(500))


def test_encoding_frames(spark):
    own = vocabulary.load()
    docs = awkward(spark).withColumn("piece_ids", F.lit("mine")).withColumn("n_tokens", F.lit("mine"))
    encoded = pieces.encode(docs, own)
    decoded = pieces.decode(encoded, own)
    assert decoded.columns == [*(c for c in docs.columns if c != "piece_ids"), "piece_ids", "decoded"]
    rows = decoded.collect()
    assert len(rows) == len(awkward_rows())
    for r in rows:
        assert r.decoded == (None if r.text is None else r.text.replace("▁", " "))
    checked = {(r.doc_id, str(r.piece_ids)): r for r in pieces.encode_and_check(docs, own).collect()}
    assert all(r.round_trip is (None if r.piece_ids is None else True) for r in checked.values())
    counted = counts.count_tokens(docs, own).collect()
    assert sorted((str(r.doc_id), r.n_tokens) for r in counted) == sorted((str(r.doc_id), None if r.piece_ids is None else len(r.piece_ids)) for r in rows)
    assert pieces.encode_and_check(docs.limit(0), own).count() == counts.count_tokens(docs.limit(0), own).count() == 0
