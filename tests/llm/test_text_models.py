"""Language identification and quality."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import catalog, language, quality
from ledgerwatch.llm.base import is_held_out

from .fixtures import DOCS, awkward


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_held_out_language_accuracy(spark, documents):
    got = catalog.op9_language(spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) > 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_fold_is_crc32_of_the_id_as_text(spark):
    import zlib

    rows = spark.range(200).select("id", is_held_out(F.col("id")).alias("held")).collect()
    assert all(r.held == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    assert spark.sql("SELECT CAST(NULL AS LONG) AS id").select(is_held_out(F.col("id"))).first()[0] is False


def test_language_learns_nothing_from_held_out_rows(spark, documents):
    changed = documents.withColumn("lang", F.when(is_held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    assert "zz" not in language.learn(changed).languages
    assert (language.learn(changed).weights == language.learn(documents).weights).all()


def test_language_of_awkward_texts(spark, documents):
    model = language.learn(documents)
    docs = awkward(spark)
    got = language.predict(docs, model)
    assert got.columns == [*(c for c in docs.columns if c not in ("lang_pred", "score")), "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in model.languages
    again = {r.text: (r.lang_pred, r.score) for r in rows}
    assert all(again[r.text] == (r.lang_pred, r.score) for r in rows)
    kept = language.keep_identified(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} & {4, 5, 6, 10} == set()


def test_language_of_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    model = language.learn(none)
    assert model.languages == ()
    assert language.predict(none, model).count() == 0
    assert [r.lang_pred for r in language.predict(spark.createDataFrame([(1, "word", "en", "a", 4)], DOCS), model).collect()] == ["und"]


def test_ngrams_do_not_span_texts():
    apart = language.hashed_ngrams(["abc", "", "Xy z"])[0]
    for (buckets, at), n in zip(apart, (1, 2, 3), strict=True):
        joined = np.concatenate([language.hashed_ngrams([t])[0][n - 1][0] for t in ("abc", "", "Xy z")])
        assert buckets.tolist() == joined.tolist()
        assert at[-1] == len(buckets)


def test_held_out_quality_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = catalog.op3_quality(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "quality")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 800
    assert sum(r.predicted == r.quality for r in rows) > 0.98 * len(rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_of_awkward_texts(spark):
    labels = spark.createDataFrame([(d, int(d % 2), 0) for d in range(17)] + [(3, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    docs = awkward(spark)
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert len({r.score for r in rows if r.doc_id == 14}) == 1
    assert quality.keep_good(docs, model, 0.0).columns == docs.columns


def test_quality_without_labels(spark):
    docs = spark.createDataFrame([(1, "a text", "en", "a", 6)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score(docs, quality.fit(docs, none)).first().score == pytest.approx(0.5)
    assert quality.score(docs.limit(0), quality.fit(docs.limit(0), none)).count() == 0
    only_good = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.score(docs, quality.fit(docs, only_good)).first().score == pytest.approx(2 / 3)


def test_descent_reaches_the_hinge_optimum():
    # Separable in one feature: the dual solution puts both margins at one.
    sets = [np.array([0], np.int32), np.array([1], np.int32)]
    weights, bias, margins = quality._descend(sets, np.array([1.0, 1.0]), np.array([1, -1]), 10.0, 200)
    assert margins == pytest.approx([1.0, -1.0], abs=1e-2)
    assert bias == pytest.approx(0.0, abs=1e-2)
    assert weights == pytest.approx([1.0, -1.0], abs=1e-2)


def test_features_are_indicators_of_the_whole_text():
    one, two, three = quality.feature_sets(["good words here", "good words here good words here", "end " * 30])
    assert set(one) <= set(two)
    assert list(quality.feature_sets([None, ""]))[0].size == 0
    # Where a text stands in a batch does not matter.
    assert list(quality.feature_sets(["end " * 30]))[0].tolist() == three.tolist()


MASK = (1 << 64) - 1


def plain_ngrams(text):
    """Buckets of a text's letter n-grams, one by one."""
    mixed = [(ord(c) if c.isalpha() else 0) * 0x9E3779B97F4A7C15 & MASK for c in f" {text.lower()} "]
    out = []
    for n in (1, 2, 3):
        for i in range(len(mixed) - n + 1):
            # 1- and 2-grams hold a letter, 3-grams have one in the middle.
            if not (mixed[i + 1] if n == 3 else any(mixed[i : i + n])):
                continue
            value = mixed[i]
            for j in range(1, n):
                value = ((value ^ value >> 29) * 0xBF58476D1CE4E5B9 + mixed[i + j]) & MASK
            value = (value ^ value >> 32) * 0x94D049BB133111EB & MASK
            out.append(value >> 64 - language.BUCKET_BITS)
    return out


def test_language_matches_a_plain_version(spark):
    """The whole smallest table: counts in dictionaries, logarithms summed in floats."""
    import math
    import zlib
    from collections import Counter, defaultdict

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()
    counts, texts = defaultdict(Counter), Counter()
    for r in docs:
        if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2:
            counts[r.lang].update(plain_ngrams(r.text))
            texts[r.lang] += 1
    size = 1 << language.BUCKET_BITS
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    got = {r.doc_id: r for r in catalog.op9_language(spark, sf).collect()}
    assert len(got) == len(docs)
    for r in docs:
        grams = Counter(plain_ngrams(r.text or ""))
        if not grams:
            assert got[r.doc_id].lang_pred == "und"
            continue
        logs = {
            lang: math.log(texts[lang] / sum(texts.values())) + sum(n * math.log((c[g] + 1) / (totals[lang] + size)) for g, n in grams.items())
            for lang, c in counts.items()
        }
        top = max(logs.values())
        # Fixed-point rounding: at most half a unit of 2**-16 an n-gram.
        slack = 2 * (sum(grams.values()) + 1) / language.FIXED_POINT
        assert logs[got[r.doc_id].lang_pred] >= top - slack
        assert got[r.doc_id].score == pytest.approx(1 / sum(math.exp(max(v - top, -700)) for v in logs.values()), abs=slack)


def plain_features(text):
    """Buckets of a text's n-grams, one by one, with the same hash."""
    def bucket(v):
        return ((v ^ v >> 31) * int(quality._MIX_B) & MASK) >> 64 - quality.BUCKET_BITS

    mix = int(quality._MIX_A)
    framed = f" {text} " if text else "  "
    power, powers = 1, []
    for _ in framed:
        powers.append(power)
        power = power * quality._STEP & MASK

    def small(c):
        return ord(c.lower()) if c.isalpha() and len(c.lower()) == 1 else ord(c)

    def kind(c):
        if c.isalpha():
            return 65 if c.isupper() else 97
        if c.isdigit():
            return 48
        return (10 if c == "\n" else 32) if c.isspace() else ord(c)

    words = []
    for word in framed.split():
        value = sum((small(c) + 1) * mix * p for c, p in zip(word, powers, strict=False)) & MASK
        words.append(value ^ value >> 29)
    pairs = list(zip(words, words[1:], strict=False))
    found = {bucket(w) for w in words} | {bucket((a * int(quality._MIX_B) + b) & MASK) for a, b in pairs}
    found |= {bucket(3 * mix & MASK)} if any(a == b for a, b in pairs) else set()
    found |= {bucket(5 * mix & MASK)} if any(a == b == c for a, b, c in zip(words, words[1:], words[2:], strict=False)) else set()
    kinds = [kind(c) * mix & MASK for c in framed]
    for n in (3, 5) if words else ():
        for i in range(len(kinds) - n + 1):
            value = kinds[i]
            for j in range(1, n):
                value = ((value ^ value >> 27) * int(quality._MIX_B) + kinds[i + j]) & MASK
            found.add(bucket(value + n & MASK))
    return sorted(found)


def test_quality_matches_a_plain_version(spark):
    """Features one by one, ratios from dictionaries, and a model no coordinate step or shift of the margins improves."""
    import math
    from collections import Counter

    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    texts = [r.text for r in docs.where("doc_id < 40").collect()] + [r[1] for r in awkward(spark).collect()]
    assert [f.tolist() for f in quality.feature_sets(texts)] == [plain_features(t) for t in texts]

    learned = docs.join(labels.select("doc_id", "quality"), "doc_id").where(~is_held_out(F.col("doc_id")) & F.col("text").isNotNull())
    rows = learned.select("doc_id", "text", "quality").collect()
    assert 0 < len(rows) <= 2 * quality.PER_CLASS
    sets, good = list(quality.feature_sets([r.text for r in rows])), [r.quality for r in rows]
    held = [Counter(), Counter()]
    for found, label in zip(sets, good, strict=True):
        held[label].update(found.tolist())
    n = [good.count(0), good.count(1)]
    ratio = {
        g: math.log((held[1][g] + 1) / (n[1] + 2)) - math.log((held[0][g] + 1) / (n[0] + 2))
        for g in held[0].keys() | held[1].keys()
        if held[0][g] + held[1][g] >= 4
    }
    model = quality.fit(docs, labels)
    assert {g: r * r for g, r in ratio.items() if r} == pytest.approx({int(g): model.squares[g] for g in np.flatnonzero(model.squares)})

    # Scores of the whole table follow from the model's weights one feature at a time.
    got = {r.doc_id: r.score for r in catalog.op3_quality(spark, sf).collect()}
    for r in rows[:200]:
        found = [g for g in plain_features(r.text) if g in ratio]
        length = max(math.sqrt(sum(ratio[g] ** 2 for g in found)), 1e-12)
        margin = sum(model.weights[g] for g in found) / length + model.bias
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-(model.slope * margin + model.offset))), abs=1e-9)

    # The primal objective of the weights, compared with those a subgradient step away.
    share = {label: len(rows) / (2 * n[label]) for label in (0, 1)}
    unit = []
    for found in sets:
        kept = [g for g in found.tolist() if ratio.get(g)]
        length = math.sqrt(sum(ratio[g] ** 2 for g in kept)) or 1.0
        unit.append({g: ratio[g] / length for g in kept})
    weights = {g: model.weights[g] / r for g, r in ratio.items() if r}

    def objective(w, bias):
        loss = sum(
            share[label] * max(0.0, 1 - (1 if label else -1) * (sum(w[g] * x for g, x in row.items()) + bias))
            for row, label in zip(unit, good, strict=True)
        )
        return (sum(v * v for v in w.values()) + bias * bias) / 2 + loss

    best = objective(weights, model.bias)
    for step in (0.02, -0.02):
        assert objective({g: v * (1 + step) for g, v in weights.items()}, model.bias) >= best - 1e-2 * best
        assert objective(weights, model.bias + step) >= best - 1e-2 * best
    assert best < objective(dict.fromkeys(weights, 0.0), 0.0)


def test_repeated_ids_teach_their_first_text(spark):
    rows = [(i, f"plain good words number {i % 7}", "en", "a", 1) for i in range(1, 40, 2)]
    rows += [(i, f"BUY BUY BUY !!! {i % 7}", "en", "a", 1) for i in range(2, 40, 2)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 40)], "doc_id long, quality int, toxic int")
    once = quality.fit(spark.createDataFrame(rows, DOCS), labels)
    for extra in ([(1, "zzz", "en", "a", 1)], [(1, "zz zz", "en", "a", 1), (2, "zzzz", "en", "a", 1)]):
        for order in (rows + extra, extra + rows):
            again = quality.fit(spark.createDataFrame(order, DOCS), labels)
            assert (again.weights == once.weights).all() and again.bias == once.bias
