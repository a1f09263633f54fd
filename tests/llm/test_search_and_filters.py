"""Top-k search, URL filters, license scans and fingerprints against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerwatch.llm import catalog, fingerprints, licenses, topk, urls

from .fixtures import DOCS, SPACE_WORD, awkward, awkward_rows

VECTORS = "vec_id long, embedding array<float>, label int"


def brute_topk(rows, is_query, k):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256.0 * float(np.float32(x))) for x in v]
        vectors[i] = min(vectors.get(i, whole), whole)
    out = []
    for q, a in vectors.items():
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in vectors.items() if i != q)
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def found(frame):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in frame.collect())


@pytest.mark.parametrize("blocks", [(65_536, 2048), (40, 3)])
def test_topk_matches_brute_force(spark, blocks):
    random.seed(4)
    rows = [(i, [random.uniform(-1, 1) for _ in range(6)]) for i in range(160)]
    rows += [(200 + i, rows[7][1]) for i in range(60)]  # one very common vector: ties
    rows += [(300, None), (301, [0.1, None, 0.2, 0.3, 0.4, 0.5]), (302, [float("nan")] * 6), (303, [float("inf")] * 6)]
    rows += [(10, rows[10][1]), (20, [0.5] * 6), (None, [0.1] * 6), (304, []), (305, [3.5, -2.25]), (306, [0.0] * 6)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS)
    config = topk.TopKConfig(rows=blocks[0], queries=blocks[1], slices=3)
    assert found(topk.search(frame, F.col("vec_id") % 10 == 0, config)) == brute_topk(rows, lambda i: i % 10 == 0, 5)


def test_topk_of_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0], 0), (50, [1.0, -2.0], 0), (7, [0.5, 0.5], 0)]
    frame = spark.createDataFrame(rows, VECTORS)
    assert found(topk.search(frame, F.col("vec_id") % 50 == 0)) == brute_topk([r[:2] for r in rows], lambda i: i % 50 == 0, 5)
    assert topk.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.search(frame, F.lit(False)).count() == 0


def test_topk_sums_are_exact_without_quantisation():
    rng = np.random.default_rng(5)
    values, query = rng.integers(-40, 40, (300, 9)), rng.integers(-40, 40, 9)
    block = topk.SlicedBlock(np.arange(300), values, 16)
    assert block.shift == 0
    total = np.zeros(300, np.int64)
    for c, bitmap in enumerate(block.sum_slices(query)):
        total += np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:300].astype(np.int64) << c
    top = np.array([(1 << b) - 1 for b in block.bits])
    wanted = (values - block.low) @ query + (np.abs(query) * top)[query < 0].sum()
    assert (total == wanted).all()


def base_verdict(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate({c: c + 32 for c in range(65, 91)})
    path = re.match(r"[^?#]*", rest[len(re.match(r"[^/?#]*", rest).group()) :]).group()
    fits = [
        (len(h + p), h + p, v)
        for h, p, v in (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [
    None, "", "no scheme", "http://", "://net/", "http://NET/", "http://net", "http://net?x=/", "http://a.example.net/en/1", "http://example.net/en",
    "http://example.net/enx/", "http://notexample.net/en/", "https://www.example.com/de/a?b#c", "https://example.com/DE/", "http://x.org/fr/", "http://org/fr/",
    "http://forg/fr/", "http://x.org/en/http://y.net/", "http://a.com/casino/x", "http://casino.org/fr/", "http://a.com/casinos", "http://a.com/CASINO",
    "http://a.com/free-download", "http://a.com/x/wp-login.php", "http://a.com/wp-login.phpx", "http://é.net/ü/", "http://u@net:80/", "http://a.com/" + "x/" * 3000,
    "http://net/\nabc", "http://a.com/free_downloads/xxx",
]


def test_url_verdicts(spark):
    pages = spark.createDataFrame([(i, u, "m", "m") for i, u in enumerate(URLS)] + [(None, "http://net/", "m", "m"), (3, "http://net/", "m", "m")], "page_id long, url string, host string, rule string")
    rows = urls.judge(pages).collect()
    assert len(rows) == len(URLS) + 2
    by_id = {r.page_id: r for r in rows if r.page_id != 3}
    for i, url in enumerate(URLS):
        if i == 3:
            continue
        host, path, rule, verdict = base_verdict(url)
        assert (by_id[i].host, by_id[i].path, by_id[i].rule) == (host, path, rule), url
        assert by_id[i].verdict == (verdict or ("block" if by_id[i].pattern_rule else "allow")), url
    named = {url: by_id[i].pattern_rule for i, url in enumerate(URLS) if i != 3}
    assert named["http://a.com/casino/x"] == named["http://a.com/CASINO"] == "*casino*"
    assert named["http://a.com/casinos"] is named["http://casino.org/fr/"] is None
    assert named["http://a.com/free-download"] == named["http://a.com/free_downloads/xxx"] == "free-download"
    assert named["http://a.com/x/wp-login.php"] == "wp-login.php" and named["http://a.com/wp-login.phpx"] is None
    assert urls.judge(pages.limit(0)).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    rules = urls.rule_frame(spark, (*urls.BASE_RULES, urls.UrlRule("r", "block", "a-b", ("a", "b"), 1)))
    tokens = spark.createDataFrame([("net",)] * 5 + [("example",)] * 3 + [("en",)] * 9 + [("a",)] * 2 + [("b",)], "token string")
    filed = {r.rule: r.token for r in urls.indexed(rules, tokens).collect()}
    assert filed == {"net/": "net", "example.net/en/": "example", "example.com/de/": "com", "org/fr/": "fr", "r": "b"}
    with pytest.raises(ValueError):
        urls.rule_frame(spark, (urls.UrlRule("r", "block", ".", (), 1),))


def brute_licenses(text, share=0.8):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    places = sorted(
        (i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
    )
    blocks = []
    for start in range(0, max(len(words) - 128, 1), 128):
        block = set(words[start : start + 256])
        for label, template in licenses.TEMPLATES:
            own = set(template.split())
            if len(own & block) >= math.ceil(share * len(own) - 1e-9):
                blocks.append((label, start, len(own & block) / len(own)))
    return len(words), places, sorted(blocks)


def test_licenses_match_brute_force(spark):
    random.seed(6)
    rows = list(awkward_rows())
    filler = [f"word{i}" for i in range(500)] + ["the", "of", "software", "license", "this"]
    for i in range(120):
        text = random.choices(filler, k=random.choice([0, 3, 60, 700, 1500]))
        for _ in range(random.randrange(3)):
            notice = random.choice(licenses.TEMPLATES)[1].split()
            notice = [w for w in notice if random.random() < random.choice([1, 0.9, 0.8, 0.7])]
            at = random.randrange(len(text) + 1)
            text[at:at] = [w.upper() if random.random() < 0.2 else w for w in notice]
        if i % 3 == 0:
            text[:0] = random.choice(list(licenses.PHRASES)).split() * random.randrange(1, 4)
        rows.append((1000 + i, random.choice([" ", ", ", "\n"]).join(text), "en", "a", 0))
    rows.append((2000, "mit license mit license MIT-License. smit license mit licenses cc  by", "en", "a", 0))
    docs = spark.createDataFrame(rows, DOCS).withColumn("n_words", F.lit("mine"))
    scanned = licenses.scan(docs).collect()
    digests = {r.doc_id: r for r in licenses.digest(licenses.scan(docs)).collect()}
    assert len(scanned) == len(rows)
    met = 0
    for r in scanned:
        words, places, blocks = brute_licenses(r.text)
        assert r.n_words == words
        assert [(p.start, p.label) for p in r.places] == places
        assert sorted((b.label, b.start, b.containment) for b in r.blocks) == blocks
        met += len(blocks)
        if r.doc_id is not None and r.doc_id >= 1000:
            d = digests[r.doc_id]
            assert d.n_base == len(places)
            assert (d.first_word, d.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
            assert d.base_labels == ",".join(sorted({x for _, x in places}))
            assert d.labels == ",".join(sorted({x for _, x in places} | {b[0] for b in blocks}))
            assert d.score == pytest.approx(1.0 if places else max([0.0, *(b[2] for b in blocks)]))
    assert met > 20
    assert licenses.scan(docs.limit(0)).count() == 0


def shingles(text):
    words = SPACE_WORD.findall(text)
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_fingerprints_of_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in catalog.op10_fingerprints(spark, sf).collect()}
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert len(got) == len(docs)
    for at, (doc_id, text) in enumerate(docs):
        after = docs[(at + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        a, b, c = shingles(text), shingles(edited), shingles(after)
        assert r.near_edited == pytest.approx(likeness(a, b), abs=0.2)
        assert r.near_next == pytest.approx(likeness(a, c), abs=0.2)
        if max(len(a | b), len(a | c)) < 128:
            assert (r.near_edited, r.near_next) == (pytest.approx(likeness(a, b)), pytest.approx(likeness(a, c)))
            assert r.distinct_shingles == len(a)
            assert r.kept == pytest.approx(len(a & b) / len(a) if a else 1.0)
    same = {}
    for doc_id, text in docs:
        assert same.setdefault(text, got[doc_id].fingerprint) == got[doc_id].fingerprint


def test_fingerprints_of_awkward_rows(spark):
    rows = fingerprints.edited_pairs(awkward(spark)).collect()
    assert len(rows) == len(awkward_rows())
    order = sorted(((-1 if i is None else i), t or "") for i, t, *_ in awkward_rows())
    wanted = sorted(t[: len(t) - len(t) // 2] + order[(at + 1) % len(order)][1][: len(t) // 2] for at, (_, t) in enumerate(order))
    assert sorted(r.edited_text for r in rows) == wanted
    assert all(r.sketch == [] for r in rows if r.n_chars == 0)
    assert fingerprints.edited_pairs(awkward(spark).limit(0)).count() == 0
    alone = fingerprints.edited_pairs(spark.createDataFrame([(1, "ab cd", "en", "a", 5)], DOCS)).first()
    assert alone.edited_text == "ab ab" and alone.near_next == 1.0


def test_next_over_sparse_ids_and_many_ranges(spark):
    ids = [-(1 << 62), -5, 0, 1, 2, 10**12, 10**12 + 1, 1 << 62]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids] + [(10**9 + i, f"t{10**9 + i}") for i in range(5000)], "doc_id long, text string")
    rows = {r.doc_id: r.next.t for r in fingerprints.with_next(docs, lambda t: []).collect()}
    order = sorted([*ids, *(10**9 + i for i in range(5000))])
    assert rows == {a: f"t{b}" for a, b in zip(order, [*order[1:], order[0]], strict=True)}


def test_one_far_id_leaves_the_ranges_even(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("t"))
    dense = spark.range(20_000).select((F.col("id") + (1 << 40)).alias("doc_id"), F.lit("t").alias("t"))
    far = spark.createDataFrame([(1 << 60, "t"), (None, "t")], "doc_id long, t string")
    at, dealt = fingerprints._ranges(docs.unionByName(dense).unionByName(far))
    rows = dealt.select("doc_id", at.alias("range")).collect()
    assert len(rows) == 40_002
    counts = {}
    for r in rows:
        counts[r.range] = counts.get(r.range, 0) + 1
    assert counts.pop(-1) == 1
    ordered = sorted((r.doc_id, r.range) for r in rows if r.doc_id is not None)
    assert [b for _, b in ordered] == sorted(b for _, b in ordered)
    at, dealt = fingerprints._ranges(docs.unionByName(far))
    sizes = [r["count"] for r in dealt.groupBy(at.alias("range")).count().where("range >= 0").collect()]
    assert len(sizes) >= 9 and max(sizes) <= 2100


def test_sketches_of_parts_merge_into_the_whole(spark):
    config = fingerprints.SketchConfig(words=1, k=8)
    parts = [(1, " ".join(f"w{i}" for i in range(a, a + 20))) for a in range(0, 60, 10)] + [(2, ""), (3, "one two")]
    frame = spark.createDataFrame(parts, "key long, text string").select("key", fingerprints.sketch(F.col("text"), config).alias("s"))
    got = {r.key: r.s for r in fingerprints.merged(frame, ["key"], "s", config).collect()}
    whole = spark.createDataFrame([(" ".join(t for k, t in parts if k == key), key) for key in (1, 3)], "text string, key long")
    wanted = {r.key: r.s for r in whole.select("key", fingerprints.sketch(F.col("text"), config).alias("s")).collect()}
    assert got == wanted
    assert len(wanted[1]) == 8


def test_rules_are_literals_without_python(spark):
    frame = urls.rule_frame(spark, urls.BASE_RULES)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" not in plan and "Python" not in plan
    assert urls.rule_frame(spark, ()).schema.names == frame.schema.names
    assert urls.rule_frame(spark, ()).count() == 0


def test_queries_with_sql_match_it(spark):
    import duckdb

    from tests.compare import difference

    sf = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for table in ("embeddings", "pages"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    for name, (run, sql) in catalog.ENTRIES.items():
        if sql is not None:
            frame, twin = run(spark, sf), db.sql(sql)
            assert difference(frame.columns, frame.collect(), twin.columns, twin.fetchall()) is None, name
