"""Registered queries of the corpus operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, counts, fingerprints, jaccard, language, lexical, licenses, mixing, pieces, quality, tokenfiles, topk, urls, vocabulary
from .base import is_held_out, read


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP1_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, v.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


def op2_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents")).drop("set_hash", "root")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    judged = quality.score(docs.select("doc_id", "text"), quality.fit(docs, read(spark, sf_dir, "labels")))
    return judged.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(read(spark, sf_dir, "documents").select("doc_id", "text")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.taken(read(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "first_shard")


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_and_check(read(spark, sf_dir, "documents"), vocabulary.load())


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return counts.count_tokens(docs, vocabulary.load()).drop("text")


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages").select("page_id", "url"))


OP8_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM cut
), rules(rule, verdict, rule_host, rule_path) AS (
  VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
         ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')
), fits AS (
  SELECT page_id, host, path,
    (SELECT max_by({'rule': r.rule, 'verdict': r.verdict}, length(r.rule)) FROM rules r
     WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS base,
    translate(host || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS place
  FROM parts
), patterns(name, pattern, priority) AS (
  SELECT '*' || w || '*', '(^|[^a-z0-9])' || w || '([^a-z0-9]|$)', length(w)
  FROM (SELECT unnest(['casino', 'porn', 'xxx', 'adserver', 'doubleclick', 'phishing', 'malware', 'torrent', 'gambling', 'betting']) AS w)
  UNION ALL SELECT 'free-download', '(^|[^a-z0-9])free[-_]downloads?([^a-z0-9]|$)', 13
  UNION ALL SELECT 'wp-login.php', '/wp-login\.php$', 12
), judged AS (
  SELECT *, CASE WHEN base IS NULL THEN
    (SELECT max({'priority': priority, 'name': name}) FROM patterns WHERE regexp_matches(place, pattern)) END AS own
  FROM fits
)
SELECT page_id, host, path, base.rule AS rule,
  coalesce(base.verdict, CASE WHEN own IS NULL THEN 'allow' ELSE 'block' END) AS verdict, own.name AS pattern_rule
FROM judged
"""


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    judged = language.predict(docs.select("doc_id", "text"), language.learn(docs))
    return judged.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(read(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        fingerprints.distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
        fingerprints.containment(F.col("sketch"), F.col("edited_sketch")).alias("kept"),
    )


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = Path(public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    return tokenfiles.digests(tokenfiles.write(read(spark, sf_dir, "documents"), tokenizer))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(read(spark, sf_dir, "embeddings"))


def _op12_sql(rounds: int = 10) -> str:
    """The rounds one after the other; distances to all centroids in plain."""

    def assigned(r: int) -> str:
        return f"""a{r} AS MATERIALIZED (
  SELECT row, vec_id, v, min(s) AS s FROM (
    SELECT row, vec_id, v, {{'distance': CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'cluster': cluster}} AS s
    FROM kept CROSS JOIN c{r}
  ) GROUP BY ALL
)"""

    def moved(r: int) -> str:
        return f"""c{r + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
    SELECT cluster, list((t - ((t % n) + n) % n) // n ORDER BY dim) AS c
    FROM (SELECT s.cluster AS cluster, dim, CAST(sum(v[dim]) AS BIGINT) AS t, count(*) AS n FROM a{r}, (SELECT unnest(range(1, 65)) AS dim) GROUP BY ALL)
    GROUP BY cluster
  ) AS m USING (cluster)
)"""

    steps = ",\n".join(f"{assigned(r)},\n{moved(r)}" for r in range(rounds))
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS cluster, v AS c
  FROM (SELECT v, sha256('3:' || vec_id) AS h FROM kept ORDER BY h LIMIT 8)
),
{steps},
{assigned(rounds)}
SELECT vec_id, s.cluster AS cluster, s.distance AS distance,
  CAST(sum(s.distance) OVER (PARTITION BY s.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(s.distance) OVER () AS BIGINT) AS inertia,
  (SELECT sha256(array_to_string(c, ',')) FROM c{rounds} AS last WHERE last.cluster = s.cluster) AS centroid_sha256
FROM a{rounds}
"""


OP12_SQL = _op12_sql()


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS row, doc_id,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), totals AS (
  SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS l FROM words WHERE len(t) > 0
), found AS (
  SELECT row, doc_id, n, term, count(*) AS tf FROM (SELECT row, doc_id, len(t) AS n, unnest(t) AS term FROM words) GROUP BY ALL
), weighed AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM found GROUP BY term), totals
), asked AS (
  SELECT DISTINCT item_id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark
), scored AS (
  SELECT item_id, row, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // l)))) AS BIGINT) AS score
  FROM asked JOIN weighed USING (term) JOIN found USING (term), totals GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""


ENTRIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_topk": (op1_topk, OP1_SQL),
    "op2_jaccard": (op2_jaccard, None),
    "op3_quality": (op3_quality, None),
    "op4_licenses": (op4_licenses, None),
    "op5_mixing": (op5_mixing, None),
    "op6_pieces": (op6_pieces, None),
    "op7_token_counts": (op7_token_counts, None),
    "op8_urls": (op8_urls, OP8_SQL),
    "op9_language": (op9_language, None),
    "op10_fingerprints": (op10_fingerprints, None),
    "op11_token_files": (op11_token_files, None),
    "op12_centroids": (op12_centroids, OP12_SQL),
    "op13_lexical": (op13_lexical, OP13_SQL),
}
