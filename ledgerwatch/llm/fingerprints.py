"""Document fingerprints: bottom-k sketches of word shingle hashes, in SQL functions only.

A sketch is the k smallest distinct 64-bit hashes of a text's shingles, sorted, as
``array<long>``. It is exact for texts of at most k distinct shingles. Sketches of
parts merge into the sketch of the whole, and estimate resemblance, containment
and the number of distinct shingles.

Defined results: null is the empty text; its sketch is empty. A text of fewer words
than a shingle is one shingle. Two empty sketches resemble each other fully, an
empty and another not at all. Equal texts have equal sketches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WORD = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096


@dataclass(frozen=True)
class SketchConfig:
    words: int = 5
    k: int = 128


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def sketch(text: Column, config: SketchConfig = SketchConfig()) -> Column:
    words = F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))

    def of_hashes(h: Column) -> Column:
        last = F.greatest(F.size(h) - config.words + 1, F.lit(1))
        shingles = F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(h, i, config.words)))
        none = F.array().cast("array<bigint>")
        return F.when(F.size(h) > 0, F.slice(F.sort_array(F.array_distinct(shingles)), 1, config.k)).otherwise(none)

    return _bound(F.coalesce(words, F.array().cast("array<bigint>")), of_hashes)


def merge(a: Column, b: Column, config: SketchConfig = SketchConfig()) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, config.k)


def merged(parts: DataFrame, keys: list[str], sketch_col: str, config: SketchConfig = SketchConfig()) -> DataFrame:
    """One sketch per key from the sketches of its parts, however many.

    Every task passes on at most k hashes of a key, so a hot key stays small.
    """
    hashes = parts.select(*keys, F.explode(sketch_col).alias("hash")).distinct()
    ranked = hashes.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("hash")))
    return ranked.where(F.col("rank") <= config.k).groupBy(*keys).agg(F.sort_array(F.collect_list("hash")).alias(sketch_col))


def resemblance(a: Column, b: Column, config: SketchConfig = SketchConfig()) -> Column:
    """Estimated Jaccard likeness of the shingle sets: the share of common hashes among the k smallest of both."""
    shared = F.size(F.array_intersect(F.array_intersect(a, b), merge(a, b, config)))
    both = F.least(F.size(F.array_union(a, b)), F.lit(config.k))
    return F.when(both > 0, shared / both).otherwise(F.lit(1.0))


def distinct_shingles(a: Column, config: SketchConfig = SketchConfig()) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(a, config.k).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < config.k, F.size(a).cast("double")).otherwise((config.k - 1) / share)


def containment(a: Column, b: Column, config: SketchConfig = SketchConfig()) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    common = resemblance(a, b, config) * distinct_shingles(merge(a, b, config), config)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(common / distinct_shingles(a, config), F.lit(1.0)))


def as_text(a: Column) -> Column:
    """A sketch as fixed-width hexadecimal."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _ranges(rows: DataFrame) -> tuple[Column, DataFrame]:
    """The number of a row's range of ids, and the rows with what tells it; -1 for a null id.

    Ids are counted in 4,096 buckets of equal width. Within a bucket they are taken
    as even between its own least and largest, which gives every id a place among
    all, rising with the id; a range is about 2,048 places, or up to 65,536 where
    that makes more than 4,096 ranges. Far ids do not put all documents into one
    range; stretches of ids that share one bucket may fall into few. The buckets
    are the only table broadcast.
    """
    ids = rows.select("doc_id").where("doc_id IS NOT NULL")
    span = ids.agg(F.min("doc_id").cast("double").alias("low"), F.max("doc_id").cast("double").alias("high"), F.count("*").alias("n")).first()
    ranges = max(1, min(-(-span.n // 2048), max(4096, -(-span.n // 65536))))
    places = -(-span.n // ranges) or 1
    low, width = span.low or 0.0, (((span.high or 0.0) - (span.low or 0.0)) / BUCKETS) or 1.0
    bucket = F.least(F.floor((F.col("doc_id").cast("double") - F.lit(low)) / F.lit(width)).cast("int"), F.lit(BUCKETS - 1))
    bucket = F.when(F.col("doc_id").isNotNull(), bucket).alias("id_bucket")

    counted = ids.select("doc_id", bucket).groupBy("id_bucket")
    counted = counted.agg(F.min("doc_id").cast("double").alias("id_least"), F.max("doc_id").cast("double").alias("id_most"), F.count("*").alias("id_count"))
    before = F.sum("id_count").over(Window.orderBy("id_bucket").rowsBetween(Window.unboundedPreceding, -1))
    buckets = counted.withColumn("id_before", F.coalesce(before, F.lit(0)))
    share = (F.col("doc_id").cast("double") - F.col("id_least")) / F.greatest(F.col("id_most") - F.col("id_least"), F.lit(1.0))
    place = F.col("id_before") + F.least(F.floor(share * F.col("id_count")), F.col("id_count") - 1)
    at = F.coalesce(F.floor(place / F.lit(places)).cast("long"), F.lit(-1).cast("long"))
    return at, rows.withColumn("id_bucket", bucket).join(F.broadcast(buckets), "id_bucket", "left")


def with_next(docs: DataFrame, make) -> DataFrame:
    """Rows doc_id and t (the text, null as empty), columns of ``make(t)``, and all but doc_id of the next row under ``next``.

    Next is by ascending doc_id (null first, then by text); after the last comes
    the first. Rows are dealt by ranges of ids, in which a window looks ahead; the
    last row of a range gets the first row of the next range from a small table, one
    row per range. The text is shuffled once and nothing is sorted as a whole.
    """
    rows = docs.select(F.col("doc_id"), F.coalesce("text", F.lit("")).alias("t"))
    at, dealt = _ranges(rows)

    firsts = dealt.groupBy(at.alias("range")).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id")).alias("first"))
    in_turn = Window.orderBy("range")
    start = F.min_by("first", "range").over(Window.partitionBy())
    follow = firsts.select("range", F.coalesce(F.lead("first").over(in_turn), start)["doc_id"].alias("next_id"))
    wanted = follow.select(F.col("next_id").alias("first_id")).distinct()
    texts = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("first_id"))).groupBy("first_id").agg(F.min("t").alias("t"))
    made = texts.select("first_id", F.struct("t", *make(F.col("t"))).alias("far"))
    beyond = follow.join(made, F.col("next_id").eqNullSafe(F.col("first_id"))).select("range", "far")

    order = Window.partitionBy("range").orderBy("doc_id", "t")
    ahead = dealt.withColumn("range", at).withColumn("next_t", F.lead("t").over(order))
    ahead = ahead.select("range", "doc_id", "t", "next_t", *make(F.col("t")))
    extra = [c for c in ahead.columns if c not in ("range", "doc_id", "t", "next_t")]
    ahead = ahead.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in extra))
    joined = ahead.join(beyond, "range")
    following = F.when(F.col("next_t").isNull(), F.col("far")).otherwise(F.struct(F.col("next_t").alias("t"), *(F.col(f"next_{c}").alias(c) for c in extra)))
    return joined.select("doc_id", "t", *extra, following.alias("next"))


def edited_pairs(docs: DataFrame, config: SketchConfig = SketchConfig()) -> DataFrame:
    """Each document's sketch, that of its edited text, and their likeness to each other and to the next document.

    doc_id, n_chars, edited_text, sketch, edited_sketch, near_edited, near_next.
    """
    rows = with_next(docs, lambda t: [sketch(t, config).alias("sketch")])
    n = F.length("t")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("t"), F.lit(1), n - half), F.substring(F.col("next.t"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited_text"), "sketch", F.col("next.sketch").alias("next_sketch"))
    rows = rows.withColumn("edited_sketch", sketch(F.col("edited_text"), config))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_text",
        "sketch",
        "edited_sketch",
        resemblance(F.col("sketch"), F.col("edited_sketch"), config).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), config).alias("near_next"),
    )
