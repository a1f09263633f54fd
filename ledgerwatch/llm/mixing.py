"""Mixing sources to target weights, by index over packed blocks.

1. Sizes are words. Sources by code point, null last, get the weights in turn, and
   share the whole size by weight; a target stops at ``most`` times its source's
   size and the excess is shared by weight among the rest, until none is above.
   That is water-filling: one level, found by ordering sources by size / weight.
2. Packing. The words of a source are one stream of its documents, cut into
   blocks of ``block`` words. Start positions come from running sums in bounded
   chunks of documents and over the chunks, so a hot source is spread out.
3. Draws. A source gets whole rounds of all its blocks and, for the rest of its
   target, as many blocks more as that needs, the last of them cut, so that it gives
   its target to the word. Each of these slots falls on an output shard at random: per
   source, one multinomial draw over the shards, so the counts of a shard are
   multinomial over the sources, given totals that meet the targets. The draw is made
   by halving the range of shards again and again, a binomial draw for each half, so any
   task finds the shards of its own slots. A shard reads a range of every source's
   slots: slot k reads block P(k mod n) of round k div n, P being a pseudorandom
   permutation of the source's n blocks (another one for each round).
4. Slots join blocks by (source, block), and blocks join documents by index.

All draws come from hashes of the seed, the source and an index; reruns agree and a
task that is run again gives the same rows.

Defined results: null and blank texts have size 0 and are never taken. A source
without words has target 0. Sources that fill up at the same level, such as equal or
proportional ones, are all full or all below their limit. A target is met to the nearest
word. Repeated rows are documents of their own. The stream of a source is in the order of
chunks (by hash of doc_id), then doc_id, null ids first in their chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .base import stored

# Java's form of [^\x20\x09-\x0D]+
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[int, ...] = (5, 2, 1)
    most: int = 3  # times a document may be repeated
    block: int = 128  # words
    slots_per_shard: int = 8192
    docs_per_chunk: int = 4096
    seed: int = 20


def size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sized: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """source, source_size, documents, weight and target of every source of rows (source, size)."""
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("documents"))
    # From here one row per source.
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(in_order) - 1, F.lit(len(config.weights)))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in config.weights)), (turn + 1).cast("int"))
    weighted = by_source.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(config.most)))
    everyone = Window.partitionBy()
    # Sources fill up in the order of limit / weight. The level is what is left
    # after those that are full, per weight left; a source is full if its limit is below.
    filling = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    levels = weighted.withColumn("level", level).withColumn("open", F.col("limit") > F.col("level") * F.col("weight"))
    # That of the first open source in the order of the window; those after it have it counted as full.
    place = F.struct(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source", "level")
    common = F.min(F.when(F.col("open"), place)).over(everyone)["level"]
    return levels.withColumn("common", common).select(
        "source",
        "source_size",
        "documents",
        "weight",
        F.when(F.col("source_size") == 0, F.lit(0.0)).when(F.col("open"), F.col("common") * F.col("weight")).otherwise(F.col("limit")).alias("target"),
    )


def positions(rows: DataFrame, shares: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The rows (source, doc_id, size, ...) with ``start``, the place of their first word in the source's stream."""
    counted = rows.join(
        shares.select(F.col("source").alias("own"), F.ceil(F.col("documents") / config.docs_per_chunk).alias("chunks")), F.col("source").eqNullSafe(F.col("own"))
    ).drop("own")
    chunked = counted.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.col("chunks"))).drop("chunks")
    chunk_order = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        chunked.groupBy("source", "chunk")
        .agg(F.sum("size").alias("words"))
        .select(F.col("source").alias("own"), F.col("chunk").alias("own_chunk"), F.coalesce(F.sum("words").over(chunk_order), F.lit(0)).alias("ahead"))
    )
    in_chunk = Window.partitionBy("source", "chunk").orderBy("doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    return (
        chunked.withColumn("within", F.coalesce(F.sum("size").over(in_chunk), F.lit(0)))
        .join(ahead, F.col("source").eqNullSafe(F.col("own")) & (F.col("chunk") == F.col("own_chunk")))
        .withColumn("start", F.col("ahead") + F.col("within"))
        .drop("own", "own_chunk", "chunk", "within", "ahead")
    )


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1, at the indexes given: a Feistel network, walked until it lands below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    value = index.astype(np.uint64)
    open_ = np.ones(len(value), bool)
    while open_.any():
        left, right = value[open_] >> np.uint64(half), value[open_] & low
        for turn in range(4):
            left, right = right, left ^ (_mixed(right + np.uint64((key + turn * 0x9E3779B97F4A7C15) % (1 << 64))) & low)
        value[open_] = (left << np.uint64(half)) | right
        open_ = value >= n
    return value.astype(np.int64)


SLOTS = "source string, shard long, slot long, round int, block long, words int"
_SLOTS_ARROW = pa.schema([("source", pa.string()), ("shard", pa.int64()), ("slot", pa.int64()), ("round", pa.int32()), ("block", pa.int64()), ("words", pa.int32())])
_PIECE = 1 << 16


def _source_key(source: str | None, seed: int) -> int:
    key = seed
    for byte in b"\x00" if source is None else b"\x01" + source.encode("utf-8", "surrogatepass"):
        key = ((key ^ byte) * 0x100000001B3 + 0x9E37) % (1 << 64)
    return key


def shards_of(first: int, last: int, slots: int, shards: int, key: int) -> np.ndarray:
    """Output shards of the slots ``first`` until ``last`` of a source: part of one multinomial draw of its slots over all shards."""
    out = np.empty(last - first, np.int64)
    open_ = [(0, shards, 0, slots)]  # a range of shards, and of the slots that fall on them
    while open_:
        low, high, start, n = open_.pop()
        if start >= last or start + n <= first or not n:
            continue
        if high - low == 1:
            out[max(start - first, 0) : min(start + n, last) - first] = low
            continue
        middle = (low + high) // 2
        left = int(np.random.default_rng((key, low, high)).binomial(n, (middle - low) / (high - low)))
        open_ += [(low, middle, start, left), (middle, high, start + left, n - left)]
    return out


def draws(shares: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The mix: for each source and slot its output shard, its round, the block that it reads, and how many words of it at most."""
    asked = shares.where("source_size > 0 AND target > 0").select(
        "source",
        F.ceil(F.col("source_size") / config.block).cast("long").alias("blocks"),
        F.expr(f"source_size DIV {config.block}").alias("full"),  # blocks that are full
        F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(config.most)).cast("long").alias("rounds"),
        "source_size",
        "target",
    )
    rest = F.greatest(F.round(F.col("target") - F.col("rounds") * F.col("source_size")), F.lit(0.0)).cast("long")
    asked = asked.withColumn("rest", F.when(F.col("rounds") >= config.most, F.lit(0)).otherwise(rest).cast("long"))
    asked = asked.withColumn("slots", F.col("rounds") * F.col("blocks") + F.ceil(F.col("rest") / config.block)).where("slots > 0")
    total = asked.agg(F.sum("slots")).first()[0] or 0
    # A large source is many pieces of slots, each a row of its own; Spark would put these few rows into one task.
    pieces_ = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("slots") - 1) / _PIECE))).alias("piece")
    asked = asked.select("source", "blocks", "full", "rounds", "rest", "slots", pieces_)
    shards = max(1, -(-total // config.slots_per_shard))
    tasks = max(1, -(-total // _PIECE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                key = _source_key(row["source"], config.seed)
                blocks, whole = row["blocks"], row["rounds"] * row["blocks"]
                first, last = row["piece"] * _PIECE, min(row["slots"], (row["piece"] + 1) * _PIECE)
                slot = np.arange(first, last)
                round_ = slot // blocks
                block = np.empty(len(slot), np.int64)
                for r in np.unique(round_):
                    at = round_ == r
                    # The last round takes the full blocks first, so that only its last slot may be short.
                    n = blocks if r < row["rounds"] else max(row["full"], 1)
                    index = slot[at] % blocks
                    block[at] = np.where(index < n, permuted(np.minimum(index, n - 1), n, key + int(r) * 0x2545F4914F6CDD1D), index)
                words = np.full(len(slot), config.block, np.int32)
                if row["rest"] and last == row["slots"]:
                    words[-1] = row["rest"] - (row["slots"] - whole - 1) * config.block
                names = pa.array([row["source"]], pa.string()).take(pa.array(np.zeros(len(slot), np.int64)))
                shard = shards_of(first, last, row["slots"], shards, key)
                columns = [names, pa.array(shard), pa.array(slot), pa.array(round_.astype(np.int32)), pa.array(block), pa.array(words)]
                yield pa.RecordBatch.from_arrays(columns, schema=_SLOTS_ARROW)

    return asked.repartition(tasks, "source", "piece").mapInArrow(run, SLOTS)


def pieces(placed: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """Where documents (source, start, size) lie in blocks: source, start, block, the words ``low`` until ``high`` of the text, and ``before``, the words of the block before these."""
    blocks = F.sequence(F.floor(F.col("start") / config.block), F.floor((F.col("start") + F.col("size") - 1) / config.block))
    cut = placed.where("size > 0").select("source", "start", "size", F.explode(blocks).alias("block"))
    return cut.select(
        "source",
        "start",
        "block",
        F.greatest(F.col("block") * config.block - F.col("start"), F.lit(0)).alias("low"),
        F.least((F.col("block") + 1) * config.block - F.col("start"), F.col("size")).alias("high"),
        F.greatest(F.col("start") - F.col("block") * config.block, F.lit(0)).alias("before"),
    )


def _read_words(words: Column) -> Column:
    """How many of a piece's words a slot reads that takes the first ``words`` of the block."""
    return F.greatest(F.least(F.col("high") - F.col("low"), words - F.col("before")), F.lit(0))


def _joined(pieces_: DataFrame, drawn: DataFrame) -> DataFrame:
    other = drawn.select(F.col("source").alias("drawn_source"), F.col("block").alias("drawn_block"), *(c for c in drawn.columns if c not in ("source", "block")))
    # Spark takes the draws to be as small as the list of sources they are made from; they grow with the corpus.
    return pieces_.hint("merge").join(other.hint("merge"), F.col("source").eqNullSafe(F.col("drawn_source")) & (F.col("block") == F.col("drawn_block"))).drop("drawn_source", "drawn_block")


def narrow(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", size(F.col("text")).alias("size"), F.xxhash64("text").alias("text_hash"))


def taken(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """doc_id, source, size, source_size, target, taken (words, repeats counted) and first_shard of every row of docs.

    ``first_shard`` is the first output shard that holds words of the row, null if none does.
    """
    rows = stored(narrow(docs), "mix-sizes")
    shares = stored(targets(rows, config), "mix-targets")
    placed = stored(positions(rows, shares, config), "mix-positions")
    whole = F.col("words") == config.block  # all slots of a source but one at most
    by_block = draws(shares, config).groupBy("source", "block").agg(
        F.count_if(whole).alias("times"),
        F.min(F.when(whole, F.col("shard"))).alias("shard"),
        F.sum(F.when(~whole, F.col("words"))).alias("cut"),
        F.min(F.when(~whole, F.col("shard"))).alias("cut_shard"),
    )
    cut = _read_words(F.coalesce("cut", F.lit(0)))
    got = _joined(pieces(placed, config), by_block).groupBy("source", "start").agg(
        F.sum((F.col("high") - F.col("low")) * F.col("times") + cut).alias("taken"),
        F.min(F.least("shard", F.when(cut > 0, F.col("cut_shard")))).alias("first_shard"),
    )
    got = got.select(F.col("source").alias("got_source"), F.col("start").alias("got_start"), "taken", "first_shard")
    # Rows without words may share a start with the next row.
    with_taken = placed.hint("merge").join(
        got.hint("merge"), F.col("source").eqNullSafe(F.col("got_source")) & (F.col("start") == F.col("got_start")) & (F.col("size") > 0), "left"
    )
    share = shares.select(F.col("source").alias("own"), "source_size", "target")
    return with_taken.join(share, F.col("source").eqNullSafe(F.col("own"))).select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard"
    )


def mixed(docs: DataFrame, config: MixConfig = MixConfig(), shard_col: str | None = None) -> DataFrame:
    """The mix as rows of docs: for each round of a document the words taken of it, in order.

    With ``shard_col``, for each output shard as well, whose number is in that column,
    put last: the rows of one number are that shard.

    A document taken whole keeps its text as it is; else the words are joined by
    blanks. ``n_chars``, where docs has it, is that of the new text. A document of
    which nothing is taken is not in the mix, and one taken three times is there
    three times.
    """
    key = ["doc_id", "source", "size", "text_hash"]
    # Equal rows are told apart by number; which of them gets which makes no difference.
    numbered = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    rows = stored(narrow(docs), "mix-sizes")
    shares = stored(targets(rows, config), "mix-targets")
    placed = stored(positions(rows, shares, config).where("size > 0").withColumn("copy", numbered), "mix-positions")
    cut = _joined(pieces(placed, config), draws(shares, config).select("source", "block", "round", "words", F.col("shard").alias("got_shard")))
    cut = cut.withColumn("high", F.col("low") + _read_words(F.col("words"))).where("high > low")
    # A list of one document's pieces, so bounded by its text.
    parts = ["round", "got_shard"] if shard_col else ["round"]
    spans = cut.groupBy("source", "start", *parts).agg(F.sort_array(F.collect_list(F.struct("low", "high"))).alias("spans"))
    spans = spans.select(F.col("source").alias("got_source"), F.col("start").alias("got_start"), "spans", *parts)
    chosen = placed.hint("merge").join(spans.hint("merge"), F.col("source").eqNullSafe(F.col("got_source")) & (F.col("start") == F.col("got_start")))
    chosen = chosen.select(*(F.col(c).alias(f"got_{c}") for c in (*key, "copy")), "spans", *parts)
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        "doc_id",
        "source",
        size(F.col("text")).alias("size"),
        F.xxhash64("text").alias("text_hash"),
    )
    # The only shuffle of texts.
    whole = whole.where("size > 0").withColumn("copy", numbered)
    same = F.lit(True)
    for c in (*key, "copy"):
        same = same & F.col(c).eqNullSafe(F.col(f"got_{c}"))
    joined = whole.hint("merge").join(chosen.hint("merge"), same)
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["high"] - s["low"])
    words = F.regexp_extract_all(F.col("row.text"), F.lit(WORD), F.lit(0))
    picked = F.transform(
        F.array(words), lambda w: F.array_join(F.flatten(F.transform("spans", lambda s: F.slice(w, (s["low"] + 1).cast("int"), (s["high"] - s["low"]).cast("int")))), " ")
    )[0]
    text = F.when(covered == F.col("size"), F.col("row.text")).otherwise(picked)
    fields = {"text": text} | ({"n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    shard = [F.col("got_shard").alias(shard_col)] if shard_col else []
    return joined.select(*(fields.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c != shard_col), *shard)
