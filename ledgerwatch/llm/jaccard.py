"""N-gram Jaccard join: documents whose shingle sets overlap enough, exactly.

1. Each text becomes its set of word shingles (64-bit hashes, sorted). Equal sets
   are one class; a class of any number of copies is one row from here on.
2. Candidates. A linked set may miss at most ``miss`` of its shingles in the other.
   A fixed share of all possible hashes is counted over the classes; a set with more
   than ``miss`` counted shingles of its own alone links with nothing. The others
   are ordered by one global order, counted shingles first, the rarest first; two
   linked sets share one of their first ``miss + 1``. Sets that share such a shingle,
   in a band of sizes that can link, are joined to the smallest of them.
   Components of these candidates bound what has to be compared.
3. Tiles. A component's sets are dealt to blocks by size band; a tile is a pair of
   blocks whose sizes can link. In a tile every pair is bounded from above by the
   bit counts of hashed bitmap signatures; the rest intersect their sorted arrays.
   Each pair meets in exactly one tile, so links are counted exactly, while a tile
   returns one row per set and no pairs.
4. Components of the links; each is named by its smallest doc_id.

Defined results: a text without words has the empty set: no links, its own
component. Null texts are such texts. Repeated rows are copies. Equal doc_ids
with different texts are different documents that print the same id. Rows with a
null doc_id are left out of the sets (they have no id to report), and returned
with their own size, no links and a null component.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import bitfilter
from .base import SPACE_WORD, Workspace, stored, tidy
from .graph import components

BLOCK_SETS, BLOCK_HASHES = 512, 1 << 19
_MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class JaccardConfig:
    """Sets link when ``over * intersection >= share * union``."""

    words: int = 3
    share: int = 90
    over: int = 100

    @property
    def counted_below(self) -> int:
        """Hashes from 0 to this, of 2**64, are counted: 1.75 times the share that a linked set may miss."""
        return int(min(0.5, 1.75 * (self.over - self.share) / self.over) * (1 << 64))

    def miss(self, size):
        return size * (self.over - self.share) // self.over


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX_B
    values = (values ^ (values >> np.uint64(27))) * _MIX_A
    return values ^ (values >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    found = SPACE_WORD.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    if not len(hashes):
        return hashes
    span = min(words, len(hashes))
    count = len(hashes) - span + 1
    value = np.full(count, span, np.uint64)
    for j in range(span):
        value = _mixed(value * _MIX_A + hashes[j : j + count])
    return np.unique(value)


def counted_and_first(found: np.ndarray, config: JaccardConfig) -> np.ndarray:
    """The hashes of a set that are counted, and as many more in order as its first miss + 1 may need."""
    counted = int(np.searchsorted(found, np.uint64(config.counted_below)))
    return found[: max(counted, config.miss(len(found)) + 1)].view(np.int64)


SETS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_hash", T.BinaryType()),
    ]
)


def _set_hash(found: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(found.tobytes())


def keyed_sets(docs: DataFrame, config: JaccardConfig) -> DataFrame:
    """doc_id, n_shingles, set_hash and the hashes that candidates are found by, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for start in range(0, len(batch), 256):
                sets = [shingle_set(t, config.words) for t in texts.slice(start, 256).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(start, 256),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(map(_set_hash, sets), pa.binary()),
                        pa.array([counted_and_first(s, config) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=[*SETS.names, "hashes"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(tidy(run), T.StructType([*SETS.fields, T.StructField("hashes", T.ArrayType(T.LongType()))]))


def _signatures(ids: np.ndarray, owner: np.ndarray, count: int, longest: int) -> np.ndarray:
    """One row of 64-bit words per set: bit h mod width for each of its hashes."""
    width = 1 << max(8, min(14, int(2 * longest - 1).bit_length()))
    bits = np.zeros((count, width), bool)
    bits[owner, (ids % np.uint64(width)).astype(np.int64)] = True
    return np.packbits(bits, axis=1).view(np.uint64)


def tile_links(sets: list[np.ndarray], side: np.ndarray, config: JaccardConfig, one_block: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """All linked pairs (i, j): i < j of one block, or of sides 0 and 1 where two blocks meet, of which one may be empty."""
    sizes = np.array([len(s) for s in sets])
    signatures = _signatures(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets), int(sizes.max()))
    out_i, out_j = [], []
    for i in np.flatnonzero(side == 0):
        others = np.arange(i + 1, len(sets)) if one_block else np.flatnonzero(side == 1)
        # 100 * shared >= 90 * union, with union = sum of sizes - shared
        need = -(-(sizes[i] + sizes[others]) * config.share // (config.over + config.share))
        fits = np.minimum(sizes[i], sizes[others]) >= need
        others, need = others[fits], need[fits]
        # A bit that only one of two signatures has stands for a shingle that only one has.
        mine = np.bitwise_count(signatures[i] & ~signatures[others]).sum(axis=1, dtype=np.int64)
        theirs = np.bitwise_count(signatures[others] & ~signatures[i]).sum(axis=1, dtype=np.int64)
        fits = np.minimum(sizes[i] - mine, sizes[others] - theirs) >= need
        others, need = others[fits], need[fits]
        if len(others):
            chosen = np.concatenate([sets[j] for j in others])
            at = np.minimum(np.searchsorted(sets[i], chosen), sizes[i] - 1)
            ends = np.cumsum(sizes[others])
            hits = np.concatenate([[0], np.cumsum(sets[i][at] == chosen)])
            linked = others[hits[ends] - hits[ends - sizes[others]] >= need]
            out_i.append(np.full(len(linked), i))
            out_j.append(linked)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *out_i]), np.concatenate([none, *out_j])


def _roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest place in each place's component."""
    root = np.arange(count)
    while len(left):
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    while (root[root] != root).any():
        root = root[root]
    return root


def _tile(config: JaccardConfig):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        nodes = table.column("node").to_numpy()
        table = table.filter(pa.array(np.concatenate([[True], nodes[1:] != nodes[:-1]])))
        found = table.column("found").combine_chunks()
        values, cuts = found.values.to_numpy().view(np.uint64), found.offsets.to_numpy()
        sets = [values[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        names, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        _, block, kind, other = table.column("tile")[0].as_py()
        i, j = tile_links(sets, table.column("side").to_numpy(), config, kind == 0 and block == other)
        links = np.zeros(len(sets), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        keep = links > 0
        return pa.table({"node": names[keep], "root": names[_roots(len(sets), i, j)][keep], "links": links[keep]})

    return run


def _tiles(members: DataFrame, config: JaccardConfig) -> DataFrame:
    """node, tile and side of every set: one row per tile that it is part of.

    A component that fits a block is one tile. A larger one is cut into blocks by
    size band and hash; blocks of the same or of adjacent bands meet.
    """
    whole = members.groupBy("component").agg(F.count("*").alias("all"), F.sum("n_shingles").alias("all_hashes"))
    small = (F.col("all") <= BLOCK_SETS) & (F.col("all_hashes") <= 2 * BLOCK_HASHES)
    # Sizes that link differ by a factor of share / over at most, so by one such band at most; equal sizes need some width.
    width = max(1.1 * float(np.log(config.over / config.share)), 0.01)
    banded = members.join(whole, "component").withColumn("band", F.when(small, F.lit(0)).otherwise(F.floor(F.log("n_shingles") / F.lit(width))).cast("long"))
    blocks = banded.groupBy("component", "band").agg(
        F.when(F.first(small), F.lit(1))
        .otherwise(F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_HASHES)))
        .cast("long")
        .alias("blocks")
    )
    above = blocks.select("component", (F.col("band") - 1).alias("band"), F.col("blocks").alias("blocks_above"))
    below = blocks.select("component", (F.col("band") + 1).alias("band"), F.col("blocks").alias("blocks_below"))
    dealt = (
        banded.join(blocks.join(above, ["component", "band"], "left").join(below, ["component", "band"], "left"), ["component", "band"])
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    )

    def to(count: str, tile, side) -> Column:
        numbers = F.when(F.col(count) > 0, F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
        return F.coalesce(F.transform(numbers, lambda o: F.struct(tile(o).alias("tile"), side(o).cast("int").alias("side"))), F.array())

    band, block = F.col("band"), F.col("block")
    own = to("blocks", lambda o: F.array(band, F.least(block, o), F.lit(0).cast("long"), F.greatest(block, o)), lambda o: block > o)
    up = to("blocks_above", lambda o: F.array(band, block, F.lit(1).cast("long"), o), lambda o: F.lit(0))
    down = to("blocks_below", lambda o: F.array(band - 1, o, F.lit(1).cast("long"), block), lambda o: F.lit(1))
    return dealt.select("component", "node", F.explode(F.concat(own, up, down)).alias("at")).select("component", "node", "at.tile", "at.side")


def _candidates(classes: DataFrame, config: JaccardConfig, work: Workspace) -> DataFrame:
    """``child`` > ``parent``: edges that connect every two classes that may link."""
    counted = (F.col("hash") >= 0) & (F.col("hash") < config.counted_below)
    miss = F.floor(F.col("n_shingles") * (config.over - config.share) / config.over)
    seen = classes.select("node", F.explode("hashes").alias("hash")).where(counted)
    per_hash = seen.groupBy("hash").agg(F.count("*").alias("sets"), F.min("node").alias("node"))
    # One row for each hash of several sets, and one for each set with hashes of its own alone.
    tally = work.stored(
        per_hash.groupBy(F.when(F.col("sets") > 1, F.col("hash")).alias("hash"), F.when(F.col("sets") == 1, F.col("node")).alias("node")).agg(
            F.count("*").alias("alone"), F.max("sets").alias("sets")
        ),
        "tally",
    )
    alone = tally.where("node IS NOT NULL").select("node", "alone")
    left = classes.join(alone, "node", "left").withColumn("wanted", miss + 1 - F.coalesce("alone", F.lit(0))).where("wanted > 0")
    each = left.select("node", "n_shingles", "wanted", F.explode("hashes").alias("hash"))
    shared = tally.where("hash IS NOT NULL").select("hash", "sets")
    # Hashes of the set alone are in none other; they only count. Uncounted ones come last.
    ordered = each.where(counted).join(shared, "hash").unionByName(each.where(~counted).withColumn("sets", F.lit(None).cast("long")))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.col("sets").asc_nulls_last(), F.col("hash")))

    def band(size: Column) -> Column:
        return F.floor(F.log(size.cast("double")) / F.lit(float(-np.log(0.7))))

    bands = F.sequence(band(F.col("n_shingles")), band(F.floor(F.col("n_shingles") * config.over / config.share)))
    keys = work.stored(ordered.withColumn("place", place).where("place <= wanted").select("node", "hash", F.explode(bands).alias("band")), "keys")
    least = keys.groupBy("hash", "band").agg(F.min("node").alias("parent"), F.count("*").alias("sets")).where("sets > 1").drop("sets")
    least = work.stored(least, "least")  # a join of two plain shuffles, whose hot keys Spark splits
    return keys.join(least, ["hash", "band"]).where("node > parent").select(F.col("node").alias("child"), "parent")


def linked_classes(docs: DataFrame, keyed: DataFrame, config: JaccardConfig, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """Classes (node, set_hash, first_doc, copies), and per linked class its component_id and links to other classes."""
    sized = keyed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = work.stored(
        sized.groupBy("set_hash")
        .agg(
            F.min("doc_id").alias("first_doc"), F.count("*").alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("hashes").alias("hashes")
        )
        .withColumn("node", F.xxhash64("set_hash")),
        "classes",
    )
    near = components(_candidates(classes, config, work), work)
    placed = near.select(F.col("child").alias("node"), F.col("parent").alias("component")).unionByName(
        near.select(F.col("parent").alias("node"), F.col("parent").alias("component")).distinct()
    )
    members = work.stored(classes.drop("hashes").join(placed, "node"), "members")

    wanted = docs.sparkSession.sparkContext.broadcast(bitfilter.build(members, "first_doc"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(bitfilter.passes(wanted.value, batch.column("first_doc").to_numpy())))
            found = [shingle_set(t, config.words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("first_doc"),
                    pa.array(map(_set_hash, found), pa.binary()),
                    pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64())),
                ],
                names=["first_doc", "set_hash", "found"],
            )

    texts = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("first_doc"), "text")
    found = texts.mapInArrow(tidy(sets), "first_doc long, set_hash binary, found array<long>")
    # Other texts under the same id are other classes; a repeated row is dropped in its tile.
    found = work.stored(found.join(members.select("first_doc", "set_hash", "node", "copies"), ["first_doc", "set_hash"]).drop("first_doc", "set_hash"), "found")
    tiled = _tiles(members, config).join(found, "node")
    linked = work.stored(tiled.groupBy("component", "tile").applyInArrow(_tile(config), "node long, root long, links long"), "links")
    roots = components(linked.where("node > root").select(F.col("node").alias("child"), F.col("root").alias("parent")), work)
    links = (
        linked.groupBy("node")
        .agg(F.sum("links").alias("links"))
        .join(roots.select(F.col("child").alias("node"), "parent"), "node", "left")
        .select("node", "links", F.coalesce("parent", "node").alias("parent"))
    )
    # A component's id is its smallest doc_id; nodes are hashes of sets.
    smallest = links.join(members.select("node", "first_doc"), "node").groupBy("parent").agg(F.min("first_doc").alias("component_id"))
    return classes.drop("hashes"), links.join(smallest, "parent").withColumnRenamed("parent", "root")


def join(docs: DataFrame, config: JaccardConfig = JaccardConfig()) -> DataFrame:
    """doc_id, n_shingles, set_hash, root, component_id and n_links of every row of docs (doc_id, text).

    ``root`` tells components apart even where ids repeat; null for rows without a set.
    """
    work = Workspace(docs.sparkSession, "jaccard")
    try:
        return stored(_joined(docs, config, work), "jaccard-result")
    finally:
        work.drop()


def _joined(docs: DataFrame, config: JaccardConfig, work: Workspace) -> DataFrame:
    keyed = work.stored(keyed_sets(docs, config), "sets")
    classes, linked = linked_classes(docs, keyed, config, work)
    per_class = classes.join(linked, "node", "left").select(
        "set_hash",
        F.coalesce("root", "node").alias("root"),
        F.coalesce("component_id", "first_doc").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    takes_part = F.col("doc_id").isNotNull()
    return (
        keyed.drop("hashes")
        .join(per_class, "set_hash", "left")
        .select(
            "doc_id",
            "n_shingles",
            "set_hash",
            F.when(takes_part, F.col("root")).alias("root"),
            F.when(takes_part, F.coalesce("component_id", "doc_id")).alias("component_id"),
            F.when(takes_part, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        )
    )


def keep_one(docs: DataFrame, config: JaccardConfig = JaccardConfig()) -> DataFrame:
    """The rows, unchanged, of one document per component, that of the smallest id; rows without an id stay.

    Rows that repeat an id and a set are one document.
    """
    joined = join(docs, config).select("doc_id", "set_hash", "root")
    first = joined.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "set_hash")).alias("kept")).select("kept.*")
    alone = joined.where("root IS NULL AND doc_id IS NOT NULL").select("doc_id", "set_hash").distinct()
    kept_ids = stored(first.unionByName(alone).select(F.col("doc_id").alias("kept_id"), F.col("set_hash").alias("kept_hash")), "jaccard-kept")

    # Most rows that go are told by their id alone, before any text is shuffled.
    wanted = docs.sparkSession.sparkContext.broadcast(bitfilter.build(kept_ids, "kept_id"))
    named = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").cast("long").alias("id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            passing = bitfilter.passes(wanted.value, ids.fill_null(0).to_numpy()) | ids.is_null().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(passing))
            hashes = [_set_hash(shingle_set(t, config.words)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), pa.array(hashes, pa.binary())], names=["row", "id", "own_hash"])

    hashed = named.mapInArrow(tidy(run), T.StructType([named.schema["row"], named.schema["id"], T.StructField("own_hash", T.BinaryType())]))
    kept = hashed.join(kept_ids, (F.col("id") == F.col("kept_id")) & (F.col("own_hash") == F.col("kept_hash"))).drop("kept_id", "kept_hash")
    return kept.dropDuplicates(["id", "own_hash"]).unionByName(hashed.where("id IS NULL")).select("row.*")
