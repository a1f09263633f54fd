"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

A text is a list of words; its blocks are stretches of ``block`` words, one every
``block / 2`` words, so that any passage of up to half a block lies within one. A
block meets a template if it holds at least ``share`` of the template's distinct
words. Every such pair is found, by filters that cannot lose one:

* order: the templates' words are ordered by how many documents of the corpus
  hold them, the rarest first (one counting pass over all texts);
* prefix: a block that meets the threshold holds one of the template's first words,
  as many as it may lack and one more; an index leads from these to templates;
* length: it has at least the needed number of template words in all;
* position: what comes after the first common word, in the template or in the
  block, must still be enough.

What is left is checked exactly. Templates are a fixed list; the word counts that
reach the driver are at most one number per template word.

Defined results: null is the empty text: no words, no places, no labels, score 0.
Repeated rows and equal texts get equal results. Texts are scanned whole. Blocks
overlap, so one passage may be reported by two of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import with_columns

# Phrases of the base and their labels, and notices by label.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"
        " files to deal in the software without restriction including without limitation the rights to use copy modify merge"
        " publish distribute sublicense and or sell copies of the software",
    ),
    (
        "apache",
        "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"
        " you may obtain a copy of the license at http www apache org licenses license 2 0",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"
        " as published by the free software foundation either version 3 of the license or at your option any later version",
    ),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the"
        " following conditions are met",
    ),
)

# A-Z become a-z; digits, letters and bytes of other characters stay; the rest are gaps.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


@dataclass(frozen=True)
class ScanConfig:
    share: float = 0.8
    block: int = 256


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Word position and label of every phrase."""
    line = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in PHRASES.items():
        wanted = b" " + phrase.encode() + b" "
        at = line.find(wanted)
        while at >= 0:
            found.append((line.count(b" ", 0, at), label))
            at = line.find(wanted, at + 1)
    return sorted(found)


@dataclass(frozen=True)
class Index:
    """Templates as word numbers, rarest first, and which templates a prefix word leads to."""

    rank: dict[bytes, int]
    labels: tuple[str, ...]
    ranks: tuple[tuple[int, ...], ...]
    need: tuple[int, ...]
    leads: dict[int, tuple[int, ...]]


def build_index(counts: dict[bytes, int], templates=TEMPLATES, config: ScanConfig = ScanConfig()) -> Index:
    sets = [set(words_of(text)) for _, text in templates]
    if any(len(words_of(text)) > config.block // 2 for _, text in templates):
        raise ValueError("a template is longer than half a block")
    order = sorted(set().union(*sets), key=lambda w: (counts.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    ranks = tuple(tuple(sorted(rank[w] for w in s)) for s in sets)
    need = tuple(max(1, int(np.ceil(config.share * len(r) - 1e-9))) for r in ranks)
    leads: dict[int, tuple[int, ...]] = {}
    for t, (own, n) in enumerate(zip(ranks, need, strict=True)):
        for r in own[: len(own) - n + 1]:
            leads[r] = (*leads.get(r, ()), t)
    return Index(rank, tuple(label for label, _ in templates), ranks, need, leads)


def block_matches(words: list[bytes], index: Index, config: ScanConfig) -> list[tuple[str, int, int, float]]:
    """Label, first word, end and containment of every block that meets a template."""
    known = [index.rank[w] for w in set(words).intersection(index.rank)]
    if not any(r in index.leads for r in known):
        return []
    numbers = [index.rank.get(w, -1) for w in words]
    found = []
    half = config.block // 2
    for start in range(0, max(len(words) - half, 1), half):
        block = sorted(set(numbers[start : start + config.block]) - {-1})
        tried: set[int] = set()
        for j, r in enumerate(block):
            for t in index.leads.get(r, ()):
                if t in tried:
                    continue
                tried.add(t)  # r is the first common word of the two
                own, need = index.ranks[t], index.need[t]
                if len(block) < need or min(len(own) - own.index(r), len(block) - j) < need:
                    continue
                shared = len(set(own).intersection(block))
                if shared >= need:
                    found.append((index.labels[t], start, min(start + config.block, len(words)), shared / len(own)))
    return found


def count_words(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, int]:
    """In how many documents each template word stands; at most one row per word reaches the driver."""
    wanted = frozenset(w for _, text in templates for w in words_of(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            for text in batch.column("text").to_pylist():
                for word in wanted.intersection(words_of(text)):
                    held[word] = held.get(word, 0) + 1
        yield pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.binary()), "n": pa.array(held.values(), pa.int64())})

    counted = docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in counted.collect()}


PLACES = "n_words long, places array<struct<start: long, label: string>>, blocks array<struct<label: string, start: long, end: long, containment: double>>"


def scan(docs: DataFrame, config: ScanConfig = ScanConfig()) -> DataFrame:
    """The rows with ``n_words``, phrase ``places`` and template ``blocks``; input columns of these names are replaced."""
    rows = docs.drop("n_words", "places", "blocks")
    sent = docs.sparkSession.sparkContext.broadcast(build_index(count_words(docs), config=config))
    added = T.StructType.fromDDL(PLACES)
    place = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
    block = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("containment", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, places, blocks = [], [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                counts.append(len(words))
                places.append([{"start": s, "label": x} for s, x in phrase_places(words)])
                blocks.append([dict(zip(("label", "start", "end", "containment"), m, strict=True)) for m in block_matches(words, sent.value, config)])
            yield with_columns(batch, {"n_words": pa.array(counts, pa.int64()), "places": pa.array(places, place), "blocks": pa.array(blocks, block)})

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added.fields]))


def digest(scanned: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and n_blocks of scanned rows."""
    base = F.transform("places", lambda p: p["label"])
    own = F.transform("blocks", lambda b: b["label"])
    starts = F.transform("places", lambda p: p["start"])
    best = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))
    return scanned.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat(base, own))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(best).alias("score"),
        F.size("blocks").cast("long").alias("n_blocks"),
    )
