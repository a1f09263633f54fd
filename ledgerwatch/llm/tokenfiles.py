"""Token ids in Arrow stream files of fixed-size-list batches.

Documents are dealt by range of doc_id to as many tasks as there is text for, sorted
there, encoded, and written by the task that holds them; no ids are shuffled. The
stream of a file's ids, an end id after every document, is cut into sequences of equal
length. A file is an Arrow IPC stream whose batches hold ``rows`` sequences each:

    ids   fixed_size_list<uint16 or uint32>[length]
    mask  fixed_size_list<bool>[length]   true for an id, false for padding

Only the last sequence of a file is padded. Beside it lies an index of the same
kind of stream (doc_id, start in the file, n_tokens). Batches are uncompressed, so a
mapped file gives any sequence and its mask as views, without a copy or a scan.

A file's name ends with the number of the attempt that wrote it, and the manifest (one
row per file, written by Spark's own commit) names the attempts that count: what a
lost executor leaves behind is in no manifest and is never read.

Defined results: a null or empty text is the end id alone. A null doc_id comes
first. Rows that repeat an id are documents of their own, ordered by hash of the text;
a very common id is split over files. No rows make no files. Texts of any length are
encoded whole: a long one is encoded in pieces cut at single blanks between other
characters, where the tokenizer's own pre-tokenisation always cuts.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import run_dir

MANIFEST = "_manifest"
# Chunks begin at single blanks between other characters. Within a chunk, words end where
# letters meet digits or punctuation, or at a single line break. The tokenizer's pattern
# cuts at all these places whatever surrounds them. An apostrophe may start a
# contraction, and a bar is part of the special token, so neither ends a word.
_BLANK = re.compile(r"(?<=\S) (?=\S)")
_RUN = r"[\s\pZ\x0B\x1C-\x1F\x{85}] | [\s\pZ\x0B\x1C-\x1F\x{85}]"  # RE2: a blank beside other white space
_LETTER, _OTHER = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{}~0-9"
_WORD = re.compile(rf"(?<=[{_LETTER}])(?=[{_OTHER}\n])|(?<=[{_OTHER}])(?=[{_LETTER}])|(?<=\S\n)(?=\S)")
_LONE = re.compile(rf" ?[{_LETTER}]+")  # most chunks, and none that _WORD cuts
_ASCII = re.compile(r" ?[A-Za-z]+")
_PLAIN = re.compile(r" ?\S+")
_KEPT: dict[str, Encoder] = {}
_INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
_ENTRY = "part int, ids_path string, index_path string, documents long, tokens long"


@dataclass(frozen=True)
class TokenFileConfig:
    length: int = 2048  # ids of a sequence
    rows: int = 64  # sequences of a batch
    chars: int = 32 << 20  # of the texts of a file, about
    end_id: int = 2


class Encoder:
    """The library's ids of texts, word by word; chunks and words met before are not encoded again.

    What is remembered is bounded by ``most`` chunks and as many words, some 200 MB of text like the given.
    """

    def __init__(self, tokenizer: str, most: int = 3 << 18):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(tokenizer)
        self.most = most
        self.dtype = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        described = json.loads(tokenizer)
        before = described.get("pre_tokenizer") or {}
        special = [t["content"] for t in described.get("added_tokens", ())]
        # Only then do the places above part the text; any other tokenizer gets whole texts.
        self.parts = (
            described.get("normalizer") is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space")
            and not any(_BLANK.search(t) or len(_WORD.split(t)) > 1 or " " in t for t in special)
        )
        self.chunks: dict[str, bytes] = {}  # by what follows the blank; without a blank before it, by a blank and the chunk
        self.words: dict[str, bytes] = {}
        if self.parts:
            self.blank = self.library.pre_tokenizer.pre_tokenize_str(" a")[0][0].removesuffix("a")
            self.newline = self.library.encode("\n", add_special_tokens=False).ids[0]

    @classmethod
    def of(cls, tokenizer: str) -> Encoder:
        """The encoder that this worker keeps."""
        if tokenizer not in _KEPT:
            _KEPT.clear()
            _KEPT[tokenizer] = cls(tokenizer)
        return _KEPT[tokenizer]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_words(self, words: Iterable[str]) -> None:
        width = self.dtype.itemsize
        plain, others, model, code = [], [], self.library.model, self.dtype.char
        for word in words:
            if _ASCII.fullmatch(word):  # one pre-token, in the model's own letters but for the blank
                self.words[word] = array(code, [t.id for t in model.tokenize(word.replace(" ", self.blank))]).tobytes()
            elif _PLAIN.fullmatch(word):
                plain.append(word)
            else:
                others.append(word)
        # Words without white space within are encoded many at a time, with a line break between.
        groups = [plain[a : a + 64] for a in range(0, len(plain), 64)]
        for some, ids in zip(groups, self._ids(["\n".join(g) for g in groups]), strict=True):
            ends = np.flatnonzero(ids == self.newline)
            if len(ends) != len(some) - 1:  # a vocabulary that joins what the line break parts
                others += some
                continue
            data, stops = ids.tobytes(), [*(ends * width).tolist(), len(ids) * width]
            start = 0
            for word, stop in zip(some, stops, strict=True):
                self.words[word] = data[start:stop]
                start = stop + width
        self.words.update(zip(others, (i.tobytes() for i in self._ids(others)), strict=True))

    def _learn(self, keys: list[str]) -> None:
        chunks = [k[1:] if k[:1] == " " else " " + k for k in keys]
        cut = [[c] if _LONE.fullmatch(c) else _WORD.split(c) for c in chunks]
        new = dict.fromkeys(w for w in chain.from_iterable(cut) if w not in self.words)
        if len(self.words) + len(new) > self.most:
            self.words.clear()
            new = dict.fromkeys(chain.from_iterable(cut))
        self._learn_words(new)
        ids = self.words.__getitem__
        self.chunks.update((k, ids(own[0]) if len(own) == 1 else b"".join(map(ids, own))) for k, own in zip(keys, cut, strict=True))

    def _looked_up(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct chunks, end to end, and how many each has."""
        new = [k for k in keys if k not in self.chunks]
        if len(self.chunks) + len(new) > self.most:
            self.chunks.clear()
            new = keys
        self._learn(new)
        found = [self.chunks[k] for k in keys]
        return np.frombuffer(b"".join(found), self.dtype), np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text, in the machine's byte order."""
        texts = texts.cast(pa.large_string()).fill_null("")
        if not self.parts or not len(texts):
            return [i.tobytes() for i in self._ids(texts.to_pylist())]
        lists = pc.split_pattern(texts, " ")
        odd = np.flatnonzero(pc.match_substring_regex(texts, _RUN).to_numpy(zero_copy_only=False))
        if len(odd):  # these are not cut at every blank
            own = pa.array([_BLANK.split(t) for t in texts.take(pa.array(odd)).to_pylist()], lists.type)
            place = np.arange(len(texts))
            place[odd] = len(texts) + np.arange(len(odd))
            lists = pa.concat_arrays([lists, own]).take(pa.array(place))
        coded = lists.flatten().dictionary_encode()
        chunk = coded.indices.to_numpy().astype(np.int64)
        # The first chunk of a text has no blank before it; its key starts with one.
        first = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
        keys = coded.dictionary.to_pylist()
        firsts = dict.fromkeys(" " + keys[i] for i in chunk[first].tolist())
        at = {k: len(keys) + n for n, k in enumerate(firsts)}
        chunk[first] = [at[" " + keys[i]] for i in chunk[first].tolist()]
        ids, lengths = self._looked_up([*keys, *firsts])
        n = lengths[chunk]
        ends = np.cumsum(n)
        starts = (np.cumsum(lengths) - lengths)[chunk]
        all_ids = ids[np.arange(int(n.sum())) + np.repeat(starts - (ends - n), n)]
        stops = ends[np.append(first[1:], len(chunk)) - 1].tolist()
        return [all_ids[a:b].tobytes() for a, b in zip([0, *stops[:-1]], stops, strict=True)]


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def _slices(texts: pa.Array, limit: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes; a longer text is a range of its own."""
    ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy())
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(ends, limit + (ends[a - 1] if a else 0), side="right")))
        yield a, b
        a = b


class _Writer:
    """One file of sequences and its index; holds a batch of each at most."""

    def __init__(self, base: str, dtype: np.dtype, config: TokenFileConfig):
        self.config, self.dtype = config, dtype
        self.ids_path, self.index_path = f"{base}.ids.arrow", f"{base}.docs.arrow"
        filesystem, path = _place(self.ids_path)
        filesystem.create_dir(os.path.dirname(path), recursive=True)
        self.sinks = [filesystem.open_output_stream(path), filesystem.open_output_stream(_place(self.index_path)[1])]
        self.schema = pa.schema(
            [("ids", pa.list_(pa.from_numpy_dtype(dtype), config.length)), ("mask", pa.list_(pa.bool_(), config.length))],
            metadata={"end_id": str(config.end_id)},
        )
        self.sequences = pa.ipc.new_stream(self.sinks[0], self.schema)
        self.index = pa.ipc.new_stream(self.sinks[1], _INDEX)
        self.held: list[bytes] = []
        self.n_held = self.tokens = self.documents = 0
        self.end = np.array([config.end_id], dtype).tobytes()

    def add(self, doc_ids: pa.Array, encoded: list[bytes]) -> None:
        width = self.dtype.itemsize
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded)) // width + 1
        starts = self.tokens + np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.index.write_batch(pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), pa.array(starts), pa.array(lengths)], schema=_INDEX))
        for ids in encoded:
            self.held += (ids, self.end)
        self.documents += len(encoded)
        self.tokens += int(lengths.sum())
        self.n_held += int(lengths.sum())
        full = self.config.length * self.config.rows
        if self.n_held >= full:
            ids = np.frombuffer(b"".join(self.held), self.dtype)
            for a in range(0, len(ids) - full + 1, full):
                self._write(ids[a : a + full], full)
            rest = ids[len(ids) - len(ids) % full :]
            self.held, self.n_held = [rest.tobytes()], len(rest)

    def _write(self, ids: np.ndarray, real: int) -> None:
        lists = [
            pa.FixedSizeListArray.from_arrays(pa.array(ids), self.config.length),
            pa.FixedSizeListArray.from_arrays(pa.array(np.arange(len(ids)) < real), self.config.length),
        ]
        self.sequences.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            ids = np.frombuffer(b"".join(self.held), self.dtype)
            self._write(np.pad(ids, (0, -len(ids) % self.config.length)), len(ids))
        for writer in (self.sequences, self.index, *self.sinks):
            writer.close()


def write(docs: DataFrame, tokenizer: str, folder: str | None = None, config: TokenFileConfig = TokenFileConfig()) -> DataFrame:
    """Writes the texts of docs in ascending doc_id order; returns the manifest, which is also stored in the folder.

    ``tokenizer`` is the text of a tokenizers file, of fixed size; it goes to the tasks by broadcast.
    """
    spark = docs.sparkSession
    base = (folder or run_dir(spark, "token-files")).rstrip("/")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    # The number of the input split only parts equal rows, so that many of them are no single range.
    keyed = rows.withColumns({"text_hash": F.xxhash64("text"), "split": F.spark_partition_id()})
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_hash"), F.col("split")]
    dealt = keyed.repartitionByRange(-(-chars // config.chars) or 1, *order).sortWithinPartitions(*order).select("doc_id", "text")
    sent = spark.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = task.partitionId()
        encoder = writer = None
        for batch in batches:
            texts = batch.column("text")
            for a, b in _slices(texts):
                encoder = encoder or Encoder.of(sent.value)
                writer = writer or _Writer(f"{base}/part-{part:06d}-{task.taskAttemptId()}", encoder.dtype, config)
                writer.add(batch.column("doc_id").slice(a, b - a), encoder.encode(texts.slice(a, b - a)))
        if writer:
            writer.close()
            entry = (part, writer.ids_path, writer.index_path, writer.documents, writer.tokens)
            yield pa.RecordBatch.from_pylist([dict(zip(_MANIFEST.names, entry, strict=True))], schema=_MANIFEST)

    dealt.mapInArrow(run, _ENTRY).write.parquet(f"{base}/{MANIFEST}")
    return manifest(spark, base)


_MANIFEST = pa.schema([("part", pa.int32()), ("ids_path", pa.string()), ("index_path", pa.string()), ("documents", pa.int64()), ("tokens", pa.int64())])


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file in the order of the stream: part, ids_path, index_path, documents, tokens, and ``base``, the ids of all files before."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    entries = spark.read.schema(_ENTRY).parquet(f"{folder.rstrip('/')}/{MANIFEST}")
    return entries.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _open(uri: str) -> pa.NativeFile:
    filesystem, path = _place(uri)
    return pa.memory_map(path) if isinstance(filesystem, pafs.LocalFileSystem) else filesystem.open_input_stream(path)


class SequenceFile:
    """Random access to the sequences of a local file; ids and masks are views of the mapped file."""

    def __init__(self, path: str):
        self.batches = list(pa.ipc.open_stream(_open(path)))  # reads the headers only
        self.rows = max((b.num_rows for b in self.batches[:1]), default=1)

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        batch = self.batches[i // self.rows]
        ids, mask = (batch.column(c) for c in ("ids", "mask"))
        length, at = ids.type.list_size, i % self.rows
        if not 0 <= at < batch.num_rows:
            raise IndexError(i)
        return ids.values.to_numpy()[at * length : (at + 1) * length], mask.values.slice(at * length, length)


def documents(ids_path: str, index_path: str) -> Iterator[tuple[int | None, int, int, list[np.ndarray]]]:
    """doc_id, start, number of ids and the ids (views of consecutive batches) of each document of a file."""
    streams = pa.ipc.open_stream(_open(ids_path))
    current, low, high = np.zeros(0, np.uint16), 0, 0
    for batch in pa.ipc.open_stream(_open(index_path)):
        for doc_id, start, n in zip(*(batch.column(c).to_pylist() for c in _INDEX.names), strict=True):
            pieces, at = [], start
            while at < start + n:
                if at == high:
                    data = next(streams)
                    current, real = data.column("ids").values.to_numpy(), data.column("mask").values.true_count
                    low, high = high, high + real
                stop = min(start + n, high)
                pieces.append(current[at - low : stop - low])
                at = stop
            yield doc_id, start, n, pieces


def _read(files: DataFrame, value: Callable[[list[np.ndarray]], object], name: str, kind: str, arrow: pa.DataType) -> DataFrame:
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (name, arrow)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.to_pylist():
                held: list[tuple] = []
                size = 0
                for doc_id, start, n, pieces in documents(file["ids_path"], file["index_path"]):
                    held.append((doc_id, file["base"] + start, n, value(pieces)))
                    size += n
                    if len(held) >= 4096 or size >= 1 << 20:
                        yield _batch(held, schema)
                        held, size = [], 0
                if held:
                    yield _batch(held, schema)

    n = files.count()
    dealt = files.repartition(max(n, 1), "part")
    return dealt.mapInArrow(run, T.StructType.fromDDL(f"doc_id long, start long, n_tokens long, {name} {kind}"))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _crc32(pieces: list[np.ndarray]) -> int:
    crc = 0
    for piece in pieces:
        crc = zlib.crc32(piece.astype("<u4"), crc)
    return crc


def read_ids(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids, read from the files of a manifest."""
    return _read(files, lambda pieces: np.concatenate(pieces).astype(np.int32), "ids", "array<int>", pa.list_(pa.int32()))


def digests(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 (of the ids as little-endian 32-bit numbers), read from the files of a manifest."""
    return _read(files, _crc32, "ids_crc32", "long", pa.int64())
