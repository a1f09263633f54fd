"""Arrow token files against the library, document by document and sequence by sequence."""

from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerwatch.llm import catalog, tokenfiles

from .fixtures import DOCS, awkward, awkward_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "  lead", "trail  ", "a  b", "a\n\n b", "a \n b\n", "\n a", "it's we'll 'tis", "x<|endoftext|>y <|endoftext|> z", "<|endoftext|>",
    "é ü ñ \x1c b", "日本 語　x", "#", "# #", "\0nul \0", "tab\tb \tc", "1 22 333,4", "ab12cd 3e,f(g) h's. i\nj\n\nk!\nl ²3,x² a_b [c]d|e ~f", "é,è\nÀb1 ß# ''s #'s .'ll", "a\rb \r\nc", "𝔘 😀 é", " '", "' s", "\x85 a\x85b", "a\u2003 b \u3000c\xa0 d \x1fe \x0bf\x0c g",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def text_of_file():
    return Path(PATH).read_text(encoding="utf-8")


def brute(library, rows):
    """doc_id, start, n_tokens and crc of rows already in order."""
    at = 0
    for doc_id, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        yield doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)


def test_encoder_equals_the_library(library, text_of_file):
    encoder = tokenfiles.Encoder(text_of_file)

    def encode(own, texts):
        return own.encode(pa.array(texts, pa.string()))

    texts = ODD + [t for _, t, *_ in awkward_rows() if t] + [" ".join(ODD), "\n".join(ODD), "ab" * 3000]
    forgetful = tokenfiles.Encoder(text_of_file, most=3)
    assert encode(forgetful, texts) == [b for t in texts for b in encode(forgetful, [t])]
    for _ in range(2):  # the second time from memory
        assert encode(encoder, texts) == encode(forgetful, texts)
        for text, ids in zip(texts, encode(encoder, texts), strict=True):
            assert np.frombuffer(ids, encoder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, other = tokenfiles.Encoder(Path(path).read_text(encoding="utf-8")), Tokenizer.from_file(path)
    assert not encoder.parts
    for text, ids in zip(ODD, encoder.encode(pa.array(ODD)), strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == other.encode(text, add_special_tokens=False).ids


def test_query_over_the_whole_table(spark, small, library):
    docs = spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect()
    rows = catalog.op11_token_files(spark, small).collect()
    assert sorted(map(tuple, rows)) == sorted(brute(library, [(r.doc_id, r.text) for r in docs]))


def test_sequences_masks_and_small_files(spark, small, library, text_of_file, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    config = tokenfiles.TokenFileConfig(length=64, rows=3, chars=60_000)
    files = tokenfiles.write(docs, text_of_file, f"file://{tmp_path}/tokens", config)
    entries = sorted(files.collect(), key=lambda r: r.part)
    assert len(entries) > 3 and [r.base for r in entries] == [sum(e.tokens for e in entries[:i]) for i in range(len(entries))]
    expected = [i for r in docs.orderBy("doc_id").collect() for i in [*library.encode(r.text or "", add_special_tokens=False).ids, 2]]
    stream = []
    for entry in entries:
        file = tokenfiles.SequenceFile(entry.ids_path)
        assert {b.num_rows for b in file.batches[:-1]} <= {3}
        for i in (len(file) - 1, 0, len(file) // 2):  # in any order
            ids, mask = file[i]
            assert len(ids) == len(mask) == 64 and ids.dtype == np.uint16
            assert not ids.flags.owndata and not ids.flags.writeable  # a view of the mapped file
        own = [file[i] for i in range(len(file))]
        assert all(m.true_count == 64 for _, m in own[:-1])
        stream += [t for ids, mask in own for t in ids[mask.to_numpy(zero_copy_only=False)].tolist()]
        with pytest.raises(IndexError):
            file[len(file)]
    assert stream == expected
    read = {r.doc_id: (r.start, r.ids) for r in tokenfiles.read_ids(files).collect()}
    for r in docs.collect():
        start, ids = read[r.doc_id]
        assert ids == expected[start : start + len(ids)] == [*library.encode(r.text or "", add_special_tokens=False).ids, 2]


def test_awkward_rows(spark, library, text_of_file):
    files = tokenfiles.write(awkward(spark), text_of_file, config=tokenfiles.TokenFileConfig(length=16, rows=2, chars=5000))
    got = sorted(map(tuple, tokenfiles.digests(files).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in awkward_rows()), key=lambda i: (i is not None, i))
    assert [r[1] for r in got] == [sum(g[2] for g in got[:i]) for i in range(len(got))]
    want = sorted(((d, n, c) for d, _, n, c in brute(library, [r[:2] for r in awkward_rows()])), key=str)
    assert sorted(((d, n, c) for d, _, n, c in got), key=str) == want
    again = tokenfiles.digests(tokenfiles.write(awkward(spark), text_of_file)).collect()
    assert sorted(map(str, again)) == sorted(map(str, tokenfiles.digests(files).collect()))


def test_one_document_over_many_batches_and_a_very_common_id(spark, library, text_of_file):
    long = " ".join(f"word{i}" for i in range(40_000))
    rows = [(7, f"copy {i % 3}", "en", "a", 1) for i in range(300)] + [(1, long, "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    files = tokenfiles.write(docs, text_of_file, config=tokenfiles.TokenFileConfig(length=32, rows=4, chars=40_000))
    got = sorted(map(tuple, tokenfiles.digests(files).collect()), key=lambda r: r[1])
    want = list(brute(library, [(1, long)]))
    assert got[0] == want[0] and len(got) == 301 and sum(r[2] for r in got) == got[-1][1] + got[-1][2]


def test_no_rows(spark, text_of_file):
    files = tokenfiles.write(spark.createDataFrame([], DOCS), text_of_file)
    assert files.count() == 0 and tokenfiles.digests(files).count() == 0 and tokenfiles.read_ids(files).columns == ["doc_id", "start", "n_tokens", "ids"]


def test_files_of_lost_attempts_are_not_read(spark, text_of_file, tmp_path):
    docs = spark.createDataFrame([(1, "one two", "en", "a", 1)], DOCS)
    files = tokenfiles.write(docs, text_of_file, f"{tmp_path}/t")
    (tmp_path / "t" / "part-000000-999999.ids.arrow").write_bytes(b"half a file")
    assert tokenfiles.digests(tokenfiles.manifest(spark, f"{tmp_path}/t")).count() == files.count() == 1
