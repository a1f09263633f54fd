"""A SentencePiece vocabulary read as a unigram model, and what its two segmenters share.

The best segmentation of a text is the sequence of pieces with the highest total
score. A character that no piece spells alone may stand as an unknown, at the
lowest score less 10; it becomes its UTF-8 bytes where the vocabulary has byte
pieces. Of two equally good last pieces the longer one wins: the tokenizer's rule.
Totals are float64, exact for the whole numbers that a merge-ranked vocabulary has
as scores; the C++ library adds in float32, so it can only differ where its own
total has been rounded.

No piece has a blank after another character, so the text falls into chunks
(blanks, then other characters) whose best segmentations are independent.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import sentencepiece

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
UNKNOWN_PENALTY = 10.0
_CHUNK = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")


@dataclass(frozen=True)
class Vocabulary:
    """Matchable pieces by id order, and byte pieces; a few megabytes, fixed by the model file."""

    pieces: tuple[str, ...]
    ids: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray | None  # id of each byte
    unknown_id: int
    texts: tuple[bytes, ...]  # what each id decodes to

    @property
    def unknown_score(self) -> float:
        return float(self.scores.min()) - UNKNOWN_PENALTY

    def unknown_ids(self, char: str) -> list[int]:
        if self.byte_ids is None:
            return [self.unknown_id]
        return [int(self.byte_ids[b]) for b in char.encode("utf-8", "surrogatepass")]


def load(path: str = MODEL) -> Vocabulary:
    """Read on the driver; tasks get the vocabulary by broadcast and need no file."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    probe = "".join(model.id_to_piece(i) for i in model.encode(" a  b "))
    if probe != f"{BLANK}{BLANK}a{BLANK}{BLANK}b{BLANK}":
        raise ValueError("only vocabularies that keep the text as it is and put a blank first")
    size = model.get_piece_size()
    names = [model.id_to_piece(i) for i in range(size)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i) for i in range(size)]
    own = [i for i in range(size) if not special[i]]
    if any(BLANK in names[i].lstrip(BLANK) for i in own):
        raise ValueError("a piece has a blank after another character")
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    has_bytes = all(model.is_byte(i) for i in byte_ids)
    texts = [names[i].replace(BLANK, " ").encode() if not special[i] else b"" for i in range(size)]
    if has_bytes:
        for b, i in enumerate(byte_ids):
            texts[i] = bytes([b])
    return Vocabulary(
        tuple(names[i] for i in own),
        np.array(own, np.int32),
        np.array([model.get_score(i) for i in own], np.float64),
        np.array(byte_ids, np.int32) if has_bytes else None,
        model.unk_id(),
        tuple(texts),
    )


def chunked(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct chunks of the texts, the chunks of all texts in order, and where each text's begin."""
    index: dict[str, int] = {}
    place: list[int] = []
    starts = [0]
    for text in texts:
        if text:
            place += [index.setdefault(c, len(index)) for c in _CHUNK.findall(BLANK + text.replace(" ", BLANK))]
        starts.append(len(place))
    return list(index), np.array(place, np.int64), np.array(starts, np.int64)


@dataclass(frozen=True)
class Lattice:
    """Chunks laid end to end, a node before every character and one after each chunk's last."""

    text: str  # with a NUL after each chunk
    begins: np.ndarray
    ends: np.ndarray
    offset: np.ndarray  # of each node in its chunk


def lay_out(chunks: list[str]) -> Lattice:
    lengths = np.fromiter(map(len, chunks), np.int64, len(chunks))
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]) if len(chunks) else np.zeros(0, np.int64)
    nodes = int((lengths + 1).sum())
    offset = np.arange(nodes) - np.repeat(begins, lengths + 1)
    return Lattice("".join(c + "\0" for c in chunks), begins, begins + lengths, offset)


def unknown_edges(lattice: Lattice, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Characters that no edge spells alone."""
    alone = np.zeros(len(lattice.offset), bool)
    alone[start[length == 1]] = True
    alone[lattice.ends] = True
    return np.flatnonzero(~alone)


def relax(
    lattice: Lattice, start: np.ndarray, length: np.ndarray, score: np.ndarray, tokens: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best total to each node; the edge it comes by (-1 at a chunk's begin), or the tokens so far; and the order of edges.

    Edges are sorted by the offset of their start, and all edges of an offset are
    relaxed at once, over all chunks: two of them never share an end. An edge
    replaces another only if strictly better, so the longest of equals stays.
    """
    order = np.argsort(lattice.offset[start], kind="stable")
    start, end, score = start[order], (start + length)[order], score[order]
    tokens = None if tokens is None else tokens[order]
    best = np.full(len(lattice.offset), -np.inf)
    best[lattice.begins] = 0.0
    carried = np.full(len(lattice.offset), -1 if tokens is None else 0, np.int64)
    at = lattice.offset[start]
    cuts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1, [len(at)]]) if len(at) else np.zeros(1, np.int64)
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        total = best[start[a:b]] + score[a:b]
        better = np.flatnonzero(total > best[end[a:b]])
        to = end[a:b][better]
        best[to] = total[better]
        carried[to] = a + better if tokens is None else carried[start[a:b][better]] + tokens[a:b][better]
    return best, carried, order
