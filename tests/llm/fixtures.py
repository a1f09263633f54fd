"""Small tables with every awkward case, and the plain versions of what operators compute."""

from __future__ import annotations

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

PROSE = (
    "The river ran slowly past the old mill and the children watched the boats go by in the evening light while their "
    "parents talked about the harvest and the long winter that was coming down from the hills"
).split()


def prose(start: int, words: int) -> str:
    return " ".join(PROSE[(start + i * (1 + start % 3)) % len(PROSE)] + ("" if (i + start) % 5 else str((start * 7 + i) % 90)) for i in range(words))


def awkward_rows() -> list[tuple]:
    base = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, base, "en", "a", 1),
        (2, base + " w60", "en", "a", 1),  # near copy of 1
        (3, base, "en", "b", 1),  # copy of 1
        (4, "", "en", None, 0),
        (5, None, None, None, None),
        (6, " \t\n ", "en", "b", 4),
        (7, "Single", "en", "c", 6),
        (8, "single", "de", "c", 6),  # the same set once folded
        (9, "two words", None, "c", 9),
        (10, "12345 ... !!!", "en", "a", 13),
        (11, "é ü ñ ß 日本 語 ▁ \U0001f600", "de", "ä", 20),
        (12, "x" * 5000, "en", "a", 5000),
        (13, prose(1, 4000), "en", "hot", 1),
        (14, prose(2, 90) + "\n" + prose(3, 40), "en", "hot", 1),
        (14, prose(2, 90) + "\n" + prose(3, 40), "en", "hot", 1),  # a repeated row
        (15, prose(4, 30), "en", "hot", 1),
        (15, prose(5, 30), "en", "hot", 1),  # the same id, another text
        (None, prose(6, 30), "en", "hot", 1),
        (16, base.upper(), "en", "hot", 1),
    ]
    return rows


def awkward(spark):
    """The rows with columns that clash with what operators add."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(awkward_rows(), DOCS)
    for name in ("score", "predicted", "lang_pred", "size", "start", "chunk", "block", "row", "key", "node", "rule", "rank", "t", "range", "taken"):
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


def shingles(text: str | None, n: int) -> frozenset:
    words = SPACE_WORD.findall((text or "").translate(FOLD))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(len(words) - n + 1, 1)))


def brute_jaccard(rows: list[tuple[int, str | None]], n: int, share: int, over: int) -> list[tuple]:
    """doc_id, set size, smallest reachable doc_id and number of links of each row."""
    sets = [shingles(text, n) for _, text in rows]
    parent = list(range(len(rows)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i + 1, len(rows)):
            if rows[i][0] is None or rows[j][0] is None or not sets[i] or not sets[j]:
                continue
            both = len(sets[i] & sets[j])
            if over * both >= share * (len(sets[i]) + len(sets[j]) - both):
                links[i] += 1
                links[j] += 1
                parent[top(j)] = top(i)
    least: dict[int, int] = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(least.get(top(i), doc_id), doc_id)
    return [(d, len(sets[i]), least.get(top(i)), links[i]) for i, (d, _) in enumerate(rows)]
