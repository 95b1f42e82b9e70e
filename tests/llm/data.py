"""Small tables with every awkward case, and plain computations to compare with."""

from __future__ import annotations

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, words: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("aeioulnrst") for _ in range(2 + rng.randrange(6))) for _ in range(words)]


def awkward() -> list[tuple]:
    """Nulls in each column, empty and blank texts, copies, near copies, repeated rows, ids and ties, a long text."""
    base, other = prose(1, 120), prose(2, 90)
    near = [*base[:60], "changed", *base[61:]]
    rows = [
        (5, " ".join(base), "en", "b", 1),
        (2, "  ".join(base), "en", "a", 1),
        (2, "  ".join(base), "en", "a", 1),
        (9, "\n".join(base), "fr", None, None),
        (7, " ".join(near), None, "a", 3),
        (8, " ".join(near).upper(), "en", "c", 3),
        (1, None, "en", "a", 0),
        (3, "", "en", "b", 0),
        (4, " \t\n ", None, None, None),
        (None, " ".join(other), "de", "b", 2),
        (None, None, None, None, None),
        (6, " ".join(other), "de", "a", 2),
        (6, "another text under the same id", "de", "c", 2),
        (10, "one two three", "en", "b", 3),
        (11, "One TWO\tthree", "en", "b", 3),
        (12, "12 345 ... !!", "en", "c", 3),
        (13, " ".join(prose(3, 30_000)), "fr", "c", 9),
        (14, " ".join([*prose(4, 40), *base[10:80], *prose(5, 30)]), "en", "a", 5),
        (15, "é" * 300 + " Ünïcode ß 日本語 😀", "de", "d", 4),
    ]
    return rows


def corpus(n: int = 60) -> list[tuple]:
    """Texts in which whole texts, passages and boilerplate repeat."""
    rng = random.Random(11)
    shared = [prose(1000 + i, 60) for i in range(4)]
    rows: list[tuple] = []
    for i in range(n):
        words = prose(i, rng.randrange(5, 200))
        if i % 3 == 0:
            words[len(words) // 2 : 0] = shared[rng.randrange(4)]
        if i % 5 == 4:
            words = rows[i - 3][1].split()
            for _ in range(rng.randrange(0, 6)):
                words[rng.randrange(len(words))] = "edited"
        rows.append((i, " ".join(words), "en", f"s{i % 5}", i))
    return rows


def words(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


def lowered(text: str | None) -> list[bytes]:
    return [re.sub(rb"[A-Z]+", lambda m: m.group().lower(), w) for w in words(text)]


def frame(spark, rows=None):
    """The awkward rows as a table, with extra columns whose names clash with internal ones."""
    df = spark.createDataFrame(awkward() if rows is None else rows, SCHEMA)
    for name in ("cls", "n", "data", "size", "kept", "_id", "_sha", "label", "rank", "digest", "place", "sid", "key", "th"):
        df = df.selectExpr("*", f"'x' as {name}")
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
