"""Greedy word-piece lengths by a longest-match automaton, without building the pieces."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bpe import Remembered, WordSplitter, byte_letters, vocabulary_path
from tabwright.llm.common import ship


class Automaton:
    """Trie of a vocabulary with failure links.

    Node u stands for a prefix of some entry. When no edge continues it, ``popped[u]``
    entries are what greedy longest match takes off its front, and ``fail[u]`` is the node of
    what is left. Every symbol is read once and each link consumes an entry, so a word
    costs time in proportion to its length. Entries are sequences of symbols in which every
    single symbol is an entry; -1 marks the root's missing link.
    """

    def __init__(self, entries: list[tuple[int, ...]]):
        self.edges: list[dict[int, int]] = [{}]
        ends = [False]
        for entry in entries:
            u = 0
            for s in entry:
                v = self.edges[u].get(s)
                if v is None:
                    v = self.edges[u][s] = len(self.edges)
                    self.edges.append({})
                    ends.append(False)
                u = v
            ends[u] = True
        symbols = {s for entry in entries for s in entry}
        if not all(s in self.edges[0] and ends[self.edges[0][s]] for s in symbols):
            raise ValueError("every single symbol must be an entry")
        self.fail, self.popped = [-1] * len(self.edges), [0] * len(self.edges)
        queue = deque([0])
        while queue:
            u = queue.popleft()
            for s, v in self.edges[u].items():
                if ends[v]:
                    self.fail[v], self.popped[v] = 0, 1
                else:
                    z, n = self.fail[u], self.popped[u]
                    while s not in self.edges[z]:
                        n += self.popped[z]
                        z = self.fail[z]
                    self.fail[v], self.popped[v] = self.edges[z][s], n
                queue.append(v)

    def count(self, symbols: list[int]) -> int:
        """Entries that greedy longest match needs; symbols unknown to the vocabulary count as one each."""
        edges, fail, popped = self.edges, self.fail, self.popped
        u = n = 0
        for s in symbols:
            v = edges[u].get(s)
            while v is None and u:
                n += popped[u]
                u = fail[u]
                v = edges[u].get(s)
            if v is None:
                n += 1
            else:
                u = v
        while u:
            n += popped[u]
            u = fail[u]
        return n


class Counter:
    """Chunk of a text -> its words and pieces. A word's last byte is a symbol of its own, with the word's end."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"]["end_of_word_suffix"] or ""
        codes = {c: b for b, c in enumerate(byte_letters())}
        entries = []
        for name in spec["model"]["vocab"]:
            ended = bool(suffix) and name.endswith(suffix) and name != suffix
            symbols = [codes[c] for c in (name[: -len(suffix)] if ended else name)]
            entries.append((*symbols[:-1], symbols[-1] + 256 * ended))
        self.automaton = Automaton(entries)
        self.split = WordSplitter([t["content"] for t in spec["added_tokens"]])
        self.chunks = Remembered(self.chunk, "pieces")

    @staticmethod
    def symbols(word: str) -> list[int]:
        raw = [*word.encode("utf-8", "replace")]
        raw[-1] += 256
        return raw

    def chunk(self, chunk: str) -> tuple[int, int]:
        words = self.split.words(chunk)
        return len(words), sum([self.automaton.count(self.symbols(w)) for w in words])

    def of_text(self, text: str) -> tuple[int, int]:
        """Words and pieces of a text; a special token is one of each."""
        found = []
        for special, part in self.split.parts(text):
            if special:
                found.append((1, 1))
            elif part:
                found += map(self.chunks.__getitem__, self.split.chunks(part))
        if not found:
            return 0, 0
        words, pieces = zip(*found)
        return sum(words), sum(pieces)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


Remembered.loaded.append(("pieces", counter.cache_clear))


def count_tokens(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_tokens of every row's whole text.

    Null and empty texts have none. Rows are counted one by one without a shuffle, so
    repeated rows and other columns don't matter; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    path = path or vocabulary_path()

    @F.pandas_udf("n_words long, n_tokens long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        count = counter(path).of_text
        Remembered.forget_others("pieces")
        for batch in batches:
            yield pd.DataFrame([count(t or "") for t in batch], columns=["n_words", "n_tokens"])

    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), run(F.col(text_col)).alias("t"))
    return made.select("doc_id", "t.n_words", "t.n_tokens")
