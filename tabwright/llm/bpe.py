"""Byte-pair encoding with a heap of merge ranks, and decoding by the vocabulary."""

from __future__ import annotations

import ctypes
import hashlib
import heapq
import json
import unicodedata
import weakref
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import ClassVar

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import ship

# Texts whose result a worker remembers in each of two generations, and their greatest length.
REMEMBERED = 150_000
LONG_WORD = 60
# Ids that are written out at a time.
IDS_OUT = 1 << 16


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class WordSplitter:
    """Lower-cased words of a text, and the special tokens that stand in it."""

    # White space here is Unicode's; ASCII separators 1C to 1F are none.
    WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\p{Z}\p{L}\p{N}]+")
    SEPARATORS = regex.compile("[\x1c-\x1f]")
    SPACES = regex.compile(r"[\t-\r \x85\p{Z}]+")

    def __init__(self, special: list[str]):
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is it special, part) of a text."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield False, text[at : m.start()]
            yield True, m.group()
            at = m.end()
        yield False, text[at:] if at else text

    def chunks(self, part: str) -> list[str]:
        """What stands between white space, composed and lower-cased; words never cross it."""
        if not unicodedata.is_normalized("NFC", part):
            part = unicodedata.normalize("NFC", part)
        # Letters are lowered one by one: a final sigma is no special case.
        part = part.replace("Σ", "σ").lower()
        return [c for c in self.SPACES.split(part) if c] if self.SEPARATORS.search(part) else part.split()

    def words(self, chunk: str) -> list[str]:
        return [chunk] if chunk.isalpha() and chunk.isascii() else self.WORDS.findall(chunk)


class Remembered(dict):
    """A bounded memo of ``make``: a full generation replaces the older one, which still serves.

    Workers live on from job to job; ``forget_others`` gives back what the memos of other
    operators hold there, and the vocabularies that they have loaded (``loaded``: by owner, what drops them).
    """

    memos: ClassVar[list[tuple[str, weakref.ref[Remembered]]]] = []
    loaded: ClassVar[list[tuple[str, Callable[[], None]]]] = []

    def __init__(self, make, owner: str):
        self.make, self.older = make, {}
        self.memos.append((owner, weakref.ref(self)))

    @classmethod
    def forget_others(cls, owner: str) -> None:
        for other, drop in cls.loaded:
            if other != owner:
                drop()
        cls.memos[:] = [m for m in cls.memos if m[1]() is not None]
        for other, named in cls.memos:
            memo = named()
            if other != owner and memo is not None:
                memo.clear()
                memo.older = {}

    def __missing__(self, key: str):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        if len(key) <= LONG_WORD:
            self[key] = found
        return found


def one_by_one(batches: Iterator, owner: str) -> Iterator:
    """The batches of a task, after the memos of other operators were given back.

    After each batch the worker returns free memory to the system: words of whole texts come and
    go by the million, and the allocators would keep their pages for the life of the worker.
    """
    Remembered.forget_others(owner)
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    for batch in batches:
        yield batch
        pa.default_memory_pool().release_unused()
        if trim is not None:
            trim(0)


class Encoder:
    """Chunk of a text -> ids of its words, as the bytes of 32-bit numbers.

    One memo holds chunks and the words in them: a word that stands alone is a chunk. Bytes take a
    third of the room that the ids' and the vocabulary's strings would.

    A word's symbols form a doubly linked list. The heap holds (rank, position) of pairs
    that can merge; an entry whose pair has changed meanwhile is skipped when it comes up.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        named = {i: s for s, i in [*vocab.items(), *self.special.items()]}
        # A pair of ids as one number: its rank, and the id that it merges to.
        self.wide = max(named) + 1
        self.names = [named.get(i, "") for i in range(self.wide)]
        self.digits = [str(i) for i in range(self.wide)]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[vocab[left] * self.wide + vocab[right]] = (rank, vocab[left + right])
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + self.suffix] for c in letters]
        self.split = WordSplitter(list(self.special))
        self.chunks = Remembered(self.chunk, "bpe")

    def ids(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "replace")
        symbols = [self.inner[b] for b in raw]
        symbols[-1] = self.last[raw[-1]]
        n = len(symbols)
        if n == 1:
            return symbols
        merges, wide, push, pop = self.merges, self.wide, heapq.heappush, heapq.heappop
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            found = merges.get(symbols[i] * wide + symbols[i + 1])
            if found:
                heap.append((found[0], i, found[1]))
        heapq.heapify(heap)
        while heap:
            rank, i, merged = pop(heap)
            left, j = symbols[i], after[i]
            if left < 0 or j >= n:
                continue
            found = merges.get(left * wide + symbols[j])
            if found is None or found[0] != rank:
                continue
            symbols[i], symbols[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get(merged * wide + symbols[k])
                if found:
                    push(heap, (found[0], i, found[1]))
            h = before[i]
            if h >= 0:
                found = merges.get(symbols[h] * wide + merged)
                if found:
                    push(heap, (found[0], h, found[1]))
        return [s for s in symbols if s >= 0]

    def chunk(self, chunk: str) -> bytes:
        words = self.split.words(chunk)
        return array("I", self.ids(chunk)).tobytes() if len(words) == 1 else b"".join(map(self.chunks.__getitem__, words))

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text."""
        found = []
        for special, part in self.split.parts(text):
            if special:
                found.append(array("I", [self.special[part]]).tobytes())
            elif part:
                found += map(self.chunks.__getitem__, self.split.chunks(part))
        return np.frombuffer(b"".join(found), np.uintc)

    def written(self, ids: np.ndarray, letters: list[str]) -> Iterator[str]:
        """Pieces of what ``letters`` has for the ids, joined by spaces: the vocabulary has no decoder."""
        for i in range(0, len(ids), IDS_OUT):
            yield (" " if i else "") + " ".join(map(letters.__getitem__, ids[i : i + IDS_OUT].tolist()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    return Encoder(path)


Remembered.loaded.append(("bpe", encoder.cache_clear))


def bpe(text: Column, path: str) -> Column:
    """Struct of ids (array<int>) and decoded (string). Null text is empty; so is its encoding."""

    @F.pandas_udf("ids array<int>, decoded string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in one_by_one(batches, "bpe"):
            ids = [enc.encode(t or "") for t in batch]
            yield pd.DataFrame({"ids": [i.tolist() for i in ids], "decoded": ["".join(enc.written(i, enc.names)) for i in ids]})

    return run(text)


def bpe_digest(text: Column, path: str) -> Column:
    """Struct of n_tokens and the hashes of ids and of the decoded text, of whole texts."""

    def hexed(pieces: Iterator[str]) -> str:
        digest = hashlib.sha256()
        for s in pieces:
            digest.update(s.encode("utf-8", "replace"))
        return digest.hexdigest()

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in one_by_one(batches, "bpe"):
            out = []
            for t in batch:
                ids = enc.encode(t or "")
                out.append((len(ids), hexed(enc.written(ids, enc.digits)), hexed(enc.written(ids, enc.names))))
            yield pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return run(text)


def encode_documents(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row.

    A row is encoded by itself, without a shuffle: nulls in other columns, repeated rows and
    ties change nothing, and an empty table gives no rows.
    """
    ship(docs.sparkSession)
    path = path or vocabulary_path()
    made = docs.select(F.col(id_col).cast("long").alias("doc_id"), bpe_digest(F.col(text_col), path).alias("e"))
    return made.select("doc_id", "e.n_tokens", "e.ids_sha256", "e.decoded_sha256")
