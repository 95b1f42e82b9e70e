"""Language identification: scripts narrow the candidates, Viterbi labels the spans."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.bpe import one_by_one
from tabwright.llm.common import ship

# Buckets of letter triples.
BUCKETS = 1 << 16
# Expected number of sampled training documents of a language: the bound of what is fitted on.
SAMPLE_DOCS = 2000
# Cost of a change of language between two words, in nats.
SWITCH = 12.0
# A language is a candidate for a script that makes up this share of its letters.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
# Characters whose letters are scored at a time, and words of a batch of texts.
SLICE = 1 << 20
BATCH_WORDS = 1 << 19

# First and last code point of letters of scripts, after the Unicode block chart.
SCRIPTS = {
    "greek": [(0x0370, 0x03FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x0400, 0x052F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x0530, 0x058F)],
    "hebrew": [(0x0590, 0x05FF)],
    "arabic": [(0x0600, 0x06FF), (0x0750, 0x077F), (0x08A0, 0x08FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x0900, 0x097F)],
    "bengali": [(0x0980, 0x09FF)],
    "tamil": [(0x0B80, 0x0BFF)],
    "thai": [(0x0E00, 0x0E7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)],
}
# 0 is no letter, 1 Latin, 2 any other letter, then the scripts above.
N_SCRIPTS = len(SCRIPTS) + 3


@lru_cache(maxsize=1)
def script_table() -> np.ndarray:
    """Script of every code point; 0 for what is no letter."""
    table = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    letters = table.astype(bool)
    table[0x0250:][letters[0x0250:]] = 2
    table[0x1E00:0x1F00][letters[0x1E00:0x1F00]] = 1
    for number, ranges in enumerate(SCRIPTS.values(), 3):
        for first, last in ranges:
            part = slice(first, last + 1)
            table[part][letters[part]] = number
    return table


@dataclass
class Words:
    """Words of a text: runs of letters. ``triples`` has a bucket per letter."""

    starts: np.ndarray
    ends: np.ndarray
    scripts: np.ndarray
    triples: np.ndarray
    first: np.ndarray


def words_of(text: str) -> Words:
    """Words of a text or of a slice that ends at a word's end. Offsets are in characters."""
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    script = script_table()[raw]
    at = np.flatnonzero(script)
    lowered = text.lower()
    if len(lowered) != len(text):
        # Letters whose lower case has several characters are read as the first of them.
        for letter in set(text):
            if len(letter.lower()) > 1:
                text = text.replace(letter, letter.lower()[0])
        lowered = text.lower()
    low = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
    padded = np.zeros(len(raw) + 2, np.uint32)
    padded[1:-1] = np.where(script > 0, low, 0)
    mixed = padded[at] * np.uint32(0x9E3779B1) + padded[at + 1] * np.uint32(0x85EBCA77) + padded[at + 2] * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    triples = (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(16)
    new = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    last = np.append(new[1:], len(at))[: len(new)] - 1
    return Words(at[new], at[last] + 1, script[at[new]], triples, new)


def slices(text: str) -> Iterator[tuple[int, str]]:
    """(offset, slice) of a text, cut where no word goes on, so that long texts take little memory."""
    at = 0
    while len(text) - at > SLICE:
        end = at + SLICE
        while end < len(text) and text[end].isalpha():
            end += 1
        yield at, text[at:end]
        at = end
    yield at, text[at:]


@dataclass
class Model:
    """Log-probabilities of letter triples and candidates of scripts, per language."""

    langs: list[str]
    table: np.ndarray
    allowed: np.ndarray

    def word_scores(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and scores (words x languages) of a whole text."""
        starts, ends, scores = [], [], []
        for offset, part in slices(text):
            w = words_of(part)
            if not len(w.starts):
                continue
            s = np.add.reduceat(self.table[w.triples], w.first, axis=0)
            s[~self.allowed[w.scripts]] = -1e6
            starts.append(w.starts + offset)
            ends.append(w.ends + offset)
            scores.append(s)
        if not starts:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros((0, len(self.langs)), np.float32)
        return np.concatenate(starts), np.concatenate(ends), np.concatenate(scores)


def viterbi(scores: list[np.ndarray], switch: float = SWITCH) -> list[np.ndarray]:
    """Best language of every word of each text: its scores less ``switch`` for each change.

    Texts advance together, a word at a time, longest first.
    """
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    lengths = np.array([len(scores[i]) for i in order])
    out: list[np.ndarray] = [np.zeros(0, np.int16)] * len(scores)
    if not len(lengths) or lengths[0] == 0:
        return out
    n, k = int((lengths > 0).sum()), scores[0].shape[1]
    lengths = lengths[:n]
    begin = np.append(0, np.cumsum(lengths))
    flat = np.concatenate([scores[i] for i in order[:n]])
    back = np.empty((len(flat), k), np.int16)
    own = np.arange(k, dtype=np.int16)
    best = flat[begin[:-1]].astype(np.float64)
    live = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
    for t in range(1, lengths[0]):
        m = live[t]
        v = best[:m]
        top = v.argmax(axis=1)
        height = v[np.arange(m), top] - switch
        stay = v >= height[:, None]
        rows = begin[:m] + t
        back[rows] = np.where(stay, own, top[:, None])
        best[:m] = np.where(stay, v, height[:, None]) + flat[rows]
    path = np.empty(len(flat), np.int16)
    state = best.argmax(axis=1).astype(np.int16)
    for t in range(lengths[0] - 1, -1, -1):
        m = live[t]
        rows = begin[:m] + t
        path[rows] = state[:m]
        if t:
            state[:m] = back[rows, state[:m]]
    for j, i in enumerate(order[:n]):
        out[i] = path[begin[j] : begin[j + 1]]
    return out


def held_out(id_col: Column) -> Column:
    """Documents that are never learned from; a null id is not held out, nor learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key: Column | None = None, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on labelled rows: those whose text and language are not null.

    Of each language, rows are drawn by a hash of ``key`` (the text by default), about
    ``sample_docs`` of them or all if there are fewer. Counts of letter triples and scripts are
    summed in Spark; the driver gets at most BUCKETS numbers per language. Without labelled
    rows the model knows no language.
    """
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"), (key if key is not None else F.xxhash64(text_col)).alias("key"))
    rows = rows.filter("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.ones((N_SCRIPTS, 0), bool))
    scale = 1 << 30
    shares = spark.createDataFrame([(x, int(min(1.0, sample_docs / sizes[x]) * scale), i) for i, x in enumerate(langs)], "lang string, below long, number int")
    drawn = rows.join(F.broadcast(shares), "lang").filter(F.pmod("key", F.lit(scale)) < F.col("below")).select("text", "number")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in one_by_one(batches, "language"):
            for text, number in zip(batch["text"], batch["number"]):
                n = sums.setdefault(number, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                for _, part in slices(text):
                    w = words_of(part)
                    n[:BUCKETS] += np.bincount(w.triples, minlength=BUCKETS)
                    long = np.diff(np.append(w.first, len(w.triples)))
                    n[BUCKETS:] += np.bincount(w.scripts, long, minlength=N_SCRIPTS).astype(np.int64)
        for number, n in sums.items():
            at = np.flatnonzero(n)
            yield pd.DataFrame({"number": np.int32(number), "at": at.astype(np.int32), "n": n[at]})

    counted = drawn.mapInPandas(count, "number int, at int, n long").groupBy("number", "at").agg(F.sum("n").alias("n")).toPandas()
    seen = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    seen[counted["at"], counted["number"]] = counted["n"]
    triples, scripts = seen[:BUCKETS] + 0.5, seen[BUCKETS:]
    table = np.log(triples / triples.sum(axis=0)).astype(np.float32)
    allowed = scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=0))
    allowed[~allowed.any(axis=1)] = True
    return Model(langs, table, allowed)


SPANS = "lang_pred string, score double, spans array<struct<start:int,end:int,lang:string>>"


def identify(text: Column, model: Model, switch: float = SWITCH, with_spans: bool = True) -> Column:
    """Struct of lang_pred, score and spans (start, end in characters, lang) of whole texts.

    The language is the one whose spans hold most letters (ties: the first by name), the
    score its share of the letters. Text that is null or without letters is ``und`` with
    score 0; so is every text if the model knows no language.

    Spark counts the function as not deterministic, so that a filter on the result doesn't judge every text
    a second time, in a second worker of the same task.
    """
    @F.pandas_udf(SPANS)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in one_by_one(batches, "language"):
            out, waiting, held = [], [], 0
            for text in batch:
                waiting.append(model.word_scores(text or "") if model.langs else None)
                held += len(waiting[-1][0]) if waiting[-1] else 0
                if held >= BATCH_WORDS:
                    out += labelled(model, waiting, switch, with_spans)
                    waiting, held = [], 0
            out += labelled(model, waiting, switch, with_spans)
            yield pd.DataFrame(out, columns=["lang_pred", "score", "spans"])

    return run.asNondeterministic()(text)


def labelled(model: Model, waiting: list, switch: float, with_spans: bool) -> list[tuple]:
    out = []
    paths = viterbi([w[2] for w in waiting], switch) if model.langs else [()] * len(waiting)
    for found, path in zip(waiting, paths):
        if not len(path):
            out.append((UNKNOWN, 0.0, []))
            continue
        starts, ends, _ = found
        letters = np.bincount(path, ends - starts, minlength=len(model.langs))
        best = int(letters.argmax())
        spans = []
        if with_spans:
            new = np.flatnonzero(np.diff(path, prepend=-1))
            last = np.append(new[1:], len(path)) - 1
            spans = [
                {"start": a, "end": b, "lang": model.langs[p]}
                for a, b, p in zip(starts[new].tolist(), ends[last].tolist(), path[new].tolist())
            ]
        out.append((model.langs[best], float(letters[best] / letters.sum()), spans))
    return out


def fit_corpus(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit on the documents that are not held out."""
    usable = docs.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return fit(usable, key=F.xxhash64("doc_id"), sample_docs=sample_docs)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_spans of every row; only the text is judged.

    Rows are judged one by one: repeated rows and other columns change nothing, and an
    empty table gives no rows.
    """
    ship(docs.sparkSession)
    made = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        identify(F.col("text"), model).alias("r"),
    )
    return made.select("doc_id", "held_out", "r.lang_pred", "r.score", F.size("r.spans").alias("n_spans"))
