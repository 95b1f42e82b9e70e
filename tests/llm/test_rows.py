"""Operators that judge each row by itself: tokens, word pieces, languages, surrogates."""

import gc
import hashlib
import json
import re
import tracemalloc
import weakref
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabwright.llm import bpe, language, surrogates, wordpiece
from tests.llm import data

TRICKY = [
    "", "   ", "ΑΣ Σ'S İstanbul ﬁ é <|endoftext|>x<|startoftext|>", "a\x1cb\x85c d​e \x00", "don't I'LL we'Re ..'s'",
    "日本語 😀👍🏽 ½ ²  Ⅷ ǅ ß ẞ", "a" * 5000, "!\x1c!\x1d", "﻿abc", "é é",
]


def hexed(s):
    return hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.no_truncation()
    t.no_padding()
    return t


def test_bpe_equals_the_library(spark, library):
    rows = [*data.awkward(), *[(100 + i, t, None, None, None) for i, t in enumerate(TRICKY)]]
    want = Counter()
    for r in rows:
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want[r[0], len(ids), hexed(" ".join(map(str, ids))), hexed(library.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(map(tuple, bpe.encode_documents(data.frame(spark, rows)).collect())) == want


def test_bpe_returns_ids_and_text(spark, library):
    df = data.frame(spark).select("text", bpe.bpe(F.col("text"), bpe.vocabulary_path()).alias("e"))
    for r in df.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.e.ids == ids
        assert r.e.decoded == library.decode(ids, skip_special_tokens=False)


def test_memo_is_bounded_and_right(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    memo = bpe.Remembered(len, "test")
    for word in ["a", "bb", "ccc", "dddd", "a", "eeeee", "bb"] * 3:
        assert memo[word] == len(word)
        assert len(memo) <= 3 and len(memo.older) <= 3
    bpe.Remembered.forget_others("test")
    assert len(memo) and memo.older
    bpe.Remembered.forget_others("another")
    assert not memo and not memo.older


def test_a_remembered_word_takes_little_room():
    encoder = bpe.Encoder(bpe.vocabulary_path())
    words = [hexed(str(i))[:12] for i in range(20_000)]
    tracemalloc.start()
    for word in words:
        encoder.encode(word)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 250 * len(words)


@pytest.mark.parametrize("load, owner", [(bpe.encoder, "bpe"), (wordpiece.counter, "pieces")])
def test_vocabularies_are_given_back_to_other_operators(load, owner):
    load.cache_clear()
    held = weakref.ref(load(bpe.vocabulary_path()))
    list(bpe.one_by_one([], owner))
    gc.collect()
    assert held() is load(bpe.vocabulary_path())
    list(bpe.one_by_one([], "another"))
    gc.collect()
    assert held() is None


def greedy(symbols, entries):
    n = 0
    while symbols:
        size = max((k for k in range(1, len(symbols) + 1) if tuple(symbols[:k]) in entries), default=1)
        symbols, n = symbols[size:], n + 1
    return n


def test_automaton_counts_like_greedy_matching():
    rng = np.random.default_rng(2)
    for _ in range(200):
        entries = {(s,) for s in range(3)} | {tuple(rng.integers(0, 3, rng.integers(2, 7)).tolist()) for _ in range(rng.integers(0, 12))}
        automaton = wordpiece.Automaton(list(entries))
        for _ in range(10):
            word = rng.integers(0, 4, rng.integers(0, 25)).tolist()
            assert automaton.count(word) == greedy(word, entries)


def test_automaton_needs_single_symbols():
    with pytest.raises(ValueError):
        wordpiece.Automaton([(0, 1)])


def test_automaton_refuses_a_symbol_that_is_no_entry():
    with pytest.raises(ValueError):
        wordpiece.Automaton([(0,), (0, 1, 0)])


def test_lower_case_of_another_length_changes_that_letter_only():
    plain, odd = language.words_of("HELLO Wide WORLD i"), language.words_of("HELLO Wide WORLD İ")
    assert plain.triples.tolist() == odd.triples.tolist()


def test_many_mentions_in_one_text():
    text = " ".join(f"user{i}@mail.example.com" for i in range(20_000))
    assert [m.value for m in surrogates.mentions(text)] == text.split()


def test_word_pieces_of_documents(spark):
    vocab = set(json.load(open(bpe.vocabulary_path()))["model"]["vocab"])
    letters = bpe.byte_letters()
    split = bpe.WordSplitter(["<|startoftext|>", "<|endoftext|>"])

    def pieces(word):
        left, n = [letters[b] for b in word.encode()], 0
        left[-1] += "</w>"
        while left:
            size = next(k for k in range(len(left), 0, -1) if "".join(left[:k]) in vocab)
            left, n = left[size:], n + 1
        return n

    rows = [r for r in data.awkward() if len(r[1] or "") < 10_000] + [(100, "x <|endoftext|> y", None, None, None)]
    want = Counter()
    for r in rows:
        found = [(s, w) for s, part in split.parts(r[1] or "") for w in ([part] if s else [w for c in split.chunks(part) for w in split.words(c)])]
        want[r[0], len(found), sum(1 if s else pieces(w) for s, w in found)] += 1
    assert Counter(map(tuple, wordpiece.count_tokens(data.frame(spark, rows)).collect())) == want


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(3)
    scores = [rng.normal(size=(int(n), 3)).astype(np.float32) for n in (5, 0, 7, 1, 6)]
    for s, path in zip(scores, language.viterbi(scores, 1.0)):
        best = [(-np.inf, None)]
        for code in range(3 ** len(s)):
            p = [code // 3**i % 3 for i in range(len(s))]
            best.append((sum(s[i, k] for i, k in enumerate(p)) - sum(a != b for a, b in zip(p, p[1:])), p))
        if len(s):
            assert path.tolist() == max(best, key=lambda b: b[0])[1]


def test_words_and_slices(monkeypatch):
    text = "Ab, cdé 12 x\nДом"
    w = language.words_of(text)
    assert [text[a:b] for a, b in zip(w.starts, w.ends)] == ["Ab", "cdé", "x", "Дом"]
    assert len(w.triples) == 9
    monkeypatch.setattr(language, "SLICE", 4)
    assert "".join(p for _, p in language.slices(text)) == text
    assert [text[o : o + len(p)] for o, p in language.slices(text)] == [p for _, p in language.slices(text)]


LABELLED = [
    (i, " ".join(data.prose(i, 50) if i % 2 else ["жук", "дом", "кот", "рыба", "лес"] * 10), ("en", "ru")[i % 2 == 0], "s", 1) for i in range(40)
]


def test_language_and_spans(spark):
    model = language.fit_corpus(data.frame(spark, LABELLED))
    assert model.langs == ["en", "ru"]
    mixed = " ".join(data.prose(77, 30)) + " " + "кот лес дом " * 5 + " ".join(data.prose(78, 3))
    rows = [(1, mixed, None, None, None), (2, None, "en", None, None), (3, "12 !!", "ru", None, None), (4, "ДОМ", "en", "x", 0), (None, "", None, None, None)]
    df = data.frame(spark, rows)
    got = {r.doc_id: r for r in language.predict(df, model).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 4, None)] == ["en", "und", "und", "ru", "und"]
    assert got[3].score == 0 and got[4].score == 1 and 0 < got[1].score < 1
    assert got[1].held_out == (__import__("zlib").crc32(b"1") % 4 == 2)
    spans = df.filter("doc_id = 1").select(language.identify(F.col("text"), model).alias("r")).first().r.spans
    assert [s.lang for s in spans] == ["en", "ru"] or [s.lang for s in spans] == ["en", "ru", "en"]
    assert mixed[spans[1].start : spans[1].end].strip().startswith("кот лес")


def test_language_on_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = language.predict(docs, language.fit_corpus(docs)).filter("held_out").join(docs, "doc_id")
    right = judged.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right > 0.95


def test_language_without_labels(spark):
    df = data.frame(spark, [(1, "text", None, None, None)])
    assert [r.lang_pred for r in language.predict(df, language.fit_corpus(df)).collect()] == ["und"]


def test_surrogates_keep_type_format_gender_and_coreference(spark):
    text = (
        "Frau Maria Lopez (MARIA.L@mail.example.com, 10.2.3.4) paid with 4532 0151 1283 0366; Mr Lopez called +1 (555) 123-4567. "
        "Lopez wrote to maria.l@mail.example.com. IBAN DE89 3704 0044 0532 0130 00, token = \"ff60d8d5b1b4efef3e225a79bff96594ffd5a6ec\""
    )
    rows = [(1, text, None, None, None), (2, "ip 10.2.3.4, 10.2.3.5 and version 1.2.3", "en", "s", 1), (3, None, None, None, None), (3, "", None, None, None)]
    got = surrogates.with_surrogates(data.frame(spark, rows), "key").collect()
    one, two = (next(r for r in got if r.doc_id == i) for i in (1, 2))
    kinds = [one.text[s.start : s.end] for s in one.spans]
    assert [s.kind for s in one.spans] == ["name", "name", "email", "ip", "card", "name", "phone", "name", "email", "iban", "secret"]
    for old in ("Maria", "Lopez", "mail.example", "10.2.3.4", "4532", "555", "3704", "ff60"):
        assert old.lower() not in one.text.lower()
    assert kinds[0].endswith("a") and kinds[0].istitle()
    assert kinds[1] == kinds[5] == kinds[7]
    assert kinds[2].lower() == kinds[8] and kinds[2].partition("@")[0].isupper()
    assert re.fullmatch(r"\d{4} \d{4} \d{4} \d{4}", kinds[4]) and surrogates.luhn(kinds[4].replace(" ", "")) == 0
    assert re.fullmatch(r"\+\d \(\d{3}\) \d{3}-\d{4}", kinds[6])
    assert int("".join(str(int(c, 36)) for c in (kinds[9][4:] + kinds[9][:4]).replace(" ", ""))) % 97 == 1
    assert re.fullmatch("[0-9a-f]{40}", kinds[10])
    assert one.text[: one.spans[0].start] == "Frau " and "1.2.3" in two.text
    assert two.text.startswith(f"ip {kinds[3]}, ") and two.n_entities == 2
    assert sorted(r.text for r in got if r.doc_id == 3) == ["", ""]
    other = surrogates.with_surrogates(data.frame(spark, rows), "another key").collect()
    assert {r.text for r in other if r.doc_id == 1} != {one.text}


PHONES = [
    "+14155552671", "+1 4155552671", "+1 (555) 123-4567", "+1-415-555-2671", "+1.415.555.2671", "01234 567890", "(030) 1234567",
    "+49 30 1234567", "+49 170 1234567", "+49 (0)30 1234567", "+49 123-45-6789", "+33 1 23 45 67 89", "01 23 45 67 89", "0612345678",
    "+44 20 7946 0958", "020 7946 0958", "030/1234567", "0171-1234567", "0049 30 1234567", "+7 495 123-45-67", "+30 210 1234567",
    "+34 612 345 678", "+39 06 1234 5678", "+86 138 0013 8000", "+81 3-1234-5678", "+298 123456", "(415) 555-2671", "415-555-2671",
    "+49 1512 3456789",
]


@pytest.mark.parametrize("phone", PHONES)
def test_phone_numbers_in_national_formats(phone):
    found = surrogates.mentions(f"Tel. {phone}, 10.2.3.4")
    assert [(m.kind, m.value) for m in found] == [("phone", phone), ("ip", "10.2.3.4")]
    assert [m.kind for m in surrogates.mentions(f"{phone} 10.2.3.4")] == ["phone", "ip"]


def test_what_is_no_phone_number():
    text = "On 01/02/2024 12:30, 2024-12-31, version 1.2.3, 0.123456789, 1234567, x+1234567890, pages 10-20"
    assert surrogates.mentions(text) == []
    assert [(m.kind, m.value) for m in surrogates.mentions("+4532 0151 1283 0366")] == [("card", "4532 0151 1283 0366")]


def test_all_parts_of_a_name_are_found():
    found = surrogates.mentions("Señora Maria Lopez Garcia Perez Ruiz met Dr Ann Lee.")
    assert [m.value for m in found] == ["Maria", "Lopez", "Garcia", "Perez", "Ruiz", "Ann", "Lee"]


def test_surrogates_stay_distinct_where_a_format_has_few_values(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"{letters[i % 26]}@b.com and {letters[(i + 1) % 26]}@b.com", None, None, None) for i in range(60)]
    made = {}
    for r in surrogates.with_surrogates(data.frame(spark, rows), "k").collect():
        first, second = r.text.split(" and ")
        assert made.setdefault(r.doc_id % 26, first) == first
        assert made.setdefault((r.doc_id + 1) % 26, second) == second
    assert len(set(made.values())) == 26


def test_empty_tables(spark):
    none = data.empty(spark)
    assert bpe.encode_documents(none).count() == 0
    assert wordpiece.count_tokens(none).count() == 0
    assert language.predict(none, language.fit_corpus(none)).count() == 0
    assert surrogates.with_surrogates(none, "k").count() == 0
