"""Operators over the whole corpus: mixing, vector search, passages, and the pipeline."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tabwright.llm import common, mixing, passages, vector_search
from tabwright.llm.queries import QUERIES, SQL
from tests.llm import data
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(spark, sf_dir, QUERIES[name], SQL[name]) is None


def test_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert len({n.split("_")[0] for n in QUERIES}) == 13
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "exact dedup", "n-gram Jaccard join", "mixing", "BPE"]


@pytest.mark.parametrize("block", [7, 2048])
def test_mixture(spark, block):
    documents, sources, mixture = mixing.mix(data.frame(spark), block=block)
    got = mixing.taken(documents, sources, mixture).collect()
    rows = data.awkward()
    assert Counter((r.doc_id, r.size) for r in got) == Counter((r[0], len(data.words(r[1]))) for r in rows)
    total = sum(len(data.words(r[1])) for r in rows)
    sizes, took, targets = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r[3]] += len(data.words(r[1]))
    by_sid = {r.sid: r for r in sources.collect()}
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    assert [by_sid[i + 1].source for i in range(len(names))] == names
    # Water level by hand.
    capped = {}
    while True:
        free = [s for s in names if s not in capped]
        rest, weight = total - sum(capped.values()), sum(names.index(s) % 3 + 1 for s in free)
        over = [s for s in free if rest * (names.index(s) % 3 + 1) / weight > 3 * sizes[s]]
        if not over:
            break
        capped.update({s: 3 * sizes[s] for s in over})
    targets = {s: capped.get(s, rest * (names.index(s) % 3 + 1) / weight) for s in names}
    for i, s in enumerate(names):
        assert by_sid[i + 1].target == pytest.approx(targets[s])
    for r in got:
        assert r.taken <= 3 * r.size
    used = mixture.groupBy("sid").agg(F.sum("n_words").alias("n"), F.countDistinct("slot").alias("slots")).collect()
    for r in used:
        assert abs(r.n - targets[names[r.sid - 1]]) <= 0.5
        assert r.slots == -(-r.n // block)
    per_slot = mixture.groupBy("sid", "slot").agg(F.sum("n_words").alias("n")).collect()
    last = Counter(r.sid for r in per_slot if r.n < block)
    assert all(n == 1 for n in last.values())
    again = mixing.taken(*mixing.mix(data.frame(spark), block=block)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_schedule_is_spread_evenly(spark):
    rows = [(i, "w " * 100, None, "abc"[i % 3], 0) for i in range(300)]
    _, sources, mixture = mixing.mix(data.frame(spark, rows), block=50)
    share = {r.sid: r.target / 30_000 for r in sources.collect()}
    slots = sorted({(r.slot, r.sid) for r in mixture.select("slot", "sid").collect()})
    for sid, want in share.items():
        places = np.array([s == sid for _, s in slots]).cumsum()
        assert np.abs(places - want * np.arange(1, len(slots) + 1)).max() < 6


def test_repeat_documents(spark):
    df = data.frame(spark)
    got = mixing.repeat_documents(df)
    assert got.columns == df.columns
    assert max(Counter((r.doc_id, r.text) for r in got.collect()).values()) <= 6


def vectors(n, dim=6, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([rng.gauss(0, 1), 0.25]) for _ in range(dim)]) for i in range(n)]
    rows += [(n, None), (n + 1, [None] * dim), (n + 2, [float("nan")] * dim), (n + 3, [float("inf")] * dim), (None, [1.0] * dim), (n + 4, [])]
    rows += [(10_000 + i, [0.5] * dim) for i in range(60)] + [(40, [1.0] * dim), (41, [0.1, 0.2])]
    return rows


@pytest.mark.parametrize("annulus", [3, 1024])
def test_search_equals_brute_force(spark, annulus):
    rows = vectors(150)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as rank", "'y' as score", "'z' as pivot")
    got = Counter(map(tuple, vector_search.top_k(df, pivots=5, annulus=annulus).collect()))
    used = [
        (i, np.pad(np.floor(64 * np.array(v, float)), (0, 6 - len(v))).astype(int))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    want = Counter()
    for q, x in used:
        if q % 20 == 0:
            found = sorted((-int(x @ y), i) for i, y in used if i != q)[:20]
            want.update((q, r + 1, i, -s) for r, (s, i) in enumerate(found))
    # Rows that repeat an id and a score are interchangeable.
    assert got == want


def test_search_keeps_large_components_and_raises_beyond_32_bits(spark):
    vectors = [[2.0**23, 1.0], [-(2.0**24), 2.0], [2.0**24, -3.5], [0.5, 0.25], [2.0**25 - 1, -(2.0**25) + 1]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    whole = [[int(np.floor(64 * x)) for x in v] for v in vectors]
    want = []
    for q in range(5):
        best = sorted((-sum(a * b for a, b in zip(whole[q], whole[c])), c) for c in range(5) if c != q)
        want += [(q, i + 1, c, -s) for i, (s, c) in enumerate(best)]
    assert sorted(map(tuple, vector_search.top_k(df, every=1).collect())) == want
    beyond = spark.createDataFrame([(0, [2.0**26])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        vector_search.top_k(beyond).collect()


def test_search_with_few_rows_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    one = spark.createDataFrame([(0, [1.0, 2.0]), (3, [1.0, 1.0])], schema)
    assert [tuple(r) for r in vector_search.top_k(one).collect()] == [(0, 1, 3, 64 * 64 * 3)]
    assert vector_search.top_k(spark.createDataFrame([], schema)).count() == 0
    assert vector_search.top_k(spark.createDataFrame([(0, None)], schema)).count() == 0


def test_chain_score_is_the_best():
    rng = random.Random(4)
    for _ in range(100):
        anchors = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(rng.randrange(1, 25))})
        best = []
        for i, (x, y) in enumerate(anchors):
            before = [best[j] - passages.GAP * (x + y - u - v) for j, (u, v) in enumerate(anchors[:i]) if u < x and v < y]
            best.append(passages.GAIN + max([0.0, *before]))
        found = passages.chains(anchors)
        top = found[0]
        assert passages.GAIN * len(top) - passages.GAP * (sum(top[-1]) - sum(top[0])) == pytest.approx(max(best))
        assert sorted(a for c in found for a in c) == anchors
        assert all(a < c and b < d for chain in found for (a, b), (c, d) in zip(chain, chain[1:]))


def test_common_subsequence():
    rng = random.Random(5)
    for _ in range(100):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert passages.common(np.array(a, np.uint32), np.array(b, np.uint32)) == table[-1, -1]


def test_planted_passages_are_found_and_clean_documents_are_not(spark):
    rng = random.Random(6)
    texts = [data.prose(5000 + i, rng.randrange(60, 250)) for i in range(80)]
    planted = set()
    for k in range(12):
        passage = data.prose(9000 + k, rng.randrange(70, 100))
        for d in rng.sample([i for i in range(80) if i not in planted], 3):
            copy = list(passage)
            for _ in range(3):
                copy[rng.randrange(len(copy))] = "edited"
            at = rng.randrange(len(texts[d]))
            texts[d][at:at] = copy
            planted.add(d)
    rows = [(i, " ".join(t), None, None, None) for i, t in enumerate(texts)]
    rows += [(None, rows[0][1], None, None, None), (200, None, None, None, None), (201, "", None, None, None), rows[3]]
    got = passages.repeated_passages(data.frame(spark, rows)).collect()
    assert {r.doc_id for r in got} | {r.ref_doc_id for r in got} == planted
    for r in got:
        assert r.end_word - r.start_word >= 50 and r.similarity >= 0.75
        here, there = texts[r.doc_id][r.start_word : r.end_word], texts[r.ref_doc_id][r.ref_start_word : r.ref_end_word]
        assert len(set(here) & set(there)) >= 0.6 * len(set(here))


def test_long_gaps_are_aligned_whatever_their_length():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 1 << 30, 5000).astype(np.uint32)
    y = x.copy()
    y[1000:4000:150] = 7
    # An insertion, so that places no longer agree, far from the seeds on either side.
    y = np.insert(y, 1100, [1, 2])
    ends = [(a, a if a < 1000 else a + 2) for a in (10, 980, 4010, 4990)]
    assert passages.align(x, y, ends) == [(0, 5000, 0, 5002, 4980)]
    # Beyond SKIP more words on one side than on the other there are two passages.
    z = np.insert(x, 2500, rng.integers(1 << 30, 1 << 31, 3000).astype(np.uint32))
    ends = [(a, a if a < 2500 else a + 3000) for a in (10, 2400, 2600, 4990)]
    assert [p[:4] for p in passages.align(x, z, ends)] == [(0, 2500, 0, 2500), (2500, 5000, 5500, 8000)]


def test_overlapping_passages_of_one_chain_are_whole():
    rng = np.random.default_rng(5)
    x, y = (rng.integers(0, 1 << 30, 400).astype(np.uint32) for _ in range(2))
    y[100:170] = x[100:170]
    y[7:62] = x[67:122] = np.append(x[67:100], x[100:122])
    assert passages.align(x, y, [(70, 10), (98, 38), (125, 125), (160, 160)])[1][:4] == (100, 170, 100, 170)


def test_a_hot_seed_is_spread(spark, monkeypatch):
    """A passage that most documents share, once with its seeds as hot keys and once without."""
    shared = data.prose(31, 80)
    rows = [(i, " ".join([*data.prose(700 + i, 60), *(shared if i % 4 else []), *data.prose(800 + i, 60)]), None, None, None) for i in range(60)]
    want = {(i, 1, 60, 140, 60, 140, 80) for i in range(2, 60) if i % 4}
    results = []
    for share in (10, 10_000_000):
        monkeypatch.setattr(common, "HOT_SHARE", share)
        got = passages.repeated_passages(data.frame(spark, rows)).collect()
        results.append({(r.doc_id, r.ref_doc_id, r.start_word, r.end_word, r.ref_start_word, r.ref_end_word, r.agreeing) for r in got})
    # Seeds across the passage's end may have further references, which share the passage too.
    assert results[0] == results[1] and want <= results[0]
    assert {r[2:4] for r in results[0]} == {(60, 140)}


def plain_passages(a: list[str], b: list[str]) -> bool:
    """Whether two texts share a stretch of 50 words with 0.75 of them at the same place, by brute force."""
    for shift in range(-len(a) + 50, len(b) - 49):
        i = max(0, -shift)
        n = min(len(a) - i, len(b) - i - shift)
        same = np.cumsum([0, *(a[i + k] == b[i + shift + k] for k in range(n))])
        if len(same) > 50 and (same[50:] - same[:-50]).max() >= 38:
            return True
    return False


def test_passages_against_brute_force(spark):
    """All pairs of texts with passages at a similarity of 0.90 and more: no false pair, and most of the pairs connected."""
    rng = random.Random(17)
    texts = [data.prose(6000 + i, rng.randrange(70, 120)) for i in range(36)]
    for k in range(9):
        passage = data.prose(6500 + k, 60)
        for d in (4 * k, 4 * k + 1):
            copy = list(passage)
            for at in rng.sample(range(60), 6 if k % 3 == 0 else 2 if k % 3 == 1 else 0):
                copy[at] = "edited" + str(at)
            texts[d][30:30] = copy if d % 4 else passage
    want = {(b, a) for a in range(36) for b in range(a + 1, 36) if plain_passages(texts[a], texts[b])}
    got = {(r.doc_id, r.ref_doc_id) for r in passages.repeated_passages(data.frame(spark, [(i, " ".join(t), None, None, None) for i, t in enumerate(texts)])).collect()}
    assert got <= want and len(want) == 9 and len(got) >= 8


def test_passages_with_many_edits(spark):
    """Pairs of texts with a passage of 60 words of which 0.90, 0.85 and 0.80 agree; the two of a pair have nothing else in common."""
    rng, rows, found = random.Random(23), [], {}
    for i in range(300):
        passage = data.prose(20_000 + i, 60)
        copy = list(passage)
        for at in rng.sample(range(60), (6, 9, 12)[i % 3]):
            copy[at] = f"edited{i}x{at}"
        for k, words in enumerate((passage, copy)):
            around = [data.prose(30_000 + 4 * i + 2 * k + j, rng.randrange(20, 90)) for j in range(2)]
            rows.append((2 * i + k, " ".join([*around[0], *words, *around[1]]), None, None, None))
    for r in passages.repeated_passages(data.frame(spark, rows)).collect():
        if r.doc_id == r.ref_doc_id + 1 and r.ref_doc_id % 2 == 0:
            found.setdefault(r.ref_doc_id // 2 % 3, set()).add(r.ref_doc_id)
    shares = [len(found[k]) / 100 for k in range(3)]
    assert shares[0] >= 0.96 and shares[1] >= 0.8 and shares[2] >= 0.57, shares


@pytest.mark.parametrize("cuts", [(30,), (20, 40), (25, 30, 35)], ids=str)
def test_passages_whose_parts_have_earlier_owners(spark, cuts):
    """Documents 10 and 20 share 60 words; smaller documents have its parts, one has what lies around a cut."""
    shared, rows = data.prose(77, 60), []
    ends = [0, *cuts, 60]
    parts = [shared[a:b] for a, b in zip(ends, ends[1:])] + [shared[cuts[0] - 12 : cuts[0] + 12]]
    for i, words in enumerate([*parts, *[shared] * 2]):
        doc = i + 1 if i < len(parts) else 10 * (i - len(parts) + 1)
        rows.append((doc, " ".join([*data.prose(500 + i, 80), *words, *data.prose(600 + i, 80)]), None, None, None))
    got = passages.repeated_passages(data.frame(spark, rows)).collect()
    assert [(r.doc_id, r.ref_doc_id, r.start_word, r.end_word) for r in got] == [(20, 10, 80, 140)]


def test_passages_of_awkward_rows(spark):
    got = {(r.doc_id, r.ref_doc_id) for r in passages.repeated_passages(data.frame(spark)).collect()}
    assert {(5, 2), (9, 2), (7, 2), (8, 2), (14, 2)} <= got
    assert not {d for p in got for d in p} & {None, 1, 3, 4, 6, 10, 11, 12, 13, 15}
    assert passages.repeated_passages(data.empty(spark)).count() == 0


def test_pipeline_stages(spark, tmp_path):
    rows = [(1000 + i, t, lang, f"s{i % 3}", 1) for i, (_, t, lang, _, _) in enumerate(data.corpus(40))]
    docs = spark.createDataFrame([*data.awkward(), *rows], data.SCHEMA)
    came = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        path = str(tmp_path / name.replace(" ", "-"))
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept = docs.collect()
        if name == "language ID":
            assert {r.doc_id for r in came} - {r.doc_id for r in kept} == {1, 3, 4, 12}
        elif name == "exact dedup":
            texts = [" ".join((r.text or "").split()) for r in kept]
            assert len(texts) == len(set(texts)) == len({" ".join((r.text or "").split()) for r in came})
        elif name == "n-gram Jaccard join":
            assert {r.doc_id for r in came} - {r.doc_id for r in kept} >= {7, 8}
        elif name == "mixing":
            assert docs.columns == corpus_pipeline.COLUMNS
            assert set(map(tuple, kept)) <= set(map(tuple, came))
        else:
            assert len(kept) == len(came) and all(r.n_tokens > 0 for r in kept)
        came = kept


def test_pipeline_judges_each_text_once(spark, capsys):
    judged = corpus_pipeline.identify_language(spark, data.frame(spark), "")
    capsys.readouterr()
    judged.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython") == 1


def test_pipeline_on_an_empty_table(spark, tmp_path):
    docs = data.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0


def test_pipeline_query(spark, sf_dir):
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert got.count() > 0
