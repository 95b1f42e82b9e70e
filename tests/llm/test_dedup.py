import hashlib
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import components, exact_dedup, jaccard_join, passages, repeats
from tests.llm import data


def _normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def _exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[_normal(r[1])].append(r[0])
    out = []
    for r in rows:
        ids = groups[_normal(r[1])]
        keep = min([i for i in ids if i is not None], default=None)
        out.append((r[0], keep, len(ids), r[0] == keep, hashlib.sha256(_normal(r[1]).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("digest", [exact_dedup.md5_bytes, lambda c: F.length(c) % 3], ids=["md5", "colliding"])
def test_exact_dedup_compares_texts_within_equal_hashes(spark, digest):
    got = exact_dedup.exact_dedup(data.frame(spark), digest=digest)
    assert Counter(map(tuple, got.collect())) == _exact(data.awkward())


def test_keep_first_keeps_columns_and_one_row_per_text(spark):
    df = data.frame(spark)
    got = exact_dedup.keep_first(df)
    assert got.columns == df.columns
    assert Counter(_normal(r.text) for r in got.collect()) == Counter({_normal(r[1]) for r in data.awkward()})
    assert {r.doc_id for r in got.collect()} >= {1, 2, 6, 7, 8, 10, 13}


def _near(rows, width=5):
    sets = []
    for r in rows:
        w = data.lowered(r[1])
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                label[max(top(i), top(j))] = min(top(i), top(j))
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[top(i)].append(r[0])
    found = [(r[0], len(sets[i]), min([x for x in least[top(i)] if x is not None], default=None) if sets[i] else r[0]) for i, r in enumerate(rows)]
    return Counter(found)


@pytest.mark.parametrize("rows", [data.awkward(), data.corpus()], ids=["awkward", "corpus"])
def test_jaccard_join_finds_the_components(spark, rows):
    got = jaccard_join.near_duplicates(data.frame(spark, rows))
    assert Counter(map(tuple, got.collect())) == _near(rows)


def test_jaccard_join_links_through_chains(spark):
    """Neighbours of a long chain of edits are near, its ends are not."""
    text, rows = data.prose(8, 300), []
    for i in range(12):
        rows.append((100 - i, " ".join(text), None, None, None))
        text = [*text[:20 * i], *[f"new{i}x{j}" for j in range(6)], *text[20 * i + 6 :]]
    want = _near(rows)
    assert len({c for _, _, c in want}) == 1
    assert Counter(map(tuple, jaccard_join.near_duplicates(data.frame(spark, rows)).collect())) == want


def test_jaccard_join_links_copies_with_appended_text_in_a_half_similar_family(spark):
    """Copies just above the threshold, in a family whose members are not near but share most shingles with several others."""
    rng = np.random.default_rng(0)
    blocks, rows = [data.prose(100_000 + i, 10) for i in range(30)], []
    for i in range(60):
        mine = np.sort(rng.permutation(30)[:20])
        rows.append((i, " ".join(w for k in mine for w in blocks[k]), None, None, None))
    for i in range(30):
        more = data.prose(200_000 + i, int(196 * (0.28 + 0.04 * rng.random())))
        rows.append((1000 + i, " ".join([rows[i][1], *more]), None, None, None))
    want = _near(rows)
    assert len({c for _, _, c in want}) == 60
    assert Counter(map(tuple, jaccard_join.near_duplicates(data.frame(spark, rows)).collect())) == want


@pytest.mark.parametrize("block", [jaccard_join.REGION_BYTES, 20_000], ids=["whole", "blocks"])
def test_jaccard_join_compares_large_half_similar_families(spark, monkeypatch, block):
    """Several hundred texts that share about half of their shingles, among them near ones that no round of pivots meets."""
    rng = np.random.default_rng(7)
    blocks, rows = [data.prose(300_000 + i, 10) for i in range(40)], []
    for i in range(300):
        mine = np.sort(rng.permutation(40)[:26])
        rows.append((i, " ".join(w for k in mine for w in blocks[k]), None, None, None))
    for i in range(0, 300, 7):
        words = rows[i][1].split()
        at = int(rng.integers(0, 200))
        rows.append((1000 + i, " ".join([*words[:at], *data.prose(400_000 + i, 20), *words[at + 20 :]]), None, None, None))
    want = _near(rows)
    monkeypatch.setattr(jaccard_join.region_links, "__defaults__", (block,))
    assert Counter(map(tuple, jaccard_join.near_duplicates(data.frame(spark, rows)).collect())) == want


@pytest.mark.parametrize("block", [1 << 30, 1500], ids=["whole", "blocks"])
def test_regions_alone_find_all_links(spark, monkeypatch, block):
    rows = data.corpus(90)
    monkeypatch.setattr(jaccard_join, "ROUNDS", 0)
    monkeypatch.setattr(jaccard_join.region_links, "__defaults__", (block,))
    assert Counter(map(tuple, jaccard_join.near_duplicates(data.frame(spark, rows)).collect())) == _near(rows)


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components_read_fewer_edges_in_each_round(spark, monkeypatch, shape):
    rng, stored = np.random.default_rng(2), []
    edges = {"path": [(i, i + 1) for i in range(300)], "star": [(i, 1000) for i in range(300)], "random": rng.integers(0, 300, (200, 2)).tolist()}[shape]
    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in label:
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])

    def counted(df, name, plain=components.materialize):
        out = plain(df, name)
        if name == "component-edges":
            stored.append(out.count())
        return out

    monkeypatch.setattr(components, "materialize", counted)
    got = components.components(spark.createDataFrame(edges, "u long, v long"))
    assert {r.node: r.label for r in got.collect()} == label
    assert stored[-1] == 0 and sum(stored) < 2 * len(edges) and len(stored) <= 6


def test_bounds_on_shared_prefix_shingles(spark):
    rng = np.random.default_rng(1)
    rows = []
    for _ in range(600):
        n = int(rng.integers(1, 60))
        universe = rng.permutation(400)
        a = set(universe[:n].tolist())
        b = set(a)
        for x in list(b)[: int(rng.integers(0, n // 4 + 1))]:
            b.discard(x)
        b |= set(universe[n : n + int(rng.integers(0, n // 4 + 1))].tolist())
        if 100 * len(a & b) >= 75 * len(a | b):
            pa, pb = jaccard_join.prefix_size(len(a)), jaccard_join.prefix_size(len(b))
            rows.append((len(a), len(b), len(set(sorted(a)[:pa]) & set(sorted(b)[:pb])), len(a) - pa))
    df = spark.createDataFrame(rows, "n long, m long, shared long, unmet long")
    n, m = F.col("n"), F.col("m")
    bounds = [jaccard_join.pair_shared(n, m), jaccard_join.pair_shared(m, n), jaccard_join.least_shared(n), jaccard_join.least_shared(m)]
    assert len(rows) > 300
    assert df.filter(F.greatest(*bounds) > F.col("shared")).count() == 0
    assert df.filter(jaccard_join.unmet(n) != F.col("unmet")).count() == 0


def test_keep_representatives(spark):
    df = data.frame(spark)
    got = jaccard_join.keep_representatives(df)
    assert got.columns == df.columns
    ids = Counter(r.doc_id for r in got.collect())
    want = Counter(r[0] for r in data.awkward())
    for gone in (5, 7, 8, 9, 11):
        assert ids[gone] == 0
        del want[gone]
    assert ids == want


def _spans(rows, length):
    texts = [(r[1] or "").encode() for r in rows]
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for r, t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((r[0], len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
    return Counter(out)


@pytest.mark.parametrize("most", [20_000, 1], ids=["sorted", "counted"])
@pytest.mark.parametrize("length", [200, 30])
def test_repeats_are_removed_exactly(spark, length, most):
    rows = [*data.awkward(), *[(100 + r[0], *r[1:]) for r in data.corpus(30)]]
    rows += [(200, "a" * 205, "", "", 0), (201, "ab" * 300, "", "", 0), (202, ("x" + "y" * 99) * 3, "", "", 0)]
    got = repeats.remove_repeats(data.frame(spark, rows), length=length, most_pieces=most)
    assert Counter((*r[:5], bytes(r[5])) for r in got.collect()) == _spans(rows, length)


def test_pieces_of_copies_are_cut_once(spark):
    text = " ".join(data.prose(1, 200))
    rows = [(i, text, None, None, None) for i in range(300)] + [(300, text[:500] + "changed" + text[500:], None, None, None)]
    texts = data.frame(spark, rows).select(*repeats.text_key(F.col("text"))).coalesce(1)
    found = repeats.runs_table(texts, 200, 64).distinct()
    wanted = found.groupBy("th", "size").agg(F.collect_list(F.struct("mark", "piece", "start", "windows")).alias("places"))
    cut = repeats.pieces_table(texts, F.broadcast(wanted), 200)
    assert cut.count() == found.count()
    got = repeats.remove_repeats(data.frame(spark, rows), most_bytes=1)
    assert Counter((*r[:5], bytes(r[5])) for r in got.collect()) == _spans(rows, 200)


def test_transform_finds_the_repeated_windows():
    rng = np.random.default_rng(5)
    for _ in range(60):
        length = int(rng.integers(1, 12))
        pieces = [bytes(rng.choice(list(b"ab\x00\xff"), int(rng.integers(0, 40))).tolist()) for _ in range(int(rng.integers(1, 8)))]
        count = Counter(p[i : i + length] for p in pieces for i in range(len(p) - length + 1))
        for piece, found in zip(pieces, repeats.repeated_windows(pieces, length)):
            assert found.tolist() == [count[piece[i : i + length]] > 1 for i in range(len(piece) - length + 1)]


def test_words_leave_nothing_in_the_worker():
    texts = [b" ".join(b"word%d" % i for i in range(at, at + 1000)) for at in range(0, 40_000, 1000)]
    jaccard_join.shingles(texts[0])
    tracemalloc.start()
    for text in texts:
        jaccard_join.shingles(text)
        passages.words_of(text)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 500_000


def test_sorting_takes_a_bounded_multiple_of_the_bytes():
    rng = np.random.default_rng(3)
    base = rng.integers(97, 123, (200, 600), dtype=np.uint8)
    pieces = [base[i % 200, : 300 + i % 299].tobytes() + rng.integers(97, 123, 60, dtype=np.uint8).tobytes() for i in range(800)]
    tracemalloc.start()
    repeats.repeated_windows(pieces, 200)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 90 * sum(map(len, pieces))


def test_empty_tables(spark):
    none = data.empty(spark)
    assert exact_dedup.exact_dedup(none).count() == 0
    assert exact_dedup.keep_first(none).count() == 0
    assert jaccard_join.near_duplicates(none).count() == 0
    assert repeats.remove_repeats(none).count() == 0
