"""Resampling, the filter audit and archives, against plain computations."""

import base64
import glob
import gzip
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from tabwright.llm import arc_to_warc as A
from tabwright.llm import filter_audit, radix, resampling
from tabwright.llm.common import join_spread
from tabwright.session import materialize, scratch_path
from tests.llm import data

# Resampling.


def runs(text):
    lowered = re.sub(r"[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return words, [*words, *(" ".join(p) for p in zip(words, words[1:]))]


def resampled(rows, targets, least_words=20, percent=25):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s = Counter(bucket(f) for r in rows for f in runs(r[1])[1])
    t = Counter(bucket(f) for x in targets for f in runs(x)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for r in rows:
        words, features = runs(r[1])
        gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in map(bucket, features)]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"7:{'null' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append((r[0], len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    able = sorted((o for o in out if o[4] >= least_words), key=lambda o: (-o[3], o[0] is None, o[0] or 0, o[1]))
    drawn = len(able) * percent // 100
    ranked = [(*o[:4], i + 1 if i < drawn else None) for i, o in enumerate(able)]
    return Counter(ranked + [(*o[:4], None) for o in out if o[4] < least_words])


@pytest.mark.parametrize("least_words, percent", [(20, 25), (1, 100)])
def test_resample(spark, least_words, percent):
    rows = [*data.awkward(), *((100 + r[0], *r[1:]) for r in data.corpus(40))]
    targets = [" ".join(data.prose(3, 200)), None, "Ünïcode ß 日本語 one two"]
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    got = resampling.resample(data.frame(spark, rows), target, least_words=least_words, percent=percent)
    assert Counter(map(tuple, got.collect())) == resampled(rows, targets, least_words, percent)


def test_resample_empty(spark):
    assert resampling.resample(data.empty(spark), data.frame(spark)).count() == 0
    rows = data.awkward()
    got = resampling.resample(data.frame(spark), data.empty(spark))
    assert Counter(map(tuple, got.collect())) == resampled(rows, [])


@pytest.mark.parametrize("grams", [1, 2, 3])
def test_feature_buckets_across_slices(monkeypatch, grams):
    rng = random.Random(1)
    text = "".join(rng.choice("aZ9é -.\n日") for _ in range(4000)) + "x" * 300
    words = runs(text)[0]
    expected = Counter(zlib.crc32(" ".join(words[i : i + k]).encode()) % 500 for k in range(1, grams + 1) for i in range(len(words) - k + 1))
    for size in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(resampling, "SLICE", size)
        assert Counter(int(b) for part in resampling.feature_buckets(text, 500, grams) for b in part) == expected


@pytest.mark.parametrize("block_bits, most", [(2, 3), (12, 13), (3, 5)])
def test_radix_ranks(spark, monkeypatch, block_bits, most):
    monkeypatch.setattr(radix, "BLOCK_BITS", block_bits)
    monkeypatch.setattr(radix, "STRETCH_BITS", 2)
    monkeypatch.setattr(radix.digits, "__defaults__", (most,))
    rng = random.Random(block_bits)
    rows = [(rng.choice([None, -5, 0, 3, 3, 3, 2**62, -(2**63)]), rng.choice([None, *range(-40, 40)]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(5)
    got = radix.radix_ranks(df, [("a", True), ("b", False), ("i", True)], "t").collect()
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or 0, -r[2])
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.rank)] == sorted(rows, key=key)
    assert sorted(r.rank for r in got) == list(range(1, 301))


def test_radix_ranks_of_equal_and_no_rows(spark):
    df = spark.createDataFrame([(7,)] * 9 + [(None,)] * 4, "a long")
    got = radix.radix_ranks(df, [("a", False)], "t").collect()
    assert sorted((r.rank, r.a) for r in got) == [(i + 1, 7) for i in range(9)] + [(i + 10, None) for i in range(4)]
    assert radix.radix_ranks(df.filter("a = 0"), [("a", False)], "t").count() == 0


# The filter audit.


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    ]


def audited(rows, labels):
    firsts = {}
    for r in rows:
        if r[0] is not None:
            firsts[r[1] or ""] = min(firsts.get(r[1] or "", r[0]), r[0])
    marks = defaultdict(lambda: [False, False])
    for doc_id, quality, toxic in labels:
        marks[doc_id][0] |= quality == 1
        marks[doc_id][1] |= toxic == 1
    parts = defaultdict(list)
    for r in rows:
        mark = marks[r[0]] if r[0] is not None else [False, False]
        parts[r[3] or ""].append(([*fails(r[1] or ""), r[0] is not None and r[0] > firsts[r[1] or ""]], *mark))
    out, shapley = [], Counter()
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for k, f in enumerate(order):
                i = "ABCDE".index(f)
                gone = [d for d in left if d[0][i]]
                left = [d for d in left if not d[0][i]]
                shapley[part, f] += len(gone)
                row = (part, "".join(order), k + 1, len(left), len(gone), sum(d[0][i] for d in docs) - len(gone))
                out.append((*row, sum(d[0][i] and sum(d[0]) == 1 for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone), f))
    return sorted((*o[:-1], shapley[o[0], o[-1]]) for o in out)


def test_filter_audit(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["Aa", "b", "C", "dd#", "e"] + [f"w{j}" for j in range(400)]) for _ in range(rng.choice([0, 5, 199, 200, 300]))) for _ in range(40)]
    texts += ["a b " * 150, "A" * 3 + " " + "x" * 200, "p|q"]
    many = [(200 + i, rng.choice(texts), "en", rng.choice(["a", "b", None, ""]), 1) for i in range(400)]
    rows = [*data.awkward(), *many, many[0], (None, texts[0], None, "a", 0)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 600, 2)] + [(2, 1, 0), (2, 0, 1), (None, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("mask", F.lit("x"))
    got = filter_audit.audit(filter_audit.failures(data.frame(spark, rows).withColumn("mask", F.lit("x")), marks))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(map(tuple, got.collect())) == audited(rows, labels)


def test_filter_audit_of_nothing(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.failures(data.empty(spark), labels)).count() == 0


@pytest.mark.parametrize("m", [1, 2, 3, 5, 6])
def test_shapley_weights(m):
    """For random values, the same as the mean marginal value over all orders."""
    rng = random.Random(m)
    value = [0] + [rng.randrange(1000) for _ in range((1 << m) - 1)]
    sums = [0] * m
    for order in permutations(range(m)):
        seen = 0
        for i in order:
            sums[i] += value[seen | 1 << i] - value[seen]
            seen |= 1 << i
    assert [sum(w * v for w, v in zip(row, value)) for row in filter_audit.shapley_weights(m)] == sums


# Archives.


def arc(version, docs, fields=None):
    names = fields or A.ARC_VERSIONS[version]
    block = b"%d 0 test\n%s\n\n" % (version, names)
    more = lambda: b"200 - - 0 f.arc " if version == 2 else b""
    out = b"filedesc://f%d.arc 0.0.0.0 20010203040506 text/plain %s%d\n%s\n" % (version, more(), len(block), block)
    for url, date, mime, body, length in docs:
        out += b"%s 192.0.2.9 %s %s %s%d\n%s\n" % (url, date, mime, more(), len(body) if length is None else length, body)
    return out


HTTP = b"HTTP/1.0 200 OK\r\nX-Page-Id: 5\r\n\r\n"
DOCS = [
    (b"http://a.example/with space", b"20020304050607", b"text/html; charset=x", HTTP + b"\n\nfiledesc:// body\n", None),
    (b"dns:a.example", b"2002", b"text/dns", b"\x00\xff\x01 binary", None),
    (b"ftp://a.example/f", b"20021399000000", b"image/gif", b"", None),
    (b"http://a.example/2", b"20020304050607123", b"text/html", b"no head\r\n\r\nat all", None),
]


@pytest.mark.parametrize("version", [1, 2])
@pytest.mark.parametrize("packed", [False, True])
def test_arc_records(version, packed):
    raw = arc(version, DOCS)
    raw = gzip.compress(raw[:200]) + gzip.compress(raw[200:]) if packed else raw
    opens, *got = A.arc_records(raw)
    assert (opens.opens, opens.archive, opens.version) == (True, f"f{version}.arc", version)
    assert [(r.uri.encode(), r.date.encode(), r.mime.encode(), r.body, None) for r in got] == DOCS
    assert not any(r.flaw or r.opens for r in got)
    made = list(A.convert_file(raw, "x", "X-Page-Id"))
    assert [m.kind for m in made] == ["warcinfo", "response", "resource", "resource", "resource"]
    assert [m.date for m in made] == ["2001-02-03T04:05:06Z", "2002-03-04T05:06:07Z", "2002-01-01T00:00:00Z", "2001-02-03T04:05:06Z", "2002-03-04T05:06:07.123Z"]
    assert [m.payload for m in made[1:]] == [b"\n\nfiledesc:// body\n", *(d[3] for d in DOCS[1:])]
    assert made[1].key == 5 and len({m.record_id for m in made}) == 5
    assert [m.record_id for m in made] == [m.record_id for m in A.convert_file(raw, "x", "X-Page-Id")]


def test_arc_layout_comes_from_the_version_block():
    names = b"URL IP-address Archive-date Content-type Extra Archive-length"
    raw = arc(1, [], names) + b"http://x 192.0.2.1 20020304050607 text/plain more 3\nabc\n" + arc(2, DOCS[:1])
    assert [(r.archive, r.uri, r.body[:3]) for r in A.arc_records(raw) if not r.opens] == [("f1.arc", "http://x", b"abc"), ("f2.arc", "http://a.example/with space", b"HTT")]


def test_arc_wrong_lengths():
    """A wrong length flaws its own record and reading goes on at the next header."""
    short = (b"http://s", b"20020304050607", b"text/plain", b"0123456789\nmore", 4)
    last = (b"http://l", b"20020304050607", b"text/plain", b"abc", 99)
    got = list(A.arc_records(arc(1, [short, DOCS[1], last])))[1:]
    assert [(r.uri, r.body, r.flaw) for r in got] == [("http://s", b"0123", "length"), ("dns:a.example", DOCS[1][3], None), ("http://l", b"abc\n", "cut")]
    assert b"WARC-Truncated: unspecified" in A.convert_record(got[0], ("", None), "X").record()
    assert list(A.arc_records(b"")) == [] and list(A.arc_records(b"\n\nnoise\n")) == []


def test_members():
    """Rows and their NUL separators are plain concatenated gzip, also beyond 16 MiB."""
    parts = [b"", b"abc", bytes(1 << 24), b"x" * (1 << 20)]
    packed = b"".join(A.member(p) + b"\0" for p in parts)
    assert gzip.decompress(packed) == b"".join(parts)


PAGES = "page_id long, url string, html string"


def page_rows():
    long, twin = "é" * 700 + " long", "t" * 1000
    rows = [(i, f"http://x/{i}", long) for i in range(50)]
    rows += [(100 + i, f"http://y/{i}", twin) for i in range(3)] + [(102, "http://y/again", twin), (200, "http://z", "t" * 999), (201, "http://z", "t" * 999)]
    rows += [(None, "http://n", long), (None, None, None), (300, "http://with space/ü\r\n", ""), (301, "http://e", "\x00\r\n\r\nWARC/1.1\r\n"), (2**60 + 1, "u", "v" * 2_000_000)]
    nameless = "n" * 1500
    return rows + [(None, "http://m/1", nameless), (None, "http://m/2", nameless), (400, "http://o", "o" * 1200), (400, "http://o", "o" * 1200)]


def test_through_archives(spark):
    df = spark.createDataFrame(page_rows(), PAGES).selectExpr("*", "'x' as key", "'x' as record_id").repartition(4)
    got = Counter(map(tuple, A.through_archives(df).collect()))
    expected = Counter()
    groups = defaultdict(list)
    for page_id, _, html in page_rows():
        payload = (html or "").encode()
        groups[payload].append(page_id)
    for payload, ids in groups.items():
        ids = sorted(ids, key=lambda i: (i is not None, i or 0))
        for place, page_id in enumerate(ids):
            again = len(payload) >= 1000 and place < len(ids) - 1
            expected[page_id, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if again else "response", ids[-1] if again else None] += 1
    assert got == expected


def test_through_archives_of_nothing(spark):
    assert A.through_archives(spark.createDataFrame([], PAGES)).count() == 0


def test_written_warc(spark):
    """Files are plain concatenated gzip members of WARC records, and a damaged payload is found out."""
    arcs, warcs = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    A.write_arc(spark.createDataFrame(page_rows(), PAGES).repartition(2), arcs, archive_bytes=20_000)
    assert {r.version for f in glob.glob(f"{arcs}/part*") for r in A.arc_records(open(f, "rb").read()) if r.opens} == {1, 2}
    A.convert(spark, arcs, warcs)
    whole = b"".join(gzip.decompress(open(f, "rb").read()) for f in sorted(glob.glob(f"{warcs}/part*")))
    records = list(A.warc_records(whole))
    kinds = Counter(h["warc-type"] for h, _ in records)
    assert kinds["response"] + kinds["revisit"] == len(page_rows()) and kinds["warcinfo"] > 2
    infos = {h["warc-record-id"] for h, _ in records if h["warc-type"] == "warcinfo"}
    for h, block in records:
        if h["warc-type"] == "response":
            assert h["warc-warcinfo-id"] in infos
            assert h["warc-block-digest"] == "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()
        if h["warc-type"] == "revisit":
            assert block.startswith(b"HTTP/1.1 200 OK\r\n") and block.endswith(b"\r\n\r\n")
    blocks = A.read_warc(spark, warcs, blocks=True).filter("record_type = 'response'").select("block").collect()
    assert len(blocks) == kinds["response"] and all(bytes(b.block).startswith(b"HTTP/1.1") for b in blocks)
    headers, block = next(x for x in records if x[0]["warc-type"] == "response")
    with pytest.raises(ValueError, match="does not match"):
        A.checked(headers, "warc-block-digest", block + b"!")


def test_join_spread(spark, monkeypatch):
    monkeypatch.setattr("tabwright.llm.common.HOT_SHARE", 5)
    rows = materialize(spark.createDataFrame([(i % 7 if i % 2 else 1, i) for i in range(200)], "k int, i int"), "t")
    table = materialize(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("k <> 3"), "t")
    got = join_spread(rows, table, ["k"], "n").select("k", "i").collect()
    assert Counter(map(tuple, got)) == Counter((r.k, r.i) for r in rows.collect() if r.k != 3)
