"""Legacy ARC archives to WARC: records by declared lengths, with identifiers, types, dates and digests made up for."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.common import bounded, join_spread, ship
from tabwright.session import materialize, scratch_path

# Payloads of fewer bytes are kept with every record.
LEAST_PAYLOAD = 1000
LEVEL = 6
# Longest line that may be a record's header, and bytes of records that go on at once.
LONGEST_LINE = 1 << 16
BATCH_BYTES = 8 << 20
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# An ARC header's fields by the names that a version block declares: (name here, pattern). Fixed values.
ARC_FIELDS = {
    b"URL": rb"(?P<uri>.*)",
    b"IP-address": rb"(?P<ip>\S+)",
    b"Archive-date": rb"(?P<date>\d+)",
    b"Content-type": rb"(?P<mime>.*?)",
    b"Result-code": rb"(?P<status>\d+|-)",
    b"Checksum": rb"(?P<checksum>\S+)",
    b"Location": rb"(?P<location>\S+)",
    b"Offset": rb"(?P<offset>\d+|-)",
    b"Filename": rb"(?P<filename>\S+)",
    b"Archive-length": rb"(?P<length>\d+)",
}
ARC_VERSIONS = {
    1: b"URL IP-address Archive-date Content-type Archive-length",
    2: b"URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}


def header_pattern(names: bytes) -> re.Pattern[bytes]:
    """Pattern of a header line whose fields have these names; an unknown field has no spaces."""
    return re.compile(b" ".join(ARC_FIELDS.get(n, rb"\S+") for n in names.split(b" ")) + rb"\Z", re.S)


@dataclass
class ArcRecord:
    """A record of an ARC archive: its header's fields and the bytes that the header declares."""

    archive: str
    version: int
    at: int
    uri: str
    ip: str
    date: str
    mime: str
    body: bytes
    flaw: str | None
    opens: bool

    @property
    def parts(self) -> tuple[bytes, bytes]:
        """Head and payload. Only what begins with an HTTP status line has a head."""
        if not self.body.startswith(b"HTTP/"):
            return b"", self.body
        end = re.search(rb"\r?\n\r?\n", self.body)
        return (self.body[: end.end()], self.body[end.end() :]) if end else (self.body, b"")


def opened(raw: bytes) -> io.BufferedReader | gzip.GzipFile:
    """A stream over plain bytes, or over the members of a compressed file as they are read."""
    return gzip.GzipFile(fileobj=io.BytesIO(raw)) if raw[:2] == b"\x1f\x8b" else io.BufferedReader(io.BytesIO(raw))


def arc_records(raw: bytes, name: str = "") -> Iterator[ArcRecord]:
    """Records of an ARC file, plain or compressed, of version 1 or 2.

    A version block says which fields the headers after it have, and another block further
    on starts the next archive. A record is as long as its header declares. If no line
    break follows it, or the file ends before, it is kept with a flaw, and reading goes on at the
    next line that is a header by the version's fields.
    """
    stream = opened(raw)
    first = [header_pattern(names) for _, names in sorted(ARC_VERSIONS.items(), reverse=True)]
    patterns, archive, version = first, name, 0
    while True:
        at = stream.tell()
        line = stream.readline(LONGEST_LINE)
        if not line:
            return
        header = line.rstrip(b"\r\n")
        if not header:
            continue
        opens = header.startswith(b"filedesc://")
        found = next(filter(None, (p.match(header) for p in (first if opens else patterns))), None)
        if not found:
            continue
        field = {k: v.decode("utf-8", "replace") for k, v in found.groupdict().items()}
        length = int(field["length"])
        body = stream.read(length)
        follows = stream.peek(1)[:1]
        flaw = "cut" if len(body) < length else "length" if follows not in (b"", b"\n", b"\r") else None
        if opens:
            archive = field["uri"].removeprefix("filedesc://")
            lines = body.split(b"\n")
            version = int(lines[0].split(b" ")[0]) if lines[0][:1].isdigit() else 1
            declared = lines[1].strip() if len(lines) > 1 else b""
            patterns = [header_pattern(declared)] if declared.endswith(b"Archive-length") else first
        yield ArcRecord(archive, version, at, field["uri"], field["ip"], field["date"], field["mime"], body, flaw, opens)


def warc_date(date: str) -> str | None:
    """``YYYY[MM[DD[hh[mm[ss]]]]]`` as a WARC date; more digits are fractions of a second. None if there is no such time."""
    whole = date[:14]
    whole += "00000101000000"[len(whole) :] if len(whole) >= 4 else ""
    try:
        stamp = datetime(int(whole[:4]), *(int(whole[i : i + 2]) for i in range(4, 14, 2)))
    except (ValueError, TypeError):
        return None
    return stamp.isoformat() + (f".{date[14:]}" if len(date) > 14 else "") + "Z"


def labelled(digest: bytes) -> str:
    return "sha1:" + base64.b32encode(digest).decode()


def warc_record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in [*headers, ("Content-Length", str(len(block)))] if v is not None]
    return "\r\n".join(["WARC/1.1", *lines, "", ""]).encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    """A gzip member that ends with a zero byte, without that byte.

    The text sink puts one separator after every row. With NUL as separator each row
    ends as a member does whose data has less than 16 MiB: its last four bytes are their number.
    After longer data an empty member follows.
    """
    pack = zlib.compressobj(level, zlib.DEFLATED, 31)
    packed = pack.compress(data) + pack.flush()
    if packed[-1]:
        empty = zlib.compressobj(level, zlib.DEFLATED, 31)
        packed += empty.compress(b"") + empty.flush()
    return packed[:-1]


def write_members(df: DataFrame, path: str, column: str = "member") -> None:
    """A file per task of concatenated members, through Spark's own commit."""
    df.select(F.col(column).cast("string").alias("value")).write.option("lineSep", "\0").text(path)


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of archive files; one is read by one task, compressed."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


@dataclass
class Converted:
    """What an ARC record becomes. The WARC record itself is made when it is asked for."""

    source: ArcRecord
    record_id: str
    kind: str
    date: str
    key: int | None
    head: bytes
    payload: bytes
    sha1: bytes
    info_id: str

    def record(self) -> bytes:
        r = self.source
        headers: list[tuple[str, str | None]] = [("WARC-Type", self.kind), ("WARC-Record-ID", self.record_id), ("WARC-Date", self.date)]
        if r.opens:
            block = f"format: WARC File Format 1.1\r\ndescription: from ARC version {r.version}\r\n".encode()
            return warc_record([*headers, ("WARC-Filename", r.archive), ("Content-Type", "application/warc-fields")], block)
        mime = "text/dns" if r.uri.startswith("dns:") else r.mime or "application/octet-stream"
        more = [
            ("WARC-Target-URI", r.uri),
            ("WARC-IP-Address", r.ip if r.ip not in ("-", "0.0.0.0") else None),
            ("WARC-Warcinfo-ID", self.info_id or None),
            ("WARC-Block-Digest", labelled(hashlib.sha1(r.body).digest() if self.head else self.sha1)),
            ("WARC-Payload-Digest", labelled(self.sha1)),
            ("WARC-Truncated", r.flaw and "unspecified"),
            ("Content-Type", "application/http; msgtype=response" if self.head else mime),
        ]
        return warc_record([*headers, *more], r.body)


def header_value(head: bytes, name: str) -> str | None:
    found = re.search(rb"(?im)^" + re.escape(name.encode()) + rb":[ \t]*([^\r\n]*)", head) if head else None
    return found.group(1).decode("utf-8", "replace").strip() if found else None


def whole_number(text: str | None) -> int | None:
    """A long, or null for anything else."""
    number = int(text) if text is not None and re.fullmatch(r"-?[0-9]{1,19}", text) else 1 << 63
    return number if -(1 << 63) <= number < 1 << 63 else None


def convert_record(r: ArcRecord, info: tuple[str, str | None], key_header: str) -> Converted:
    """The WARC equivalent of a record; ``info`` is the archive's identifier and its own date."""
    head, payload = (b"", b"") if r.opens else r.parts
    sha1 = hashlib.sha1(payload).digest()
    record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{r.archive}#{r.at} {r.uri} {r.date} {sha1.hex()}')}>"
    kind = "warcinfo" if r.opens else "response" if head else "resource"
    date = warc_date(r.date) or info[1] or "1970-01-01T00:00:00Z"
    return Converted(r, record_id, kind, date, whole_number(header_value(head, key_header)), head, payload, sha1, info[0])


def convert_file(raw: bytes, name: str, key_header: str) -> Iterator[Converted]:
    info: tuple[str, str | None] = ("", None)
    for r in arc_records(raw, name):
        made = convert_record(r, info, key_header)
        if r.opens:
            info = (made.record_id, warc_date(r.date))
        yield made


def in_batches(rows: Iterator[tuple], schema: str, size) -> Iterator[pd.DataFrame]:
    """Rows as frames of about ``BATCH_BYTES``, so that no more than that waits in a task."""
    columns = [part.split(" ") for part in schema.split(", ")]

    def frame(waiting: list[tuple]) -> pd.DataFrame:
        # Whole numbers with gaps would else become doubles.
        kinds = ("Int64" if kind == "long" else object for _, kind in columns)
        return pd.DataFrame({c: pd.Series(list(v), dtype=k) for (c, _), k, v in zip(columns, kinds, zip(*waiting))})

    waiting, bulk = [], 0
    for row in rows:
        waiting.append(row)
        bulk += size(row)
        if bulk >= BATCH_BYTES or len(waiting) >= 10_000:
            yield frame(waiting)
            waiting, bulk = [], 0
    if waiting:
        yield frame(waiting)


def each_file(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, bytes]]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            yield path, bytes(content)


INDEX = "record_id string, uri string, date string, key long, sha1 binary, sha256 binary, bytes long, head binary"


def index_payloads(files: DataFrame, key_header: str, least: int) -> DataFrame:
    """A narrow row per response whose payload has ``least`` bytes."""

    def rows(batches):
        for path, content in each_file(batches):
            for r in convert_file(content, path.rsplit("/", 1)[-1], key_header):
                if r.kind == "response" and len(r.payload) >= least:
                    yield r.record_id, r.source.uri, r.date, r.key, r.sha1, hashlib.sha256(r.payload).digest(), len(r.payload), r.head

    return files.mapInPandas(lambda batches: in_batches(rows(batches), INDEX, lambda r: 300 + len(r[-1])), INDEX)


def revisit_record(record_id, date, uri, sha1, head, to_id, to_uri, to_date) -> bytes:
    headers = [
        ("WARC-Type", "revisit"),
        ("WARC-Record-ID", record_id),
        ("WARC-Date", date),
        ("WARC-Target-URI", uri),
        ("WARC-Profile", REVISIT_PROFILE),
        ("WARC-Refers-To", to_id),
        ("WARC-Refers-To-Target-URI", to_uri),
        ("WARC-Refers-To-Date", to_date),
        ("WARC-Block-Digest", labelled(hashlib.sha1(head).digest())),
        ("WARC-Payload-Digest", labelled(sha1)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    return warc_record(headers, head)


def revisits(index: DataFrame) -> DataFrame:
    """(record_id, revisit): the compressed revisit record of every response but its group's last.

    Payloads are equal when length, SHA-1 and SHA-256 are. The group's response is the
    one with the largest key (null keys are smallest, ties go to the larger record id).
    Groups are aggregated with a partial result per task, and the join back spreads large ones.
    """
    same = ["sha256", "sha1", "bytes"]
    top = F.max(F.struct("key", "record_id", "uri", "date")).alias("to")
    groups = materialize(index.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), top).filter("n > 1"), "warc-groups")
    rows = join_spread(index, groups, same, "n").filter(F.col("record_id") != F.col("to.record_id"))

    @F.pandas_udf("binary")
    def build(rows: pd.DataFrame) -> pd.Series:
        return pd.Series([member(revisit_record(*r)) for r in rows.itertuples(index=False, name=None)], dtype=object)

    fields = ["record_id", "date", "uri", "sha1", "head", F.col("to.record_id").alias("to_id"), F.col("to.uri").alias("to_uri"), F.col("to.date").alias("to_date")]
    return rows.select("record_id", build(F.struct(*fields)).alias("revisit"))


def convert(spark: SparkSession, arc_path: str, warc_path: str, key_header: str = "X-Page-Id", least: int = LEAST_PAYLOAD) -> None:
    """Write the WARC equivalent of all ARC files under ``arc_path`` to ``warc_path``.

    A version block becomes a warcinfo record, a document with an HTTP head a response and
    any other one a resource. Identifiers are drawn from the archive's name, the record's
    place, address, date and digest, so another run gives the same ones. Dates are those of the ARC header, and
    where it holds none, the archive's. Block and payload digests are SHA-1 in base 32.

    Of responses with equal payloads of ``least`` bytes or more, the one with the largest
    number in the HTTP header ``key_header`` stays, and the others become revisit records without
    payload. Files are read twice, once for the narrow index of payloads and once to write.
    Records are compressed one by one, and their order within a file has no meaning (each names its warcinfo).
    """
    ship(spark)
    files = archives(spark, arc_path)
    index = materialize(index_payloads(files, key_header, least), "warc-index")
    again = materialize(revisits(index), "warc-revisits")

    def rows(batches):
        for path, content in each_file(batches):
            for r in convert_file(content, path.rsplit("/", 1)[-1], key_header):
                yield r.record_id, member(r.record())

    schema = "record_id string, member binary"
    whole = files.mapInPandas(lambda batches: in_batches(rows(batches), schema, lambda r: len(r[1])), schema)
    joined = whole.join(bounded(again, F.length("revisit") + F.lit(100)), "record_id", "left")
    write_members(joined.select(F.coalesce("revisit", "member").alias("member")), warc_path)


def warc_records(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of a WARC file's records, plain or compressed."""
    stream = opened(raw)
    while True:
        line = stream.readline(LONGEST_LINE)
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:80]!r}")
        headers: dict[str, str] = {}
        while (line := stream.readline(LONGEST_LINE)).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        length = int(headers["content-length"])
        block = stream.read(length)
        if len(block) < length:
            raise ValueError(f"record {headers.get('warc-record-id')} ends early")
        yield headers, block


def checked(headers: dict[str, str], name: str, data: bytes) -> str:
    """Hex SHA-1 of ``data``; raises unless it is the record's digest ``name``."""
    digest = hashlib.sha1(data).digest()
    if headers.get(name) != labelled(digest):
        raise ValueError(f"{name} of {headers.get('warc-record-id')} does not match its data")
    return digest.hex()


RECORDS = "record_id string, record_type string, uri string, date string, key long, payload_digest string, payload_bytes long, refers_to_id string, block binary"


def read_warc(spark: SparkSession, path: str, key_header: str = "X-Page-Id", blocks: bool = False) -> DataFrame:
    """A row per record of the WARC files under ``path``; blocks themselves only with ``blocks``.

    Digests of blocks, and of payloads where the record holds one, are computed anew and must
    match. A revisit has the digest that it states and no payload bytes of its own.
    """
    ship(spark)

    def rows(batches):
        for _, content in each_file(batches):
            for h, block in warc_records(content):
                kind, digest, size, key = h["warc-type"], None, None, None
                if kind != "warcinfo":
                    checked(h, "warc-block-digest", block)
                    http = h.get("content-type", "").startswith("application/http")
                    cut = re.search(rb"\r?\n\r?\n", block) if http else None
                    head, payload = (block[: cut.end()], block[cut.end() :]) if cut else (block, b"") if http else (b"", block)
                    key = whole_number(header_value(head, key_header))
                    if kind == "revisit":
                        digest = base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:")).hex()
                    else:
                        digest, size = checked(h, "warc-payload-digest", payload), len(payload)
                yield (
                    h["warc-record-id"], kind, h.get("warc-target-uri"), h["warc-date"], key, digest, size,
                    h.get("warc-refers-to"), block if blocks else None,
                )

    return archives(spark, path).mapInPandas(lambda batches: in_batches(rows(batches), RECORDS, lambda r: 500 + len(r[-1] or b"")), RECORDS)


def resolve(records: DataFrame) -> DataFrame:
    """Documents of read records, a revisit with the key and payload size of the response that it refers to.

    Columns: page_id (the record's key), payload_bytes, payload_digest, record_type and refers_to. The
    responses that are referred to are told by an aggregation of the revisits, and the join spreads those with many.
    """
    stored = materialize(records.drop("block").filter("record_type <> 'warcinfo'"), "warc-records")
    again = stored.filter("record_type = 'revisit'").drop("payload_bytes")
    wanted = again.groupBy("refers_to_id").agg(F.count(F.lit(1)).alias("n"))
    held = stored.filter("record_type <> 'revisit'")
    referred = materialize(
        held.select(F.col("record_id").alias("refers_to_id"), F.col("key").alias("refers_to"), "payload_bytes", F.col("payload_digest").alias("_digest"))
        .join(wanted, "refers_to_id")
        .dropDuplicates(["refers_to_id"]),
        "warc-referred",
    )
    found = join_spread(again, referred, ["refers_to_id"], "n").filter("payload_digest = _digest")
    columns = [F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type"]
    own = held.select(*columns, F.lit(None).cast("long").alias("refers_to"))
    return own.unionByName(found.select(*columns, "refers_to"))


def fetched(page: tuple) -> tuple[bytes, bytes, bytes]:
    """(address, date, HTTP response) of a page as a crawler would have stored it."""
    number, url, html = page
    address = re.sub(r"[\r\n]", lambda m: f"%{ord(m.group()):02X}", url or "about:blank").encode("utf-8", "replace")
    payload = (html or "").encode("utf-8", "surrogatepass")
    own = b"" if number is None else b"X-Page-Id: %d\r\n" % number
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n%s\r\n" % (len(payload), own)
    day = (datetime(2005, 1, 1) + timedelta(seconds=(number or 0) % 10**8)).strftime("%Y%m%d%H%M%S").encode()
    return address, day, head + payload


def write_arc(pages: DataFrame, path: str, archive_bytes: int = 64 << 20) -> None:
    """Stand-in input: the pages as ARC archives of both versions by turns, no shuffle.

    Every task writes one file; a new archive begins with its own version block after ``archive_bytes``.
    """
    from pyspark import TaskContext

    ship(pages.sparkSession)

    def rows(batches):
        task, number, bulk = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            numbers = [None if p is None else int(p) for p in batch["page_id"]]
            for page in zip(numbers, batch["url"], batch["html"]):
                version = 1 + (task + number) % 2
                name = b"pages-%05d-%05d.arc" % (task, number)
                if not bulk:
                    block = b"%d 0 stand-in\n%s\n\n" % (version, ARC_VERSIONS[version])
                    more = b"200 - - 0 %s " % name if version == 2 else b""
                    yield (member(b"filedesc://%s 0.0.0.0 20050101000000 text/plain %s%d\n%s\n" % (name, more, len(block), block)),)
                address, day, body = fetched(page)
                more = b"200 - - %d %s " % (bulk, name) if version == 2 else b""
                yield (member(b"%s 192.0.2.1 %s text/html %s%d\n%s\n" % (address, day, more, len(body), body)),)
                bulk += len(body)
                if bulk >= archive_bytes:
                    number, bulk = number + 1, 0

    # As text, a null among the ids leaves the others whole numbers.
    columns = [F.col("page_id").cast("long").cast("string").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")]
    made = pages.select(*columns).mapInPandas(lambda batches: in_batches(rows(batches), "member binary", lambda r: len(r[0])), "member binary")
    write_members(made, path)


def through_archives(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of pages that went through ARC and WARC files.

    Null html is an empty payload and a null url ``about:blank``. Null page ids stay null, are the
    smallest, and a revisit of such a page has a null ``refers_to``. Rows that repeat a page give a record
    each. Long pages are whole; other columns are not read; an empty table gives no rows.
    """
    spark = pages.sparkSession
    arcs, warcs = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arcs)
    convert(spark, arcs, warcs, least=least)
    return resolve(read_warc(spark, warcs))


SQL = r"""
with p as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest,
           max(page_id) over (partition by coalesce(html, '')) as last
    from pages)
select page_id, cast(payload_bytes as bigint) as payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id < last then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id < last then last end as refers_to
from p
"""
