"""WARC archives: a writer with revisit records, and a reader that salvages what damage leaves.

**Writing.** :func:`write_warc` makes one WARC/1.1 record per page. Of pages with equal payloads (the
SHA-1 of the UTF-8 html) of at least ``min_revisit`` bytes the one with the smallest page_id becomes the
``response``; the others become ``revisit`` records (profile identical-payload-digest, HTTP header only)
that refer to it. The first page of each digest comes from one aggregate with a map-side step. A digest with
more than one page in ``HOT_SHARE`` is joined by a broadcast of such digests, of which there are fewer than
``HOT_SHARE``; the others by an ordinary join, so no task gets all copies of a page.

An archive is a byte string of about ``ARCHIVE_BYTES``: a ``warcinfo`` record and page records, each a gzip
member of its own (``gz=False``: plain records). Spark's text writer stores each as one file, so tasks commit
through Spark and any store Spark writes to will do. That writer ends every file with a line separator:
here the empty gzip member, or the blank lines that end a plain record.

**Reading.** :func:`read_warc` reads the files as they are, one row per record or gap. At each place the
reader expects a gzip member or a version line, and checks the gzip CRC, the header, the lengths, the record
end and both digests. After a failed check:

* if header, length and record end still agree (only contents are damaged), reading goes on behind the record,
  so a whole record quoted inside a damaged payload is not taken for one;
* else the next place that holds a gzip magic or a version line *and* a whole valid record is searched;
* the bytes between are one gap (offset, end, reason), in the rows with ``reason`` set (:func:`quarantined`).

Defined results: null html is an empty payload; null page_ids come after all others and stay null; rows with
equal ids and payloads are records of their own, one of them the response; a null url leaves out
WARC-Target-URI; extra columns are ignored; an empty table gives an empty archive folder and no rows. A
record is held in memory whole, a few times its size.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import materialise, numbered, scratch

ARCHIVE_BYTES = 8_000_000
HOT_SHARE = 1000
#: Pages carry no crawl time, so records get this one.
DATE = "2000-01-01T00:00:00Z"
MAGIC, VERSION = b"\x1f\x8b\x08", b"WARC/1."
END = b"\r\n\r\n"
MAX_HEADER = 1 << 16
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# --- records ------------------------------------------------------------------------------------

def record_id(page_id: int | None, rid: int) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}:{rid}>"


def page_of(record: str | None) -> int | None:
    """The page_id in a record id of this writer."""
    found = re.fullmatch(r"<urn:page:(-?\d+):-?\d+>", record or "")
    return int(found[1]) if found else None


def make_record(kind: str, name: str, block: bytes, fields: list[tuple[str, str | None]]) -> bytes:
    """One record without the blank lines that end it."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", DATE), *fields,
            ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def page_record(page_id: int | None, rid: int, url: str | None, payload: bytes, digest: str,
                refers_to: tuple[int | None, int] | None) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    uri = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    fields = [("WARC-Target-URI", uri), ("WARC-Payload-Digest", f"sha1:{digest}"),
              ("Content-Type", "application/http; msgtype=response")]
    if refers_to is None:
        return make_record("response", record_id(page_id, rid), http + payload, fields)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(*refers_to))]
    return make_record("revisit", record_id(page_id, rid), http, fields)


INFO = make_record("warcinfo", "<urn:warcinfo:forecourt>", b"software: forecourt\r\nformat: WARC File Format 1.1\r\n",
                   [("Content-Type", "application/warc-fields")])


# --- writing ------------------------------------------------------------------------------------

def with_first(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """rid, page_id, url, payload, sha1 (hex), first_rid, first_page: the page that a revisit refers to
    (null for responses)."""
    rows = numbered(pages.select(F.col("page_id").cast("long").alias("doc_id"), "url",
                                 F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload")))
    rows = rows.select("rid", F.col("doc_id").alias("page_id"), "url", "payload", F.sha1("payload").alias("sha1"))
    groups = materialise(rows.where(F.octet_length("payload") >= min_revisit).groupBy("sha1").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("rid", "page_id")).alias("first")), "payloads")
    total = groups.agg(F.sum("n")).first()[0] or 0
    copied, hot = groups.where("n > 1"), F.col("n") * HOT_SHARE > total
    few = copied.where(hot).select("sha1", F.col("first").alias("hot_first"))  # fewer than HOT_SHARE rows
    rest = copied.where(~hot).select(F.col("sha1").alias("rest_sha1"), F.col("first").alias("rest_first"))
    rows = rows.join(F.broadcast(few), "sha1", "left")
    # what is found already is dealt by its own number and matches nothing
    key = F.when(F.col("hot_first").isNull(), F.col("sha1")).otherwise(F.col("rid").cast("string"))
    rows = rows.join(rest, key == F.col("rest_sha1"), "left")
    first = F.coalesce("hot_first", "rest_first")
    first = F.when((first["rid"] != F.col("rid")) & (F.octet_length("payload") >= min_revisit), first)
    return rows.select("rid", "page_id", "url", "payload", "sha1", first["rid"].alias("first_rid"), first["page_id"].alias("first_page"))


def write_warc(pages: DataFrame, path: str, *, min_revisit: int = 0, gz: bool = True,
               archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write ``pages`` (page_id, url, html) as archives below ``path``."""
    close = (lambda record: _gzip(record + END)) if gz else (lambda record: record + END)

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            data = close(INFO) + b"".join(held)
            # Spark's line separator ends the last plain record
            return pa.RecordBatch.from_arrays([pa.array([data if gz else data[:-len(END)]], pa.binary())], names=["archive"])

        for b in batches:
            for i in range(b.num_rows):
                rid, page_id, url, payload, sha1, first_rid, first_page = (c[i].as_py() for c in b.columns)
                refers = None if first_rid is None else (first_page, first_rid)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                record = close(page_record(page_id, rid, url, payload, digest, refers))
                if held and size + len(record) > archive_bytes:
                    yield flush()
                    held, size = [], 0
                held.append(record)
                size += len(record)
        if held:
            yield flush()

    (with_first(pages, min_revisit).mapInArrow(archives, "archive binary")
     .select(F.col("archive").cast("string")).write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
     .option("lineSep", (_gzip(b"") if gz else END).decode("latin-1")).text(path))


# --- reading ------------------------------------------------------------------------------------

class Found(NamedTuple):
    """A record at [offset, end) of an archive, or with ``reason`` a gap."""
    offset: int
    end: int
    reason: str | None = None
    fields: dict[str, str] | None = None
    block: bytes = b""


class Damaged(Exception):
    """A failed check. ``end``: where the record ends, if header, length and record end still agree."""

    def __init__(self, reason: str, end: int | None = None):
        super().__init__(reason)
        self.reason, self.end = reason, end


def plain_record(data: bytes, at: int) -> Found:
    """The record that begins at ``at``; raises :class:`Damaged`."""
    if not data.startswith(VERSION, at):
        raise Damaged("no version line")
    stop = data.find(END, at, at + MAX_HEADER)
    if stop < 0:
        raise Damaged("no header end")
    lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("bad header line")
        fields[name.strip().lower()] = value.strip()
    if not re.fullmatch(r"WARC/1\.\d+", lines[0]) or "warc-type" not in fields or "warc-record-id" not in fields:
        raise Damaged("bad header")
    if not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")):
        raise Damaged("bad length")
    begin = stop + len(END)
    end = begin + int(fields["content-length"])
    if end > len(data):
        raise Damaged("truncated block")
    if data[end:end + len(END)] != END:
        raise Damaged("no record end")
    block, behind = data[begin:end], end + len(END)
    sound = behind if behind == len(data) or data.startswith((VERSION, MAGIC), behind) else None
    if not _agrees(fields.get("warc-block-digest"), block):
        raise Damaged("block digest", sound)
    if fields["warc-type"] == "response" and not _agrees(fields.get("warc-payload-digest"), payload_of(fields, block)):
        raise Damaged("payload digest", sound)
    return Found(at, behind, None, fields, block)


def _agrees(digest: str | None, data: bytes) -> bool:
    """Digests of other kinds than sha1 are not checked."""
    kind, _, value = (digest or "").partition(":")
    return kind.lower() != "sha1" or value.upper() == base32_sha1(data)


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """The block without its HTTP header."""
    if not fields.get("content-type", "").lower().startswith("application/http"):
        return block
    return block.partition(END)[2]


def gzip_member(data: bytes, at: int, step: int = 1 << 14) -> tuple[bytes, int]:
    """(contents, end) of the member that begins at ``at``, its CRC checked."""
    unpack, view, out, pos = zlib.decompressobj(31), memoryview(data), [], at
    try:
        while not unpack.eof and pos < len(data):
            out.append(unpack.decompress(view[pos:pos + step]))
            pos += step
    except zlib.error:
        raise Damaged("bad gzip member") from None
    if not unpack.eof:
        raise Damaged("truncated gzip member")
    return b"".join(out), min(pos, len(data)) - len(unpack.unused_data)


def records_at(data: bytes, at: int) -> tuple[list[Found], int]:
    """The records of the member or the plain record at ``at``, and where it ends."""
    if not data.startswith(MAGIC, at):
        found = plain_record(data, at)
        return [found], found.end
    inner, end = gzip_member(data, at)
    found = []
    for f in salvage(inner, (VERSION,)):
        if f.reason is not None and len(inner) == f.end - f.offset:
            raise Damaged(f.reason, end)
        found.append(f._replace(offset=at, end=end))
    return found, end


def salvage(data: bytes, marks: tuple[bytes, ...] = (MAGIC, VERSION)) -> Iterator[Found]:
    """All valid records of an archive in order, and the gaps between them. Records begin with one of ``marks``."""
    at, size = 0, len(data)
    while at < size:
        try:
            found, end = records_at(data, at)
        except Damaged as problem:
            end = problem.end or next_valid(data, at + 1, marks)
            yield Found(at, end, problem.reason)
        else:
            yield from found
        at = end


def next_valid(data: bytes, at: int, marks: tuple[bytes, ...]) -> int:
    """The next place from ``at`` on with one of ``marks`` and a valid record; else the end."""
    places = {mark: data.find(mark, at) for mark in marks}
    while any(p >= 0 for p in places.values()):
        mark = min((m for m in places if places[m] >= 0), key=places.__getitem__)
        place = places[mark]
        try:
            found, _ = records_at(data, place)
            if any(f.reason is None for f in found):
                return place
        except Damaged:
            pass
        places[mark] = data.find(mark, place + 1)
    return len(data)


READ = ("archive string, offset long, end long, reason string, record_type string, page_id long, url string, "
        "payload_bytes long, payload_digest string, refers_to long")


def read_warc(spark: SparkSession, path: str, *, payload: bool = False) -> DataFrame:
    """One row per record of the archives below ``path`` (with ``payload``, its bytes too) and, with ``reason``
    set, one per gap. Payload length and digest are those of the payload itself for responses and those that
    the record states for revisits."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = [c.split()[0] for c in READ.split(", ")]

    def row(archive: str, f: Found) -> tuple:
        if f.reason is not None:
            return (archive, f.offset, f.end, f.reason, *(None,) * 7)
        kind, fields = f.fields["warc-type"], f.fields
        body = payload_of(fields, f.block)
        if kind == "revisit":
            stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)\r?$", f.block)
            digest = fields.get("warc-payload-digest", "").partition(":")[2] or None
            return (archive, f.offset, f.end, None, kind, page_of(fields["warc-record-id"]), fields.get("warc-target-uri"),
                    int(stated[1]) if stated else None, digest, page_of(fields.get("warc-refers-to")), None)
        return (archive, f.offset, f.end, None, kind, page_of(fields["warc-record-id"]), fields.get("warc-target-uri"),
                len(body), base32_sha1(body), None, body)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(),
                 pa.string(), pa.int64()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            if payload:
                return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[-1], pa.binary())], names=[*names, "payload"])
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for b in batches:
            for i in range(b.num_rows):
                archive, rows, size = b.column(0)[i].as_py(), [], 0
                for f in salvage(b.column(1)[i].as_py()):
                    rows.append(row(archive, f) if payload else (*row(archive, f)[:-1], None))
                    size += len(f.block) if payload else 0
                    if size > ARCHIVE_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    return files.mapInArrow(parse, READ + (", payload binary" if payload else ""))


def pages_of(rows: DataFrame) -> DataFrame:
    """The page records among the rows of :func:`read_warc`."""
    return rows.where("reason IS NULL AND record_type IN ('response', 'revisit')")


def quarantined(rows: DataFrame) -> DataFrame:
    """archive, offset, end, reason: the byte ranges that no valid record holds."""
    return rows.where("reason IS NOT NULL").select("archive", "offset", "end", "reason")


def warc_round_trip(pages: DataFrame, *, min_revisit: int = 0, gz: bool = True) -> DataFrame:
    """Write the archives to the shared scratch folder and read them back."""
    path = scratch(pages.sparkSession, "warc")
    write_warc(pages, path, min_revisit=min_revisit, gz=gz)
    return pages_of(read_warc(pages.sparkSession, path)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
