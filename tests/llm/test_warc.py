import base64
import gzip
import hashlib
import random

import pytest
from oracle import compare, duck

from forecourt.llm import warc as W
from forecourt.llm.common import scratch
from forecourt.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"


def brute(rows, least=0):
    out = []
    known = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for i, (page_id, _, html) in enumerate(known):
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        first = next(k for k, r in enumerate(known) if (r[2] or "") == (html or ""))
        if first == i or len(body) < least:
            out.append((page_id, len(body), digest, "response", None))
        else:
            out.append((page_id, len(body), digest, "revisit", known[first][0]))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


ROWS = [(5, "http://a/ b\r\n", "<p>é</p>"), (2, None, "<p>é</p>"), (9, "http://c", None), (8, "u", ""), (7, "u", "x" * 200_000),
        (7, "u", "x" * 200_000), (None, "u", "<p>é</p>"), (None, "v", "only"), (1, "v", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n"),
        (-4, "v", "\x1f\x8b\x08 no gzip"), (3, "v", "\r\n\r\n"), (4, "v", "x")] + [(100 + i, "c", "copy") for i in range(40)]


@pytest.mark.parametrize("gz", [True, False])
@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, gz, least):
    pages = spark.createDataFrame(ROWS, PAGES).repartition(3)
    assert rows_of(W.warc_round_trip(pages, gz=gz, min_revisit=least)) == brute(ROWS, least)


def test_files_are_plain_gzip_members_and_hold_the_payloads(spark):
    pages = spark.createDataFrame([r for r in ROWS if r[0] is not None and r[0] != 7], PAGES).coalesce(1)
    path = scratch(spark, "test-warc")
    W.write_warc(pages, path, archive_bytes=1000)
    files = [r.content for r in spark.read.format("binaryFile").load(path).collect()]
    assert len(files) > 2 and all(gzip.decompress(bytes(f)).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") for f in files)
    rows = W.read_warc(spark, path, payload=True)
    got = {r.page_id: bytes(r.payload).decode() for r in rows.where("record_type = 'response'").collect()}
    assert got[-4] == "\x1f\x8b\x08 no gzip" and got[3] == "\r\n\r\n" and got[1].startswith("WARC/1.1")
    assert W.quarantined(rows).count() == 0 and rows.where("record_type = 'warcinfo'").count() == len(files)


def archive(n, gz, quoted=False):
    """(archive, [(offset, end)]) of n records."""
    data, places = b"", []
    for i in range(n):
        body = (f"page {i} " * (i % 7 + 1)).encode()
        if quoted:
            body += W.page_record(900, 900, "q", b"quoted", W.base32_sha1(b"quoted"), None) + W.END
        one = W.page_record(i, i, "u", body, W.base32_sha1(body), None) + W.END
        one = W._gzip(one) if gz else one
        places.append((len(data), len(data) + len(one)))
        data += one
    return data, places


def check(data):
    found = list(W.salvage(data))
    at = 0
    for f in found:  # records and gaps tile the archive
        assert f.offset == at and f.end > at
        at = f.end
    assert at == len(data)
    ids = [W.page_of(f.fields["warc-record-id"]) for f in found if f.reason is None]
    return ids, [f for f in found if f.reason is not None]


@pytest.mark.parametrize("gz", [True, False])
@pytest.mark.parametrize("seed", range(25))
def test_damage_costs_the_damaged_records_only(gz, seed):
    r = random.Random(seed)
    data, places = archive(12, gz)
    hit = sorted(r.sample(range(12), r.randint(1, 4)))
    broken = bytearray(data)
    for k in hit:
        lo, hi = places[k]
        # any byte of a gzip member but its time, flags and system bytes, which no checksum covers; of a plain one the head
        at = r.randrange(lo + 10, hi) if gz else r.choice([lo + 2, lo + r.randrange(10, 20), hi - 6 - r.randrange(3), hi - 1])
        broken[at] ^= 1 << r.randrange(8)
    ids, gaps = check(bytes(broken))
    assert set(ids) >= set(range(12)) - set(hit) and len(ids) == len(set(ids))
    assert all(any(places[k][0] <= g.offset and g.end <= places[last][1] for k in hit for last in hit) for g in gaps)
    assert gaps


@pytest.mark.parametrize("gz", [True, False])
def test_garbage_between_and_truncation(gz):
    data, places = archive(6, gz)
    lo = places[3][0]
    ids, gaps = check(data[:lo] + b"\x1f\x8b\x08WARC/1.1\r\ngarbage" + data[lo:])
    assert ids == list(range(6)) and [(g.offset, g.end) for g in gaps] == [(lo, lo + 20)]
    ids, gaps = check(data[:-9])
    assert ids == list(range(5)) and (gaps[0].offset, gaps[0].end) == (places[5][0], len(data) - 9)
    ids, gaps = check(data[5:])
    assert ids == list(range(1, 6)) and gaps[0].offset == 0
    assert check(b"") == ([], []) and check(b"nothing here")[0] == []


def test_a_record_quoted_in_a_damaged_payload_is_not_recovered():
    data, places = archive(4, False, quoted=True)
    broken = bytearray(data)
    broken[data.index(b"page 2") + 1] ^= 1  # only the contents: both digests fail, the lengths agree
    ids, gaps = check(bytes(broken))
    assert ids == [0, 1, 3] and [(g.offset, g.end, g.reason) for g in gaps] == [(*places[2], "block digest")]


def test_damaged_files_through_spark(spark):
    path, broken = scratch(spark, "test-whole"), scratch(spark, "test-broken")
    W.write_warc(spark.createDataFrame([(i, "u", f"page {i}") for i in range(50)], PAGES).coalesce(1), path, gz=False)
    (whole,) = [bytes(r.content) for r in spark.read.format("binaryFile").load(path).collect()]
    place = whole.index(b"page 17")
    cut = whole[:place] + b"X" + whole[place + 1:]
    spark.createDataFrame([(cut[:-4].decode(),)], "archive string").write.option("lineSep", "\r\n\r\n").text(broken)
    rows = W.read_warc(spark, broken)
    assert sorted(r.page_id for r in W.pages_of(rows).collect()) == [i for i in range(50) if i != 17]
    (gap,) = W.quarantined(rows).collect()
    assert gap.reason == "block digest" and gap.offset < place < gap.end


def test_empty_table_and_clashing_columns(spark):
    assert W.warc_round_trip(spark.createDataFrame([], PAGES)).count() == 0
    clash = spark.createDataFrame([(1, "u", "h", 3, "x"), (2, "u", "h", 3, "x")], PAGES + ", rid long, sha1 string")
    assert rows_of(W.warc_round_trip(clash)) == brute([(1, "u", "h"), (2, "u", "h")])


def test_query_equals_sql(spark):
    con = duck(SF)
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF}/pages.parquet')")
    same, why = compare(QUERIES["op13_warc"](spark, SF), con, ORACLE_SQL["op13_warc"])
    assert same, why
