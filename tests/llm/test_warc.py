import gzip
import hashlib
import io
import zlib

import pytest

from corpusloom.llm import warc
from corpusloom.session import scratch_path

SCHEMA = "page_id long, url string, html string, record_type string"


@pytest.mark.parametrize("sent, hot", [(200_000, 1000), (0, 1000), (0, 2)])
def test_round_trip(spark, monkeypatch, sent, hot):
    monkeypatch.setattr(warc, "SENT_DIGESTS", sent)
    monkeypatch.setattr(warc, "HOT_ROWS", hot)
    long = "é<p>" * 40
    rows = [(5, "http://a", long, "x"), (3, None, long, "x"), (9, "http://b\r\nEvil: 1", long, None),
            (1, "u", "short", "x"), (2, "u", "short", "x"), (4, "u", None, "x"), (6, "u", "", "x"),
            (7, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20, "x"), (8, "u", "z" * 3_000_000, "x"),
            (3, None, long, "x"), (None, "u", long, "x"), (None, "u", "n" * 200, "x")]
    got = warc.archive_round_trip(spark.createDataFrame(rows, SCHEMA)).collect()
    seen = sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type,
                   str(r.refers_to)) for r in got)
    want = []
    for i, _, h, _ in rows:
        body = (h or "").encode()
        same = [j for j, _, g, _ in rows if g == h and j is not None]
        revisit = len(body) >= 100 and bool(same) and i != min(same)
        want.append((str(i), len(body), hashlib.sha256(body).hexdigest(),
                     "revisit" if revisit else "response", str(min(same) if revisit else None)))
    assert seen == sorted(want)


def test_members_stand_alone_and_hold_the_payload(spark):
    rows = [(i, f"http://h/{i}", f"<p>{i}</p>" * (i + 1), None) for i in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = warc.write_warc(warc.warc_records(df, "page_id", "url", "html"),
                            scratch_path(spark, "w"), per_file=7)
    index = warc.normalise_warc(spark, whole, scratch_path(spark, "m"))
    for r in index.collect():
        with open(r.file.removeprefix("file://").removeprefix("file:"), "rb") as f:
            f.seek(r.offset)
            data = f.read(r.length)
        engine = zlib.decompressobj(31)
        record = engine.decompress(data)
        assert engine.eof and not engine.unused_data and record.startswith(b"WARC/1.1\r\n")
    got = {r.record_id: bytes(r.payload).decode() for r in warc.read_warc(index).collect()}
    assert got == {f"<urn:page:{i}>": h for i, _, h, _ in rows}


def test_inflate_takes_one_or_many_members():
    data = bytes(range(256)) * 9000
    assert b"".join(warc.inflate(io.BytesIO(gzip.compress(data)))) == data
    two = gzip.compress(data[:10]) + gzip.compress(data[10:])
    assert b"".join(warc.inflate(io.BytesIO(two))) == data
    assert max(map(len, warc.inflate(io.BytesIO(gzip.compress(b"0" * 50_000_000))))) <= warc.CHUNK


def test_broken_archive_raises():
    with pytest.raises(ValueError):
        list(warc.split_records(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"])))


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
