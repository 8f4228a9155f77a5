"""WARC: round trips, damaged archives, revisits."""

import gzip
import hashlib
import io
import uuid

import pytest

from quire.llm import warc
from quire.llm.common import shared_dir

SCHEMA = "page_id long, url string, html string, first long, digest string"


def rows():
    long = "<p>" + "x" * 3_000_000 + "</p>"
    page = "<html>" + "é" * 60 + "</html>"
    out = [(1, "http://a/ü?x=1 2\r\nEvil: 1", page, 5, "d"), (7, None, page, None, None), (7, "u", page, 1, "d"),
           (2, "", None, 0, ""), (3, "u", "", 0, ""), (4, "u", "short", 0, ""), (5, "u", "short", 0, ""),
           (6, "u", long, 0, ""), (8, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 9, 0, ""),
           (-3, "u", page + "!", 0, ""), (10, "u", "y" * 99, 0, ""), (11, "u", "y" * 99, 0, ""),
           (12, "u", "z" * 100, 0, ""), (13, "u", "z" * 100, 0, ""), (None, "u", "z" * 100, 0, "")]
    return out + [(1000 + i, "u", "common page " * 20, 0, "") for i in range(400)]


def want(data):
    least, out = {}, []
    raw = [(i, (h or "").encode()) for i, _, h, *_ in data]
    for i, p in raw:
        if len(p) >= 100 and i is not None:
            least[p] = min(i, least.get(p, i))
    for i, p in raw:
        to = least.get(p) if least.get(p) != i else None
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [2, 10**9])
def test_round_trip(spark, monkeypatch, limit):
    monkeypatch.setattr(warc, "hot_limit", lambda n: limit)
    data = rows()
    got = warc.round_trip(spark.createDataFrame(data, SCHEMA).repartition(4)).collect()
    assert sorted([(r.record_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got], key=repr) == want(data)
    texts = {i: (h or "").encode() for i, _, h, *_ in data}
    assert all(bytes(r.payload) == texts[r.record_id] for r in got if r.record_type == "response" and r.record_id is not None)


def test_archives_are_gzip_members_and_roll(spark, monkeypatch):
    df = spark.createDataFrame(rows(), SCHEMA)
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    manifest = warc.write_archives(warc.plan_records(df), folder).collect()
    assert sum(r.records for r in manifest) == len(rows())
    for r in manifest:
        path = r.path if r.path.startswith("/") else "/" + r.path
        with open(path, "rb") as f:
            data = f.read()
        assert len(data) == r.bytes and gzip.decompress(data).count(b"WARC-Record-ID") == r.records
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.round_trip(empty).collect() == []


def test_reader_is_incremental_and_finds_damage():
    digest = hashlib.sha256(b"abc").hexdigest()
    one = warc.record_bytes("response", 1, "u", b"abc", digest, 3, None)
    two = warc.record_bytes("revisit", 2, "u", b"", digest, 3, 1)

    class Slow(io.BytesIO):
        def read(self, n=-1):
            return super().read(min(n, 7))

    got = [warc.parsed(f, b) for f, b in warc.read_records(Slow(one + two))]
    assert [g[0] for g in got] == [1, 2] and got[0][3] == b"abc" and got[1][2:] == ("revisit", None, 3, digest, 1)
    wrong = warc.record_bytes("response", 1, "u", b"abd", digest, 3, None)
    with pytest.raises(warc.BadArchive):
        [warc.parsed(f, b) for f, b in warc.read_records(io.BytesIO(wrong))]
    with pytest.raises(warc.BadArchive):
        list(warc.read_records(io.BytesIO((one + two)[:-9])))
    plain = gzip.decompress(one)
    for bad in (plain.replace(b"Content-Length: ", b"Content-Length: 1", 1) if False else plain[:-4],
                plain.replace(b"abc", b"abx"), plain + b"more", b"HTTP/1.1\r\n\r\n"):
        with pytest.raises(warc.BadArchive):
            list(warc.read_records(io.BytesIO(gzip.compress(bad))))
    assert list(warc.read_records(io.BytesIO(b""))) == []
