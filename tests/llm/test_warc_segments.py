import base64
import gzip
import hashlib
import random

import pytest

from claimlens.llm import warc_segments as warc

SCHEMA = "page_id bigint, url string, html string, row int, page string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def got(found):
    return sorted(map(tuple, found.collect()), key=repr)


def expected(rows, least=0):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out, seen = [], set()
    for i, _, html in rows:
        raw = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        origin = first.get(html or "")
        if len(raw) < least or (i == origin and raw not in seen):
            seen.add(raw)
            out.append((i, len(raw), digest, "response", None))
        else:
            out.append((i, len(raw), digest, "revisit", origin))
    return sorted(out, key=repr)


ROWS = [
    (1, "http://a.example/x", "<p>same</p>"),
    (5, "http://a.example/y", "<p>same</p>"),
    (0, "http://b.example/", "<p>same</p>"),
    (2, None, None),
    (3, "http://c.example/\r\nX-Page: 9", ""),
    (4, "", "line\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n0\r\n\r\n"),
    (6, "http://d.example/", "é中\U0001f600\x00" * 9000),
    (7, "http://d.example/", "a" * 100_000),
    (8, "http://e.example/", "x" * 16_384),
    (8, "http://e.example/", "x" * 16_384),
]


@pytest.mark.parametrize("sizes", [{}, {"segment_bytes": 50, "file_records": 3}])
def test_round_trip(spark, sizes):
    rows = [(i, u, h if h is None or sizes == {} else h[:900]) for i, u, h in ROWS]
    assert got(warc.archived(frame(spark, rows), **sizes)) == expected(rows)


def test_short_payloads_are_responses(spark):
    assert got(warc.archived(frame(spark, ROWS[:5]), revisit_bytes=100)) == expected(ROWS[:5], 100)


def test_null_page_and_empty_table(spark):
    rows = [(None, "http://a.example/", "p"), (3, None, "p")]
    assert got(warc.archived(frame(spark, rows))) == expected(rows)
    assert got(warc.archived(frame(spark, []))) == []


def test_framing():
    rng = random.Random(1)
    for n in (0, 1, 9, 500):
        text = "".join(rng.choice("a\r\né0;") for _ in range(n))
        assert warc.dechunked(warc.chunked(text, 7).encode()) == text.encode()
        parts = warc.segments(text, 5)
        assert "".join(parts) == text and all(len(p.encode()) <= 5 for p in parts)
    assert warc.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError, match="not closed"):
        warc.dechunked(b"2\r\nabc\r\n0\r\n\r\n")


def test_lost_segment_is_an_error(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write(frame(spark, [(1, "u", "a" * 400)]), path, segment_bytes=100)
    records = warc.read_records(spark, path)
    assert records.where("type = 'continuation'").count() >= 3
    assert warc.reassemble(records).count() == 1
    for gone in (2, 4):
        with pytest.raises(Exception, match="missing or repeated|do not add up|not closed|not found|invalid"):
            warc.reassemble(records.where(f"segment <> {gone}")).collect()
    last = records.agg({"segment": "max"}).first()[0]
    with pytest.raises(Exception, match="do not add up"):
        warc.reassemble(records.where(f"segment <> {last}")).collect()


def test_archives_are_read_in_pieces(spark, tmp_path, monkeypatch):
    """No piece, and no batch of records, grows with the file."""
    blocks = [f"{i}\r\n\r\n" * 50 for i in range(200)]
    plain = "".join(warc.record({"WARC-Type": "response", "WARC-Record-ID": f"<{i}>"}, b) + "\r\n\r\n" for i, b in enumerate(blocks)).encode()
    half = plain.index(b"WARC/1.1", len(plain) // 2)
    monkeypatch.setattr(warc, "PIECE_BYTES", 1000)
    for file in (plain, gzip.compress(plain), gzip.compress(plain[:half]) + gzip.compress(plain[half:])):
        pieces = list(warc.expanded(file))
        assert max(map(len, pieces)) <= 1000 and b"".join(pieces) == plain
        assert [r["block"].decode() for r in warc.parsed(iter(pieces))] == blocks
        with pytest.raises(ValueError, match="cut off|not closed|do not end"):
            list(warc.parsed(warc.expanded(file[:-20])))
    assert list(warc.parsed(warc.expanded(b""))) == []
