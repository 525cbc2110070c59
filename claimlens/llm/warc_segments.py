"""WARC archives: writing segmented records, and reassembling payloads from what is read back.

A page is a ``response`` record (an HTTP message in chunked framing), cut into segments of bounded size
where it is long: the first in the record itself, the others in ``continuation`` records. Pages with a
payload that another page has already are ``revisit`` records, which refer to it.

Archives are written by Spark's text writer, a record a line, with the two line ends that close a WARC
record as its line end, and compressed by it. Segments keep records, and records a file keep files,
below a known size.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.llm.common import BATCH_ROWS, text_or_empty
from claimlens.session import scratch_path, stage

# Bytes of a record's block, records of a file: a file has 40 MB or so at most.
SEGMENT_BYTES = 16 << 10
FILE_RECORDS = 2000
CHUNK_CHARS = 4096
# Payloads of fewer bytes are always responses.
REVISIT_BYTES = 0
# What is expanded, and what is handed on, of an archive at a time.
PIECE_BYTES = 1 << 20

_END = "\r\n"
_BETWEEN = _END * 2
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2024-01-01T00:00:00Z"  # fixed value: the tables have no time of capture


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(headers: dict[str, str], block: str) -> str:
    """One WARC record without the line ends that close it."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block.encode())}"]
    return _END.join(lines) + _BETWEEN + block


def chunked(payload: str, chunk_chars: int = CHUNK_CHARS) -> str:
    """The payload in chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), chunk_chars):
        chunk = payload[i : i + chunk_chars]
        parts.append(f"{len(chunk.encode()):x}{_END}{chunk}{_END}")
    return "".join(parts) + "0" + _BETWEEN


def dechunked(framed: bytes) -> bytes:
    """The payload of a chunked message; chunk extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = framed.index(b"\r\n", at)
        size = int(framed[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        if framed[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is not closed where its size says")
        parts.append(framed[at : at + size])
        at += size + 2


def segments(block: str, most: int) -> list[str]:
    """The block cut into pieces of at most ``most`` bytes, between characters; one piece if it is empty."""
    raw, parts, at = block.encode(), [], 0
    while at < len(raw):
        end = min(len(raw), at + most)
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        parts.append(raw[at:end].decode())
        at = end
    return parts or [""]


def identifier(*what) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, ':'.join(map(str, what)))}>"


def http_head(payload_bytes: int) -> str:
    return f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}Transfer-Encoding: chunked{_BETWEEN}"


def records_of(row: dict, segment_bytes: int) -> list[str]:
    """All records of one page: row, page_id, url, html, first_row and first_page (of the response)."""
    payload = row["html"].encode()
    own = identifier("page", row["row"])
    head = http_head(len(payload))
    common = {
        "WARC-Record-ID": own,
        "WARC-Date": _DATE,
        "WARC-Target-URI": (row["url"] or "about:blank").replace("\r", "%0D").replace("\n", "%0A"),
        "WARC-Payload-Digest": f"sha1:{digest_of(payload)}",
        "X-Page": "" if row["page_id"] is None else str(row["page_id"]),
    }
    kind = {"Content-Type": "application/http; msgtype=response"}
    if row["first_row"] != row["row"]:
        refers = {"WARC-Refers-To": identifier("page", row["first_row"]), "WARC-Profile": _PROFILE}
        return [record({"WARC-Type": "revisit", **common, **refers, **kind}, head)]
    parts = segments(head + chunked(row["html"]), segment_bytes)
    total = sum(len(p.encode()) for p in parts)
    if len(parts) == 1:
        return [record({"WARC-Type": "response", **common, **kind}, parts[0])]
    made = [record({"WARC-Type": "response", **common, **kind, "WARC-Segment-Number": "1"}, parts[0])]
    for number, part in enumerate(parts[1:], 2):
        headers = {
            "WARC-Type": "continuation",
            "WARC-Record-ID": identifier("page", row["row"], number),
            "WARC-Date": _DATE,
            "WARC-Segment-Origin-ID": own,
            "WARC-Segment-Number": str(number),
        }
        if number == len(parts):
            headers["WARC-Segment-Total-Length"] = str(total)
        made.append(record(headers, part))
    return made


def write(
    pages: DataFrame,
    path: str,
    segment_bytes: int = SEGMENT_BYTES,
    file_records: int = FILE_RECORDS,
    revisit_bytes: int = REVISIT_BYTES,
) -> None:
    """Archives of page_id, url, html (null: empty) below a folder that all executors reach.

    Of the pages with equal payloads of at least ``revisit_bytes`` bytes the one with the smallest page_id
    (nulls last, repeated rows by place) is the response; the others revisit it. A row with a null page_id
    or url gets records as any other; rows may be repeated. Other columns are not read. A row is known
    by its place in ``pages``, which is read twice: it must be a table, or the result of a checkpoint.
    """
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), text_or_empty("html").alias("html"))
    rows = rows.withColumns(
        {
            "row": F.monotonically_increasing_id(),
            "digest": F.sha1(F.encode("html", "UTF-8")),
            "size": F.octet_length("html"),
        }
    )
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")).alias("first")
    firsts = rows.where(F.col("size") >= revisit_bytes).groupBy("digest", "size").agg(first)
    firsts = stage(firsts.select("digest", "size", F.col("first.row").alias("first_row")), "warc-firsts")
    linked = rows.join(firsts, ["digest", "size"], "left").select(
        "row", "page_id", "url", "html", F.coalesce("first_row", "row").alias("first_row")
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, size = [], 0
            for i in range(batch.num_rows):
                for r in records_of(batch.slice(i, 1).to_pylist()[0], segment_bytes):
                    made.append(r)
                    size += len(r)
                if size >= PIECE_BYTES:
                    yield pa.record_batch([pa.array(made, pa.string())], ["value"])
                    made, size = [], 0
            yield pa.record_batch([pa.array(made, pa.string())], ["value"])

    writer = linked.mapInArrow(encode, "value string").write.option("lineSep", _BETWEEN)
    writer.option("maxRecordsPerFile", file_records).option("compression", "gzip").text(path)


FIELDS = (
    "record_id string, type string, page string, digest string, refers_to string, origin string, "
    "segment int, total bigint, segmented boolean, block binary"
)


def expanded(file: bytes) -> Iterator[bytes]:
    """The content of a file that may be compressed, as one member or as many, in pieces of bounded size."""
    if file[:2] != b"\x1f\x8b":
        for at in range(0, len(file), PIECE_BYTES):
            yield file[at : at + PIECE_BYTES]
        return
    at = 0
    while file[at : at + 2] == b"\x1f\x8b":
        member = zlib.decompressobj(wbits=31)
        while not member.eof:
            some = file[at : at + PIECE_BYTES]
            if not some:
                raise ValueError("a compressed file is cut off")
            at += len(some)
            while some and not member.eof:
                piece = member.decompress(some, PIECE_BYTES)
                some = member.unconsumed_tail
                if piece:
                    yield piece
        at -= len(member.unused_data)


def parsed(archive: Iterable[bytes]) -> Iterator[dict]:
    """The records of an archive, given in pieces: found by their lengths, not by what their blocks hold. No more
    than a record and a piece are held at a time."""
    pieces, held = iter(archive), bytearray()

    def more() -> bool:
        piece = next(pieces, None)
        held.extend(piece or b"")
        return piece is not None

    while held or more():
        if not held:
            continue
        seen = 0
        while (end := held.find(_BETWEEN.encode(), seen)) < 0:
            seen = max(0, len(held) - 3)
            if not more():
                raise ValueError("a record's headers do not end")
        lines = held[:end].decode().split(_END)
        if not lines[0].startswith("WARC/"):
            raise ValueError("no record starts here")
        head = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines[1:])}
        at = end + 4
        close = at + int(head["content-length"])
        while len(held) < close + 4 and more():
            pass
        if held[close : close + 4] != _BETWEEN.encode():
            raise ValueError("a record is not closed where its length says")
        block = bytes(held[at:close])
        del held[: close + 4]
        total = head.get("warc-segment-total-length")
        yield {
            "record_id": head["warc-record-id"],
            "type": head["warc-type"],
            "page": head.get("x-page") or None,
            "digest": head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            "refers_to": head.get("warc-refers-to"),
            "origin": head.get("warc-segment-origin-id", head["warc-record-id"]),
            "segment": int(head.get("warc-segment-number", 1)),
            "total": None if total is None else int(total),
            "segmented": "warc-segment-number" in head,
            "block": block,
        }


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below a folder. A file is read in pieces, and its records leave in batches of
    bounded size."""

    def batch_of(rows: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([r[n] for r in rows], kind) for n, kind in zip(names, kinds, strict=True)]
        return pa.record_batch(columns, names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0):
                rows, size = [], 0
                for row in parsed(expanded(archive.as_py())):
                    rows.append(row)
                    size += len(row["block"])
                    if size >= PIECE_BYTES or len(rows) >= BATCH_ROWS:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    schema = T.StructType.fromDDL(FIELDS)
    names = [f.name for f in schema]
    kinds = [pa.string()] * 6 + [pa.int32(), pa.int64(), pa.bool_(), pa.binary()]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.where("length > 0").select("content").mapInArrow(parse, FIELDS)


def reassemble(records: DataFrame) -> DataFrame:
    """(record_id, type, page, digest, refers_to, payload): a row for each response and revisit.

    Segments are grouped by their origin and ordered by number; numbers must run from 1 without a gap and
    their lengths must add up to the total that the last one states. Anything else raises an error: an
    archive that lost a segment is never read as a shorter page. A group is one page's segments; records
    that are not in segments are not moved.
    """
    part = F.struct("segment", "block", "total", "record_id", "type", "page", "digest", "refers_to")
    cut = records.where("segmented").groupBy("origin").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    whole = records.where("not segmented").select(F.array(part).alias("parts")).union(cut.select("parts"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for parts in batch.column(0).to_pylist():
                first, last = parts[0], parts[-1]
                if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)):
                    raise ValueError(f"segments of {first['record_id']} are missing or repeated")
                block = b"".join(p["block"] for p in parts)
                if len(parts) > 1 and last["total"] != len(block):
                    raise ValueError(f"segments of {first['record_id']} do not add up")
                payload = None
                if first["type"] == "response":
                    head, _, body = block.partition(b"\r\n\r\n")
                    framed = b"transfer-encoding: chunked" in head.lower()
                    payload = dechunked(body) if framed else body
                    if first["digest"] not in (None, digest_of(payload)):
                        raise ValueError(f"payload of {first['record_id']} does not match its digest")
                rows.append((*(first[n] for n in ("record_id", "type", "page", "digest", "refers_to")), payload))
            kinds = [pa.string()] * 5 + [pa.binary()]
            names = ["record_id", "type", "page", "digest", "refers_to", "payload"]
            yield pa.record_batch(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names
            )

    return whole.select("parts").mapInArrow(
        decode, "record_id string, type string, page string, digest string, refers_to string, payload binary"
    )


def archived(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES, **sizes) -> DataFrame:
    """Write archives and read them back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    payload_bytes and payload_digest are those of the full payload that was read; a revisit's come from
    the response that it refers to, found by a join in which many revisits of one response can be split.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path, revisit_bytes=revisit_bytes, **sizes)
    found = reassemble(read_records(spark, path)).withColumns(
        {"bytes": F.octet_length("payload").cast("bigint"), "page": F.col("page").cast("bigint")}
    )
    found = stage(found.drop("payload"), "warc-read")
    responses = found.where("type = 'response'")
    as_response = responses.select(
        F.col("page").alias("page_id"),
        F.col("bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.lit(None).cast("bigint").alias("refers_to"),
    )
    origins = responses.select(
        F.col("record_id").alias("__origin"), F.col("page").alias("__page"), F.col("bytes").alias("__bytes")
    )
    revisits = found.where("type = 'revisit'")
    as_revisit = revisits.join(origins, revisits["refers_to"] == F.col("__origin")).select(
        F.col("page").alias("page_id"),
        F.col("__bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("__page").alias("refers_to"),
    )
    return as_response.unionByName(as_revisit)
