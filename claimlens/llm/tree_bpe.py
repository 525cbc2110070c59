"""Byte-level BPE over a balanced tree of text segments.

The segments of a text form a monoid: a segment's tokens are those of its two halves joined. A join
keeps all tokens of both halves except those in a window around the seam, which it encodes anew. The
window grows until both of its ends are *seams of every scan*: places where the split pattern must
end a match whatever stands further off. A match of the pattern holds white space only as its first
character, or consists of white space alone; so a match always ends between a character that is not
white space and one that is. Tokens beyond such a place depend on nothing inside the window.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from claimlens.llm.common import text_or_empty

LEAF_CHARS = 2048
FIRST_WINDOW = 64

# Python's \S leaves out a superset of the white space of the pattern; the second class is a subset.
_SEAM = re.compile(r"\S(?=[ \t\n\r\f\v])")


def rank_file(path: str | None = None) -> bytes:
    """The bytes of a rank file (a few MB: what a vocabulary is, whatever the data)."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        return file.read()


class Codec:
    """Encoder and decoder of one vocabulary, given as the lines of a rank file."""

    def __init__(self, ranks: bytes, pattern: str | None = None):
        import tiktoken

        if pattern is None:
            from public_tokenizers import PATTERN as pattern
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self._plain = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self._bytes: list[bytes] = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            self._bytes[rank] = token

    def leaf(self, text: str) -> np.ndarray:
        return np.array(array("I", self._plain.encode_ordinary(text)), "<u4")

    def encode(self, text: str, leaf_chars: int = LEAF_CHARS) -> np.ndarray:
        """Ids of a whole text; equal to ``leaf(text)``."""
        return self._encode(text, 0, len(text), max(1, leaf_chars))

    def _encode(self, text: str, start: int, end: int, leaf_chars: int) -> np.ndarray:
        if end - start <= leaf_chars:
            return self.leaf(text[start:end])
        middle = (start + end) // 2
        left = self._encode(text, start, middle, leaf_chars)
        right = self._encode(text, middle, end, leaf_chars)
        return self.join(text, start, middle, end, left, right)

    def join(self, text: str, start: int, middle: int, end: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of text[start:end] from those of text[start:middle] and text[middle:end]."""
        low, high = _last_seam(text, start, middle), _first_seam(text, middle, end)
        # What the halves had made of the window goes; the window's own ids take its place.
        kept = len(left) - len(self.leaf(text[low:middle])) if low > start else 0
        dropped = len(self.leaf(text[middle:high])) if high < end else len(right)
        return np.concatenate([left[:kept], self.leaf(text[low:high]), right[dropped:]])

    def decode(self, ids: np.ndarray, leaf_ids: int = LEAF_CHARS) -> bytes:
        """The bytes of ids: those of the halves, one after the other."""
        if len(ids) <= leaf_ids:
            return b"".join([self._bytes[i] for i in ids.tolist()])
        middle = len(ids) // 2
        return self.decode(ids[:middle], leaf_ids) + self.decode(ids[middle:], leaf_ids)


def _last_seam(text: str, start: int, middle: int) -> int:
    """The last seam of every scan inside text[start:middle], or its start."""
    width = FIRST_WINDOW
    while True:
        low = max(start, middle - width)
        found = low
        for match in _SEAM.finditer(text, low, middle):
            found = match.end()
        if found > low or low == start:
            return found if found > low else start
        width *= 2


def _first_seam(text: str, middle: int, end: int) -> int:
    """The first seam of every scan inside text[middle:end], or its end."""
    width = FIRST_WINDOW
    while True:
        high = min(end, middle + width)
        match = _SEAM.search(text, middle, high)
        if match or high == end:
            return match.end() if match else end
        width *= 2


def round_trip(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ranks: bytes | None = None,
    leaf_chars: int = LEAF_CHARS,
) -> DataFrame:
    """Per row: key, n_tokens, ids_sha256, decoded_sha256, and ids (array of int).

    A null text counts as empty (no ids); repeated rows each give a row; an empty table gives none;
    other columns are not read. One text is one task's work at most, in batches of bounded size.
    """
    spark: SparkSession = documents.sparkSession
    shared = spark.sparkContext.broadcast(ranks or rank_file())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            ids = [codec.encode(t, leaf_chars) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i.tobytes()).hexdigest() for i in ids], pa.string()),
                    pa.array([hashlib.sha256(codec.decode(i)).hexdigest() for i in ids], pa.string()),
                    pa.array([i.astype(np.int32) for i in ids], pa.list_(pa.int32())),
                ],
                [key, "n_tokens", "ids_sha256", "decoded_sha256", "ids"],
            )

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text_or_empty(text).alias(text)).mapInArrow(
        encode, f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids array<int>"
    )
