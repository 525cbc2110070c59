"""What several operators share: session settings, the train rows, word hashes, components."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.session import stage, tune

# Rows and bytes of one Arrow batch: what a Python worker holds at a time stays small even where
# every text is long.
BATCH_ROWS = 500
BATCH_BYTES = 8 << 20


def prepared(spark: SparkSession) -> SparkSession:
    """Settings of these operators; Python workers find this package where the driver found it."""
    tune(spark)
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    places = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in places:
        environment["PYTHONPATH"] = os.pathsep.join([root, *places])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that nothing is learned from: crc32 of the id's text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


# --- word hashes -----------------------------------------------------------------------------

# The white space of the data contracts: space and the five control characters 9-13.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with good avalanche (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_RANDOM = np.random.Generator(np.random.PCG64(20240611))
_BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_POSITION_STEP = np.uint64(0x9E3779B97F4A7C15)
# A longer text goes through in pieces of this many bytes, cut at white space.
_PIECE = 1 << 19


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash for each word ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes, A-Z lower-cased, in order."""
    if len(text) <= _PIECE:
        return _hashes_of_piece(np.frombuffer(text, np.uint8))
    parts, at = [], 0
    while at < len(text):
        end = min(len(text), at + _PIECE)
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        parts.append(_hashes_of_piece(np.frombuffer(text[at:end], np.uint8)))
        at = end
    return np.concatenate(parts)


def _hashes_of_piece(raw: np.ndarray) -> np.ndarray:
    inside = ~_SPACE[raw]
    if not inside.any():
        return np.empty(0, np.uint64)
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & ~before)
    kept = np.flatnonzero(inside)
    ordinal = np.cumsum((inside & ~before)[kept]) - 1
    position = (kept - starts[ordinal]).astype(np.uint64)
    # Each byte is hashed with its place in the word; a word's hash is the sum over its bytes.
    each = mix(_BYTE_CODES[_LOWER[raw[kept]]] + position * _POSITION_STEP)
    first = np.searchsorted(kept, starts)
    return mix(np.add.reduceat(each, first))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words; fewer words, but at least one, make a single run."""
    if len(words) == 0:
        return words
    if len(words) < width:
        total = np.full(1, len(words), np.uint64)
        for k in range(len(words)):
            total = mix(total * _POSITION_STEP + words[k : k + 1])
        return total
    total = np.full(len(words) - width + 1, np.uint64(width))
    for k in range(width):
        total = mix(total * _POSITION_STEP + words[k : len(words) - width + 1 + k])
    return total


# --- gates -----------------------------------------------------------------------------------

GATE_BITS = 1 << 25
_GATE_PIECE = 1 << 15  # what bitmap_construct_agg puts into one value


def maybe_in(keys: DataFrame, *on: str) -> Column:
    """For a table with the columns ``on``: false only for rows that equal none of ``keys`` in them, so that few
    others have to move to meet ``keys``. The driver and each worker hold 4 MB, whatever the data; a fuller gate
    lets more rows through, and what follows decides about them."""
    bit = F.pmod(F.xxhash64(*on), F.lit(GATE_BITS))
    pieces = keys.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / _GATE_PIECE).alias("piece"))
    bits = np.zeros((GATE_BITS // _GATE_PIECE, _GATE_PIECE // 8), np.uint8)
    for row in pieces.agg(F.bitmap_construct_agg(F.col("bit") % _GATE_PIECE).alias("bits")).collect():
        bits[row["piece"]] = np.frombuffer(row["bits"], np.uint8)
    gate = keys.sparkSession.sparkContext.broadcast(bits.reshape(-1))

    @F.arrow_udf("boolean")
    def passes(place: pa.Array) -> pa.Array:
        at = place.to_numpy(zero_copy_only=False)
        return pa.array((gate.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 != 0)

    return passes(bit)


# --- components ------------------------------------------------------------------------------


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, component) for every node of the undirected ``links`` (a, b): the smallest node reachable.

    Large-star and small-star rounds: each keeps the components and shrinks the graph towards one
    star around each component's smallest node, in a number of rounds that grows with the logarithm
    of a path's length. A round groups by node through a join with the nodes' smallest neighbours,
    so that the links of one popular node are never gathered in a task. Rounds end when a round
    changes nothing; each is written to the shared folder, so lost executors cost a re-read.
    """
    current = links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    current = stage(current.distinct(), f"{label}-links")
    seen = _fingerprint(current)
    while True:
        both = current.select("a", "b").union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = stage(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")),
            f"{label}-lowest",
        )
        # Large star: every larger neighbour moves to the smallest of the neighbourhood.
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.distinct(), f"{label}-large")
        # Small star: the smaller neighbours and the node itself move to the smallest of them.
        lowest = stage(large.groupBy("a").agg(F.min("b").alias("m")), f"{label}-small")
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.where("a <> b").union(lowest.select("a", F.col("m").alias("b")))
        current = stage(small.distinct(), f"{label}-links")
        now = _fingerprint(current)
        if now == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        seen = now


def _fingerprint(links: DataFrame) -> tuple:
    """Equal for equal sets of links: their number and an order-free sum of hashes."""
    return tuple(
        links.agg(
            F.count(F.lit(1)),
            F.sum(F.xxhash64("a", "b").cast("decimal(20,0)")),
        ).first()
    )
