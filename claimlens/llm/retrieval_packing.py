"""Packing documents into training sequences with lexically related neighbours.

Documents are dealt by their leading terms into shards of bounded size. A shard has an index with BM25
weights over token ids; document frequencies and the mean length are those of the whole corpus. The first
unused document is a seed, and the unused documents of its shard that share a term with it fill the rest
of its window, best score first; the last one is cut to what is left. Where none is left, the next unused
ones follow in order. A shard leaves one window that is not full, at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import text_or_empty
from claimlens.llm.tree_bpe import Codec, rank_file
from claimlens.operators.running import running_totals
from claimlens.session import stage

WINDOW = 2048
END_OF_TEXT = 1  # closes every document
SHARD_CHARS = 8_000_000  # a shard's text, on average: what a task holds at a time
ROW_CHARS = 64  # what a row adds to its shard's size besides its characters
SALT_SEED = 20240611
RANKED_FIRST = 64  # the best so many are put in order first, the others if these do not fill a window
K1, B = 1.2, 0.75


class Statistics(NamedTuple):
    """Of all documents: their number, their mean length, and how many hold each id."""

    documents: int
    mean: float
    held: np.ndarray

    def weights(self, terms: np.ndarray, counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """BM25 weights of terms that documents of these lengths hold so many times."""
        found = self.held[terms]
        idf = np.log1p((self.documents - found + 0.5) / (found + 0.5))
        norm = K1 * (1 - B + B * lengths / max(1.0, self.mean))
        return counts * (K1 + 1) / (counts + norm) * idf


def terms_of(document: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A document's distinct ids and their counts; what closes every document is no term."""
    terms, counts = np.unique(document, return_counts=True)
    kept = terms != END_OF_TEXT
    return terms[kept], counts[kept].astype(float)


def terms_of_all(documents: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``terms_of`` every document, one after the other: the document's place, the term, its count."""
    lengths = [len(d) for d in documents]
    ids = np.concatenate([np.empty(0, np.uint32), *documents])
    # Place and id in one number, a short one where they fit: one sort puts all terms in order.
    short = len(documents) <= 1 << 16 and ids.max(initial=0) < 1 << 16
    kind, bits = (np.uint32, 16) if short else (np.uint64, 32)
    owner = np.repeat(np.arange(len(documents), dtype=kind), lengths)
    found, counts = np.unique(owner << kind(bits) | ids.astype(kind), return_counts=True)
    owner, terms = (found >> kind(bits)).astype(np.int64), (found & kind((1 << bits) - 1)).astype(np.int64)
    kept = terms != END_OF_TEXT
    return owner[kept], terms[kept], counts[kept].astype(float)


def statistics_of(documents: list[np.ndarray]) -> Statistics:
    held = np.bincount(terms_of_all(documents)[1], minlength=1)
    return Statistics(len(documents), sum(map(len, documents)) / max(1, len(documents)), held)


class Index:
    """BM25 over documents given as arrays of ids. A term that many of the documents hold is a column of a
    matrix, a rarer one has a list; a score is over all terms of the seed."""

    def __init__(self, documents: list[np.ndarray], statistics: Statistics | None = None):
        statistics = statistics or statistics_of(documents)
        n = len(documents)
        owner, terms, counts = terms_of_all(documents)
        length = np.array([len(d) for d in documents], float)
        weight = statistics.weights(terms, counts, length[owner])
        found = np.bincount(terms, minlength=1)
        place = (np.cumsum(found > 0) - 1)[terms]
        found = found[found > 0]
        # A matrix at least a quarter of which is filled: no larger than the lists in its place.
        wide = found > n / 4
        column = np.cumsum(wide) - 1
        common = wide[place]
        self._matrix = np.zeros((n, int(wide.sum())), np.float32)
        self._matrix[owner[common], column[place[common]]] = weight[common]
        self._seeds = self._matrix > 0
        # Terms that no other document holds add to no score.
        rare = ~common & (found[place] > 1)
        ends = np.searchsorted(owner[rare], np.arange(1, n + 1))
        self._query = np.split(place[rare], ends[:-1]) if n else []
        by = np.argsort(place[rare].astype(np.min_scalar_type(len(found))), kind="stable")
        self._place, self._owner, self._weight = place[rare][by], owner[rare][by], weight[rare][by]
        self.documents = np.arange(n)
        self._terms = len(found)
        self._bounds()

    def _bounds(self) -> None:
        self._starts = np.searchsorted(self._place, np.arange(self._terms + 1))

    def keep(self, kept: np.ndarray) -> None:
        """From now on only those of ``documents`` are looked for."""
        of_kept = kept[self._owner]
        self._owner = (np.cumsum(kept) - 1)[self._owner[of_kept]]
        self._place, self._weight = self._place[of_kept], self._weight[of_kept]
        self._matrix, self.documents = self._matrix[kept], self.documents[kept]
        self._bounds()

    def scores(self, seed: int) -> np.ndarray:
        """Of each of ``documents``, by what it has of the seed's terms."""
        starts = self._starts[self._query[seed]]
        sizes = self._starts[self._query[seed] + 1] - starts
        at = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        scores = np.bincount(self._owner[at], self._weight[at], minlength=len(self.documents))
        return scores + self._matrix @ self._seeds[seed].astype(np.float32)


def ranked(scores: np.ndarray) -> Iterator[int]:
    """Places of all scores above 0, best first, equal ones in order."""
    given, some = 0, RANKED_FIRST
    while True:
        least = np.partition(scores, -some)[-some] if some < len(scores) else 0.0
        places = np.flatnonzero((scores >= least) & (scores > 0))
        places = places[np.lexsort((places, -scores[places]))]
        yield from places[given:].tolist()
        if least <= 0:
            return
        given, some = len(places), 8 * some


def packed(
    documents: list[np.ndarray], window: int = WINDOW, statistics: Statistics | None = None
) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece; each id lies in exactly one."""
    length = np.array([len(d) for d in documents], np.int64)
    taken = np.zeros(len(documents), np.int64)
    sequence = 0
    # Whole windows of long documents need no neighbour.
    for d in np.flatnonzero(length >= window):
        while length[d] - taken[d] >= window:
            yield int(d), int(taken[d]), window, sequence, 0
            taken[d] += window
            sequence += 1
    index = Index(documents, statistics)
    left = length - taken
    seed = 0
    while seed < len(documents):
        if not left[seed]:
            seed += 1
            continue
        used = 0

        def piece(d: int, size: int):
            nonlocal used
            made = (int(d), int(length[d] - left[d]), int(size), sequence, used)
            left[d] -= size
            used += size
            return made

        yield piece(seed, left[seed])
        if used < window:
            unused = left[index.documents] > 0
            if unused.sum() < 0.75 * len(unused):
                index.keep(unused)
                unused = unused[unused]
            scores = index.scores(seed)
            scores[~unused] = 0.0
            for place in ranked(scores):
                d = index.documents[place]
                yield piece(d, min(left[d], window - used))
                if used == window:
                    break
            # No unused document shares a term: the next ones in order.
            if used < window:
                for d in np.flatnonzero(left):
                    yield piece(d, min(left[d], window - used))
                    if used == window:
                        break
        sequence += 1


def encoded(documents: DataFrame, key: str, text: str, shared) -> DataFrame:
    """(__key, __ids, __cost, __salt) of every row, written once: ids with ``END_OF_TEXT`` as bytes, what a
    shard's size counts, and a number in [0, 1) that spreads rows with nothing to tell them apart. Each task adds
    a row with what its documents add to the statistics, __held, and nothing else."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, held, length, n, kind = Codec(shared.value), np.zeros(1, np.int64), 0, 0, None
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = [np.append(codec.leaf(t), np.uint32(END_OF_TEXT)).astype("<u4") for t in texts]
            found = np.bincount(terms_of_all(ids)[1])
            longer = max(len(held), len(found))
            held = np.pad(held, (0, longer - len(held))) + np.pad(found, (0, longer - len(found)))
            length, n, kind = length + sum(map(len, ids)), n + len(ids), batch.schema.field(0).type
            cost = [len(t) + ROW_CHARS for t in texts]
            yield _coded(batch.column(0), [_bytes(i) for i in ids], cost, [None] * len(ids))
        if n:
            terms = np.flatnonzero(held)
            sums = np.concatenate([[n, length], terms, held[terms]]).astype("<i8").tobytes()
            yield _coded(pa.nulls(1, kind), [None], [None], [sums])

    rows = documents.select(F.col(key).alias("__key"), text_or_empty(text).alias("__text"))
    kind = documents.schema[key].dataType.simpleString()
    rows = rows.mapInArrow(encode, f"__key {kind}, __ids binary, __cost bigint, __held binary")
    return stage(rows.withColumn("__salt", F.rand(SALT_SEED)), "packing-ids")


def _coded(keys: pa.Array, ids: list, cost: list, held: list) -> pa.RecordBatch:
    columns = [keys, pa.array(ids, pa.binary()), pa.array(cost, pa.int64()), pa.array(held, pa.binary())]
    return pa.record_batch(columns, ["__key", "__ids", "__cost", "__held"])


def _bytes(ids: np.ndarray) -> bytes:
    """Two bytes an id where they suffice, else four; the first byte tells."""
    return b"\2" + ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"\4" + ids.tobytes()


def _ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype("<u4")


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    ids = np.concatenate([np.empty(0, np.int32), *parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))


def corpus_statistics(rows: DataFrame) -> Statistics:
    """Of all rows of ``encoded``. One number per id of the vocabulary reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                (n, length), rest = np.split(np.frombuffer(data, "<i8"), [2])
                terms, held = np.split(rest, 2)
                yield pa.record_batch(
                    [pa.array(np.r_[-2, -1, terms]), pa.array(np.r_[n, length, held])], ["term", "n"]
                )

    sums = rows.where(F.col("__held").isNotNull()).select("__held")
    counts = sums.mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counts.collect()}
    n, total = found.pop(-2, 0), found.pop(-1, 0)
    held = np.zeros(max(found, default=0) + 1, np.int64)
    held[list(found)] = list(found.values())
    return Statistics(n, total / max(1, n), held)


def leading_terms(documents: list[np.ndarray], statistics: Statistics, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Each document's two strongest terms among those that ``least`` documents hold, or else among all; -1 for none."""
    owner, terms, counts = terms_of_all(documents)
    lengths = np.array([len(d) for d in documents], float)
    weight = statistics.weights(terms, counts, lengths[owner])
    weight[statistics.held[terms] < least] -= 1e6
    first, second = np.full(len(documents), -1), np.full(len(documents), -1)
    for strongest in (first, second):
        places = _greatest(owner, weight)
        strongest[owner[places]] = terms[places]
        owner, terms, weight = (np.delete(x, places) for x in (owner, terms, weight))
    return first, second


def _greatest(owner: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Where each owner's greatest weight stands, the first of equal ones; owners are in order."""
    if not len(owner):
        return np.empty(0, np.int64)
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    most = np.repeat(np.maximum.reduceat(weight, starts), np.diff(starts, append=len(owner)))
    places = np.flatnonzero(weight == most)
    return places[np.r_[True, owner[places][1:] != owner[places][:-1]]]


def dealt(rows: DataFrame, statistics: Statistics, shards: int, shard_chars: int, shared) -> DataFrame:
    """``encoded`` rows with their __shard. Documents of one leading term lie in one shard or in shards side
    by side: those of a term too large for one are divided by their second terms, and those of both terms,
    where they are too many (copies among them), by their salt.

    Sums per leading term, and per part of those that are divided, place the parts one after the other, by
    running totals over ranges of them."""
    least = 0.5 * statistics.documents / shards

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = leading_terms([_ids(d) for d in batch.column(1).to_pylist()], shared.value, least)
            yield pa.record_batch(
                [*batch.columns, pa.array(first), pa.array(second)], [*batch.schema.names, "__first", "__second"]
            )

    kind = rows.schema["__key"].dataType.simpleString()
    led = rows.mapInArrow(
        lead, f"__key {kind}, __ids binary, __cost bigint, __salt double, __first bigint, __second bigint"
    )
    sums = led.groupBy("__first", "__second").agg(F.sum("__cost").alias("__cost"))
    sums = stage(sums, "packing-terms")
    part = shard_chars / 4
    divided = sums.groupBy("__first").agg(F.greatest(F.lit(1), F.ceil(2 * F.sum("__cost") / part)).alias("__parts"))
    divided = divided.withColumn("__parts", F.when(F.col("__parts") <= 2, 1).otherwise(F.col("__parts")))
    divided = stage(divided, "packing-parts")  # a row per id of the vocabulary at most
    in_part = F.pmod(F.xxhash64("__second"), F.col("__parts")).alias("__part")
    units = sums.join(F.broadcast(divided), "__first").groupBy("__first", in_part).agg(F.sum("__cost").alias("cost"))
    units = units.select(F.struct("__first", "__part").alias("unit"), "cost")
    places = running_totals(units, [], "unit", ["cost"])
    # Rows of a unit lie between its place and the next one's, by their salt; a small unit's lie at its middle.
    spread = F.when(F.col("cost") > part, F.col("cost")).otherwise(0)
    middle = F.when(F.col("cost") > part, 0.0).otherwise(F.col("cost") / 2)
    places = places.select("unit.__first", "unit.__part", (F.col("cost_before") + middle).alias("__at"), spread.alias("__spread"))
    places = stage(places, "packing-places")
    led = led.join(F.broadcast(divided), "__first").withColumn("__part", in_part)
    led = led.join(places, ["__first", "__part"])
    shard = F.floor((F.col("__at") + F.col("__salt") * F.col("__spread")) / shard_chars).cast("bigint")
    return led.select("__key", "__ids", shard.alias("__shard"))


def pack(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ranks: bytes | None = None,
    window: int = WINDOW,
    shard_chars: int = SHARD_CHARS,
) -> DataFrame:
    """Per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset and ids.

    Every row is a document: its ids, then ``END_OF_TEXT``. A null or empty text is that id alone. Rows
    with equal keys are documents of their own; a null key stays null. An empty table gives no rows;
    other columns are not read. A sequence lies in one shard, whose number is the upper half of its id.
    Shards are dealt from written rows, so a recomputed task makes the same pieces.
    """
    context = documents.sparkSession.sparkContext
    rows = encoded(documents, key, text, context.broadcast(ranks or rank_file()))
    statistics = corpus_statistics(rows)
    shared = context.broadcast(statistics)
    rows = rows.where(F.col("__held").isNull()).drop("__held")
    cost = rows.agg(F.sum("__cost")).first()[0] or 0
    shards = max(1, -(-cost // shard_chars))
    if shards == 1:
        rows = rows.select("__key", "__ids", F.lit(0).cast("bigint").alias("__shard"))
    else:
        rows = dealt(rows, statistics, shards, shard_chars, shared)

    def fill(table: pa.Table) -> pa.Table:
        shard = table.column("__shard")[0].as_py()
        keys, data = table.column("__key").to_pylist(), table.column("__ids").to_pylist()
        order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i], data[i]))
        ids = [_ids(data[i]) for i in order]
        pieces = list(packed(ids, window, shared.value))
        parts = [ids[d][start : start + size] for d, start, size, _, _ in pieces]
        return pa.table(
            {
                key: pa.array([keys[order[p[0]]] for p in pieces], table.schema.field("__key").type),
                "start": pa.array([p[1] for p in pieces], pa.int64()),
                "length": pa.array([p[2] for p in pieces], pa.int64()),
                "ids_crc32": pa.array([crc32(part.tobytes()) for part in parts], pa.int64()),
                "doc_tokens": pa.array([len(ids[p[0]]) for p in pieces], pa.int64()),
                "sequence_id": pa.array([(shard << 32) + p[3] for p in pieces], pa.int64()),
                "offset": pa.array([p[4] for p in pieces], pa.int64()),
                "ids": _lists(parts),
            }
        )

    kind = documents.schema[key].dataType.simpleString()
    return rows.groupBy("__shard").applyInArrow(
        fill,
        f"`{key}` {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
        "`offset` bigint, ids array<int>",
    )
