from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from claimlens.llm import queries
from claimlens.llm import retrieval_packing as packing
from tests.llm.frames import AWKWARD, SF, documents


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def check(pieces, rows, tokenizer, window):
    """Each id in one piece, pieces without a gap in their documents and sequences; gives the sequences' sizes."""
    wanted = defaultdict(int)
    for key, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        wanted[key, ids.tobytes()] += 1
    by_key, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_key[p.doc_id, p.doc_tokens].append(p)
        by_sequence[p.sequence_id].append(p)
    made = defaultdict(int)
    for key, text in list(wanted):
        n, times = len(text) // 4, wanted[key, text]
        starts = defaultdict(int)
        for p in by_key[key, n]:
            assert p.ids_crc32 == crc32(text[4 * p.start : 4 * (p.start + p.length)])
            starts[p.start] += p.length
            made[key] += 1
        assert sum(starts.values()) == n * times
    assert sum(made.values()) == len(pieces)
    sizes = []
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window
        sizes.append(at)
    return sizes


def test_awkward_rows(spark, tokenizer):
    frame = documents(spark, AWKWARD).selectExpr("*", "1 as start", "'x' as ids")
    pieces = packing.pack(frame).collect()
    sizes = check(pieces, [r[:2] for r in AWKWARD], tokenizer, 2048)
    assert sum(s < 2048 for s in sizes) <= 1
    assert packing.pack(frame.limit(0)).collect() == []


def test_query(spark, tokenizer):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    sizes = check(queries.QUERIES["op3_retrieval_packing"](spark, SF).collect(), rows, tokenizer, 2048)
    assert sum(s < 2048 for s in sizes) <= 1


def test_many_small_shards(spark, tokenizer):
    rows = [(i, f"text {i} " * (i % 40)) for i in range(200)]
    pieces = packing.pack(documents(spark, rows), window=64, shard_chars=4000).collect()
    check(pieces, rows, tokenizer, 64)
    assert len({p.sequence_id >> 32 for p in pieces}) > 3


def test_neighbours_share_terms():
    """Seeds draw the documents that share their rare terms, not those that come next."""
    rng = np.random.default_rng(1)
    topics = [rng.integers(1000 * t, 1000 * t + 50, (10, 30)) for t in range(1, 5)]
    docs = [np.r_[topics[i % 4][i // 4], rng.integers(0, 20, 10)].astype(np.uint32) for i in range(40)]
    together = defaultdict(set)
    for d, _, _, sequence, _ in packing.packed(docs, 200):
        together[sequence].add(d % 4)
    assert sum(len(t) == 1 for t in together.values()) >= len(together) - 2


@pytest.mark.parametrize("largest", [60, 70_000])
def test_leading_terms_of_a_batch(largest):
    """The two strongest terms of every document, as found one document at a time."""
    rng = np.random.default_rng(largest)
    docs = [rng.integers(0, largest, rng.integers(0, 40)).astype(np.uint32) for _ in range(200)]
    docs += [np.array([1], np.uint32), np.array([7, 7, 1], np.uint32), np.empty(0, np.uint32)]
    statistics = packing.statistics_of(docs)
    for least in (0, 3):
        expected = []
        for d in docs:
            terms, counts = packing.terms_of(d)
            weight = statistics.weights(terms, counts, np.float64(len(d)))
            weight[statistics.held[terms] < least] -= 1e6
            best = sorted(zip(-weight, terms.tolist(), strict=True))
            expected.append(tuple([t for _, t in best] + [-1, -1])[:2])
        assert list(zip(*(x.tolist() for x in packing.leading_terms(docs, statistics, least)), strict=True)) == expected


def test_scores_are_bm25():
    docs = [np.array(d, np.uint32) for d in ([5, 5, 7], [5, 8, 8, 8], [9], [7, 9])]
    n, mean = 4, 10 / 4
    expected = np.zeros(4)
    for term in (5, 7):
        holders = sum(term in d for d in docs)
        idf = np.log1p((n - holders + 0.5) / (holders + 0.5))
        for i, d in enumerate(docs):
            tf = int((d == term).sum())
            expected[i] += idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
    assert packing.Index(docs).scores(0) == pytest.approx(expected)


def test_all_shared_terms_are_looked_up():
    """A seed with many strong terms of its own still finds the documents that share its weaker ones."""
    docs = [np.r_[np.arange(100, 140), 7, 8], *(np.arange(1000 * i, 1000 * i + 42) for i in range(2, 9)), np.full(42, 7)]
    first = [d for d, _, _, s, _ in packing.packed([d.astype(np.uint32) for d in docs], 84) if s == 0]
    assert first == [0, 8]


def test_neighbours_until_the_window_is_full():
    """More related documents than any fixed number, and no unrelated one before them."""
    docs = [np.array([5 + (i % 2), 1], np.uint32) for i in range(200)]
    pieces = list(packing.packed(docs, 160))
    assert [d for d, _, _, s, _ in pieces if s == 0] == list(range(0, 160, 2))
    assert [d for d, _, _, s, _ in pieces if s == 2] == [*range(160, 200, 2), *range(161, 200, 2)]


def test_statistics_cover_all_shards(spark, tokenizer):
    rows = [(i, f"word{i % 7} text {i} " * 20) for i in range(200)]
    ids = [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], np.uint32) for _, t in rows]
    staged = packing.encoded(documents(spark, rows), "doc_id", "text", spark.sparkContext.broadcast(packing.rank_file()))
    found, expected = packing.corpus_statistics(staged), packing.statistics_of(ids)
    assert found.documents == 200 and found.mean == pytest.approx(expected.mean)
    assert found.held.tolist() == expected.held.tolist()


def test_related_documents_meet_in_a_shard(spark, tokenizer):
    """Four topics of a shard each: a sequence holds one topic, which a deal by hash would mix."""
    names = ["orbit planet comet", "sonata violin cello", "glacier fjord moraine", "tariff ledger audit"]
    rows = [(i, f"{names[i % 4]} " * (20 + i // 4)) for i in range(160)]
    cost = sum(len(t) + packing.ROW_CHARS for _, t in rows)
    pieces = packing.pack(documents(spark, rows), window=512, shard_chars=-(-cost // 4)).collect()
    check(pieces, rows, tokenizer, 512)
    topics = defaultdict(set)
    for p in pieces:
        topics[p.sequence_id].add(p.doc_id % 4)
    assert sum(len(t) == 1 for t in topics.values()) > 0.8 * len(topics)


def test_equal_rows_and_empty_texts_are_spread(spark, tokenizer):
    rows = [(None, "the same text again")] * 300 + [(None, "")] * 300
    pieces = packing.pack(documents(spark, rows), window=64, shard_chars=6000).collect()
    check(pieces, rows, tokenizer, 64)
    held = defaultdict(int)
    for p in pieces:
        held[p.sequence_id >> 32] += 1
    assert len(held) > 4 and max(held.values()) < 200
