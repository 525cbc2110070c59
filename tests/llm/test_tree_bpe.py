import base64
import hashlib
import random

import numpy as np
import pytest
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from claimlens.llm import queries, tree_bpe
from tests.llm.frames import AWKWARD, SF, documents


@pytest.fixture(scope="module")
def codec():
    return tree_bpe.Codec(tree_bpe.rank_file())


def texts(seed, n, most=60):
    letters = random.Random(seed)
    signs = "ab  \n\t'sre12.,é  中\x1c \U0001f600"
    return ["".join(letters.choice(signs) for _ in range(letters.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("leaf", [1, 3, 8])
def test_tree_equals_whole_text(codec, leaf):
    for text in texts(leaf, 400):
        assert codec.encode(text, leaf).tolist() == codec.leaf(text).tolist(), text


def test_long_texts_without_seams(codec):
    for text in ("a" * 30_000, " " * 30_000, "中" * 20_000, "!\n" * 10_000, ""):
        assert codec.encode(text).tolist() == codec.leaf(text).tolist()


def test_decoding_gives_the_text_back(codec):
    for text in texts(7, 200):
        assert codec.decode(codec.leaf(text), 3) == text.encode()


def test_ids_are_those_of_the_other_library(codec):
    other = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    other.encode_special_tokens = True
    for text in [*texts(11, 300), "the <|endoftext|> of", "don't we'll THEY'RE"]:
        assert codec.encode(text, 16).tolist() == other.encode(text, add_special_tokens=False).ids


def test_awkward_rows(spark):
    frame = documents(spark, AWKWARD).selectExpr("*", "1 as n_tokens", "'x' as ids")
    found = {(r.doc_id, r.decoded_sha256): r for r in tree_bpe.round_trip(frame).collect()}
    for row in AWKWARD:
        text = (row[1] or "").encode()
        assert (row[0], hashlib.sha256(text).hexdigest()) in found
    assert found[1, hashlib.sha256(b"").hexdigest()].n_tokens == 0
    assert tree_bpe.round_trip(frame).count() == len(AWKWARD)
    assert tree_bpe.round_trip(frame.limit(0)).collect() == []


def test_query_equals_the_library(spark):
    ranks = tree_bpe.rank_file()
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    text_of = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.QUERIES["op5_tree_bpe"](spark, SF).collect()
    assert len(rows) == len(text_of)
    for row in rows:
        ids = plain.encode_ordinary(text_of[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text_of[row.doc_id].encode()).hexdigest()
