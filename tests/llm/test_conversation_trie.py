import hashlib
import random
import re
from zlib import crc32

import pytest

from claimlens.llm import conversation_trie as trie
from claimlens.llm import queries

ROWS = "conv_id bigint, turn bigint, role string, text string, depth string, k1 int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS)


def turns_of(rows):
    """{conv_id: [(role, text), ...]} in the defined order."""
    found = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            found.setdefault(c, []).append(((t is not None, t or 0, digest), (role, text)))
    return {c: [x for _, x in sorted(ts)] for c, ts in found.items()}


def rebuilt(turns):
    heads = {c: crc32(str(c).encode()) % 4 for c in turns}
    return {c: turns.get(c - c % 20, [])[:h] + turns[c][h:] for c, h in heads.items()}


def plain(turns):
    """Nodes by following every conversation from the root, sums by following every node to it."""
    nodes = {}
    for c, ts in turns.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    children = dict.fromkeys(nodes, 0)
    for key in nodes:
        if key:
            children[key[:-1]] += 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for key, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        for d in range(len(key) + 1):
            leaves[key[:d]] += children[key] == 0
            saved[key[:d]] += (len(members) - 1) * words
    rows = []
    for key, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(turns[c]) == len(key))))
        parent = min(nodes[key[:-1]]) if key else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        rows.append((min(members), len(key), parent, len(members), children[key], leaves[key], saved[key], digest))
    return sorted(rows, key=repr)


def found(spark, rows, shared=False):
    turns = trie.ordered(frame(spark, rows))
    turns, ids = trie.with_shared_heads(turns) if shared else (turns, turns.select("conv_id").distinct())
    return sorted(map(tuple, trie.trie(turns, ids).collect()), key=repr)


def conversations(n, seed):
    """Conversations with common beginnings, of 1 to 9 turns, some copied."""
    rng, rows = random.Random(seed), []
    for c in range(n):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rng.choice(["yes", "no", "a b c", ""])))
    return rows


def test_equals_a_plain_trie(spark):
    rows = conversations(60, 1)
    assert found(spark, rows) == plain(turns_of(rows))


def test_shared_heads(spark):
    rows = conversations(50, 2) + [(-41, 1, "user", "q"), (-40, 1, "user", "r"), (10**15 + 3, 5, "user", "alone")]
    assert found(spark, rows, shared=True) == plain(rebuilt(turns_of(rows)))


@pytest.mark.parametrize("deepest", [20])
def test_several_rounds_of_bands_and_blocks(spark, monkeypatch, deepest):
    """Bands of 2 depths, windows of 8 turns: a trie of depth 20 needs five rounds and many blocks."""
    monkeypatch.setattr(trie, "BAND", 2)
    monkeypatch.setattr(trie, "BLOCK", 8)
    monkeypatch.setattr(trie, "TURNS", 4)
    monkeypatch.setattr(trie, "IDS", 3)
    rng, rows = random.Random(deepest), []
    for c in range(14):
        alike = rng.randint(0, deepest)
        for t in range(rng.choice([alike + 1, deepest])):
            rows.append((c, t, "user", "same words" if t < alike else f"own {c % 3}"))
    assert found(spark, rows) == plain(turns_of(rows))


def test_awkward_rows(spark):
    """Nulls, ties, equal rows, gaps between turns, no conv_id, long texts, control characters."""
    rows = [
        (1, None, None, None),
        (1, 7, "user", "a\x00b"),
        (1, -3, "user", "first\tsecond"),
        (2, 1, "user", "tie"),
        (2, 1, "assistant", "tie"),
        (2, 1, "assistant", "tie"),
        (3, 1, "assistant", "tie"),
        (None, 1, "user", "nobody"),
        (4, 2**40, "user", "word " * 50_000),
        (4, 2**40 + 1, "", ""),
        (5, 1, "us", "ertie"),
        (6, 1, "user", "tie"),
    ]
    assert found(spark, rows) == plain(turns_of(rows))
    assert found(spark, rows, shared=True) == plain(rebuilt(turns_of(rows)))


def test_empty_table(spark):
    assert found(spark, []) == [] and found(spark, [], shared=True) == []


def test_a_turnless_conversation_ends_at_the_root(spark):
    """Its two turns go, and the conversation that it would begin like is absent."""
    absent = next(c for c in range(21, 39) if crc32(str(c).encode()) % 4 == 2)
    rows = [(absent, 1, "user", "x"), (absent, 2, "assistant", "y")]
    assert found(spark, rows, shared=True) == plain({absent: []})


def test_one_conversation_with_most_turns_is_many_windows(spark):
    """No window holds more than a range of turns, and no row more than a band."""
    rows = [(1, t, "user", f"t{t % 5}") for t in range(9000)] + [(2, t, "user", f"t{t % 5}") for t in range(20)]
    turns = trie.ordered(frame(spark, rows))
    nodes = trie.trie(turns, turns.select("conv_id").distinct()).collect()
    assert len(nodes) == 9001
    root = next(n for n in nodes if n.depth == 0)
    assert (root.n_convs, root.n_leaves, root.saved_tokens) == (2, 1, 20)


def test_query_has_a_twin():
    assert "op11_conversation_trie" in queries.ORACLE_SQL
