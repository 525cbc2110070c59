import re
from collections import Counter

import pytest

from claimlens.llm import divergence_rules as rules
from claimlens.llm import queries
from tests.llm.frames import AWKWARD, SF, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) by plain counting."""
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, held = Counter(windows), set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            held.update(range(i, i + 8))
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(held)


TEXTS = [
    "a b c d e f g h a b c d e f g h x a b c d e f g h",
    "a a a a a a a a a a",
    "a a a a a a a a",
    "one\x0btwo\x0cthree\rfour\tfive    six",
    "same\n same\nsame\n\n \t\nsame ",
    "#*$%&|<> \U0001f600 中文",
    " ".join(str(i % 9) for i in range(300)),
    " ".join(map(str, range(3000))),
]


def test_base_columns(spark):
    rows = documents(spark, [*AWKWARD, *((100 + i, t) for i, t in enumerate(TEXTS))])
    found = rules.judge(rows.selectExpr("*", "1 as n_words", "2 as kept"), {}).collect()
    assert len(found) == len(AWKWARD) + len(TEXTS)
    text_of = {r[0]: r[1] for r in AWKWARD} | {100 + i: t for i, t in enumerate(TEXTS)}
    for r in found:
        expected = base(text_of[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (expected[0] < 20 or 100 * expected[4] > 30 * expected[0])
        assert r.kept == (not r.base_failed) and r.char_distance is None
    assert rules.judge(rows.limit(0), {}).collect() == [] and rules.references(rows.limit(0)) == {}


def distance(p, q):
    from math import log2, sqrt

    both = 0.0
    for a, b in zip(p, q, strict=True):
        both += (a * log2(2 * a / (a + b)) if a else 0) + (b * log2(2 * b / (a + b)) if b else 0)
    return sqrt(min(1, max(0, both / 2)))


def test_distances(spark):
    prose = [(i, " ".join(f"the river of {'abcdefgh'[(i * j) % 8]}tone and".title() for j in range(20)), "en") for i in range(30)]
    junk = [(100, "$$## " * 30 + " ".join(f"{i}%" for i in range(60)), None)]
    short = [(101, "## $$ %% " * 8, None)]
    frame = documents(spark, prose + junk + short)
    known = rules.references(frame)
    assert list(known) == ["en"] and sum(known["en"].classes) == pytest.approx(1)
    found = {r.doc_id: r for r in rules.judge(frame, known).collect()}
    assert not found[100].kept and found[100].char_distance > rules.CHAR_DISTANCE
    assert found[101].char_distance is None
    for i, text, _ in prose[:5] + junk:
        classes = [
            sum(c.islower() for c in text), len(re.findall(r"[\x20\x09-\x0D]", text)),
            sum(c in "#%" for c in text), sum(c.isupper() for c in text), sum(c.isdigit() for c in text),
        ]
        shares = [c / len(text) for c in classes] + [1 - sum(classes) / len(text)]
        assert found[i].char_distance == pytest.approx(distance(shares, known["en"].classes), abs=2e-6)
        words = re.findall(r"[a-z]+", text.lower())
        common = list(known["en"].words)
        p = [words.count(w) / max(1, len(words)) for w in common]
        q = [known["en"].words[w] for w in common]
        if words:
            assert found[i].word_distance == pytest.approx(distance([*p, 1 - sum(p)], [*q, max(0.0, 1 - sum(q))]), abs=2e-6)


def test_query(spark):
    rows = queries.QUERIES["op7_divergence_rules"](spark, SF)
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in rows._jdf.queryExecution().executedPlan().toString()
    text_of = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = rows.collect()
    assert len(found) == len(text_of)
    for r in found:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(text_of[r.doc_id])
