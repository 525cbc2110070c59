from collections import Counter, defaultdict

import pytest

from claimlens.llm import line_frequency as lines
from tests.llm.frames import AWKWARD, documents

BLANK = " \t\n\x0b\x0c\r"


def brute(rows, share, least):
    pages, often = Counter(r[3] for r in rows), defaultdict(Counter)
    for _, text, _, site in rows:
        often[site].update({x.strip(BLANK) for x in (text or "").split("\n")} - {""})
    out = []
    for key, text, _, site in rows:
        if text is None:
            out.append((key, None, 0, 0))
            continue
        all_lines = text.split("\n")
        bad = {x for x, n in often[site].items() if site is not None and n >= least and n > share * pages[site]}
        kept = [x for x in all_lines if x.strip(BLANK) not in bad]
        out.append((key, "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


def got(frame):
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in frame.collect()), key=repr)


ROWS = [
    *((i, f"home\n own {i}\n\n  terms \nhome", "en", "a") for i in range(10)),
    *((20 + i, f"own {i}\nhome" if i == 0 else f"own {i}", "en", "b") for i in range(10)),
    *((40 + i, "home\nterms", "en", None) for i in range(5)),
    *((60 + i, "same", "en", "c") for i in range(2)),
]


@pytest.mark.parametrize(("share", "least"), [(0.02, 3), (0.2, 1), (0.99, 2), (1.0, 1)])
def test_equals_counting(spark, share, least):
    rows = [*ROWS, *AWKWARD]
    frame = documents(spark, rows).selectExpr("*", "7 as n_lines", "1 as __n")
    found = lines.without_boilerplate(frame, "source", share=share, least_pages=least)
    assert got(found) == brute(rows, share, least)
    assert set(found.columns) == {*frame.columns, "n_dropped"}


def test_empty_table(spark):
    assert lines.without_boilerplate(documents(spark, []), "source").collect() == []
