import random
import re
from html import unescape

import pytest

from claimlens.llm import page_difference as pages
from claimlens.llm import queries
from tests.llm.frames import SF

SCHEMA = "page_id bigint, url string, html string, place int, texts string"


def extract(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return {r.page_id: r.text for r in pages.extract(frame).collect()}


def block_text(html):
    return " ".join(t for t, _ in pages.Blocks().finished(html))


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(1500):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = sorted(pages.common_subsequence(a, b))
        rest = iter(b)
        assert len(found) == table[-1][-1] and all(a[i] in rest for i in found)


def test_common_subsequence_in_little_memory(monkeypatch):
    """Tables that are divided give subsequences as long."""
    rng = random.Random(4)
    pairs = [tuple([rng.randint(0, 5) for _ in range(rng.randint(0, 40))] for _ in range(2)) for _ in range(300)]
    lengths = [len(pages.common_subsequence(a, b)) for a, b in pairs]
    monkeypatch.setattr(pages, "TABLE_BITS", 20)
    for (a, b), n in zip(pairs, lengths, strict=True):
        found = sorted(pages.common_subsequence(a, b))
        rest = iter(b)
        assert len(found) == n and all(a[i] in rest for i in found)
    long = [rng.randrange(2000) for _ in range(6000)]
    monkeypatch.setattr(pages, "TABLE_BITS", 1 << 20)
    assert len(pages.common_subsequence(long, long[3000:] + long[:3000])) >= 3000


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ('<div class="layout with-sidebar"><article><p>a</article><div class="sidebar">s</div></div>', "a"),
        ('<div class="hfeed site nav-visible"><main><article>a</article></main></div>', "a"),
        ('<div class="promo page"><main><p>a</main><p>x</div>', "a"),
        ('<div class="banner"><article>a</article><p>x</div><p>y', "a"),
        ("<main><h1>Title</h1><p>by me<article><p>a</article></main>", "Title a"),
        ("<main><h1>Title</h1><p>a</main><p>x", "Title a"),
        ("<article>" + "a " * 40 + "</article><article>teaser</article>", " ".join("a" * 40)),
        ("<article>one two</article><article>three</article>", "one two three"),
        ("<article>a</article><div class=related><article>b</article></div>", "a"),
        ("<article>a<div class=comments><article class=comment>b</article></div></article>", "a"),
        ("<nav><main>x</main></nav><p>y", "y"),
        ("<main>m</main><div class='no-comments'>x</div>", "m"),
    ],
)
def test_marks(spark, html, text):
    blocks = pages.Blocks().finished(html)
    assert pages.main_text(blocks, [pages.block_key(t) for t, _ in blocks], []) == text


def test_many_stray_end_tags_and_deep_pages():
    html = "<div>" * 20_000 + "x" + "</span>" * 20_000 + "</div>" * 20_000 + "<p>y"
    assert block_text(html) == "x y"


def test_pairs_are_nearest_by_path(spark):
    """Each page's neighbour is one of its host whose path shares the longest beginning, the one before if two do."""
    rng = random.Random(8)
    rows = []
    for i in range(60):
        path = "/".join(rng.choice(["a", "ab", "b", "news", "x1"]) for _ in range(rng.randint(1, 4)))
        rows.append((i, f"http://{rng.choice(['p', 'q', 'r'])}.example/{path}/{i}", [f"k{rng.randrange(12)}" for _ in range(rng.randint(1, 8))]))
    found = extract(spark, [(i, url, "".join(f"<p>{b}</p>" for b in blocks)) for i, url, blocks in rows])

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    place = {i: (url.split("/")[2], url.partition(".example")[2], i) for i, url, _ in rows}
    blocks = {i: b for i, _, b in rows}
    for i, key in place.items():
        others = [k for k in place.values() if k[0] == key[0] and k != key]
        best = max((shared(key[1], k[1]) for k in others), default=None)
        near = [k for k in sorted(others) if shared(key[1], k[1]) == best]
        before, after = [k for k in near if k < key], [k for k in near if k > key]
        other = before[-1:] or after[:1]
        gone = pages.common_subsequence(blocks[i], blocks[other[0][2]]) if other else set()
        gone = set() if len(gone) == len(blocks[i]) else gone
        assert len(found[i].split()) == len(blocks[i]) - len(gone)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a&amp;b &eacute;&#233;</p><p> c\n\t d </p>", "a&b éé c d"),
        ("wo<b>rd</b>s<br>next<hr/>last", "words next last"),
        ("<nav><ul><li>x</nav><p>y", "y"),
        ("<div class='Side-Bar ad'>x<p>z</div>y", "y"),
        ("<div id=comments><p>x</div><p>y<script>if (a<b) c('</p>')</script><style>p{}</style>", "y"),
        ("<form>x<input><p>z</form><div role=navigation>n</div><div aria-hidden=true>h</div>y", "y"),
        ("<header>x</header><footer>f</footer><aside>s</aside><!-- c -->y", "y"),
        ("<ul><li>a<li>b</ul><p class=ad>x<p>c", "a b c"),
        ("</div></p>a<b>b<p>c", "ab c"),
        ("", ""),
        ("a < b & c &am", "a < b & c &am"),
    ],
)
def test_structure(html, text):
    assert block_text(html) == text


def test_article_decides(spark):
    page = "<body><p>menu</p><article><header><h1>T</h1></header><p>{}</p><section class=comments>c</section></article><p>end</p>"
    rows = [(1, "http://h/a/1", page.format("same")), (2, "http://h/a/2", page.format("same"))]
    assert extract(spark, rows) == {1: "T same", 2: "T same"}


def test_difference_with_the_nearest_page(spark):
    page = "<p>home</p><p>{}</p><p>shared</p><p>{}</p><p>imprint</p>"
    rows = [
        (1, "http://h.example/news/1", page.format("one", "uno")),
        (2, "http://h.example/news/2?x=1", page.format("two", "due")),
        (3, "http://h.example/shop/9", "<p>other</p><p>imprint</p>"),
        (4, "http://other.example/news/1", "<p>home</p><p>alone</p>"),
        (5, None, "<p>home</p>"),
        (6, "no host", "<p>home</p>"),
        (7, "http://copy.example/1", "<p>home</p><p>text</p>"),
        (8, "http://copy.example/2", "<p>home</p><p>text</p>"),
        (9, "http://h.example/news/3", None),
    ]
    found = extract(spark, rows)
    assert found[1] == "one uno" and found[4] == "home alone" and found[5] == found[6] == "home"
    assert found[7] == found[8] == "home text" and found[9] == ""


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "http://h/1", "<p>a b</p>")] * 3
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    assert [tuple(r) for r in pages.extract(frame).collect()] == [(1, "http://h/1", "a b", 3)] * 3
    assert pages.extract(frame.limit(0)).collect() == []


def test_query_gives_every_article_whole(spark):
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.QUERIES["op2_page_difference"](spark, SF).collect()
    assert len(rows) == len(html)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", html[r.page_id], re.S)[1]
        plain = unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|h1|br)>", " ", article)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)
