import unicodedata

import zstandard

from claimlens.llm import compression_language as language
from claimlens.llm import queries
from tests.llm.frames import AWKWARD, SF, documents, held_out

WORDS = {"en": "the of and that with from have this", "de": "der die und das nicht mit sich auf", "xx": "qua zog wib nul"}


def corpus(n=40):
    rows = []
    for k, (lang, words) in enumerate(sorted(WORDS.items())):
        words = words.split()
        for i in range(n):
            text = " ".join(words[(i * j + j) % len(words)] for j in range(1, 30))
            rows.append((1000 * k + i, text, lang, "s"))
    return rows


def test_learns_from_rows_that_are_not_held_out(spark):
    rows = corpus()
    changed = [(i, "zzz " * 9 if held_out(i) else t, "zz" if held_out(i) else lang, s) for i, t, lang, s in rows]
    assert language.fit(documents(spark, rows)) == language.fit(documents(spark, changed))
    assert sorted(language.fit(documents(spark, rows))) == sorted(WORDS)


def test_copies_count_once(spark):
    rows = corpus()
    copies = [(9000 + i, rows[0][1], rows[0][2], "s") for i in range(300)]
    assert language.fit(documents(spark, rows + copies), texts_per_language=1000)["de"] == language.fit(
        documents(spark, [*rows, copies[0], *copies[:9]]), texts_per_language=1000
    )["de"]


def test_predictions_and_awkward_rows(spark):
    known = language.fit(documents(spark, corpus()))
    frame = documents(spark, AWKWARD + [(50, "DER!! DIE!! UND!! DAS!! NICHT!!", "en", "s")])
    frame = frame.selectExpr("*", "'mine' as lang_pred", "9 as other")
    rows = language.predict(frame, known).collect()
    assert len(rows) == len(AWKWARD) + 1
    by = {r.doc_id: r for r in rows}
    assert by[50].lang_pred == "de" and by[50].other == 9 and not by[50].rejected
    for i in (1, 2, 3):
        assert (by[i].lang_pred, by[i].score, by[i].rejected) == ("und", 0.0, True)
    assert all(0 <= r.score <= 1 and (r.lang_pred in WORDS or r.rejected) for r in rows)
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id == 5}) == 1
    assert language.predict(frame.limit(0), known).collect() == []
    assert {r.lang_pred for r in language.predict(frame, {}).collect()} == {"und"}
    assert language.fit(frame.limit(0)) == {}


def plain(text, dictionaries):
    """(lang_pred, rejected) by category, one encoder at a time."""
    said = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower()).split()
    said = [w for i, w in enumerate(said) if not i or w != said[i - 1]]
    if not said:
        return "und", True
    raw = f" {' '.join(said)} ".encode()
    while len(raw) < 256:
        raw = raw + f" {' '.join(said)} ".encode()
    sizes = []
    for lang in sorted(dictionaries):
        content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        encoder = zstandard.ZstdCompressor(level=9, dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False)
        blocks = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
        sizes.append((sum(len(encoder.compress(b)) for b in blocks), lang))
    (first, lang), (second, _) = sorted(sizes)[:2]
    return lang, second - first < 0.005 * first


def test_equals_a_plain_prediction(spark):
    """Predictions and rejections of whole texts, by another reading of letters and another way to encode."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = language.fit(docs)
    odd = ["²", "½ ① Ⅷ", "x²y", "Ⅷ und ½ der", "ªº", "__der__", "3rd 4th", "e\u0301te\u0301", "中文和字母", "der²die"]
    frame = docs.select("doc_id", "text").union(documents(spark, [(-i, t) for i, t in enumerate(odd, 1)]).select("doc_id", "text"))
    rows = language.predict(frame, known).collect()
    assert [(r.lang_pred, r.rejected) for r in rows] == [plain(r.text, known) for r in rows]
    by = {r.doc_id: r.lang_pred for r in rows}
    assert by[-1] == by[-2] == "und" and by[-3] != "und"


def test_ties_and_margins():
    assert language.decide([90, 90, 95], ["b", "a", "c"])[0::2] == ("a", True)
    assert language.decide([1000, 1100], ["a", "b"])[0::2] == ("a", False)
    assert language.decide([1000, 1002], ["a", "b"])[2]
    assert language.decide([50], ["a"])[1:] == (1.0, False)


def test_accepted_keeps_rows_and_columns(spark):
    known = language.fit(documents(spark, corpus()))
    rows = [*AWKWARD, (50, "der die und das nicht mit sich auf", None)]
    frame = documents(spark, rows).selectExpr("*", "'mine' as lang_pred")
    kept = language.accepted(frame, known)
    rejected = {r.doc_id for r in language.predict(frame, known).where("rejected").collect()}
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - rejected and 50 not in rejected
    assert {r.lang_pred for r in kept.collect()} == {"mine"}


def test_held_out_accuracy(spark):
    folder = SF.replace("0.001", "0.01")
    true = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = [r for r in queries.QUERIES["op4_compression_language"](spark, folder).collect() if r.held_out]
    assert {r.doc_id for r in rows} == {i for i in true if held_out(i)}
    assert sum(true[r.doc_id] == r.lang_pred for r in rows) > 0.97 * len(rows)
