"""Small tables: documents with every awkward case, and the whole small tables of the given data."""

from zlib import crc32

SF = "/root/testdata/sf0.001"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows):
    """Rows of (doc_id, text[, lang[, source]])."""
    full = [(*r, *[None] * (4 - len(r)), None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


AWKWARD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \t\n ", "en", "a"),
    (4, "one", "en", None),
    (5, "one", "en", None),
    (5, "one", "en", None),
    (None, "one two three four five", None, "a"),
    (6, "word " * 60_000, "en", "a"),
    (7, "x" * 100_000, None, "b"),
    (8, "a\x00b <|endoftext|> 中文 \U0001f600 é", "fr", "b"),
]


def held_out(doc_id):
    return doc_id is not None and crc32(str(doc_id).encode()) % 3 == 1
