"""Language identification by compression.

Each language has a zstandard dictionary of raw content: text of that language. A document is encoded
once with each dictionary; the language whose dictionary gives the fewest bytes is the prediction. A
document whose two smallest encodings lie close together is rejected.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.llm.common import held_out, text_or_empty

# The fit's sample: so many texts of a language, so many characters of each; these bound a
# dictionary at 96 KB or so, whatever the corpus holds. Everything else sees whole texts.
TEXTS_PER_LANGUAGE = 96
CHARS_PER_TEXT = 1000
RANKED = 16
LEVEL = 9
# A text is encoded in blocks of so many bytes, so that the dictionary, and not what the text says
# earlier, is what a long text is measured against.
BLOCK_BYTES = 4096
# A text of fewer bytes is said over and over until it has so many: the encoder leaves very short input
# as it is, so that no dictionary would count.
LEAST_BYTES = 256
# Rejected: the runner-up needs less than this share more bytes than the winner.
NARROW = 0.005
UNDETERMINED = "und"

_WORD = re.compile(r"[^\W\d_]+")


def letters(text: str) -> str:
    """What is encoded: a text's words in lower case, a word said again at once left out. Capitals,
    marks and repetition say nothing of the language, but change sizes."""
    words = _WORD.findall(text.lower())
    # Signs that count as alphanumeric and are no letters (superscripts, fractions, Roman numerals) divide words.
    if not all(map(str.isalpha, words)):
        words = "".join(c if c.isalpha() else " " for c in " ".join(words)).split()
    kept = [word for i, word in enumerate(words) if i == 0 or word != words[i - 1]]
    return f" {' '.join(kept)} " if kept else ""


def fit(
    documents: DataFrame,
    texts_per_language: int = TEXTS_PER_LANGUAGE,
    chars_per_text: int = CHARS_PER_TEXT,
) -> dict[str, bytes]:
    """Dictionaries by language, from rows that are not held out and have a language and a letter.

    The sample of a language is its distinct texts of lowest hash, so copies count once, and the same
    rows give the same dictionaries however they are partitioned. Only the chosen texts' first
    ``chars_per_text`` characters reach the driver.
    """
    known = documents.where(~held_out() & F.col("lang").isNotNull())
    sizes = known.groupBy(F.col("lang").cast("string").alias("lang")).count().collect()  # a row per language
    labelled = known.where(F.col("text").rlike(r"\p{L}")).select(
        F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("hash"), F.col("text").alias("text")
    )
    # Several times as many rows as wanted lie below a language's bound; only they are ranked, in one task.
    for_all = 2**63 - 1
    shares = {r["lang"]: min(1.0, RANKED * texts_per_language / r["count"]) for r in sizes}
    bounds = {lang: for_all if s == 1.0 else int(-(2**63) + s * 2**64) for lang, s in shares.items()}
    if bounds:
        bound = F.try_element_at(F.create_map(*[F.lit(x) for item in bounds.items() for x in item]), F.col("lang"))
        labelled = labelled.where(F.col("hash") <= bound)
    lowest = Window.partitionBy("lang").orderBy("hash")
    chosen = (
        labelled.select("lang", "hash").distinct().withColumn("place", F.row_number().over(lowest))
        .where(F.col("place") <= texts_per_language)
        .select("lang", "hash")
        .collect()
    )
    hashes = sorted({row["hash"] for row in chosen})
    taken = {(row["lang"], row["hash"]) for row in chosen}
    samples: dict[str, dict[int, str]] = {}
    found = labelled.where(F.col("hash").isin(hashes)).groupBy("lang", "hash")
    for row in found.agg(F.min(F.substring("text", 1, chars_per_text)).alias("text")).collect():
        if (row["lang"], row["hash"]) in taken:
            samples.setdefault(row["lang"], {})[row["hash"]] = row["text"]
    return {
        lang: "\n".join(letters(samples[lang][h]) for h in sorted(samples[lang])).encode() for lang in sorted(samples)
    }


class Sizes:
    """Encoded sizes of a text, one for each language."""

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        import zstandard

        self.languages = sorted(dictionaries)
        self._encoders = []
        for lang in self.languages:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            self._encoders.append(
                zstandard.ZstdCompressor(
                    dict_data=content, write_content_size=False, write_checksum=False, write_dict_id=False
                )
            )

    def of(self, words: str) -> list[int]:
        raw = words.encode()
        raw *= max(1, -(-LEAST_BYTES // max(1, len(raw))) if len(raw) < LEAST_BYTES else 1)
        blocks = [raw[i : i + BLOCK_BYTES] for i in range(0, len(raw), BLOCK_BYTES)]
        return [sum(len(encoder.compress(b)) for b in blocks) for encoder in self._encoders]


def decide(sizes: list[int], languages: list[str], narrow: float = NARROW) -> tuple[str, float, bool]:
    """(language, score, rejected); equal sizes go to the first language by name.

    The score is the winner's share when a language's weight is 2^-(bytes more than the winner's, per
    64 of the winner's bytes, eight bits each): 1 when the others are far off, 1/n when all n are equal.
    """
    best = min(range(len(sizes)), key=lambda i: (sizes[i], languages[i]))
    unit = 64 / max(64, sizes[best])
    score = 1 / sum(math.exp2(-min(1000.0, 8 * (s - sizes[best]) * unit)) for s in sizes)
    rest = [s for i, s in enumerate(sizes) if i != best]
    rejected = bool(rest) and min(rest) - sizes[best] < narrow * sizes[best]
    return languages[best], score, rejected


def predict(
    documents: DataFrame,
    dictionaries: dict[str, bytes],
    text: str = "text",
    keep: list[str] | None = None,
    narrow: float = NARROW,
) -> DataFrame:
    """The columns ``keep`` (all by default), then lang_pred, score and rejected.

    Null texts, texts without a letter, and any text if nothing was learned: ``und``, score 0,
    rejected. Repeated rows get the same answer; columns of those three names are replaced.
    """
    new = ["lang_pred", "score", "rejected"]
    keep = [c for c in (documents.columns if keep is None else keep) if c not in new]
    shared = documents.sparkSession.sparkContext.broadcast(dictionaries)  # bounded by the fit's sample

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value)
        for batch in batches:
            answers = []
            for value in batch.column(batch.num_columns - 1).to_pylist():
                words = letters(value)
                if sizes.languages and words:
                    answers.append(decide(sizes.of(words), sizes.languages, narrow))
                else:
                    answers.append((UNDETERMINED, 0.0, True))
            columns = list(batch.columns[:-1])
            columns += [
                pa.array([a[0] for a in answers], pa.string()),
                pa.array([a[1] for a in answers], pa.float64()),
                pa.array([a[2] for a in answers], pa.bool_()),
            ]
            yield pa.record_batch(columns, [*batch.schema.names[:-1], *new])

    schema = T.StructType([documents.schema[c] for c in keep]).add(new[0], "string").add(new[1], "double")
    source = documents.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(text).alias("__text"))
    return source.mapInArrow(classify, schema.add(new[2], "boolean"))


def accepted(documents: DataFrame, dictionaries: dict[str, bytes], text: str = "text", narrow: float = NARROW) -> DataFrame:
    """The rows, with all their columns, that ``predict`` does not reject."""
    shared = documents.sparkSession.sparkContext.broadcast(dictionaries)  # bounded by the fit's sample
    place = documents.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Sizes(shared.value)
        for batch in batches:
            clear = []
            for value in batch.column(place).to_pylist():
                words = letters(value or "") if sizes.languages else ""
                clear.append(bool(words) and not decide(sizes.of(words), sizes.languages, narrow)[2])
            yield batch.filter(pa.array(clear, pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
