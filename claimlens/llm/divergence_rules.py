"""Quality rules by distribution divergence, in DataFrame functions alone.

A document's histograms of character classes and of common words are compared with those of every
language of the corpus by the Jensen-Shannon distance (square root of the divergence in bits: 0 for
equal histograms, 1 for disjoint ones). A document that is far from all languages is rejected. Short
documents, whose histograms say little, are not judged by distance.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import text_or_empty

BASE_WORDS = 20
BASE_REPEAT_PERCENT = 30
RUN = 8  # words of a window that counts as repeated
COMMON_WORDS = 32  # of each language
JUDGED_WORDS = 50  # no distance is judged below
CHAR_DISTANCE = 0.26
WORD_DISTANCE = 0.425

_SPACE = r"[\x20\x09-\x0D]+"
# Removed from a text one after the other: what a step takes away is a class's count. What is left
# at the end is one more class.
_CLASSES = {"lower": r"\p{Ll}+", "space": _SPACE, "mark": r"\p{P}+", "upper": r"\p{Lu}+", "digit": r"\p{N}+"}


_PLACE = {name: i for i, name in enumerate(_CLASSES)}


@dataclass
class Reference:
    """A language's shares of the character classes, and of its common words among its words."""

    classes: list[float]
    words: dict[str, float]


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where a lambda in it uses it again and again."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def letter_words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def repeated_words(words: Column, run: int = RUN) -> Column:
    """How many words lie in a window of ``run`` words that the text holds twice or more.

    Windows are told apart by 64-bit hashes of their words' hashes: a window's is made of those of two
    shorter ones, so that each step looks at two numbers a word."""

    def covered(positions: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))

        def step(state, p):
            new = F.lit(run) - F.greatest(F.lit(0), state["end"] - p)
            return F.struct((state["n"] + new).alias("n"), (p + run).alias("end"))

        return F.aggregate(positions, start, step, lambda state: state["n"])

    def repeats(windows: Column) -> Column:
        placed = F.array_sort(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))

        def positions(ordered: Column) -> Column:
            last = F.size(ordered) - 1
            held = F.filter(
                ordered,
                lambda s, k: ((k > 0) & (F.get(ordered, k - 1)["w"] == s["w"]))
                | ((k < last) & (F.get(ordered, k + 1)["w"] == s["w"])),
            )
            return F.array_sort(F.transform(held, lambda s: s["i"]))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(
            covered(let(placed, positions))
        )

    def windows(hashes: Column, made: int, left: int, body) -> Column:
        """``body`` of the hashes of windows of made + left words, from those of ``made`` words."""
        if not left:
            return body(hashes)
        step = min(made, left)
        n = F.size(hashes) - step
        pairs = F.zip_with(
            F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(step + 1), n), lambda a, b: F.xxhash64(a, b)
        )
        return let(pairs, lambda h: windows(h, made + step, left - step, body))

    found = let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: windows(h, 1, run - 1, repeats))
    return F.when(F.size(words) < run, 0).otherwise(found).cast("bigint")


def with_base(documents: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, the text (null: empty) as __text, its words as __words, its numbers of characters as __shape, and
    the base columns."""
    rows = documents.select(*keep, text_or_empty(text).alias("__text"))
    rows = rows.withColumns({"__words": words_of(F.col("__text")), "__shape": shape(F.col("__text"))})
    lines = F.filter(F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns(
        {
            "n_words": F.size("__words").cast("bigint"),
            "word_chars": (F.length("__text") - F.col("__shape")["classes"][_PLACE["space"]]).cast("bigint"),
            "n_symbols": F.col("__shape")["symbols"].cast("bigint"),
            "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint"),
            "n_repeat_words": repeated_words(F.col("__words")),
        }
    )
    failed = (F.col("n_words") < BASE_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed)


def shape(text: Column) -> Column:
    """Of a text's characters: ``classes``, how many are in each class, and ``symbols``, how many are symbols.
    Symbols are looked for in what is left without lower case, most of a text."""

    def step(rest: Column, patterns: list[str], before: list[Column]) -> Column:
        if not patterns:
            return F.array(*before, F.length(rest))
        return let(
            F.regexp_replace(rest, patterns[0], ""),
            lambda less: step(less, patterns[1:], [*before, F.length(rest) - F.length(less)]),
        )

    lower, *others = _CLASSES.values()
    return let(
        F.regexp_replace(text, lower, ""),
        lambda rest: F.struct(
            step(rest, others, [F.length(text) - F.length(rest)]).alias("classes"),
            F.length(F.regexp_replace(rest, r"[^#*$%&|<>]+", "")).alias("symbols"),
        ),
    )


def references(documents: DataFrame, common_words: int = COMMON_WORDS) -> dict[str, Reference]:
    """References by language, over all documents that have a language and ``BASE_WORDS`` words.

    One aggregate over words, in which a document's numbers are a few entries more: a word is letters, so an entry
    that begins with a digit is one of them, its place and its amount. Rows of the numbers and of the common words
    of each language reach the driver."""
    rows = documents.where(F.col("lang").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), text_or_empty().alias("text")
    )
    places = range(len(_CLASSES) + 1)

    def entries(words: Column) -> Column:
        numbers = let(
            shape(F.col("text"))["classes"],
            lambda n: F.array(
                *[F.concat(F.lit(f"{i}"), n[i].cast("string")) for i in places],
                F.concat(F.lit(f"{len(places)}"), F.size(words).cast("string")),
            ),
        )
        return F.when(F.size(words) >= BASE_WORDS, F.concat(words, numbers))

    found = rows.select("lang", F.explode(let(letter_words_of(F.col("text")), entries)).alias("entry"))
    numeric = F.col("entry").between("0", f"{len(places)}~")
    found = found.select(
        "lang",
        numeric.alias("numeric"),
        F.when(numeric, F.substring("entry", 1, 1)).otherwise(F.col("entry")).alias("word"),
        F.when(numeric, F.substring("entry", 2, 20).try_cast("bigint")).otherwise(F.lit(1)).alias("n"),
    )
    counts = found.groupBy("lang", "numeric", "word").agg(F.sum("n").alias("n"))
    most = Window.partitionBy("lang", "numeric").orderBy(F.desc("n"), "word")
    least = max(common_words, len(places) + 1)
    most = counts.withColumn("place", F.row_number().over(most)).where(F.col("place") <= least)
    amounts: dict[str, dict[int, int]] = {}
    common: dict[str, dict[str, int]] = {}
    for row in most.orderBy("lang", "place").collect():
        if row["numeric"]:
            amounts.setdefault(row["lang"], {})[int(row["word"])] = row["n"]
        elif row["place"] <= common_words:
            common.setdefault(row["lang"], {})[row["word"]] = row["n"]
    references = {}
    for lang, n in sorted(amounts.items()):
        classes, total = [float(n[i]) for i in places], n[len(places)]
        shares = {word: c / total for word, c in common.get(lang, {}).items()}
        references[lang] = Reference([c / sum(classes) for c in classes], shares)
    return references


def part(p: Column, q: Column) -> Column:
    """What a bin with shares p and q adds to twice the divergence in bits."""

    def half(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    return half(p, q) + half(q, p)


def distance(twice: Column) -> Column:
    return F.sqrt(F.least(F.lit(1.0), F.greatest(F.lit(0.0), twice / 2)))


def class_distance(shares: Column, reference: Reference) -> Column:
    twice = F.lit(0.0)
    for i, q in enumerate(reference.classes):
        twice = twice + part(shares[i], F.lit(q))
    return distance(twice)


def word_distance(found: Column, reference: Reference) -> Column:
    """``found``: (word, share) of a document's common words, of whatever language. The common words
    of the language are a bin each, all other words one more; a bin that the document lacks adds the
    reference's share (its part of the divergence when p is 0)."""
    shares = F.create_map(*[F.lit(x) for item in reference.words.items() for x in item])
    start = F.struct(F.lit(0.0).alias("twice"), F.lit(0.0).alias("p"), F.lit(0.0).alias("q"))

    def step(state, item):
        q = F.try_element_at(shares, item["word"])
        added = F.struct(
            (state["twice"] + part(item["share"], q)).alias("twice"),
            (state["p"] + item["share"]).alias("p"),
            (state["q"] + q).alias("q"),
        )
        return F.when(q.isNull(), state).otherwise(added)

    total = sum(reference.words.values())

    def close(state):
        rest = part(F.greatest(F.lit(0.0), 1 - state["p"]), F.lit(max(0.0, 1 - total)))
        return distance(state["twice"] + (total - state["q"]) + rest)

    return F.aggregate(found, start, step, close)


def judge(
    documents: DataFrame,
    languages: dict[str, Reference],
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    char_distance: float = CHAR_DISTANCE,
    word_distance_most: float = WORD_DISTANCE,
) -> DataFrame:
    """``keep``, the base columns, char_distance and word_distance (to the nearest language, six digits;
    null where they are not judged) and kept.

    kept is false if base_failed, or if either distance is judged and above its limit. A null text has
    no words (base_failed); without any reference nothing is judged; repeated rows get equal results;
    other columns are not read. A projection: no row moves.
    """
    rows = with_base(documents, text, keep)
    usable = [r for r in languages.values() if r.words]
    judged = F.col("n_words") >= JUDGED_WORDS
    if usable:
        common = sorted({w for r in usable for w in r.words})

        def histogram(words: Column) -> Column:
            return let(
                F.filter(words, lambda w: w.isin(common)),
                lambda held: F.transform(
                    F.array_distinct(held),
                    lambda w: F.struct(
                        w.alias("word"), ((F.size(held) - F.size(F.array_remove(held, w))) / F.size(words)).alias("share")
                    ),
                ),
            )

        shares = F.transform(F.col("__shape")["classes"], lambda c: c / F.length("__text"))
        by_class = let(shares, lambda s: F.array_min(F.array(*[class_distance(s, r) for r in usable])))
        letter_words = letter_words_of(F.col("__text"))
        by_word = let(
            let(letter_words, histogram), lambda f: F.array_min(F.array(*[word_distance(f, r) for r in usable]))
        )
        found = {"char_distance": F.round(by_class, 6), "word_distance": F.round(by_word, 6)}
        rows = rows.withColumns({name: F.when(judged, value) for name, value in found.items()})
    else:
        rows = rows.withColumns({"char_distance": F.lit(None).cast("double"), "word_distance": F.lit(None).cast("double")})
    far = (F.col("char_distance") > char_distance) | (F.col("word_distance") > word_distance_most)
    rows = rows.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))
    return rows.drop("__text", "__words", "__shape")
