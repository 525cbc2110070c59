"""Toxicity by weak supervision.

Voters: word lists, word-beginning lists and surface patterns, each of which calls a text toxic, clean, or
abstains. A generative model of the voters (a hidden class, each voter's accuracy given the class,
and the correlations of voters within a class) is fitted to the counts of vote vectors over all
training documents. Its posterior labels train a linear classifier on the voters' hit counts, which
scores any text.

Labels (rows that are not held out only) are used to draw up the lists and for the share of toxic
documents. The votes that the generative model sees are those of all training rows, labelled or not.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log1p
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.llm.common import held_out, text_or_empty
from claimlens.session import stage

# The lists are drawn up from so many labelled rows of each class, at most, those of lowest hash.
LABELLED_PER_CLASS = 10_000
# An entry of a list has this many toxic documents at least, and a share of toxic ones (in rates, so
# that the classes' sizes do not matter) of this at least.
ENTRY_DOCUMENTS = 5
ENTRY_SHARE = 0.99
# Its toxic documents hold it between so many different neighbours at least, and as a share of them:
# the words of one text that has many copies keep their neighbours, whatever the number of copies.
ENTRY_PLACES = 5
ENTRY_PLACES_SHARE = 0.5
CANDIDATES = 50_000  # entries of a list family whose places are counted, the most frequent
ENTRIES = 4000  # of a list family, the strongest
WORD_LISTS = 4
BEGINNINGS = (4, 5, 6)
REJECTED_FROM = 0.7

_WORD = re.compile(r"[^\W\d_]+")
# A worker remembers the lists that a word is on; it forgets all when it knows so many words.
_REMEMBERED = 200_000


@dataclass
class Lists:
    """Entries of each list voter: whole words for the first WORD_LISTS, then beginnings by length."""

    words: list[frozenset[str]] = field(default_factory=lambda: [frozenset()] * WORD_LISTS)
    beginnings: list[frozenset[str]] = field(default_factory=lambda: [frozenset()] * len(BEGINNINGS))

    @property
    def size(self) -> int:
        return len(self.words) + len(self.beginnings)


PATTERNS = 3  # shouting, exclamation marks, few words that are on no list
VOTERS = WORD_LISTS + len(BEGINNINGS) + PATTERNS


def labelled_sample(documents: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(text, toxic): training documents with a label, at most ``per_class`` of each; a document with
    several labels counts as toxic if one of them says so, one with several rows has one text."""
    rows = labels.where(~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = rows.withColumn("hash", F.xxhash64("doc_id"))
    # Half as many again as wanted lie below these hashes: only they are ranked, however many labels there are.
    low = F.lit(False)
    for row in rows.groupBy("toxic").count().collect():
        share = min(1.0, 1.5 * per_class / row["count"])
        below = 2**63 - 1 if share == 1.0 else int(-(2**63) + share * 2**64)
        low = low | ((F.col("toxic") == row["toxic"]) & (F.col("hash") <= F.lit(below)))
    lowest = Window.partitionBy("toxic").orderBy("hash", "doc_id")
    rows = rows.where(low).withColumn("place", F.row_number().over(lowest)).where(F.col("place") <= per_class)
    # Bounded by 2 * per_class rows of two numbers.
    found = documents.select("doc_id", text_or_empty().alias("text")).join(
        F.broadcast(rows.select("doc_id", "toxic")), "doc_id"
    )
    # Of the rows of one doc_id the text of lowest hash, so that the sample has no more rows than labels.
    lowest = F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")
    return found.groupBy("doc_id", "toxic").agg(lowest).select("text", "toxic")


def entries_of(words: list[str]) -> dict[tuple[int, str], int]:
    """What a text's words could put on the lists, (0, word) and (length, beginning), each with a
    hash of its first occurrence's neighbours."""
    found: dict[tuple[int, str], int] = {}
    for i, word in enumerate(words):
        if (0, word) not in found:
            place = crc32(f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}".encode())
            found[0, word] = place
            for n in BEGINNINGS:
                if len(word) >= n:
                    found.setdefault((n, word[:n]), place)
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, entry, toxic, clean): partial counts of the documents that hold an entry."""
    counts: dict[tuple[int, str], list[int]] = {}

    def flush():
        return pa.record_batch(
            [
                pa.array([k[0] for k in counts], pa.int32()),
                pa.array([k[1] for k in counts], pa.string()),
                pa.array([c[1] for c in counts.values()], pa.int64()),
                pa.array([c[0] for c in counts.values()], pa.int64()),
            ],
            ["kind", "entry", "toxic", "clean"],
        )

    for batch in batches:
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for key in entries_of(_WORD.findall(text.lower())):
                counts.setdefault(key, [0, 0])[label] += 1
        if len(counts) > 300_000:
            yield flush()
            counts.clear()
    yield flush()


def draw_up_lists(sample: DataFrame) -> tuple[Lists, float]:
    """The lists, and the share of toxic rows in the sample (0.5 if it has but one class)."""
    totals = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return Lists(), 0.5
    counts = sample.select("text", "toxic").mapInArrow(_counted, "kind int, entry string, toxic bigint, clean bigint")
    counts = counts.groupBy("kind", "entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    rate1, rate0 = F.col("toxic") / n1, F.col("clean") / n0
    strong = counts.where((F.col("toxic") >= ENTRY_DOCUMENTS) & (rate1 / (rate1 + rate0) >= ENTRY_SHARE))
    most = Window.partitionBy("kind").orderBy(F.desc("toxic"), "entry")
    strong = strong.withColumn("rank", F.row_number().over(most)).where(F.col("rank") <= CANDIDATES)
    candidates = {(r["kind"], r["entry"]): r["toxic"] for r in strong.collect()}
    shared = sample.sparkSession.sparkContext.broadcast(frozenset(candidates))  # bounded by CANDIDATES

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        for batch in batches:
            rows = [
                (*key, place)
                for text in batch.column(0).to_pylist()
                for key, place in entries_of(_WORD.findall(text.lower())).items()
                if key in wanted
            ]
            yield pa.record_batch(
                [
                    pa.array([r[0] for r in rows], pa.int32()),
                    pa.array([r[1] for r in rows], pa.string()),
                    pa.array([r[2] for r in rows], pa.int64()),
                ],
                ["kind", "entry", "place"],
            )

    places = sample.where("toxic = 1").select("text").mapInArrow(placed, "kind int, entry string, place bigint")
    places = places.distinct().groupBy("kind", "entry").agg(F.count(F.lit(1)).alias("places"))
    kept = [
        (r["kind"], r["entry"], r["places"])
        for r in places.where(F.col("places") >= ENTRY_PLACES).collect()
        if r["places"] >= ENTRY_PLACES_SHARE * candidates[r["kind"], r["entry"]]
    ]
    ranked = {n: sorted((-p, e) for k, e, p in kept if k == n)[:ENTRIES] for n in (0, *BEGINNINGS)}
    return (
        Lists(
            [frozenset(e for _, e in ranked[0][k::WORD_LISTS]) for k in range(WORD_LISTS)],
            [frozenset(e for _, e in ranked[n]) for n in BEGINNINGS],
        ),
        n1 / (n1 + n0),
    )


class Voters:
    def __init__(self, lists: Lists):
        self._lists = lists
        self._known: dict[str, tuple[int, ...]] = {}

    def _on(self, word: str) -> tuple[int, ...]:
        """The list voters that the word is a hit for; then one more, if it is all capitals."""
        low = word.lower()
        on = [k for k, entries in enumerate(self._lists.words) if low in entries]
        at = len(self._lists.words)
        on += [at + k for k, n in enumerate(BEGINNINGS) if low[:n] in self._lists.beginnings[k]]
        if len(word) > 1 and word.isupper():
            on.append(self._lists.size)
        if len(self._known) >= _REMEMBERED:
            self._known.clear()
        self._known[word] = tuple(on)
        return self._known[word]

    def features(self, text: str) -> list[float]:
        """The linear classifier's input: log hits of each list, whether it has one, then the patterns:
        share of words in capitals, of exclamation marks in the text, and whether it has a word."""
        counts, known = [0] * (self._lists.size + 1), self._known
        words = _WORD.findall(text)
        for word in words:
            on = known.get(word)
            if on is None:
                on = self._on(word)
            for k in on:
                counts[k] += 1
        n, upper = max(1, len(words)), counts.pop()
        return [
            *(log1p(c) for c in counts),
            *(float(c > 0) for c in counts),
            upper / n,
            text.count("!") / max(1, len(text)),
            float(bool(words)),
        ]

    def votes(self, features: list[float]) -> list[int]:
        """1 toxic, -1 clean, 0 abstains. A list calls a text clean when no word is on it."""
        k = self._lists.size
        lists = [1 if f > 0 else -1 for f in features[:k]]
        shouting = 1 if features[2 * k] > 0.8 else 0
        exclaiming = 1 if features[2 * k + 1] > 0.02 else 0
        unlisted = -1 if features[2 * k + 2] and not any(f > 0 for f in features[:k]) else 0
        return [*lists, shouting, exclaiming, unlisted]


@dataclass
class LabelModel:
    """Posterior of the hidden class given a vote vector.

    ``given[c][j][v]``: the probability of vote v - 1 of voter j in class c (its accuracy).
    ``correlations``: of the votes within a class; a voter that says what others say counts for less:
    its evidence is divided by the sum of its absolute correlations, its own 1 included.
    """

    prior: float
    given: np.ndarray
    correlations: np.ndarray

    @property
    def weights(self) -> np.ndarray:
        return 1 / np.abs(self.correlations).sum(1)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        evidence = np.log(self.given[1]) - np.log(self.given[0])
        each = np.take_along_axis(evidence[None], (votes + 1)[:, :, None], axis=2)[:, :, 0]
        odds = each @ self.weights + np.log(self.prior) - np.log1p(-self.prior)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def fit_label_model(votes: np.ndarray, counts: np.ndarray, prior: float, rounds: int = 30) -> LabelModel:
    """Expectation maximisation over the counts of vote vectors, from a start where the lists are
    right more often than not. Accuracies and within-class correlations are re-estimated each round."""
    prior = min(max(prior, 0.001), 0.999)
    n, width = votes.shape
    start = votes[:, : WORD_LISTS + len(BEGINNINGS)].max(1) > 0 if n else np.zeros(0, bool)
    belief = np.where(start, 0.9, 0.1 * prior)
    model = LabelModel(prior, np.full((2, width, 3), 1 / 3), np.eye(width))
    for _ in range(rounds if n else 0):
        given, spread = np.empty((2, width, 3)), np.zeros((width, width))
        for c, share in ((0, 1 - belief), (1, belief)):
            weight = share * counts
            for v in (-1, 0, 1):
                given[c, :, v + 1] = weight @ (votes == v) + 0.5
            given[c] /= given[c].sum(1, keepdims=True)
            centred = votes - (weight @ votes) / max(weight.sum(), 1e-9)
            spread += (centred * weight[:, None]).T @ centred
        deviation = np.sqrt(np.clip(np.diag(spread), 1e-9, None))
        correlations = spread / deviation[:, None] / deviation[None]
        np.fill_diagonal(correlations, 1.0)
        share = float((belief * counts).sum() / counts.sum())
        model = LabelModel(min(max(share, 1e-4), 1 - 1e-4), given, np.clip(correlations, -1, 1))
        belief = model.posterior(votes)
    return model


def fit_linear(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 60, ridge: float = 1e-5) -> np.ndarray:
    """Weights (the last is the constant) of a logistic regression on soft labels, by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    weight = weight / max(weight.sum(), 1e-9)
    weights = np.zeros(x.shape[1])
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * weights
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


@dataclass
class Model:
    lists: Lists
    labels: LabelModel
    weights: np.ndarray

    def score(self, voters: Voters, text: str) -> float:
        odds = float(np.dot(self.weights[:-1], voters.features(text)) + self.weights[-1])
        return 1 / (1 + exp(-min(max(odds, -500.0), 500.0)))


def fit(documents: DataFrame, labels: DataFrame, per_class: int = LABELLED_PER_CLASS) -> Model:
    """The lists and the classifier's rows come from the bounded sample of labelled training rows; the
    label model from the votes on all training rows. The classifier learns the label model's
    posteriors, not the labels; a row weighs as much as the training rows of its vote per sampled one."""
    sample = stage(labelled_sample(documents, labels, per_class), "toxicity-sample")
    lists, prior = draw_up_lists(sample)
    shared = documents.sparkSession.sparkContext.broadcast(lists)  # bounded by ENTRIES

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters, seen = Voters(shared.value), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen[tuple(voters.votes(voters.features(text)))] += 1
        yield pa.record_batch(
            [pa.array(list(seen), pa.list_(pa.int32())), pa.array(list(seen.values()), pa.int64())], ["votes", "n"]
        )

    def feature(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(shared.value)
        for batch in batches:
            rows = [voters.features(text) for text in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(rows, pa.list_(pa.float64()))], ["features"])

    train = documents.where(~held_out()).select(text_or_empty().alias("text"))
    # At most 3^VOTERS rows whatever the corpus holds, since each list says toxic or clean only: 2^7 * 2 * 2.
    seen = train.mapInArrow(vote, "votes array<int>, n bigint").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    seen = sorted((tuple(r["votes"]), r["n"]) for r in seen)
    votes = np.array([v for v, _ in seen], int).reshape(len(seen), VOTERS)
    counts = np.array([n for _, n in seen], float)
    model = fit_label_model(votes, counts, prior)
    # Bounded: 2 * per_class rows of a few numbers.
    rows = sorted(tuple(r["features"]) for r in sample.select("text").mapInArrow(feature, "features array<double>").collect())
    x = np.array(rows, float).reshape(len(rows), 2 * lists.size + PATTERNS)
    own = [tuple(Voters(lists).votes(list(r))) for r in rows]
    drawn, total = Counter(own), dict(seen)
    y = model.posterior(np.array(own, int).reshape(len(own), VOTERS))
    weight = np.array([total.get(v, 0) / drawn[v] for v in own], float)
    return Model(lists, model, fit_linear(x, y, weight))


def predict(documents: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default), then score and predicted (1 from ``REJECTED_FROM`` on).

    A null text counts as empty; empty texts and texts without a word get the score of a text without
    any hit. Repeated rows get the same score; columns named score or predicted are replaced.
    """
    keep = [c for c in (documents.columns if keep is None else keep) if c not in ("score", "predicted")]
    shared = documents.sparkSession.sparkContext.broadcast(model)  # lists bounded by ENTRIES

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        voters = Voters(known.lists)
        for batch in batches:
            scores = [known.score(voters, t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.record_batch(
                [
                    *batch.columns[:-1],
                    pa.array(scores, pa.float64()),
                    pa.array([int(s >= REJECTED_FROM) for s in scores], pa.int32()),
                ],
                [*batch.schema.names[:-1], "score", "predicted"],
            )

    schema = T.StructType([documents.schema[c] for c in keep]).add("score", "double").add("predicted", "integer")
    source = documents.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(text).alias("__text"))
    return source.mapInArrow(score, schema)


def accepted(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose score is below ``REJECTED_FROM``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # lists bounded by ENTRIES
    place = documents.columns.index(text)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        voters = Voters(known.lists)
        for batch in batches:
            texts = batch.column(place).to_pylist()
            yield batch.filter(pa.array([known.score(voters, t or "") < REJECTED_FROM for t in texts], pa.bool_()))

    return documents.mapInArrow(keep, documents.schema)
