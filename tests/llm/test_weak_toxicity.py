import random

import numpy as np

from claimlens.llm import queries
from claimlens.llm import weak_toxicity as toxicity
from tests.llm.frames import AWKWARD, SF, documents, held_out

CLEAN = "river stone market winter garden letter simple morning paper window yellow basket".split()
TOXIC = "grublik snarfwat plonkish".split()


def corpus(n=600, seed=5):
    rng, rows, labels = random.Random(seed), [], []
    for i in range(n):
        words = [rng.choice(CLEAN) + rng.choice(["", "s", "ly", "er", "ing"]) for _ in range(rng.randint(20, 60))]
        bad = i % 6 == 0
        for _ in range(3 if bad else 0):
            words.insert(rng.randint(1, len(words) - 1), rng.choice(TOXIC))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(bad)))
    return rows, labels


def tables(spark, rows, labels):
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_finds_planted_words_on_held_out_rows(spark):
    rows, labels = corpus()
    docs, marks = tables(spark, rows, labels)
    model = toxicity.fit(docs, marks)
    assert set(TOXIC) <= set().union(*model.lists.words)
    found = {r.doc_id: r for r in toxicity.predict(docs, model, keep=["doc_id"]).collect()}
    for i, _, bad in labels:
        if held_out(i):
            assert found[i].predicted == bad == int(found[i].score >= 0.7)


def test_learns_nothing_from_held_out_labels(spark):
    rows, labels = corpus()
    wrong = [(i, q, 1 - t if held_out(i) else t) for i, q, t in labels]
    first, second = (toxicity.fit(*tables(spark, rows, marks)) for marks in (labels, wrong))
    assert first.lists == second.lists and np.allclose(first.weights, second.weights)


def test_words_of_many_copies_are_not_put_on_lists(spark):
    rows, labels = corpus()
    copy = "harmless unrelated sentence about nothing that everyone has copied many times over already"
    rows += [(5000 + i, copy, "en", "s") for i in range(200)]
    labels += [(5000 + i, 1, 1) for i in range(200)]
    listed = set().union(*toxicity.fit(*tables(spark, rows, labels)).lists.words)
    assert set(TOXIC) <= listed and not listed & set(copy.split())


def test_awkward_rows(spark):
    rows, labels = corpus()
    docs, marks = tables(spark, rows, [*labels, (None, 1, 1), (1, 1, None), (2, None, 0)])
    model = toxicity.fit(docs, marks)
    frame = documents(spark, AWKWARD).selectExpr("*", "'mine' as score")
    found = toxicity.predict(frame, model).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == 0 for r in found)
    assert {r.score for r in found if r.doc_id in (1, 2)} == {next(r.score for r in found if r.doc_id == 3)}
    kept = toxicity.accepted(frame, model)
    assert kept.columns == frame.columns and kept.count() == len(AWKWARD)
    assert toxicity.predict(frame.limit(0), model).collect() == []


def plain_score(model, text):
    """The classifier's score by counting words one by one."""
    words = [w for w in "".join(c if c.isalnum() and not c.isdecimal() else " " for c in text).split()]
    n = max(1, len(words))
    hits = [sum(w.lower() in entries for w in words) for entries in model.lists.words]
    hits += [sum(w.lower()[:k] in entries for w in words) for k, entries in zip(toxicity.BEGINNINGS, model.lists.beginnings, strict=True)]
    x = [*np.log1p(hits), *(float(h > 0) for h in hits)]
    x += [sum(len(w) > 1 and w.isupper() for w in words) / n, text.count("!") / max(1, len(text)), float(bool(words))]
    return 1 / (1 + np.exp(-(np.dot(model.weights[:-1], x) + model.weights[-1])))


def test_equals_a_plain_score(spark):
    rows, labels = corpus()
    model = toxicity.fit(*tables(spark, rows, labels))
    texts = [t for _, t, _, _ in rows[:80]] + ["", "GRUBLIK!!! you", "!", "a1b grublik2 snarfwat", "Plonkish " * 3000, "..."]
    found = toxicity.predict(documents(spark, list(enumerate(texts))), model).collect()
    for r in found:
        score = plain_score(model, texts[r.doc_id])
        assert abs(r.score - score) < 1e-9 and r.predicted == int(score >= 0.7)


def test_a_doc_id_of_many_rows_is_one_document(spark):
    """Neither lists nor classifier change when a labelled doc_id has many rows more."""
    rows, labels = corpus()
    first = next(i for i, _, bad in labels if bad and not held_out(i))
    more = [(first, f"{rows[first][1]} {i}" if i % 2 else rows[first][1], "en", "s") for i in range(400)]
    docs, marks = tables(spark, rows + more, labels)
    assert toxicity.labelled_sample(docs, marks, 10_000).count() == sum(not held_out(i) for i, _, _ in labels)
    assert toxicity.draw_up_lists(toxicity.labelled_sample(docs, marks, 10_000))[0].words


def test_no_labels_and_no_documents(spark):
    docs, marks = tables(spark, *corpus(30))
    for model in (toxicity.fit(docs, marks.limit(0)), toxicity.fit(docs.limit(0), marks)):
        assert all(0 <= r.score <= 1 for r in toxicity.predict(docs, model).collect())


def test_label_model_recovers_what_voters_find():
    """Voters as the lists are: each finds some of the toxic texts, and hardly ever a clean one."""
    rng = np.random.default_rng(3)
    hidden = rng.random(20_000) < 0.2
    finds = [0.5, 0.6, 0.7, 0.8, 0.65, 0.75, 0.55]
    hit = np.stack([np.where(hidden, rng.random(20_000) < r, rng.random(20_000) < 0.004) for r in finds], 1)
    votes = np.hstack([np.where(hit, 1, -1), np.zeros((20_000, toxicity.VOTERS - 7), int)]).astype(int)
    kinds, counts = np.unique(votes, axis=0, return_counts=True)
    model = toxicity.fit_label_model(kinds, counts.astype(float), 0.2)
    assert abs(model.prior - 0.2) < 0.03
    assert np.abs(model.given[1, :7, 2] - finds).max() < 0.08
    assert ((model.posterior(votes) > 0.5) == hidden).mean() > 0.98


def test_voters_that_repeat_another_count_for_less():
    rng = np.random.default_rng(4)
    votes = np.where(rng.random((5000, toxicity.VOTERS)) < 0.3, 1, -1)
    votes[:, 1] = votes[:, 0]
    kinds, counts = np.unique(votes, axis=0, return_counts=True)
    weights = toxicity.fit_label_model(kinds, counts.astype(float), 0.3).weights
    assert weights[0] < 0.75 * weights[2:].max()


def test_held_out_accuracy(spark):
    folder = SF.replace("0.001", "0.1")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op6_weak_toxicity"](spark, folder).collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in rows) > 0.95 * len(rows)
