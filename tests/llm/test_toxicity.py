import random

import numpy as np
from tables import ODD_TEXTS, clashing, documents, prose

from tidemart.llm import toxicity as tx

LABELS = "doc_id bigint, quality int, toxic int, lang string"


def corpus(n=600):
    rng, texts, toxic = random.Random(3), [], []
    for i in range(n):
        words, bad = prose(i, 40, 3000), i % 5 == 0
        for _ in range(3 if bad else 0):
            words[rng.randrange(40)] = "zorgu" + rng.choice(["", "la", "mi", "to", "ra", "ne", "xi"])
        texts.append(" ".join(words))
        toxic.append(int(bad))
    return texts, toxic


def test_held_out_accuracy(spark):
    texts, toxic = corpus()
    labels = spark.createDataFrame([(i, 1, t, "en") for i, t in enumerate(toxic)], LABELS)
    rows = tx.toxicity_report(clashing(spark, texts), labels).collect()
    held = [r for r in rows if r.held_out]
    assert 60 < len(held) < 180 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert np.mean([r.predicted == toxic[r.doc_id] for r in held]) > 0.97
    kept = tx.without_toxic(clashing(spark, texts), labels)
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {r.doc_id for r in rows if not r.predicted}


def test_labels_of_held_out_rows_do_not_matter(spark):
    texts, toxic = corpus(200)
    docs = documents(spark, texts)
    held = {r.doc_id for r in docs.select("doc_id").where(tx.fold_of() == 0).collect()}
    one = spark.createDataFrame([(i, 1, t, "en") for i, t in enumerate(toxic)], LABELS)
    two = spark.createDataFrame([(i, 1, 1 - t if i in held else t, "fr") for i, t in enumerate(toxic)], LABELS)
    assert held and tx.fit(docs, one).weights == tx.fit(docs, two).weights


def test_odd_rows_and_tables(spark):
    texts, toxic = corpus(200)
    labels = spark.createDataFrame([(i, 1, t, "en") for i, t in enumerate(toxic)] + [(None, 1, 1, "x"), (3, 0, None, "x"), (4, 0, 7, "x")], LABELS)
    rows = tx.toxicity_report(documents(spark, texts + ODD_TEXTS), labels).orderBy("doc_id").collect()[200:]
    assert len({rows[0].score, rows[1].score, rows[2].score}) == 1 and all(r.predicted == 0 for r in rows)
    none = spark.createDataFrame([], LABELS)
    alone = tx.toxicity_report(documents(spark, ["you idiot", "fine", None]), none).orderBy("doc_id").collect()
    assert [r.predicted for r in alone] == [1, 0, 0]
    assert tx.toxicity_report(documents(spark, []), labels).count() == 0


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(0)
    truth = rng.random(6000) < 0.3

    def voter(right, wrong):
        return np.where(np.where(truth, rng.random(6000) < right, rng.random(6000) < wrong), 1, -1)

    voters = [voter(0.9, 0.05), voter(0.8, 0.1), voter(0.85, 0.1), voter(0.7, 0.1)]
    votes = np.stack([*voters, voters[3], voters[3]], 1).astype(np.int8)
    model = tx.fit_label_model(votes, (votes[:, 0] > 0) * 0.8 + 0.1)
    for j, right in enumerate((0.9, 0.8, 0.85)):
        assert abs(model.chances[j, 2, 1] - right) < 0.08
    assert model.correlations[3, 4] > 0.9 and model.weights[3] < 0.5 < model.weights[0]
    assert np.mean((model.posterior(votes) > 0.5) == truth) > 0.93


def test_shouting_counts_the_whole_text():
    calm, loud = "a quiet word " * 10_000, "A LOUD WORD " * 90_000
    assert tx.patterns(calm + loud, frozenset())[tx.PATTERNS.index("shouting")] == 1
    assert tx.patterns(loud[:110_000] + calm * 9, frozenset())[tx.PATTERNS.index("shouting")] == 0
