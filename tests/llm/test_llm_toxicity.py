import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chaintally.llm import toxicity as tx

BAD = ["rotten", "vile", "nasty"]
WORDS = [a + b + c for a in "bdfgklmp" for b in ("a", "e", "i", "o", "u") for c in ("na", "re", "to", "li", "su", "ka", "mo", "pe", "x", "nd")]


def make(n, rng):
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(WORDS[rng.randrange(400)] for _ in range(8)) for _ in range(rng.randint(2, 30))]
        toxic = int(i % 4 == 0)
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] = sentences[k] + " " + rng.choice(BAD) + "### here"
        rows.append((i, ". ".join(sentences) + ".", "x"))
        labels.append((i, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = make(400, random.Random(1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic_score string")
    marks = spark.createDataFrame(labels + [(3, None), (10_000, 1)], "doc_id long, toxic int")
    return docs, labels, tx.learn(docs, marks, F.col("doc_id") % 5 != 0)


def test_held_out_documents_and_offenders(learned):
    docs, labels, model = learned
    got = {r.doc_id: r for r in tx.score(docs, model).where("doc_id % 5 = 0").collect()}
    assert all((r.toxic_score >= 0.5) == bool(labels[i][1]) for i, r in got.items())
    for i, r in got.items():
        if labels[i][1]:
            assert any(any(b in r.text[s.start:s.end] for b in BAD) for s in r.offending)


def test_noisy_or_is_the_chance_of_any():
    z = np.array([-1.0, 0.5, -3.0])
    p = 1 / (1 + np.exp(-z))
    assert tx.noisy_or(z) == pytest.approx(1 - np.prod(1 - p))
    assert tx.noisy_or(np.array([])) == 0


def test_edge_texts(spark, learned):
    rows = [(1, None), (2, ""), (3, "..."), (4, "vile. " * 20_000), (4, "é vile here!! ok"), (None, "w1 w2. w3")]
    got = tx.score(spark.createDataFrame(rows, "doc_id long, text string"), learned[2]).collect()
    assert [r.toxic_score for r in got[:3]] == [0, 0, 0]
    assert got[3].toxic_score > 0.5 and len(got[3].offending) == 20_000
    assert got[4].text[got[4].offending[0].start:got[4].offending[0].end] == "é vile here"
    assert got[5].toxic_score < 0.5


def test_nothing_to_learn_from(spark, learned):
    docs = learned[0]
    none = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, toxic int")
    model = tx.learn(docs, none, F.lit(True))
    assert {r.toxic_score for r in tx.score(docs.limit(4), model).collect()} == {0.0}
    assert tx.score(docs.limit(0), learned[2]).count() == 0
    kept = tx.drop_toxic(docs, none)
    assert kept.columns == docs.columns and kept.count() == 400


def long_rows(n, rng, vile_at):
    """Texts of over 10,000 characters; ``vile_at`` gives the place of the one bad sentence of a toxic one."""
    rows, labels = [], []
    for i in range(n):
        parts = [" ".join(WORDS[rng.randrange(400)] for _ in range(8)) for _ in range(400)]
        if i % 4 == 0:
            parts[vile_at(len(parts))] += " " + rng.choice(BAD) + " here"
        rows.append((i, ". ".join(parts) + "."))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_documents_of_any_length_teach(spark):
    rng = random.Random(3)
    rows, labels = long_rows(120, rng, lambda n: n - 1)
    assert min(len(t) for _, t in rows) > 10_000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = tx.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), F.lit(True))
    fresh, marks = long_rows(40, rng, rng.randrange)
    got = {r.doc_id: r.toxic_score for r in tx.score(spark.createDataFrame(fresh, "doc_id long, text string"), model).collect()}
    assert {i: int(s >= 0.5) for i, s in got.items()} == dict(marks)


def test_a_sentence_counts_as_often_as_it_stands():
    rng = random.Random(4)
    rows, labels = make(80, rng)
    again = [(i, (text + " ") * 3) for i, text, _ in rows]
    whole = tx.train([(t.encode(), y) for (_, t), (_, y) in zip(again, labels)])
    bags = [tx.bag_of(t.encode(), {}) for _, t in again]
    assert all((b.times % 3 == 0).all() for b in bags)
    thin = [tx.thinned(b, int(b.words.sum()) - 1) for b in bags]
    assert all(t.times.sum() == pytest.approx(b.times.sum()) and len(t.sizes) == len(b.sizes) - 1 or len(b.sizes) == 1
               for t, b in zip(thin, bags))
    assert all(t.features.size == t.sizes.sum() for t in thin)
    assert np.isfinite(whole[2])


def test_words_limit_fills_the_total():
    sizes = np.array([5, 100, 20, 7])
    assert tx.words_limit(sizes, 132) == 100 and tx.words_limit(sizes, 62) == 30
    assert tx.words_limit(np.array([9, 9]), 10) == 5 and tx.words_limit(np.array([], dtype=int), 5) == 0


def test_sentences_of_unseen_words_do_not_add_up(spark, learned):
    unseen = ". ".join(f"zq{i} vvk{i}" for i in range(50_000))
    docs = spark.createDataFrame([(1, unseen), (3, unseen + ". vile here")], "doc_id long, text string")
    got = {r.doc_id: r for r in tx.score(docs, learned[2]).collect()}
    assert got[1].toxic_score == 0
    assert got[3].toxic_score >= 0.5 and len(got[3].offending) == 1


def test_small_probabilities_do_not_add_up(spark, learned):
    """Long texts of sentences of clean held-out documents stay clean; one bad sentence among them is found."""
    docs, labels, model = learned
    assert np.isfinite(model.floor)
    rng = random.Random(9)
    clean = [s for r in docs.where("doc_id % 5 = 0").collect() if not labels[r.doc_id][1] for s in r.text.split(".") if s.strip()]
    texts = [". ".join(rng.choices(clean, k=10_000)) for _ in range(5)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(10 + k, t + ". you vile here") for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in tx.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all(got[k].toxic_score < 0.5 for k in range(5)) and all(got[10 + k].toxic_score >= 0.5 for k in range(5))


def test_floor_loses_hardly_a_toxic_document():
    z = np.array([2.0, -1.6, -1.6, -1.6, -1.6, -6.0])
    bag, times = np.array([0, 1, 1, 1, 1, 2]), np.ones(6)
    # the second document needs its four sentences of 0.17
    assert tx.learned_floor(z, bag, times, np.array([1.0, 1.0, 0.0])) == pytest.approx(np.log(0.15 / 0.85))
    assert tx.learned_floor(z, bag, times, np.array([1.0, 0.0, 0.0])) == pytest.approx(np.log(0.2 / 0.8))
    assert tx.bag_score(z[1:5], 0.0) == pytest.approx(1 / (1 + np.exp(1.6))) and tx.bag_score(np.array([]), 0.0) == 0
