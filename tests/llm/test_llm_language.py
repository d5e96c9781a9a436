import random

import pytest
from pyspark.sql import functions as F

from chaintally.llm import language_id as li

PARTS = {"aa": ["the", "ing", "sh", "ou", "er", "and"], "bb": ["ção", "mente", "lla", "os", "que", "rr"], "cc": ["zk", "wy", "sz", "prz", "ć", "ó"]}


def text(lang, rng, n):
    return " ".join("".join(rng.choices(PARTS[lang], k=3)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(i, text(lang, rng, rng.randint(30, 300)), lang, "s", "extra") for i in range(240) for lang in [("aa", "bb", "cc")[i % 3]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string")


def test_held_out_accuracy(docs):
    model = li.learn(docs, F.col("doc_id") % 4 != 0)
    assert sorted(model) == ["aa", "bb", "cc"]
    got = li.identify(docs, model).where("doc_id % 4 = 0").collect()
    assert len(got) == 60 and all(r.lang_pred == r.lang and 0 <= r.score <= 1 and r.accepted for r in got)


def test_undecided_ties_and_long_texts(spark, docs):
    model = li.learn(docs, F.lit(True))
    rng = random.Random(4)
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "x"), (5, text("cc", rng, 30_000)), (5, text("cc", rng, 5)), (None, text("bb", rng, 50))]
    got = li.identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    by = [(r.doc_id, r.lang_pred) for r in got]
    assert by[:3] == [(1, "und"), (2, "und"), (3, "und")] and by[3][1] in model
    assert by[4] == (5, "cc") and by[6] == (None, "bb")
    assert not got[3].accepted  # a tie has no margin


def test_nothing_to_learn_from(spark, docs):
    assert li.learn(docs.limit(0), F.lit(True)) == {}
    assert li.learn(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True)) == {}
    assert {r.lang_pred for r in li.identify(docs.limit(3), {}).collect()} == {"und"}
    assert li.identify(docs.limit(0), li.learn(docs, F.lit(True))).count() == 0


def test_predictions_ignore_labels(docs):
    model = li.learn(docs, F.lit(True))
    other = docs.withColumn("lang", F.lit("aa")).withColumn("source", F.lit("z"))
    a, b = (sorted((r.doc_id, r.lang_pred, r.score) for r in li.identify(d, model).collect()) for d in (docs, other))
    assert a == b


def test_every_language_is_learned(spark, monkeypatch):
    """Three hundred languages, more than one block of compressors: the one with fewest documents is predicted too."""
    rng = random.Random(6)
    stems = {f"l{k:03d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(12)] for k in range(300)}

    def spoken(lang, n):
        return " ".join("".join(rng.choices(stems[lang], k=2)) for _ in range(n))

    rows = [(i, spoken(lang, 60), lang) for i, lang in enumerate(list(stems) + list(stems)[:299])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = li.learn(docs, F.lit(True))
    assert len(model) == 300 and list(model)[-1] == "l299"
    asked = spark.createDataFrame([(k, spoken(lang, 40), lang) for k, lang in enumerate(("l299", "l000", "l150", "l298"))], docs.schema)
    got = [(r.doc_id, r.lang_pred, r.score) for r in li.identify(asked, model).collect()]
    assert [lang for _, lang, _ in got] == ["l299", "l000", "l150", "l298"]
    monkeypatch.setattr(li, "BLOCK", 1000)
    assert [(r.doc_id, r.lang_pred, r.score) for r in li.identify(asked, model).collect()] == got
