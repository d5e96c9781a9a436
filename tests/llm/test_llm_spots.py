import hashlib
import random

import numpy as np
import pytest

from chaintally.llm import spot_signatures as ss

SCHEMA = "doc_id long, text string, part int, own boolean, n int"
ANCHORS = [b"the", b"of", b"and", b"a"]


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "a"]) if rng.random() < 0.3 else f"w{rng.randint(0, 3000)}" for _ in range(n))


def changed(rng, text, share):
    return " ".join(f"x{rng.randint(0, 10 ** 6)}" if rng.random() < share else w for w in text.split())


def jaccard(a, b):
    a, b = set(a.tolist()), set(b.tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def test_signatures_follow_anchors():
    spots = ss.Spots(ANCHORS)
    one = spots.fingerprint(b"red fox jumped over the lazy old brown dog")
    assert len(one) == 4  # three chains at the beginning, one after "the"
    assert set(one) & set(spots.fingerprint(b"Another text: the Lazy, old and brown dogs"))
    assert not len(spots.fingerprint(b" \n .,")) and len(spots.fingerprint(b"the")) == 4
    # a bag counts repetitions
    assert len(spots.fingerprint(b"the cat sat here " * 5)) > len(spots.fingerprint(b"the cat sat here " * 2))
    # no common word in sight: hash-chosen anchors cover the text
    strange = " ".join(f"q{k}" for k in range(2000)).encode()
    assert len(spots.fingerprint(strange)) > 2000 / 20


def test_pruned_jaccard_is_jaccard_or_below():
    rng = np.random.default_rng(0)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 1500, rng.integers(0, 1200))) for _ in range(2))
        b = np.unique(np.concatenate((a[: rng.integers(0, len(a) + 1)], b[: rng.integers(0, 60)])))
        want = jaccard(a, b)
        assert ss.pruned_jaccard(a, b) == want
        for least in (0.3, 0.8):
            assert ss.pruned_jaccard(a, b, least) == want if want >= least else ss.pruned_jaccard(a, b, least) in (0.0, want)


def test_anchors_are_the_words_of_the_share(spark, monkeypatch):
    monkeypatch.setattr(ss, "HELD_WORDS", 50)
    rng = random.Random(2)
    texts = [prose(rng, rng.randint(0, 300)) for _ in range(60)] + [None, ""]
    words = [w for t in texts for w in (t or "").split()]
    want = sorted({w.encode() for w in words if words.count(w) >= 0.002 * len(words)})
    docs = spark.createDataFrame([(k, t, 0, True, 0) for k, t in enumerate(texts)], SCHEMA).repartition(5)
    assert ss.learn_anchors(docs) == want
    assert ss.learn_anchors(spark.createDataFrame([], SCHEMA)) == []


def plain_neighbours(rows, anchors):
    spots = ss.Spots(anchors)
    rows = sorted(((r[0], r[1] or "") for r in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    out = []
    for k, (doc_id, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        edit = text[:len(text) - len(text) // 3] + following[:len(text) // 3]
        a, b, c = (spots.fingerprint(t.encode()) for t in (text, edit, following))
        out.append((doc_id, len(text), hashlib.sha256(edit.encode()).hexdigest(), ss.as_text(a), ss.as_text(b), jaccard(a, b), jaccard(a, c)))
    return sorted(out, key=str)


def test_neighbours_match_brute_force(spark):
    rng = random.Random(7)
    rows = [(k * 3, prose(rng, rng.choice([0, 1, 5, 80, 300])), 0, True, 0) for k in range(150)]
    rows += [(None, "no id", 1, False, 1), (None, None, 1, False, 1), (-4, "ünï cödé " * 50, 0, None, 0), (12, "again the same id", 0, True, 0),
             (30, None, 0, True, 0), (33, "the long text " * 20_000, 0, True, 0)] + [(60, "one of many equal rows", 0, True, 0)] * 20
    anchors = ss.learn_anchors(spark.createDataFrame(rows, SCHEMA))
    for part in (rows, rows[:1], []):
        got = ss.compare_neighbours(spark.createDataFrame(part, SCHEMA).repartition(3), anchors)
        assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        assert sorted(map(tuple, got.collect()), key=str) == plain_neighbours(part, anchors)


def test_query_tells_edits_from_strangers(spark):
    from pyspark.sql import functions as F

    found = ss.op11_spot_signatures(spark, "/root/testdata/sf0.001").where("n_chars > 60")
    row = found.agg(F.count("*").alias("n"), F.count_if(F.col("near_edited") > F.col("near_next")).alias("told"), F.avg("near_edited").alias("e"),
                    F.avg("near_next").alias("x")).first()
    assert row["told"] == row["n"] and row["e"] > 0.4 and row["x"] < 0.05


def plain_components(rows, anchors, similarity):
    spots = ss.Spots(anchors)
    sets = [spots.fingerprint((r[1] or "").encode()) for r in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if label[i] != label[j] and jaccard(sets[i], sets[j]) >= similarity:
                label = [label[j] if x == label[i] else x for x in label]
    least = {}
    for k, r in enumerate(rows):
        least.setdefault(label[k], []).append(r[0])
    return sorted((r[0], min((i for i in least[label[k]] if i is not None), default=None)) for k, r in enumerate(rows) if r[0] is not None)


@pytest.mark.parametrize("limits", [(64, 128), (2, 3)])
def test_near_duplicates_match_all_pairs(spark, monkeypatch, limits):
    monkeypatch.setattr(ss, "LIST", limits[0])
    monkeypatch.setattr(ss, "BLOCK", limits[1])
    rng = random.Random(4)
    rows = []
    for k in range(25):
        text = prose(rng, rng.choice([3, 10, 40, 200]))
        rows += [(10 * k + j, changed(rng, text, rng.choice([0, 0.01, 0.03, 0.08])), 0, True, 0) for j in range(rng.choice([1, 2, 6]))]
    hot = prose(rng, 120)
    rows += [(1000 + j, changed(rng, hot, 0.02), 0, True, 0) for j in range(40)] + [(2000 + j, None, 0, True, 0) for j in range(3)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted((r["doc_id"], r["component_id"]) for r in ss.near_duplicates(docs, 0.8, ANCHORS).collect())
    assert got == plain_components(rows, ANCHORS, 0.8)
    assert ss.near_duplicates(spark.createDataFrame([], SCHEMA), 0.8, ANCHORS).collect() == []
