import collections
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chaintally.llm import suffix_tree_lm as lm
from chaintally.llm.common import fold
from chaintally.llm.packed import packed, steps, unpacked
from chaintally.session import checkpoint_root

SCHEMA = "doc_id long, text string, score string"


def tokens(t):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [""]


def corpus(n=300):
    rng = random.Random(2)
    out = []
    for i in range(n):
        text = []
        for _ in range(rng.randint(1, 40)):
            text += rng.choice([["the", "old", "house"], ["A", "New", "day"], [f"rare{rng.randint(0, 3000)}"], ["the", "new", "day", "is"], ["of"]])
        out.append((i, " ".join(text), "x"))
    return out + [(900, None, None), (901, "", "x"), (902, " \n", "x"), (3, out[3][1], "x"), (None, "no id the old house", "x"), (903, "the old " * 30_000, "x")]


@pytest.fixture
def shares(monkeypatch):
    monkeypatch.setattr(lm, "WORD_SHARE", 1e-3)  # most rare words come by the join
    monkeypatch.setattr(lm, "HELD_WORDS", 50)


def test_base_score_matches_plain_counts(spark, shares):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _, _ in rows}
    count = collections.Counter(t for i, text, _ in rows if not held[i] for t in tokens(text))
    total, distinct = sum(count.values()), len(count)
    got = lm.score(docs, fold(F.col("doc_id"), 7) != 2).collect()
    assert len(got) == len(rows)
    have = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    want = sorted((str(i), len(tokens(t)), sum(count[x] > 0 for x in tokens(t)), total,
                   round(sum(math.log10((count[x] + 1) / (total + distinct + 1)) for x in tokens(t)), 6)) for i, t, _ in rows)
    assert have == want
    assert sum(r.score - r.base_score for r in got if held[r.doc_id]) > 0


def test_every_context_is_a_distribution(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    counts = lm.stage(lm.word_counts(docs), "t")
    tree = lm.learn(docs, counts)
    assert len(tree.levels[0].codes) and len(tree.levels[1].codes)
    words = sorted(tree.vocabulary, key=tree.vocabulary.get)
    unseen = 1 / (tree.tokens + tree.distinct + 1)
    root = tree.log_base()
    assert (10 ** root).sum() + unseen == pytest.approx(1)
    for before in ([b"the"], [b"the", b"old"], [b"a", b"new"], [b"rare1"], [b"of", b"the"], []):
        # the probability of every word, and of an unseen one, after `before` at the start of a text
        raws = [b" ".join([*before, w]) for w in words if w] + [b" ".join(before)] + [b" ".join([*before, b"unseen-word"])]
        _, numbers, sizes = tree.number(raws)
        gain = lm.log_gain(tree, numbers, sizes)
        at = np.cumsum(sizes) - 2
        at[len(words) - 1] += 1  # the end itself follows `before`
        logs = [gain[a] + (root[numbers[a]] if numbers[a] >= 0 else math.log10(unseen)) for a in at]
        assert sum(10 ** x for x in logs) == pytest.approx(1)


def test_longest_retained_suffix_scores(spark):
    rows = [(i, "a b c d " * 50 + "x b e d " * 50, None) for i in range(30)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = lm.score(docs, F.lit(True)).first()
    # after two words the next is all but certain
    assert got.score > 0.1 * got.base_score


def test_no_training_rows_and_empty(spark):
    docs = spark.createDataFrame(corpus(20), SCHEMA)
    got = lm.score(docs, F.lit(False)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score == r.base_score == 0 for r in got)
    assert lm.score(docs.limit(0), F.lit(True)).count() == 0


def test_rare_contexts_and_next_words_are_scored(spark, monkeypatch):
    rng = random.Random(5)
    rare = [(i, f"key{i} value{i} end{i}", None) for i in range(40)] * 4
    rows = rare + [(100 + i, " ".join(rng.choice("abcdefgh") for _ in range(200)), None) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    # of 40,000 tokens each rare word is a tenth of a thousandth
    whole = {r.doc_id: r for r in lm.score(docs, F.lit(True)).collect()}
    assert all(whole[i].score > whole[i].base_score + 6 for i in range(40))
    for words, grams in ((1e-3, 1e-3), (2e-6, 2e-4), (2.0, 2.0)):
        # scored by the joins alone or in part, the results are the same
        monkeypatch.setattr(lm, "WORD_SHARE", words)
        monkeypatch.setattr(lm, "HEAD_SHARE", grams)
        part = {r.doc_id: r for r in lm.score(docs, F.lit(True)).collect()}
        assert {i: (round(r.base_score, 6), round(r.score, 6)) for i, r in part.items()} == {
            i: (round(r.base_score, 6), round(r.score, 6)) for i, r in whole.items()}


def test_held_out_tail_backs_off_as_the_head_does(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(4)
    teaches = fold(F.col("doc_id"), 7) != 2
    whole = sorted((str(r.doc_id), round(r.score, 6)) for r in lm.score(docs, teaches, 3).collect())
    monkeypatch.setattr(lm, "HEAD_SHARE", 1e-3)
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in lm.score(docs, teaches, 3).collect()) == whole


@pytest.mark.parametrize("depth", [0, 2, 3])
def test_scores_are_those_of_the_whole_tree(spark, monkeypatch, depth):
    rows = corpus(120)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    teaches = fold(F.col("doc_id"), 7) != 2
    learned = docs.where(teaches)
    tree = lm.learn(learned, lm.stage(lm.word_counts(learned), "t"), depth)
    assert tree.whole
    want = collections.Counter()
    for i, text, _ in rows:
        _, numbers, sizes = tree.number([(text or "").encode()])
        want[i, round(float(lm.log_gain(tree, numbers, sizes).sum()), 6) + 0.0] += 1
    # many small chunks, and contexts dealt to several tasks ("the old" has most tokens)
    for most in (200, 10_000_000):
        monkeypatch.setattr(lm, "CHUNK_TOKENS", most)
        got = lm.score(docs, teaches, depth).collect()
        assert collections.Counter((r.doc_id, round(r.score - r.base_score, 6) + 0.0) for r in got) == want


def test_no_table_of_grams_is_written(spark):
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    assert lm.score(spark.createDataFrame(corpus(20), SCHEMA), F.lit(True)).count() == 26
    assert not [x for x in set(os.listdir(root)) - before if "lm-" in x]


def test_packed_arrays_come_back():
    ids = np.sort(np.random.default_rng(1).choice(1 << 40, 1000)).astype(np.int64)
    arrays = [ids, np.arange(1000) % 3, np.empty(0, dtype=np.int64), np.array([-0.5, 0.0, 1e300]), np.array([True, False]),
              np.array([-1, 1 << 62], dtype=np.int64).view(np.uint64)]
    raw = packed(steps(arrays[0]), *arrays[1:])
    got = unpacked(raw)
    assert np.array_equal(np.cumsum(got[0]), ids)
    assert got[5].tolist() == [-1, 1 << 62]
    for a, b in zip(arrays[1:5], got[1:5]):
        assert np.array_equal(a, b)
    # a number takes no more bytes than its array's largest
    assert len(raw) < 1000 * 6
