import random
import re

import numpy as np
import pytest

from chaintally.llm import decontaminate as dc
from chaintally.llm.fm_index import FMIndex, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def plain(text, items, window):
    tokens, hit, own = WORD.findall(lower(text)), set(), set()
    for item_id, item in items:
        w = WORD.findall(lower(item))
        for a in range(max(1, len(w) - window + 1)):
            x = w[a:a + window]
            for k in range(len(tokens) - len(x) + 1) if x else ():
                if tokens[k:k + len(x)] == x:
                    hit |= set(range(k, k + len(x)))
                    own |= {str(item_id)} if item_id is not None else set()
    return len(tokens), sorted(hit), sorted(own)


@pytest.mark.parametrize("seed", range(25))
def test_suffixes_search_and_locate(seed):
    rng = np.random.default_rng(seed)
    runs = [list(rng.integers(1, 4, int(rng.integers(1, 20)))) + [0] for _ in range(5)]
    text = np.array(sum(runs, []), dtype=np.int32)
    order = suffix_array(text, 3)
    marks = [-(len(text) - i) if s == 0 else int(s) for i, s in enumerate(text)]
    assert order.tolist() == sorted(range(len(text)), key=lambda i: marks[i:])
    index = FMIndex(text, 3, sample=4)
    phrases = np.array([list(rng.integers(1, 4, 3)) for _ in range(12)], dtype=np.int32)
    lengths = rng.integers(1, 4, 12)
    for phrase, n, low, high in zip(phrases, lengths, *index.search(phrases, lengths)):
        want = [i for i in range(len(text) - n + 1) if (text[i:i + n] == phrase[:n]).all()]
        assert sorted(index.locate(np.arange(low, high)).tolist()) == want


def test_shards_match_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        voc = ["a", "b", "c", "d"][: rng.choice([2, 4])]
        items = [(str(i), " ".join(rng.choices(voc, k=rng.randint(0, 7)))) for i in range(rng.randint(0, 5))]
        texts = [" ".join(rng.choices(voc + ["zz"], k=rng.randint(0, 40))) for _ in range(rng.randint(0, 6))]
        phrases = dc.Phrases([(i, t.encode()) for i, t in items], 4)
        for t, (spans, ids) in zip(texts, dc.search_shard([phrases.numbers(x.encode()) for x in texts], phrases)):
            n, hit, own = plain(t, items, 4)
            assert [k for s, e in spans for k in range(s, e)] == hit and sorted(ids) == own


def tables(spark):
    items = [(1, "Alpha beta, gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short one"), (3, ""), (4, None),
             (2, "short one"), (None, "nameless item here"), (10, "éa 12 ßx short one")]
    long_text = "filler " * 50_000 + items[0][1] + " end" * 20_000
    docs = [(1, "x ALPHA-beta gamma delta epsilon zeta eta theta iota kappa lambda y", "e"), (2, "a short, ONE b", "e"), (3, None, None),
            (4, "", "e"), (5, "clean text", None), (2, "a short, ONE b", "e"), (6, long_text, "e"), (7, "short one", "e"),
            (8, "nameless item here too", "e"), (9, "éa 12 ßx short one tail", "e"), (None, "short one more", None)]
    return docs, items, spark.createDataFrame(docs, "doc_id long, text string, items string"), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_words", [2_000_000, 5])
def test_find_matches_brute_force(spark, block_words):
    docs, items, d, b = tables(spark)
    got = dc.find_contamination(d.repartition(2), b, block_words=block_words).collect()
    have = sorted((str(r.doc_id), r.n_words, [k for s in r.spans for k in range(s.start, s.end)], r["items"]) for r in got)
    assert have == sorted((str(i), *plain(t, items, 10)) for i, t, _ in docs)


def test_removal_cuts_spans_and_keeps_the_rest(spark):
    _, _, d, b = tables(spark)
    got = dc.remove_contamination(d, b)
    assert got.columns == d.columns
    rows = {r.doc_id: r.text for r in got.collect() if r.doc_id != 6}
    assert rows[1] == "x  y" and rows[2] == "a  b" and rows[5] == "clean text" and rows[3] is None and rows[4] == ""
    assert 7 not in rows and rows[8] == " too" and rows[None] == " more"


def test_empty_tables(spark):
    _, _, d, b = tables(spark)
    assert dc.find_contamination(d.limit(0), b).count() == 0
    assert all(r.spans == [] for r in dc.find_contamination(d, b.limit(0)).collect())


def test_many_blocks_are_one_pass(spark):
    """Any number of phrase blocks is searched in one Python pass, with the same result."""
    rng = random.Random(8)
    voc = [f"w{k}" for k in range(30)]
    bench = spark.createDataFrame([(k, " ".join(rng.choices(voc, k=rng.randint(2, 14)))) for k in range(60)], "item_id long, text string")
    texts = spark.createDataFrame([(k, " ".join(rng.choices(voc, k=rng.randint(0, 400)))) for k in range(40)], "doc_id long, text string").repartition(3)
    one, many = (dc.find_contamination(texts, bench, 3, words) for words in (10_000, 10))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
    for df in (many, dc.remove_contamination(texts, bench, 3, 10)):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    a, b = (sorted(map(tuple, dc.remove_contamination(texts, bench, 3, words).collect())) for words in (10_000, 10))
    assert a == b
