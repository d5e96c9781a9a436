import hashlib
from fractions import Fraction

import pytest

from chaintally.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rate string, target double"


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Reshare the excess by weight until no source is above, in exact fractions."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, held = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in held]
        rest = total - sum(most * sizes[s] for s in held)
        target = {s: Fraction(most * sizes[s]) if s in held else Fraction(rest * w[s], sum(w[f] for f in free)) for s in order}
        above = {s for s in free if target[s] > most * sizes[s]}
        if not above:
            return target
        held |= above


def rows(n=60):
    out = [(i, "word " * (i % 13 + 1), "en", ["a", "b", "c", "é", None, "Z"][i % 6], 0, "x", 1.0) for i in range(n)]
    out += [(900, None, None, "nulls", None, None, None), (901, " \t", "en", "", 0, None, None), (902, "tiny", "en", "tiny", 4, None, None),
            (3, out[3][1], "en", "é", 0, "x", 1.0), (None, "no id", "en", "a", 5, None, None), (903, "long " * 40_000, "en", "b", 1, None, None)]
    return out


def plain_taken(r, rate):
    text = ":".join([mixing.SEED] + [str(x) for x in (r[0], r[1]) if x is not None])
    drawn = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2 ** 52
    whole = int(rate)
    return whole + (drawn < float(rate) - whole)


def test_targets_and_copies_match_plain(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    sizes = {}
    for r in data:
        sizes[r[3]] = sizes.get(r[3], 0) + len((r[1] or "").split())
    want = plain_targets(sizes)
    got = {r.source: r for r in mixing.source_targets(docs.select("source", mixing.n_words(docs.text).alias("size"))).collect()}
    assert set(got) == set(want)
    for s, t in want.items():
        assert got[s].source_size == sizes[s]
        assert got[s].target == pytest.approx(float(t), rel=1e-12)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    have = {}
    for r in mixed.collect():
        have[tuple(r)] = have.get(tuple(r), 0) + 1
    expect = {}
    for r in data:
        n = plain_taken(r, want[r[3]] / sizes[r[3]] if sizes[r[3]] else 0)
        if n:
            expect[r] = expect.get(r, 0) + n
    assert have == expect
    assert sorted(map(str, mixed.collect())) == sorted(map(str, mixing.mix(docs).collect()))


def test_rate_is_at_most_three(spark):
    docs = spark.createDataFrame([(1, "a", "s1"), (2, "b " * 1000, "s2"), (3, "c", "s3")], "doc_id long, text string, source string")
    got = {r.source: r.rate for r in mixing.source_targets(docs.select("source", mixing.n_words(docs.text).alias("size"))).collect()}
    assert got["s1"] == 3.0 and got["s3"] == 3.0 and got["s2"] == pytest.approx((1002 - 6) / 1000)


def test_no_words_and_empty(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "", "s")], "doc_id long, text string, source string")
    assert mixing.mix(docs).count() == 0
    assert [r.target for r in mixing.source_targets(docs.select("source", mixing.n_words(docs.text).alias("size"))).collect()] == [0.0, 0.0]
    assert mixing.mix(docs.limit(0)).count() == 0


def test_share_over_draws(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "concat('one two ', id) as text", "if(id % 2 = 0, 'a', 'b') as source")
    mixed = mixing.mix(docs).groupBy("source").count().collect()
    got = {r["source"]: r["count"] for r in mixed}
    assert abs(got["a"] - 4000 * 5 / 7) < 120 and abs(got["b"] - 4000 * 2 / 7) < 120
