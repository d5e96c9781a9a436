import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chaintally.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, anchor long, score long"


def plain(rows, positives=5, negatives=10):
    kept = []
    for r in rows:
        if r[1] is not None and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1]):
            label = (r[2] + 1) % 10 if r[0] is not None and r[0] % 7 == 0 else r[2]
            kept.append((r[0], [math.floor(256 * float(np.float32(x))) for x in r[1]], label))
    out = []
    for k, (anchor, v, label) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), math.inf if i is None else i, of) for j, (i, w, of) in enumerate(kept) if j != k)
        own = [(-s, i) for s, i, of in scored if of == label][:positives]
        other = [(-s, i) for s, i, of in scored if of != label]
        for score, positive in own:
            found = [(s, i) for s, i in other if 30 * score <= 100 * s <= 90 * score][:negatives]
            out += [(anchor, None if positive == math.inf else positive, n + 1, None if i == math.inf else i, score, s)
                    for n, (s, i) in enumerate(found)]
    return sorted(out, key=str)


def run(df, **how):
    found = hn.mine(df, F.col("vec_id") % 100 == 0, hn.shifted_label(), **how)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()), key=str)


def random_rows(n, width, seed=0, step=10):
    rng = np.random.default_rng(seed)
    return [(int(i * step), [float(x) for x in rng.normal(size=width)], int(rng.integers(0, 4)), 1, 2) for i in range(n)]


@pytest.mark.parametrize("anchor_bytes", [8 << 20, 400])
def test_matches_brute_force(spark, monkeypatch, anchor_bytes):
    monkeypatch.setattr(hn, "ANCHOR_BYTES", anchor_bytes)
    monkeypatch.setattr(hn, "CELLS", 300)
    rows = random_rows(250, 6)
    rows += [(3, [0.5] * 6, 1, None, None)] * 40  # one common vector: ties and repeated rows
    rows += [(5, None, 0, 1, 1), (6, [1.0, None], 0, 1, 1), (7, [float("nan")] * 6, 0, 1, 1), (8, [float("inf")] * 6, 0, 1, 1), (9, [1.0], None, 1, 1),
             (13, [3.0, 3.0], 0, 1, 1), (11, [], 2, 1, 1), (None, [2.0] * 6, 0, 1, 1), (200, rows[20][1], 0, 1, 1), (300, [0.0] * 6, 1, 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert run(df) == plain(rows)
    assert run(df, positives=2, negatives=3) == plain(rows, 2, 3)


def test_hot_label_and_hot_score(spark):
    """A third of all rows are one vector of one label; windows full of ties stay right."""
    rng = np.random.default_rng(3)
    rows = [(int(i), [1.0, 0.5, 0.0] if i % 3 == 0 else [float(x) for x in rng.normal(size=3)], 1 if i % 3 == 0 else int(rng.integers(0, 3)), 0, 0)
            for i in range(600)]
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)


def test_keys_sort_as_wanted():
    rng = np.random.default_rng(1)
    keys = [(int(a), int(s), int(k), int(v), int(r)) for a, s, k, v, r in zip(
        rng.integers(0, 3, 500), rng.choice([-(1 << 62), -5, 0, 7, 1 << 62], 500), rng.integers(0, 2, 500),
        rng.choice([-(1 << 63), -1, 0, 5, hn.NO_ID], 500), rng.integers(0, 9, 500))]
    ordered = [hn.unpacked(k) for k in sorted(hn.packed(*k) for k in keys)]
    assert ordered == sorted(keys, key=lambda k: (k[0], -k[1], *k[2:]))


def test_the_stream_holds_open_windows_only():
    keys = [hn.packed(0, 1000, hn.POSITIVE, 1, 1)] + [hn.packed(0, 900 - k, hn.NEGATIVE, k, k) for k in range(600)]
    taken = iter(keys)
    first = [next(hn.stream_negatives(taken, 10))]
    assert first == [(0, 1, 1, 0, 1000, 900, 1)] and next(taken) == keys[2]
    assert [r[2:4] for r in hn.stream_negatives(keys, 10)] == [(n + 1, n) for n in range(10)]


def test_large_components_and_empty(spark):
    rng = np.random.default_rng(2)
    rows = [(i * 50, [float(np.float32(x)) for x in rng.normal(size=3) * 2e4], i % 2, 0, 0) for i in range(40)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == plain(rows)
    with pytest.raises(Exception, match="64 bits"):
        run(spark.createDataFrame([(0, [1e12], 0, 0, 0), (1, [1e12], 0, 0, 0)], SCHEMA))
    for few in ([], rows[:1], [r for r in rows if r[0] % 100]):
        assert run(spark.createDataFrame(few, SCHEMA)) == plain(few)
