import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chaintally.llm import topk_search as ts

SCHEMA = "vec_id long, embedding array<float>, label int, query long"


def plain(rows, k):
    kept = [(i, r[0], [math.floor(1024 * float(np.float32(x))) for x in r[1]]) for i, r in enumerate(rows)
            if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for qi, qid, q in kept:
        if qid is not None and qid % 100 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), math.inf if vid is None else vid) for i, vid, v in kept if i != qi)
            out += [(qid, n + 1, None if v == math.inf else v, -s) for n, (s, v) in enumerate(scores[:k])]
    return sorted(out, key=str)


def run(df, k=10):
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in ts.search(df, F.col("vec_id") % 100 == 0, k).collect()), key=str)


def random_rows(n, width, seed=0):
    rng = np.random.default_rng(seed)
    return [(int(i * 10), [float(x) for x in rng.normal(size=width)], 0, None) for i in range(n)]


@pytest.mark.parametrize("query_bytes", [16 << 20, 600])
def test_matches_brute_force(spark, monkeypatch, query_bytes):
    monkeypatch.setattr(ts, "QUERY_BYTES", query_bytes)
    monkeypatch.setattr(ts, "SEED_ROWS", 16)
    rows = random_rows(300, 8)
    rows += [(3, [0.5] * 8, 0, None)] * 30  # one common vector: ties and repeated rows
    rows += [(5, None, 0, None), (6, [1.0, None], 0, None), (7, [float("nan")] * 8, 0, None), (8, [float("inf")] * 8, 0, None),
             (9, [3.0, 3.0], 0, None), (11, [], 0, None), (None, [2.0] * 8, 0, 1), (200, rows[20][1], 0, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert run(df) == plain(rows, 10)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i * 50, [float(np.float32(x)) for x in rng.normal(size=3) * 2e5], 0, None) for i in range(40)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == plain(rows, 10)
    with pytest.raises(Exception, match="64 bits"):
        run(spark.createDataFrame([(0, [1e12], 0, None), (1, [1e12], 0, None)], SCHEMA))


def test_pruning_skips_blocks(monkeypatch):
    rng = np.random.default_rng(0)
    groups = np.repeat(np.eye(16, dtype=np.int64) * 1000, ts.BLOCK, axis=0) + rng.integers(-5, 6, (16 * ts.BLOCK, 16))
    q = np.eye(16, dtype=np.int64)[:1] * 1000
    best = ts.Best(1, 10, np.array([ts.NONE]))
    taken = []
    add = best.add
    monkeypatch.setattr(best, "add", lambda query, *a: (taken.append(len(query)), add(query, *a)))
    ts.search_batch(best, q, np.array([-1]), groups, np.arange(len(groups)), np.arange(len(groups)))
    assert len(taken) == 1
    scores = groups @ q[0]
    assert sorted(best.cut()[1].tolist()) == sorted(np.sort(scores)[-10:].tolist())


def test_few_rows_and_empty(spark):
    rows = [(0, [1.0], 0, None), (1, [2.0], 0, None)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == plain(rows, 10)
    assert run(spark.createDataFrame(rows[:1], SCHEMA)) == []
    assert run(spark.createDataFrame([], SCHEMA)) == []
    assert run(spark.createDataFrame(rows[1:], SCHEMA)) == []
