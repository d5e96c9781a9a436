"""Exact top-k inner-product search with block-at-a-time pruning.

Method.  Vectors are ordered so that similar ones stand together and cut into
document-range blocks.  A block's maximum and minimum per term bound the score
of each of its vectors: per query, the sum over terms of the larger of
query * maximum and query * minimum.  A query takes blocks by falling bound, scores
them whole through their forward index, and stops where the bound falls
below its k-th score so far.

Scale.  Queries go out in blocks of at most ``QUERY_BYTES``; each block is one
pass over all vectors, written on its own.  A first look at ``SEED_ROWS``
vectors gives every query a valid lower bound of its k-th score, so tasks
prune and stay silent early.  A task holds k rows per query of the block and
one batch of vectors; tasks' lists meet in a ranking of at most k rows per task.

Components are floor(1024 * x); sums stay exact in doubles below 2**53 and in
64-bit integers beyond; a product sum that may pass 2**63 raises an error.

Defined cases: a vector that is null or holds a null or non-finite component
takes no part; a shorter vector counts as padded with zeros; repeated rows are rows of
their own (only the query's own row is left out); a null vec_id is no query and
comes last in ties; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chaintally.llm.common import dense_index, least_rows, stage, table

K = 10
SCALE = 1024
BLOCK = 64
# Bound of one broadcast of queries, and of the vectors read for first thresholds and as pivots of the order.
QUERY_BYTES, SEED_ROWS, PIVOTS = 16 << 20, 4096, 64


def quantized(embeddings: DataFrame) -> DataFrame:
    """vec_id and v, the integer components, of the vectors that take part."""
    x = F.col("embedding")
    sound = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embeddings.where(sound).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * SCALE)).alias("v"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integer components, padded to ``width``."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]].astype(np.int64)
    sizes = np.diff(offsets)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    cells = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    out[rows, cells] = flat
    return out


# Score of no vector.
NONE = np.iinfo(np.int64).min


class Best:
    """The k best (score, vec_id, row) of each query so far, and the score to reach."""

    def __init__(self, queries: int, k: int, reach: np.ndarray):
        self.k, self.reach = k, reach.copy()
        self.top = np.full((queries, k), NONE)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.held = 0

    def add(self, query: np.ndarray, scores: np.ndarray, vec: np.ndarray, row: np.ndarray) -> None:
        """scores, vec, row: one line per query of ``query``."""
        merged = np.concatenate((self.top[query], scores), axis=1)
        merged.partition(merged.shape[1] - self.k, axis=1)
        self.top[query] = merged[:, -self.k:]
        self.reach[query] = np.maximum(self.reach[query], self.top[query].min(axis=1))
        at, col = np.nonzero((scores >= self.reach[query][:, None]) & (scores > NONE))
        if len(at):
            self.parts.append((query[at], scores[at, col], vec[at, col], row[at, col]))
            self.held += len(at)
            if self.held > 4 * self.k * len(self.top) + 100_000:
                self.parts = [self.cut()]
                self.held = len(self.parts[0][0])

    def cut(self) -> tuple[np.ndarray, ...]:
        """The k best of each query, by falling score and then vec_id."""
        if not self.parts:
            return (np.empty(0, dtype=np.int64),) * 4
        query, score, vec, row = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((row, vec, -score, query))
        query, score, vec, row = query[order], score[order], vec[order], row[order]
        first = np.searchsorted(query, query)
        keep = np.arange(len(query)) - first < self.k
        return query[keep], score[keep], vec[keep], row[keep]


def search_batch(best: Best, queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, vec: np.ndarray, row: np.ndarray) -> None:
    """Score a batch of vectors, in blocks by falling bound per query."""
    # the largest sum there can be: up to 2**53 doubles are exact, and faster
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * vectors.shape[1]
    if most >= 1 << 63:
        raise ValueError("inner products do not fit in 64 bits")
    q, v = (queries.astype(float), vectors.astype(float)) if most < 1 << 53 else (queries, vectors)
    blocks = [slice(s, s + BLOCK) for s in range(0, len(v), BLOCK)]
    high = np.stack([v[b].max(axis=0) for b in blocks]).astype(float)
    low = np.stack([v[b].min(axis=0) for b in blocks]).astype(float)
    bound = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
    if most >= 1 << 53:
        bound = bound * (1 + np.sign(bound) * 1e-9) + 1  # rounded sums: stay above
    order = np.argsort(-bound, axis=1, kind="stable")
    for turn in range(len(blocks)):
        ids = order[:, turn]
        active = np.flatnonzero(np.take_along_axis(bound, ids[:, None], 1)[:, 0] >= best.reach)
        if not len(active):
            break
        active = active[np.argsort(ids[active], kind="stable")]
        cuts = np.flatnonzero(np.diff(ids[active])) + 1
        scores = np.full((len(active), BLOCK), NONE)
        place = np.zeros((len(active), BLOCK), dtype=np.int64)
        at = 0
        for group in np.split(active, cuts):
            b = blocks[ids[group[0]]]
            got = q[group] @ v[b].T
            scores[at:at + len(group), :got.shape[1]] = got
            place[at:at + len(group)] = np.minimum(np.arange(b.start, b.stop), len(v) - 1)
            at += len(group)
        scores[row[place] == own[active][:, None]] = NONE
        best.add(active, scores, vec[place], row[place])


NO_ID = np.iinfo(np.int64).max


def _pass(rows: DataFrame, queries: np.ndarray, own: np.ndarray, reach: np.ndarray, k: int) -> DataFrame:
    """(query, score, vec_id, row): each task's k best of each query."""
    shared = rows.sparkSession.sparkContext.broadcast((queries, own, reach))

    def run(batches):
        q, mine, least = shared.value
        best = Best(len(q), k, least)
        for batch in batches:
            if batch.num_rows:
                column = batch.column(2)
                width = max(q.shape[1], int(np.diff(column.offsets.to_numpy()).max(initial=0)))
                padded = np.pad(q, ((0, 0), (0, width - q.shape[1])))
                vec = batch.column(1).fill_null(NO_ID).to_numpy()
                search_batch(best, padded, mine, matrix(column, width), vec, batch.column(0).to_numpy())
        query, score, vec, row = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(score), pa.array(vec), pa.array(row)],
                                         names=["query", "score", "vec_id", "row"])

    return rows.select("index", "vec_id", "v").mapInArrow(run, "query long, score long, vec_id long, row long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _as_matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for line, r in zip(out, rows):
        line[:len(r["v"])] = r["v"]
    return out


def ordered(vectors: DataFrame) -> DataFrame:
    """The vectors numbered (``index``) so that those nearest the same pivot stand together."""
    chosen = least_rows(vectors, F.xxhash64("vec_id", "v"), PIVOTS, ["vec_id"]).select("v").collect()
    width = max((len(r["v"]) for r in chosen), default=0)
    pivots = _as_matrix(chosen, width).astype(float)
    lengths = np.sqrt((pivots ** 2).sum(axis=1)) + 1e-9
    shared = vectors.sparkSession.sparkContext.broadcast(pivots / lengths[:, None])

    def run(batches):
        for batch in batches:
            column = batch.column(1)
            pivots = shared.value
            size = max(pivots.shape[1], int(np.diff(column.offsets.to_numpy()).max(initial=0)))
            near = matrix(column, size)[:, :pivots.shape[1]].astype(float) @ pivots.T
            yield pa.RecordBatch.from_arrays([batch.column(0), column, pa.array(near.argmax(axis=1).astype(np.int32))],
                                             names=["vec_id", "v", "pivot"])

    placed = vectors.mapInArrow(run, "vec_id long, v array<long>, pivot int") if len(chosen) else vectors.withColumn("pivot", F.lit(0))
    return stage(dense_index(placed, ["pivot", "vec_id"], "topk-order").drop("pivot"), "topk-vectors")


def search(embeddings: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of the k best rows of every query row."""
    spark = embeddings.sparkSession
    rows = ordered(quantized(embeddings))
    wanted = rows.where(is_query).withColumnRenamed("index", "own")
    wanted = stage(dense_index(wanted, ["own"], "topk-queries").withColumnRenamed("index", "query"), "topk-queries-numbered")
    first = wanted.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width = first["width"] or 0
    per_block = max(1, QUERY_BYTES // (8 * (width + 2 + k)))
    seed = stage(least_rows(rows, F.xxhash64("index"), SEED_ROWS, ["index"]), "topk-seed")
    found = []
    for start in range(0, first["n"], per_block):
        block = wanted.where(F.col("query").between(start, start + per_block - 1)).orderBy("query").collect()
        q, own = _as_matrix(block, width), np.array([r["own"] for r in block], dtype=np.int64)
        reach = np.full(len(q), NONE)
        floor = _ranked(_pass(seed, q, own, reach, k), k).groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("s"))
        for r in floor.where(F.col("n") == k).collect():
            reach[r["query"]] = r["s"]
        ranked = _ranked(_pass(rows, q, own, reach, k), k).withColumn("query", F.col("query") + start)
        found.append(stage(ranked, "topk-found"))
    if not found:
        found = [spark.createDataFrame([], "query long, score long, vec_id long, row long, rank int")]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    ids = wanted.select("query", F.col("vec_id").alias("query_id"))
    return out.join(ids, "query").select("query_id", "rank", F.when(F.col("vec_id") != int(NO_ID), F.col("vec_id")).alias("vec_id"), "score")


def op5_topk_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP5_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.row AS q, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY q.row ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id, c.row) AS r
  FROM v q JOIN v c ON q.row <> c.row WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM s WHERE r <= 10
"""
