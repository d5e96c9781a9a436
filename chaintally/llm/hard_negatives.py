"""Hard-negative mining by a secondary-sort shuffle.

Method.  An anchor's pair scores are packed into keys (anchor, descending score, kind,
id) whose byte order is the order wanted, and sorted by
``repartitionAndSortWithinPartitions``.  A streaming iterator reads an anchor's
pairs from the highest score down: a row of the anchor's label opens a window
from ``HIGH`` to ``LOW`` hundredths of its score, and each row of another label is
emitted as the next negative of every window it lies in, until the window
has its number or lies above the score.  No anchor is ever held as a group: the iterator
keeps the open windows only.

Scale.  Anchors go out in blocks of at most ``ANCHOR_BYTES``; each block is two passes
over all vectors.  The first keeps, in each task, the best rows of an anchor's label; what is left is
sorted and its first rows are the positives.  The second keeps, in each task
and for each window, the best rows of other labels: what a task leaves out stands behind
enough rows of that very window, so nothing that could be returned is lost, and the shuffle moves
a bounded number of pairs per anchor and task instead of all pairs.
One anchor's keys meet in one task, which streams them.

Components are floor(256 * x); sums stay exact in doubles below 2**53 and in 64-bit
integers beyond; a product sum that may pass 2**63, or a window of it that does, raises an error.

Defined cases: a row without label, or with a null vector or a null or
non-finite component, takes no part; a shorter vector counts as padded with zeros; repeated
rows are rows of their own (an anchor leaves out only its own row), ties of
score and id go by row; a null vec_id is no anchor and comes last in ties; a
positive of negative score has an empty window; an empty table gives an empty
result; extra columns are ignored.
"""

from __future__ import annotations

import struct
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.rdd import portable_hash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chaintally.llm.common import dense_index, stage, table
from chaintally.llm.topk_search import matrix

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# A negative's score lies between LOW and HIGH hundredths of its positive's.
LOW, HIGH = 30, 90
# Bound of one broadcast of anchors with their windows.
ANCHOR_BYTES = 8 << 20
# Cells of scores that a task holds at once.
CELLS = 1 << 21
NO_ID = np.iinfo(np.int64).max
NONE = np.iinfo(np.int64).min
POSITIVE, NEGATIVE = 0, 1
_KEY = struct.Struct(">qQBqq")


def packed(anchor: int, score: int, kind: int, vec: int, row: int) -> bytes:
    """A key whose byte order is anchor, falling score, kind, id, row (ids and rows with their sign flipped for that)."""
    return _KEY.pack(anchor, (1 << 63) - 1 - score, kind, vec ^ NONE, row)


def unpacked(key: bytes) -> tuple[int, int, int, int, int]:
    anchor, score, kind, vec, row = _KEY.unpack(key)
    return anchor, (1 << 63) - 1 - score, kind, vec ^ NONE, row


def of_anchor(key: bytes) -> int:
    """What a key is dealt by: its anchor."""
    return portable_hash(key[:8])


def prepared(embeddings: DataFrame, label: Column) -> DataFrame:
    """vec_id, label and v, the integer components, of the rows that take part."""
    x = F.col("embedding")
    sound = F.col("label").isNotNull() & x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embeddings.where(sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * SCALE)).alias("v"))


def scores(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, exact: vectors by anchors."""
    most = int(np.abs(anchors).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * max(1, vectors.shape[1])
    if most * 100 >= 1 << 63:
        raise ValueError("inner products do not fit in 64 bits")
    if most < 1 << 53:
        return (vectors.astype(float) @ anchors.astype(float).T).astype(np.int64)
    return vectors @ anchors.T


def first_of(score: np.ndarray, vec: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k rows by falling score, id, row."""
    if len(score) > 4 * k:
        kept = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        kept = np.arange(len(score))
    return kept[np.lexsort((row[kept], vec[kept], -score[kept]))[:k]]


class Nearest:
    """The first k rows of each list so far (a list is an anchor, or a window of one)."""

    def __init__(self, lists: int, k: int):
        self.k, self.lists = k, lists
        self.reach = np.full(lists, NONE)
        self.held: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(lists)]
        self.sizes = np.zeros(lists, dtype=np.int64)

    def add(self, at: int, score: np.ndarray, vec: np.ndarray, row: np.ndarray) -> None:
        """New rows of a list."""
        if len(score):
            first = first_of(score, vec, row, self.k)
            self.held[at].append((score[first], vec[first], row[first]))
            self.sizes[at] += len(first)
            if self.sizes[at] >= 4 * self.k:
                self._cut(at)

    def _cut(self, at: int) -> tuple[np.ndarray, ...]:
        score, vec, row = (np.concatenate(x) for x in zip(*self.held[at]))
        first = first_of(score, vec, row, self.k)
        score, vec, row = score[first], vec[first], row[first]
        self.held[at], self.sizes[at] = [(score, vec, row)], len(score)
        if len(score) == self.k:
            self.reach[at] = score[-1]
        return score, vec, row

    def lists_held(self):
        for at in range(self.lists):
            if self.held[at]:
                yield at, *self._cut(at)


def _parts(batches, columns: int, width: int):
    """(index, vec_id, label, vectors) of slices whose scores are at most ``CELLS`` cells."""
    step = max(1, CELLS // max(1, columns))
    for whole in batches:
        for at in range(0, whole.num_rows, step):
            batch = whole.slice(at, step)
            column = batch.column(3)
            size = max(width, int(np.diff(column.offsets.to_numpy()).max(initial=0)))
            yield (batch.column(0).to_numpy(), batch.column(1).fill_null(NO_ID).to_numpy(), batch.column(2).to_numpy(),
                   matrix(column, size), size)


def best_positives(rows: DataFrame, anchors: np.ndarray, labels: np.ndarray, own: np.ndarray, k: int) -> DataFrame:
    """Keys of each task's first k rows of every anchor's label."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, labels, own))

    def run(batches):
        anchors, labels, own = shared.value
        best = Nearest(len(anchors), k)
        for index, vec, label, v, size in _parts(batches, len(anchors), anchors.shape[1]):
            wide = np.pad(anchors, ((0, 0), (0, size - anchors.shape[1])))
            for of_label in np.unique(label):
                mine, theirs = np.flatnonzero(labels == of_label), np.flatnonzero(label == of_label)
                if not len(mine):
                    continue
                found = scores(wide[mine], v[theirs])
                for a, column in zip(mine.tolist(), found.T):
                    keep = (column >= best.reach[a]) & (index[theirs] != own[a])
                    best.add(a, column[keep], vec[theirs[keep]], index[theirs[keep]])
        yield _keys(((a, POSITIVE, *found) for a, *found in best.lists_held()))

    return rows.select("index", "vec_id", "label", "v").mapInArrow(run, "key binary")


def _keys(lists) -> pa.RecordBatch:
    out = []
    for anchor, kind, score, vec, row in lists:
        out += [packed(anchor, s, kind, i, r) for s, i, r in zip(score.tolist(), vec.tolist(), row.tolist())]
    return pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["key"])


def best_negatives(rows: DataFrame, anchors: np.ndarray, labels: np.ndarray, windows: tuple[np.ndarray, ...], k: int) -> DataFrame:
    """Keys of each task's first k rows of another label in every window; ``windows``: anchor, least and largest score."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, labels, *windows))

    def run(batches):
        anchors, labels, owner, low, high = shared.value
        best = Nearest(len(owner), k)
        floor = np.full(len(anchors), np.iinfo(np.int64).max)
        np.minimum.at(floor, owner, low)
        places: list[list[int]] = [[] for _ in anchors]
        for w, a in enumerate(owner.tolist()):
            places[a].append(w)
        for index, vec, label, v, size in _parts(batches, len(anchors), anchors.shape[1]):
            found = scores(np.pad(anchors, ((0, 0), (0, size - anchors.shape[1]))), v)
            fits = (found >= floor) & (label[:, None] != labels)
            for a in np.flatnonzero(fits.any(axis=0)).tolist():
                at = np.flatnonzero(fits[:, a])
                score = found[at, a]
                for w in places[a]:
                    keep = (score >= max(low[w], best.reach[w])) & (score <= high[w])
                    best.add(w, score[keep], vec[at[keep]], index[at[keep]])
        # a row may be kept for several windows of an anchor
        held: dict[int, set[tuple[int, int, int]]] = {}
        for w, score, vec, row in best.lists_held():
            held.setdefault(int(owner[w]), set()).update(zip(score.tolist(), vec.tolist(), row.tolist()))
        out = [packed(a, s, NEGATIVE, i, r) for a, kept in held.items() for s, i, r in kept]
        yield pa.RecordBatch.from_arrays([pa.array(out, type=pa.binary())], names=["key"])

    return rows.select("index", "vec_id", "label", "v").mapInArrow(run, "key binary")


def first_positives(keys, k: int):
    """The first k keys of each anchor, from sorted keys."""
    for _, of_one in groupby(keys, key=lambda key: key[:8]):
        for _, key in zip(range(k), of_one):
            yield key


def stream_negatives(keys, k: int, low: int = LOW, high: int = HIGH):
    """(anchor, positive id, rank, negative id, positive score, negative score, positive row) from sorted keys.

    Only the windows that are open are held.
    """
    now, windows = None, []
    for key in keys:
        anchor, score, kind, vec, row = unpacked(key)
        if anchor != now:
            now, windows = anchor, []
        if kind == POSITIVE:
            windows.append([score, vec, row, 0])
            continue
        for w in windows:
            if low * w[0] <= 100 * score <= high * w[0]:
                w[3] += 1
                yield anchor, w[1], w[3], vec, w[0], score, w[2]
        windows = [w for w in windows if w[3] < k and low * w[0] <= 100 * score]


def _sorted(keys: DataFrame):
    """Keys dealt by anchor and sorted within the partitions."""
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = keys.rdd.map(lambda r: (bytes(r[0]), None))
    return pairs.repartitionAndSortWithinPartitions(n, of_anchor).keys()


def mine(embeddings: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of every anchor and positive."""
    spark = embeddings.sparkSession
    rows = stage(dense_index(prepared(embeddings, label), ["vec_id"], "negatives-order"), "negatives-vectors")
    wanted = rows.where(is_anchor).withColumnRenamed("index", "own")
    wanted = stage(dense_index(wanted, ["own"], "negatives-anchors").withColumnRenamed("index", "anchor"), "negatives-anchors-numbered")
    first = wanted.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width = first["width"] or 0
    per_block = max(1, ANCHOR_BYTES // (8 * (width + 2 + 3 * positives)))
    schema = "anchor long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_row long"
    out = []
    for start in range(0, first["n"], per_block):
        block = wanted.where(F.col("anchor").between(start, start + per_block - 1)).orderBy("anchor").collect()
        anchors = np.zeros((len(block), width), dtype=np.int64)
        for line, r in zip(anchors, block):
            line[:len(r["v"])] = r["v"]
        labels, own = (np.array([r[c] for r in block], dtype=np.int64) for c in ("label", "own"))
        best = best_positives(rows, anchors, labels, own, positives)
        keys = _sorted(best).mapPartitions(lambda ks: first_positives(ks, positives)).map(lambda k: (bytearray(k),))
        opened = stage(spark.createDataFrame(keys, "key binary"), "negatives-positives")
        # at most ``positives`` keys for each anchor of the block
        told = np.array([unpacked(bytes(r[0]))[:2] for r in opened.collect()], dtype=np.int64).reshape(-1, 2)
        owner, score = told[:, 0], told[:, 1]
        windows = owner, -(-low * score // 100), high * score // 100
        met = best_negatives(rows, anchors, labels, windows, negatives).union(opened)
        mined = _sorted(met).mapPartitions(lambda ks: stream_negatives(ks, negatives, low, high))
        found = spark.createDataFrame(mined, schema).withColumn("anchor", F.col("anchor") + start)
        out.append(stage(found, "negatives-found"))
    whole = out[0] if out else spark.createDataFrame([], schema)
    for more in out[1:]:
        whole = whole.unionByName(more)
    ids = wanted.select("anchor", F.col("vec_id").alias("anchor_id"))

    def known(name):
        return F.when(F.col(name) != int(NO_ID), F.col(name)).alias(name)

    return whole.join(ids, "anchor").select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")


def shifted_label() -> Column:
    """The label, moved on by one (modulo 10) where vec_id is divisible by 7."""
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def op13_hard_negatives(spark, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, shifted_label())


OP13_SQL = """
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row AS a, a.vec_id AS anchor_id, c.row, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.row <> c.row WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, row) <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.a, p.row ORDER BY s.score DESC, s.vec_id, s.row) AS r
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, CAST(r AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE r <= 10
"""
