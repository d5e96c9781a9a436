"""SimHash near-duplicates through a byte-position inverted index.

Method.  A fingerprint has eight bytes.  Two fingerprints at most four bits
apart differ in at most four bytes, so they share the byte at four or more
positions: that is the guaranteed minimum.  The inverted index posts each
distinct fingerprint under the bytes of chosen position triples; the triples
are chosen so that every set of four positions holds one of them whole.  Every pair within a posting
list has its shared positional bytes tallied, pairs under the minimum are
dropped, and the rest are verified by their bit distance.

Scale.  Copies of a text share a fingerprint, so only distinct fingerprints
are posted.  A long posting list is dealt by a hash into blocks and each pair
of blocks is one cell of bounded size, compared by numpy in row strips; a cell returns a
spanning forest of its links instead of all its pairs, so no link between
components is lost and nothing quadratic is written.  Components come from
alternating star joins on the distinct links, checkpointed in the shared
folder.

Defined cases: a null or word-less text has fingerprint zero and is linked
like any other; fewer words than a shingle make one shingle; repeated rows
are kept; a null doc_id takes part but names no component unless no other
id is there, then the component is null; an empty table gives an empty result;
extra columns are ignored by ``fingerprints`` and ``components``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaintally.llm.common import extended, free_names, pieces, stage, text_bytes, with_columns, words
from chaintally.session import materialize

SHINGLE_WORDS = 4
MAX_BITS = 4
HASH_SEED = 42
BYTES = 8
# Fingerprints per block of a long posting list; a cell of two blocks is compared at once.
BLOCK = 2048
# Edges a node must have to be a hub, besides more than one in HUBS of all.
HUB, HUBS = 500, 1024
# Rows of a cell compared with the whole cell in one numpy step.
STRIP = 256


def simhash(raw: bytes, shingle_words: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """64-bit fingerprint: a bit is set if set in over half of the shingle hashes."""
    tokens = words(raw)
    if not tokens:
        return 0
    line = b" ".join(tokens)
    ends = np.append(np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32), len(line))
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(tokens) - shingle_words + 1)
    last = ends[min(shingle_words, len(tokens)) - 1:]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[s:e], seed) for s, e in zip(starts[:n].tolist(), last.tolist())], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, BYTES), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * counts > n, bitorder="little")
    return int(packed.view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> DataFrame:
    """The documents with ``fp``, the fingerprint as a signed long."""
    schema = with_columns(docs.schema, ("fp", T.LongType()))

    def run(batches):
        for batch in batches:
            for part in pieces(batch):
                found = np.array([simhash(b, shingle_words, seed) for b in text_bytes(part)], dtype=np.uint64)
                yield extended(part, schema, {"fp": found.view(np.int64)})

    return docs.mapInArrow(run, schema)


def position_triples() -> list[tuple[int, int, int]]:
    """Twenty triples of byte positions; any four positions hold one of them.

    Positions are split in three parts; a triple lies within a part or takes
    two positions of a part and one of the part after it (Turan's system).
    """
    parts = [(0, 1, 2), (3, 4, 5), (6, 7)]
    found = [t for p in parts for t in combinations(p, 3)]
    for k, p in enumerate(parts):
        found += [(a, b, c) for a, b in combinations(p, 2) for c in parts[(k + 1) % 3]]
    return found


def _posting_keys(fp: Column) -> Column:
    """One key per triple: its number above the three bytes."""
    byte = [F.shiftrightunsigned(fp, 8 * i).bitwiseAND(F.lit(255)) for i in range(BYTES)]
    return F.array(*[(F.lit(k * (1 << 24)).cast("long") + byte[a] * 65536 + byte[b] * 256 + byte[c])
                     for k, (a, b, c) in enumerate(position_triples())])


def cell_forest(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Links (smaller index first to its root) that span the components of one cell."""
    n = len(fps)
    label = np.arange(n)
    least = BYTES - max_bits
    for at in range(0, n, STRIP):
        apart = fps[at:at + STRIP, None] ^ fps[None, at:]
        shared = (apart.view(np.uint8).reshape(*apart.shape, BYTES) == 0).sum(axis=2, dtype=np.uint8)
        left, right = np.nonzero(shared >= least)
        near = np.bitwise_count(apart[left, right]) <= max_bits
        left, right = left[near] + at, right[near] + at
        while True:
            a, b = label[left], label[right]
            open_ = a != b
            if not open_.any():
                break
            left, right, a, b = left[open_], right[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while (label != label[label]).any():
                label = label[label]
    joined = np.nonzero(label != np.arange(n))[0]
    return fps[joined], fps[label[joined]]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Spanning links (a, b) between distinct fingerprints ``fp`` within ``max_bits``.

    Written for up to four bits: the triples cover every set of four positions.
    """
    if not 0 <= max_bits <= 4:
        raise ValueError("the index guarantees pairs up to 4 bits apart")
    postings = distinct.select("fp", F.explode(_posting_keys(F.col("fp"))).alias("key"))
    long_lists = stage(postings.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
                               .select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "simhash-long")
    dealt = postings.join(long_lists, "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # a fingerprint of block i goes to the cells (i, j) and (j, i) for every j
    cells = dealt.withColumn("own", own).select(
        "fp", "key", F.explode(F.transform(
            F.sequence(F.lit(0), F.col("blocks") - 1),
            lambda j: F.struct(F.least(j, F.col("own")).alias("i"), F.greatest(j, F.col("own")).alias("j")))).alias("cell"))
    lists = (cells.groupBy("key", "cell").agg(F.collect_list("fp").alias("fps"))
                  .where(F.size("fps") > 1).select("fps"))
    schema = "a long, b long"

    def run(batches):
        for batch in batches:
            column = batch.column(0)
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            out_a, out_b = [], []
            for s, e in zip(ends[:-1], ends[1:]):
                a, b = cell_forest(flat[s:e].astype(np.int64).view(np.uint64), max_bits)
                out_a.append(a)
                out_b.append(b)
            if out_a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).view(np.int64)) for x in (out_a, out_b)], names=["a", "b"])

    return lists.mapInArrow(run, schema).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``a``-``b`` edges, root the least node.

    Alternating large-star and small-star steps; each is a map-side combined
    minimum joined back to the edges.  A hub's edges need not meet in one task: a node with more than
    its share of all edges (at most ``2 * HUBS`` have so many) gets its minimum by a broadcast.
    Stops when a round leaves the edges as they were.
    """
    def star(e: DataFrame, large: bool, size: int) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = both.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("a", "m"))
        hubs = F.broadcast(least.where(F.col("n") > max(HUB, size // HUBS)).select("a", "m"))
        met = both.join(hubs, "a").unionByName(both.join(hubs, "a", "left_anti").join(least.select("a", "m"), "a"))
        if large:
            return met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        moved = met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        return moved.where(F.col("a") != F.col("b")).distinct()

    def state(e: DataFrame):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialize(edges)
    now = state(edges)
    while now[0]:
        edges = materialize(star(materialize(star(edges, True, now[0])), False, now[0]))
        before, now = now, state(edges)
        if before == now:
            break
    return (edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root"))
                 .union(edges.select(F.least("a", "b").alias("node"), F.least("a", "b").alias("root"))).distinct())


def components(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
               block: int = BLOCK) -> DataFrame:
    """doc_id, row_hash, fp, root (least fingerprint of the component), component_id."""
    row_hash = F.xxhash64(*[F.col(c) for c in docs.columns])
    slim = docs.select("doc_id", "text", row_hash.alias("row_hash"))
    prints = stage(fingerprints(slim, shingle_words).select("doc_id", "row_hash", "fp"), "simhash-fp")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    roots = connected(links(distinct.select("fp"), max_bits, block))
    placed = (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                      .withColumn("root", F.coalesce("root", "fp")))
    named = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_print = stage(placed.join(named, "root").select("fp", "root", "component_id"), "simhash-components")
    return prints.join(by_print, "fp")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents, one of each component: the least doc_id (null last), ties by row hash, one row of equal rows.

    Which row stays is decided on ids and hashes alone; whole rows are dealt once, by the hash they are found and counted by.
    """
    columns = docs.columns
    hashed, missing, number, nth = free_names(docs, "row_hash", "no_id", "id", "nth")
    none = F.lit(0).cast(docs.schema["doc_id"].dataType)
    placed = components(docs, shingle_words, max_bits)
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_hash")).alias("k"))
    keep = stage(first.select(F.col("k.row_hash").alias(hashed), F.col("k.no_id").alias(missing),
                              F.coalesce("k.doc_id", none).alias(number)), "simhash-keep")
    keys = [hashed, missing, number]
    keyed = (docs.withColumn(hashed, F.xxhash64(*[F.col(c) for c in columns])).withColumn(missing, F.col("doc_id").isNull())
                 .withColumn(number, F.coalesce("doc_id", none)))
    kept = keyed.join(keep, keys, "left_semi")
    one = F.row_number().over(Window.partitionBy(*keys).orderBy(hashed))
    return kept.withColumn(nth, one).where(F.col(nth) == 1).select(*columns)


def op8_simhash_dedup(spark, sf_dir: str) -> DataFrame:
    from chaintally.llm.common import table

    found = components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
