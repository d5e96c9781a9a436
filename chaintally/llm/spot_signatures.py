"""Document fingerprints of spot signatures.

Method.  Common words are anchors.  Each anchor and the chain of the ``CHAIN``
content words (words that are no anchors) that follow it is a signature; a
fingerprint is the sorted bag of a text's signatures (the second, third, ...
of a kind are numbered, so that a bag is a set).  Two fingerprints are compared by
Jaccard, pruned: sets whose lengths alone rule the wanted likeness out aren't
compared, and a comparison ends as soon as what is left can't reach it.

A text's beginning is an anchor too, with chains of one word up to ``CHAIN``, so a short text or one
without common words has signatures; and where ``GAP`` words go by without an anchor, content words of one hash class in eight are,
so that a text in a language whose words are not common in the corpus is covered all over.

Scale.  Anchors are words with at least ``ANCHOR_SHARE`` of all words of all
documents, so at most 1 / ``ANCHOR_SHARE`` words are broadcast; all documents are
counted.  Fingerprints are made row by row.  ``near_duplicates`` collapses equal
fingerprints, partitions sets by length so that only neighbouring partitions
can hold alike ones, and posts each set under its rarest signatures only
(any two alike sets share one of them).  Short lists give pairs; the sets of long lists are
dealt into blocks, and each pair of blocks that shares such a list is one cell of bounded size,
which returns a spanning forest of its links.

Defined cases: a null text is empty; a text without words has the empty
fingerprint, which is like another empty one (1) and unlike all others (0); repeated rows have equal
fingerprints; a null doc_id comes last; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chaintally.llm.common import HELD_WORDS, frequent_words, pieces, stage, table, text_bytes, text_strings
from chaintally.llm.simhash_dedup import connected

CHAIN = 3
ANCHOR_SHARE = 0.002
GAP, CLASSES = 16, 8
SIMILARITY = 0.8
# Bits of a signature; it is written as 12 hex digits.
BITS = 48
# Sets of a short list, and of a block of a long one.
LIST, BLOCK = 64, 128
# Parts of the order of documents for each shuffle partition.
PARTS = 4

# A word is a run of digits, a-z and any character beyond ASCII, after A-Z is lower-cased.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def spot_words(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    """64-bit hash by word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > HELD_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


class Spots:
    """Makes fingerprints with given anchors."""

    def __init__(self, anchors: list[bytes]):
        self.anchors = dict.fromkeys(anchors, 1)
        self.hashes = _Hashes()

    def fingerprint(self, raw: bytes) -> np.ndarray:
        """The sorted signatures of a text, all different."""
        tokens = spot_words(raw)
        n = len(tokens)
        if not n:
            return np.empty(0, dtype=np.int64)
        hashed = np.fromiter(map(self.hashes.__getitem__, tokens), dtype=np.uint64, count=n)
        common = np.fromiter(map(self.anchors.get, tokens, repeat(0)), dtype=bool, count=n)
        content = np.flatnonzero(~common)
        place = np.arange(n)
        # places since the last anchor, the text's beginning being one
        since = place - np.maximum.accumulate(np.where(common, place, -1))
        spare = ~common & (since > GAP) & (hashed % np.uint64(CLASSES) == 0)
        spots = np.concatenate(([-1], np.flatnonzero(common | spare)))
        head = np.concatenate((hashed, [np.uint64(1)]))  # the beginning's own hash stands at -1
        following = np.concatenate((hashed[content], np.zeros(CHAIN, dtype=np.uint64)))
        at = np.searchsorted(content, spots, side="right")
        with np.errstate(over="ignore"):
            found, begun = mixed(head[spots]), []
            for k in range(CHAIN):
                found = mixed(found * _MIX[0] + following[np.minimum(at + k, len(content))])
                begun.append(found[0])
            found = np.sort(np.concatenate((found[1:], begun)))
            first = np.searchsorted(found, found)
            nth = np.arange(len(found)) - first
            found = np.where(nth > 0, mixed(found + nth.astype(np.uint64) * _MIX[0]), found) >> np.uint64(64 - BITS)
        return np.unique(found).astype(np.int64)


def pruned_jaccard(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard of two sorted sets; 0 as soon as it can't reach ``least``."""
    if len(a) > len(b):
        a, b = b, a
    if not len(b):
        return 1.0
    if len(a) < least * len(b):
        return 0.0
    both = len(a) + len(b)
    need = least / (1 + least) * both - 1e-9
    shared, step = 0, 256 if least else max(1, len(a))
    for at in range(0, len(a), step):
        part = a[at:at + step]
        near = np.minimum(np.searchsorted(b, part), len(b) - 1)
        shared += int((b[near] == part).sum())
        if shared + len(a) - at - len(part) < need:
            return 0.0
    return shared / (both - shared)


def as_text(found: np.ndarray) -> str:
    """A fingerprint as text: 12 hex digits for each signature."""
    return found.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8:].tobytes().hex()


def learn_anchors(docs: DataFrame, share: float = ANCHOR_SHARE) -> list[bytes]:
    """The words with at least ``share`` of all words of all documents, sorted."""
    return sorted(word for word, _ in frequent_words(docs, share, spot_words, HELD_WORDS))


def fingerprints(docs: DataFrame, anchors: list[bytes]) -> DataFrame:
    """doc_id, n (signatures) and ``spots``, the fingerprint, of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(anchors)

    def run(batches):
        spots = Spots(shared.value)
        for batch in batches:
            for part in pieces(batch):
                found = [spots.fingerprint(raw) for raw in text_bytes(part)]
                ends = np.cumsum([0] + [len(f) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(ends)),
                     pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(np.concatenate(found) if found else [], type=pa.int64()))],
                    names=["doc_id", "n", "spots"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n long, spots array<long>")


# --- near duplicates ---------------------------------------------------------------


def length_part(n: Column, similarity: float) -> Column:
    """Number of a set's length partition: sets alike by ``similarity`` lie in the same or in neighbouring ones."""
    return F.floor(F.log(n) / F.lit(-np.log(similarity)) + F.lit(1e-9)).cast("int")


def postings(sets: DataFrame, similarity: float) -> DataFrame:
    """(part, spot, node, guest): each set under its rarest signatures, in its own length partition and as a guest in the next.

    Two sets alike by ``similarity`` share one of their first n - ceil(similarity * n) + 1 signatures in any common order; the rarest come first.
    """
    each = sets.select("node", "n", F.explode("spots").alias("spot"))
    rare = stage(each.groupBy("spot").agg(F.count("*").alias("often")).where("often > 1"), "spots-often")
    # a signature of one set only shares nothing, but counts in the order: those come first of all
    met = each.join(rare, "spot").select("node", "n", F.struct("often", "spot").alias("s"))
    kept = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - F.lit(1e-9)) + 1
    listed = met.groupBy("node", "n").agg(F.array_sort(F.collect_list("s")).alias("s"))
    alone = F.col("n") - F.size("s")
    first = listed.select("node", length_part(F.col("n"), similarity).alias("home"),
                          F.explode(F.slice("s", F.lit(1), F.greatest(kept - alone, F.lit(0)).cast("int"))).alias("s"))
    return first.select("node", F.col("s.spot").alias("spot"), F.explode(F.array(
        F.struct(F.col("home").alias("part"), F.lit(False).alias("guest")),
        F.struct((F.col("home") + 1).alias("part"), F.lit(True).alias("guest")))).alias("p")).select("p.part", "spot", "node", "p.guest")


def _pairs(posted: DataFrame) -> DataFrame:
    """Different pairs of nodes of the lists of up to ``LIST`` sets, at least one of each at home."""
    listed = posted.groupBy("part", "spot").agg(F.collect_list(F.struct("guest", "node")).alias("l")).where(F.size("l") > 1)
    one = listed.select("l", F.explode("l").alias("a")).where("not a.guest")
    two = one.select("a", F.explode("l").alias("b")).where("b.guest or a.node < b.node")
    return two.select(F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose sets are alike."""
    left = sets.select(F.col("node").alias("a"), F.col("spots").alias("sa"), F.col("n").alias("na"))
    right = sets.select(F.col("node").alias("b"), F.col("spots").alias("sb"), F.col("n").alias("nb"))
    sized = pairs.join(left.select("a", "na"), "a").join(right.select("b", "nb"), "b").where(
        F.least("na", "nb") >= F.lit(similarity - 1e-9) * F.greatest("na", "nb")).select("a", "b")
    met = sized.join(left.select("a", "sa"), "a").join(right.select("b", "sb"), "b")

    def run(batches):
        for batch in batches:
            a, b, sa, sb = batch.columns
            near = [pruned_jaccard(sa[k].values.to_numpy(), sb[k].values.to_numpy(), similarity) >= similarity for k in range(batch.num_rows)]
            kept = pa.array(near, type=pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(kept), b.filter(kept)], names=["a", "b"])

    return met.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def cell_links(nodes: list[int], sides: list[int], sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that span the components of a cell, found by an inverted index over its sets; sides 1 and 2 are compared, a side with itself not."""
    root = list(range(len(nodes)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            if (sides[i] != sides[j] or not sides[i]) and top(i) != top(j) and pruned_jaccard(a, sets[j], similarity) >= similarity:
                root[top(i)] = top(j)
                links.append((nodes[i], nodes[j]))
    return links


def _cells(posted: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Spanning links of the sets of long lists: each pair of blocks with a list in common is compared once."""
    nodes = posted.select("part", "node").distinct()
    blocks = nodes.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = stage(nodes.join(F.broadcast(blocks), "part").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
                       .drop("blocks"), "spots-blocks")
    of_list = posted.join(dealt, ["part", "node"]).groupBy("part", "spot").agg(F.sort_array(F.collect_set("block")).alias("l"))
    cells = (of_list.select("part", F.explode(F.transform("l", lambda i: F.struct(i.alias("i"), F.filter("l", lambda j: j >= i).alias("js")))).alias("c"))
                    .select("part", "c.i", F.explode("c.js").alias("j")).distinct().withColumn("cell", F.struct("part", "i", "j")))
    members = cells.select("part", "cell", F.explode(F.when(F.col("i") == F.col("j"), F.array(F.struct(F.col("i").alias("block"), F.lit(0).alias("side"))))
                           .otherwise(F.array(F.struct(F.col("i").alias("block"), F.lit(1).alias("side")),
                                              F.struct(F.col("j").alias("block"), F.lit(2).alias("side"))))).alias("m")).select("part", "cell", "m.*")
    full = members.join(dealt, ["part", "block"]).join(sets.select("node", "spots"), "node")
    grouped = full.groupBy("cell").agg(F.collect_list(F.struct("node", "side", "spots")).alias("l")).select("l")

    def run(batches):
        for batch in batches:
            found = []
            for k in range(batch.num_rows):
                cell = batch.column(0)[k].values
                spots = cell.field("spots")
                found += cell_links(cell.field("node").to_pylist(), cell.field("side").to_pylist(),
                                    [spots[i].values.to_numpy() for i in range(len(spots))], similarity)
            yield pa.RecordBatch.from_arrays([pa.array([x[e] for x in found], type=pa.int64()) for e in (0, 1)], names=["a", "b"])

    return grouped.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, anchors: list[bytes] | None = None) -> DataFrame:
    """doc_id and component_id (the least doc_id linked to it, by any steps) of every document."""
    anchors = learn_anchors(docs) if anchors is None else anchors
    key = F.md5(F.array_join("spots", ",").cast("binary"))
    prints = stage(fingerprints(docs, anchors).withColumn("key", key), "spots-prints")
    # equal fingerprints are one set
    sets = prints.groupBy("key").agg(F.min("doc_id").alias("least_id"), F.first("spots").alias("spots"), F.first("n").alias("n"))
    sets = stage(sets.withColumn("node", F.monotonically_increasing_id()), "spots-sets")
    posted = stage(postings(sets.select("node", "n", "spots"), similarity), "spots-postings")
    long_lists = stage(posted.groupBy("part", "spot").agg(F.count("*").alias("size")).where(F.col("size") > LIST).select("part", "spot"), "spots-long")
    short = posted.join(long_lists, ["part", "spot"], "left_anti")
    links = _verified(_pairs(short), sets, similarity).union(_cells(posted.join(long_lists, ["part", "spot"]), sets, similarity))
    roots = connected(links.distinct())
    placed = sets.select("node", "key", "least_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = stage(placed.join(placed.groupBy("root").agg(F.min("least_id").alias("component_id")), "root").select("key", "component_id"), "spots-components")
    return prints.select("doc_id", "key").join(named, "key").select("doc_id", "component_id")


# --- texts and their neighbours ----------------------------------------------------


def in_order(docs: DataFrame, per_partition: int = PARTS) -> DataFrame:
    """part, doc_id, text, own: the documents by falling doc_id (null last, ties by text), each part followed by the row that comes next.

    Parts are cut by quantiles of the ids; of each, one row's text goes to the part before it too (``own`` is false there), after
    the last part the first one's.
    """
    spark = docs.sparkSession
    n = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = texts.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)], F.lit(20 * n))).first()[0] or []
    bounds = np.unique(np.array(cuts, dtype=np.int64))

    @F.pandas_udf("int")
    def after(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy(), side="right"))

    placed = texts.withColumn("part", F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(after(F.coalesce("doc_id", F.lit(0)))))
    # one row for each part
    firsts = sorted(tuple(r) for r in placed.groupBy("part").agg(F.max("doc_id").alias("id")).collect())
    following = [(p, firsts[(k + 1) % len(firsts)][1]) for k, (p, _) in enumerate(firsts)]
    wanted = F.broadcast(spark.createDataFrame(following, "part int, id long"))
    ghosts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("id"))).groupBy("part").agg(F.min("text").alias("text"))
    both = placed.select("part", "doc_id", "text", F.lit(True).alias("own")).union(
        ghosts.select("part", F.lit(None).cast("long"), "text", F.lit(False)))
    return both.repartition("part").sortWithinPartitions(F.col("part"), F.col("own").desc(), F.col("doc_id").desc_nulls_last(), F.col("text"))


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many characters of the next text, or all of them."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def compare_neighbours(docs: DataFrame, anchors: list[bytes]) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness to each other and to the next document's."""
    shared = docs.sparkSession.sparkContext.broadcast(anchors)
    kinds = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
             "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}

    def run(batches):
        spots, before = Spots(shared.value), None
        for batch in batches:
            for part in pieces(batch):
                rows = []
                for where, doc_id, text, own in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), text_strings(part), part.column(3).to_pylist()):
                    now = (where, doc_id, text, spots.fingerprint(text.encode()))
                    if before is not None and before[0] == where:
                        changed = edited(before[2], text).encode()
                        of_changed = spots.fingerprint(changed)
                        rows.append((before[1], len(before[2]), hashlib.sha256(changed).hexdigest(), as_text(before[3]), as_text(of_changed),
                                     pruned_jaccard(before[3], of_changed), pruned_jaccard(before[3], now[3])))
                    before = now if own else None
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=t) for k, t in enumerate(kinds.values())], names=list(kinds))

    return in_order(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                          "near_edited double, near_next double")


def op11_spot_signatures(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return compare_neighbours(docs, learn_anchors(docs))
