"""Benchmark decontamination with an FM-index per training shard.

Method.  Test phrases are the windows of ``WINDOW`` consecutive words of each
benchmark item (an item of fewer words is one window).  Each shard of training
documents becomes an FM-index over word numbers; phrases are searched backward
through wavelet-tree ranks, occurrences are located by sampled suffix positions,
and overlapping occurrences merge to removal spans.

Words no phrase holds cannot be part of an occurrence, so they only cut the
text into runs, and a run shorter than the shortest phrase holds no
occurrence: neither enters the index.  Nothing else is left out.

Scale.  A shard is a bounded number of words within one task (a longer
document is a shard of its own), so there is no shuffle.  Words are numbered as they are split.  Phrases are
broadcast in blocks of at most ``BLOCK_WORDS`` benchmark words; a task searches its texts for one block
after the other, in one pass over the documents, and holds one block at a time.

Defined cases: a null text has no words; an item without words has no window;
a null item_id is left out of the item list but its words are removed; repeated
items of one id count once; an empty benchmark hits nothing; an empty table gives an
empty result; extra columns pass through ``remove_contamination`` whatever their names; in
``find_contamination`` one named like a new column is replaced.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaintally.llm.common import extended, pieces, stage, table, text_bytes, with_columns
from chaintally.llm.fm_index import FMIndex

WINDOW = 10
# Words of one FM-index; the arrays of a shard stay near 30 MB.
SHARD_WORDS = 1 << 18
# Bytes of text searched at once: with one block of phrases, and with several, which are read again for each piece.
PIECE, MANY_PIECE = 4 << 20, 32 << 20
# Benchmark words broadcast at once (about 100 bytes each in a worker).
BLOCK_WORDS = 2_000_000

# A word is a run of digits, a-z and any character beyond ASCII, after A-Z is lower-cased.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_KEPT = np.array([c != 32 for c in _FOLD])


def item_words(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


class Phrases:
    """The distinct windows of a block of items, as word numbers."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item_id, raw in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in item_words(raw)]
            for at in range(max(1, len(numbers) - window + 1)):
                phrase = tuple(numbers[at:at + window])
                if phrase:
                    owners.setdefault(phrase, set()).update([item_id] if item_id is not None else [])
        self.lengths = np.array([len(p) for p in owners], dtype=np.int64)
        self.table = np.zeros((len(owners), window), dtype=np.int32)
        for row, phrase in zip(self.table, owners):
            row[:len(phrase)] = phrase
        self.owners = [sorted(o) for o in owners.values()]
        self.shortest = int(self.lengths.min(initial=window))

    def numbers(self, raw: bytes) -> np.ndarray:
        """The numbers of a text's words, 0 for one that no phrase holds."""
        tokens = item_words(raw)
        return np.fromiter(map(self.vocabulary.get, tokens, repeat(0)), dtype=np.int32, count=len(tokens))


def search_shard(docs: list[np.ndarray], phrases: Phrases) -> list[tuple[list[tuple[int, int]], set[str]]]:
    """For each document (the numbers of its words): removal spans [from, to) in words, and the items found."""
    found: list[tuple[list[tuple[int, int]], set[str]]] = [([], set()) for _ in docs]
    sizes = np.fromiter(map(len, docs), dtype=np.int64, count=len(docs))
    if not len(phrases.lengths) or not sizes.sum():
        return found
    # all words in a row, one 0 after each document
    flat = np.zeros(int(sizes.sum()) + len(docs), dtype=np.int32)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    for at, d in zip(starts, docs):
        flat[at:at + len(d)] = d
    # runs of known words that can hold a phrase
    known = np.concatenate(([False], flat != 0))
    edges = np.flatnonzero(known[1:] != known[:-1])
    run_from, run_to = edges[::2], edges[1::2]
    wide = run_to - run_from >= phrases.shortest
    run_from, run_to = run_from[wide], run_to[wide]
    if not len(run_from):
        return found
    lengths = run_to - run_from + 1  # with the 0 after the run
    at_text = np.cumsum(lengths) - lengths
    source = np.arange(int(lengths.sum())) + np.repeat(run_from - at_text, lengths)
    index = FMIndex(flat[source], len(phrases.vocabulary))
    low, high = index.search(phrases.table, phrases.lengths)
    counts = high - low
    total = int(counts.sum())
    if not total:
        return found
    phrase = np.repeat(np.arange(len(counts)), counts)
    rows = np.arange(total) + np.repeat(low - (np.cumsum(counts) - counts), counts)
    place = source[index.locate(rows)]
    # spans: where more occurrences have begun than ended
    cover = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(cover, place, 1)
    np.add.at(cover, place + phrases.lengths[phrase], -1)
    hit = np.concatenate(([False], np.cumsum(cover) > 0))
    turns = np.flatnonzero(hit[1:] != hit[:-1])
    for s, e in zip(turns[::2].tolist(), turns[1::2].tolist()):
        doc = int(np.searchsorted(starts, s, side="right")) - 1
        found[doc][0].append((s - int(starts[doc]), e - int(starts[doc])))
    doc = np.searchsorted(starts, place, side="right") - 1
    for d, p in np.unique(np.stack((doc, phrase)), axis=1).T.tolist():
        found[d][1].update(phrases.owners[p])
    return found


def _search_all(texts: list[bytes], phrases: Phrases):
    """(words, spans, items) of each text, in shards of a bounded number of words."""
    shard, size = [], 0
    for raw in texts:
        numbers = phrases.numbers(raw)
        if shard and size + len(numbers) > SHARD_WORDS:
            yield from ((len(d), *f) for d, f in zip(shard, search_shard(shard, phrases)))
            shard, size = [], 0
        shard.append(numbers)
        size += len(numbers)
    yield from ((len(d), *f) for d, f in zip(shard, search_shard(shard, phrases)))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def phrase_blocks(benchmark: DataFrame, window: int, block_words: int):
    """The benchmark in blocks of about ``block_words`` words, one at a time on the driver."""
    items = stage(benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
                           .withColumn("size", F.length("text")), "benchmark")
    chars = items.agg(F.sum("size")).first()[0] or 0
    blocks = 1 + int(chars) // (4 * block_words)
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Phrases([(r["item_id"], (r["text"] or "").encode()) for r in part.select("item_id", "text").toLocalIterator()], window)


def _searcher(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int):
    """A function that gives (words, spans, items) of each of a list of texts, searching one block of phrases after the other."""
    shared = [docs.sparkSession.sparkContext.broadcast(p) for p in phrase_blocks(benchmark, window, block_words)]

    def search(texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        found = list(_search_all(texts, shared[0].value))
        for k in range(1, len(shared)):
            # a worker holds one block at a time and reads it again from its executor's copy
            vars(shared[k - 1]).pop("_value", None)
            more = _search_all(texts, shared[k].value)
            found = [(n, merged(s + t), i | j) for (n, s, i), (_, t, j) in zip(found, more)]
        if len(shared) > 1:
            vars(shared[-1]).pop("_value", None)
        return found

    return search, (PIECE if len(shared) == 1 else MANY_PIECE)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents with n_words, ``spans`` (merged removal spans in words) and ``items`` (ids, sorted as strings)."""
    schema = with_columns(docs.schema, ("n_words", T.LongType()), ("spans", SPANS), ("items", T.ArrayType(T.StringType())))
    search, size = _searcher(docs, benchmark, window, block_words)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", size):
                found = search(text_bytes(part))
                yield extended(part, schema, {
                    "n_words": [n for n, _, _ in found], "items": [sorted(ids) for _, _, ids in found],
                    "spans": [[{"start": s, "end": e} for s, e in spans] for _, spans, _ in found]})

    return docs.mapInArrow(run, schema)


def cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans, from each first word's start to the last one's end."""
    held = np.concatenate(([False], _KEPT[np.frombuffer(raw, dtype=np.uint8)], [False]))
    edges = np.flatnonzero(held[1:] != held[:-1])
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for first, after in spans:
        out.append(raw[at:starts[first]])
        at = int(ends[after - 1])
    return b"".join(out) + raw[at:]


def remove_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without their removal spans, n_chars counted anew, all other columns as they are.

    A document all of whose words are removed goes; one without spans stays as it is.  One pass finds and cuts.
    """
    schema = docs.schema
    search, size = _searcher(docs, benchmark, window, block_words)

    def run(batches):
        for batch in batches:
            for whole in pieces(batch, "text", size):
                found = search(text_bytes(whole))
                left = [not spans or n > sum(e - s for s, e in spans) for n, spans, _ in found]
                part = whole.filter(pa.array(left, type=pa.bool_()))
                spans = [s for (_, s, _), kept in zip(found, left) if kept]
                raw = part.column(part.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
                clean = [None if t is None else (cut(t, s) if s else t).decode("utf-8", "replace") for t, s in zip(raw, spans)]
                values = {"text": clean}
                if "n_chars" in schema.names:
                    old = part.column(part.schema.get_field_index("n_chars")).to_pylist()
                    values["n_chars"] = [len(t) if s else n for n, t, s in zip(old, clean, spans)]
                yield extended(part, schema, values)

    return docs.mapInArrow(run, schema)


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))
