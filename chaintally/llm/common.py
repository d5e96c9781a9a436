"""Helpers the training-data operators share."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaintally.session import staging_path

# A word: a run of anything but ASCII white space (fixed value of the contracts).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    The lineage ends at files every executor sees, and Spark knows the
    table's size in bytes when it plans the joins that read it.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % n, F.lit(0))


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """A string column as UTF-8 bytes, null as empty."""
    return [b or b"" for b in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def text_strings(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """A string column as str, null as empty."""
    return [s or "" for s in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def pieces(batch: pa.RecordBatch, name: str = "text", limit: int = 4 << 20):
    """The batch in slices of about ``limit`` bytes of a string column (a longer text is a slice of its own)."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0).cast(pa.int64()))
    ends, at = ends.to_numpy(), 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def parts(batches, name: str = "text"):
    """Arrow batches cut so that the texts of one stay small in memory."""
    for batch in batches:
        yield from pieces(batch, name)


def words(raw: bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased; bytes.split() cuts at the same six characters as WORD_PATTERN."""
    return raw.lower().split()


# Different words a task counts at once.
HELD_WORDS = 250_000


def frequent_words(docs: DataFrame, share: float, split, held_words: int = HELD_WORDS) -> list[tuple[bytes, int]]:
    """(word, n) of the words with at least ``share`` of all words of all texts, most frequent first; at most 1 / share.

    ``split`` gives the words of a text.  A word with that share of the whole has it in some task's texts: one pass
    names each task's words that may have that share, another counts those in all texts; each hands on one list a task.
    """
    texts = docs.select("text")

    def name(batches):
        # counts of a task's words; where they are too many, the least are dropped and what they may have had is remembered
        held, dropped, total = Counter(), 0, 0
        for part in parts(batches):
            for raw in text_bytes(part):
                found = split(raw)
                total += len(found)
                held.update(found)
            while len(held) > held_words:
                cut = int(np.median(np.fromiter(held.values(), dtype=np.int64, count=len(held))))
                held = Counter({w: c - cut for w, c in held.items() if c > cut})
                dropped += cut
        yield pa.RecordBatch.from_arrays([pa.array([w for w, c in held.items() if c + dropped >= share * total], type=pa.binary())], names=["word"])

    named = stage(texts.mapInArrow(name, "word binary").distinct(), "words-named")
    # a task names 1 / share words or few more, and the tasks mostly name the same
    shared = docs.sparkSession.sparkContext.broadcast({bytes(r[0]) for r in named.toLocalIterator()})

    def count(batches):
        wanted, total = dict.fromkeys(shared.value, 0), 0
        for part in parts(batches):
            held: Counter[bytes] = Counter()
            for raw in text_bytes(part):
                held.update(split(raw))
            total += held.total()
            for w in wanted.keys() & held.keys():
                wanted[w] += held[w]
        kept = {w: n for w, n in wanted.items() if n}
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *kept], type=pa.binary()), pa.array([total, *kept.values()], type=pa.int64())], names=["word", "n"])

    counts = stage(texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "words-counted")
    total = counts.where("word is null").agg(F.sum("n")).first()[0] or 0
    kept = counts.where(F.col("word").isNotNull() & (F.col("n") >= share * total)).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in kept), key=lambda r: (-r[1], r[0]))


def with_columns(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    """The schema plus new fields; a new field replaces one of the same name."""
    new = {n for n, _ in fields}
    return T.StructType([f for f in schema if f.name not in new] + [T.StructField(n, t) for n, t in fields])


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names, each with underscores before it until the frame has no column of that name."""
    held = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in held:
            name = "_" + name
        held.add(name.lower())
        out.append(name)
    return out


def extended(batch: pa.RecordBatch, schema: T.StructType, values: dict[str, list]) -> pa.RecordBatch:
    """The batch with new columns, in the order of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_type

    arrays, names = [], []
    for f in schema:
        if f.name in values:
            arrays.append(pa.array(values[f.name], type=to_arrow_type(f.dataType)))
        else:
            arrays.append(batch.column(batch.schema.get_field_index(f.name)))
        names.append(f.name)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def least_rows(df: DataFrame, key: Column, n: int, ties: list[str]) -> DataFrame:
    """The n rows of least ``key`` (a hash), ties by further columns.

    The n-th key is found on the keys alone; then hardly more than n whole
    rows pass the filter, however many tasks read the table.
    """
    keyed = df.withColumn("__key", key)
    last = keyed.select("__key").orderBy("__key").limit(n).agg(F.max("__key")).first()[0]
    return keyed.where(F.col("__key") <= F.lit(last)).orderBy("__key", *ties).limit(n).drop("__key")


def dense_index(df: DataFrame, order: list[str], name: str, index: str = "index") -> DataFrame:
    """Number the rows 0, 1, ... in the given order (ascending, nulls first).

    Range partitions are sorted on their own; each one's first number is the
    sum of the sizes before it, taken over one row per partition.  A hidden
    last sort key lets a run of equal rows spread over partitions.
    """
    placed = df.withColumn("__tie", F.monotonically_increasing_id())
    placed = (placed.repartitionByRange(*[F.col(c) for c in order], F.col("__tie"))
                    .sortWithinPartitions(*order, "__tie").drop("__tie")
                    .withColumn("__at", F.monotonically_increasing_id()))
    placed = stage(placed, name)
    part, local = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return (placed.withColumn("__part", part).join(starts, "__part")
                  .withColumn(index, F.col("__start") + local).drop("__part", "__start", "__at"))
