"""Mixing sources to target weights.

Method.  Words are summed per source.  Each source gets a share of the budget
in proportion to its weight, no more than ``max_repeat`` times its own size;
what is over is shared again by weight until no source is above.  A source's
repetition rate is target / size: each document is emitted floor(rate) times,
plus once more when a draw seeded by the hash of the document falls below the
fraction.

Scale.  One map-side combined aggregate per source (a hot source is one row per
task).  Sources are numbered by a range sort, and the resharing passes two
sums to the driver per round, so neither needs the sources in one task.
The per-source targets are a written table of known size: Spark broadcasts it
or splits the hot source of a sorted join by itself.

Defined cases: a null text has no words; a null source is a source, last in
order; a source without words has target and rate zero; repeated rows (same id
and text) share one draw; an empty table gives an empty result; extra columns
pass through ``mix`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chaintally.llm.common import WORD_PATTERN, dense_index, free_names, stage, table

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
SEED = "mix-1"
_EXACT = "decimal(38,0)"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def draw(seed: str) -> Column:
    """A number in [0, 1) from the md5 of seed, id and text (its first 52 bits)."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), F.col("text")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """source, source_size, target, rate from rows (source, size)."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = dense_index(totals.withColumn("last", F.col("source").isNull()), ["last", "source"], "mix-sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("index") % len(weights) + 1).cast("int"))
    sources = stage(ordered.select("source", "source_size", weight.cast("long").alias("w"),
                                   (F.col("source_size") * max_repeat).alias("most")), "mix-weights")

    def above(rest: int, total_weight: int) -> Column:
        return (F.lit(rest).cast(_EXACT) * F.col("w").cast("decimal(18,0)")
                > F.col("most").cast("decimal(20,0)") * F.lit(total_weight).cast("decimal(18,0)"))

    def sums(held: Column) -> tuple[int, int]:
        got = sources.agg(F.sum(F.when(held, F.col("most"))), F.sum(F.when(~held, F.col("w")))).first()
        return int(got[0] or 0), int(got[1] or 0)

    budget = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    _, total_weight = sums(F.lit(False))
    rest, before = budget, None
    while before != (rest, total_weight) and total_weight:
        before = (rest, total_weight)
        used, total_weight = sums(above(*before))
        rest = budget - used
    fair = F.lit(float(rest)) * F.col("w") / F.lit(float(total_weight or 1))
    held = above(rest, total_weight) if total_weight else F.lit(True)
    target = F.when(held, F.col("most").cast("double")).otherwise(fair)
    return stage(sources.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))),
        "mix-targets")


def copies(rate: Column, drawn: Column) -> Column:
    """floor(rate) copies plus one with probability of the fraction."""
    return F.floor(rate).cast("long") + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)


def mix(docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT, seed: str = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    sizes = docs.select("source", n_words(F.col("text")).alias("size"))
    source, rate, drawn, times, copy = free_names(docs, "of_source", "rate", "drawn", "times", "copy")
    targets = source_targets(sizes, weights, max_repeat).select(F.col("source").alias(source), F.col("rate").alias(rate))
    rated = docs.withColumn(drawn, draw(seed)).join(targets, F.col("source").eqNullSafe(F.col(source)))
    taken = rated.withColumn(times, copies(F.col(rate), F.col(drawn))).where(F.col(times) > 0)
    return taken.select(*docs.columns, F.explode(F.sequence(F.lit(1).cast("long"), times)).alias(copy)).drop(copy)


def op1_mix_sources(spark, sf_dir: str) -> DataFrame:
    slim = stage(table(spark, sf_dir, "documents").select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), draw(SEED).alias("drawn")), "mix-sizes")
    targets = source_targets(slim.select("source", "size"))
    placed = slim.alias("d").join(targets.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    return placed.select("doc_id", "size", "source_size", "target",
                         (F.col("size") * copies(F.col("rate"), F.col("drawn"))).alias("taken"))


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(CAST('0x' || substr(md5(concat_ws(':', 'mix-1', CAST(doc_id AS VARCHAR), text)), 1, 13) AS BIGINT) AS DOUBLE)
           / 4503599627370496 AS drawn
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w
  FROM d GROUP BY source),
r AS (
  SELECT *, 3 * source_size AS most,
         (SELECT sum(source_size) FROM s) - coalesce(sum(3 * source_size) OVER before, 0) AS rest,
         (SELECT sum(w) FROM s) - coalesce(sum(w) OVER before, 0) AS weight
  FROM s WINDOW before AS (ORDER BY 3.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT rest, weight FROM r WHERE most * weight >= rest * w ORDER BY 1.0 * most / w, source NULLS LAST LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN (SELECT rest FROM f) * w > most * (SELECT weight FROM f) THEN CAST(most AS DOUBLE)
              ELSE CAST((SELECT rest FROM f) AS DOUBLE) * w / CAST((SELECT weight FROM f) AS DOUBLE) END AS target
  FROM r),
p AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM t)
SELECT d.doc_id, d.size, p.source_size, p.target,
       d.size * CAST(floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
"""
