"""Language identification by compression.

Method.  Each language's dictionary is raw content: slices of training texts.
A text is encoded with every language's zstandard dictionary and belongs to the
language that gives the fewest bytes; it is rejected where the runner-up is
within ``MIN_MARGIN``.  A text is encoded whole, in pieces of ``PIECE`` bytes,
so that its own repetition doesn't drown the dictionary's help.  Both sides
are lower-cased and keep letters only, words parted by one space.  Matches of four bytes count, for
most word parts are that short; texts up to ``SHORT`` bytes, where each byte
decides, are encoded at a slower, closer level.

Scale.  Training takes one slice per language and slot, by the least hash, in
a map-side combined aggregate: ``SLOTS`` slices of ``SLICE`` characters of each language reach
the driver, whatever the input holds.  Every language is learned; more than ``BLOCK`` are encoded block
after block, so that a task holds the compressors of one block.  Prediction is row by row over Arrow batches.

Defined cases: a null text or one without a letter is ``und`` with score 0; if no
language could be learned every text is; a null lang teaches nothing; ties
go to the language with more training documents; an empty table gives an empty result;
extra columns pass through, and one named like a new column is replaced.
"""

from __future__ import annotations

from math import exp

import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaintally.llm.common import extended, fold, parts, table, text_strings, with_columns

# Bounds of the model: slices of each language, characters of each; languages whose compressors are held at once.
SLOTS, SLICE, BLOCK = 64, 1024, 256
PIECE = 2048
SHORT, SHORT_LEVEL = 400, 12
_PLAIN = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
PARAMETERS = zstandard.ZstdCompressionParameters(
    strategy=zstandard.STRATEGY_GREEDY, min_match=4, window_log=17, hash_log=16, chain_log=16, search_log=4,
    target_length=0, **_PLAIN)
MIN_MARGIN = 0.005
# How sharply a relative difference in size tells: score is a softmax of -SHARPNESS * size / least size.
SHARPNESS = 60.0
UNDECIDED = "und"
_LETTER = regex.compile(r"\p{L}")
_FOLD = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def normal(text: str) -> bytes:
    """Lower case, letters (and what lies beyond ASCII) only, one space between words."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_FOLD).split())


def learn(docs: DataFrame, teaches: Column) -> dict[str, bytes]:
    """Dictionary of each language, from the rows that ``teaches`` selects."""
    rows = docs.where(teaches & F.col("lang").isNotNull() & (F.length("text") > 0))
    h = F.xxhash64("doc_id", F.length("text"))
    slots = rows.select("lang", F.pmod(h, F.lit(SLOTS)).alias("slot"), F.xxhash64(h).alias("h"),
                        F.substring("text", 1 + F.pmod(h, F.greatest(F.length("text") - SLICE, F.lit(1))), F.lit(SLICE)).alias("piece"))
    picked = slots.groupBy("lang", "slot").agg(F.min(F.struct("h", "piece")).alias("least"), F.count("*").alias("n"))
    picked = picked.cache()
    try:
        languages = [r["lang"] for r in picked.groupBy("lang").agg(F.sum("n").alias("n"))
                                              .orderBy(F.desc("n"), "lang").collect()]
        slices: dict[str, list[str]] = {lang: [] for lang in languages}
        for p in picked.orderBy("lang", "slot").select("lang", "least.piece").toLocalIterator():
            slices[p["lang"]].append(p["piece"])
    finally:
        picked.unpersist()
    return {lang: normal("\n".join(held)) for lang, held in slices.items()}


class Coder:
    """One compressor per language."""

    def __init__(self, model: dict[str, bytes]):
        self.languages = list(model)
        self.coders = [zstandard.ZstdCompressor(compression_params=PARAMETERS, dict_data=d).compress
                       for d in self._dictionaries(model, compression_params=PARAMETERS)]
        self.short_coders = [zstandard.ZstdCompressor(level=SHORT_LEVEL, dict_data=d, **_PLAIN).compress
                             for d in self._dictionaries(model, level=SHORT_LEVEL)]

    @staticmethod
    def _dictionaries(model: dict[str, bytes], **how):
        for content in model.values():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(**how)
            yield dictionary

    def sizes(self, raw: bytes) -> list[int]:
        """Bytes of a normal text with each language's dictionary."""
        cut = [raw[i:i + PIECE] for i in range(0, len(raw), PIECE)]
        coders = self.short_coders if len(raw) <= SHORT else self.coders
        return [sum(map(len, map(code, cut))) for code in coders]


def told(text: str | None) -> bytes:
    """The normal text of one that can be told, empty for one without letters."""
    return normal(text) if text and _LETTER.search(text) else b""


def decide(languages: list[str], sizes: list[int]) -> tuple[str, float, bool]:
    """(language, score, accepted) from the sizes with all languages."""
    if not sizes:
        return UNDECIDED, 0.0, False
    least = min(sizes)
    best = sizes.index(least)
    score = 1.0 / sum(exp(-SHARPNESS * (s - least) / least) for s in sizes)
    others = sizes[:best] + sizes[best + 1:]
    margin = (min(others) - least) / min(others) if others else 1.0
    return languages[best], score, margin >= MIN_MARGIN


def identify(docs: DataFrame, model: dict[str, bytes]) -> DataFrame:
    """The documents with ``lang_pred``, ``score`` and ``accepted`` (the margin is wide enough)."""
    schema = with_columns(docs.schema, ("lang_pred", T.StringType()), ("score", T.DoubleType()), ("accepted", T.BooleanType()))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names, block = ("lang_pred", "score", "accepted"), BLOCK

    def run(batches):
        model = shared.value
        languages = list(model)
        blocks = [languages[k:k + block] for k in range(0, len(languages), block)]
        held: list[Coder] = []
        for part in parts(batches):
            raws = [told(t) for t in text_strings(part)]
            sizes: list[list[int]] = [[] for _ in raws]
            for of_block in blocks:
                coder = held[0] if held else Coder({lang: model[lang] for lang in of_block})
                held = [coder] if len(blocks) == 1 else []
                for line, raw in zip(sizes, raws):
                    if raw:
                        line += coder.sizes(raw)
            found = [decide(languages, line) for line in sizes]
            yield extended(part, schema, {n: [f[i] for f in found] for i, n in enumerate(names)})

    return docs.mapInArrow(run, schema)


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn(docs, fold(F.col("doc_id"), 3) != 1)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score", "accepted")
