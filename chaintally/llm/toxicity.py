"""Toxicity by multiple-instance learning.

Method.  A document is a bag of sentences.  A logistic model over hashed words
and word beginnings (a stem with another ending is seen as well) gives each
sentence a probability; the document is toxic if any sentence is (noisy-or).
Weights are learned from document labels alone, by proximal gradient steps on
the noisy-or likelihood.  A sentence whose words have no weight tells nothing and counts as 0: the
bias alone doesn't add up with the length of a text; nor do sentences of small probability: the model learns
a floor, the highest below which hardly a toxic training document needs a sentence, and sentences under it are not
heard (a document with none above has its likeliest sentence's probability).  In a toxic document, the sentences at 0.5 or more (or,
if none is, the likeliest ones) are then the located offenders.

Scale.  Learning uses a bounded sample of labelled rows of every length (``PER_CLASS`` of each
label by least hash).  Tasks turn them into features; equal sentences of a bag are one with its number.
Whole bags teach as long as the sample has up to ``TRAIN_WORDS`` words.  Beyond, the longest bags are
thinned to one common number of words, in sentences drawn by hash over the whole bag (at least one), each of
which counts for its share of the bag's true number of sentences.
Scoring covers every whole text, row by row over Arrow batches.

Defined cases: a null or word-less text has the score of no sentence, 0; without
labelled rows of both classes every score is 0; a null label teaches nothing;
repeated labels of one id each count; an empty table gives an empty result;
extra columns pass through, and one named like a new column is replaced.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaintally.llm.common import extended, fold, parts, pieces, stage, table, text_bytes, with_columns

# Bounds of the training sample.
PER_CLASS, TRAIN_WORDS = {0: 4000, 1: 2000}, 10_000_000
FEATURES = 1 << 20
# Lengths in bytes of the word beginnings, and the bags a feature must be in to be learned.
BEGINNINGS, MIN_BAGS = (4, 5, 6, 7, 8), 3
# Share of the toxic bags in the likelihood, and the first logit of a sentence without known words.
TOXIC_SHARE, FIRST_BIAS = 0.3, -9.0
ROUNDS, RATE, L1 = 250, 1.5, 5e-5
# Features of a gradient step held at once, and files of the sample, of which the driver reads one at a time.
CHUNK, THIN_FILES = 1 << 20, 32
THRESHOLD = 0.5
# Probabilities tried as the floor, highest first, and the share of found toxic documents it may lose.
FLOORS, LOST_SHARE = (0.2, 0.15, 0.1, 0.07, 0.05, 0.03, 0.02, 0.01, 0.005), 0.005

_ENDS = b".!?\n\r|;"
# letters of A-Z lower-cased, bytes beyond ASCII and apostrophes kept, sentence ends as dots, the rest as spaces
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 or c == 39 else 46 if c in _ENDS else 32
              for c in range(256))
_IS_END = np.array([c in _ENDS for c in range(256)])


def sentences(raw: bytes) -> list[set[bytes]]:
    """The different words of each sentence, in order; a sentence may have none."""
    return [set(s.split()) for s in raw.translate(_FOLD).split(b".")]


def word_features(word: bytes) -> list[int]:
    """Hashed features of a word: the word and its beginnings."""
    return [zlib.crc32(word) % FEATURES] + [zlib.crc32(b"^" + word[:k]) % FEATURES for k in BEGINNINGS if len(word) > k]


class Weights(dict):
    """Weight by word, summed over its features once and remembered."""

    LIMIT = 200_000

    def __init__(self, weights: np.ndarray):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) > self.LIMIT:
            self.clear()
        self[word] = w = float(self.weights[word_features(word)].sum())
        return w


def sentence_logits(raw: bytes, weights: Weights, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """Logit of every sentence, and whether a word of it has weight."""
    weight = weights.__getitem__
    sums = np.array([sum(map(weight, s)) for s in sentences(raw)], dtype=float)
    return bias + sums, sums != 0


def noisy_or(logits: np.ndarray) -> float:
    return float(-np.expm1(-np.logaddexp(0.0, logits).sum()))


class Model(NamedTuple):
    """Features with weight, their weights, the bias, and the logit from which a sentence is heard."""
    features: np.ndarray
    weights: np.ndarray
    bias: float
    floor: float


NOTHING = Model(np.empty(0, dtype=np.int64), np.empty(0), float("-inf"), float("-inf"))


def bag_score(logits: np.ndarray, floor: float) -> float:
    """Noisy-or of the sentences that are heard; where none is, the likeliest one's probability."""
    heard = logits[logits >= floor]
    if len(heard) or not len(logits):
        return noisy_or(heard)
    return noisy_or(logits[[logits.argmax()]])


def learned_floor(z: np.ndarray, bag: np.ndarray, times: np.ndarray, labels: np.ndarray) -> float:
    """The highest of ``FLOORS`` (as a logit) at which hardly a toxic training document that the plain noisy-or finds is lost."""
    def found(floor: float) -> np.ndarray:
        heard = np.where(z >= floor, times * np.logaddexp(0.0, z), 0.0)
        return (-np.expm1(-np.bincount(bag, heard, minlength=len(labels))) >= THRESHOLD) & (labels == 1)

    whole = int(found(float("-inf")).sum())
    for p in FLOORS:
        if whole - int(found(np.log(p / (1 - p))).sum()) <= LOST_SHARE * whole:
            return float(np.log(p / (1 - p)))
    return float("-inf")


class Bag(NamedTuple):
    """The different sentences of a text that have words: all their features in a row, and of each sentence the
    number of features, of words, and how many times it stands (a share of the bag's sentences where it is thinned)."""
    features: np.ndarray
    sizes: np.ndarray
    words: np.ndarray
    times: np.ndarray


def bag_of(raw: bytes, known: dict[bytes, list[int]]) -> Bag:
    """The whole bag of a text; ``known`` remembers the features of words."""
    counted = Counter(map(frozenset, filter(None, sentences(raw))))
    feature, sizes = array("i"), array("i")
    if len(known) > Weights.LIMIT:
        known.clear()
    for tokens in counted:
        before = len(feature)
        for t in sorted(tokens):
            if t not in known:
                known[t] = word_features(t)
            feature.extend(known[t])
        sizes.append(len(feature) - before)
    return Bag(np.frombuffer(feature, dtype=np.int32), np.frombuffer(sizes, dtype=np.int32),
               np.fromiter(map(len, counted), dtype=np.int32, count=len(counted)),
               np.fromiter(counted.values(), dtype=np.float64, count=len(counted)))


def thinned(bag: Bag, limit: int) -> Bag:
    """A bag of more than ``limit`` words by sentences of least hash up to that; their times sum up to the bag's."""
    if bag.words.sum() <= limit:
        return bag
    ends = np.cumsum(bag.sizes)
    place = np.arange(len(ends), dtype=np.int64)
    order = np.argsort([zlib.crc32(k.tobytes()) for k in place], kind="stable")
    taken = np.sort(order[:max(1, int(np.searchsorted(np.cumsum(bag.words[order], dtype=np.int64), limit, side="right")))])
    times = bag.times[taken] * (bag.times.sum() / bag.times[taken].sum())
    held = np.isin(np.repeat(place, bag.sizes), taken)
    return Bag(bag.features[held], bag.sizes[taken], bag.words[taken], times)


def words_limit(sizes: np.ndarray, total: int) -> int:
    """The largest common limit that leaves bags of these numbers of words with ``total`` words at most."""
    if sizes.sum() <= total:
        return int(sizes.max(initial=0))
    ordered = np.sort(sizes).astype(np.int64)
    # words left with the limit at each size
    left = np.cumsum(ordered) + ordered * np.arange(len(ordered) - 1, -1, -1)
    k = int(np.searchsorted(left, total, side="right"))
    return int((total - ordered[:k].sum()) // (len(ordered) - k))


def train(bags: list[tuple[bytes, int]]) -> Model:
    """(features, their weights, bias) from (text, label) rows; features without weight are left out."""
    known: dict[bytes, list[int]] = {}
    return fit([bag_of(raw, known) for raw, _ in bags], np.array([y for _, y in bags], dtype=float))


def fit(bags: list[Bag], labels: np.ndarray) -> Model:
    """(features, their weights, bias) from bags and their labels."""
    return fit_stream(lambda: zip(bags, labels))


def fit_stream(rows: Callable[[], Iterable[tuple[Bag, float]]]) -> Model:
    """As ``fit``, from (bag, label) rows that can be read twice in one order: for the features met in enough bags, then for their numbers."""
    bags_with, labels, most = np.zeros(FEATURES, dtype=np.int32), [], 0
    for b, label in rows():
        bags_with[np.unique(b.features)] += 1
        labels.append(label)
        most += len(b.features)
    if len(set(labels)) < 2:
        return NOTHING
    n, bias, labels = len(labels), FIRST_BIAS, np.array(labels, dtype=float)
    met = bags_with >= min(MIN_BAGS, n)
    used, number = np.flatnonzero(met), (np.cumsum(met) - 1).astype(np.int32)
    feature, filled = np.empty(most, dtype=np.int32), 0
    sizes, times, of_bag = [], [], []
    for b, _ in rows():
        keep = met[b.features]
        kept = number[b.features[keep]]
        feature[filled:filled + len(kept)] = kept
        filled += len(kept)
        sizes.append(np.bincount(np.repeat(np.arange(len(b.sizes)), b.sizes)[keep], minlength=len(b.sizes)).astype(np.int32))
        times.append(np.array(b.times))
        of_bag.append(len(b.sizes))
    bag = np.repeat(np.arange(n, dtype=np.int32), of_bag)
    size, times = np.concatenate(sizes), np.concatenate(times)
    del sizes
    count = len(bag)
    # sentences in chunks of a bounded number of features: first sentence, last, first feature, last
    ends = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
    cuts = [0]
    while cuts[-1] < count:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, ends[cuts[-1]] + CHUNK, side="right")) - 1))
    chunks = [(s, e, int(ends[s]), int(ends[e])) for s, e in zip(cuts[:-1], cuts[1:])]
    w, grown, grown_bias = np.zeros(len(used)), np.full(len(used), 1e-8), 1e-8
    share = np.where(labels == 1, TOXIC_SHARE / max(labels.sum(), 1), (1 - TOXIC_SHARE) / max((1 - labels).sum(), 1))
    z = np.empty(count)
    for _ in range(ROUNDS):
        for s, e, f, t in chunks:
            z[s:e] = bias + np.bincount(np.repeat(np.arange(e - s), size[s:e]), w[feature[f:t]], minlength=e - s)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        survive = np.exp(-np.bincount(bag, times * np.logaddexp(0.0, z), minlength=n))
        toward = np.where(labels == 1, -survive / np.maximum(1 - survive, 1e-9), 1.0) * share
        g_sentence = times * p * toward[bag]
        g = np.zeros(len(used))
        for s, e, f, t in chunks:
            g += np.bincount(feature[f:t], np.repeat(g_sentence[s:e], size[s:e]), minlength=len(used))
        grown += g * g
        rate = RATE / np.sqrt(grown)
        w = w - rate * g
        w = np.sign(w) * np.maximum(np.abs(w) - rate * L1, 0.0)
        grown_bias += g_sentence.sum() ** 2
        bias -= 0.1 * g_sentence.sum() / np.sqrt(grown_bias)
    known = np.zeros(count, dtype=bool)
    for s, e, f, t in chunks:
        z[s:e] = np.bincount(np.repeat(np.arange(e - s), size[s:e]), w[feature[f:t]], minlength=e - s)
        known[s:e] = z[s:e] != 0
    floor = learned_floor(np.where(known, z + bias, -np.inf), bag, times, labels)
    return Model(used[w != 0], w[w != 0], float(bias), floor)


def model_weights(model: Model) -> tuple[Weights, float]:
    """Weights by word and the bias of a trained model."""
    dense = np.zeros(FEATURES)
    dense[model.features] = model.weights
    return Weights(dense), model.bias


def learn(docs: DataFrame, labels: DataFrame, teaches: Column) -> Model:
    """Model from the labelled documents that ``teaches`` (over doc_id) selects."""
    marked = labels.where(teaches & F.col("toxic").isin(0, 1)).select("doc_id", "toxic")
    texts = docs.where(F.col("text").isNotNull())
    known = texts.select("doc_id", F.xxhash64("doc_id").alias("h")).join(marked, "doc_id")
    clean, toxic = (known.where(F.col("toxic") == y).orderBy("h", "doc_id").limit(n) for y, n in PER_CLASS.items())
    sample = stage(clean.union(toxic).select("doc_id", "toxic").distinct(), "toxicity-sample")
    keys = ["h", "doc_id", "toxic", "t"]
    rows = texts.select("doc_id", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"), "text").join(sample, "doc_id")
    rows = stage(_bags(rows.select(*keys, "text")), "toxicity-bags")
    total = sum(PER_CLASS.values())
    sizes = rows.select(*keys, "n_words").orderBy(*keys).limit(total).collect()
    limit = words_limit(np.array([r["n_words"] for r in sizes], dtype=np.int64), TRAIN_WORDS)
    thin = stage(_thin_bags(rows, limit).orderBy(*keys).limit(total).select("toxic", *BAG_TYPES).repartition(THIN_FILES), "toxicity-thin")

    def read():
        for r in thin.toLocalIterator():
            yield Bag(*(np.frombuffer(r[k], dtype=d) for k, d in BAG_TYPES.items())), float(r["toxic"])

    return fit_stream(read)


BAG_TYPES = {"features": np.int32, "sizes": np.int32, "words": np.int32, "times": np.float64}


def _bag_schema(schema: T.StructType) -> T.StructType:
    return with_columns(T.StructType([f for f in schema if f.name != "text"]),
                        *((k, T.BinaryType()) for k in BAG_TYPES), ("n_words", T.LongType()))


def _bag_columns(bags: list[Bag]) -> dict[str, list]:
    return {k: [getattr(b, k).tobytes() for b in bags] for k in BAG_TYPES} | {"n_words": [int(b.words.sum()) for b in bags]}


def _bags(rows: DataFrame) -> DataFrame:
    """The rows with their bag in place of ``text``."""
    schema = _bag_schema(rows.schema)

    def run(batches):
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            for part in pieces(batch):
                yield extended(part, schema, _bag_columns([bag_of(raw, known) for raw in text_bytes(part)]))

    return rows.mapInArrow(run, schema)


def _thin_bags(rows: DataFrame, limit: int) -> DataFrame:
    """The rows of bags, each thinned to at most ``limit`` words."""
    schema = rows.schema

    def run(batches):
        for batch in batches:
            read = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in BAG_TYPES]
            bags = [Bag(*map(np.frombuffer, bag, BAG_TYPES.values())) for bag in zip(*read)]
            yield extended(batch, schema, _bag_columns([thinned(b, limit) for b in bags]))

    return rows.mapInArrow(run, schema)


SENTENCES = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))


def offenders(raw: bytes, logits: np.ndarray) -> list[dict]:
    """Place (code points) and probability of each sentence at 0.5 or more, or else of the likeliest."""
    cuts = np.flatnonzero(_IS_END[np.frombuffer(raw, dtype=np.uint8)]).tolist()
    starts, ends = [0] + [c + 1 for c in cuts], cuts + [len(raw)]
    out = []
    for k in np.flatnonzero(logits >= min(0.0, logits.max())).tolist():
        text = raw[starts[k]:ends[k]].decode("utf-8", "replace")
        at = len(raw[:starts[k]].decode("utf-8", "replace"))
        lead = len(text) - len(text.lstrip())
        out.append({"start": at + lead, "end": at + len(text.rstrip()), "score": float(1 / (1 + np.exp(-logits[k])))})
    return out


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with ``toxic_score`` and ``offending``, the sentences that make them so."""
    schema = with_columns(docs.schema, ("toxic_score", T.DoubleType()), ("offending", SENTENCES))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, bias = model_weights(shared.value)
        for part in parts(batches):
            scores, found = [], []
            for raw in text_bytes(part):
                logits, told = sentence_logits(raw, weights, bias)
                scores.append(bag_score(logits[told], shared.value.floor))
                found.append(offenders(raw, np.where(told, logits, -np.inf)) if scores[-1] >= THRESHOLD else [])
            yield extended(part, schema, {"toxic_score": scores, "offending": found})

    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents the model does not call toxic, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, F.lit(True)))

    def run(batches):
        weights, bias = model_weights(shared.value)
        for part in parts(batches):
            keep = []
            for raw in text_bytes(part):
                logits, told = sentence_logits(raw, weights, bias)
                keep.append(bag_score(logits[told], shared.value.floor) < THRESHOLD)
            yield part.filter(pa.array(keep, type=pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 5) == 0
    model = learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    found = score(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), F.col("toxic_score").alias("score"),
                        (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"), "offending")
