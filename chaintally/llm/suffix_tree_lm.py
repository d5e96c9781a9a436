"""Language-model scoring with a probabilistic suffix tree over words.

Method.  The root of the tree is the add-one distribution of single words.  A
context of up to ``MAX_DEPTH`` preceding words is retained if it occurs at least ``MIN_CONTEXT`` times and the distribution of its next
word diverges from its parent's (the context without its oldest word) by more than its parameters cost
(log-likelihood gain against half a log of its count per next word).  A
retained context's distribution is smoothed with its parent's, weighted by its
number of different next words, and a text is scored word by word from the longest retained suffix of what precedes.

Scale.  All counts cover all words of all training texts.  ``score`` cuts the texts into chunks of about ``CHUNK_TOKENS``
and sends each chunk's different words, then at each depth its different grams (a context and its next word), as packed numbers to the
tasks that count them; these sum over all chunks, test the contexts and answer with counts, from which the chunk takes its
tokens' probabilities.  Words and grams are numbered by the tasks that count them, so a gram is two numbers at any
depth: its context's and its next word's.  A gram is sent only if its context occurs ``MIN_CONTEXT`` times in all
training texts, which the depth before has told.  A context with more than half a task's share of all tokens is dealt to several
tasks by next word, and the chunk adds up their parts.  Nothing is broadcast, and the driver sees no more than the size of all texts.

``learn`` gives the caller the frequent part of the same tree, of words of at least ``WORD_SHARE`` and grams of at least
``HEAD_SHARE`` of all tokens, from tables that hold all of them.

Defined cases: a null text is empty (only its end is a token); a null doc_id is in fold 0, thus
learned from; repeated rows count as often as they stand; without training
rows every probability is that of an empty count; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field
from itertools import chain, pairwise, repeat
from math import log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chaintally.llm.common import fold, parts, stage, table, text_bytes, words
from chaintally.llm.packed import packed, steps, unpacked

MAX_DEPTH = 2
MIN_CONTEXT = 2
WORD_SHARE = 2e-6
HEAD_SHARE = 4e-6
# Distinct words a task holds before it hands its counts on.
HELD_WORDS = 250_000
# Tokens of a chunk, or few more; a longer text is a chunk of its own.
CHUNK_TOKENS = 750_000
# Bytes of text for each counting task, at most.
TASK_BYTES = 32 << 20
END = b""
# Stands before the first word of a text; no word holds white space.
START = b"\n"


def word_counts(texts: DataFrame) -> DataFrame:
    """(token, c) over all texts; the end token is empty."""
    def run(batches):
        held: Counter[bytes] = Counter()

        def handed():
            return pa.RecordBatch.from_arrays([pa.array(list(held), type=pa.binary()), pa.array(list(held.values()), type=pa.int64())],
                                              names=["token", "n"])

        for batch in parts(batches):
            for raw in text_bytes(batch):
                held.update(words(raw))
                held[END] += 1
                if len(held) > HELD_WORDS:
                    yield handed()
                    held.clear()
        yield handed()

    counted = texts.select("text").mapInArrow(run, "token binary, n long")
    return counted.groupBy("token").agg(F.sum("n").alias("c"))


def grams(tokens: list[bytes], depth: int) -> list[bytes]:
    """Each token after the up to ``depth`` tokens before it, parted by spaces."""
    line = [START, *tokens]
    early = [b" ".join(line[:k + 2]) for k in range(min(depth - 1, len(tokens)))]
    return early + list(map(b" ".join, zip(*(line[k:] for k in range(depth + 1)))))


def gram_counts(texts: DataFrame, depth: int) -> DataFrame:
    """(gram, size, n): longest grams over all texts, with their number of tokens."""
    def run(batches):
        held: Counter[bytes] = Counter()

        def handed():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(held), type=pa.binary()), pa.array([g.count(b" ") + 1 for g in held], type=pa.int32()),
                 pa.array(list(held.values()), type=pa.int64())], names=["gram", "size", "n"])

        for batch in parts(batches):
            for raw in text_bytes(batch):
                held.update(grams(words(raw) + [END], depth))
                if len(held) > HELD_WORDS:
                    yield handed()
                    held.clear()
        yield handed()

    counted = texts.select("text").mapInArrow(run, "gram binary, size int, n long")
    return counted.groupBy(F.col("gram").cast("string").alias("gram"), "size").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """The frequent part of one depth: sorted codes of contexts, log10 of the weight of the parent, and log10 gain of grams over the root."""
    codes: np.ndarray
    log_weight: np.ndarray
    next_codes: np.ndarray
    next_gains: np.ndarray


@dataclass
class Tree:
    vocabulary: dict[bytes, int]
    counts: np.ndarray
    tokens: int
    distinct: int
    symbols: int
    levels: list[Level] = field(default_factory=list)
    # whether the levels hold every gram
    whole: bool = True

    @property
    def base(self) -> int:
        """Radix of context codes: 0 is any other word, symbols are 1 to ``symbols``, and the start of a text is one more."""
        return self.symbols + 2

    def log_base(self) -> np.ndarray:
        """log10 of the root's probability of each word of the vocabulary."""
        return np.log10((self.counts + 1) / (self.tokens + self.distinct + 1))

    def number(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """All tokens (each text's words and its end), their vocabulary numbers (-1: none) and text sizes."""
        split = [words(t) + [END] for t in texts]
        sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        flat = list(chain.from_iterable(split))
        return flat, np.fromiter(map(self.vocabulary.get, flat, repeat(-1)), dtype=np.int64, count=len(flat)), sizes

    def contexts(self, numbers: np.ndarray, sizes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each token, and the code of the ``depth`` symbols before it (0 where there is no such context)."""
        symbol = np.where((numbers >= 0) & (numbers < self.symbols), numbers + 1, 0)
        start = np.repeat(np.cumsum(sizes) - sizes, sizes)
        place = np.arange(len(symbol))
        code = np.zeros(len(symbol), dtype=np.int64)
        whole = np.ones(len(symbol), dtype=bool)
        for back in range(depth, 0, -1):
            at = place - back
            before = np.where(at >= start, symbol[np.maximum(at, 0)], np.where(at == start - 1, self.symbols + 1, 0))
            whole &= before > 0
            code = code * self.base + before
        return symbol, np.where(whole, code, 0)


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted value among sorted keys, -1 if it isn't there."""
    if not len(keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def grow(texts: DataFrame, counts: DataFrame, max_depth: int = MAX_DEPTH) -> list[tuple[DataFrame, DataFrame]]:
    """Of each depth from 1: (gram, n, p, root) of all grams, and (context, log_weight) of the retained contexts.

    ``p`` is the next word's probability in the longest retained suffix of the
    gram's context, ``root`` the one of the word alone.
    """
    if max_depth < 1:
        return []
    total = counts.agg(F.sum("c"), F.count("*")).first()
    root = (F.col("c") + 1) / F.lit(float(int(total[0] or 0) + int(total[1]) + 1))
    below = counts.select(F.col("token").cast("string").alias("gram"), root.alias("p"), root.alias("root"))
    counted = stage(gram_counts(texts, max_depth), "lm-grams")
    of_depth = {max_depth: counted.where(F.col("size") == max_depth + 1).select("gram", "n")}
    for depth in range(max_depth - 1, 0, -1):
        shorter = of_depth[depth + 1].select(_without_oldest(depth + 1).alias("gram"), "n")
        starts = counted.where(F.col("size") == depth + 1).select("gram", "n")
        of_depth[depth] = shorter.union(starts).groupBy("gram").agg(F.sum("n").alias("n"))
    levels = []
    for depth in range(1, max_depth + 1):
        parent = below.select(F.col("gram").alias("lower"), F.col("p").alias("parent"), "root")
        rows = stage(of_depth[depth].withColumn("lower", _without_oldest(depth)).join(parent, "lower").drop("lower"), f"lm-parents-{depth}")
        rows = rows.withColumn("context", _context(depth))
        told = F.sum(F.col("n") * F.log(F.col("n") / F.col("parent"))) - F.sum("n") * F.log(F.sum("n"))
        contexts = rows.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("types"), told.alias("told"))
        contexts = contexts.where((F.col("total") >= MIN_CONTEXT) & (F.col("told") >= 0.5 * (F.col("types") + 1) * F.log("total")))
        contexts = stage(contexts.select("context", "total", "types"), f"lm-contexts-{depth}")
        smoothed = (F.col("n") + F.col("types") * F.col("parent")) / (F.col("total") + F.col("types"))
        below = stage(rows.join(contexts, "context", "left").select(
            "gram", "n", F.coalesce(smoothed, F.col("parent")).alias("p"), "root"), f"lm-depth-{depth}")
        levels.append((below, contexts.select("context", F.log10(F.col("types") / (F.col("total") + F.col("types"))).alias("log_weight"))))
    return levels


def _without_oldest(depth: int) -> Column:
    """The gram of a depth without its first token."""
    return F.substring_index("gram", " ", -depth)


def _context(depth: int) -> Column:
    """The gram of a depth without its last token."""
    return F.substring_index("gram", " ", depth)


def head(counts: DataFrame, levels: list[tuple[DataFrame, DataFrame]]) -> Tree:
    """What is broadcast of the tree: the frequent words and grams, and the contexts if that is all grams."""
    total = counts.agg(F.sum("c"), F.count("*")).first()
    tokens, distinct = int(total[0] or 0), int(total[1])
    often = counts.where(F.col("c") >= WORD_SHARE * tokens).orderBy(F.desc("c"), "token").toArrow()
    # the code of a whole gram must fit 63 bits
    symbols = min(often.num_rows, int(2 ** (62 / (len(levels) + 1))) - 2)
    tree = Tree({t: i for i, t in enumerate(often.column("token").to_pylist())}, often.column("c").to_numpy(), tokens, distinct, symbols)

    def coded(column: pa.ChunkedArray) -> np.ndarray:
        """Codes of grams or contexts, -1 with a word that has no symbol."""
        out = np.empty(len(column), dtype=np.int64)
        for k, raw in enumerate(column.to_pylist()):
            code = 0
            for word in raw.split(b" "):
                number = symbols if word == START else tree.vocabulary.get(word, -1)
                if number < 0 or number >= symbols and word != START:
                    code = -1
                    break
                code = code * tree.base + number + 1
            out[k] = code
        return out

    found = []
    for of_grams, _ in levels:
        common = of_grams.where(F.col("n") >= HEAD_SHARE * tokens).select(
            F.col("gram").cast("binary").alias("gram"), F.log10(F.col("p") / F.col("root")).alias("gain")).toArrow()
        codes = coded(common.column("gram"))
        order = np.argsort(codes)[(codes < 0).sum():]
        found.append((codes[order], common.column("gain").to_numpy()[order]))
        tree.whole = tree.whole and len(order) == of_grams.count()
    for (next_codes, next_gains), (_, contexts) in zip(found, levels):
        codes, log_weight = np.empty(0, dtype=np.int64), np.empty(0)
        if tree.whole:
            kept = contexts.select(F.col("context").cast("binary").alias("context"), "log_weight").toArrow()
            codes, log_weight = coded(kept.column("context")), kept.column("log_weight").to_numpy()
            order = np.argsort(codes)
            codes, log_weight = codes[order], log_weight[order]
        tree.levels.append(Level(codes, log_weight, next_codes, next_gains))
    return tree


def learn(texts: DataFrame, counts: DataFrame, max_depth: int = MAX_DEPTH) -> Tree:
    """The head of the training texts' tree; ``counts`` is their written word_counts."""
    return head(counts, grow(texts, counts, max_depth))


def resolve(tree: Tree, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log10 of each token's probability in its longest retained context, over the root's, and whether the head tells it (else 0)."""
    out, open_ = np.zeros(len(numbers)), np.ones(len(numbers), dtype=bool)
    sure = np.full(len(numbers), tree.whole)
    longest = np.minimum(np.arange(len(numbers)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1, len(tree.levels))
    for depth in range(len(tree.levels), 0, -1):
        level = tree.levels[depth - 1]
        symbol, code = tree.contexts(numbers, sizes, depth)
        at = np.flatnonzero(open_ & (code > 0))
        hit = _find(level.next_codes, code[at] * tree.base + symbol[at])
        hit = np.where(symbol[at] > 0, hit, -1)
        known, missed = at[hit >= 0], at[hit < 0]
        out[known] += level.next_gains[hit[hit >= 0]]
        open_[known] = False
        sure[known] |= longest[known] == depth
        state = _find(level.codes, code[missed])
        out[missed[state >= 0]] += level.log_weight[state[state >= 0]]
    return np.where(sure, out, 0.0), sure


def log_gain(tree: Tree, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 of each token's probability in its longest retained context, over the root's, as far as the head tells it."""
    return resolve(tree, numbers, sizes)[0]


# What moves between tasks as (key, (level, sender, part, payload)): a chunk's texts; its words or grams, to the task that
# counts them; and that task's answers, back to the chunk.
TEXTS, WORDS = -2, -1


def _place(key: int) -> int:
    return key


def _spread(ids: np.ndarray) -> np.ndarray:
    """Evenly spread non-negative numbers of ids."""
    return ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys in order, a place of each, and each place's number among them."""
    order = np.argsort(keys)
    held = keys[order]
    new = np.ones(len(held), dtype=bool)
    np.not_equal(held[1:], held[:-1], out=new[1:])
    which = np.empty(len(held), dtype=np.int32)
    which[order] = np.cumsum(new, dtype=np.int32) - 1
    return held[new], order[new], which


def _retained(types: np.ndarray, total: np.ndarray, told: np.ndarray) -> np.ndarray:
    """Whether contexts pass the tests; ``told`` is the sum of n * ln(n / parent) over a context's grams."""
    least = np.log(np.maximum(total, 1))
    return (total >= MIN_CONTEXT) & (told - total * least >= 0.5 * (types + 1) * least)


def _chunks(tasks: int):
    """Cuts the texts of a task into chunks: a row of each one's numbered tokens, and a row of its words for every counting task."""
    def run(batches):
        number, serial = TaskContext.get().partitionId(), 0
        lines, sizes, ids, teaches = [], [], [], []

        def handed():
            coded = pa.chunked_array(lines).combine_chunks().dictionary_encode()
            code = coded.indices.to_numpy()
            learned = np.repeat(np.array(teaches, dtype=bool), sizes)
            often = np.argsort(-np.bincount(code), kind="stable")
            rank = np.empty_like(often)
            rank[often] = np.arange(len(often))
            n = np.bincount(code, weights=learned, minlength=len(often)).astype(np.int64)[often]
            word = coded.dictionary.take(pa.array(often))
            target = np.fromiter(map(crc32, word.to_pylist()), dtype=np.int64, count=len(word)) % tasks
            known = np.array([i is not None for i in ids])
            numbers = np.array([i or 0 for i in ids], dtype=np.int64).view(np.uint64)
            yield -1, packed(rank[code], np.array(sizes), numbers, known, np.array(teaches), target)
            order = np.argsort(target, kind="stable")
            word, n = word.take(pa.array(order)), n[order]
            ends = np.frombuffer(word.buffers()[1], dtype=np.int64, count=len(word) + 1)
            joined = np.frombuffer(word.buffers()[2], dtype=np.uint8, count=ends[-1]) if ends[-1] else np.empty(0, dtype=np.uint8)
            cuts = np.searchsorted(target[order], np.arange(tasks + 1)).tolist()
            for k, (s, e) in enumerate(pairwise(cuts)):
                yield k, packed(joined[ends[s]:ends[e]], np.diff(ends[s:e + 1]), n[s:e])

        def rows():
            for target, payload in handed():
                yield pa.RecordBatch.from_arrays([pa.array([number], type=pa.int32()), pa.array([serial], type=pa.int32()), pa.array([target], type=pa.int32()),
                                                  pa.array([payload], type=pa.binary())], names=["task", "serial", "target", "payload"])

        held = 0
        for batch in parts(batches):
            line = []
            for raw, doc_id, teach in zip(text_bytes(batch), batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                tokens = [START, *words(raw), END]
                line += tokens
                sizes.append(len(tokens))
                ids.append(doc_id)
                teaches.append(teach)
                if held + len(line) >= CHUNK_TOKENS:
                    lines.append(pa.array(line, type=pa.large_binary()))
                    yield from rows()
                    serial, held = serial + 1, 0
                    for x in (line, lines, sizes, ids, teaches):
                        x.clear()
            held += len(line)
            lines.append(pa.array(line, type=pa.large_binary()))
        if held:
            yield from rows()
        # the worker may wait for long with what it holds
        pa.default_memory_pool().release_unused()

    return run


def _by_key(rows) -> dict[int, list]:
    """(level, sender, part, payload) of each key, in a fixed order."""
    found = defaultdict(list)
    for key, value in rows:
        found[key].append(value)
    for own in found.values():
        own.sort(key=lambda x: x[:3])
    return found


def _count_words(tasks: int):
    """Answers each chunk's words with their numbers and counts over all texts, and with the sums over all words."""
    def run(rows):
        for key, asked in _by_key(rows).items():
            asked = [(sender, unpacked(payload)) for level, sender, _, payload in asked if level == WORDS]
            if not asked:
                continue
            ends = [np.concatenate([[0], np.cumsum(lengths)]) for _, (_, lengths, _) in asked]
            arrays = [pa.Array.from_buffers(pa.large_binary(), len(e) - 1, [None, pa.py_buffer(e.astype(np.int64)), pa.py_buffer(joined.astype(np.uint8))])
                      for e, (_, (joined, _, _)) in zip(ends, asked)]
            coded = pa.chunked_array(arrays).combine_chunks().dictionary_encode()
            at = coded.indices.to_numpy()
            c = np.bincount(at, weights=np.concatenate([n for _, (_, _, n) in asked]), minlength=len(coded.dictionary)).astype(np.int64)
            rank = np.empty(len(c), dtype=np.int64)
            rank[np.argsort(-c, kind="stable")] = np.arange(len(c))
            # the start of a text is a context word, but no token
            tokens = np.where(pc.equal(coded.dictionary, pa.scalar(START, pa.large_binary())).to_numpy(zero_copy_only=False), 0, c)
            sums = np.array([tokens.sum(), (tokens > 0).sum()])
            cuts = np.cumsum([len(e) - 1 for e in ends])
            for (sender, _), own in zip(asked, np.split(at, cuts[:-1])):
                yield sender, (WORDS, key, 0, packed(rank[own], c[own], sums))

    return run


def _count_grams(tasks: int, last: bool):
    """Answers each chunk's grams with their counts over all texts, the numbers of those that may be contexts, and what is retained."""
    def run(rows):
        for key, asked in _by_key(rows).items():
            blocks = [unpacked(payload) for *_, payload in asked]
            ids, _, at = _distinct(np.concatenate([np.cumsum(b[0]) for b in blocks]))
            at = at.astype(np.int64)
            context = np.repeat(at, np.concatenate([b[1] for b in blocks]))
            word = np.concatenate([b[3] for b in blocks])
            if len(word) and int(word.max()).bit_length() + len(ids).bit_length() > 62:
                word = np.unique(word, return_inverse=True)[1]
            bits = int(word.max()).bit_length() if len(word) else 0
            gram, _, which = _distinct(context << bits | word)
            n = np.bincount(which, weights=np.concatenate([b[4] for b in blocks]), minlength=len(gram)).astype(np.int64)
            context = gram >> bits
            total = np.bincount(context, weights=n, minlength=len(ids)).astype(np.int64)
            types = np.bincount(context, weights=n > 0, minlength=len(ids)).astype(np.int64)
            told = np.bincount(context, weights=n * np.log(np.maximum(n, 1)), minlength=len(ids))
            told -= np.bincount(at, weights=np.concatenate([b[2] for b in blocks]), minlength=len(ids))
            kept = np.where(_retained(types, total, told), types, 0)
            number = np.cumsum(n >= MIN_CONTEXT) - 1
            done = done_grams = 0
            for (level, sender, part, _), block in zip(asked, blocks):
                own = at[done:done + len(block[0])]
                grams_ = which[done_grams:done_grams + len(block[3])]
                done, done_grams = done + len(own), done_grams + len(grams_)
                if part:
                    # other tasks hold further grams of these contexts: the chunk adds up
                    about = [types[own], total[own], told[own]]
                else:
                    about = [kept[own], total[own][kept[own] > 0]]
                if last and not part:
                    about.append(n[grams_[np.repeat(kept[own] > 0, block[1])]])
                else:
                    about.append(n[grams_])
                if not last:
                    about.append(steps(number[grams_[n[grams_] >= MIN_CONTEXT]]))
                yield sender, (level, key, part, packed(*about))

    return run


class _Chunk:
    """Texts as numbers, and each token's probability as far as answers go."""

    def __init__(self, tasks: int, texts: bytes, answers: list):
        self.tasks = tasks
        code, self.sizes, ids, known, teaches, target = unpacked(texts)
        self.ids = [i if k else None for i, k in zip(ids.view(np.int64).tolist(), known.tolist())]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.learned = np.repeat(teaches > 0, self.sizes)
        answers = [(key, *unpacked(payload)) for key, payload in answers]
        self.tokens, self.distinct = (int(x) for x in sum(sums for *_, sums in answers))
        order = np.argsort(target, kind="stable")
        number, c = np.empty_like(target), np.empty_like(target)
        number[order] = np.concatenate([rank * tasks + key for key, rank, _, _ in answers])
        c[order] = np.concatenate([c for _, _, c, _ in answers])
        # words by number, so that grams are in the order of their numbers too
        by = np.argsort(number)
        rank = np.empty_like(by)
        rank[by] = np.arange(len(by))
        self.word, self.numbers, self.c = rank.astype(np.int32)[code], number[by], c[by]
        self.p = ((self.c + 1) / (self.tokens + self.distinct + 1))[self.word]
        self._follow(self.word, self.numbers, self.c)

    def _follow(self, ending: np.ndarray, ids: np.ndarray, n: np.ndarray):
        """The gram ending at each token (-1: none) is the next one's context, if seen often enough."""
        before = np.empty_like(ending)
        before[1:] = ending[:-1]
        before[self.starts] = -1
        before[before >= 0] = np.where(n[before[before >= 0]] >= MIN_CONTEXT, before[before >= 0], -1)
        self.before, self.ids_before, self.n_before = before, ids, n

    def ask(self):
        """Finds the different grams and deals them by context; a context of many grams is dealt to several tasks by next word too."""
        self.at = np.flatnonzero(self.before >= 0).astype(np.int32)
        gram, first, which = _distinct(self.before[self.at].astype(np.int64) << 32 | self.word[self.at])
        context, word = gram >> 32, gram & 0xFFFFFFFF
        n = np.bincount(which, weights=self.learned[self.at], minlength=len(gram)).astype(np.int64)
        parent = self.p[self.at[first]]
        new = np.diff(context, prepend=-1) > 0
        used = context[new]
        share = np.clip(-(-2 * self.tasks * self.n_before[used] // max(self.tokens, 1)), 1, self.tasks)
        offset = np.cumsum(share) - share
        own = np.cumsum(new) - 1
        group = offset[own] + np.where(share[own] > 1, _spread(self.numbers[word] + 1) % share[own], 0)
        in_groups = np.argsort(group, kind="stable") if (share > 1).any() else np.arange(len(group))
        sizes = np.bincount(group, minlength=int(share.sum()))
        told = np.bincount(group, weights=n * np.log(parent), minlength=len(sizes))
        held = np.repeat(used, share)
        split = np.repeat(share > 1, share)
        piece = np.arange(len(held)) - np.repeat(offset, share)
        slot = (_spread(self.ids_before[held] + 1) + piece) % self.tasks * 2 + split
        by_slot = np.argsort(slot.astype(np.min_scalar_type(2 * self.tasks)), kind="stable")
        ends = np.cumsum(sizes)
        length = sizes[by_slot]
        place = np.arange(len(gram)) + np.repeat((ends - sizes)[by_slot] - (np.cumsum(length) - length), length)
        self.order = in_groups[place]
        self.slot, self.held, self.split, self.length = slot[by_slot], held[by_slot], split[by_slot], length
        self.context, self.gram_word, self.n, self.parent, self.which, self.told = context, word, n, parent, which, told[by_slot]

    def blocks(self):
        """(task, part, payload) of what ``ask`` found."""
        ids, word, n = self.ids_before[self.held], self.numbers[self.gram_word][self.order], self.n[self.order]
        ends = np.concatenate([[0], np.cumsum(self.length)])
        slots, starts = np.unique(self.slot, return_index=True)
        for slot, s, e in zip(slots.tolist(), starts.tolist(), [*starts[1:].tolist(), len(self.slot)]):
            g = slice(ends[s], ends[e])
            yield slot >> 1, slot & 1, packed(steps(ids[s:e]), self.length[s:e], self.told[s:e], word[g], n[g])

    def hear(self, answers: list, last: bool):
        """Smooths each token's probability with its context's, where that is retained."""
        n, number = np.zeros(len(self.order), dtype=np.int64), np.full(len(self.order), -1, dtype=np.int64)
        types, total, told = (np.zeros(len(self.slot)) for _ in range(3))
        ends = np.concatenate([[0], np.cumsum(self.length)])
        for key, part, payload in answers:
            s, e = np.searchsorted(self.slot, [key * 2 + part, key * 2 + part + 1])
            got = iter(unpacked(payload))
            own = n[ends[s]:ends[e]]
            types[s:e] = next(got)
            if part:
                total[s:e], told[s:e] = next(got), next(got)
            else:
                total[s:e][types[s:e] > 0] = next(got)
            if last and not part:
                own[np.repeat(types[s:e] > 0, self.length[s:e])] = next(got)
            else:
                own[:] = next(got)
            if not last:
                number[ends[s]:ends[e]][own >= MIN_CONTEXT] = np.cumsum(next(got)) * self.tasks + key
        contexts = len(self.ids_before)
        types, total, told, split = (np.bincount(self.held, weights=x, minlength=contexts) for x in (types, total, told, self.split))
        types = np.where((split > 0) & ~_retained(types, total, told), 0, types)
        counted = np.empty_like(n)
        counted[self.order] = n
        types, total = types[self.context], total[self.context]
        p = np.where(types > 0, (counted + types * self.parent) / np.maximum(total + types, 1), self.parent)
        self.p = self.p.copy()
        self.p[self.at] = p[self.which]
        if last:
            return
        numbered = np.empty_like(number)
        numbered[self.order] = number
        ids, first, rank = _distinct(numbered)
        none = int(len(ids) > 0 and ids[0] < 0)
        often = counted[first]
        ending = np.full(len(self.word), -1, dtype=np.int32)
        ending[self.at] = rank[self.which] - none
        self._follow(ending, ids[none:], often[none:])

    def scores(self):
        """A row for each text."""
        token = np.ones(len(self.word), dtype=bool)
        token[self.starts] = False
        total = self.tokens + self.distinct + 1
        sums = [np.add.reduceat(np.where(token, x, 0), self.starts).tolist() for x in (
            (self.c > 0).astype(np.int64)[self.word], np.log10(self.c + 1.0)[self.word], np.log10(self.p / ((self.c + 1) / total)[self.word]))]
        for doc_id, size, n_known, log_count, gain in zip(self.ids, self.sizes.tolist(), *sums):
            base = log_count - (size - 1) * log10(total)
            yield doc_id, size - 1, n_known, self.tokens, base, base + gain


def _chunks_heard(tasks: int, heard: int, depth: int):
    """Takes in the answers of ``heard`` depths; then asks for the next depth's grams, or gives the scores."""
    def run(rows):
        for key, own in _by_key(rows).items():
            of = defaultdict(list)
            for level, sender, part, payload in own:
                of[level].append((sender, payload) if level == WORDS else (sender, part, payload))
            if not of[TEXTS]:
                continue
            chunk = _Chunk(tasks, of[TEXTS][0][-1], of[WORDS])
            for level in range(1, heard + 1):
                chunk.ask()
                chunk.hear(of[level], level == depth)
            if heard == depth:
                yield from chunk.scores()
            else:
                chunk.ask()
                for task, part, payload in chunk.blocks():
                    yield task, (heard + 1, key, part, payload)

    return run


def score(docs: DataFrame, teaches: Column, max_depth: int = MAX_DEPTH) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every document; learns from rows that ``teaches`` selects."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(teaches, F.lit(False)).alias("teaches"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))

    def dealt(rdd):
        return rdd.partitionBy(tasks, _place)

    read = texts.mapInArrow(_chunks(tasks), "task int, serial int, target int, payload binary").rdd
    width = read.getNumPartitions()
    # a chunk's key is a number of its own; its texts and its words move in one exchange
    first = dealt(read.map(lambda r: (r["task"] + r["serial"] * width, (TEXTS, 0, 0, bytes(r["payload"]))) if r["target"] < 0 else (
        r["target"], (WORDS, r["task"] + r["serial"] * width, 0, bytes(r["payload"])))))
    held = first.filter(lambda x: x[1][0] == TEXTS).union(dealt(first.mapPartitions(_count_words(tasks))))
    for depth in range(max_depth):
        asked = dealt(dealt(held).mapPartitions(_chunks_heard(tasks, depth, max_depth)))
        held = held.union(dealt(asked.mapPartitions(_count_grams(tasks, depth + 1 == max_depth))))
    # what belongs to a chunk is in one partition already, so dealing ``held`` moves nothing
    found = dealt(held).mapPartitions(_chunks_heard(tasks, max_depth, max_depth))
    return spark.createDataFrame(found, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double", verifySchema=False)


def op9_suffix_tree_lm(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold(F.col("doc_id"), 7) == 2
    found = score(docs, ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
