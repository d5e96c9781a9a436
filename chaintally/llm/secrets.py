"""Secret scan: credential patterns plus guess cost of values in credential contexts.

Method.  Three base patterns are matched in every whole text.  Besides, each value
that stands in a credential context (``pwd = ...``, ``passphrase: ...``) gets a guess
cost: the cheapest way to cut it into words, dates, repeats, keyboard walks
and brute-force spans, in log10 guesses, by dynamic programming over its
characters.  Values at or above ``MIN_COST`` are secrets of kind ``guess``.  Words are ranked by
their frequency: first a few that passwords are made of, then the corpus's own (``learn_words``).
A repeat is a block of any length that stands twice or more: all maximal repetitions
of a value are found by comparing it with itself at every distance, at as many places as blocks of
that size fit, through prefix hashes.

Scale.  The words are counted over all texts in two map-side passes and are at most 1 / ``WORD_SHARE``.
The search is row by row over Arrow batches; no shuffle.  A keyword test skips the
expression where no keyword stands.  The cutting takes n log n steps for a value of length n.

Defined cases: a null text is empty and has no spans; repeated rows give repeated
results; very long texts and values are read whole; an empty table gives an
empty result; extra columns pass through, and one named like a new column
is replaced.
"""

from __future__ import annotations

import re
from math import log10

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaintally.llm.common import extended, frequent_words, parts, table, text_strings, with_columns

# Fixed values of the contract.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# the runs of 32 or more among the matches of [0-9a-f]+
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS = 8, 16

# Contexts whose values are tested by guess cost.
CONTEXT = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|credentials?)"
    r"[\"']?[\x20\t]*(?:=>|:=|[:=])[\x20\t]*[\"']?([^\s\"'<>]+)", re.I | re.A)
HINTS = ("pass", "pwd", "secret", "token", "key", "credential")
# Share of all words from which one is a word to guess (there are 1 / WORD_SHARE of them at most), and its longest length.
WORD_SHARE, MAX_WORD = 2e-5, 24
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(256))
# log10 guesses from which a value counts as a secret.
MIN_COST = 10.0

# Fixed words of guessable passwords, commonest first.
COMMON = ("password", "qwerty", "admin", "welcome", "letmein", "monkey", "dragon", "master", "login", "secret",
          "sunshine", "princess", "football", "baseball", "shadow", "superman", "batman", "trustno", "hello", "freedom",
          "whatever", "michael", "jordan", "hunter", "summer", "winter", "spring", "autumn", "love", "root", "test",
          "guest", "default", "changeme", "example", "user", "server", "access", "private", "public", "token", "the",
          "pass", "word", "none", "null", "true", "false", "your", "here", "value", "string", "my", "key", "data", "demo")
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("4@8301!$57", "aabeolisst")
_DATE = re.compile(r"(?:(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
                   r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d)")
_YEAR = re.compile(r"(?:19|20)\d\d")

def _neighbours() -> set[tuple[str, str]]:
    """Ordered pairs of adjacent keys, and of successive letters and digits."""
    pairs = set()
    for r, row in enumerate(KEY_ROWS):
        for c, key in enumerate(row):
            near = [(r, c + 1), (r + 1, c), (r + 1, c - 1)]
            for rr, cc in near:
                if rr < len(KEY_ROWS) and 0 <= cc < len(KEY_ROWS[rr]):
                    pairs |= {(key, KEY_ROWS[rr][cc]), (KEY_ROWS[rr][cc], key)}
    for run in ("abcdefghijklmnopqrstuvwxyz", "0123456789"):
        pairs |= set(zip(run, run[1:])) | set(zip(run[1:], run))
    return pairs


_NEAR = _neighbours()


def _char_cost(ch: str) -> float:
    if ch.isdigit():
        return 1.0
    if "a" <= ch <= "z":
        return log10(26)
    return log10(62) if "A" <= ch <= "Z" else log10(95)


def repetitions(value: str) -> list[tuple[int, int, int]]:
    """(start, end, size) of the maximal runs in which a block of ``size`` characters, the least there is, stands twice or more."""
    n = len(value)
    codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _BASE))))
        sums = np.concatenate(([np.uint64(0)], np.cumsum((codes + np.uint64(1)) * powers[:n])))

    def same(i: np.ndarray, length: np.ndarray, size: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (sums[i + length] - sums[i]) * powers[size] == sums[i + size + length] - sums[i + size]

    def longest(most: np.ndarray, size: np.ndarray, start) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            half = (low + high + 1) // 2
            fits = same(start(half), half, size)
            low, high = np.where(fits, half, low), np.where(fits, high, half - 1)
        return low

    found: dict[tuple[int, int], int] = {}
    first = 1
    while 2 * first <= n:
        # sizes whose places are up to a million together
        last = first
        places = (n - 1) // first
        while 2 * (last + 1) <= n and places + (n - 1) // (last + 1) <= 1 << 20:
            last += 1
            places += (n - 1) // last
        sizes = np.arange(first, last + 1)
        counts = (n - 1) // sizes
        size = np.repeat(sizes, counts)
        at = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * size
        ahead = longest(n - at - size, size, lambda half, at=at: at)
        back = longest(at.copy(), size, lambda half, at=at: at - half)
        start, end = at - back, at + size + ahead
        for k in np.flatnonzero(end - start >= 2 * size).tolist():
            run = int(start[k]), int(end[k])
            # sizes rise, so a run is first met with its least block
            if run not in found and (codes[run[0]:run[1] - size[k]] == codes[run[0] + size[k]:run[1]]).all():
                found[run] = int(size[k])
        first = last + 1
    return sorted((s, e, size) for (s, e), size in found.items())


_BASE = np.uint64(0x9E3779B97F4A7C15)


class Guesser:
    """Guess costs with given words, commonest first."""

    def __init__(self, words=COMMON):
        self.ranks: dict[str, int] = {}
        for w in words:
            self.ranks.setdefault(w, len(self.ranks) + 1)
        self.longest = max(map(len, self.ranks), default=0)
        # the longest word or date
        self.window = max(self.longest, 10)

    def lengths(self, least: int, most: int) -> list[int]:
        """Lengths at which a run may end in a cheapest segmentation.

        A word, date or other run that goes on beyond its end overlaps it by a word
        or date at most, and one inside it pays only after a short beginning.
        """
        if most - least <= 2 * self.window:
            return list(range(least, most + 1))
        return [*range(least, least + self.window), *range(most - self.window, most + 1)]

    def cost(self, value: str) -> float:
        """log10 guesses of the cheapest segmentation of a value."""
        n, low = len(value), value.lower()
        plain = low.translate(LEET)
        if len(low) != n:  # a letter whose lower case is longer: treat the value as it is
            low = plain = value
        best = [0.0] + [float("inf")] * n
        # length of the keyboard walk from each place
        walk = [1] * (n + 1)
        for i in range(n - 2, -1, -1):
            walk[i] = walk[i + 1] + 1 if (low[i], low[i + 1]) in _NEAR else 1
        each = [_char_cost(c) for c in value]
        # blocks that stand again from each place: size and how often
        again: dict[int, list[tuple[int, int]]] = {}
        for start, end, size in repetitions(value):
            for i in range(start, end - 2 * size + 1):
                if size > 1 or end - i >= 3:
                    again.setdefault(i, []).append((size, (end - i) // size))

        def offer(i: int, j: int, cost: float) -> None:
            if best[i] + cost < best[j]:
                best[j] = best[i] + cost

        for i in range(n):
            offer(i, i + 1, each[i])
            for size in range(2, min(self.longest, n - i) + 1):
                for text, extra in ((low, 0.0), (plain, 0.5)):
                    rank = self.ranks.get(text[i:i + size])
                    if rank:
                        mixed = 0.0 if value[i:i + size] == text[i:i + size] else 0.5
                        offer(i, i + size, log10(rank + 1) + extra + mixed)
            if walk[i] >= 3:
                for k in self.lengths(3, walk[i]):
                    offer(i, i + k, log10(47 * 4) + log10(k))
            for size, times in again.get(i, ()):  # a block written again and again
                block = sum(each[i:i + size])
                for k in self.lengths(3 if size == 1 else 2, times):
                    offer(i, i + k * size, block + log10(k))
            if value[i].isdigit():
                for pattern, cost in ((_DATE, log10(365 * 120)), (_YEAR, log10(120))):
                    m = pattern.match(value, i)
                    if m:
                        offer(i, m.end(), cost)
        return best[n]


PLAIN = Guesser()


def guess_cost(value: str) -> float:
    """log10 guesses of the cheapest segmentation with the few words of passwords only."""
    return PLAIN.cost(value)


def corpus_words(raw: bytes) -> list[bytes]:
    """Runs of the letters A-Z, lower-cased, of a length that words have."""
    return [w for w in raw.translate(_LETTERS).split() if 3 <= len(w) <= MAX_WORD]


def learn_words(docs: DataFrame, share: float = WORD_SHARE) -> list[str]:
    """The words of guessable passwords: the fixed ones, then the corpus's most frequent, commonest first."""
    return [*COMMON, *(w.decode() for w, _ in frequent_words(docs, share, corpus_words))]


def scan(text: str, guesser: Guesser = PLAIN) -> list[tuple[str, int, int, int, int, float | None]]:
    """(kind, start, end, value start, value end, cost), by start and then kind."""
    lowered = text.lower()
    hinted = any(h in lowered for h in HINTS)
    found = []
    if hinted:
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= MIN_ASSIGN:
                found.append(("assign", m.start(), m.end(), m.start(2), m.end(2), guesser.cost(m[2])))
    if "AKIA" in text:
        found += [("access", m.start(), m.end(), m.start(), m.end(), None)
                  for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [("hex", m.start(), m.end(), m.start(), m.end(), None) for m in HEX.finditer(text)]
    if hinted:
        covered = sorted((f[1], f[2]) for f in found)
        for m in CONTEXT.finditer(text):
            start = m.start(1)
            end = start + len(m[1].rstrip(".,;:!?)]}|"))
            if end - start < 6 or any(s <= start and end <= e for s, e in covered):
                continue
            cost = guesser.cost(text[start:end])
            if cost >= MIN_COST:
                found.append(("guess", start, end, start, end, cost))
    order = {k: i for i, k in enumerate((*KINDS, "guess"))}
    return sorted(found, key=lambda f: (f[1], order[f[0]]))


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("value_start", T.IntegerType()), T.StructField("value_end", T.IntegerType()),
    T.StructField("cost", T.DoubleType())]))


def find_secrets(docs: DataFrame, words: list[str] | None = None) -> DataFrame:
    """The documents with ``spans``: kind, start and end of each secret, its value's place and guess cost.

    ``words``: those of guessable passwords, commonest first; by default they are learned from ``docs``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(learn_words(docs) if words is None else words)
    schema = with_columns(docs.schema, ("spans", SPANS))
    names = [f.name for f in SPANS.elementType]

    def run(batches):
        guesser = Guesser(shared.value)
        for part in parts(batches):
            yield extended(part, schema, {"spans": [[dict(zip(names, s)) for s in scan(t, guesser)] for t in text_strings(part)]})

    return docs.mapInArrow(run, schema)


def masked(text: str, mask: str, guesser: Guesser = PLAIN) -> str:
    """The text with the value of every secret replaced; overlapping values become one mask."""
    out, at = [], 0
    for _, _, _, start, end, _ in sorted(scan(text, guesser), key=lambda s: s[3]):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, mask: str = "[SECRET]", words: list[str] | None = None) -> DataFrame:
    """The documents with secret values masked and n_chars counted anew; all others as they are.  ``words`` as in ``find_secrets``."""
    schema = docs.schema
    shared = docs.sparkSession.sparkContext.broadcast(learn_words(docs) if words is None else words)

    def run(batches):
        guesser = Guesser(shared.value)
        for batch in parts(batches):
            raw = batch.column(batch.schema.get_field_index("text")).to_pylist()
            clean = [t and masked(t, mask, guesser) for t in raw]
            values = {"text": clean}
            if "n_chars" in schema.names:
                counts = batch.column(batch.schema.get_field_index("n_chars")).to_pylist()
                values["n_chars"] = [n if c == t else len(c) for n, c, t in zip(counts, clean, raw)]
            yield extended(batch, schema, values)

    return docs.mapInArrow(run, schema)


def op10_secrets(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "spans")

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
                        F.transform("spans", lambda s: F.round(s["cost"], 6)).alias("costs"))
