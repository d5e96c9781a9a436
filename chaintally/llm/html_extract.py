"""Main-text extraction with a recurrent block labeller.

Method.  A page is cut into its leaf text blocks.  Each block gets a vector of
its tag path (tags with the words of their class, id and role), of its
hashed words, and of its shape.  A bidirectional LSTM in numpy reads the
page's blocks in order and labels each as main text or not, so each label draws
on the whole page.  Blocks labelled main are joined in page order by one newline.

Learning.  Pages carry no labels; the teacher is the structure of the
sampled pages themselves: blocks below ``article`` or ``main`` and no boilerplate element are main
text.  Training pages are varied: elements are renamed to generic ones with telling
classes, path parts are hidden at random, and boilerplate blocks of further
kinds (headers, sidebars, notices, forms, comments, adverts) made of the
sample's own words are added, so that the network learns from words of
class names, position and neighbours, not from one template.

Scale.  The sample is ``SAMPLE`` pages of any length by least hash, cut into blocks in tasks; a page of more than
``PAGE_BLOCKS`` blocks teaches with so many, spread evenly over it.  Every page is labelled whole, row by row over Arrow batches, in groups of pages of like length.

Defined cases: a null or empty html has no text; a page without main blocks has an
empty text; unclosed and stray tags are closed or ignored; only the
content of raw-text elements (``OPAQUE``) is left out before labelling; where no page
has a block to learn from, the teacher itself labels; repeated rows give repeated results; a null url stays null; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaintally.llm.common import extended, pieces, table, text_strings, with_columns

SAMPLE, PAGE_BLOCKS = 300, 400
PATH_BUCKETS, WORD_BUCKETS, SHAPE = 512, 32, 6
PATH_SIZE, HIDDEN = 16, 12
EPOCHS, PAGES_PER_STEP, LEARNING_RATE = 8, 24, 0.02
SEED = 7

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][\w:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|[^<]+|<", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Raw-text elements, whose content is no markup and no text of the page.
OPAQUE = frozenset(("script", "style", "template", "textarea", "iframe"))
VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
# Elements that stand inside a line of text and don't end a block.
INLINE = frozenset(("a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd",
                    "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br"))
# Elements an opening tag closes, if they are open with nothing but inline elements above.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
# Elements that stand inside a paragraph as blocks of their own; in the first two an element may close itself.
FOREIGN = ("svg", "math")
CLOSES |= dict.fromkeys((*FOREIGN, "object", "canvas", "select", "noscript"), ())
MAIN = frozenset(("article", "main"))
BOILERPLATE = frozenset(("nav", "header", "footer", "aside", "form", "head", "title", "menu", "button", "dialog"))
SPACE = re.compile(r"\s+")
WORD = re.compile(r"\w+")


class Element:
    """An open element that shows in paths, with what the whole path to it holds: its parts' hashed set and the teacher's marks.

    Each is its parent's with its own parts added, so a path of any depth is known whole at the cost of its last element.
    """

    __slots__ = ("part", "parent", "held", "main", "boilerplate")

    def __init__(self, part: str = "", parent: Element | None = None):
        self.part, self.parent = part, parent
        if parent is None:
            self.held, self.main, self.boilerplate = 0, False, False
            return
        tag, bits, names = _parts_of(part)
        self.held = parent.held | bits
        self.main = parent.main or tag in MAIN
        self.boilerplate = parent.boilerplate or tag in BOILERPLATE or bool(names & BOILERPLATE_NAMES)

    @staticmethod
    def of(path) -> Element:
        element = Element()
        for part in path:
            element = Element(part, element)
        return element

    def path(self) -> tuple[str, ...]:
        out, element = [], self
        while element.parent is not None:
            out.append(element.part)
            element = element.parent
        return tuple(reversed(out))

    def last_tags(self) -> str:
        above = self.parent.part.split(".")[0] + ">" if self.parent is not None and self.parent.parent is not None else ""
        return above + self.part.split(".")[0]


class Block:
    """A leaf text block and the element that holds it."""

    __slots__ = ("text", "element", "link_chars")

    def __init__(self, text: str, place: Element | tuple[str, ...], link_chars: int = 0):
        self.text, self.link_chars = text, link_chars
        self.element = place if isinstance(place, Element) else Element.of(place)

    @property
    def path(self) -> tuple[str, ...]:
        return self.element.path()


def attribute_words(raw: str) -> str:
    """The words of class, id and role, lower-cased."""
    found = [w.lower() for m in ATTRIBUTE.finditer(raw) for w in re.findall(r"[A-Za-z]+", m[2] or m[3] or m[4] or "")]
    return ".".join(found)


class OpenElements:
    """The open elements, with what must be known of them at once; every step takes constant time for each element it opens or ends."""

    def __init__(self):
        self.stack: list[tuple[str, Element]] = []
        # depths of the open elements of each tag, and of those that are not inline
        self.depths: dict[str, list[int]] = {}
        self.firm: list[int] = []
        self.root = Element()

    def open(self, tag: str) -> bool:
        return bool(self.depths.get(tag))

    def here(self) -> Element:
        return self.stack[-1][1] if self.stack else self.root

    def push(self, tag: str, words: str) -> None:
        self.depths.setdefault(tag, []).append(len(self.stack))
        if tag not in INLINE:
            self.firm.append(len(self.stack))
        shown = tag not in INLINE or words
        self.stack.append((tag, Element(f"{tag}.{words}" if words else tag, self.here()) if shown else self.here()))

    def cut(self, depth: int) -> None:
        while len(self.stack) > depth:
            tag, _ = self.stack.pop()
            self.depths[tag].pop()
            if tag not in INLINE:
                self.firm.pop()

    def close(self, tag: str) -> None:
        """An end tag; a stray inline one doesn't close the blocks above it."""
        if self.open(tag):
            depth = self.depths[tag][-1]
            if tag not in INLINE or not self.firm or depth > self.firm[-1]:
                self.cut(depth)

    def close_before(self, tag: str) -> None:
        """What an opening block tag ends: an open paragraph, or its like in lists and tables."""
        if self.firm and self.stack[self.firm[-1]][0] in CLOSES.get(tag, ("p",)):
            self.cut(self.firm[-1])


def blocks(page: str) -> list[Block]:
    """Leaf text blocks in page order."""
    out: list[Block] = []
    elements = OpenElements()
    pieces: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = SPACE.sub(" ", entities.unescape("".join(pieces))).strip()
            if text:
                out.append(Block(text, elements.here(), linked))
            pieces.clear()
        linked = 0

    at, size = 0, len(page)
    while at < size:
        m = TOKEN.match(page, at)
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            if not m[0].startswith(("<!", "<?")):
                pieces.append(m[0])
                linked += len(m[0]) if elements.open("a") else 0
        elif tag == "br":
            pieces.append(" ")
        elif m[1]:
            if tag not in INLINE:
                flush()
            elements.close(tag)
        elif tag in OPAQUE:
            flush()
            if not m[3].rstrip().endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
                at = end.end() if end else size
        elif tag in VOID or m[3].rstrip().endswith("/") and (tag in FOREIGN or any(map(elements.open, FOREIGN))):
            if tag not in INLINE:
                flush()
        else:
            if tag not in INLINE:
                flush()
                elements.close_before(tag)
            elements.push(tag, attribute_words(m[3]))
    flush()
    return out


def bucket(part: str, size: int) -> int:
    return zlib.crc32(part.encode("utf-8", "replace")) % size


@lru_cache(maxsize=1 << 14)
def _parts_of(part: str) -> tuple[str, int, frozenset[str]]:
    """Tag of a path part, the set of its hashed tag and attribute words as bits, and these words."""
    tag, *words = part.split(".")
    names = frozenset(w.rstrip("s") for w in words)  # plural and singular are one word
    bits = 1 << bucket(tag, PATH_BUCKETS)
    for name in names:
        bits |= 1 << bucket("#" + name, PATH_BUCKETS)
    return tag, bits, names


class Reader:
    """Block features; what is hashed is remembered while it is common."""

    LIMIT = 200_000

    def __init__(self):
        self.paths: dict[int, np.ndarray] = {}
        self.words: dict[str, int] = {}

    def path(self, element: Element) -> np.ndarray:
        """Hashed parts of the whole path: each tag, each attribute word, and the last two tags together."""
        held = element.held | 1 << bucket(">" + element.last_tags(), PATH_BUCKETS)
        found = self.paths.get(held)
        if found is None:
            if len(self.paths) > self.LIMIT // 10:
                self.paths.clear()
            bits = np.frombuffer(held.to_bytes(PATH_BUCKETS // 8, "little"), dtype=np.uint8)
            found = self.paths[held] = np.flatnonzero(np.unpackbits(bits, bitorder="little"))
        return found

    def word(self, word: str) -> int:
        found = self.words.get(word)
        if found is None:
            if len(self.words) > self.LIMIT:
                self.words.clear()
            found = self.words[word] = bucket(word, WORD_BUCKETS)
        return found

    def dense(self, block: Block, place: float) -> np.ndarray:
        """Hashed words (as shares) and shape: length, links, sentence ends, capitals, digits, place in the page."""
        text = block.text
        words = WORD.findall(text.lower())
        out = np.zeros(WORD_BUCKETS + SHAPE)
        if words:
            out[:WORD_BUCKETS] = np.bincount([self.word(w) for w in words], minlength=WORD_BUCKETS) / len(words)
        n = len(text)
        out[WORD_BUCKETS:] = (np.log1p(n) / 8, min(1.0, block.link_chars / n), min(1.0, sum(map(text.count, ".!?")) / (len(words) + 1) * 4),
                              text[:1].isupper(), any(c.isdigit() for c in text[:40]), place)
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block vectors with a logistic output per block."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        width = PATH_SIZE + WORD_BUCKETS + SHAPE

        def start(rows, cols):
            return rng.normal(0, 1 / np.sqrt(rows), (rows, cols))

        self.p = {"path": rng.normal(0, 0.3, (PATH_BUCKETS, PATH_SIZE)), "out": start(2 * HIDDEN + width, 1), "bias": np.zeros(1)}
        for d in "fb":
            self.p |= {f"wx{d}": start(width, 4 * HIDDEN), f"wh{d}": start(HIDDEN, 4 * HIDDEN), f"b{d}": np.zeros(4 * HIDDEN)}
            self.p[f"b{d}"][HIDDEN:2 * HIDDEN] = 1.0  # remember at first

    def inputs(self, paths: list[list[np.ndarray]], dense: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Padded inputs (pages, blocks, width) and the mask of real blocks."""
        longest = max(map(len, paths))
        x = np.zeros((len(paths), longest, PATH_SIZE + WORD_BUCKETS + SHAPE))
        mask = np.zeros((len(paths), longest))
        for k, (page, d) in enumerate(zip(paths, dense)):
            for t, ids in enumerate(page):
                x[k, t, :PATH_SIZE] = self.p["path"][ids].sum(axis=0)
            x[k, :len(page), PATH_SIZE:] = d
            mask[k, :len(page)] = 1
        return x, mask

    def _direction(self, x: np.ndarray, mask: np.ndarray, d: str, keep: bool):
        n, steps, _ = x.shape
        pre = x @ self.p[f"wx{d}"] + self.p[f"b{d}"]
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        out, saved = np.zeros((n, steps, HIDDEN)), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[:, t] + h @ self.p[f"wh{d}"]
            gates = sigmoid(z[:, :3 * HIDDEN])
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
            g = np.tanh(z[:, 3 * HIDDEN:])
            m = mask[:, t:t + 1]
            new = f * c + i * g
            bent = np.tanh(new)
            if keep:
                saved.append((t, i, f, o, g, c, bent, h, m))
            c = m * new + (1 - m) * c
            h = m * o * bent + (1 - m) * h
            out[:, t] = h
        return out, saved

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        both = [self._direction(x, mask, d, keep) for d in "fb"]
        joined = np.concatenate((both[0][0], both[1][0], x), axis=2)
        return sigmoid((joined @ self.p["out"])[..., 0] + self.p["bias"]), joined, [b[1] for b in both]

    def gradients(self, paths, dense, labels: np.ndarray) -> dict[str, np.ndarray]:
        x, mask = self.inputs(paths, dense)
        prob, joined, saved = self.forward(x, mask, keep=True)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        error = (prob - labels) * mask / mask.sum()
        g["out"][:, 0] = np.einsum("ntk,nt->k", joined, error)
        g["bias"][0] = error.sum()
        back = error[..., None] * self.p["out"][:, 0]
        dx = back[..., 2 * HIDDEN:].copy()
        for d, at, steps in (("f", 0, saved[0]), ("b", HIDDEN, saved[1])):
            dh, dc = np.zeros((len(x), HIDDEN)), np.zeros((len(x), HIDDEN))
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN))
            for t, i, f, o, gate, c, bent, h, m in reversed(steps):
                dh = dh + back[:, t, at:at + HIDDEN]
                dnew = m * dc + m * dh * o * (1 - bent ** 2)
                dz = np.concatenate((dnew * gate * i * (1 - i), dnew * c * f * (1 - f), m * dh * bent * o * (1 - o),
                                     dnew * i * (1 - gate ** 2)), axis=1)
                dz_all[:, t] = dz
                g[f"wh{d}"] += h.T @ dz
                dh = dz @ self.p[f"wh{d}"].T + (1 - m) * dh
                dc = dnew * f + (1 - m) * dc
            g[f"wx{d}"] += np.einsum("ntk,ntj->kj", x, dz_all)
            g[f"b{d}"] += dz_all.sum(axis=(0, 1))
            dx += dz_all @ self.p[f"wx{d}"].T
        for k, page in enumerate(paths):
            for t, ids in enumerate(page):
                g["path"][ids] += dx[k, t, :PATH_SIZE]
        return g

    def fit(self, pages: list[tuple[list[np.ndarray], np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> None:
        """Adam over (path buckets, dense vectors, labels) of pages."""
        rng = np.random.default_rng(SEED)
        mean, square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for s in range(0, len(order), PAGES_PER_STEP):
                part = [pages[k] for k in order[s:s + PAGES_PER_STEP]]
                labels = np.zeros((len(part), max(len(y) for _, _, y in part)))
                for line, (_, _, y) in zip(labels, part):
                    line[:len(y)] = y
                g = self.gradients([p for p, _, _ in part], [d for _, d, _ in part], labels)
                norm = np.sqrt(sum((v ** 2).sum() for v in g.values()))
                step += 1
                for k, v in g.items():
                    v = v / max(1.0, norm)
                    mean[k] = 0.9 * mean[k] + 0.1 * v
                    square[k] = 0.99 * square[k] + 0.01 * v * v
                    self.p[k] -= LEARNING_RATE * (mean[k] / (1 - 0.9 ** step)) / (np.sqrt(square[k] / (1 - 0.99 ** step)) + 1e-8)

    def label(self, paths: list[list[np.ndarray]], dense: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of main text for every block of every page."""
        return [p[:len(page)] for p, page in zip(self.forward(*self.inputs(paths, dense))[0], paths)]


def is_main(block: Block) -> bool:
    """The teacher: below an article or main element, and below no boilerplate element inside or outside it."""
    return block.element.main and not block.element.boilerplate


# Words of class and id that name boilerplate, and those that name main text (fixed values of the teacher).
BOILERPLATE_NAMES = frozenset((
    "ad", "advert", "advertisement", "banner", "sponsor", "sponsored", "promo", "promotion", "nav", "navigation", "navbar", "menu",
    "breadcrumb", "header", "masthead", "footer", "copyright", "sidebar", "widget", "aside", "related", "recommended", "share", "social",
    "notice", "cookie", "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "signup", "login", "form", "search", "comment",
    "reply", "replie", "discussion", "respond", "pagination", "pager", "tag", "toolbar", "topbar", "alert", "disclaimer", "legal"))
MAIN_NAMES = ("content", "article", "post", "entry", "story", "main", "body", "text", "article.body", "post.content", "entry.content",
              "main.content", "page.content", "article.content", "story.body")


def varied(page: list[Block], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A training variant of a page: renamed and hidden path parts, and further boilerplate blocks."""
    labels = [int(is_main(b)) for b in page]
    names = sorted(BOILERPLATE_NAMES)
    rename, bare = rng.random() < 0.65, rng.random() < 0.2
    holder = ("div", "section", "main", "article", "td")[rng.integers(5)]
    name = "" if holder in MAIN and rng.random() < 0.5 else "." + MAIN_NAMES[rng.integers(len(MAIN_NAMES))]
    shown = [list(b.path) for b in page]
    if rename:
        for path in shown:
            for k, part in enumerate(path):
                tag = part.split(".")[0]
                if tag in MAIN:
                    path[k] = "" if bare else holder + name
                elif tag in BOILERPLATE and tag not in ("head", "title", "button") and rng.random() < 0.5:
                    path[k] = f"div.{tag}"
    rows = [(Block(b.text, tuple(filter(None, p)), b.link_chars), y) for b, p, y in zip(page, shown, labels)]
    spoken = [w for b in page for w in b.text.split()]
    wrap = tuple(rows[len(rows) // 2][0].path[:1]) if rows else ("html",)
    main_rows = [k for k, (_, y) in enumerate(rows) if y]
    for _ in range(int(rng.integers(0, 5))):
        what = names[rng.integers(len(names))]
        words = [spoken[k] for k in rng.integers(len(spoken), size=rng.integers(2, 60))] if spoken else ["x"]
        tag = ("div", "section", "aside", "ul", "form", "header", "footer", "nav", "div", "p")[rng.integers(10)]
        inner = ("p", "li", "a", "span", "h1", "h2", "h3", "label", "div", "p")[rng.integers(10)]
        second = "." + what if rng.random() < 0.8 or tag not in BOILERPLATE else ""
        inside = bool(main_rows) and rng.random() < 0.35
        before = rows[main_rows[0]][0].path[:-1] if inside else (*wrap, "body")
        new = [(Block(" ".join(words), (*before, tag + second, inner), 0 if rng.random() < 0.6 else len(" ".join(words))), 0)
               for _ in range(int(rng.integers(1, 4)))]
        at = int(rng.integers(len(rows) + 1))
        if inside:
            at = main_rows[rng.integers(len(main_rows))] + 1
        rows[at:at] = new
        main_rows = [k for k, (_, y) in enumerate(rows) if y]
    return [b for b, _ in rows], [y for _, y in rows]


def features(page: list[Block], reader: Reader) -> tuple[list[np.ndarray], np.ndarray]:
    n = len(page)
    return ([reader.path(b.element) for b in page],
            np.stack([reader.dense(b, k / n) for k, b in enumerate(page)]) if n else np.zeros((0, WORD_BUCKETS + SHAPE)))


def drawn(page: list[Block]) -> list[Block]:
    """Up to ``PAGE_BLOCKS`` blocks, spread evenly over the page."""
    if len(page) <= PAGE_BLOCKS:
        return page
    return [page[k] for k in np.linspace(0, len(page) - 1, PAGE_BLOCKS).astype(int)]


def train(pages: list[str], variants: int = 4) -> dict[str, np.ndarray]:
    """Weights learned from sampled pages."""
    return fit([drawn(blocks(raw)) for raw in pages], variants)


def fit(pages: list[list[Block]], variants: int = 4) -> dict[str, np.ndarray]:
    """Weights learned from the blocks of pages; none where there is no block."""
    rng, reader, rows = np.random.default_rng(SEED), Reader(), []
    for found in pages:
        if found:
            for k in range(variants):
                page, labels = varied(found, rng) if k else (found, [int(is_main(b)) for b in found])
                paths, dense = features(page, reader)
                hidden = [ids[rng.random(len(ids)) > 0.1] if k else ids for ids in paths]
                rows.append((hidden, dense, np.array(labels)))
    if not rows:
        return {}
    model = Labeller()
    model.fit(rows)
    return model.p


def learn(pages: DataFrame) -> dict[str, np.ndarray]:
    """Weights from the sample of pages."""
    keyed = pages.where(F.length("html") > 0).select(F.xxhash64("page_id", "url").alias("h"), F.xxhash64("html").alias("t"), "html")
    last = keyed.select("h").orderBy("h").limit(SAMPLE).agg(F.max("h")).first()[0]
    schema = with_columns(keyed.drop("html").schema, ("blocks", BLOCKS))

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "html"):
                yield extended(part, schema, {"blocks": [[{"text": b.text, "path": b.path, "link_chars": b.link_chars} for b in drawn(blocks(p))] for p in text_strings(part, "html")]})

    sample = keyed.where(F.col("h") <= F.lit(last)).mapInArrow(run, schema).orderBy("h", "t").limit(SAMPLE).select("blocks").collect()
    return fit([[Block(b["text"], tuple(b["path"]), b["link_chars"]) for b in r["blocks"]] for r in sample])


BLOCKS = T.ArrayType(T.StructType([
    T.StructField("text", T.StringType()), T.StructField("path", T.ArrayType(T.StringType())), T.StructField("link_chars", T.LongType())]))


# Padded blocks labelled at once.
GROUP_BLOCKS = 40_000


def main_texts(pages: list[str], model: Labeller, reader: Reader) -> list[str]:
    """The main text of each page."""
    cut = [blocks(p) for p in pages]
    if not model.p:  # nothing was learned
        return ["\n".join(b.text for b in page if is_main(b)) for page in cut]
    order = sorted((k for k in range(len(cut)) if cut[k]), key=lambda k: len(cut[k]))
    out, at = [""] * len(cut), 0
    while at < len(order):
        group = [order[at]]
        at += 1
        while at < len(order) and len(cut[order[at]]) * (len(group) + 1) <= GROUP_BLOCKS and len(cut[order[at]]) <= 1.3 * len(cut[group[0]]) + 4:
            group.append(order[at])
            at += 1
        found = [features(cut[k], reader) for k in group]
        for k, p in zip(group, model.label([f[0] for f in found], [f[1] for f in found])):
            out[k] = "\n".join(b.text for b, y in zip(cut[k], p) if y >= 0.5)
    return out


def extract(pages: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """The pages with ``text``, their main text, in place of ``html``."""
    schema = with_columns(pages.schema, ("text", T.StringType()))
    shared = pages.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        model, reader = Labeller(), Reader()
        model.p = shared.value
        for batch in batches:
            for part in pieces(batch, "html"):
                yield extended(part, schema, {"text": main_texts(text_strings(part, "html"), model, reader)})

    return pages.mapInArrow(run, schema).drop("html")


def op4_html_extract(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = extract(pages, learn(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
