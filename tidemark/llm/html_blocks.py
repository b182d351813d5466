"""Main text of web pages by a recurrent block labeller.

A page is cut into blocks, the stretches of text between block-level tags. Each block becomes a vector: hashed tags
and class words of the elements around it, hashed words of its text, and a few numbers. A bidirectional LSTM in numpy
reads all blocks of a page, forwards and backwards, and labels each as main text or not, so that a block is judged in
the light of the whole page. The text of the main blocks, in page order, is the result.

There are no labelled pages, so the network learns from weak labels: what stands in a navigation, footer, advert and so
on of a bounded sample of the pages is not main text, the body of the article is. Blocks in further kinds of containers
(comments, notices, sidebars, forms) are mixed in under names from a fixed list, with text of the page's own, so that
the network has to go by the containers and by the company of a block. Some copies have their main text in containers
without a name or with one that says nothing, next to bars of links in such containers, so that a page without telling
names is judged by its texts and links. Pages are labelled where they lie, a slice at a
time, without a shuffle.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import codes, prepare, slices, spare

TAG_BITS, CLASS_BITS, WORD_BITS, NUMBERS = 128, 384, 24, 6
WIDTH = TAG_BITS + CLASS_BITS + WORD_BITS + NUMBERS
HIDDEN = 20
#: Pages that the network is fitted on, the longest page among them in characters, and mixed copies of each page.
SAMPLE_PAGES, SAMPLE_CHARS, COPIES = 240, 60_000, 6
#: Block vectors held at a time when pages are labelled.
CELLS = 1 << 16

#: A self-closed svg or math, whose last attribute value is no unquoted one ending in /, holds nothing.
ALONE = r"""<(?:svg|math)(?=[\s/>])(?:[^"'>=]|(?>=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))|"[^"]*"|'[^']*')*?/>"""
MARKUP = re.compile(r"""<!--.*?(?:-->|$)|""" + ALONE + r"""|<(script|style|template|noscript|textarea|svg|title|iframe|math)(?=[\s/>])(?:[^"'>]|"[^"]*"|'[^']*')*>.*?(?:</\1\s*>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*)>""", re.S | re.I)
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
BREAKS_NOTHING = INLINE | {"br", "wbr", "img"}
#: Tags that can stand in a head; any other, and text, ends it.
HEAD = frozenset("html base basefont bgsound link meta title noscript noframes style script template".split())
#: Open elements that a start tag ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("table ul ol dl select article section div nav aside main body html".split())

#: Names of containers, for the weak labels and for blocks that are mixed in.
OTHER_TAGS = ("nav", "footer", "aside", "form", "header", "menu", "button", "select", "dialog", "fieldset")
OTHER_NAMES = ("ad", "ads", "advert", "advertisement", "banner", "promo", "sponsor", "sponsored", "sidebar", "menu", "nav", "navbar", "breadcrumb", "breadcrumbs", "footer", "header", "masthead", "cookie", "consent", "notice", "popup", "modal", "newsletter", "subscribe", "signup", "login", "share", "social", "related", "recommended", "comment", "comments", "reply", "replies", "disqus", "respond", "widget", "copyright", "legal", "toolbar", "pagination", "search")
MAIN_NAMES = ("content", "article", "post", "entry", "body", "text", "story", "main", "page", "wrapper", "container", "section", "row", "column")


@dataclass
class Block:
    path: tuple[str, ...]
    text: str
    linked: int = 0


@dataclass
class Parser:
    """Cuts a page into blocks. Broken markup never fails: what cannot be a tag is text, what is open stays open."""

    blocks: list[Block] = field(default_factory=list)
    stack: list[tuple[str, str]] = field(default_factory=list)
    parts: list[str] = field(default_factory=list)
    links: int = 0
    linked: int = 0
    in_head: bool = False

    def flush(self) -> None:
        if self.parts:
            text = " ".join(html.unescape("".join(self.parts)).split())
            if text:
                self.blocks.append(Block(tuple(x for _, x in self.stack), text, self.linked))
            self.parts, self.linked = [], 0

    def close(self, name: str) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            if self.stack[k][0] == name:
                self.links -= sum(t == "a" for t, _ in self.stack[k:])
                del self.stack[k:]
                return
            if name in INLINE and self.stack[k][0] not in INLINE:
                return  # an inline end tag does not end a block around it

    def end_open(self, names: set[str], scopes: frozenset[str]) -> None:
        for k in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[k][0]
            if tag in names:
                self.close(tag)
                return
            if tag in scopes:
                return

    def leave_head(self) -> None:
        if self.in_head:
            self.in_head = False
            self.close("head")

    def add(self, text: str) -> None:
        if text:
            if self.in_head and not text.isspace():
                self.leave_head()
            self.parts.append(text)
            if self.links:
                self.linked += len(text)

    def run(self, page: str) -> list[Block]:
        at = 0
        for m in MARKUP.finditer(page):
            self.add(page[at : m.start()])
            at = m.end()
            name = m[3]
            if name is None:
                if m[1] is not None and m[1].lower() not in ("svg", "math"):
                    self.flush()
                continue
            name = name.lower()
            if name not in BREAKS_NOTHING:
                self.flush()
            elif name == "br":
                self.parts.append(" ")
            if not m[2] and name not in HEAD:
                self.leave_head()
            if m[2]:
                self.close(name)
            elif name not in VOID:
                self.in_head = self.in_head or name == "head"
                if name not in INLINE:
                    self.end_open({"p"}, SCOPES)
                    if name in ENDS:
                        self.end_open(ENDS[name], SCOPES)
                words = ""
                if m[4] and "=" in m[4]:
                    words = "." + ".".join(w.lower() for x in NAMED.findall(m[4]) for w in WORD.findall("".join(x)))
                self.stack.append((name, name + words.rstrip(".")))
                self.links += name == "a"
        self.add(page[at:])
        self.flush()
        return self.blocks


def blocks_of(page: str) -> list[Block]:
    """Blocks of the page with a text, the title and other text of the head left out."""
    return [b for b in Parser().run(page) if not any(x.split(".")[0] == "head" for x in b.path)]


def hashed(word: str, size: int) -> int:
    return zlib.crc32(word.encode()) % size


class Encoder:
    """Vectors of blocks; those of paths are remembered up to a bound."""

    def __init__(self) -> None:
        self.paths: dict[tuple[str, ...], np.ndarray] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) > 20_000:
                self.paths.clear()
            x = np.zeros(TAG_BITS + CLASS_BITS, np.float32)
            for element in path:
                tag, *names = element.split(".")
                if tag not in INLINE:
                    x[hashed(tag, TAG_BITS)] = 1
                for name in names:
                    x[TAG_BITS + hashed(name, CLASS_BITS)] = 1
            self.paths[path] = x
        return self.paths[path]

    def parts(self, blocks: list[Block]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Vectors of the distinct paths, the number of each block's path, and the blocks' other features."""
        numbers: dict[tuple[str, ...], int] = {}
        of = np.fromiter((numbers.setdefault(b.path, len(numbers)) for b in blocks), np.int64, len(blocks))
        count = np.array([b.text.count(" ") + 1 for b in blocks])
        lists = [b.text.lower().encode().split(b" ") for b in blocks]
        read = np.array([len(x) for x in lists])
        number, distinct = codes([w for x in lists for w in x])
        place = np.fromiter((zlib.crc32(w) % WORD_BITS for w in distinct), np.int64, len(distinct))[number]
        bag = np.bincount(np.repeat(np.arange(len(blocks)), read) * WORD_BITS + place, minlength=len(blocks) * WORD_BITS)
        chars = np.array([len(b.text) for b in blocks])
        linked = np.array([b.linked for b in blocks]) / chars
        ends = [b.text[-1] in ".!?…\"'" for b in blocks]
        title = np.array([any(x[0] == "h" and x[1:2].isdigit() for x in p[-2:]) for p in numbers])[of]
        more = np.stack([np.log1p(count) / 4, np.minimum(1, linked), ends, count <= 3, np.log1p(chars) / 6, title], axis=1)
        return np.stack([self.path(p) for p in numbers]), of, np.concatenate([bag.reshape(-1, WORD_BITS) / read[:, None], more], axis=1, dtype=np.float32)

    def __call__(self, blocks: list[Block]) -> np.ndarray:
        if not blocks:
            return np.zeros((0, WIDTH), np.float32)
        paths, of, more = self.parts(blocks)
        return np.concatenate([paths[of], more], axis=1)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over blocks, a logistic layer on both states of each block."""

    def __init__(self, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        self.p = {}
        for way in "fb":
            self.p[way + "w"] = rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, 4 * HIDDEN))
            self.p[way + "r"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
            self.p[way + "c"] = np.concatenate([np.ones(HIDDEN), np.zeros(3 * HIDDEN)])
        self.p |= {"o": rng.normal(0, 0.1, 2 * HIDDEN), "d": np.zeros(1)}

    def _way(self, way: str, x: np.ndarray, mask: np.ndarray) -> list[tuple]:
        n = x.shape[0]
        h, c, out = np.zeros((n, HIDDEN), self.p["o"].dtype), np.zeros((n, HIDDEN), self.p["o"].dtype), []
        steps = range(x.shape[1]) if way == "f" else range(x.shape[1] - 1, -1, -1)
        drive = x @ self.p[way + "w"] + self.p[way + "c"]
        for t in steps:
            z = drive[:, t] + h @ self.p[way + "r"]
            gates = sigmoid(z[:, : 3 * HIDDEN])
            f, i, o = (gates[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            new = f * c + i * g
            live = mask[:, t, None]
            old_h, old_c = h, c
            c = np.where(live, new, c)
            h = np.where(live, o * np.tanh(c), h)
            out.append((t, f, i, o, g, old_h, old_c, c, h))
        return out

    def forward(self, x: np.ndarray, mask: np.ndarray) -> tuple:
        states = np.zeros((*x.shape[:2], 2 * HIDDEN), self.p["o"].dtype)
        ways = {}
        for k, way in enumerate("fb"):
            ways[way] = self._way(way, x, mask)
            for step in ways[way]:
                states[:, step[0], k * HIDDEN : (k + 1) * HIDDEN] = step[-1]
        return states, ways, sigmoid(states @ self.p["o"] + self.p["d"][0])

    def gradient(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy of blocks, through time in both directions."""
        states, ways, p = self.forward(x, mask)
        e = (np.where(mask, p - y, 0.0) / mask.sum()).astype(self.p["o"].dtype)
        out = {"o": np.einsum("nt,nth->h", e, states), "d": e.sum(keepdims=True).ravel()}
        for k, way in enumerate("fb"):
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), e.dtype)
            dr = np.zeros_like(self.p[way + "r"])
            dh = dc = np.zeros((x.shape[0], HIDDEN), e.dtype)
            for t, f, i, o, g, old_h, old_c, c, _ in reversed(ways[way]):
                live = mask[:, t, None]
                dh = dh + e[:, t, None] * self.p["o"][k * HIDDEN : (k + 1) * HIDDEN]
                th = np.tanh(c)
                dcell = dc + dh * o * (1 - th * th)
                dz = np.concatenate([dcell * old_c * f * (1 - f), dcell * g * i * (1 - i), dh * th * o * (1 - o), dcell * i * (1 - g * g)], axis=1)
                dz = dz * live
                dz_all[:, t] = dz
                dr += old_h.T @ dz
                dh = np.where(live, dz @ self.p[way + "r"].T, dh)
                dc = np.where(live, dcell * f, dc)
            out |= {way + "w": np.einsum("ntw,ntz->wz", x, dz_all, optimize=True), way + "r": dr, way + "c": dz_all.sum(axis=(0, 1))}
        return out

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], rounds: int = 12, batch: int = 24, rate: float = 1e-2) -> Labeller:
        """Adam on batches of pages of like length; the same input gives the same network. Without pages everything is
        main text."""
        pages = sorted((p for p in pages if len(p[0])), key=lambda p: len(p[0]))
        if not pages:
            self.p["d"][0] = 1.0
        rng, step = np.random.default_rng(5), 0
        m, v = ({k: 0.0 for k in self.p} for _ in range(2))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        groups = []
        for i in range(0, len(pages), batch):
            x, mask = padded([f for f, _ in pages[i : i + batch]])
            y = np.zeros(mask.shape, np.float32)
            y[mask] = np.concatenate([labels for _, labels in pages[i : i + batch]])
            groups.append((x, mask, y))
        for turn in range(rounds):
            for k in rng.permutation(len(groups)):
                x, mask, y = groups[k]
                step += 1
                for k, g in self.gradient(x, mask, y).items():
                    g = g + 1e-5 * self.p[k]
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * 0.85**turn * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self

    def label(self, pages: list[list[Block]], encode: Encoder) -> list[np.ndarray]:
        """Chance of each block of each page to be main text; pages of like length go together.

        What paths add to the gates is worked out once per distinct path.
        """
        flat = [b for x in pages for b in x]
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        if not flat:
            return out
        paths, of, more = encode.parts(flat)
        p = {k: v.astype(np.float32) for k, v in self.p.items()}
        split = TAG_BITS + CLASS_BITS
        drive = {w: (paths @ p[w + "w"][:split])[of] + more @ p[w + "w"][split:] + p[w + "c"] for w in "fb"}
        sizes = np.array([len(x) for x in pages])
        first = np.cumsum(sizes) - sizes
        order = np.argsort(sizes, kind="stable")
        order = order[sizes[order] > 0]
        i = 0
        while i < len(order):
            j = i + 1
            while j < len(order) and (j - i + 1) * sizes[order[j]] <= CELLS:
                j += 1
            own = order[i:j]
            logit = np.zeros((len(own), sizes[own[-1]]), np.float32)
            for k, way in enumerate("fb"):
                h = c = np.zeros((len(own), HIDDEN), np.float32)
                weight = p["o"][k * HIDDEN : (k + 1) * HIDDEN]
                for t in range(logit.shape[1]):
                    live = int(np.searchsorted(sizes[own], t, side="right"))  # pages are by length: those from here go on
                    at = first[own[live:]] + (t if way == "f" else sizes[own[live:]] - 1 - t)
                    z = drive[way][at] + h[live:] @ p[way + "r"]
                    gates = sigmoid(z[:, : 3 * HIDDEN])
                    c = np.concatenate([c[:live], gates[:, :HIDDEN] * c[live:] + gates[:, HIDDEN : 2 * HIDDEN] * np.tanh(z[:, 3 * HIDDEN :])])
                    h = np.concatenate([h[:live], gates[:, 2 * HIDDEN :] * np.tanh(c[live:])])
                    logit[np.arange(live, len(own)), at - first[own[live:]]] += h[live:] @ weight
            chance = sigmoid(logit + p["d"][0])
            for row, k in enumerate(own.tolist()):
                out[k] = chance[row, : sizes[k]]
            i = j
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    longest = max(len(p) for p in pages)
    x, mask = np.zeros((len(pages), longest, WIDTH), np.float32), np.zeros((len(pages), longest), bool)
    for row, p in enumerate(pages):
        x[row, : len(p)], mask[row, : len(p)] = p, True
    return x, mask


def weak_label(block: Block) -> bool:
    """Whether the elements around a block let it pass for main text."""
    elements = [x.split(".") for x in block.path]
    inside = any(e[0] in ("article", "main") for e in elements)
    for tag, *names in elements:
        if tag in OTHER_TAGS and not (tag == "header" and inside):
            return False
        if any(n in OTHER_NAMES for n in names):
            return False
    if inside:
        return True
    return len(block.text.split()) >= 8 and block.linked < len(block.text) / 2


def made_up(rng: np.random.Generator) -> str:
    """A name that says nothing of its container."""
    return "".join("bcdfgklmnprstvwxz"[int(rng.integers(17))] + "aeiou"[int(rng.integers(5))] for _ in range(int(rng.integers(1, 4))))


def mixed(blocks: list[Block], labels: list[bool], rng: np.random.Generator) -> tuple[list[Block], list[bool]]:
    """A copy of a page with other containers: around its article, and groups of blocks of other kinds put in."""
    texts = [b.text for b, y in zip(blocks, labels, strict=True) if y] or [b.text for b in blocks] or ["text"]
    pick = lambda x: x[int(rng.integers(len(x)))]
    styles = (("article",), ("main",), ("main", "article"), (f"div.{pick(MAIN_NAMES)}", "article"), (f"div.{pick(MAIN_NAMES)}.{pick(MAIN_NAMES)}",), (f"div.{pick(MAIN_NAMES)}.{pick(MAIN_NAMES)}",), (f"div.{pick(MAIN_NAMES)}",), (f"section.{pick(MAIN_NAMES)}.{pick(MAIN_NAMES)}",), ("article", f"div.{pick(MAIN_NAMES)}"), ("main", f"section.{pick(MAIN_NAMES)}"))
    around = pick(styles)
    if rng.random() < 0.4:
        around = pick(((), ("div",), ("div", "div"), ("section",), ("table", "tr", "td"), (f"div.{made_up(rng)}",), (f"div.{made_up(rng)}", f"div.{made_up(rng)}")))
    out: list[tuple[Block, bool]] = []
    for b, y in zip(blocks, labels, strict=True):
        path = b.path
        if y and rng.random() < 0.9:
            leaf = path[-1].split(".")[0] if path else "p"
            leaf = leaf if leaf not in ("article", "main", "div", "body") else "p"
            inner = pick((("p",), ("p",), ("blockquote", "p"), ("ul", "li"), ("h2",), ("pre",), ("table", "tr", "td"), ("figure", "figcaption"))) if leaf == "p" and rng.random() < 0.25 else (leaf,)
            path = ("html", "body", *around, *inner)
        out.append((Block(path, b.text, b.linked), y))
    own = [k for k, (_, y) in enumerate(out) if y] or [0]
    for _ in range(int(rng.integers(1, 6))):
        name = pick(OTHER_NAMES)
        box = pick(((pick(OTHER_TAGS),), (f"div.{name}",), (f"div.{name}",), (f"section.{name}",), (f"aside.{name}",), (f"div.{name}.{pick(MAIN_NAMES)}",), (f"ul.{name}",)))
        outside = pick((("html", "body"), ("html", "body", *around), ("html", "body", f"div.{pick(MAIN_NAMES)}")))
        inner = pick((("p",), ("p",), ("div",), ("li",), (), ("h3",), ("div", "p"), ("label",)))
        at = int(rng.integers(len(out) + 1)) if rng.random() < 0.4 else pick((own[0], own[-1] + 1, len(out)))
        group = []
        if rng.random() < 0.4:  # a bar of links that no name gives away
            box = pick(((), ("div",), ("ul", "li"), ("div", "ul", "li"), ("p",), (f"div.{made_up(rng)}",)))
            for _ in range(int(rng.integers(2, 9))):
                text = " ".join(pick(texts).split()[: int(rng.integers(1, 6))])
                group.append((Block((*outside[:2], *box), text, len(text)), False))
            at = pick((own[0], own[-1] + 1))
            out[at:at] = group
            own = [k for k, (_, y) in enumerate(out) if y] or [0]
            continue
        for _ in range(int(rng.integers(1, 7))):
            text = pick(texts)
            if rng.random() < 0.5:
                text = " ".join(text.split()[: int(rng.integers(1, 9))])
            group.append((Block((*outside, *box, *inner), text, len(text) if rng.random() < 0.3 else 0), False))
        out[at:at] = group
        own = [k for k, (_, y) in enumerate(out) if y] or [0]
    return [b for b, _ in out], [y for _, y in out]


def train(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = SAMPLE_PAGES, chars: int = SAMPLE_CHARS) -> Labeller:
    """Fit a labeller on weak labels of at most ``sample`` pages of at most ``chars`` characters, by hash of their id.

    The sample is bounded, so one task holds it; that task sends back the weights, not the pages."""
    prepare(pages.sparkSession)
    short = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html")).where(F.length("html") <= chars)
    chosen = short.orderBy(F.xxhash64("id"), "id", F.xxhash64("html")).limit(sample).select("html")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng, encode, examples = np.random.default_rng(7), Encoder(), []
        for batch in batches:
            for page in batch.column("html").to_pylist():
                blocks = blocks_of(page)
                labels = [weak_label(b) for b in blocks]
                examples.append((blocks, labels))
                examples += [mixed(blocks, labels, rng) for _ in range(COPIES)]
        fitted = Labeller().fit([(encode(b), np.array(y, float)) for b, y in examples])
        yield pa.RecordBatch.from_arrays([pa.array(list(fitted.p)), pa.array([v.astype(np.float32).tobytes() for v in fitted.p.values()])], ["name", "weights"])

    found = chosen.coalesce(1).mapInArrow(fit, "name string, weights binary").collect()  # the network alone
    if not found:
        return Labeller().fit([])
    network = Labeller()
    network.p = {r.name: np.frombuffer(bytes(r.weights), np.float32).reshape(network.p[r.name].shape) for r in found}
    return network


def extract(pages: DataFrame, labeller: Labeller, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, *keep, text, n_blocks, n_main): the main text of every page, its blocks joined by one line feed.

    Character references are decoded, and white space within a block becomes one space. Null and empty pages, and
    pages without a main block, have an empty text. Broken or cut-off markup is read as far as it goes. Very long pages
    are read whole. Repeated rows each get a row, null ids are passed on. No pages give no rows. Columns in ``keep``
    are passed on under their names, others are not looked at; an own column whose name is kept gets underscores behind.
    """
    prepare(pages.sparkSession)
    taken = pages.select(*[F.col(f"`{c}`") for c in keep])
    names = [spare(taken, "id"), *keep, *[spare(taken, x) for x in ("text", "n_blocks", "n_main")]]
    passed = [f"c{k}" for k in range(len(keep) + 1)]  # plain names on the way, whatever the columns are called
    kinds = [pages.schema[c].dataType.simpleString() for c in (id_col, *keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder()
        for batch, raw in slices(batches, "html"):
            found = [blocks_of(x.decode("utf-8", "replace")) for x in raw]
            labels = labeller.label(found, encode)
            main = [[b.text for b, y in zip(x, p, strict=True) if y >= 0.5] for x, p in zip(found, labels, strict=True)]
            arrays = [batch.column(c) for c in passed]
            arrays += [pa.array(["\n".join(x) for x in main], pa.string()), pa.array([len(x) for x in found], pa.int64()), pa.array([len(x) for x in main], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*passed, "text", "n_blocks", "n_main"])

    columns = [F.col(f"`{c}`").alias(p) for c, p in zip((id_col, *keep), passed, strict=True)]
    rows = pages.select(*columns, F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"))
    schema = ", ".join(f"{p} {k}" for p, k in zip(passed, kinds, strict=True)) + ", text string, n_blocks long, n_main long"
    return rows.mapInArrow(run, schema).toDF(*names)
