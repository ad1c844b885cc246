"""Main text of web pages: boosted trees over the nodes of the page, decoded along its tree.

A page becomes a tree of its block elements; inline elements belong to the block around them. Every
block is described by its text (own, in the subtree, in links), its place (depth, siblings, offset)
and the words of its tag, class and id, and boosted trees give the probability that it is content.
The decoder then chooses one state for each block, over the whole page at once: *around* the content,
*in* it, or *out* of it. Below *out* everything is out, below *in* nothing is around; so an advert
in an article can go, and an article in an advert cannot come back.

The trees are fitted on a bounded sample of at most about ``pages`` pages and ``nodes`` blocks. Pages
whose markup says where the article is teach by it, and again with that markup rewritten in other
common ways, so that the names of the given pages are not all that is learned.

Raw text (scripts, styles, titles, text areas, frames) goes up to its end tag, as HTML says; other
unseen elements end by their own end tag or with their parent, and a head where the body starts.

Nulls: a null page is empty and has no text; repeated rows are read alike; a page without blocks
has no text; markup cut off at the end is read as far as it goes. Without any page that teaches, the
words of tags and classes decide alone. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payscore.llm.common import table
from payscore.llm.trees import Trees, fit_trees

# Kinds of elements, and words that tell what a part of a page is for.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
RAW = "script style title textarea iframe".split()
UNSEEN = "noscript template head svg canvas object select".split()
IN_HEAD = "base link meta title style script noscript template".split()
INLINE = (
    "a abbr acronym b bdi bdo big br button cite code data del dfn em font i img ins kbd label mark math meter q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr"
).split()
CONTENT_TAGS = ["article", "main"]
OTHER_TAGS = ["nav", "header", "footer", "aside", "form", "menu", "dialog", "fieldset"]
CONTENT_WORDS = "article articles articlebody blog body content entry main page post story text".split()
OTHER_WORDS = (
    "ad ads advert advertisement alert aside author banner bar breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer footer form gdpr header login masthead menu modal nav navbar navigation newsletter "
    "notice pager pagination pagetop popup promo promoted promotion recommended related replies reply search share "
    "sharing sidebar signup skip social sponsor sponsored subscribe subscription tags toolbar widget"
).split()

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)|([^<]+|<)", re.S
)
_ATTRIBUTES = re.compile(r"(class|id|role|itemprop)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_VOID, _RAW, _UNSEEN, _IN_HEAD, _INLINE = set(VOID), set(RAW), set(UNSEEN), set(IN_HEAD), set(INLINE)
#: The block of what is inside an element of UNSEEN.
_HIDDEN = -2
_CONTENT_WORDS, _OTHER_WORDS = set(CONTENT_WORDS), set(OTHER_WORDS)
_TAG_GROUPS = [
    set(CONTENT_TAGS), set(OTHER_TAGS), {"p", "pre", "blockquote"}, {"h1", "h2", "h3", "h4", "h5", "h6"},
    {"ul", "ol", "dl"}, {"li", "dt", "dd"}, {"div", "section", "center"}, {"table", "tbody", "tr", "td", "th", "thead"},
]
#: What an opening tag closes, up to the element that ends the search.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
AROUND, IN, OUT = 0, 1, 2


class Page:
    """The blocks of a page in order: parents, tags, words of attributes, and pieces of text.

    ``pieces`` are (block, in a link, text); block -1 marks a break between blocks.
    """

    def __init__(self, source: str):
        self.parents, self.tags, self.words, self.depths = [-1], ["#page"], [[]], [0]
        self.pieces: list[tuple[int, bool, str]] = []
        stack: list[tuple[str, int]] = [("#page", 0)]
        links, at, end = 0, 0, len(source)
        while at < end:
            m = _TOKEN.match(source, at)
            if m is None:  # a tag with a quote that never ends
                at += 1
                continue
            at = m.end()
            closing, tag, attributes, text = m.groups()
            if text is not None:
                if stack[-1] == ("head", _HIDDEN) and text.strip():
                    stack.pop()
                if stack[-1][1] != _HIDDEN:
                    self.pieces.append((stack[-1][1], links > 0, html.unescape(text)))
                continue
            if tag is None or not source.endswith(">", 0, at):
                continue
            tag = tag.lower()
            if closing:
                names = [t for t, _ in stack]
                known = tag in names[1:]
                place = stack[len(names) - 1 - names[::-1].index(tag)] if known else stack[-1]
                if tag not in _INLINE and place[1] != _HIDDEN:
                    self.pieces.append((-1, False, ""))
                if known:
                    while stack[-1][0] != tag:
                        links -= stack.pop()[0] == "a"
                    links -= stack.pop()[0] == "a"
                continue
            if ("head", _HIDDEN) in stack and (tag == "body" or (stack[-1][0] == "head" and tag not in _IN_HEAD)):
                # The end tag of a head may be missing.
                while stack[-1] != ("head", _HIDDEN):
                    links -= stack.pop()[0] == "a"
                stack.pop()
            if tag in _RAW:
                if not attributes.endswith("/"):
                    ends = re.compile(rf"</{re.escape(tag)}[\s>]", re.I).search(source, at)
                    at = source.find(">", ends.start()) + 1 or end if ends else end
                continue
            if tag in _UNSEEN or stack[-1][1] == _HIDDEN:
                # Ends by its own end tag, or with its parent.
                if tag not in _VOID and not attributes.endswith("/"):
                    links += tag == "a"
                    stack.append((tag, _HIDDEN))
                continue
            if tag in _INLINE:
                if tag == "br":
                    self.pieces.append((stack[-1][1], False, " "))
                elif tag not in _VOID and not attributes.endswith("/"):
                    links += tag == "a"
                    stack.append((tag, stack[-1][1]))
                continue
            self.pieces.append((-1, False, ""))
            closes, until = _CLOSES.get(tag, ({"p"}, {"div", "td", "li", "article", "section", "blockquote", "body"}))
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] in closes:
                    links -= sum(t == "a" for t, _ in stack[k:])
                    del stack[k:]
                    break
                if stack[k][0] in until:
                    break
            self.parents.append(stack[-1][1])
            self.tags.append(tag)
            self.words.append([w.lower() for _, v in _ATTRIBUTES.findall(attributes) for w in _PARTS.findall(v)])
            self.depths.append(self.depths[stack[-1][1]] + 1)
            if tag not in _VOID and not attributes.endswith("/"):
                stack.append((tag, len(self.tags) - 1))

    def named(self, node: int) -> tuple[int, int]:
        """How many words of a block speak for content, and how many for something else."""
        words = self.words[node]
        good = (self.tags[node] in CONTENT_TAGS) + sum(w in _CONTENT_WORDS for w in words)
        return good, (self.tags[node] in OTHER_TAGS) + sum(w in _OTHER_WORDS for w in words)

    def features(self) -> np.ndarray:
        n = len(self.tags)
        own, link, marks, digits, offset = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
        seen = 0
        for node, linked, text in self.pieces:
            if node < 0:
                continue
            size = len(text) - text.count(" ") - text.count("\n")
            own[node] += size
            link[node] += size * linked
            marks[node] += sum(map(text.count, ".,;:!?"))
            seen += size
        parents = np.array(self.parents)
        children, nodes = np.zeros(n), np.ones(n)
        text, linked, signs = own.copy(), link.copy(), marks.copy()
        for i in range(n - 1, 0, -1):
            p = parents[i]
            children[p] += 1
            nodes[p] += nodes[i]
            text[p] += text[i]
            linked[p] += linked[i]
            signs[p] += signs[i]
        place, like, before = np.zeros(n), np.zeros(n), np.zeros(n)
        so_far: dict[int, int] = {}
        tags: dict[tuple[int, str], int] = {}
        for i in range(1, n):
            p = self.parents[i]
            place[i] = so_far[p] = so_far.get(p, 0) + 1
            tags[p, self.tags[i]] = tags.get((p, self.tags[i]), 0) + 1
        passed = np.concatenate([[0], np.cumsum(own)])[:n]
        good, bad = (np.array(x, float) for x in zip(*map(self.named, range(n)), strict=True))
        good_up, bad_up = np.zeros(n), np.zeros(n)
        for i in range(1, n):
            p = self.parents[i]
            like[i] = tags[p, self.tags[i]] / so_far[p]
            good_up[i], bad_up[i] = good_up[p] + good[p], bad_up[p] + bad[p]
        up = np.maximum(parents, 0)
        total = max(seen, 1)
        density = linked / np.maximum(text, 1)
        columns = [
            np.array(self.depths, float), np.log1p(own), np.log1p(text), text / total, density, density[up],
            np.log1p(children), np.log1p(nodes), text / nodes, place / np.maximum(children[up], 1), np.log1p(children[up]), like,
            signs / np.maximum(text, 1), text / np.maximum(text[up], 1), passed / total,
            np.minimum(good, 3), np.minimum(bad, 3), np.minimum(good_up, 3), np.minimum(bad_up, 3),
        ]
        columns += [np.array([t in g for t in self.tags], float) for g in _TAG_GROUPS]
        self.own, self.text = own, text
        return np.stack(columns, axis=1)

    def teaches(self) -> np.ndarray | None:
        """1, 0 or -1 (not used) for each block, where the markup names the article; else None."""
        n = len(self.tags)
        inside, out = [False] * n, [False] * n
        for i in range(1, n):
            p = self.parents[i]
            good, bad = self.named(i)
            out[i] = out[p] or (bad > 0 and self.tags[i] != "body")
            inside[i] = not out[i] and (inside[p] or self.tags[i] in CONTENT_TAGS or (good > 0 and self.tags[i] in ("div", "section")))
        if not any(inside):
            return None
        around = [False] * n
        for i in range(n - 1, 0, -1):
            if inside[i] or around[i]:
                around[self.parents[i]] = True
        return np.array([1 if inside[i] else -1 if around[i] else 0 for i in range(n)])

    def decode(self, p: np.ndarray) -> list[int]:
        """The best state of each block: no content below what is out, nothing around below what is in."""
        p = np.clip(p, 1e-4, 1 - 1e-4)
        weight = 1 + np.minimum(self.own, 400) / 100
        yes, no = weight * np.log(p), weight * np.log(1 - p)
        best = np.stack([np.where(self.own > 0, no, 0.0) - 0.05, yes, no], axis=1)
        rows = best.tolist()
        for i in range(len(rows) - 1, 0, -1):
            a, b, c = rows[i]
            up = rows[self.parents[i]]
            up[AROUND] += max(a, b, c)
            up[IN] += max(b, c)
            up[OUT] += c
        states = [AROUND] * len(rows)
        states[0] = max(range(3), key=rows[0].__getitem__)
        for i in range(1, len(rows)):
            above = states[self.parents[i]]
            states[i] = max(range(above, 3), key=rows[i].__getitem__)
        return states

    def content(self, states: list[int]) -> str:
        """The text of what is in, a line for each block."""
        lines, line = [], []
        for node, _, text in [*self.pieces, (-1, False, "")]:
            if node < 0:
                whole = " ".join("".join(line).split())
                if whole:
                    lines.append(whole)
                line = []
            elif states[node] == IN:
                line.append(text)
        return "\n".join(lines)


@dataclass(frozen=True)
class Sample:
    """Bounds of what the trees are fitted on."""

    pages: int = 400
    nodes: int = 60_000
    max_chars: int = 400_000


# Other ways to write the parts of a page.
_ARTICLES = ["<article>", '<div class="content">', '<main>', '<div class="post-body">', '<div id="main-content">', "<div>", '<section class="story">']
_ASIDES = [
    '<div class="ad">', '<aside>', '<div class="sidebar">', '<div class="cookie-notice">', '<div class="promo banner">', "<form>",
    '<section class="comments">', '<div class="related">', "<header>", '<div id="footer">', '<div class="newsletter">', "<div>",
]


def rewritten(source: str, rng: random.Random) -> str:
    """The page with other names for its article and for its other parts, and some of these in other places."""
    article, aside = rng.choice(_ARTICLES), rng.choice(_ASIDES)
    tag = re.match(r"<(\w+)", article)[1]
    source = re.sub(r"<(?:article|main)\b[^>]*>", article, source)
    source = re.sub(r"</(?:article|main)>", f"</{tag}>", source)
    other = re.match(r"<(\w+)", aside)[1]
    part = re.search(r'<div class="ad">(.*?)</div>|<footer>(.*?)</footer>|<aside\b[^>]*>(.*?)</aside>', source, re.S)
    if part:
        text = next(x for x in part.groups() if x is not None)
        extra = f"{aside}<p>{text}</p></{other}>"
        where = rng.choice(["</body>", f"</{tag}>", article, "</p>"])
        source = source.replace(where, where + extra if where in (article, "</p>") else extra + where, 1)
    if rng.random() < 0.3:
        source = re.sub(r"<(/?)nav\b", r"<\1div", source)
    for gone in (r"<nav\b.*?</nav>", r"<footer\b.*?</footer>", r'<div class="ad">.*?</div>'):
        if rng.random() < 0.4:
            source = re.sub(gone, "", source, flags=re.S)
    if rng.random() < 0.4:
        source = source.replace("<body>", "<body><div><div>", 1)
    return source


def truth_of(source: str, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and labels of a page that names its article, as given and rewritten.

    In one of the rewritten pages all names are hidden, so that text and place have to decide.
    """
    out = []
    rng = random.Random(seed)
    for k in range(6):
        page = Page(source if k == 0 else rewritten(source, rng))
        labels = page.teaches()
        if labels is None:
            continue
        x = page.features()
        if k == 5:
            x = hidden(x)
        out.append((x[labels >= 0], labels[labels >= 0]))
    return out


def hidden(x: np.ndarray) -> np.ndarray:
    """Features of blocks whose names say nothing."""
    x = x.copy()
    x[:, 15:21] = 0
    return x


def fit_pages(pages: DataFrame, bounds: Sample = Sample()) -> Trees:
    """Fit the trees on a bounded sample of the pages, chosen by the checksum of their id."""
    many = max(pages.count(), 1)
    place = F.pmod(F.xxhash64(F.col("page_id").cast("string"), F.lit("html")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = pages.where(place < bounds.pages / many).where(F.char_length("html") <= bounds.max_chars).select("page_id", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.column(1):
                for features, labels in truth_of(x.as_py() or "", len(x.as_py() or "")):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r.tobytes() for r in features], pa.binary()), pa.array(labels, pa.int32())], ["x", "y"]
                    )

    rows = some.mapInArrow(run, "x binary, y int").limit(bounds.nodes).collect()
    if not rows:
        return Trees(np.zeros((0, 15), np.int64), np.zeros((0, 15)), np.zeros((0, 16)), 0.0)
    rows = sorted((bytes(r["x"]), r["y"]) for r in rows)
    x = np.frombuffer(b"".join(r[0] for r in rows), float).reshape(len(rows), -1)
    return fit_trees(x, np.array([r[1] for r in rows], float))


def _by_name(x: np.ndarray) -> np.ndarray:
    """Without any tree: what names say, or else the part of text that is no link."""
    score = 3 * (x[:, 15] + x[:, 17]) - 4 * (x[:, 16] + x[:, 18]) + 2 * (0.3 - x[:, 4])
    return 1 / (1 + np.exp(-score))


def texts_of(trees: Trees, sources: list[str | None]) -> list[str]:
    """The main text of each page."""
    pages = [Page(s or "") for s in sources]
    features = [p.features() for p in pages]
    x = np.concatenate(features) if features else np.zeros((0, 27))
    p = trees.probability(x) if len(trees.features) else _by_name(x)
    parts = np.split(p, np.cumsum([len(f) for f in features])[:-1]) if pages else []
    return [page.content(page.decode(q)) for page, q in zip(pages, parts, strict=True)]


def main_texts(pages: DataFrame, trees: Trees) -> DataFrame:
    """page_id, url, text, n_chars of each row."""
    shared = pages.sparkSession.sparkContext.broadcast((trees.features, trees.limits, trees.leaves, trees.base))
    kinds = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = Trees(*shared.value)
        for batch in batches:
            for k in range(0, len(batch), 64):
                some = batch.slice(k, 64)
                texts = texts_of(fitted, some.column(2).to_pylist())
                sizes = pa.array([len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(texts, pa.string()), sizes], ["page_id", "url", "text", "n_chars"])

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)


def op10_html(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return main_texts(pages, fit_pages(pages))
