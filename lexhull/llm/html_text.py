"""Main text of web pages: flat text blocks and a decision tree.

A page is read as a flat sequence of text blocks. Each block is described by its own word count
and link density, by those of the blocks before and after it and of the next longer ones around it, by whether it ends
like a sentence, by the container it stands in (its words, its share of the largest one's, whether it has a heading, whether it comes
before or after the largest), and by what its mark-up says: inside an element made for boilerplate or for the
article, how many elements and words of class, id or role around it are marks of either, one of several articles side by side, a heading, a list item. A decision tree trained on
a small labelled table, drawn by rule from layouts with and without telling mark-up, says which
blocks are main text.
"""
from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .frames import without

#: Fixed values of HTML: elements whose content is no text, inline elements, elements without an end.
RAW = ("script", "style", "noscript", "template", "textarea", "select", "svg", "math", "iframe", "object", "title", "canvas", "audio", "video")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base col embed hr img input link meta param source track wbr br".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILER_TAGS = frozenset("nav footer aside form header dialog menu fieldset button".split())
MAIN_TAGS = frozenset(("article", "main"))
#: Of these an article or main element inside is none the less the article.
LOOSE_TAGS = frozenset("form header fieldset".split())
#: Words in class, id and role that hint at boilerplate or at the article, and words before them that say what a layout has.
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment comments complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus footer form gdpr header legal login masthead menu modal nav navbar navigation newsletter notice notification outbrain pager pagination popup promo promotion recommended related replies reply respond search share sharing side sidebar signup skip social sponsor sponsored subscribe taboola tags teaser toolbar topbar widget".split()
)
MAIN_WORDS = frozenset("article content entry main post story text body".split())
LAYOUT_WORDS = frozenset("has with no without".split())
#: Words after them that say it isn't there.
ABSENT_WORDS = frozenset("free less off".split())
#: Elements of which a block or a list is made; what holds these is the container.
PARTS = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre figure figcaption table thead tbody tfoot tr td th".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>" + "|".join(RAW) + r")(?=[\s/>]|\Z)(?:[^>]*/>|.*?(?:</(?P=raw)\s*>|\Z))"
    r"|<(?P<end>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?>\"[^\"]*\"|'[^']*'|[^'\">])*|[^>]*)>",
    re.S | re.I,
)
NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
PART = re.compile(r"[a-z]+")

#: What a block is described by, in order; the words and link density of a block that isn't there are 0.
FEATURES = (
    "words", "links", "words before", "links before", "words after", "links after", "links of the longer block before", "links of the longer block after",
    "words of the container", "share of the largest container", "heading in the container", "place to the largest container",
    "sentence", "heading", "item", "boilerplate element", "boilerplate marks", "article element", "article marks", "articles side by side",
)
#: Of these a block says itself: words, links, container, and the ones from "sentence" on.
OWN = 3 + len(FEATURES) - FEATURES.index("sentence")
SENTENCE_END = (".", "!", "?", "…", ":", "。", "！", "？", '."', ".”", ".)")


def named(attrs: str) -> tuple[int, int]:
    """How many words of class, id or role hint at boilerplate, and how many at the article."""
    boiler = main = 0
    for value in NAMED.findall(attrs):
        for name in value.lower().split():
            words = PART.findall(name)
            for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                if before not in LAYOUT_WORDS and after not in ABSENT_WORDS:
                    boiler, main = boiler + (word in BOILER_WORDS), main + (word in MAIN_WORDS)
    return boiler, main


class Container:
    """An open element and what it says about the text inside."""

    __slots__ = ("name", "number", "tag", "hint", "main_tag", "main_hint", "articles", "among")

    def __init__(self, name: str, attrs: str, outer: Container | None, number: int):
        self.name, self.number, self.articles = name, number, [0]
        self.tag, self.hint, self.main_tag, self.main_hint, self.among = (outer.tag, outer.hint, outer.main_tag, outer.main_hint, outer.among) if outer else ("", 0, False, 0, [0])
        boiler, main = named(attrs) if "=" in attrs and name not in ("html", "body") else (0, 0)
        if name == "article" and outer:
            # how many there are is known once all of them have been read
            outer.articles[0] += 1
            self.among = outer.articles
        if name in MAIN_TAGS:
            self.main_tag = True
            if self.tag in LOOSE_TAGS or name == "main":
                self.tag = ""
            if name == "main":
                self.hint = 0
        elif name in BOILER_TAGS and not (name == "header" and self.main_tag):
            self.tag = self.tag if self.tag and self.tag not in LOOSE_TAGS else name
        if boiler and not (self.main_tag and name in ("header", *HEADINGS)):
            self.hint += boiler
        self.main_hint += main


def blocks(page: str | None) -> tuple[list[str], np.ndarray]:
    """(text, features) of the blocks of a page, in order; blocks without text are left out."""
    texts: list[str] = []
    rows: list[tuple] = []
    parts: list[str] = []
    root = Container("", "", None, 0)
    stack: list[Container] = []
    opened = 0
    linked, in_link, breaks = 0, 0, 0

    def flush() -> None:
        nonlocal linked, breaks
        if parts:
            text = "".join(parts)
            text = " ".join((html.unescape(text) if "&" in text else text).split())
            if text:
                texts.append(text)
                inner = stack[-1] if stack else root
                words = text.count(" ") + 1
                # the element around a block's own one, with lists and the like seen through; what says what it is made for holds its own text
                around = next((c.number for c in reversed(stack[:-1] if inner.name == "div" else stack) if c.name not in PARTS), 0)
                rows.append((words, min(1.0, linked / words), around, text.endswith(SENTENCE_END), inner.name in HEADINGS, inner.name == "li", inner.tag != "", inner.hint + (inner.tag != ""), inner.main_tag, inner.main_hint + inner.main_tag, inner.among))
            parts.clear()
        linked, breaks = 0, 0

    def add(text: str) -> None:
        nonlocal linked, breaks
        if text:
            parts.append(text)
            if not text.isspace():
                breaks = 0
                if in_link:
                    linked += len(text.split())

    at, page = 0, page or ""
    for m in TOKEN.finditer(page):
        add(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m["raw"]:
                add(" ")
            continue
        name = name.lower()
        if name == "br":
            breaks += 1
            parts.append(" ")
            if breaks > 1:
                flush()
            continue
        if name == "a":
            in_link = 0 if m["end"] else 1
        if name in INLINE:
            continue
        flush()
        if m["end"]:
            in_link = 0
            if any(c.name == name for c in stack):
                while stack.pop().name != name:
                    pass
        elif name not in VOID and not m["attrs"].endswith("/"):
            if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1].name == name:
                stack.pop()  # its end may be left out
            opened += 1
            stack.append(Container(name, m["attrs"], stack[-1] if stack else root, opened))
    add(page[at:])
    flush()
    return texts, features(np.array([(*r[:-1], r[-1][0]) for r in rows], float).reshape(-1, OWN))


def features(own: np.ndarray) -> np.ndarray:
    """What each block says itself, with its neighbours' words and links, as FEATURES has them."""
    words, links = own[:, 0], own[:, 1]
    shifted = lambda x, by: np.r_[0, x[:-1]] if by < 0 else np.r_[x[1:], 0]
    around = [shifted(x, by) for by in (-1, 1) for x in (words, links)] if len(own) else [words] * 4
    longer = [np.zeros(len(own)), np.zeros(len(own))]
    for way, order in enumerate((range(len(own)), range(len(own) - 1, -1, -1))):
        waiting: list[int] = []  # blocks seen so far, each longer than those after it
        for i in order:
            while waiting and words[waiting[-1]] <= words[i]:
                waiting.pop()
            longer[way][i] = links[waiting[-1]] if waiting else 0
            waiting.append(i)
    if not len(own):
        return np.zeros((0, len(FEATURES)))
    _, container = np.unique(own[:, 2], return_inverse=True)
    inside = np.bincount(container, words * (1 - links))  # what is linked is no text
    largest = int(inside.argmax())
    headed = np.bincount(container, own[:, 4]) > 0
    own_place = np.flatnonzero(container == largest)
    place = np.where(np.arange(len(own)) < own_place[0], -1, np.where(np.arange(len(own)) > own_place[-1], 1, 0))
    place[own_place] = 0
    return np.column_stack([words, links, *around, *longer, inside[container], inside[container] / max(inside[largest], 1), headed[container], place, own[:, 3:]])


def labelled_table(pages: int = 900, seed: int = 7) -> list[tuple[str, str]]:
    """The labelled table, drawn by rule: pages, and for each of their blocks whether it is main text.

    A page is a menu, notices, an article, and what comes after it. Each part is marked by an element
    made for it, by a name, by a compound name, by a name that says nothing, or by nothing, and articles have names that speak of
    boilerplate, too; so the tree learns what words, links, neighbours and containers tell, and how far names can be trusted.
    """
    rng = random.Random(seed)
    some = lambda low, high: " ".join(rng.choice(("stone", "river", "late", "market", "of", "the", "and", "seven", "walked", "green", "slowly", "house")) for _ in range(rng.randint(low, high)))
    said = lambda low, high: some(low, high).capitalize() + rng.choice("...?!:")
    link = lambda low, high: f"<a href=x>{rng.choice((some, some, said))(low, high)}</a>"
    names = {
        "menu": ("main-nav", "menu", "navbar top", "navigation"), "notice": ("cookie-notice", "cookie-text", "notice", "gdpr-banner"), "ad": ("ad", "ads", "story-ad", "sponsored content"),
        "side": ("sidebar", "sidebar-content", "main-sidebar", "widget text"), "related": ("related", "related-content", "recommended"), "comments": ("comments", "comment-body", "replies"),
        "news": ("newsletter", "newsletter-text", "signup"), "foot": ("footer", "footer-text", "copyright"), "share": ("share", "post-share", "social"),
    }
    tags = {"menu": "nav", "side": "aside", "foot": "footer", "news": "form", "ad": "aside"}

    def part(kind: str, blocks: list[str], marked: bool = False) -> tuple[str, str]:
        how = rng.choice(("tag", "tag", "name", "name", "none")) if not marked else rng.choice(("tag", "name"))
        tag = tags.get(kind) if how == "tag" else None
        name = f' {rng.choice(("class", "id"))}="{rng.choice(names[kind])}"' if how == "name" or (how == "tag" and not tag) else ""
        if how == "none" and rng.random() < 0.5:  # a name in another language, or one that says nothing
            name = f' class="{rng.choice(("seitenleiste", "usr-cmts", "box-3", "kasten", "c1", "zusatz"))}"'
        each = rng.choice(("p", "div", "li")) if kind in ("menu", "foot", "share", "related") else rng.choice(("p", "p", "div"))
        inner = "".join(f"<{each}>{b}</{each}>" for b in blocks)
        if len(blocks) == 1 and rng.random() < 0.5:
            inner = blocks[0]
        if kind in ("comments", "side", "related") and len(blocks) > 1 and rng.random() < 0.5:
            inner = "".join(f"<article><p>{b}</p></article>" for b in blocks)
        if how == "none" and kind in ("menu", "share", "related", "foot") and rng.random() < 0.5:  # straight in the page
            return (f"<ul>{inner}</ul>" if each == "li" else inner), "0" * len(blocks)
        return f"<{tag or 'div'}{name}>{inner}</{tag or 'div'}>", "0" * len(blocks)

    def boiler(kind: str, marked: bool = False) -> tuple[str, str]:
        few = rng.randint(1, 4)
        if kind in ("notice", "ad", "news") and rng.random() < 0.4:  # something to do
            return part(kind, [rng.choice((f"{said(3, 14)} {link(1, 3)}", some(1, 3), said(1, 3)))], marked)
        made = {
            "menu": lambda: [link(1, 3) for _ in range(rng.randint(2, 7))], "share": lambda: [link(1, 2) for _ in range(few)], "related": lambda: [link(4, 12) for _ in range(few + 1)],
            "notice": lambda: [said(8, 40)], "ad": lambda: [said(3, 25)], "side": lambda: [said(5, 30) for _ in range(few)], "comments": lambda: [said(4, 60) for _ in range(few)],
            "news": lambda: [said(4, 25)], "foot": lambda: [rng.choice((some(1, 6), said(2, 9), f"{some(1, 3)} {link(1, 2)} {link(1, 2)}")) for _ in range(rng.randint(1, 2))],
        }[kind]()
        return part(kind, made, marked)

    def article() -> tuple[str, str]:
        out, labels = [], ""
        wrap, para = rng.choice(("article", "main", "named", "named", "none", "bare", "bare")), rng.choice(("p", "p", "div"))

        def add(tag: str, text: str) -> None:
            nonlocal labels
            out.append(f"<{tag}>{text}</{tag}>")
            labels += "1"

        if rng.random() < 0.8:
            add(rng.choice(("h1", "h2")), some(1, 12))
        for _ in range(rng.choice((1, 1, 2, 4, 8, 14))):
            kind = rng.random()
            if kind < 0.15:
                add("p", said(1, 5))
            elif kind < 0.75:
                add(para, said(12, 90))
            elif kind < 0.85:
                add("p", f"{some(8, 30)} {link(1, 5)} {said(4, 20)}")
            elif kind < 0.92:
                add(rng.choice(("h2", "h3")), some(1, 6))
                add("p", said(15, 60))
            elif kind < 0.95:
                add("figcaption", rng.choice((some, said))(3, 14))
                add("p", said(15, 50))
            else:
                for _ in range(rng.randint(2, 4)):
                    add("li", some(1, 8))
                add("p", said(10, 40))
            if wrap in ("article", "main") and rng.random() < 0.15:  # such as sources
                add(rng.choice(("p", "li")), link(1, 12))
            if rng.random() < 0.12:
                html_, zeros = boiler(rng.choice(("ad", "share", "news")), True)
                out.append(html_)
                labels += zeros
        inner = "".join(out)
        if wrap == "bare":
            return inner, labels
        opened = {"article": "<article>", "main": "<main>", "named": f'<div class="{rng.choice(("content", "entry text", "post", "story-body", "text-ad-free", "content no-sidebar", "post share-enabled", "spalte-2"))}">', "none": "<div>"}[wrap]
        return f"{opened}{inner}</{opened[1:].split()[0].rstrip('>')}>", labels

    out = []
    for _ in range(pages):
        before = [boiler(k) for k in ("menu", "notice", "ad") if rng.random() < 0.6]
        after = [boiler(k) for k in ("share", "related", "side", "comments", "news", "foot") if rng.random() < 0.4]
        kind = rng.random()
        parts = [*before, article(), *after] if kind < 0.82 else [article()] if kind < 0.94 else [boiler("menu"), boiler("foot", True)]
        page = "".join(h for h, _ in parts)
        out.append((f"<body class={rng.choice(('has-sidebar', 'post', 'page'))}>{page}</body>" if rng.random() < 0.5 else page, "".join(x for _, x in parts)))
    return out


class Tree:
    """A small decision tree by Gini impurity, held as flat arrays."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 12, least: int = 4):
        self.feature, self.cut, self.left, self.value, self.least = [], [], [], [], least
        self.grow(x, y, depth)

    def grow(self, x: np.ndarray, y: np.ndarray, depth: int) -> int:
        node = len(self.feature)
        for a, v in ((self.feature, -1), (self.cut, 0.0), (self.left, (0, 0)), (self.value, float(y.mean()) if len(y) else 0.0)):
            a.append(v)
        if depth and 0 < y.sum() < len(y):
            best = (len(y) * y.mean() * (1 - y.mean()) - 1e-9, None)
            for f in range(x.shape[1]):
                order = np.argsort(x[:, f], kind="stable")
                v, ones = x[order, f], np.cumsum(y[order])[:-1]
                n = np.arange(1, len(y))
                score = ones * (1 - ones / n) + (ones[-1] + y[order[-1]] - ones) * (1 - (ones[-1] + y[order[-1]] - ones) / (len(y) - n))
                score[(v[1:] == v[:-1]) | (n < self.least) | (len(y) - n < self.least)] = np.inf
                at = int(score.argmin())
                if score[at] < best[0] - 1e-12:
                    best = (score[at], (f, (v[at] + v[at + 1]) / 2))
            if best[1]:
                f, cut = best[1]
                low = x[:, f] < cut
                self.feature[node], self.cut[node] = f, float(cut)
                self.left[node] = (self.grow(x[low], y[low], depth - 1), self.grow(x[~low], y[~low], depth - 1))
        return node

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        work = [(0, np.arange(len(x)))]
        while work:
            node, rows = work.pop()
            if self.feature[node] < 0:
                out[rows] = self.value[node] >= 0.5
            elif len(rows):
                low = x[rows, self.feature[node]] < self.cut[node]
                work += [(self.left[node][0], rows[low]), (self.left[node][1], rows[~low])]
        return out


def trained(labelled: list[tuple[str, str]] | None = None) -> Tree:
    """The tree of a labelled table, by default the one that labelled_table() draws."""
    xs, ys = [], []
    for page, labels in labelled_table() if labelled is None else labelled:
        texts, x = blocks(page)
        if len(texts) != len(labels):
            raise ValueError(f"{len(labels)} labels for {len(texts)} blocks: {texts}")
        xs.append(x)
        ys.append(np.array([c == "1" for c in labels], float))
    return Tree(np.vstack(xs), np.concatenate(ys))


def extract_text(pages: DataFrame, html_col: str = "html", tree: Tree | None = None) -> DataFrame:
    """Input columns without the page, plus text string and blocks array<string>: the main text.

    Character references are decoded, white space inside a block becomes one space, blocks are
    trimmed and joined in page order by one newline. A single <br> is white space, several in a
    row part blocks. Null or empty pages and pages without main text give an empty string;
    unclosed and stray tags are taken as browsers do, roughly; pages of any length are read whole;
    repeated rows are each returned; input columns named text or blocks are replaced.
    """
    tree = tree or trained()
    kept = without(pages, html_col, "text", "blocks")
    frame = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept.columns)], F.col(html_col).alias("html"))
    at = len(kept.columns)
    schema = ", ".join([*[f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept.schema.fields)], "text string, blocks array<string>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in tb.pieces(batches, at):
            found = [blocks(p) for p in piece.column(at).to_pylist()]
            main = tree.predict(np.vstack([x for _, x in found])) if found else np.zeros(0, bool)
            ends = np.cumsum([0, *[len(t) for t, _ in found]])
            chosen = [[t for t, keep in zip(texts, main[s:e].tolist()) if keep] for (texts, _), s, e in zip(found, ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*piece.columns[:at], pa.array(["\n".join(c) for c in chosen], pa.string()), pa.array(chosen, pa.list_(pa.string()))], names=[*[f"c{i}" for i in range(at)], "text", "blocks"])

    return frame.mapInArrow(run, schema).toDF(*kept.columns, "text", "blocks")
