"""Main text of web pages by a tree-structured model. The catalogue keeps no web pages, so this works on any table of pages."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scenequarry.llm.shipping import ship

NAME_END, SPECIAL, OPENS = re.compile(r"[\s/>]"), re.compile("[>\"']"), re.compile("<[a-zA-Z/!]")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Fixed values of the markup language.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template svg math head iframe textarea select button object canvas audio video title".split())
RAW = frozenset("script style textarea title iframe noembed xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp small span strike strong sub sup time tt u var wbr br".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
SCOPES = frozenset("ul ol dl table article section aside nav div main body html".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figcaption caption td th address".split()) | INLINE


@dataclass
class Page:
    """Elements of a page in page order, and its blocks of text as (element, text) parts."""

    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    tag: list[str] = field(default_factory=lambda: ["#root"])
    tokens: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    linked: list[bool] = field(default_factory=lambda: [False])
    blocks: list[list[tuple[int, str]]] = field(default_factory=lambda: [[]])

    def add(self, parent: int, tag: str, tokens: tuple[str, ...] = ()) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.tag.append(tag)
        self.tokens.append(tokens)
        self.linked.append(tag == "a" or self.linked[parent])
        return len(self.parent) - 1


def attribute_tokens(text: str) -> tuple[str, ...]:
    out = []
    for name, value in ATTRIBUTE.findall(text):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "style" and re.search(r"display\s*:\s*none", value):
            out.append("hidden")
        elif name != "style":
            out += [t.lower().rstrip("s") for t in TOKEN.findall(value)]
    return tuple(dict.fromkeys(t for t in out if len(t) > 1))


class Tags:
    """Tags of a page from left to right, each place looked at a fixed number of times however broken the page is.

    A tag ends at the first ``>`` outside quotes. What follows a quote doesn't depend on where the tag began, so it is
    worked out once per quote; a ``<`` without such an end is text.
    """

    def __init__(self, html: str) -> None:
        self.html, self.last = html, html.rfind(">")
        self.quotes: dict[int, int] = {}
        self.name = self.special = (0, -1)  # a range of places, and the first name end or special sign after all of them

    def _next(self, kept: tuple[int, int], pattern: re.Pattern, at: int) -> tuple[int, int]:
        if kept[0] <= at <= kept[1]:
            return kept
        m = pattern.search(self.html, at)
        return at, m.start() if m else len(self.html)

    def end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose name ended at ``at``; -1 if there is none."""
        html, path, found = self.html, [], -1
        while True:
            self.special = self._next(self.special, SPECIAL, at)
            q = self.special[1]
            if q == len(html):
                break
            if html[q] == ">":
                found = q
                break
            if q in self.quotes:
                found = self.quotes[q]
                break
            path.append(q)
            at = html.find(html[q], q + 1) + 1
            if not at:
                break
        self.quotes.update(dict.fromkeys(path, found))
        return found

    def find(self, at: int) -> tuple[int, int, str, str, str] | None:
        """(start, end, "/" or "", name, rest) of the next tag; comments and declarations have no name."""
        html = self.html
        while (i := html.find("<", at)) >= 0:
            if i > self.last:
                i = html.find("<!--", i)
                return (i, len(html), "", "", "") if i >= 0 else None
            if html.startswith("<!--", i):
                e = html.find("-->", i + 4)
                return i, e + 3 if e >= 0 else len(html), "", "", ""
            if html[i + 1] in "!?":
                return i, html.find(">", i) + 1, "", "", ""
            p = i + 1 + (html[i + 1] == "/")
            if "a" <= html[p : p + 1].lower() <= "z":
                self.name = self._next(self.name, NAME_END, p)
                e = self.end(self.name[1])
                if e >= 0:
                    return i, e + 1, html[i + 1 : p], html[p : self.name[1]], html[self.name[1] : e]
            at = i + 1
        return None


def parse(html: str) -> Page:
    """Elements and blocks of a whole page, however broken: unclosed elements end with their parent, stray ends are passed over."""
    page = Page()
    stack, names, silent = [0], ["#root"], 0
    opened = Counter(names)
    tags, at = Tags(html), 0

    def text(piece: str) -> None:
        if silent or not piece or piece.isspace():
            if piece and not silent and page.blocks[-1]:
                page.blocks[-1].append((stack[-1], " "))
            return
        owner = stack[-1]
        if names[-1] not in LEAVES:
            owner = page.add(owner, "#text")
        page.blocks[-1].append((owner, unescape(piece)))

    def block() -> None:
        if page.blocks[-1]:
            page.blocks.append([])

    def pop() -> None:
        nonlocal silent
        stack.pop()
        name = names.pop()
        opened[name] -= 1
        silent -= name in SILENT

    while True:
        tag = tags.find(at)
        if tag is None:
            cut_off = OPENS.search(html, max(at, tags.last + 1))
            text(html[at : cut_off.start() if cut_off else len(html)])
            return page
        start, end, slash, name, rest = tag
        text(html[at:start])
        at = end
        if not name:
            continue
        name = name.lower()
        if slash:
            if opened[name]:
                if name not in INLINE:
                    block()
                elif not set(names[len(names) - 1 - names[::-1].index(name) :]) <= INLINE:
                    continue
                while names[-1] != name:
                    pop()
                pop()
            continue
        if name == "br":
            text(" ") if page.blocks[-1] and not silent else None
            if page.blocks[-1] and not silent:
                page.blocks[-1].append((stack[-1], " "))
            continue
        if name not in INLINE:
            block()
            if opened["p"] and name not in VOID:
                k = len(names) - 1 - names[::-1].index("p")
                if not set(names[k + 1 :]) & SCOPES:
                    while len(names) > k:
                        pop()
            for k in range(len(names) - 1 if name in CLOSES else 0, 0, -1):
                if names[k] in CLOSES[name]:
                    while len(names) > k:
                        pop()
                    break
                if names[k] in SCOPES:
                    break
        if name in VOID:
            continue
        node = page.add(stack[-1], name, attribute_tokens(rest) if rest else ())
        if rest.endswith("/") and name in SILENT:
            continue
        stack.append(node)
        names.append(name)
        opened[name] += 1
        silent += name in SILENT
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(html, at)
            at = end.start() if end else len(html)


def block_text(parts: list[tuple[int, str]]) -> str:
    return " ".join("".join(t for _, t in parts).split())


#: Exponents of the potentials of a node's text features and of its attributes: paragraphs of one part of a page say much
#: the same, so that they may not count as independent, while the names of parts are chosen to tell.
TEXT_WEIGHT, NAME_WEIGHT = 0.2, 3.0


class Forest:
    """All elements of some pages as arrays, parents before children, with their features."""

    def __init__(self, pages: list[Page]) -> None:
        start, self.offsets = 0, []
        parent, depth, self.tags, self.tokens = [], [], [], []
        for p in pages:
            self.offsets.append(start)
            parent.append(np.array(p.parent, np.int64) + np.where(np.array(p.parent) < 0, 0, start))
            depth.append(np.array(p.depth, np.int64))
            self.tags += p.tag
            self.tokens += p.tokens
            start += len(p.parent)
        self.parent = np.concatenate(parent) if parent else np.zeros(0, np.int64)
        self.depth = np.concatenate(depth) if depth else np.zeros(0, np.int64)
        self.n = start
        stats = np.zeros((start, 3))
        for p, o in zip(pages, self.offsets, strict=True):
            for block in p.blocks:
                for node, t in block:
                    if not t.isspace():
                        stats[o + node] += (len(t), len(t) if p.linked[node] else 0, sum(map(t.count, ".!?")))
        order = np.argsort(self.depth, kind="stable")
        ends = np.searchsorted(self.depth[order], np.arange(self.depth.max(initial=0) + 2))
        self.levels = [order[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        self.own = stats[:, 0].copy()
        for level in self.levels[:0:-1]:
            np.add.at(stats, self.parent[level], stats[level])
        length = np.maximum(stats[:, 0], 1)
        self.length = stats[:, 0]
        self.bins = np.stack([np.digitize(stats[:, 0], [1, 25, 100, 300]), 5 + np.digitize(stats[:, 1] / length, [0.001, 0.2, 0.6]), 9 + np.digitize(100 * stats[:, 2] / length, [0.001, 0.6, 1.6])], axis=1)


BINS = 13


@dataclass
class ContentModel:
    """Potentials of a tree of elements that are content (1) or not (0), as logarithms.

    ``steps`` holds, by the child's tag, the potential of a parent's and a child's label; ``tokens`` (names in attributes)
    and ``bins`` (length, links and sentence ends of the text below) belong to single nodes.
    """

    start: np.ndarray
    tags: dict[str, int]
    steps: np.ndarray
    tokens: dict[str, tuple[float, float]]
    bins: np.ndarray

    @classmethod
    def from_counts(cls, counts: dict[tuple[str, str], tuple[float, float, float, float]]) -> ContentModel:
        """From (kind, name) -> numbers: of nodes by label, or of (parent, child) label pairs for steps."""
        tags = {name: i for i, name in enumerate(sorted({n for k, n in counts if k == "tag"} | {"#other"}))}
        steps = np.zeros((len(tags), 2, 2))
        pooled = np.array([[8.0, 2.0], [1.0, 9.0]])
        bins, tokens, nodes = np.full((BINS, 2), 1.0), {}, np.ones(2)
        for (kind, name), c in counts.items():
            if kind == "tag":
                nodes += c[:2]
            elif kind == "step":
                steps[tags.get(name, tags["#other"])] += np.array(c).reshape(2, 2)
                pooled += np.array(c).reshape(2, 2) / 100
            elif kind == "bin":
                bins[int(name)] += c[:2]
        for (kind, name), c in counts.items():
            if kind == "token" and c[0] + c[1] >= 3:
                tokens[name] = tuple(np.log((np.array(c[:2]) + 0.5) / (nodes + 1)))
        prior = pooled / pooled.sum(1, keepdims=True)
        for a, b in ((0, 5), (5, 9), (9, 13)):
            bins[a:b] /= bins[a:b].sum(0)
        return cls(np.log(np.array([0.5, 0.5])), tags, np.log((steps + 4 * prior) / (steps.sum(2, keepdims=True) + 4)), tokens, np.log(bins))

    def marginals(self, f: Forest) -> np.ndarray:
        """Chance of each element to be content: one pass from the leaves to the roots and one back, over all pages at once."""
        if not f.n:
            return np.zeros(0)
        other = self.tags["#other"]
        tag = np.array([self.tags.get(t, other) for t in f.tags])
        own = TEXT_WEIGHT * self.bins[f.bins].sum(1)
        for i, some in enumerate(f.tokens):
            for t in some:
                if t in self.tokens:
                    own[i] += NAME_WEIGHT * np.array(self.tokens[t])
        own[f.depth == 0] += self.start
        step = self.steps[tag]
        up = np.zeros((f.n, 2))
        for level in f.levels[:0:-1]:
            up[level] = np.logaddexp(*np.moveaxis(step[level] + own[level][:, None, :], 2, 0))
            np.add.at(own, f.parent[level], up[level])
        belief = own
        for level in f.levels[1:]:
            rest = belief[f.parent[level]] - up[level]
            belief[level] += np.logaddexp(*np.moveaxis(rest[:, :, None] + step[level], 1, 0))
        return 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))


def label_counts(html: str, text: str) -> Counter:
    """Numbers for ``ContentModel.from_counts`` from one page with its main text (blocks joined by two line ends)."""
    page = parse(html)
    f = Forest([page])
    wanted = set(text.split("\n\n"))
    good = np.zeros(f.n)
    for block in page.blocks:
        if block_text(block) in wanted:
            for node, t in block:
                good[node] += 0 if t.isspace() else len(t)
    for level in f.levels[:0:-1]:
        np.add.at(good, f.parent[level], good[level])
    label = np.where(f.length == 0, -1, (good > 0.5 * f.length).astype(int))
    out: Counter = Counter()
    for i in range(f.n):
        y = label[i]
        if y < 0:
            continue
        out["tag", f.tags[i], y] += 1
        for t in f.tokens[i]:
            out["token", t, y] += 1
        for b in f.bins[i].tolist():
            out["bin", str(b), y] += 1
        if i:
            out["step", f.tags[i], 2 * label[f.parent[i]] + y] += 1
    return out


LANDMARKS = re.compile(r"<(/?)(article|main|nav|header|footer|aside|section)\b", re.I)
OUTSIDE = frozenset("nav header footer aside form".split())


def landmark_text(html: str) -> str | None:
    """Text inside the only ``article`` or ``main`` of a page, without menus and the like; null if there is no such element."""
    page = parse(html)
    marks = [i for i, t in enumerate(page.tag) if t == "article"] or [i for i, t in enumerate(page.tag) if t == "main"]
    if len(marks) != 1:
        return None
    inside = [False] * len(page.tag)
    for i in range(marks[0], len(page.tag)):
        inside[i] = i == marks[0] or inside[page.parent[i]] and page.tag[i] not in OUTSIDE
    blocks = [block_text([x for x in b if inside[x[0]]]) for b in page.blocks]
    return "\n\n".join(b for b in blocks if b)


# Names that page authors give to parts of a page.
ASIDE_NAMES = (
    "nav navbar menu breadcrumb header masthead topbar footer bottom sidebar aside widget related recommended share social comment comments reply disqus discussion cookie consent "
    "banner notice notification alert popup modal overlay ad ads advert advertisement sponsor sponsored promo newsletter subscribe signup form login search copyright legal "
    "tags meta byline pagination pager toolbar skip hidden disclaimer replies responses feedback reactions rating popular trending teaser leaderboard warning gdpr privacy subscription signin register "
    "topnav subnav sitemap crumbs"
).split()
MAIN_NAMES = "content main article post entry story body text page".split()


def teaching_pages() -> list[tuple[str, str]]:
    """(html, main text) of plain labelled pages: usual parts under usual names, around and inside the main text."""
    words = "the river carried small boats past old houses while people spoke about weather, markets and long roads".split()
    line = lambda k, n: " ".join(words[(k * 7 + j) % len(words)] for j in range(n)).capitalize() + "."
    out = []
    for k, name in enumerate(ASIDE_NAMES):
        for form in range(3):
            main = [line(k + j, 18 + 9 * (j + form)) + " " + line(k * j + form, 14) for j in range(4)]
            title = line(k + 3, 5)
            list_ = "<ul>" + "".join(f'<li><a href="/{j}">{words[(k + j) % len(words)]}</a></li>' for j in range(5)) + "</ul>"
            body = f"<h{2 + k % 3}>{line(k, 2)}</h{2 + k % 3}><p>{line(k + 11, 16)} {line(k + 12, 12)}</p><p>{line(k + 13, 21)}</p>" if form else f"{line(k + 14, 17)} <b>{line(k, 3)}</b>" if k % 2 else f"<p>{line(k + 14, 6)}</p>{list_}"
            part = (f'<div class="{name}">{body}</div>', f'<section id="{name}">{body}</section>', f'<aside class="{name}-box">{body}</aside>' if k % 2 else f"<aside>{body}</aside>")[form]
            paragraphs = "".join(f"<p>{x}</p>" for x in main)
            extra = [[], [line(k + 7, 9), line(k + 8, 6)], [line(k + 9, 13)]][form]
            more = ("", f"<h{2 + k % 3}>{{}}</h{2 + k % 3}><ul><li>{{}}</li></ul>", "<blockquote>{}</blockquote>")[form].format(*extra)
            if k % 3 == 0:
                extra, more = [*extra, line(k, 3), line(k + 1, 2), line(k + 4, 4)], more + f"<table><tr><td>{line(k, 3)}</td><td>{line(k + 1, 2)}</td></tr></table><pre>{line(k + 4, 4)}</pre>"
            inner = f"<h1>{title}</h1>{paragraphs}{more}"
            holder = MAIN_NAMES[k % len(MAIN_NAMES)]
            whole = (f"<article>{inner}{part}</article>", f'<div class="{holder}">{inner}</div>{part}', f"{part}<main>{inner}</main>")[(k + form) % 3]
            form_ = '<form action="/s"><label>Search the site</label><input name="q"></form>'
            out.append((f"<html><body><nav>{list_}</nav><header><p>{line(k + 5, 4)}</p></header>{whole}{form_}<footer><p>{line(k + 6, 8)}</p></footer></body></html>", "\n\n".join([title, *main, *extra])))
    return out


def fit_content_model(labelled: DataFrame, html: str = "html", text: str = "text") -> ContentModel:
    """Learn the potentials from labelled pages (null text: left out) beside the teaching pages. The caller bounds their number.

    An element is content if more than half of its text lies in blocks of the labelled text. Each page also counts with its
    landmark elements turned into ``div``, so that pages without them can be told by their other features. Counts are made
    per page in the tasks and added up by feature; only feature counts reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                total.update(label_counts(h, t))
                total.update(label_counts(LANDMARKS.sub(r"<\1div", h), t))
        rows = list(total.items())
        yield pa.RecordBatch.from_arrays([pa.array([r[0][0] for r in rows], pa.string()), pa.array([r[0][1] for r in rows], pa.string()), pa.array([r[0][2] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64())], ["kind", "name", "y", "n"])

    ship(labelled.sparkSession)
    rows = labelled.filter(F.col(html).isNotNull() & F.col(text).isNotNull()).select(html, text)
    sums = rows.mapInArrow(count, "kind string, name string, y int, n long").groupBy("kind", "name", "y").agg(F.sum("n").alias("n"))
    # names of parts that only a few pages use tell nothing
    counts: dict[tuple[str, str], list[float]] = {}
    for r in sums.filter("kind <> 'token' OR n >= 3").collect():
        counts.setdefault((r.kind, r.name), [0.0] * 4)[r.y] += r.n
    # the given pages share weight with the teaching pages, whatever their number
    taught: Counter = Counter()
    for h, t in teaching_pages():
        taught.update(label_counts(h, t))
        taught.update(label_counts(LANDMARKS.sub(r"<\1div", h), t))
    given = sum(x[0] + x[1] for (kind, _), x in counts.items() if kind == "tag")
    scale = max(1.0, given / sum(n for (kind, _, _), n in taught.items() if kind == "tag"))
    for (kind, name, y), n in taught.items():
        counts.setdefault((kind, name), [0.0] * 4)[y] += n * scale
    return ContentModel.from_counts({k: tuple(v) for k, v in counts.items()})


def self_labelled(pages: DataFrame, bound: int = 2000, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(html, text) of at most ``bound`` different pages, drawn by a hash of the id and the page, whose only ``article`` or ``main`` says what is content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([landmark_text(h) for h in b.column(0).to_pylist()], pa.string())], ["html", "text"])

    spark: SparkSession = pages.sparkSession
    ship(spark)
    drawn = pages.filter(F.col(html).isNotNull()).select(F.xxhash64(page_id, html).alias("_h")).distinct().orderBy("_h").limit(bound)
    last = drawn.agg(F.max("_h")).first()[0]
    if last is None:
        return spark.createDataFrame([], "html string, text string")
    return pages.filter(F.col(html).isNotNull() & (F.xxhash64(page_id, html) <= last)).select(F.col(html).alias("html")).distinct().mapInArrow(run, "html string, text string")


def page_texts(htmls: list[str | None], model: ContentModel) -> list[str]:
    """Main text of each page; see ``extract_pages``."""
    pages = [parse(h or "") for h in htmls]
    f = Forest(pages)
    content = model.marginals(f) >= 0.5
    out = []
    for p, o in zip(pages, f.offsets, strict=True):
        blocks = (block_text([x for x in b if content[o + x[0]]]) for b in p.blocks)
        out.append("\n\n".join(b for b in blocks if b))
    return out


def extract_pages(pages: DataFrame, model: ContentModel, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of the whole page in ``text``.

    Text stands if the element that holds it is content with a chance of a half or more, given the whole page. White space
    inside a block becomes one space, blocks come in page order, joined by two line ends; character references are decoded
    once. Null or empty pages, and pages without content, have an empty text. Other columns stay; ``text`` is replaced.
    """
    ship(pages.sparkSession)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    kept = pages.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, 200):
                part = b.slice(k, 200)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(page_texts(part.column(html).to_pylist(), shared.value), pa.string())], [*part.schema.names, text])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, T.StructField(text, T.StringType())]))
