"""Main text of web pages by the ratios of text and punctuation to nodes on each tag path."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SMOOTH = (0.25, 0.5, 0.25)
THRESHOLD = 0.25
# Fused ratio of an ordinary short paragraph (60 characters, two marks): a very long one does not make others boilerplate.
TYPICAL = 180.0
# What a mark by tag, role, class or id leaves of the fused ratio: none, one by an ambiguous name, a certain one.
PENALTY = (1.0, 0.5, 0.0)
# An element with this share of the page's unlinked text is a wrapper, whatever it is called; one whose name is certain only
# if paragraphs outside of all names have no more than OUTSIDE of it.
WRAPPER = 0.5
OUTSIDE = 0.05
# What counts as a paragraph there: so many characters, and a punctuation mark.
PARAGRAPH = 60
# A block with more of its text in links than this is no text.
LINKED = 0.5

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_PUNCTUATION = re.compile(r"[.,;:!?…。，；：！？、]")

_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"}
_BLOCKS = set(
    "html head body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre "
    "header footer nav aside form fieldset figure figcaption address details summary dialog menu select option button hgroup center svg canvas "
    "audio video object search".split()
)
_NEVER = {"select", "button", "svg", "canvas", "audio", "video", "object", "head"}
_MARKED = {"nav", "footer", "aside", "form", "menu", "dialog", "search"}
_CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"},
}
_FENCES = {"table", "ul", "ol", "dl", "select", "td", "th"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar", "alertdialog"}
_BOILER = set(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices "
    "popup modal overlay newsletter subscribe subscription signup sidebar sidebars menu menus nav navbar navigation breadcrumb breadcrumbs footer "
    "masthead comment comments disqus respond reply replies share sharing social related recommended recommendations widget widgets login "
    "toolbar skip copyright legal alert alerts pagination pager".split()
)
# Names that also stand on parts of articles.
_AMBIGUOUS = set("legal related recommended recommendations copyright promotion share".split())
# Words that do not change what a name says.
_NEUTRAL = set(
    "left right top bottom main site page primary secondary block box area section wrap wrapper container inner list item items "
    "reader readers user users visitor visitors post posts article body text content form".split()
)
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


@dataclass(slots=True, eq=False)
class Element:
    tag: str
    at: int  # its place among the page's elements, parents before children
    parent: int
    depth: int
    path: int  # the number of its tag path
    never: bool
    hidden: bool
    mark: int
    article: bool  # whether it is an article or within one


@dataclass(slots=True, eq=False)
class Leaf:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""


def _mark(name: str) -> int:
    """2 if a class or id names boilerplate, 1 if it only has such a word in it (has-sidebar, related-work), else 0."""
    words = {w.lower() for w in _NAME.findall(name)}
    found = words & _BOILER
    return 0 if not found else 2 if found >= words - _NEUTRAL and not found <= _AMBIGUOUS else 1


class Page:
    """Elements and leaves of a page. Paths are numbered as they are met, so none is spelt out however deep it is."""

    def __init__(self):
        self.paths: dict[tuple[int, str], int] = {}
        self.elements = [Element("", 0, -1, 0, -1, False, False, 0, False)]
        self.leaves: list[Leaf] = []

    def add(self, tag: str, attributes: str, parent: Element) -> Element:
        hidden = False
        mark = 2 if tag in _MARKED else 0
        is_article = tag in ("article", "main")
        names: list[str] = []
        for name, a, b, c in _ATTRIBUTE.findall(attributes) if attributes.strip(" /") else ():
            name, value = name.lower(), a or b or c
            if name in ("class", "id"):
                names += value.split()
            elif name == "role":
                mark = 2 if value.strip().lower() in _ROLES else mark
                is_article |= value.strip().lower() in ("main", "article")
            elif name == "hidden" or (name == "aria-hidden" and value == "true"):
                hidden = True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                hidden = True
        words = {w.lower() for n in names for w in _NAME.findall(n)}
        named = max([0, *map(_mark, names)])
        if tag in ("article", "main"):
            # A comment can be an article of its own, but not the page's.
            if named == 2:
                mark, is_article = 2, False
        elif tag not in ("html", "body"):
            mark = max(mark, named)
            if (tag == "header" or "header" in words) and not parent.article:
                mark = 2
        path = self.paths.setdefault((parent.path, ".".join([tag, *sorted(words)])), len(self.paths))
        made = Element(tag, len(self.elements), parent.at, parent.depth + 1, path, parent.never or tag in _NEVER, hidden, mark, parent.article or is_article)
        self.elements.append(made)
        return made


def read(page: str) -> Page:
    """The page's elements and its pieces of text in order, each with the element that holds it; a new piece starts at every block's edge."""
    out = Page()
    stack = [out.elements[0]]
    leaf = Leaf(stack[0])
    anchors = at = 0

    def close() -> None:
        nonlocal leaf
        text = " ".join("".join(leaf.parts).split())
        if text:
            leaf.text = text
            out.leaves.append(leaf)
        leaf = Leaf(stack[-1])

    def add(raw: str) -> None:
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            leaf.parts.append(text)
            leaf.linked += len(text) if anchors else 0

    while True:
        m = _TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "a":
                anchors = max(0, anchors - 1)
            elif tag in _BLOCKS:
                i = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
                if i:
                    del stack[i:]
                close()
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag in ("br", "wbr"):
            add(" " if tag == "br" else "")
        elif tag == "hr":
            close()
        elif tag == "a":
            anchors += 1
        elif tag in _BLOCKS and tag not in _VOID:
            gone = _CLOSES.get(tag, set())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in gone:
                    del stack[i:]
                    break
                if stack[i].tag in _FENCES:
                    break
            if stack[-1].tag == "p":
                stack.pop()
            stack.append(out.add(tag, m[3] or m[6] or "", stack[-1]))
            close()
            anchors = 0
    close()
    return out


def _summed_up(page: Page, per_element: list) -> list:
    """For every element the sum over itself and all within it."""
    total = list(per_element)
    for e in reversed(page.elements[1:]):
        total[e.parent] += total[e.at]
    return total


def _marks(page: Page, found: list[Leaf], own: np.ndarray, marks: np.ndarray) -> list[int]:
    """Each element's mark: the strongest on its path below the last article or wrapper, 3 if hidden.

    A wrapper is an element that holds most of the page's unlinked text. One whose own tag or name is certain boilerplate
    is a wrapper only if it holds the article as well, or the paragraphs that no name covers are next to nothing; else a
    long footer or many comments would take the article's place. So an article within a marked element counts as one
    only if there is none outside.
    """
    elements = page.elements
    texts, articles = [0.0] * len(elements), [0] * len(elements)
    free = [True] * len(elements)  # of certain names
    for e in elements[1:]:
        free[e.at] = free[e.parent] and e.mark < 2 and not e.hidden
        articles[e.at] = int(e.article and not elements[e.parent].article)
    outside = 0.0
    for leaf, w, p in zip(found, own.tolist(), marks.tolist(), strict=True):
        texts[leaf.element.at] += w
        if w >= PARAGRAPH and p and free[leaf.element.at]:
            outside += w
    texts, within = _summed_up(page, texts), _summed_up(page, articles)
    total = texts[0]
    only_marked = not any(a and f for a, f in zip(articles, free, strict=True))
    out = [0] * len(elements)
    for e in elements[1:]:
        before = out[e.parent]
        wraps = texts[e.at] > WRAPPER * total and (e.mark < 2 or (within[e.at] and only_marked) or outside <= OUTSIDE * total)
        enters = articles[e.at] and before < 3 and (only_marked or before < 2)
        through = 0 if wraps or enters else before
        out[e.at] = through if wraps else max(through, 3 if e.hidden else e.mark)
    return out


def path_ratios(found: list[Leaf], own: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every leaf the number of its tag path among these leaves', and the text and the punctuation per leaf of that path."""
    _, path = np.unique([leaf.element.path for leaf in found], return_inverse=True)
    nodes = np.bincount(path)
    text, punctuation = (np.bincount(path, weights=w) / nodes for w in (own, marks + 1))
    return path, text[path], punctuation[path]


def main_text(page: str | None) -> str:
    """The text of the content node, blocks joined by line breaks.

    Controls and hidden elements are set aside. For every path of tags and classes the other leaves give two ratios: text
    length per leaf and punctuation per leaf. The sequence of the leaves' ratios is smoothed and the two are fused by their
    product. Tags, roles, classes and ids that name boilerplate (menus, footers, adverts, notices, comments, forms) lower
    the fused ratio, certain ones to nothing; a mark does not pass into the page's article, nor is it one on an element that
    holds most of the page's unlinked text. Leaves are selected if they reach a share of the largest value or of an ordinary
    paragraph's. The content node is the lowest element that holds all selected leaves, or an article around it. Its text
    are the selected leaves and what stands beside them unmarked: lists, tables, headings and short blocks, but no
    block of which most is links, and no leaf that is a link and no heading.
    """
    whole = read(page or "")
    found = [leaf for leaf in whole.leaves if not leaf.element.never]
    if not found:
        return ""
    own = np.array([max(0.0, len(leaf.text) * (1 - leaf.linked / len(leaf.text))) for leaf in found])
    marks = np.array([len(_PUNCTUATION.findall(leaf.text)) for leaf in found], dtype=float)
    held = _marks(whole, found, own, marks)
    mark = np.array([held[leaf.element.at] for leaf in found], dtype=np.int64)
    seen = mark < 3
    if any(leaf.element.article and m < 2 for leaf, m in zip(found, mark.tolist(), strict=True)):
        seen &= np.array([leaf.element.article for leaf in found])
    if not seen.any():
        return ""
    found = [leaf for leaf, s in zip(found, seen.tolist(), strict=True) if s]
    own, marks, mark = own[seen], marks[seen], mark[seen]
    _, text, punctuation = path_ratios(found, own, marks)
    smooth = [np.convolve(np.pad(r, 1, mode="edge"), SMOOTH, mode="valid") for r in (text, punctuation)]
    # A leaf beside a long one is not judged by it alone: its own path counts where smoothing would lift a link or lower a paragraph.
    fused = np.where(own > 0, np.maximum(smooth[0] * smooth[1], text * punctuation), 0)
    largest = fused[mark < 2].max(initial=0.0)
    if largest == 0:
        return "\n".join(leaf.text for leaf, m in zip(found, mark.tolist(), strict=True) if m < 2)
    sizes = np.array([len(leaf.text) for leaf in found], dtype=float)
    chosen = fused * np.array(PENALTY)[mark] >= THRESHOLD * min(largest, TYPICAL)
    chosen &= (fused > 0) & (mark < 2) & (own >= LINKED * sizes)
    if not chosen.any():
        chosen = (fused == largest) & (mark < 2)

    elements = whole.elements
    per = [[0.0] * len(elements) for _ in range(3)]
    for leaf, c, n, w in zip(found, chosen.tolist(), sizes.tolist(), own.tolist(), strict=True):
        for sums, x in zip(per, (c, n, w), strict=True):
            sums[leaf.element.at] += x
    picked, lengths, unlinked = (_summed_up(whole, sums) for sums in per)
    root = max((e for e in elements if picked[e.at] == picked[0]), key=lambda e: e.depth)
    while root.at and (root.tag not in ("article", "main", "section", "div", "body", "td") or (root.article and elements[root.parent].article and root.tag != "article")):
        root = elements[root.parent]
    # Parts of an ambiguous name stand with their selected leaves; a block without any must not be mostly links.
    inside, kept, near = [False] * len(elements), [False] * len(elements), [False] * len(elements)
    for e in elements:
        inside[e.at] = e is root or (e.at > 0 and inside[e.parent])
        below = inside[e.at] and e is not root
        whole_block = below and not picked[e.at] and picked[e.parent]
        kept[e.at] = inside[e.at] and (e is root or kept[e.parent]) and (not whole_block or unlinked[e.at] >= LINKED * lengths[e.at])
        near[e.at] = below and (near[e.parent] or (e.mark == 1 and picked[e.at] > 0))
    out = []
    for leaf, c, m, w, n in zip(found, chosen.tolist(), mark.tolist(), own.tolist(), sizes.tolist(), strict=True):
        e = leaf.element
        is_link = w < LINKED * n and e.tag not in _HEADINGS
        if c or (kept[e.at] and not is_link and (m == 0 or (m == 1 and near[e.at]))):
            out.append(leaf.text)
    return "\n".join(out)


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) per page row.

    Null and empty pages give an empty text; malformed and cut-off markup is read as far as it goes. Null ids and urls are
    kept, repeated rows give repeated results, an empty table gives no rows, other columns are ignored. Very long pages are
    read whole; elements may be nested to any depth.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch["html"]]
            columns = [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html")
    return rows.mapInArrow(work, "page_id long, url string, text string, n_chars long")


def op1_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
