"""Main text of web pages from text-to-tag ratios.

The standard library's parser streams a page's events. Blocks are the page's lines; each has the ratio of its text to the tags since the
block before, links and hidden elements not counted as text. The ratios are smoothed with a Gaussian and cut at a threshold; lines above it
form the clusters that select the content:

* article and main elements are a prior: where they hold at least a quarter of the clusters' text, every outermost one that a cluster reaches
  is content, and the rest of the page isn't;
* elsewhere the content is the smallest element that holds nearly all of the clusters' text, from the first cluster to the last. At its
  ends, lines below their own threshold stay only where they are built like the clusters' lines, or are headings.

Short lines between and beside dense ones are content because the smoothing lifts them; lists of links are not. Elements that the page itself
marks as something else are left out, unless they are wrappers around all of it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from turnlake.llm.arrow import text_slices, texts

#: Elements that break blocks, that end by themselves, that never hold main text, and that never have an end tag.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
CLOSED_BY = {"p": BLOCKS, "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}), "tr": frozenset({"tr"}), "head": frozenset({"body"})}
SKIPPED = frozenset(
    "aside audio button canvas datalist dialog footer head iframe input label legend map math menu nav noscript object option script search select"
    " style svg template textarea title video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Skipped elements that are seen as a box of their own, and so part the words before and after.
BOXES = frozenset("audio button canvas iframe input label map object select svg textarea video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words in class, id and role names that mark page furniture, and those that do so outside an article only.
FURNITURE = frozenset(
    "ad ads adsense advert adverts advertisement advertising adbox alert alerts banner breadcrumb breadcrumbs comment comments commentlist consent"
    " cookie cookies dialog disqus gdpr menu modal nav navbar navigation newsletter notice notices pagination popup promo promoted recommended related"
    " reply replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
OUTER_FURNITURE = frozenset("footer header masthead topbar contentinfo complementary".split())
#: Words that turn such a name into one of the element around or beside the furniture, as in has-sidebar, and those that
#: turn a header or footer into an article's own.
LAYOUT = frozenset("free has no non with without".split())
OWN = frozenset("article content entry post story".split())
ROOTS = frozenset({"article", "main"})
#: The mark of elements that are never text, whatever is around them.
NEVER = 1 << 30

SIGMA = 1.5
#: Of the clusters' text: the least share in articles at which these are the content, and the share that a content element must hold.
ROOT_SHARE, ELEMENT_SHARE = 0.25, 0.9
_NAMES = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z0-9])([A-Z])")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_OPENING = re.compile(r"<[A-Za-z/!?]")
_COMMENT_END, _SECTION_END = re.compile(r"--!?\s*>"), re.compile(r"\]\]>")
_HEAT = np.exp(-np.arange(-4, 5) ** 2 / (2 * SIGMA * SIGMA))


@dataclass(slots=True)
class Line:
    """A block: its text, the tags before it, the share of its text in links, its outermost root, how many elements around it are named as
    furniture (or :data:`NEVER` at least), the form it is in, the element that holds it, and what kind of element it is."""

    text: str
    tags: int
    linked: float
    root: int
    marks: int
    form: int
    element: int
    tag: str


@dataclass(slots=True)
class _Open:
    tag: str
    marks: int
    block_marks: int
    root: int
    form: int
    element: int


class _Events(HTMLParser):
    """Collects the lines of a page, and for each element the one around it (0 is the page)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.parents = [0]
        self.stack = [_Open("", 0, 0, 0, 0, 0)]
        self.open: Counter[str] = Counter()
        self.parts: list[tuple[str, int]] = []
        self.tags = self.linked = self.links = 0
        self.block = "", 0
        self.endless: set[re.Pattern] = set()

    def parse_comment(self, i: int, report: bool = True) -> int:
        return self._skip(i, _COMMENT_END)

    def parse_html_declaration(self, i: int) -> int:
        return self._skip(i, _SECTION_END if self.rawdata.startswith("<![CDATA[", i) else None)

    def _skip(self, i: int, end: re.Pattern | None) -> int:
        """Where a comment or declaration ends: one that its own mark never ends, at the next ``>``. A search that failed isn't made again."""
        if end and end not in self.endless:
            if found := end.search(self.rawdata, i + 2):
                return found.end()
            self.endless.add(end)
        found = self.rawdata.find(">", i + 2)
        return found + 1 if found >= 0 else len(self.rawdata)

    def flush(self) -> None:
        text = " ".join("".join(p for p, _ in self.parts).split())
        if text:
            top = self.stack[-1]
            # names on inline elements count only where no text of the block is outside them
            marks = min(m for p, m in self.parts if p and not p.isspace())
            tag, element = self.block if self.block[1] == top.element or top.tag not in BLOCKS else (top.tag, top.element)
            self.lines.append(Line(text, self.tags, self.linked / len(text), top.root, marks, top.form, self.parents[element], tag))
            self.tags = 0
        self.parts.clear()
        self.linked = 0

    def _furniture(self, tag: str, attrs: list, root: int) -> int:
        """The mark that the element adds: one for a name, which the rest of the page may prove wrong, or :data:`NEVER`."""
        if tag in SKIPPED or tag == "header" and not root:
            return NEVER
        named = 0
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                if tag not in ROOTS and tag not in ("html", "body"):
                    for names in map(_NAMES.findall, _CAMEL.sub(r"\1 \2", value).lower().split()):
                        outer = not root and OWN.isdisjoint(names)
                        if any(n in FURNITURE or outer and n in OUTER_FURNITURE for n in names) and LAYOUT.isdisjoint(names):
                            named = 1
            elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and value and _UNSEEN.search(value):
                return NEVER
        return named

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self.tags += 1
        block = tag in BLOCKS
        if block:
            self.flush()
            while tag in CLOSED_BY.get(self.stack[-1].tag, ()):
                self._end(self.stack[-1].tag)
        elif tag in ("br", "td", "th") or tag in BOXES:
            self.parts.append((" ", NEVER))
        if tag == "body":
            self._end("head")
        if tag in VOID:
            return
        top, element = self.stack[-1], len(self.parents)
        self.parents.append(top.element)
        marks = top.marks + self._furniture(tag, attrs, top.root)
        root = top.root or (element if tag in ROOTS or any(k == "role" and v in ROOTS for k, v in attrs) else 0)
        self.stack.append(_Open(tag, marks, marks if block else top.block_marks, root, element if tag == "form" else top.form, element))
        if block:
            self.block = tag, element
        self.open[tag] += 1
        self.links += tag == "a"

    def _end(self, tag: str) -> None:
        if not self.open[tag]:
            return  # so a stray end tag costs nothing
        while True:
            last = self.stack.pop()
            self.open[last.tag] -= 1
            self.links -= last.tag == "a"
            if last.tag == tag:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag in BLOCKS:
            self.flush()
        elif tag in BOXES:
            self.parts.append((" ", NEVER))
        self._end(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("script", "style", "svg"):
            self._end(tag)

    def handle_data(self, data: str) -> None:
        top = self.stack[-1]
        if top.marks >= NEVER > top.block_marks:
            return  # a skipped element inside a block of text
        self.parts.append((data, top.marks))
        if self.links:
            self.linked += len(data)


def _smooth(values: np.ndarray) -> np.ndarray:
    """Gaussian means; at the ends, of what is there."""
    return np.convolve(values, _HEAT, "full")[4 : 4 + len(values)] / np.convolve(np.ones(len(values)), _HEAT, "full")[4 : 4 + len(values)]


def _marked(lines: list[Line]) -> int:
    """How many marks a line of text may have: none, but those of a wrapper around all of the page or around its article.

    A name around an article counts for nothing where no article is without one and the articles hold more text than the rest without one.
    """
    open_ = [b for b in lines if b.marks < NEVER]
    if not open_:
        return 0
    least, inside = min(b.marks for b in open_), [b for b in open_ if b.root]
    if inside and (wrapped := min(b.marks for b in inside)) > least:
        mass = lambda rows: sum(len(b.text) * (1 - b.linked) for b in rows)
        if mass(b for b in inside if b.marks == wrapped) > mass(b for b in open_ if b.marks < wrapped):
            return wrapped
    return least


def _forms(lines: list[Line]) -> set[int]:
    """The forms that are furniture: all but one around most of the page's text, which lost its controls when they were read."""
    held = Counter()
    for b in lines:
        if b.marks < NEVER:
            held[b.form] += len(b.text)
    return {f for f, n in held.items() if f and 2 * n <= held.total()}


def _without_lists(lines: list[Line], at: list[int], run: int, low: np.ndarray) -> list[int]:
    """Leave out lists of links: ``run`` or more lines in a row that are mostly links, any of them low."""
    out, i = [], 0
    while i < len(at):
        j = i
        while j < len(at) and lines[at[j]].linked > 0.5:
            j += 1
        if j - i < run or not low[at[i:j]].any():
            out += at[i:j]
        if j < len(at):
            out.append(at[j])
        i = j + 1
    return out


def _content(lines: list[Line], parents: list[int], hidden: np.ndarray, ratio: np.ndarray, smooth: np.ndarray) -> list[int]:
    """The lines that are content."""
    cut = min(smooth.std(), smooth.mean())  # the spread of the ratios, as is usual for this method; for even pages, what is common
    dense = (smooth >= cut) & ~hidden
    mass = np.array([len(b.text) * (1 - b.linked) for b in lines]) * dense
    root = np.array([b.root for b in lines])
    if mass[root > 0].sum() >= ROOT_SHARE * mass.sum() > 0:
        weight = lambda r: float((mass * smooth)[root == r].sum())
        reached = sorted(set(root[dense & (root > 0)].tolist()))
        links = {r: sum(len(b.text) * (b.linked - 0.5) for b, h in zip(lines, hidden, strict=True) if b.root == r and not h) for r in reached}
        best = max(reached, key=lambda r: (weight(r), -r))
        chosen = {r for r in reached if r == best or links[r] <= 0}
        return _without_lists(lines, [i for i, b in enumerate(lines) if b.root in chosen and not hidden[i]], 3, smooth < cut)
    linked = np.array([b.linked for b in lines])
    core = np.flatnonzero(dense & (linked <= 0.5))
    if not len(core):
        return []
    held = np.zeros(len(parents))
    for i in core:
        held[lines[i].element] += mass[i]
    total = held.sum()
    for e in range(len(parents) - 1, 0, -1):
        held[parents[e]] += held[e]
    around = max(np.flatnonzero(held >= ELEMENT_SHARE * total).tolist(), default=0)
    within = np.zeros(len(parents), bool)
    for e in range(len(parents)):
        within[e] = e == around or (e > 0 and within[parents[e]])
    core = [i for i in core.tolist() if within[lines[i].element]]
    own = [i for i in core if ratio[i] >= cut] or core
    built = {(lines[i].element, lines[i].tag) for i in own}
    edge = lambda i: own[0] <= i <= own[-1] or (lines[i].element, lines[i].tag) in built or lines[i].tag in HEADINGS
    first, last = next(i for i in core if edge(i)), next(i for i in reversed(core) if edge(i))
    return _without_lists(lines, [i for i in range(first, last + 1) if not hidden[i] and within[lines[i].element]], 2, linked > 0.5)


def _finished(html: str) -> str:
    """The page without a tag that its end cuts off, and all that would be in it."""
    end = html.rfind(">") + 1
    cut = _OPENING.search(html, end)
    return html[: cut.start()] if cut else html


def extract_text(html: str | None) -> str:
    """The page's main text: blocks in page order, one line each. Empty for null, empty and contentless pages."""
    if not html:
        return ""
    events = _Events()
    events.feed(_finished(html))
    events.close()
    events.flush()
    lines = events.lines
    if not lines:
        return ""
    allowed, forms = _marked(lines), _forms(lines)
    hidden = np.array([b.marks > allowed or b.form in forms for b in lines])
    ratio = np.array([len(b.text) * (1 - b.linked) / max(b.tags, 1) for b in lines]) * ~hidden
    return "\n".join(lines[i].text for i in _content(lines, events.parents, hidden, ratio, _smooth(ratio)))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)``, one row per input row: the main text and its code points.

    Null, empty and contentless pages have an empty text. Pages of any length are parsed whole; malformed markup is parsed as far as it
    makes sense, a comment without an end up to the next ``>``, and a tag that the page's end cuts off is left out. Null ids and repeated rows stay; other columns are ignored; an empty table gives an empty result.
    """
    source = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].cast("string").alias("html"))
    kinds = [source.schema[c].dataType.simpleString() for c in ("id", "url")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, 2):
            found = [extract_text(h) for h in texts(batch, 2)]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text", "n_chars"])

    out = source.mapInArrow(run, f"id {kinds[0]}, url {kinds[1]}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
