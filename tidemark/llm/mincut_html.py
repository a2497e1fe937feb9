"""Main text of web pages by minimum-cut labelling of their text blocks.

*Blocks.* The page is read tag by tag (no tree is needed): text between two block-level tags is a block. Scripts,
styles, titles and other invisible elements carry none. A block knows its open elements, the share of its characters
inside links, and the element that holds it.

*Classifier.* A logistic model over length, link share, closing punctuation, word count and kind of element is learned
from a bounded sample of pages (``Setup.sample_pages`` of smallest id hash), whose blocks inside article or main and
inside navigation, footers, asides and forms are the labels. Its log odds are the terminal capacities of a block; a
block inside such an element, or inside one whose class, id or role names page furniture, gets the capacity ``sure``.

*Cut.* Blocks that follow each other, and blocks with the same parent, are joined by edges; the capacity falls with the
number of elements between them. The minimum cut between content and boilerplate labels the page's blocks together, so
unsure blocks follow their neighbourhood.

Character references are decoded, white space inside a block becomes one space, blocks are joined by an empty line.
A null or empty html gives an empty text, as does a page without content. Rows are independent of each other; only the
named columns are read.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_texts, table
from tidemark.llm.toxicity import fit_logistic

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|aria-label|hidden|itemprop)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
#: Elements whose text is never shown as prose.
SILENT = frozenset("script style title noscript template svg math canvas object iframe audio video head select "
                   "textarea button datalist".split())
#: Of these the content is raw: it ends at its own end tag only.
RAW = frozenset("script style title textarea noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter q rp "
                   "rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
FURNITURE = frozenset("nav footer aside form menu dialog".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu".split())
#: Class and id names (whole, or up to - or _) of page furniture.
_NAMES = re.compile(
    r"^(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promos?|promotions?|banner|sidebar|side-bar|"
    r"menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|topbar|toolbar|cookies?|consent|gdpr|notices?|"
    r"popup|modal|overlay|alert|comments?|commentlist|disqus|replies|respond|share|sharing|social|related|recommended|"
    r"newsletter|subscribe|subscription|signup|login|search|pagination|pager|widget|copyright|legal|disclaimer)"
    r"(?:[-_].*)?$", re.I)
_LAST_NAMES = re.compile(
    r"[-_](?:ads?|sidebar|menu|nav|navbar|footer|banner|cookies?|notice|comments?|newsletter|popup|modal|promo|breadcrumbs?)$", re.I)
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 "
                      "header hr main menu nav ol p pre section table ul".split())
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
_CLOSING = (".", "!", "?", "…", ":", ";", '"', "”", "»")


@dataclass(frozen=True)
class Setup:
    sample_pages: int = 400
    sure: float = 50.0
    adjacent: float = 1.0
    siblings: float = 0.5


class Page:
    """The text blocks of one page."""

    def __init__(self, source: str):
        self.texts: list[str] = []
        self.parts: list[str] = []
        self.linked = 0
        self.stack: list[tuple[str, int, int]] = []  # name, mark (1 furniture, -1 content, 0 none), element number
        self.rows: list[tuple] = []
        self.number = 0
        self._read(source)

    def _flush(self) -> None:
        raw = "".join(self.parts)
        self.parts, linked, self.linked = [], self.linked, 0
        text = " ".join(html.unescape(raw).split())
        if not text:
            return
        names = [name for name, _, _ in self.stack]
        marks = [mark for _, mark, _ in self.stack]
        blocks = [n for name, _, n in self.stack if name not in INLINE]
        mark = 1 if 1 in marks else -1 if -1 in marks else 0
        heading = any(re.fullmatch("h[1-6]", n) for n in names)
        self.texts.append(text)
        self.rows.append((mark, min(1.0, linked / max(1, len(text))), heading, "li" in names or "td" in names,
                          "p" in names, tuple(blocks)))

    def _mark(self, name: str, attributes: str) -> int:
        inside = any(n in ("article", "main") for n, _, _ in self.stack)
        if name in FURNITURE or (name == "header" and not inside):
            return 1
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)} if attributes else {}
        if "hidden" in found:
            return 1
        if found.get("role", "").lower() in FURNITURE_ROLES:
            return 1
        if name in ("article", "main") or found.get("role") == "main" or found.get("itemprop") == "articleBody":
            return -1 if not any(m == 1 for _, m, _ in self.stack) else 0
        if name in ("html", "body"):
            return 0
        for word in f"{found.get('class', '')} {found.get('id', '')}".split():
            if (_NAMES.match(word) and not (inside and word.lower().startswith("header"))) or _LAST_NAMES.search(word):
                return 1
        return 0

    def _pop(self, names) -> None:
        """Closes the innermost open element of some names, if one is open inside the current container."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in names:
                del self.stack[i:]
                return
            if self.stack[i][0] in ("ul", "ol", "dl", "table", "article", "body"):
                return

    def _read(self, source: str) -> None:
        at, silent = 0, 0
        position = 0
        while position < len(source):
            m = _TOKEN.search(source, position)
            text = source[at:m.start() if m else len(source)]
            if text and not silent:
                self.parts.append(text)
                if any(n == "a" for n, _, _ in self.stack):
                    self.linked += len(text.strip())
            if not m:
                break
            at = position = m.end()
            if not m[2]:
                continue
            name = m[2].lower()
            if m[1]:
                if name in VOID or not any(n == name for n, _, _ in self.stack):
                    if name not in INLINE and not silent:
                        self._flush()
                    continue
                if name not in INLINE:
                    self._flush() if not silent else None
                while self.stack:
                    gone = self.stack.pop()[0]
                    silent -= gone in SILENT
                    if gone == name:
                        break
                continue
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
                if name not in INLINE and not silent:
                    self._flush()
                at = position = end.end() if end else len(source)
                continue
            if name not in INLINE and not silent:
                self._flush()
            if name in VOID:
                if name == "br" and not silent:
                    self.parts.append(" ")
                continue
            if name in ("body", "main", "article", "header", "nav", "div", "p") and any(n == "head" for n, _, _ in self.stack):
                silent -= sum(n in SILENT for n, _, _ in self.stack)  # a head that was never closed
                self.stack = [e for e in self.stack if e[0] not in SILENT]
            if name in _CLOSES_P:
                self._pop({"p"})
            if name in _SIBLINGS:
                self._pop(_SIBLINGS[name])
            if m[3] and m[3].rstrip().endswith("/") and name not in INLINE:
                continue
            self.number += 1
            self.stack.append((name, self._mark(name, m[3]), self.number))
            silent += name in SILENT
        self._flush()

    def features(self) -> np.ndarray:
        out = np.ones((len(self.texts), 8))
        for i, (text, (_, linked, heading, item, paragraph, _)) in enumerate(zip(self.texts, self.rows)):
            out[i, 1:] = (np.log1p(len(text)) / 5, linked, text.endswith(_CLOSING), min(text.count(" "), 50) / 25,
                          heading, item, paragraph)
        return out


def minimum_cut(content: list[float], other: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (True: content) of least total cost; ``content`` is what labelling a node otherwise costs.

    Shortest augmenting paths from nodes with spare content capacity to nodes with spare other capacity.
    """
    n = len(content)
    supply = [c - o for c, o in zip(content, other)]
    spare: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, capacity in edges:
        spare[a][b] = spare[a].get(b, 0.0) + capacity
        spare[b][a] = spare[b].get(a, 0.0) + capacity
    tiny = 1e-9
    while True:
        parent = {i: -1 for i in range(n) if supply[i] > tiny}
        queue, end = list(parent), -1
        for node in queue:
            if supply[node] < -tiny:
                end = node
                break
            for to, left in spare[node].items():
                if left > tiny and to not in parent:
                    parent[to] = node
                    queue.append(to)
        if end < 0:
            return [i in parent for i in range(n)]
        path, node = [], end
        while parent[node] >= 0:
            path.append((parent[node], node))
            node = parent[node]
        flow = min([supply[node], -supply[end]] + [spare[a][b] for a, b in path])
        supply[node] -= flow
        supply[end] += flow
        for a, b in path:
            spare[a][b] -= flow
            spare[b][a] = spare[b].get(a, 0.0) + flow


def label(page: Page, beta: np.ndarray, setup: Setup) -> list[bool]:
    """Content or not, for every block of a page."""
    if not page.texts:
        return []
    odds = page.features() @ beta
    for i, row in enumerate(page.rows):
        if row[0]:
            odds[i] = -setup.sure * row[0]
    edges, last_in = [], {}
    for i, row in enumerate(page.rows):
        path = row[5]
        if i:
            before = page.rows[i - 1][5]
            shared = next((k for k, (a, b) in enumerate(zip(path, before)) if a != b), min(len(path), len(before)))
            edges.append((i - 1, i, setup.adjacent / (1 + len(path) + len(before) - 2 * shared)))
        holder = path[-2] if len(path) > 1 else 0
        if holder in last_in and last_in[holder] != i - 1:
            edges.append((last_in[holder], i, setup.siblings))
        last_in[holder] = i
    return minimum_cut([max(0.0, o) for o in odds], [max(0.0, -o) for o in odds], edges)


def learn(pages: DataFrame, setup: Setup = Setup()) -> list[float]:
    """Weights of the block classifier; without labelled blocks, zeros: then only sure blocks and neighbours decide."""
    chosen = pages.where("html IS NOT NULL").select("page_id").distinct().orderBy(
        F.xxhash64("page_id"), "page_id").limit(setup.sample_pages)
    sample = pages.join(chosen, "page_id", "left_semi")

    def block(sources: list) -> dict:
        out = []
        for s in sources:
            page = Page((s or b"").decode("utf-8", "replace"))
            out.append([[float(r[0]), *f] for r, f in zip(page.rows, page.features().tolist())])
        return {"rows": out}

    rows = [b for r in map_texts(sample, block, "rows array<array<double>>", {}, "html").collect() for b in r.rows if b[0]]
    if len({b[0] for b in rows}) < 2:
        return [0.0] * 8
    data = np.array(rows)
    return fit_logistic(data[:, 1:], (data[:, 0] < 0).astype(float)).tolist()


def extract(
    pages: DataFrame, beta: list[float], setup: Setup = Setup(), keep: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per page: the ``keep`` columns (default page_id and url), text, n_chars, n_blocks and n_kept."""
    keep = keep or {"page_id": F.col("page_id").cast("long"), "url": F.col("url")}
    weights = np.array(beta)

    def block(sources: list) -> dict:
        out: dict = {"text": [], "n_chars": [], "n_blocks": [], "n_kept": []}
        for s in sources:
            page = Page((s or b"").decode("utf-8", "replace"))
            kept = [t for t, good in zip(page.texts, label(page, weights, setup)) if good]
            text = "\n\n".join(kept)
            for name, value in (("text", text), ("n_chars", len(text)), ("n_blocks", len(page.texts)), ("n_kept", len(kept))):
                out[name].append(value)
        return out

    return map_texts(pages, block, "text string, n_chars long, n_blocks long, n_kept long", keep, "html")


def op9_mincut_html(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learn(pages))
