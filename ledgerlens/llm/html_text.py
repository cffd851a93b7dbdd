"""HTML main text (operator 8) by minimum-cut labelling.

A page is cut into text blocks at block-level tags. A linear classifier over structure and
text gives each block a score for being content; its costs for either label are the
capacities to the two terminals of a graph. Edges join neighbouring blocks and blocks of one
container: the smoothness of labels that are near in the page or in the DOM. A maximum flow
separates content (the source's side of the minimum cut) from boilerplate.

Null and empty pages give an empty text; pages without any markup are one block; unclosed or
crossing tags, cut-off pages and stray ``<`` are read as browsers read them, roughly. White
space inside a block (``<br>`` included) becomes one space. Repeated rows give a row each;
extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: roles of HTML elements, and words of class names -------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
SILENT = frozenset("template svg math select datalist button object audio video canvas noscript "
                   "head label".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p "
    "pre search section summary table tbody td tfoot th thead tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that an opening tag of the same group closes, up to the container that holds them.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
          "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
BOILERPLATE_TAGS = frozenset("nav aside footer form menu dialog search".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog "
                              "alertdialog menu menubar toolbar".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner "
    "menu nav navbar navigation breadcrumb breadcrumbs sidebar aside widget footer cookie cookies consent "
    "gdpr notice popup modal overlay newsletter subscribe signup login share sharing social related "
    "recommended recommendations comment comments respond disqus reply replies pagination pager toolbar "
    "masthead topbar teaser alert".split())
CONTENT_WORDS = frozenset("article content post entry story main text body".split())

# --- the classifier's weights ----------------------------------------------------------------
IN_CONTENT, IN_BOILERPLATE, NAMED_CONTENT, PARAGRAPH, HEADING = 4.0, -12.0, 1.0, 1.0, 0.5
LINKS, MOST_LINKS, LENGTH, SENTENCE, SHORT, LEGAL, BIAS = -2.0, -3.0, 1.5, 0.7, -0.8, -2.5, -1.0
#: Smoothness between neighbours, and between blocks of one parent and of one grandparent.
NEAR, SIBLINGS, COUSINS = 0.2, 0.6, 0.3

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^"'>])*+)>""")
_BROKEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)")
_OTHER = re.compile(r"<!--.*?(?:-->|$)|<[!?/][^>]*(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_LEGAL = re.compile(r"©|all rights reserved|cookie|privacy policy|terms of (?:use|service)", re.I)


class Context:
    """What an open element tells of the text inside it."""

    __slots__ = ("name", "parent", "content", "boilerplate", "named", "link", "silent")

    def __init__(self, name: str, parent: Context | None):
        self.name, self.parent = name, parent
        self.content = parent.content if parent else False
        self.boilerplate = parent.boilerplate if parent else False
        self.named = parent.named if parent else False
        self.link = parent.link if parent else False
        self.silent = parent.silent if parent else False

    def read(self, attributes: str) -> None:
        name = self.name
        if name in ("article", "main"):
            self.content = True
        elif name in BOILERPLATE_TAGS or (name == "header" and not self.content):
            self.boilerplate = True
        elif name == "a":
            self.link = True
        elif name in SILENT:
            self.silent = True
        if attributes and not attributes.isspace():
            self._hints(attributes)

    def _hints(self, attributes: str) -> None:
        for key, value in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), value.strip("\"'")
            if key in ("class", "id"):
                words = {w.lower() for w in _WORDS.findall(value)}
                if self.name in ("html", "body", "article", "main"):
                    continue
                if words & BOILERPLATE_WORDS or ("header" in words and not self.content):
                    self.boilerplate = True
                elif words & CONTENT_WORDS:
                    self.named = True
            elif key == "role":
                if value in ("main", "article"):
                    self.content = True
                elif value in BOILERPLATE_ROLES:
                    self.boilerplate = True
            elif (key == "hidden" and self.name != "a") or (key == "aria-hidden" and value == "true") \
                    or (key == "style" and re.search(r"display\s*:\s*none", value)):
                self.silent = True


class Block:
    __slots__ = ("text", "linked", "context")

    def __init__(self, text: str, linked: int, context: Context):
        self.text, self.linked, self.context = text, linked, context


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in their order."""
    out: list[Block] = []
    root = Context("", None)
    stack = [root]
    pieces: list[str] = []
    linked, owner = 0, root

    def flush():
        nonlocal linked, owner
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append(Block(text, linked, owner))
            pieces.clear()
        linked = 0

    def holder() -> Context:
        return next((c for c in reversed(stack) if c.name in BLOCK), root)

    def say(raw: str):
        nonlocal linked, owner
        now = stack[-1]
        if now.silent or not raw:
            return
        if now.boilerplate and pieces and not owner.boilerplate and now.name not in BLOCK:
            return  # an advert or the like inside a line
        text = html.unescape(raw) if "&" in raw else raw
        if not pieces:
            if not text.strip():
                return
            owner = now if now.boilerplate else holder()
        elif owner.boilerplate and not now.boilerplate and text.strip():
            pieces.clear()  # the line began with an advert or the like
            linked, owner = 0, holder()
        if now.link:
            linked += len(text)
        pieces.append(text)

    def close(names, limits=frozenset()):
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in names:
                del stack[k:]
                return
            if stack[k].name in limits:
                return

    at, size = 0, len(page)
    while at < size:
        mark = page.find("<", at)
        if mark < 0:
            say(page[at:])
            break
        if mark > at:
            say(page[at:mark])
        tag = _TAG.match(page, mark) or _BROKEN_TAG.match(page, mark)
        if not tag:
            other = _OTHER.match(page, mark)
            if not other:
                say("<")
            at = other.end() if other else mark + 1
            continue
        at = tag.end()
        closing, name, attributes = tag.groups()
        name = name.lower()
        if name == "br":
            if pieces:
                pieces.append(" ")
            continue
        if name in BLOCK:
            flush()
        if closing:
            close({name})
            continue
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in VOID:
            continue
        if name in BLOCK and any(c.name == "p" for c in stack):
            close({"p"}, {"button", "td", "th", "table", "caption"})
        if name in CLOSES:
            close(*CLOSES[name])
        if name == "body":
            close({"head"})
        inside = Context(name, stack[-1])
        inside.read(attributes)
        if not attributes.endswith("/") or name in BLOCK:
            stack.append(inside)
    flush()
    return out


def score(block: Block) -> float:
    """The classifier's score (log-odds) that a block is content."""
    c, text = block.context, block.text
    z = BIAS
    if c.boilerplate:
        z += IN_BOILERPLATE
    elif c.content:
        z += IN_CONTENT
    if c.named:
        z += NAMED_CONTENT
    if c.name in ("p", "blockquote", "pre"):
        z += PARAGRAPH
    elif c.name in HEADINGS:
        z += HEADING
    share = min(1.0, block.linked / max(1, len(text)))
    z += LINKS * share + (MOST_LINKS if share > 0.6 else 0)
    z += LENGTH * min(1.0, math.log1p(len(text) / 40) / math.log(11))
    if text[-1] in ".!?…:;\"'”»)" and " " in text:
        z += SENTENCE
    elif len(text) < 25:
        z += SHORT
    if len(text) < 300 and _LEGAL.search(text) and not c.content:
        z += LEGAL
    return z


def edges(found: list[Block]) -> list[tuple[int, int, float]]:
    """Smoothness edges: neighbours in the page, and the last block of the same container."""
    out, last = [], {}
    for i, b in enumerate(found):
        parent = b.context.parent
        grand = parent.parent if parent else None
        if i:
            out.append((i - 1, i, NEAR))
        for key, weight in ((parent, SIBLINGS), (grand, COUSINS)):
            if key is None:
                continue
            if (id(key), weight) in last:
                out.append((last[id(key), weight], i, weight))
            last[id(key), weight] = i
    return out


def min_cut(scores: list[float], links: list[tuple[int, int, float]]) -> list[bool]:
    """Labels (true: content) of least total cost: a block's cost of the label that its score
    speaks against, plus the weights of the links whose ends differ. Found by maximum flow."""
    n = len(scores)
    graph: list[dict[int, float]] = [{} for _ in range(n + 2)]
    s, t = n, n + 1
    for i, z in enumerate(scores):  # only the difference of the two terminal costs matters
        a, b = (s, i) if z > 0 else (i, t)
        graph[a][b] = abs(z)
        graph[b].setdefault(a, 0.0)
    for i, j, w in links:
        graph[i][j] = graph[i].get(j, 0.0) + w
        graph[j][i] = graph[j].get(i, 0.0) + w
    while True:  # Dinic's algorithm
        level = [-1] * (n + 2)
        level[s] = 0
        queue = deque([s])
        while queue:
            u = queue.popleft()
            for v, room in graph[u].items():
                if room > 1e-9 and level[v] < 0:
                    level[v] = level[u] + 1
                    queue.append(v)
        if level[t] < 0:
            return [level[i] >= 0 for i in range(n)]
        rest = [iter(list(graph[u])) for u in range(n + 2)]
        path = [s]
        while path:
            u = path[-1]
            if u == t:
                flow = min(graph[a][b] for a, b in zip(path, path[1:]))
                cut = len(path)
                for k, (a, b) in enumerate(zip(path, path[1:])):
                    graph[a][b] -= flow
                    graph[b][a] = graph[b].get(a, 0.0) + flow
                    if graph[a][b] <= 1e-9 and k + 1 < cut:
                        cut = k + 1
                del path[cut:]
                continue
            for v in rest[u]:
                if level[v] == level[u] + 1 and graph[u][v] > 1e-9:
                    path.append(v)
                    break
            else:
                path.pop()
                level[u] = -2


def main_text(page: str | None) -> str:
    """The main text of a page: its content blocks, one a line."""
    found = blocks(page) if page else []
    if not found:
        return ""
    labels = min_cut([score(b) for b in found], edges(found))
    return "\n".join(b.text for b, keep in zip(found, labels) if keep)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = batch.column(2)
            text = pa.array([main_text(source[i].as_py()) for i in range(len(source))], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), text],
                                             names=["page_id", "url", "text"])

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    kinds = [rows.schema[c].dataType.simpleString() for c in ("page_id", "url")]
    return rows.mapInArrow(run, f"page_id {kinds[0]}, url {kinds[1]}, text string") \
        .withColumn("n_chars", F.length("text").cast("long"))
