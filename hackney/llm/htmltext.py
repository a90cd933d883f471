"""Main-text extraction from HTML by minimum-cut labelling.

A page's visible text is cut into blocks at block-level tags. A logistic
classifier gives each block the probability that it is content; the negative
logarithms are what labelling it content or boilerplate costs. These costs are
the capacities to two terminals; edges between neighbouring blocks, and between
successive blocks of one container of the document tree, cost their weight if
their ends get different labels. The minimum cut, found by maximum flow, is
the labelling of least total cost; the content blocks in page order are the
text.

The classifier's features (``FEATURES``) are the block's own text (length,
links, sentence marks, letters), its element, its place in the tree (the
container that holds most of the page's prose, the share and number of blocks
in its own container), its neighbours, and hints: whether an element, a role or
a class name around it speaks for content or against it. All weights are fitted
here, on blocks of a bounded sample of pages: those whose markup leaves no
doubt, and on pages without such markup those whose links or container leave
little. Each example is learned twice, with its hints and without, so that pages with
other or no names are judged by text and structure. The fit starts from
``PRIOR``, which decides alone what the sample does not show.

The sample is ``FIT_PAGES`` distinct (id, HTML) pairs at most, those of the least
hashes, and of each page at most ``FIT_BLOCKS`` blocks, evenly spread. Extraction
runs over every page and its whole HTML.

Defined cases: NULL or empty HTML, and pages without content, give the empty
text; broken and truncated markup is read leniently (unclosed tags end with
their parent); NULL ids, repeated rows and very long pages are rows like
others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import bounded_sample, ship_package

FIT_PAGES, FIT_BLOCKS = 400, 200

# What HTML's elements are.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section "
    "select summary table tbody td tfoot th thead title tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN_TAGS = frozenset("head script style noscript template textarea title iframe object svg math canvas audio video "
                        "select option button datalist xmp noembed noframes".split())
SECTION_TAGS = frozenset("article aside body dialog div fieldset footer form header main nav section table ul ol dl"
                         .split())
#: An opening tag of the key ends an open element of these tags, if it is the innermost block.
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"},
        "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "option": {"option"}}

# Elements, roles and names that speak for content or against it.
CONTENT_TAGS = frozenset(("article", "main"))
BOILERPLATE_TAGS = frozenset("nav footer aside form fieldset menu dialog search".split())
CONTENT_ROLES = frozenset(("article", "main"))
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu "
                              "menubar".split())
PROSE_TAGS = frozenset("p pre blockquote".split())
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEM_TAGS = frozenset("li dt dd td th caption figcaption".split())
BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|advert\w*|adsense|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|sidebar\w*|"
    r"side|widget\w*|footer\w*|masthead|topbar|toolbar|cookies?|consent|gdpr|notice\w*|alert\w*|popup|modal|overlay|"
    r"subscribe|subscription|newsletter|signup|login|comments?|commentlist|disqus|respond|replies|share|sharing|"
    r"social|related|recommend\w*|outbrain|taboola|pager|pagination|legal|copyright|disclaimer|skip\w*)"
    r"(?:$|[\s_-]|\d)", re.I)
GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article\w*|post|entry|story|content|main|text|body|page)(?:$|[\s_-])", re.I)

# What the fit starts from and is drawn to: the weight of each feature before any page is seen.
FEATURES = {"bias": -1.5, "length": 1.0, "links": -3.0, "ends a sentence": 0.8, "letters": 0.5,
            "prose element": 0.7, "heading": 0.7, "item": -0.2,
            "in the main container": 1.0, "share of its container": 0.5, "blocks in its container": 0.3,
            "links before": -0.5, "links after": -0.5, "length before": 0.2, "length after": 0.2, "distance from the middle": -0.3,
            "content element": 4.0, "content role": 3.0, "content name": 0.8,
            "boilerplate element": -9.0, "boilerplate role": -9.0, "boilerplate name": -9.0,
            "outside the page's content element": -3.0}
PRIOR = np.array(list(FEATURES.values()))
HINTS = list(FEATURES).index("content element")  # the features from here on are hints
SHRINK = 0.003
#: A container is the page's main one if it holds this share of the page's prose; the innermost such counts.
MAIN_SHARE = 0.6

# Weights of the smoothness edges.
NEXT_TO, SAME_PARENT, SAME_SECTION = 0.3, 0.5, 0.4

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|title|iframe|xmp)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)", re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")


@dataclass
class Block:
    text: str
    tag: str         # the innermost block element
    parent: int      # its number
    section: int     # number of the innermost section
    links: float     # share of characters inside links
    hints: int       # bits: content element, role, name; boilerplate element, role, name


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    outer: list[tuple[int, int]] = field(default_factory=list)  # (section, the section around it), as they open


@dataclass
class _Open:
    tag: str
    hints: int
    hidden: bool
    link: bool
    block_tag: str
    block: int
    section: int


_GOOD, _BAD = 0b000111, 0b111000


def _hints(tag: str, attrs: str, around: int) -> tuple[int, bool]:
    """The hints an element gives for all inside it, and whether it is hidden."""
    hints = (tag in CONTENT_TAGS) | (tag in BOILERPLATE_TAGS) << 3
    if tag == "header" and not around & 1:
        hints |= 1 << 3  # within an article it is the article's own heading
    if not attrs or tag in ("a", "b", "i", "em", "strong"):
        return hints, False
    given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)}
    role = given.get("role", "").lower()
    hints |= (role in CONTENT_ROLES) << 1 | (role in BOILERPLATE_ROLES) << 4
    if tag not in ("body", "html", "article", "main"):
        names = f"{given.get('class', '')} {given.get('id', '')}"
        if BAD_NAME.search(names):
            hints |= 1 << 5
        elif GOOD_NAME.search(names):
            hints |= 1 << 2
    hidden = ("hidden" in given or given.get("aria-hidden") == "true"
              or bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""))))
    return hints, hidden


def read(page: str) -> Page:
    """The visible text blocks of a page, in order, in time linear in its length."""
    root = _Open("", 0, False, False, "", 0, 0)
    stack, out = [root], Page()
    where: dict[str, list[int]] = {}  # tag -> places in the stack of its open elements
    open_blocks: list[int] = []       # places in the stack of open block elements
    parts: list[str] = []
    linked = numbered = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            top = stack[-1]
            if text:
                raw = sum(map(len, parts))
                out.blocks.append(Block(text, top.block_tag, top.block, top.section, min(1.0, linked / raw), top.hints))
            parts.clear()
        linked = 0

    def close(at: int) -> None:
        """Ends the elements from a place of the stack on."""
        while len(stack) > at:
            ended = stack.pop()
            where[ended.tag].pop()
            if open_blocks and open_blocks[-1] == len(stack):
                open_blocks.pop()

    for token in _TOKEN.finditer(page):
        kind = token.lastgroup
        if kind == "text":
            top = stack[-1]
            if not top.hidden:
                text = token["text"]
                text = html.unescape(text) if "&" in text else text
                parts.append(text)
                if top.link:
                    linked += len(text)
            continue
        if token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if token["end"]:
            if where.get(tag):
                at = where[tag][-1]
                if open_blocks and open_blocks[-1] >= at:
                    flush()
                close(at)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        is_block = tag in BLOCK_TAGS
        if is_block:
            flush()
            closes = ENDS.get(tag, {"p"})
            while open_blocks and stack[open_blocks[-1]].tag in closes:
                close(open_blocks[-1])
        if tag in VOID_TAGS:
            continue
        top = stack[-1]
        numbered += 1
        hints, hidden = _hints(tag, token["attrs"], top.hints)
        is_section = tag in SECTION_TAGS
        if is_section:
            out.outer.append((numbered, top.section))
        where.setdefault(tag, []).append(len(stack))
        if is_block:
            open_blocks.append(len(stack))
        stack.append(_Open(tag, top.hints | hints, top.hidden or hidden or tag in HIDDEN_TAGS,
                           top.link or tag == "a", tag if is_block else top.block_tag,
                           numbered if is_block else top.block, numbered if is_section else top.section))
    flush()
    return out


def _main_container(page: Page) -> set[int]:
    """The innermost section with most of the page's unlinked text, and all within it; empty if that is the whole page."""
    prose: dict[int, float] = {}
    for block in page.blocks:
        prose[block.section] = prose.get(block.section, 0.0) + len(block.text) * (1 - block.links)
    enough = MAIN_SHARE * sum(prose.values())
    for section, outer in reversed(page.outer):  # inner sections open later than those around them
        if section in prose:
            prose[outer] = prose.get(outer, 0.0) + prose[section]
    main = 0
    for section, outer in page.outer:
        if outer == main and prose.get(section, 0.0) >= enough > 0:
            main = section
    inside = {main} if main else set()
    for section, outer in page.outer:
        if outer in inside:
            inside.add(section)
    return inside


def features(page: Page) -> np.ndarray:
    """One row of ``FEATURES`` for every block of a page."""
    found = page.blocks
    if not found:
        return np.zeros((0, len(PRIOR)))
    main = _main_container(page)
    sizes, counts = {}, {}
    for block in found:
        sizes[block.section] = sizes.get(block.section, 0) + len(block.text)
        counts[block.section] = counts.get(block.section, 0) + 1
    total = sum(sizes.values())
    length = [math.log1p(len(b.text)) / 5 for b in found]
    has_content = any(b.hints & 1 for b in found)
    rows, last = [], len(found) - 1
    for i, b in enumerate(found):
        hints = [float(b.hints >> k & 1) for k in range(6)]
        if b.hints & _BAD:
            hints[:3] = 0.0, 0.0, 0.0  # what is boilerplate within an article is not the article's
        rows.append([
            1.0, length[i], b.links, float(b.text[-1] in ".!?…\"'”»"), sum(map(str.isalpha, b.text)) / len(b.text),
            float(b.tag in PROSE_TAGS), float(b.tag in HEADING_TAGS), float(b.tag in ITEM_TAGS),
            float(b.section in main), sizes[b.section] / total, math.log(counts[b.section]) / 3,
            found[i - 1].links if i else 0.0, found[i + 1].links if i < last else 0.0,
            length[i - 1] if i else 0.0, length[i + 1] if i < last else 0.0, abs(2 * i / last - 1) if last else 0.0,
            *hints, float(has_content and not b.hints & 1)])
    return np.array(rows)


def seeds(page: Page) -> list[int]:
    """1 (content) or 0 for the blocks that can teach, -1 for the others.

    Where the markup names the content or the boilerplate, that counts. On a
    page without any such hint, blocks that are mostly links or lie outside the
    main container are boilerplate, longer ones with few links inside it content.
    """
    if any(b.hints & (_BAD | 0b011) for b in page.blocks):
        return [0 if b.hints & _BAD else 1 if b.hints & 0b011 else -1 for b in page.blocks]
    main = _main_container(page)
    return [0 if b.links >= 0.5 or main and b.section not in main
            else 1 if main and b.links < 0.2 and len(b.text) >= 80 else -1 for b in page.blocks]


def fit(rows: np.ndarray, labels: np.ndarray, steps: int = 30, shrink: float = SHRINK) -> np.ndarray:
    """Weights of a logistic model drawn to ``PRIOR`` (Newton steps); ``PRIOR`` itself unless both labels occur."""
    weights = PRIOR.copy()
    if not len(labels) or labels.min() == labels.max():
        return weights
    bare = rows.copy()
    bare[:, HINTS:] = 0.0
    rows, labels = np.concatenate([rows, bare]), np.concatenate([labels, labels])
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())) / len(labels)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -35, 35)))
        slope = rows.T @ (balance * (p - labels)) + shrink * (weights - PRIOR)
        curve = (rows * (balance * np.maximum(p * (1 - p), 1e-3))[:, None]).T @ rows + shrink * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def _cut(lean: list[float], edges: dict[tuple[int, int], float]) -> list[bool]:
    """Which nodes stay with the source in the minimum cut.

    ``lean`` is the capacity from the source less that to the sink. A node
    that leans more than all its edges weigh is decided alone, and its edges
    become leanings of its neighbours; the rest goes through maximum flow.
    """
    near: list[dict[int, float]] = [{} for _ in lean]
    for (a, b), w in edges.items():
        near[a][b] = near[b][a] = w
    lean, side = list(lean), [None] * len(lean)
    ready = [i for i in range(len(lean)) if abs(lean[i]) >= sum(near[i].values())]
    while ready:
        i = ready.pop()
        if side[i] is not None:
            continue
        side[i] = lean[i] >= 0
        for j, w in near[i].items():
            if side[j] is None:
                del near[j][i]
                lean[j] += w if side[i] else -w
                if abs(lean[j]) >= sum(near[j].values()):
                    ready.append(j)
    open_nodes = [i for i, s in enumerate(side) if s is None]
    if open_nodes:
        reached = _max_flow(open_nodes, lean, near, side)
        for i in open_nodes:
            side[i] = i in reached
    return side


def _max_flow(nodes: list[int], lean: list[float], near: list[dict[int, float]], side: list) -> set[int]:
    """Nodes the source reaches in the residual network of a maximum flow (blocking flows along shortest paths)."""
    source, sink, eps = -1, -2, 1e-12
    left: dict[int, dict[int, float]] = {i: {j: w for j, w in near[i].items() if side[j] is None} for i in nodes}
    left[source], left[sink] = {}, {}
    for i in nodes:
        if lean[i] > 0:
            left[source][i], left[i][source] = lean[i], 0.0
        elif lean[i] < 0:
            left[i][sink], left[sink][i] = -lean[i], 0.0
    while True:
        level, queue = {source: 0}, deque([source])
        while queue:
            a = queue.popleft()
            for b, room in left[a].items():
                if room > eps and b not in level:
                    level[b] = level[a] + 1
                    queue.append(b)
        if sink not in level:
            return set(level)
        untried = {a: list(left[a]) for a in level}
        path = [source]
        while path:
            a = path[-1]
            if a == sink:
                steps = list(zip(path, path[1:], strict=False))
                flow = min(left[x][y] for x, y in steps)
                full = None
                for k, (x, y) in enumerate(steps):
                    left[x][y] -= flow
                    left[y][x] += flow
                    if full is None and left[x][y] <= eps:
                        full = k
                del path[full + 1:]
                continue
            while untried[a]:
                b = untried[a][-1]
                if left[a][b] > eps and level.get(b) == level[a] + 1:
                    path.append(b)
                    break
                untried[a].pop()
            else:
                path.pop()
                if path:
                    untried[path[-1]].pop()


def edges_of(found: list[Block]) -> dict[tuple[int, int], float]:
    """What it costs to label two blocks differently that are neighbours or follow each other in a container."""
    edges: dict[tuple[int, int], float] = {}
    last: dict[int, int] = {}
    for i, block in enumerate(found):
        if i:
            edges[i - 1, i] = NEXT_TO + SAME_PARENT * (found[i - 1].parent == block.parent)
        before = last.get(block.section)
        if before is not None:
            edges[before, i] = edges.get((before, i), 0.0) + SAME_SECTION
        last[block.section] = i
    return edges


def label(page: Page, weights: np.ndarray) -> list[bool]:
    """Which blocks are content, by minimum cut."""
    if not page.blocks:
        return []
    # log(p) - log(1 - p) is the score itself: the capacity from the source less that to the sink.
    return _cut([float(x) for x in features(page) @ weights], edges_of(page.blocks))


def main_text(page: str | None, weights: np.ndarray) -> str:
    """The content blocks of a page, joined by line feeds."""
    found = read(page) if page else Page()
    return "\n".join(b.text for b, keep in zip(found.blocks, label(found, weights), strict=True) if keep)


def learn(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", fit_pages: int = FIT_PAGES) -> np.ndarray:
    """The classifier's weights from the blocks that can teach of a bounded sample of pages."""
    ship_package(pages.sparkSession)

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            xs, ys = [], []
            for text in batch.column(0):
                page = read(text.as_py())
                known = [(x, y) for x, y in zip(features(page).tolist(), seeds(page), strict=True) if y >= 0]
                for x, y in known[::max(1, -(-len(known) // FIT_BLOCKS))]:
                    xs.append(x)
                    ys.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(xs, pa.list_(pa.float64())), pa.array(ys, pa.int32())],
                                             names=["x", "y"])

    chosen = bounded_sample(pages, [id_col, html_col], html_col, fit_pages)
    got = chosen.select("value").mapInArrow(examples, "x array<double>, y int").collect()
    got = sorted((list(r["x"]), r["y"]) for r in got)  # the same sum whatever order tasks end in
    return fit(np.array([x for x, _ in got]), np.array([y for _, y in got], float))


def extract(pages: DataFrame, weights: np.ndarray, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text, n_chars (code points)."""
    ship_package(pages.sparkSession)
    model = [float(w) for w in weights]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py(), np.array(model)) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())],
                                             names=["id", "url", "text", "n_chars"])

    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return (rows.mapInArrow(run, f"id {id_type}, url {url_type}, text string, n_chars long")
            .withColumnsRenamed({"id": id_col, "url": url_col}))
