"""Operator 7: main text of web pages by minimum-cut labelling.

A page is read into text blocks in page order. A linear classifier gives each block a cost of either label from its
words, links, tags and the names of the elements around it; these are the capacities from the source (content) and to
the sink (boilerplate). Blocks next to each other are joined by smoothness edges, the stronger the nearer they are in the
tree of elements, and so are like elements of one parent. The minimum cut of that graph leaves the main text on the source's
side: blocks whose cost outweighs their edges are settled first, the rest by shortest augmenting paths, level by level.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopfloor.llm import common

# Elements of HTML by what they do to text.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead title tr ul".split())
BREAKS = frozenset({"br"})
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: Elements whose text isn't of the page; they end with their parent.
UNSEEN = frozenset("noscript object svg template".split())
#: Elements that a start tag of the key ends if they are open nearer than the stop set.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
PARAGRAPH_ENDERS = BLOCKS - {"body", "caption", "head", "html", "legend", "optgroup", "option", "tbody", "td", "tfoot", "th", "thead", "title", "tr"}
OUTER = frozenset({"ul", "ol", "dl", "table", "select", "body", "html", "article", "section", "div"})

# The classifier's words. Elements and the parts of class, id and role names that speak for either side.
CHROME_TAGS = frozenset("nav footer header aside form button select menu dialog search".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN_TAGS = frozenset("article main".split())
PROSE = frozenset("p pre blockquote".split())
CHROME_NAMES = frozenset("ad ads advert advertisement banner breadcrumb breadcrumbs byline comment comments complementary consent contentinfo cookie cookies copyright disqus dropdown footer form gdpr header hidden login masthead menu meta modal nav navbar navigation newsletter notice outbrain pager pagination pagelinks popup privacy promo promoted promotion related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe taboola tags toolbar topbar widget".split())
#: Names that a wrapper of the whole page may have for its layout.
LAYOUT_NAMES = frozenset("banner footer header hidden menu nav navbar navigation sidebar tags toolbar topbar widget".split())
READER_NAMES = frozenset("comment comments disqus replies reply respond".split())
#: Parts of a name after which, or before which, the rest says how a page is laid out or set, not what the element holds.
STATED = frozenset("no has with without not is show hide hides shows".split())
SETTINGS = frozenset("open closed enabled disabled allowed on off active inactive left right".split())
MAIN_NAMES = frozenset("article body content entry main post story text".split())

TAG = re.compile(r"""<!--.*?(?:-->|--!>|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|$)|'[^']*(?:'|$))*)(?:>|$)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE = re.compile(r"[\s ]+")

# Weights of the classifier, and capacities of the edges: between blocks next to each other, and of one parent.
WEIGHTS = {"bias": -0.4, "chrome": -8.0, "main": 3.5, "links": -3.0, "length": 0.5, "stops": 0.25, "heading": 0.6, "prose": 0.9, "item": -0.3, "head": -9.0}
NEXT, SIBLING = 1.6, 0.6
#: Steps in the tree of elements past which blocks are as far as can be.
FAR = 12


@dataclass
class Element:
    tag: str
    parent: Element | None
    chrome: bool
    main: bool
    heading: bool
    item: bool
    names: frozenset = frozenset()  # for which it or one around it is chrome; none if for a tag or hidden
    depth: int = 0


@dataclass
class Block:
    element: Element
    parts: list[str] = field(default_factory=list)
    linked: int = 0  # characters inside links

    @property
    def text(self) -> str:
        return SPACE.sub(" ", "".join(self.parts)).strip()


def attributes(raw: str) -> dict[str, str]:
    return {m[0].lower(): html.unescape(m[1] or m[2] or m[3] or "") for m in ATTRIBUTE.findall(raw)} if raw.strip() else {}


def parts_of(listed: str) -> tuple[set[str], set[str]]:
    """All parts of the names in a class, id or role, and those of names that tell what the element is: no-sidebar,
    has-comments and comments-open say something of the page around it."""
    every, telling = set(), set()
    for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", listed).lower().split():
        own = re.findall(r"[a-z]+", name)
        every.update(own)
        if own and own[0] not in STATED and not (len(own) > 1 and own[-1] in SETTINGS):
            telling.update(own)
    return every, telling


def opened(tag: str, raw: str, parent: Element | None) -> Element:
    own = attributes(raw)
    names, telling = parts_of(" ".join(own.get(k, "") for k in ("class", "id", "role")))
    hidden = "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "").lower()
    inside = parent is not None and parent.main
    # an article may have a header of its own with the title
    own_header = tag == "header" and inside
    # a form may be a page's wrapper, if it isn't inside what the page is about
    wrapper = tag == "form" and not inside and not (parent and parent.chrome)
    hard = hidden or tag in UNSEEN or (tag in CHROME_TAGS and not own_header and not wrapper)
    bad = telling & (READER_NAMES if tag in MAIN_TAGS else CHROME_NAMES) if tag not in ("body", "html") else frozenset()
    bad = bad - {"header"} if own_header else bad | {"form"} if wrapper else bad
    role, around = tag in MAIN_TAGS or own.get("role") == "main", bool(parent and parent.chrome)
    # a main element has its text though a wrapper around it is named for the page's layout
    if around and parent.names and (role and parent.names <= LAYOUT_NAMES or (role or "article" in names) and parent.names <= LAYOUT_NAMES | {"form"}):
        around = False
    why = frozenset(bad) | (parent.names if around else frozenset())
    if hard or (around and not parent.names):
        why = frozenset()
    main = (role and not bad) or bool(names & MAIN_NAMES) or inside
    return Element(tag, parent, hard or bool(bad) or around, main, tag in HEADINGS or bool(parent and parent.heading), tag == "li" or bool(parent and parent.item), why, parent.depth + 1 if parent else 0)


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order: runs of text between block elements, line breaks inside them kept as spaces."""
    root = Element("html", None, False, False, False, False)
    stack, out, links = [root], [], 0
    opens: Counter[str] = Counter()
    block = Block(root)

    def pop() -> None:
        opens[stack.pop().tag] -= 1

    def close() -> None:
        nonlocal block
        if block.parts:
            out.append(block)
        block = Block(stack[-1])

    def add(text: str) -> None:
        if text and not any(opens[x] for x in UNSEEN):
            text = html.unescape(text)
            block.parts.append(text)
            if links:
                block.linked += len(text.strip())

    at, n = 0, len(page)
    while at < n:
        m = TAG.search(page, at)
        add(page[at : m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:  # an end tag closes its element and those still open in it, if it is open
            if tag == "a":
                links = max(0, links - 1)
            if opens[tag]:
                if tag in BLOCKS:
                    close()
                while stack[-1].tag != tag:
                    pop()
                pop()
                if tag in BLOCKS:
                    close()
            elif tag in ("p", "br"):
                close()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|$)[^>]*(?:>|$)", re.I).search(page, at)
            at = end.end() if end else n
            if tag in BLOCKS:
                close()
            continue
        if tag in BREAKS:
            block.parts.append(" ")
            continue
        if tag in BLOCKS:
            if tag in PARAGRAPH_ENDERS and opens["p"]:
                while stack[-1].tag != "p":
                    pop()
                pop()
            ended = ENDS.get(tag, frozenset())
            if any(opens[x] for x in ended):
                near = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag in ended or stack[k].tag in OUTER), 0)
                if near and stack[near].tag in ended:
                    while len(stack) > near:
                        pop()
            close()
        if tag in VOID or (tag in UNSEEN and m[3].rstrip().endswith("/")):
            continue
        if tag == "a":
            links += 1
        stack.append(opened(tag, m[3], stack[-1]))
        opens[tag] += 1
        if tag in BLOCKS:
            close()
    close()
    return out


def preference(block: Block, text: str, has_main: bool) -> float:
    """The classifier: above 0 for content."""
    e, n = block.element, len(text)
    share = min(1.0, block.linked / max(1, n))
    w = WEIGHTS
    value = w["bias"] + w["length"] * min(4.0, n / 60) + w["stops"] * min(4, len(re.findall(r"[.!?,;:]", text))) + w["links"] * share
    value += w["prose"] * (e.tag in PROSE) + w["chrome"] * e.chrome + w["heading"] * e.heading + w["item"] * e.item * (1 + 2 * share)
    # what is beside an article, or beneath it, isn't of it for being inside its element
    return value + (0.0 if e.chrome else w["main"] if e.main else -1.5 if has_main else 0.0)


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Whether each node stays with the source in a minimum cut (the largest such side); edges run both ways."""
    n = len(source)
    gain, kept, held = [a - b for a, b in zip(source, sink, strict=True)], [None] * n, [0.0] * n
    near: list[list[tuple[int, float]]] = [[] for _ in range(n)]
    for a, b, c in edges:
        for x, y in ((a, b), (b, a)):
            near[x].append((y, c))
            held[x] += c
    # a node whose own cost is more than all its edges is settled, and pulls at those next to it
    queue = list(range(n))
    while queue:
        i = queue.pop()
        if kept[i] is None and (gain[i] >= held[i] or -gain[i] > held[i]):
            kept[i] = gain[i] >= held[i]
            for j, c in near[i]:
                if kept[j] is None:
                    gain[j] += c if kept[i] else -c
                    held[j] -= c
                    queue.append(j)
    rest = [i for i in range(n) if kept[i] is None]
    number = {i: k for k, i in enumerate(rest)}
    open_edges = [(number[a], number[b], c) for a, b, c in edges if kept[a] is None and kept[b] is None]
    for i, side in zip(rest, max_flow([gain[i] for i in rest], open_edges), strict=True):
        kept[i] = side
    return kept


def max_flow(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The nodes that can't reach the sink when no more flows from nodes of positive gain to those of negative."""
    to: list[list[int]] = [[] for _ in gain]  # numbers of edges; the reverse of edge k is k ^ 1
    head, left, gain = [], [], list(gain)
    for a, b, c in edges:
        for x, y in ((a, b), (b, a)):
            to[x].append(len(head))
            head.append(y)
            left.append(c)
    while True:
        # steps to the nearest node that takes more
        level = {i: 0 for i, g in enumerate(gain) if g < -1e-9}
        queue = deque(level)
        while queue:
            a = queue.popleft()
            for k in to[a]:
                if left[k ^ 1] > 1e-9 and head[k] not in level:
                    level[head[k]] = level[a] + 1
                    queue.append(head[k])
        starts = [i for i, g in enumerate(gain) if g > 1e-9 and i in level]
        if not starts:
            return [i not in level for i in range(len(gain))]
        turn = [0] * len(gain)
        for s in starts:
            path = []
            while gain[s] > 1e-9:
                a = head[path[-1]] if path else s
                if level[a] == 0 and gain[a] < -1e-9:
                    flow = min(gain[s], -gain[a], *(left[k] for k in path))
                    gain[s] -= flow
                    gain[a] += flow
                    for k in path:
                        left[k] -= flow
                        left[k ^ 1] += flow
                    path = []
                elif turn[a] == len(to[a]):
                    if not path:
                        break
                    path.pop()
                    turn[head[path[-1]] if path else s] += 1
                else:
                    k = to[a][turn[a]]
                    if left[k] > 1e-9 and level.get(head[k], -1) == level[a] - 1:
                        path.append(k)
                    else:
                        turn[a] += 1


def apart(a: Element, b: Element) -> int:
    """Steps from one element to another in their tree, up to FAR."""
    n = 0
    while a is not b and n < FAR:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        n += 1
    return n


def main_text(page: str | None) -> str:
    found = [(b, t) for b in blocks_of(page or "") if (t := b.text)]
    if not found:
        return ""
    has_main = any(b.element.main and not b.element.chrome for b, _ in found)
    score = [preference(b, t, has_main) for b, t in found]
    edges, last = [], {}
    for i, (b, _) in enumerate(found):
        e = b.element
        if i:
            edges.append((i - 1, i, NEXT / (2 + apart(found[i - 1][0].element, e))))
        alike = id(e.parent), e.tag
        if alike in last:
            edges.append((last[alike], i, SIBLING))
        last[alike] = i
    kept = minimum_cut([max(x, 0.0) for x in score], [max(-x, 0.0) for x in score], edges)
    if not any(kept):  # a page of a few words, which nothing speaks for or against
        kept = [not b.element.chrome and 2 * b.linked < len(t) for b, t in found]
    return "\n".join(t for (_, t), k in zip(found, kept, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """Adds ``text`` (blocks joined by line breaks, empty if there are none) and ``n_chars`` to every row.

    Null and empty html give an empty text, an empty table an empty one. Rows are worked on by themselves, so null ids and
    repeated rows stay as they are. Time grows with a page's length and blocks, however deep or many. Columns named text
    or n_chars are replaced, any others stay.
    """
    pages = pages.drop("text", "n_chars")
    kind = pages.select("*", F.lit("").alias("text")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x for y in batches for x in common.slices(y, "html")):
            text = pa.array([main_text(h) for h in b.column("html").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, text], schema=pa.schema([*b.schema, pa.field("text", pa.string())]))

    return pages.mapInArrow(run, kind).withColumn("n_chars", F.length("text").cast("bigint"))
