"""Main text of web pages by tag-path ratios.

A page is a tree; each text node has a path of tags from the root. Per path the
length of the text, its punctuation, its links and its number of nodes are summed:
long, punctuated, unlinked text per node speaks for content. Ratios of paths are
smoothed with those of paths that share their parent, length and punctuation are
fused into one score, and paths at or above a threshold are content. All text on
content paths is returned, and so is all other text of the elements that hold it
together, since a heading or a list item is part of the article however short:
the named articles where they hold most of the content, else the smallest section
of the page with nearly all of it.

Tags and class words of menus, notices, comments and the like mark a subtree, and a
marked subtree is left out, however long it is. Only where a mark stands on what
wraps the article is it lifted: when no text that reads like prose (punctuated,
unlinked, of any length) is left outside of marked subtrees, or, for marks that a
layout may carry (a form around the page, a header, a sidebar class), when at most
one short block is left outside, and no article or main element has prose there.

Defined results: a null or empty page, and one without text, gives an empty text;
broken markup is read as far as it goes (an open comment or script runs to the
end); equal scores need no order, as paths are kept or dropped by threshold;
repeated pages give equal rows; an empty table gives an empty one; other columns
of the input are not read. Time and memory are in proportion to the page, however
deep its elements are nested.
"""

from __future__ import annotations

import heapq
import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*+)"
    r"(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|</?[A-Za-z][^>]*+(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S,
)
CLASS = re.compile(r"""(?:^|\s)(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？¿¡]")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg annotation annotation-xml".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol"
    " p pre section summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "aside button dialog footer form head header input label menu nav option select".split()
)
DROPPED_WORDS = frozenset(
    "ad ads adsbygoogle advert advertisement adverts banner breadcrumb breadcrumbs comment comments"
    " consent cookie cookies disclaimer disqus footer header masthead menu modal nav navbar navigation"
    " newsletter notice pager pagination popup promo promotion related respond replies share"
    " sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
DROPPED_ROLES = frozenset("alert alertdialog complementary contentinfo dialog search".split())
# What a page's layout may put around the article itself.
LAYOUT = frozenset("form header masthead sidebar toolbar widget".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}}
CLOSED_BY |= {"td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table article section div body main aside nav header footer form".split())
NAMED = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Elements whose ids are the slugs of their own headings or terms.
SLUGGED = HEADINGS | frozenset("p li dt dd td th tr pre blockquote figure figcaption summary".split())
ABSENT = frozenset("has no with without".split())
HOLDERS = frozenset("html body div article main section form center header footer aside fieldset details dialog".split())
THRESHOLD = 0.25
SHARE = 0.5
COVER = 0.9
SHORT = 0.1
KEPT, WEAK, STRONG = range(3)
# Elements that a later tag may close, and those that can hold one of their own name.
CLOSABLE = frozenset("p li dt dd tr td th option".split())
NESTING = frozenset("svg template annotation annotation-xml".split())


class Node:
    """An element; `path` numbers its path of tags, `scope` and `area` count what is open in it."""

    __slots__ = (
        "area", "content", "dropped", "heading", "linked", "mark", "name", "open", "parent", "path",
        "prose", "proses", "scope", "size", "within",
    )

    def __init__(self, name: str, parent: Node | None, path: int, mark: int):
        self.name, self.parent, self.path, self.mark = name, parent, path, mark
        self.within = name in NAMED or bool(parent and parent.within)
        self.linked = name == "a" or bool(parent and parent.linked)
        self.heading = name in HEADINGS or bool(parent and parent.heading)
        # The nearest block, and the nearest element that keeps paragraphs and items apart.
        self.scope = self if name in BLOCK or parent is None else parent.scope
        self.area = self if name in SCOPES or parent is None else parent.area
        self.open: dict[str, int] = {}
        self.dropped = False
        self.size = self.content = self.prose = self.proses = 0


class Tree:
    """The elements of a page as its tags open and close them."""

    def __init__(self):
        self.paths: dict[tuple[int, str], int] = {}
        self.parents: list[int] = [-1]
        self.root = self.node = Node("", None, 0, KEPT)
        self.elements = [self.root]
        self.blocks: dict[str, int] = {}

    def push(self, name: str, tokens: list[tuple[str, str]]) -> None:
        parent = self.node
        words = [w for _, token in tokens for w in re.split(r"[_-]+", token)]
        key = (parent.path, ".".join([name, *words]))
        path = self.paths.setdefault(key, len(self.parents))
        if path == len(self.parents):
            self.parents.append(parent.path)
        self.node = Node(name, parent, path, _mark(name, tokens, parent))
        self.elements.append(self.node)
        self._count(self.node, 1)

    def _count(self, node: Node, step: int) -> None:
        """Note that an element opens or closes, where a later tag will look for it."""
        if node.name in BLOCK:
            self.blocks[node.name] = self.blocks.get(node.name, 0) + step
        else:
            held = node.parent.scope.open
            held[node.name] = held.get(node.name, 0) + step
        if node.name in CLOSABLE:
            held, key = node.parent.area.open, f"<{node.name}"
            held[key] = held.get(key, 0) + step

    def pop_to(self, node: Node) -> None:
        """Close everything up to and with that element."""
        while True:
            last, self.node = self.node, self.node.parent
            self._count(last, -1)
            if last is node:
                return

    def close(self, name: str) -> None:
        """An end tag: of a block, the nearest one open; of other elements, one in this block."""
        is_open = self.blocks if name in BLOCK else self.node.scope.open
        if is_open.get(name, 0) > 0:
            up = self.node
            while up.name != name:
                up = up.parent
            self.pop_to(up)

    def make_room(self, name: str) -> None:
        """What a start tag closes: a paragraph before a block, an item before the next one."""
        closes = CLOSED_BY.get(name) or ({"p"} if name in BLOCK else set())
        while any(self.node.area.open.get(f"<{c}", 0) > 0 for c in closes):
            up = self.node
            while up.name not in closes:
                up = up.parent
            self.pop_to(up)


def _attributes(more: str) -> list[tuple[str, str]]:
    found = []
    for m in CLASS.finditer(more):
        kind = m[0].lstrip().split("=")[0].strip().lower()
        found += [(kind, token) for token in "".join(filter(None, m.groups())).lower().split()]
    return found


def _mark(name: str, tokens: list[tuple[str, str]], parent: Node) -> int:
    """How far tag and class words speak against an element below `parent`."""
    if name in ("html", "body", "main"):
        return KEPT
    found = set()
    if name in DROPPED and not (name == "header" and parent.within):
        found.add(name)
    in_heading = name in HEADINGS or parent.heading
    for kind, token in tokens:
        slug = name in SLUGGED or name not in BLOCK or in_heading or name == "section" and parent.within
        if kind == "id" and slug:
            continue
        words = [w for w in re.split(r"[_-]+", token) if w]
        if not ABSENT.isdisjoint(words) or name == "article" and len(words) > 1:
            continue
        hits = {w for w in [*words, *map("".join, zip(words, words[1:]))] if w in DROPPED_WORDS}
        if kind == "role":
            hits |= DROPPED_ROLES.intersection(words)
        if in_heading or parent.within:
            hits -= {"header", "masthead"}
        found |= hits
    return STRONG if found - LAYOUT else WEAK if found else KEPT


def _raw_end(page: str, name: str, at: int) -> int:
    """Where the raw element that was opened before `at` ends, nested ones of its name counted."""
    depth = 1
    for m in re.compile(rf"<(/?){re.escape(name)}(?=[\s/>])[^>]*+(?:>|\Z)", re.I).finditer(page, at):
        if m[1]:
            depth -= 1
        elif name in NESTING and not m[0].endswith("/>"):
            depth += 1
        if not depth:
            return m.end()
    return len(page)


def text_nodes(page: str) -> tuple[list[tuple[Node | None, str]], Tree]:
    """The page's texts with the elements that hold them, (None, "") between blocks; all elements."""
    tree = Tree()
    found, at = [], 0
    while True:
        m = MARKUP.search(page, at)
        stop = m.start() if m else len(page)
        if stop > at:
            found.append((tree.node, page[at:stop]))
        if m is None:
            return found, tree
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        if name in BLOCK:
            found.append((None, ""))
        if name == "br":
            found.append((tree.node, " "))
        if m["close"]:
            tree.close(name)
        elif name in RAW:
            if not m["more"].endswith("/"):
                at = _raw_end(page, name, at)
        elif name not in VOID and not (m["more"].endswith("/") and name not in BLOCK):
            tree.make_room(name)
            tree.push(name, _attributes(m["more"]) if "=" in m["more"] else [])


def path_scores(texts: list[tuple[Node, str]], parents: list[int]) -> dict[int, float]:
    """Fused and smoothed ratio of each path; `parents` has the path above each."""
    sums: dict[int, list[float]] = {}
    for node, text in texts:
        size = len(text.strip())
        own = sums.setdefault(node.path, [0, 0, 0, 0])
        for k, x in enumerate((size, len(PUNCTUATION.findall(text)), size * node.linked, 1)):
            own[k] += x
    fused = {
        path: size / n * math.log1p(1 + marks / n) * (1 - linked / size) if size else 0.0
        for path, (size, marks, linked, n) in sums.items()
    }
    groups: dict[int, list[int]] = {}
    for path in fused:
        groups.setdefault(parents[path], []).append(path)
    smooth = {}
    for paths in groups.values():
        weight = sum(sums[p][0] for p in paths)
        around = sum(fused[p] * sums[p][0] for p in paths) / weight if weight else 0.0
        smooth |= {p: (fused[p] + around) / 2 for p in paths}
    return smooth


def _sum_up(elements: list[Node], *names: str) -> None:
    """Add what each element has of its own to all above it."""
    for n in reversed(elements):  # children come after their parents
        if n.parent is not None:
            for name in names:
                setattr(n.parent, name, getattr(n.parent, name) + getattr(n, name))


def _weigh(shown: list[tuple[Node, str]], elements: list[Node], scores: dict[int, float], least: float) -> None:
    """Set each element's length of text, and of text on content paths."""
    for n in elements:
        n.size = n.content = 0
    for node, text in shown:
        node.size += len(text)
        node.content += len(text) * (scores[node.path] >= least and scores[node.path] > 0)
    _sum_up(elements, "size", "content")


def _settle(elements: list[Node]) -> None:
    for n in elements:
        n.dropped = n.mark > KEPT or bool(n.parent and n.parent.dropped)


def _lift_marks(prose: list[tuple[Node, int]], elements: list[Node]) -> None:
    """Take the marks off what wraps the article; `prose` has the blocks that read like text."""
    for node, size in prose:
        node.prose += size
        node.proses += 1
    direct: dict[int, list[tuple[Node, int]]] = {}
    _settle(elements)
    # Every block by the innermost mark above it, and every mark by the next one above.
    above: dict[int, Node | None] = {}
    for n in elements:
        above[id(n)] = n if n.mark > KEPT else above[id(n.parent)] if n.parent else None
    for node, size in prose:
        direct.setdefault(id(above[id(node)]), []).append((node, size))
    inner: dict[int, list[Node]] = {}
    for n in elements:
        if n.mark > KEPT:
            inner.setdefault(id(above[id(n.parent)]), []).append(n)
    _sum_up(elements, "prose", "proses")
    queue: list[tuple] = []
    outside: list[tuple[Node, int]] = []
    lifted: Node | None = None
    while True:
        outside += direct.get(id(lifted), [])
        if len(outside) > 1 or any(n.within for n, _ in outside):
            break
        for n in inner.get(id(lifted), []):
            if n.prose:
                heapq.heappush(queue, (n.mark != WEAK, -n.prose, id(n), n))
        size = sum(size for _, size in outside)
        lifted = None
        while queue and lifted is None:
            n = heapq.heappop(queue)[-1]
            # One block outside: only what a layout may carry, and only around much more.
            if not outside or n.mark == WEAK and size <= SHORT * n.prose and n.proses > 1:
                lifted = n
        if lifted is None:
            break
        lifted.mark = KEPT
    _settle(elements)


def _prose(nodes: list[tuple[Node | None, str]]) -> list[tuple[Node, int]]:
    """Blocks that are punctuated and mostly unlinked: the element of their first text, and length."""
    found, block = [], []
    for node, text in [*nodes, (None, "")]:
        if node is not None:
            if not text.isspace():
                block.append((node, text))
        elif block:
            size = sum(len(t) for _, t in block)
            linked = sum(len(t) for n, t in block if n.linked)
            plain = html.unescape("".join(t for n, t in block if not n.linked))
            if PUNCTUATION.search(plain) and linked <= SHARE * size:
                found.append((block[0][0], size))
            block = []
    return found


def main_text(page: str | None, threshold: float = THRESHOLD, share: float = SHARE) -> str:
    """Blocks of the article, one space for white space, two line breaks between blocks."""
    nodes, tree = text_nodes(page or "")
    elements = tree.elements
    _lift_marks(_prose(nodes), elements)
    shown = [(n, t) for n, t in nodes if n is not None and not t.isspace() and not n.dropped]
    if not shown:
        return ""
    scores = path_scores([(n, html.unescape(t)) for n, t in shown], tree.parents)
    least = threshold * max(scores.values())
    _weigh(shown, elements, scores, least)
    total = elements[0].content
    # The outermost named elements if they have most of the content, else the
    # smallest section of the page that has nearly all of it.
    held = [n for n in elements if n.name in NAMED and n.content and not (n.parent and n.parent.within)]
    if not total:
        held = elements[:1]
    elif sum(n.content for n in held) <= share * total:
        held = [n for n in elements if (n.name in HOLDERS or not n.name) and n.content >= COVER * total][-1:]
    inside: dict[int, bool] = {id(n): True for n in held}
    for n in elements:
        inside[id(n)] = id(n) in inside or bool(n.parent and inside[id(n.parent)])
    blocks, block, kept = [], [], False
    for node, text in [*nodes, (None, "")]:
        if node is not None:
            if not node.dropped:
                block.append(text)
                if not text.isspace():
                    kept = kept or inside[id(node)] or scores[node.path] >= least > 0
        else:
            if kept:
                blocks.append(" ".join(html.unescape("".join(block)).split()))
            block, kept = [], False
    return "\n\n".join(b for b in blocks if b)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")
    ).mapInArrow(extract, "page_id long, url string, text string, n_chars long")
