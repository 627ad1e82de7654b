"""Main text of web pages by composite text density.

A page is parsed into a tree of its tags. Subtrees that are no article by their tag or role
go first (menus, headers, footers, asides, scripts, styles), then those that a class or id marks
(sidebars, notices, adverts, comments of readers), forms and dialogs, if they hold no article and little
of the page's text: what holds most of it wraps the page. A form wraps the page only if its text
is long for its controls; an element that is named as readers' comments, adverts or notices and
nothing else never does. Ids of headings and, but for readers' comments and adverts, of what is
inside an article mark nothing. A page of which nothing remains has no main text. For every
remaining node the composite text density is its characters
per tag, adjusted by the share of characters and tags inside links. A node's density sum
adds the densities of its children; the subtree of the largest sum is the article. The
smallest density on the path from there to the body is the threshold: what hangs beside
that path and reaches it belongs to the text too, and so do headings directly before a node
of the path. If the article element is marked as such, only other article elements that reach
it do. Equal sums go to the node that comes first in the page.

Null pages count as empty and give an empty text; a page without a body is read as one.
Cut-off tags and references are tolerated. Character references are decoded, white space
inside a block becomes one space, blocks are joined by one space in page order; nothing
else is dropped and no length is capped. Repeated rows give repeated results; other
columns pass through, ``main_text`` is replaced. One narrow pass, linear in the page.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import map_arrow, text_of

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>?",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
NAME = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noframes xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
NO_TEXT = frozenset(
    "head title script style noscript template button select option textarea input iframe object svg canvas "
    "audio video map".split()
)
DROPPED = NO_TEXT | frozenset("nav footer aside menu dialog".split())
CONTROLS = frozenset("button select textarea input".split())
#: characters per control from which a form holds a page and does not ask for input
PER_CONTROL = 100
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
#: an opening tag of the key ends an open tag of the set, up to the listed container
SIBLINGS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table", "tbody", "thead", "tfoot"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
ROLES = frozenset("navigation banner contentinfo complementary search menu menubar alert".split())
#: roles that may wrap a page, as forms and marked elements do
WRAPPING = frozenset("form dialog".split())
#: words of a class or id that mark what is no article
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar menu "
    "nav navbar navigation breadcrumb breadcrumbs footer header masthead cookie cookies consent notice notices popup modal "
    "newsletter subscribe share sharing social related comment comments disqus widget".split()
)
#: words that overrule the marks
KEPT = frozenset("article post entry content main story".split())
#: words of what is by readers or advertisers, and words that may stand beside them in an id inside an article
OTHERS = frozenset("comment comments disqus ad ads".split())
OTHERS_PLACE = OTHERS | frozenset("area block box container list section slot thread wrapper".split())
#: words of notices; an element named by these, by OTHERS and by the words beside them alone is never text
NOTICES = frozenset("cookie cookies consent notice notices popup modal newsletter subscribe advert adverts advertisement".split())
NEVER = NOTICES | OTHERS_PLACE | frozenset("bar banner overlay message".split())
#: share of the page's text from which a marked element is no mere surroundings, and that of OTHERS
LITTLE, LITTLE_OTHERS, ALWAYS = 0.5, 0.9, math.inf
FIXED = frozenset({"html", "body", "main"})
ARTICLES = frozenset({"article", "main"})
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BREAK = object()


def _no_article(tag: str, attributes: str, inside: bool) -> bool:
    """Whether tag or role alone say so."""
    if tag in DROPPED:
        return True
    if tag == "header":
        return not inside  # the head of an article holds its title
    if tag in FIXED or not attributes:
        return False
    return any(
        name.lower() == "role" and next((v for v in values if v), "").lower() in ROLES
        for name, *values in ATTRIBUTE.findall(attributes)
    )


def _mark(tag: str, attributes: str, inside: bool) -> float:
    """Share of the page's text below which class or id bar the element; 0 without a mark."""
    if tag in FIXED:
        return 0.0
    share = 0.0
    for name, *values in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name == "role":
            if next((v for v in values if v), "").lower() in WRAPPING:
                share = max(share, LITTLE)
            continue
        words = {w.lower() for w in NAME.findall(next((v for v in values if v), ""))}
        if not words & MARKS:
            continue
        if name == "id" and (tag in HEADINGS or (inside and not (words & OTHERS and words <= OTHERS_PLACE))):
            continue
        if words & (OTHERS | NOTICES) and words <= NEVER:
            return ALWAYS
        if words & OTHERS:
            share = max(share, LITTLE_OTHERS)
            continue
        if not (words & KEPT and tag in CLOSES_P):
            share = max(share, LITTLE)
    return share or (LITTLE if tag == "form" else 0.0)


class Tree:
    """Nodes of a page in page order, with the text pieces that stand directly in them."""

    def __init__(self, page: str):
        self.tag: list[str] = ["#root"]
        self.parent: list[int] = [-1]
        self.pieces: list[tuple[int, str | object]] = []
        self.marks: dict[int, float] = {}
        self.controls: list[int] = []
        self._build(page)
        if self.marks:
            self._bar()

    def _bar(self) -> None:
        """Drop the text of marked elements that hold no article and little of the page's text."""
        n, tag, parent, marks = len(self.tag), self.tag, self.parent, self.marks
        chars, articles, foreign = [0] * n, [0] * n, [False] * n
        for node, piece in self.pieces:
            if piece is not BREAK:
                chars[node] += sum(map(len, piece.split()))
        controls = [0] * n
        for node in self.controls:
            controls[node] += 1
        for i in range(1, n):
            foreign[i] = foreign[parent[i]] or marks.get(i, 0.0) >= LITTLE_OTHERS
            articles[i] = int(tag[i] in ARTICLES)
        own = any(a and not f for a, f in zip(articles, foreign, strict=True))
        for i in range(n - 1, 0, -1):
            chars[parent[i]] += chars[i]
            articles[parent[i]] += articles[i]
            controls[parent[i]] += controls[i]
        barred = [False] * n
        for i in range(1, n):
            share = marks.get(i, 0.0)
            # readers' comments may be article elements beside the article itself
            holds = articles[i] and share < ALWAYS and not (share == LITTLE_OTHERS and own)
            little = chars[i] < share * chars[0] or (tag[i] == "form" and chars[i] < PER_CONTROL * controls[i])
            barred[i] = barred[parent[i]] or (share > 0 and not holds and little)
        self.pieces = [x for x in self.pieces if not barred[x[0]]]

    def _build(self, page: str) -> None:
        tag, parent, pieces = self.tag, self.parent, self.pieces
        stack = [0]
        depth: dict[str, int] = {}
        dropped = 0  # open elements from the outermost dropped one on
        at, end = 0, len(page)

        def close(to: int) -> None:
            nonlocal dropped
            while len(stack) > to:
                name = tag[stack.pop()]
                depth[name] -= 1
                if dropped:
                    dropped -= 1
                elif name not in INLINE:
                    pieces.append((stack[-1], BREAK))

        while at < end:
            m = TAG.search(page, at)
            if m is None or m.start() > at:
                if not dropped:
                    pieces.append((stack[-1], page[at : m.start() if m else end]))
                if m is None:
                    break
            at = m.end()
            name = m[2]
            if not name:
                continue
            name = name.lower()
            if m[1]:
                if depth.get(name, 0):
                    to = len(stack) - 1
                    while tag[stack[to]] != name:
                        to -= 1
                    close(to)
                elif not dropped and name not in INLINE:
                    pieces.append((stack[-1], BREAK))
                continue
            if name in CLOSES_P and depth.get("p", 0):
                to = len(stack) - 1
                while tag[stack[to]] != "p":
                    to -= 1
                close(to)
            elif name in SIBLINGS:
                ends, until = SIBLINGS[name]
                to = len(stack) - 1
                while to and tag[stack[to]] not in ends and tag[stack[to]] not in until:
                    to -= 1
                lowest = None
                while to and tag[stack[to]] not in until:
                    if tag[stack[to]] in ends:
                        lowest = to
                    to -= 1
                if lowest is not None:
                    close(lowest)
            attributes = m[3]
            if name in CONTROLS and not dropped:
                self.controls.append(stack[-1])
            if name in VOID:
                if not dropped and (name == "br" or name == "hr"):
                    pieces.append((stack[-1], BREAK))
                continue
            if name in RAW:
                stop = re.compile(f"</{re.escape(name)}", re.IGNORECASE).search(page, at)
                if stop is None:
                    at = end
                    break
                closing = page.find(">", stop.end())
                at = end if closing < 0 else closing + 1
                continue
            if not dropped and name not in INLINE:
                pieces.append((stack[-1], BREAK))
            inside = depth.get("article", 0) > 0 or depth.get("main", 0) > 0
            node = len(tag)
            if dropped or _no_article(name, attributes, inside):
                dropped += 1
            elif share := _mark(name, attributes, inside):
                self.marks[node] = share
            tag.append(name)
            parent.append(stack[-1])
            stack.append(node)
            depth[name] = depth.get(name, 0) + 1


def densities(tree: Tree) -> tuple[list[float], list[float]]:
    """Composite text density and density sum of every node."""
    n = len(tree.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [1] * n, [0] * n
    in_link = [False] * n
    for i in range(1, n):
        in_link[i] = in_link[tree.parent[i]] or tree.tag[i] == "a"
        link_tags[i] = int(in_link[i])
    for node, piece in tree.pieces:
        if piece is not BREAK:
            size = sum(map(len, piece.split()))
            chars[node] += size
            if in_link[node]:
                links[node] += size
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        tags[p] += tags[i]
        link_tags[p] += link_tags[i]
    whole = links[0] / max(chars[0], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n - 1, -1, -1):
        c, lc, t, lt = chars[i], links[i], tags[i], link_tags[i]
        if c:
            base = math.log(c / max(c - lc, 1) * lc + whole * c + math.e)
            ratio = c / max(lc, 1) * t / max(lt, 1)
            density[i] = c / t * math.log(max(ratio, 1.0)) / math.log(max(base, 1.0 + 1e-9)) if base > 1 else c / t * math.log(max(ratio, 1.0))
        if i:
            total[tree.parent[i]] += density[i]
    return density, total


def article_nodes(tree: Tree) -> set[int]:
    """Roots of the subtrees that make up the text."""
    density, total = densities(tree)
    n = len(tree.tag)
    best, most = 0, 0.0
    for i in range(n):
        if tree.tag[i] not in INLINE and total[i] > most:
            best, most = i, total[i]
    path, node, marked = [], best, None
    while node > 0:
        path.append(node)
        if tree.tag[node] in ARTICLES:
            marked = node
        node = tree.parent[node]
    if marked is not None:
        at = path.index(marked)
        least = min(density[i] for i in path[at:])
        rest = {i for i in range(1, n) if tree.tag[i] in ARTICLES and density[i] >= least > 0}
        return {marked} | rest | _titles(tree, path[at:])
    if not path:
        return {0}
    threshold = min(density[i] for i in path)
    on_path = set(path) | {0}
    beside = {i for i in range(1, n) if i not in on_path and tree.parent[i] in on_path and density[i] >= threshold > 0}
    return {best} | beside | _titles(tree, path)


def _titles(tree: Tree, path: list[int]) -> set[int]:
    """Headings that stand directly before a node of the path, one after the other."""
    out: set[int] = set()
    on_path = set(path)
    run: dict[int, list[int]] = {}  # by parent: the headings since its last other child
    for i in range(1, len(tree.tag)):
        if i in on_path:
            out.update(run.get(tree.parent[i], ()))
        if tree.tag[i] in HEADINGS:
            run.setdefault(tree.parent[i], []).append(i)
        elif tree.tag[i] not in INLINE:
            run.pop(tree.parent[i], None)
    return out


def extract(page: str) -> str:
    """The main text of one page."""
    return _text(Tree(page))


def _text(tree: Tree) -> str:
    roots = article_nodes(tree)
    inside = [False] * len(tree.tag)
    for i in range(len(tree.tag)):
        inside[i] = i in roots or (i > 0 and inside[tree.parent[i]])
    # ends of blocks count wherever they stand, or texts from two subtrees would touch
    parts = [" " if piece is BREAK else piece for node, piece in tree.pieces if piece is BREAK or inside[node]]
    return " ".join(entities.unescape("".join(parts)).split())


def main_text(pages: DataFrame) -> DataFrame:
    """``pages`` plus ``main_text``."""
    pages = pages.drop("main_text")
    schema = T.StructType([*pages.schema.fields, T.StructField("main_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [extract(page or "") for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string())], names=[*batch.schema.names, "main_text"]
            )

    return map_arrow(pages, run, schema)


def html_query(pages: DataFrame) -> DataFrame:
    slim = pages.select("page_id", "url", text_of("html").alias("html"))
    return main_text(slim).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars")
    )
