"""Main text of web pages by composite text density.

Each page's tags become a tree.  Elements that never hold the article (menus,
scripts, hidden ones and such) are cut out first, and so are forms and elements
whose class, id or role says advert, comment, sidebar and so on, but not those
that wrap the article: see ``settle``.  Every remaining node gets its
link-adjusted characters per tag; the node with the highest sum over its
children is the core, and the least density on its path to the body is the
threshold that other parts must reach, each with its own best subtree.  If the
core lies in an ``article`` or ``main`` element, or holds one, that element is
the article.

Character references are decoded; white space within a block becomes one space;
blocks are trimmed and joined by one space in page order.  ``br`` is white
space, inline tags are nothing.  A paragraph, list item or table cell that is
not closed ends where the next one begins; pages may end anywhere.

Edge cases: null or empty pages, and pages without text, give an empty text;
repeated pages each get a row; other columns are kept as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StringType, StructType

from .arrowmap import add_struct

KIND = StructType().add("text", StringType()).add("n_chars", LongType())

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr".split())
#: Elements that hold no article text.
CUT = frozenset(
    "nav aside footer script style noscript template button select textarea iframe object svg math canvas audio "
    "video menu dialog head title fieldset".split())
#: Starting one of these ends an open one of those, up to the named ancestors.
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
         "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
         "option": ({"option"}, {"select"})}
#: Parts of lists, tables and running text; the density of one of them speaks for its container.
PARTS = frozenset("tr tbody thead tfoot td th caption li dt dd ul ol dl p blockquote pre figure center h1 h2 h3 h4 h5 h6".split())
#: Words of class, id and role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent "
    "gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar side aside "
    "rail widget widgets menu menubar nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar topbar "
    "masthead header footer copyright legal share sharing social related recommended recommendations comment comments "
    "commentlist disqus reply replies respond discussion search skip tags complementary contentinfo dialog "
    "alertdialog tooltip".split())
_KEEP = frozenset("html body article main".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "cut", "marked", "link", "parts", "parent", "chars", "link_chars", "tags", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, cut: bool, link: bool = False, marked: bool = False):
        self.tag, self.parent, self.cut, self.marked = tag, parent, cut, marked
        self.link = link
        self.parts: list[Node | str] = []

    def nodes(self):
        return [p for p in self.parts if isinstance(p, Node)]


def _marked(attrs) -> bool:
    return any(value and name in ("class", "id", "role") and any(w.lower() in MARKS for w in _WORD.findall(value))
               for name, value in attrs)


def _hidden(attrs) -> bool:
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True
    return False


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#", None, False)
        self.stack = [self.root]         # open elements
        self.open: Counter[str] = Counter()

    def close(self):
        super().close()
        self.stack = self.stack[:1]

    def leave(self, at: int) -> None:
        """Closes the open elements from place ``at`` on."""
        for node in self.stack[at:]:
            self.open[node.tag] -= 1
        del self.stack[at:]

    def close_to(self, tags, stop) -> None:
        if not any(self.open[t] for t in tags):
            return
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[at].tag
            if tag in tags:
                self.leave(at)
                return
            if tag in stop:
                return

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS:
            self.close_to(*_ENDS[tag])
        if tag not in INLINE and tag not in VOID:   # a block ends an open paragraph
            self.close_to({"p"}, {"table", "td", "th", "button", "object", "body"})
        if tag in ("html", "body") and self.open[tag]:
            return
        inside = self.open["article"] or self.open["main"]
        cut = tag in CUT or tag == "header" and not inside or tag not in _KEEP and _hidden(attrs)
        node = Node(tag, self.stack[-1], cut, tag == "a", tag == "form" or _marked(attrs))
        self.stack[-1].parts.append(node)
        if tag not in VOID:
            self.stack.append(node)
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag == "br":
            self.stack[-1].parts.append(Node("br", self.stack[-1], False))
        elif self.open[tag] and tag not in ("html", "body"):
            at = next(i for i in range(len(self.stack) - 1, 0, -1) if self.stack[i].tag == tag)
            self.leave(at)

    def handle_data(self, data):
        self.stack[-1].parts.append(data)


def parse(html: str) -> Node:
    """The root of a page's tree."""
    tree = _Tree()
    tree.feed(html)
    tree.close()
    settle(tree.root)
    return tree.root


def settle(root: Node) -> None:
    """Cuts out marked elements, but not those whose density is to decide.

    These hold the page's articles, if none stands outside of marked elements,
    or most of its text that is not in links, if the article is not outside; if
    nothing would be left, none is cut."""
    order, at = [(root, False)], 0      # node, whether it lies in a marked element
    while at < len(order):
        node, inside = order[at]
        inside = inside or node.marked and node.tag not in _KEEP
        order.extend((n, inside) for n in node.nodes() if not n.cut)
        at += 1
    plain: dict[int, int] = {}
    holds: dict[int, bool] = {}
    outside = False     # an article outside of marked elements
    for node, inside in reversed(order):
        below = [n for n in node.nodes() if not n.cut]
        own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        plain[id(node)] = 0 if node.link else own + sum(plain[id(n)] for n in below)
        article = node.tag in ("article", "main") and not node.marked and plain[id(node)] > 0
        holds[id(node)] = article or any(holds[id(n)] for n in below)
        outside = outside or article and not inside
    total = plain[id(root)]
    marked = [(n, inside) for n, inside in order if n.marked and n.tag not in _KEEP]
    left = total - sum(plain[id(n)] for n, inside in marked if not inside)
    for node, _ in marked:
        most = 2 * plain[id(node)] > total
        node.cut = left > 0 and not (holds[id(node)] and (most or not outside) or most and not outside)


def _order(root: Node) -> list[Node]:
    """Nodes that are not cut out, parents first."""
    out, at = [root], 0
    while at < len(out):
        out.extend(n for n in out[at].nodes() if not n.cut)
        at += 1
    return out


def measure(root: Node) -> list[Node]:
    """Sets characters, tags, density and density sum of each node that is not cut out."""
    order = _order(root)
    for node in reversed(order):
        below = [n for n in node.nodes() if not n.cut]
        own = sum(len("".join(p.split())) for p in node.parts if isinstance(p, str))
        node.chars = own + sum(n.chars for n in below)
        node.tags = sum(n.tags + 1 for n in below)
        node.link_chars = node.chars if node.link else sum(n.link_chars for n in below)
        node.link_tags = sum(n.link_tags + n.link for n in below)
    share = root.link_chars / max(1, root.chars)
    for node in reversed(order):
        c, t = node.chars, max(1, node.tags)
        plain = max(1, c - node.link_chars)
        base = math.log(c / plain * node.link_chars + share * c + math.e)
        ratio = c / max(1, node.link_chars) * t / max(1, node.link_tags)
        node.density = c / t * math.log(max(ratio, 1.0)) / math.log(base) if c and base > 1 + 1e-9 else \
            c / t * math.log(max(ratio, 1.0)) if c else 0.0
        node.total = sum(n.density for n in node.nodes() if not n.cut)
    return order


def _best(node: Node) -> Node:
    return max(_order(node), key=lambda n: n.total)


def _whole(node: Node) -> Node:
    """The list, table or other container of which a node is but a part."""
    while node.tag in PARTS and node.parent is not None and node.parent.tag not in ("body", "#"):
        node = node.parent
    return node


def content(root: Node) -> list[Node]:
    """The nodes that hold the article, in no order; none lies in another."""
    order = measure(root)
    body = next((n for n in order if n.tag == "body"), root)
    if not body.chars:
        return []
    core = _best(body)

    def up(node: Node | None) -> list[Node]:
        out = []
        while node is not None and node is not body.parent:
            out.append(node)
            node = node.parent
        return out

    path = up(core)
    for tag in ("article", "main"):
        around = [n for n in path if n.tag == tag]
        if around:
            return around[-1:]
    held = [n for tag in ("article", "main") for n in _order(core) if n.tag == tag and n.chars]
    if held:
        top = held[0].tag
        return [n for n in held if n.tag == top and not any(a.tag == top for a in up(n.parent))]
    if core.total == 0:
        return [body]
    least = min(n.density for n in path)
    chosen, todo = [], [body]
    while todo:
        node = todo.pop()
        if node.density >= least and node.chars:
            found = _best(node)
            chosen.append(_whole(found if found.total else node))
            todo.extend(n for n in node.nodes() if not n.cut)
    ids = {id(n) for n in chosen}
    unique = {id(n): n for n in chosen}.values()
    return [n for n in unique if not any(id(a) in ids for a in up(n.parent))]


def text_of(root: Node) -> str:
    """The article's text."""
    wanted = {id(n) for n in content(root)}
    out: list[str] = []
    todo: list[tuple[Node | str, bool]] = [(root, False)]
    while todo:
        part, inside = todo.pop()
        if isinstance(part, str):
            if inside:
                out.append(part)
            continue
        if part.cut:
            out.append(" " if part.tag not in INLINE else "")
            continue
        inside = inside or id(part) in wanted
        edge = [] if part.tag in INLINE else [(" ", inside)]
        todo.extend(reversed([*edge, *((p, inside) for p in part.parts), *edge]))
    return " ".join("".join(out).split())


def main_text(html: str | None) -> str:
    return text_of(parse(html)) if html else ""


def extract(pages: DataFrame, *, html_col: str = "html", keep: list[str] | None = None,
            name: str = "main") -> DataFrame:
    """``keep`` columns (all by default) and a struct: text, n_chars."""
    def compute(batches):
        for batch in batches:
            found = [main_text(h) for h in batch.column(0).to_pylist()]
            yield batch, pa.StructArray.from_arrays(
                [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=KIND.names)

    return add_struct(pages, [html_col], pages.columns if keep is None else keep, name, KIND, compute)
