"""Main text of web pages by composite text density.

A page becomes a DOM (tags left open are closed as browsers do).  Parts that say themselves what they are - menus, page
headers, footers, sidebars, notices, adverts, forms, reader comments - are taken out by element, role and class name; a
class name alone takes nothing out, the part's links and density have to agree.  Every node that is left gets its
composite text density: characters per tag, adjusted by the share of link text of the node against that of the body.  The container whose children's densities have the greatest sum is the core of the article.
The least density on the path from it to the body is the threshold: every other subtree outside the core that reaches it
contributes its own greatest-sum container, so an article in several pieces stays whole.  A core within ``<article>`` or
``<main>`` stands for that element.

Text: character references decoded, ``[\\x20\\x09-\\x0D]+`` inside a block to one space, trimmed; blocks in page order joined by
two line feeds; a line break is white space.  Nothing within the chosen subtrees is dropped or capped.

Work per page is linear in its size and pages are independent, so the job is one scan.  Defined cases: null or empty
html, or a page without text, gives an empty string; repeated rows give equal results; an empty table an empty result."""

from __future__ import annotations

import html as entities
import math
import re
from bisect import bisect_right
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Markup that is skipped whole, or the beginning of a tag.  Every quantifier that could retry is possessive.
OPENING = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)|</?+[a-zA-Z]""", re.S)
#: A tag up to its ``>``; a quoted value (after ``=`` only) may hold any character.  PLAIN_TAG knows no quotes.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/><]*+)((?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)""")
PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/><]*+)([^<>]*+)")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")
BLANK = re.compile(r"[\x20\x09-\x0D]+")
NAME = re.compile(r"[a-z]+")
WHOLE_NAME = re.compile(r"[^\x20\x09-\x0D]+")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp noembed noframes iframe".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
             "img br".split())
#: An open element of the left is closed by a start tag of the right.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "thead", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
             "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option", "optgroup"}, "head": {"body"}}
CLOSERS = set().union(*CLOSED_BY.values())
BARRIERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}, "head": set()}
CONTAINERS = set("body div article main section td table tbody center blockquote figure details fieldset form dl ul ol span font".split())
HEADINGS = {"h1", "h2", "h3"}
ALL_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}

NEVER = set("script style noscript template head title select button input textarea option iframe object svg canvas audio video dialog datalist".split())
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar toolbar form".split())
#: Words in a class or id that name a part as no article text.
PARTS = set("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar sidebars sidenav nav navbar navigation menu
    menus breadcrumb breadcrumbs masthead footer footers cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup
    login share sharing social related recommended recommendations trending pagination pager toolbar widget widgets skip topbar""".split())
#: Those of them that name articles' own parts too where they stand within a longer name, as in ``elementor-widget``.
GENERIC = set("widget widgets notice notices share sharing social related promo promotion overlay modal toolbar login skip menu".split())
COMMENTS = set("comment comments commentlist reply replies respond disqus responses".split())
PAGE_HEADS = {"header", "head"}
#: Elements that wrap parts of a page; a class name on any other (a paragraph, a quotation) says nothing about its text.
WRAPPERS = set("div section ul ol dl table tr td form header center fieldset".split())


class Node:
    __slots__ = ("tag", "names", "whole", "attrs", "parent", "children", "chars", "tags", "link_chars", "link_tags", "density", "total", "out", "holds")

    def __init__(self, tag: str, attrs: dict, parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []
        said = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower() if attrs else ""
        self.names, self.whole = set(NAME.findall(said)), set(WHOLE_NAME.findall(said))
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0
        self.out = self.holds = False


class Open:
    """The open elements, innermost last, with the places of every tag and of the nearest blocks: no lookup walks the stack."""

    def __init__(self, root: Node):
        self.nodes, self.places = [root], defaultdict(list)
        self.block, self.wall = [0], [0]   # nearest element at or below that isn't inline; that is neither inline nor a paragraph

    def push(self, node: Node) -> None:
        i = len(self.nodes)
        self.nodes.append(node)
        self.places[node.tag].append(i)
        inline = node.tag in INLINE
        self.block.append(self.block[-1] if inline else i)
        self.wall.append(self.wall[-1] if inline or node.tag == "p" else i)

    def cut(self, i: int) -> None:
        for node in reversed(self.nodes[i:]):
            self.places[node.tag].pop()
        del self.nodes[i:], self.block[i:], self.wall[i:]

    def close(self, tag: str) -> None:
        places = self.places.get(tag)
        if places and tag not in ("br", "html", "body") and not (tag in INLINE and self.wall[-1] > places[-1]):   # an inline end tag doesn't close a block
            self.cut(places[-1])

    def imply_ends(self, tag: str) -> None:
        if tag not in INLINE:
            i = self.block[-1]
            if i > 0 and (self.nodes[i].tag == "p" or self.nodes[i].tag in ALL_HEADINGS and (tag == "p" or tag in ALL_HEADINGS)):
                self.cut(i)
        if tag in CLOSERS:
            ends = [o for o, closers in CLOSED_BY.items() if tag in closers]
            wall = max((p[-1] for o in ends for t in BARRIERS[o] if (p := self.places.get(t))), default=0)
            above = [p[k] for o in ends if (p := self.places.get(o)) and (k := bisect_right(p, wall)) < len(p)]
            if above:
                self.cut(min(above))


def parse(page: str) -> Node:
    """The DOM; children are nodes and decoded strings.  A ``<`` that opens no tag is text.

    A tag that another ``<`` interrupts outside of quotes is none; the stretch it was tried on is read again without
    quotes, so no character is tried more than twice."""
    root = Node("html", {}, None)
    open_, pos, n, plain_until = Open(root), 0, len(page), 0
    text = 0   # where text not yet added begins

    def add(end):
        if end > text:
            raw = page[text:end]
            open_.nodes[-1].children.append(entities.unescape(raw) if "&" in raw else raw)

    while found := OPENING.search(page, pos):
        s, pos = found.start(), found.end()
        if page[s + 1] in "!?":
            add(s)
            text = pos
            continue
        m = None
        if s >= plain_until:
            m = TAG.match(page, s)
            if m.end() < n and page[m.end()] != ">":
                plain_until, m = m.end(), None
        if m is None:
            m = PLAIN_TAG.match(page, s)
            if m.end() < n and page[m.end()] != ">":
                continue
        add(s)
        pos = text = min(m.end() + 1, n)
        tag = m[2].lower()
        if m[1]:
            open_.close(tag)
            continue
        if tag == "html":
            continue
        open_.imply_ends(tag)
        attrs = {a.lower(): d or s_ or u or "" for a, d, s_, u in ATTRIBUTE.findall(m[3])} if m[3].strip(" /\n\t\r\f") else {}
        node = Node(tag, attrs, open_.nodes[-1])
        node.parent.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>?", re.I).search(page, pos)
            pos = text = end.end() if end else n
        elif tag not in VOID and not m[3].endswith("/") or tag in INLINE - VOID:
            open_.push(node)
    add(n)
    return root


def _is_out(node: Node, inside: bool) -> bool:
    """Whether an element is no article text by its kind.  ``inside``: it lies in an article."""
    tag = node.tag
    if tag in NEVER or tag in ("nav", "footer", "aside", "menu"):
        return True
    if tag in ("html", "body", "main", "article"):
        return bool(tag == "article" and node.names & COMMENTS)
    return tag == "header" and not inside or bool(node.names & COMMENTS) and not node.holds


def _is_suspect(node: Node, inside: bool) -> bool:
    """Whether an element names itself as another part of the page, so that its text has to speak for it."""
    tag, attrs = node.tag, node.attrs
    if node.holds or tag in ("html", "body", "main", "article"):
        return False
    if tag == "form":
        return True
    if attrs and ("hidden" in attrs or attrs.get("aria-hidden", "") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower() or attrs.get("role", "").lower() in ROLES):
        return True
    return tag in WRAPPERS and (bool(node.names & PARTS) or bool(node.names & PAGE_HEADS) and not inside and tag in ("div", "section"))


def _inside(root: Node, left_out: bool = True) -> list[Node]:
    """The nodes of a subtree in page order, parents first; without those taken out, unless asked for."""
    nodes, todo = [], [root]
    while todo:
        x = todo.pop()
        nodes.append(x)
        todo += [c for c in reversed(x.children) if isinstance(c, Node) and (left_out or not c.out)]
    return nodes


def _mark(root: Node) -> None:
    """Take out what is no article text: elements of the kinds above, comments, and named parts whose text says so too.

    A named part stays if less than half of its text is links and it is as heavy (greatest density sum) as all that
    carries no such name in its article, or in the page outside of articles.  One that only bears a generic word in a
    longer name stays as well if it has a block of half the mean density of the others' core."""
    for x in reversed(_inside(root)[1:]):
        x.parent.holds = x.parent.holds or x.holds or x.tag in ("article", "main") and not x.names & COMMENTS
    suspects, scopes = [], {id(root): root}
    todo = [(root, root)]
    while todo:
        node, scope = todo.pop()
        for c in node.children:
            if not isinstance(c, Node):
                continue
            here = c if scope is root and c.tag in ("article", "main") else scope
            if _is_out(c, here is not root):
                c.out = True
                continue
            scopes[id(here)] = here
            if _is_suspect(c, here is not root):
                suspects.append((c, here))
            todo.append((c, here))
    if not suspects:
        return
    nodes = _measure(root)
    share = root.link_chars / root.chars if root.chars else 0.0
    _densities(nodes, share)
    heaviest, densest = {}, {}
    for x in reversed(nodes):
        inner = [c for c in x.children if isinstance(c, Node) and not c.out]
        heaviest[id(x)] = max([x.density, x.total, *(heaviest[id(c)] for c in inner)])
        densest[id(x)] = max([x.density, *(densest[id(c)] for c in inner)])
    own = {id(x): (x.link_chars * 2 <= x.chars, heaviest[id(x)], densest[id(x)]) for x, _ in suspects}
    for x, _ in suspects:
        x.out = True
    _densities(_measure(root), share)
    rest = {}
    for k, scope in scopes.items():
        core = _best(scope)
        blocks = sum(1 for c in core.children if isinstance(c, Node) and not c.out and c.chars)
        rest[k] = max(core.total, core.density), core.total / max(blocks, 1)
    for x, scope in suspects:
        prose, heavy, dense = own[id(x)]
        weight, mean = rest[id(scope)]
        x.out = not (prose and (heavy >= weight or x.names & PARTS and x.names & PARTS <= GENERIC and not x.whole & PARTS and dense * 2 >= mean))


def _measure(root: Node) -> list[Node]:
    """Characters and tags of every node left, which are returned in page order."""
    nodes, linked = _inside(root, left_out=False), set()
    for x in nodes:
        x.tags = x.link_tags = 0
        x.density = x.total = 0.0
        if x.tag == "a" or x is not root and id(x.parent) in linked:
            linked.add(id(x))
        x.chars = sum(len(BLANK.sub("", c)) for c in x.children if not isinstance(c, Node))
        x.link_chars = x.chars if id(x) in linked else 0
    for x in reversed(nodes[1:]):
        up = x.parent
        up.chars += x.chars
        up.tags += x.tags + 1
        up.link_chars += x.link_chars
        up.link_tags += x.link_tags + (x.tag == "a")
    return nodes


def _densities(nodes: list[Node], body_share: float) -> None:
    """Composite text density: C/T * log_b((C/LC) * (T/LT)), b = ln(C/nLC * LC + LC_body/C_body * C + e)."""
    for node in nodes:
        c, t = node.chars, max(node.tags, 1)
        if c:
            lc, lt = max(node.link_chars, 1), max(node.link_tags, 1)
            base = math.log(c / max(c - node.link_chars, 1) * node.link_chars + body_share * c + math.e)
            value = max(c / lc * t / lt, 1.0)
            node.density = c / t * (math.log(value) / math.log(base) if base > 1.0000001 else math.log(value))
    for x in nodes[1:]:
        x.parent.total += x.density


def _best(node: Node) -> Node:
    """The container of greatest density sum in a subtree; of equals the outer one."""
    best, todo = node, [node]
    while todo:
        x = todo.pop()
        if x.total > best.total and x.tag in CONTAINERS:
            best = x
        todo += [c for c in x.children if isinstance(c, Node) and not c.out]
    return best


def _chosen(body: Node) -> list[Node]:
    core = _best(body)
    up = core
    while up is not None and not (up.tag in ("article", "main") and not up.names & COMMENTS):
        up = up.parent
    if up is not None:
        return [up]
    least, path, x = core.density, set(), core
    while x is not None and x is not body:
        least = min(least, x.density)
        path.add(id(x))
        x = x.parent
    path.add(id(body))
    if core is body:
        return [body]
    picked: list[Node] = []

    walks: list[tuple] = [(iter(body.children), [])]
    while walks:
        rest, heads = walks[-1]
        for c in rest:
            if not isinstance(c, Node) or c.out:
                continue
            if c is core:
                picked.extend([*heads, c])
            elif id(c) in path:
                picked.extend(heads)
                heads.clear()
                walks.append((iter(c.children), []))
                break
            elif c.tag in HEADINGS:
                heads.append(c)
                continue
            elif c.density >= least and c.chars and c.link_chars * 2 < c.chars:
                picked.extend([*heads, _best(c)])
            else:
                continue
            heads.clear()
        else:
            walks.pop()
    return picked


def _blocks(node: Node, out: list[str], line: list[str]) -> None:
    todo: list = list(reversed(node.children))
    while todo:
        c = todo.pop()
        if c is None:
            _flush(out, line)
        elif not isinstance(c, Node):
            line.append(c)
        elif c.out:
            continue
        elif c.tag == "br":
            line.append(" ")
        elif c.tag in INLINE:
            todo += reversed(c.children)
        else:
            _flush(out, line)
            todo += [None, *reversed(c.children)]


def _flush(out: list[str], line: list[str]) -> None:
    text = BLANK.sub(" ", "".join(line)).strip(" ")
    if text:
        out.append(text)
    line.clear()


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    bodies = [c for c in root.children if isinstance(c, Node) and c.tag == "body"]
    body = bodies[0] if len(bodies) == 1 and not any(isinstance(c, Node) and c.tag not in ("head", "body") and c.children for c in root.children) else root
    _mark(body)
    _densities(_measure(body), body.link_chars / body.chars if body.chars else 0.0)
    out: list[str] = []
    line: list[str] = []
    for node in _chosen(body):
        _blocks(node, out, line)
        _flush(out, line)
    return "\n\n".join(out)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every row."""
    def run(batches):
        for b in batches:
            texts = [main_text(t.as_py()) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, type=pa.string()), pa.array(list(map(len, texts)), type=pa.int64())], names=["page_id", "url", "text", "n_chars"])

    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return src.mapInArrow(run, "page_id long, url string, text string, n_chars long")
