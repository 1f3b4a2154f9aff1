"""Main text of web pages by tree scoring.

A page becomes a tree. Its paragraphs give points for length and commas to
their ancestors, less to remoter ones; link density discounts what an element
has gathered. The best container is kept, with those of its siblings that read
like it; parts of the page that are no article (menus, adverts, comments and so
on) are taken out before. A part that is called so but holds most of the points
of the page may be a wrapper: its points are discounted instead, and it is taken
out once the best container is found elsewhere.

Results in special cases: a null or empty page, or one without text, gives the
empty string. Of equally good containers the first in the page is taken. Markup
left open, closed twice or nested to any depth is read as browsers do in the
common cases. Pages are taken one by one; repeated rows and other columns
change nothing, and an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "head title script style noscript template nav header footer aside form button select textarea option datalist "
    "iframe object embed svg canvas audio video dialog menu map".split()
)
BLOCKS = frozenset(
    "html body main article section div p pre blockquote h1 h2 h3 h4 h5 h6 hgroup ul ol li dl dt dd table caption "
    "thead tbody tfoot tr td th figure figcaption address details summary fieldset center hr".split()
)
PARAGRAPHS = frozenset("p pre blockquote td li dd".split())
# Elements that a new one of the second set closes, looking outwards no farther than the third.
CLOSED_BY = (
    ({"p"}, BLOCKS - {"html", "body", "li", "dt", "dd", "td", "th", "tr", "thead", "tbody", "tfoot", "caption"} | {"nav", "header", "footer", "aside", "form", "menu", "dialog"}, {"table", "td", "th", "button", "object"}),
    ({"li", "p"}, {"li"}, {"ul", "ol", "menu", "table"}),
    ({"dt", "dd", "p"}, {"dt", "dd"}, {"dl", "table"}),
    ({"td", "th", "p"}, {"td", "th"}, {"tr", "table"}),
    ({"tr", "td", "th", "p"}, {"tr"}, {"table", "thead", "tbody", "tfoot"}),
    ({"thead", "tbody", "tfoot", "tr", "td", "th", "p"}, {"thead", "tbody", "tfoot"}, {"table"}),
    ({"option"}, {"option"}, {"select", "datalist"}),
)
# Words that mark a part as no article, where a class, id or role is one of them,
OTHER_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login sidebar "
    "sidebars related recommended recommendations share sharing social breadcrumb breadcrumbs menu menus nav navbar "
    "navigation footer header masthead comment comments disqus respond replies reply pagination pager widget widgets "
    "toolbar contentinfo complementary search skip".split()
)
# or made of them and of these.
AROUND_PARTS = frozenset(
    "site page post posts entry article articles story stories main primary secondary global local sub top bottom left right "
    "upper lower first last fixed sticky floating float mobile desktop responsive inner outer area list box block container "
    "wrapper wrap section group holder row column col bar slot slots unit units zone panel button buttons link links icon icons "
    "item items form field title heading label text count reader readers user users author legal info copyright policy message "
    "tool tools media network networks google facebook twitter email mail wp js c o m by for the".split()
)
WHOLE = frozenset(("article", "main"))
# The share of its points that a part called no article keeps where it holds most of the page.
DOUBTFUL = 0.1
MIN_PARAGRAPH = 25
SIBLING_SHARE = 0.2
ARTICLE_POINTS = 25.0


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "points", "size", "linked")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []
        self.points, self.size, self.linked = 0.0, 0, 0


class TreeBuilder(HTMLParser):
    """Builds the tree, leaving out parts that never are article text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def _up_to(self, tags: set[str], fence: set[str]) -> None:
        """Close the outermost open element of `tags` that lies inside the fence."""
        node, found = self.at, None
        while node.parent is not None and node.tag not in fence:
            if node.tag in tags:
                found = node
            node = node.parent
        if found is not None:
            self.at = found.parent

    def handle_starttag(self, tag, attrs):
        for closed, by, fence in CLOSED_BY:
            if tag in by:
                self._up_to(closed, fence)
        if tag == "body" or self.at.tag == "head" and tag not in ("title", "meta", "link", "script", "style", "base", "noscript", "template"):
            self._up_to({"head"}, set())
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            if node.tag in ("table", "td", "th", "article", "main") and tag not in BLOCKS | DROPPED:
                return  # a stray end of an inline element doesn't reach out of these
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def _in_order(root: Node) -> list[Node]:
    """All elements, each before its children."""
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        found.append(node)
        waiting.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return found


def _is_called_other(node: Node) -> bool:
    """Whether a class, id or role says that an element is no article."""
    named = " ".join(node.attrs.get(k, "") for k in ("class", "id", "role"))
    for name in re.sub(r"([a-z0-9])([A-Z])", r"\1-\2", named).lower().split():
        words = set(re.findall(r"[^\W\d_]+", name))
        if words & OTHER_PARTS and words <= OTHER_PARTS | AROUND_PARTS:
            return True
    return False


def _is_never_shown(node: Node) -> bool:
    if node.tag in DROPPED:
        return True
    if node.tag in ("#root", "html", "body"):
        return False
    return "hidden" in node.attrs or node.attrs.get("aria-hidden") == "true" or bool(re.search(r"display\s*:\s*none", node.attrs.get("style", "")))


def _without(root: Node, gone: Callable[[Node], bool]) -> None:
    for node in _in_order(root):
        node.children = [c for c in node.children if isinstance(c, str) or not gone(c)]


def _worth(node: Node) -> tuple[float, Node]:
    """The points that the text of an element itself gives, and the first element that gets them."""
    holds_blocks = any(isinstance(c, Node) and c.tag in BLOCKS for c in node.children)
    is_paragraph = node.tag in PARAGRAPHS and not holds_blocks
    above = node.parent if is_paragraph else node
    if node.tag not in BLOCKS:
        return 0.0, above
    own = " ".join(_text([c for c in node.children if isinstance(c, str) or c.tag not in BLOCKS]).split())
    if len(own) < MIN_PARAGRAPH:
        return 0.0, above
    return 1.0 + own.count(",") + own.count("，") + min(len(own) / 100.0, 3.0), above


def prune(root: Node) -> set[int]:
    """Take out the parts that are no article; returns the ids of those left in doubt."""
    _without(root, _is_never_shown)
    nodes = _in_order(root)
    called = {id(n) for n in nodes if n.tag not in ("#root", "html", "body") and _is_called_other(n)}
    if not called:
        return set()
    for node in nodes:  # elements around an article are no side part, whatever they are called
        if node.tag in WHOLE and id(node) not in called:
            above = node.parent
            while above is not None:
                called.discard(id(above))
                above = above.parent
    held = {id(n): _worth(n)[0] for n in nodes}
    for node in reversed(nodes):
        if node.parent is not None:
            held[id(node.parent)] += held[id(node)]
    doubtful = {i for i in called if 2 * held[i] > held[id(root)]}
    _without(root, lambda n: id(n) in called and id(n) not in doubtful)
    return doubtful


def score(root: Node, doubtful: set[int] = frozenset()) -> list[Node]:
    """Give every element its points; returns the elements in page order."""
    nodes = _in_order(root)
    discounted: set[int] = set()
    for node in reversed(nodes):
        own = sum(len(" ".join(c.split())) for c in node.children if isinstance(c, str))
        below = [c for c in node.children if isinstance(c, Node)]
        node.size = own + sum(c.size for c in below)
        node.linked = node.size if node.tag == "a" else sum(c.linked for c in below)
    for node in nodes:
        if id(node) in doubtful or node.parent is not None and id(node.parent) in discounted:
            discounted.add(id(node))
        points, above = _worth(node)
        if not points:
            continue
        points, level = points * (DOUBTFUL if id(node) in discounted else 1.0), 0
        while above is not None and level < 5:
            above.points += points / (1, 2, 6, 9, 12)[level]
            above, level = above.parent, level + 1
    for node in nodes:
        if node.tag in WHOLE and node.size:
            node.points += ARTICLE_POINTS * (DOUBTFUL if id(node) in discounted else 1.0)
        node.points *= 1.0 - (node.linked / node.size if node.size else 0.0)
    return nodes


def _best(nodes: list[Node]) -> Node:
    best = max(nodes, key=lambda n: n.points)
    if best.points <= 0:  # too little text to score
        return nodes[0]
    above = best
    while above is not None:  # a section of an article stands for the whole of it
        if above.tag in WHOLE or above.attrs.get("role") == "main" or above.attrs.get("itemprop") == "articleBody":
            best = above
        above = above.parent
    return best


def _reads_alike(node: Node, best: Node) -> bool:
    density = node.linked / node.size if node.size else 1.0
    if node.points >= max(3.0, SIBLING_SHARE * best.points):
        return True
    return node.tag in BLOCKS and node.size > 0 and density < 0.25


def _text(parts: list[Node | str]) -> str:
    """The text of parts in page order, a line break at every edge of a block."""
    out: list[str] = []
    waiting: list[Node | str] = list(reversed(parts))
    while waiting:
        part = waiting.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.tag == "br":
            out.append("\n")
        elif part.tag in BLOCKS:
            out.append("\n")
            waiting.append("\n")
            waiting.extend(reversed(part.children))
        else:
            waiting.extend(reversed(part.children))
    return "".join(out)


def _kept(best: Node) -> list[Node | str]:
    """The best container with its siblings that read like it, and the text between them."""
    if best.parent is None or best.tag == "body":
        return [best]
    kept: list[Node | str] = []
    line: list[Node | str] = []  # text and inline elements in a row

    def end_line() -> None:
        size = sum(len(" ".join(c.split())) if isinstance(c, str) else c.size for c in line)
        linked = sum(c.linked for c in line if isinstance(c, Node))
        # Rows of links are menus; spaces keep words of kept blocks apart.
        if 2 * linked < size or not size:
            kept.extend(line)
        line.clear()

    for child in best.parent.children:
        if isinstance(child, str) or child is not best and child.tag not in BLOCKS and child.points < max(3.0, SIBLING_SHARE * best.points):
            line.append(child)
            continue
        end_line()
        if child is best or _reads_alike(child, best):
            kept.append(child)
    end_line()
    return kept


def extract(html: str | None) -> str:
    """The main text of one page."""
    if not html:
        return ""
    root = parse(html)
    doubtful = prune(root)
    best = _best(score(root, doubtful))
    if doubtful:
        above = best
        while above is not None:
            doubtful.discard(id(above))
            above = above.parent
        _without(root, lambda n: id(n) in doubtful)
    return " ".join(_text(_kept(best)).split())


@F.pandas_udf(T.StringType())
def main_text(pages: pd.Series) -> pd.Series:
    return pages.map(extract, na_action=None)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, and its main text."""
    return pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), main_text(F.col(html_col)).alias("text")
    )
