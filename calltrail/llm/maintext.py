"""Main text of web pages by tree scoring.

A page becomes a tree of its block elements. Subtrees that are never of an article (menus, footers, forms, adverts,
comments) go by element, role or name. Paragraphs pass points, one and one for each comma and each hundred characters,
discounted by link density, to the containers above them, half at each step up. The container with the most points is
kept, or the article or main element around it, with those siblings that look like text of the same article; lists of
links inside go. A page is a row of its own from scan to result; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from calltrail.llm.common import in_slices

# Elements of HTML by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes noscript xmp".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset("table caption colgroup thead tbody tfoot tr td th".split())
BLOCKS = HEADINGS | CELLS | frozenset(
    "address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form header hgroup hr"
    " legend li main menu nav ol optgroup option p pre search section summary ul".split()
)
CONTAINERS = frozenset("article main section div center details td #page".split())
LISTS = frozenset("ul ol dl dir table div section".split())
#: What a start tag ends, and the elements that it does not look beyond.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}), "tbody": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}), "tfoot": ({"thead", "tbody", "tfoot", "tr", "caption"}, {"table"}),
}
# Elements, roles and words in class or id of what is no article.
DROPPED = frozenset("nav footer aside dialog menu button select option datalist svg math object canvas audio video template search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
NAMES = frozenset(
    "ad ads adbox advert adverts advertisement advertising sponsor sponsored promo promotion nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc sidebar"
    " widget footer cookie cookies consent gdpr respond share sharing social related recommended newsletter subscribe signup login popup modal".split()
)
#: These go too, unless another word says that they are of the article.
WEAK_NAMES = frozenset("header masthead topbar toolbar banner banners notice notices notification alert overlay hidden".split())
ARTICLE_NAMES = frozenset("article entry post story content body".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus".split())

#: Elements within one another that count; what lies deeper belongs to the last of them.
DEEPEST = 512
_TAG = re.compile(
    r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|(/?)([A-Za-z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*')|[^>])*+)>|[!?/][^>]*>|[!?/A-Za-z][^>]*\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAMED = re.compile(r"class|id|role|hidden|style", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_PREFIXED = re.compile(r"(?:no|has|with|without|is|js)[-_]")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_COMMAS = re.compile("[,，、،]")
_SENTENCE = re.compile(r"[.!?。！？…][\"'”’»)]*$")


class Node:
    __slots__ = ("tag", "parent", "parts", "sure", "doubtful", "gone", "size", "linked", "links", "score", "leaf")

    def __init__(self, tag: str, parent: Node | None, sure: bool = False, doubtful: bool = False):
        self.tag, self.parent, self.sure, self.doubtful, self.gone = tag, parent, sure, doubtful, False
        self.parts: list[Node | tuple[str, bool]] = []  # text, and whether it is in a link
        self.size = self.linked = self.links = 0
        self.score, self.leaf = 0.0, True

    def density(self) -> float:
        return self.linked / self.size if self.size else 0.0


def attributes(raw: str) -> dict[str, str]:
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    return found


def judged(tag: str, raw: str, in_article: bool) -> tuple[bool, bool, str]:
    """(goes for sure, goes unless the article is within, element): by element, role, style and names."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return True, False, tag
    if tag == "form":
        return False, True, tag
    if not raw or not _NAMED.search(raw):
        return False, False, tag
    a = attributes(raw)
    role = a.get("role", "").lower()
    if role in ROLES or "hidden" in a or a.get("aria-hidden", "").lower() == "true" or _UNSEEN.search(a.get("style", "").lower()):
        return True, False, tag
    names = [n for n in f"{a.get('class', '')} {a.get('id', '')}".split() if not _PREFIXED.match(n.lower())]
    words = {w.lower() for n in names for w in _WORD.findall(n)}
    if words & COMMENT_NAMES and not (tag == "article" and words & (ARTICLE_NAMES - {"body", "content"})):
        return True, False, tag
    doubtful = bool(words & NAMES) or (bool(words & WEAK_NAMES) and not words & ARTICLE_NAMES)
    return False, doubtful and tag != "main", "main" if role == "main" else tag


class Tree:
    """Block elements of a page in page order; open elements end as in HTML, roughly, and inline ones leave no node."""

    def __init__(self, page: str):
        self.root = Node("#page", None)
        self.nodes = [self.root]
        self.open: list[tuple[str, Node]] = [("#page", self.root)]
        self.count: dict[str, int] = {}
        at, size = 0, len(page)
        while at < size:
            m = _TAG.search(page, at)
            if m is None:
                break
            self.text(page[at : m.start()])
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if m[1]:
                self.end(tag)
            elif tag in RAW:
                close = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(page, at)
                at = size if close is None else page.find(">", close.end() - 1) + 1 or size
            else:
                self.start(tag, m[3])
        self.text(page[at:])

    def text(self, text: str) -> None:
        if text:
            self.open[-1][1].parts.append((text, self.count.get("a", 0) > 0))

    def cut(self, i: int) -> None:
        for tag, _ in self.open[i:]:
            self.count[tag] -= 1
        del self.open[i:]

    def close(self, tags: set[str], stops: set[str] | frozenset[str]) -> None:
        if any(self.count.get(t) for t in tags):
            for i in range(len(self.open) - 1, 0, -1):
                if self.open[i][0] in tags:
                    self.cut(i)
                    return
                if self.open[i][0] in stops:
                    return

    def start(self, tag: str, raw: str) -> None:
        if tag in ("html", "head", "body"):
            return
        node = self.open[-1][1]
        if tag in VOID and tag != "hr":
            if tag == "br":
                node.parts.append((" ", False))
            return
        if tag in BLOCKS and (tag not in CELLS or tag == "table"):
            self.close({"p"}, CELLS)
        if tag in ENDS:
            self.close(*ENDS[tag])
        elif tag in HEADINGS and self.open[-1][0] in HEADINGS:
            self.cut(len(self.open) - 1)
        elif tag == "a":
            self.remove("a")
            self.open[-1][1].links += 1
        node = self.open[-1][1]
        article = any(self.count.get(t) for t in ("article", "main"))
        sure, doubtful, name = judged(tag, raw, article)
        if tag == "hr" or len(self.open) < DEEPEST:
            if tag in BLOCKS or sure or doubtful:
                own = Node(name, node, sure or node.sure, doubtful)
                node.parts.append(own)
                self.nodes.append(own)
                node = own
            if tag not in VOID:
                self.open.append((tag, node))
                self.count[tag] = self.count.get(tag, 0) + 1

    def remove(self, tag: str) -> None:
        """Ends an inline element and nothing that was opened in it."""
        for i in range(len(self.open) - 1, 0, -1) if self.count.get(tag) else ():
            if self.open[i][0] == tag:
                self.count[tag] -= 1
                del self.open[i]
                return

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
        elif tag in HEADINGS:
            self.close(set(HEADINGS), CELLS)
        elif tag in BLOCKS or tag in DROPPED:
            self.close({tag}, {"table"} if tag in CELLS and tag != "table" else set() if tag == "table" else CELLS)
        elif tag == "a":
            self.remove("a")
        else:
            self.close({tag}, BLOCKS)


def clean(pieces: list[str]) -> str:
    return " ".join("".join(html.unescape(p) if "&" in p else p for p in pieces).split())


def settle(tree: Tree, spared: set[int]) -> list[Node]:
    """Sets who goes, and returns the others."""
    for node in tree.nodes:
        node.gone = node.sure or (node.doubtful and id(node) not in spared) or (node.parent is not None and node.parent.gone)
    return [n for n in tree.nodes if not n.gone]


def judge(tree: Tree) -> None:
    """Who goes, sizes and links of what stays, and points of the containers.

    Doubtful elements go where an article or main element is left without them; else those stay that hold one. Where no
    text would be left, forms stay.
    """
    left = settle(tree, set())
    if not any(n.tag in ("article", "main") for n in left):
        holds: set[int] = set()
        for node in reversed(tree.nodes):
            if (node.tag in ("article", "main") and not node.sure) or id(node) in holds:
                holds.add(id(node))
                holds.add(id(node.parent))
        left = settle(tree, holds)
    if not any(isinstance(p, tuple) and p[0].strip() for n in left for p in n.parts):
        settle(tree, {id(n) for n in tree.nodes if n.tag == "form"})
    for node in reversed(tree.nodes):
        if node.gone:
            continue
        own = clean([p[0] for p in node.parts if isinstance(p, tuple)])
        linked = min(len(own), sum(len(p[0].strip()) for p in node.parts if isinstance(p, tuple) and p[1]))
        node.leaf = not any(isinstance(p, Node) and not p.gone for p in node.parts)
        node.size += len(own)
        node.linked += linked
        if own:
            points = (1 + len(_COMMAS.findall(own)) + len(own) / 100) * (1 - linked / len(own))
            at = node if node.tag in CONTAINERS and not node.leaf else node.parent or node
            while at is not None:
                if at.tag in CONTAINERS:
                    at.score += points
                    points /= 2
                at = at.parent
        if node.parent is not None:
            for field in ("size", "linked", "links"):
                setattr(node.parent, field, getattr(node.parent, field) + getattr(node, field))
    for node in tree.nodes:
        node.score *= 1 - node.density()


def kept(tree: Tree) -> list[Node]:
    """The best container, or the article or main element around it, and those of its siblings that belong to it."""
    best = max((n for n in tree.nodes if n.tag in CONTAINERS and not n.gone), key=lambda n: n.score)
    if best.score <= 0:
        return []
    for wanted in ("article", "main"):
        at = best
        while at is not None and at.tag != wanted:
            at = at.parent
        if at is not None:
            best = at
            break
    if best.parent is None:
        return [best]
    least, found, follows = 0.2 * best.score, [], False
    for node in reversed([p for p in best.parent.parts if isinstance(p, Node) and not p.gone]):
        if node.tag in HEADINGS:
            stays = follows  # what stands under it stays
        elif node.tag in CONTAINERS and not node.leaf:
            stays = node.score >= least
        else:
            stays = node.density() < 0.25 and (node.size > 80 or (node.linked == 0 and bool(_SENTENCE.search(clean([p[0] for p in node.parts if isinstance(p, tuple)])))))
        follows = node is best or stays
        if follows:
            found.append(node)
    return found[::-1]


def blocks(node: Node, out: list[list[str]]) -> None:
    """Adds the text of each block below node; the last list is the open one."""
    for part in node.parts:
        if isinstance(part, tuple):
            out[-1].append(part[0])
        elif not part.gone and not (part.tag in LISTS and part.links >= 3 and part.density() > 0.5):
            out.append([])
            blocks(part, out)
            out.append([])


def extract(page: str) -> str:
    tree = Tree(page)
    judge(tree)
    out: list[list[str]] = [[]]
    for node in kept(tree):
        out.append([])
        blocks(node, out)
    return "\n".join(t for t in map(clean, out) if t)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: a row for each row of pages, whatever its other columns. Null and empty html, and
    pages without an article, have the empty text; null ids and urls stay null; repeated rows stay repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, column=2):
            texts = [extract(t) if t else "" for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"))
    kinds = dict(own.dtypes)
    return own.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
