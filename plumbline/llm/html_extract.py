"""HTML main text extraction with site template removal.

Element subtrees are hashed; Spark counts on how many pages of a host a hash occurs, inside articles on
how many pages with different articles. Subtrees that recur are their host's template and are deleted, then
elements that by tag, role or class are no content, and the text of what is left is returned.
"""

from __future__ import annotations

import hashlib
import re
from html.parser import HTMLParser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.tables import fresh, map_pieces, written

RATIO = 0.1  # of a host's pages
MIN_PAGES = 5
BROADCAST_HASHES = 500_000  # 8 bytes each

# HTML's element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre search section table ul".split()
)
#: An open element (key) ends where one of these begins.
IMPLIED_END = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "thead", "tfoot"]),
    "td": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "thead", "tfoot"]),
    "option": frozenset(["option", "optgroup"]),
}
#: Blocks that are parts of a text inside an article, no box of their own, however often they recur.
PIECES = frozenset("h1 h2 h3 h4 h5 h6 li dt dd tr td th tbody thead tfoot caption figcaption option optgroup".split())
SCOPE = frozenset("table td th ul ol dl body html article section main div select".split())
#: Elements without main text, whatever they hold.
NO_CONTENT = frozenset(
    "head script style noscript template nav footer aside form button input select textarea iframe object embed svg canvas audio video map dialog menu title link meta".split()
)
CONTROLS = frozenset("button input select textarea".split())
#: Elements that hold an article's own words; a passage in them that articles share is no template.
PROSE = frozenset("p blockquote pre ul ol dl table figure".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of a class or id that name a part around the article.
PARTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist disqus respond replies consent cookie cookies gdpr "
    "footer masthead menu nav navbar navigation newsletter notice notices pagination pager popup modal overlay promo promoted promotion related recommended sponsor sponsored "
    "share sharing sidebar sidebars social subscribe subscription signup toolbar topbar widget widgets".split()
)
#: Of these, the words that name readers' comments wherever a name ends with them.
COMMENTS = frozenset("comment comments commentlist disqus respond replies".split())
#: Words that may stand beside those in the name of a part.
BESIDE = frozenset(
    "area bar block bottom box button buttons container content footer global header inner left line link links list main page post primary right secondary section site slot top unit wrap wrapper".split()
)
_PART_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ARTICLE = frozenset(["article", "main"])


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


class _Builder(HTMLParser):
    """A tree of elements and texts; references are decoded, comments and declarations left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._end("p", CLOSES_P)
        top = self.open[-1].tag
        while tag in IMPLIED_END.get(top, ()):
            self.open.pop()
            top = self.open[-1].tag
        if tag in IMPLIED_END:  # an inline element left open inside the item ends with it
            for node in reversed(self.open):
                if tag in IMPLIED_END.get(node.tag, ()):
                    del self.open[self.open.index(node) :]
                    break
                if node.tag not in INLINE and node.tag != "p":
                    break
        node = Node(tag, {k: v or "" for k, v in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag not in VOID:
            self._end(tag, frozenset())

    def _end(self, tag, barrier):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return
            if self.open[i].tag in barrier:
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def _digest(*parts: str | bytes) -> bytes:
    h = hashlib.blake2b(digest_size=8)
    for part in parts:
        raw = part.encode("utf-8", "surrogatepass") if isinstance(part, str) else part
        h.update(len(raw).to_bytes(4, "little") + raw)
    return h.digest()


def hash_subtrees(root: Node) -> tuple[dict[int, int], dict[int, int], int, int]:
    """id(node) to a signed 64-bit hash of tag, class, texts and children, for the elements outside
    articles that have text, then for the boxes inside articles, and hashes of all articles (0 without)
    and of the whole page. Children are hashed before their parents; what holds an article is no template."""
    outside: dict[int, int] = {}
    within: dict[int, int] = {}
    order, stack = [], [(root, False)]
    while stack:
        node, inside = stack.pop()
        order.append((node, inside))
        inside = inside or node.tag in _ARTICLE
        stack.extend((c, inside) for c in node.children if isinstance(c, Node))
    own: dict[int, bytes] = {}
    holders, articles = set(), []
    for node, inside in reversed(order):
        if node.tag in ("script", "style"):
            continue
        parts: list[str | bytes] = [node.tag, node.attrs.get("class", "")]
        for c in node.children:
            if isinstance(c, Node):
                parts.append(own.get(id(c), b""))
                if c.tag in _ARTICLE or id(c) in holders:
                    holders.add(id(node))
            elif text := " ".join(c.split()):
                parts.append(text)
        own[id(node)] = digest = _digest(*parts)
        if node.tag in _ARTICLE:
            if not inside:
                articles.append(digest)
        elif id(node) in holders or node.tag in ("", "html", "body"):
            continue
        elif not inside and _has_text(node):
            outside[id(node)] = int.from_bytes(digest, "little", signed=True)
        elif inside and node.tag not in INLINE and node.tag not in PIECES and node.tag not in PROSE and _has_text(node):
            within[id(node)] = int.from_bytes(_digest("in", digest), "little", signed=True)
    number = lambda digest: int.from_bytes(digest, "little", signed=True)
    return outside, within, number(_digest(*articles)) if articles else 0, number(own[id(root)])


def _has_text(node: Node) -> bool:
    stack = [node]
    while stack:
        for c in stack.pop().children:
            if isinstance(c, Node):
                stack.append(c)
            elif c.strip():
                return True
    return False


def names_part(names: str) -> bool:
    """Whether a class or id is the name of a part: made of PARTS words alone, or of them and BESIDE words,
    or one that ends with a word for comments."""
    for name in names.split():
        words = [w.lower() for w in _PART_WORDS.findall(name)]
        if words and words[-1] in COMMENTS:
            return True
        if any(w in PARTS for w in words) and all(w in PARTS or w in BESIDE for w in words):
            return True
    return False


def is_content(node: Node, inside: bool = False) -> bool:
    """Not an element that by tag, role, state, class or id stands around an article. Inside one the
    id of a heading or section is a place to link to and says nothing."""
    if node.tag in NO_CONTENT or node.attrs.get("role", "").lower() in ROLES or "hidden" in node.attrs:
        return False
    if node.tag in ("html", "body", "article", "main"):
        return True
    if node.tag in ("label", "fieldset") and ("for" in node.attrs or _has_control(node)):
        return False
    own = node.attrs.get("id", "")
    linked = inside and node.tag in ("h1", "h2", "h3", "h4", "h5", "h6")
    linked |= inside and node.tag == "section" and not (_PART_WORDS.findall(own.lower()) or [""])[-1] in COMMENTS
    return not names_part(node.attrs.get("class", "")) and (linked or not names_part(own))


def _has_control(node: Node) -> bool:
    stack = [node]
    while stack:
        for c in stack.pop().children:
            if isinstance(c, Node):
                if c.tag in CONTROLS:
                    return True
                stack.append(c)
    return False


def article_holders(root: Node) -> set[int]:
    """id(node) of all elements with an article or a main element in them."""
    order, stack, found = [], [root], set()
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in node.children if isinstance(c, Node))
    for node in reversed(order):
        if any(isinstance(c, Node) and (c.tag in _ARTICLE or id(c) in found) for c in node.children):
            found.add(id(node))
    return found


def main_text(root: Node, template: set[int]) -> str:
    """The text of the article, of the main element or else of the whole page, without template
    subtrees and elements that are no content. Blocks and line breaks count as white space."""
    if template:
        outside, within, _, _ = hash_subtrees(root)
        gone = {node for node, h in (outside | within).items() if h in template}
    else:
        gone = set()

    def keep(node: Node, inside: bool) -> bool:
        if node.tag == "header":  # a page's header goes, an article's own one has its heading
            return inside
        return is_content(node, inside) and id(node) not in gone

    holders = article_holders(root)
    tops: dict[str, list[Node]] = {"article": [], "main": []}
    for drop in (True, False):  # articles in comments or asides only if there are no others
        stack = [root]
        while stack:
            node = stack.pop()
            if node.tag == "article":
                tops["article"].append(node)  # an article inside an article is part of it
                continue
            if node.tag == "main":
                tops["main"].append(node)
            for c in reversed(node.children):
                if isinstance(c, Node) and (c.tag in _ARTICLE or id(c) in holders) and (not drop or c.tag == "form" or keep(c, False)):
                    stack.append(c)
        if tops["article"] or tops["main"]:
            break
    out: list[str] = []
    for top in tops["article"] or tops["main"] or [root]:
        inside = top is not root
        work: list[Node | str] = [top]
        while work:
            x = work.pop()
            if isinstance(x, str):
                out.append(x)
            elif x is top or keep(x, inside):
                if x.tag not in INLINE:
                    out.append(" ")
                    work.append(" ")
                work.extend(reversed(x.children))
    return " ".join("".join(out).split())


def host_of(url: Column) -> Column:
    """Lower-case host of a URL; empty if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def extract(pages: DataFrame, url: str = "url", html: str = "html", output: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """``pages`` with the main text in ``output``, without the column ``html``.

    A subtree is template if it is on at least ``min_pages`` different pages and ``ratio`` of the different
    pages of its host: copies of a page count as one, so they keep their text. Inside articles, pages whose
    articles are equal count as one, and only boxes are candidates: no inline elements, headings,
    paragraphs, lists, tables or figures, which belong to a text however often articles share them.

    - A NULL or empty html has an empty text; so has one without content. Pages of a NULL URL, or one
      without a host, form a host of their own.
    - Repeated rows, and other pages of equal content, count once; a subtree counts once per page.
    - Whole pages of any length are read, broken markup included. An empty table gives an empty table.
    - Other columns pass through; a column already named ``output`` is replaced.

    Shuffled are (host, hash) counts, added up within tasks first. A host has at most (mean subtrees of
    a page / ratio) template hashes; up to BROADCAST_HASHES in all are broadcast, more are joined to
    the pages by host (AQE splits a hot host).
    """
    host, template = fresh(pages, "__host", "__template")
    hosted = pages.withColumn(host, host_of(F.col(f"`{url}`")))

    def hashes(texts):
        found = [hash_subtrees(parse(t)) if t else ({}, {}, 0, 0) for t in texts]
        return tuple(zip(*[(sorted(set(o.values())), sorted(set(w.values())), a, p) for o, w, a, p in found])) or ([], [], [], [])

    outputs = {"outside": "array<bigint>", "within": "array<bigint>", "article": "bigint", "page": "bigint"}
    found = written(map_pieces(hosted.select(host, html), hashes, [html], outputs, keep=[host]), "subtrees")
    different = found.groupBy(host, "page").agg(F.first("outside").alias("outside"))
    articles = found.where("article <> 0").groupBy(host, "article").agg(F.first("within").alias("within"))

    def often(pages_, column):
        counts = pages_.select(host, F.explode(column).alias("k")).groupBy(host, "k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
        totals = pages_.groupBy(host).agg(F.count(F.lit(1)).alias("total"))
        return counts.join(totals, host).where(F.col("n") >= F.lit(float(ratio)) * F.col("total")).select(host, "k")

    recurring = often(different, "outside").unionByName(often(articles, "within"))
    recurring = written(recurring.groupBy(host).agg(F.collect_list("k").alias(template)), "site-templates")
    size = recurring.agg(F.sum(F.size(template))).first()[0] or 0
    joined = hosted.join(F.broadcast(recurring) if size <= BROADCAST_HASHES else recurring, host, "left")

    def texts_of(texts, templates):
        return ([main_text(parse(t), set(h or ())) if t else "" for t, h in zip(texts, templates)],)

    keep = [c for c in pages.columns if c not in (html, output)]
    return map_pieces(joined, texts_of, [html, template], {output: "string"}, keep)
