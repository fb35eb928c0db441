"""HTML extraction: flat text blocks, features of each block and its neighbours, a decision tree.

``blocks`` cuts a page into flat text blocks (block-level tags end a block,
inline tags do not) and notes the words of each, how many stand in links, and
what its containers look like.  A decision tree, fitted by Spark ML on the
small labelled table ``LABELLED_PAGES``, decides whether a block is main text.
What it sees of a block (``FEATURES``):

* word count and link density of the block and of the blocks before and after;
* ``in_main``: it lies in an article or main container; ``elsewhere``: it does
  not, but the page has such a container with text;
* ``side``: the strongest hint of a side container around it, from its main
  container (or the page) down: 1 for a side element (nav, aside, footer, ...)
  and for names of reader comments, half for a form, and for a class or id the
  part of the name's words that are words of usual side containers; ``depth``:
  how many containers give such a hint; ``comments``: names of reader comments
  anywhere around it;
* ``share``: the share of the words of its main container (or the page) that
  the outermost of these containers holds (1 if there is none), so a wrapper
  with an unlucky name differs from a box;
* ``excess``: side containers around its main container, beyond those that the
  page's best main container has: an article in a comment list or a teaser box
  is not the article, one below a page-wide form is;
* ``heading``.

A name is a hint and no verdict: ids of headings are not names, and the id of a
section that only repeats the section's heading does not count (but for reader
comments).  The tree is a few dozen numbers and goes to the tasks as such;
pages are never shuffled.

Edge cases: null, empty and text-free html give an empty text.  Unclosed and
stray tags are tolerated as browsers do; an unclosed comment, script or tag
ends the page.  Hidden elements have no text.  Very long pages are cut in one
linear scan.  Ties in the tree go to main text.  Repeated rows and null ids and
urls pass through; other columns are not read.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .html_labels import LABELLED_PAGES, MAIN_MARK

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of the page.
UNSEEN = frozenset("script style noscript template textarea select button svg iframe object audio video canvas title datalist annotation annotation-xml".split())
#: Of these, the content is raw and ends only at the closing tag.
RAW = frozenset("script style textarea title noscript iframe template svg".split())
#: Elements that a "/" at the end of their start tag ends at once, as in XML.
FOREIGN = frozenset("svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
    "math mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle mpadded msub msup msubsup munder mover munderover mtable mtr mtd semantics".split()
)
#: Elements that a later start tag can end, and the tags that end them (any block-level tag ends a paragraph).
OPEN_ENDED = frozenset("p li dt dd tr td th option".split())
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
MAIN_TAGS = frozenset("article main".split())
SIDE_TAGS = frozenset("nav header footer aside dialog menu".split())
#: Elements around inputs, and around whole pages of some site builders: as strong a hint as half a name.
FORM_TAGS = frozenset("form fieldset".split())
FORM_STRENGTH = 0.5
SIDE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist status".split())
#: Parts of class and id names, as authors commonly write them.
SIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle sponsor sponsored sponsors promo promoted promotion banner cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription paywall nav navbar navigation menu menus topnav subnav breadcrumb breadcrumbs crumbs sidebar "
    "rail widget widgets related recommended recommendations trending footer foot header masthead topbar toolbar comment comments commentlist disqus reply replies "
    "respond responses discussion share sharing social login signin signup register search searchbox pagination pager paginator toc skip copyright legal disclaimer "
    "outbrain taboola teaser hidden adbox adslot adunit adsense announcement warning toast offcanvas megamenu dropdown sidenav navmenu colophon".split()
)
#: Beginnings of longer names of the same kind.
SIDE_STEMS = ("advert", "breadcrumb", "cookie", "footer", "newsletter", "sidebar", "sponsor", "subscri")
#: A name with one of these tells how the page is laid out, not what the element is.
LAYOUT_NAMES = frozenset("has with no without layout open closed enabled disabled allowed".split())
#: Those of reader comments.
COMMENT_NAMES = frozenset("comment comments commentlist disqus reply replies respond responses".split())
MAIN_NAMES = frozenset("article articlebody post entry story".split())

ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
HIDDEN = re.compile(r"(^|\s)hidden(\s|=|/?$)")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
QUOTE = re.compile(r"[\"'>]")

FEATURES = (
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "in_main", "elsewhere", "side", "depth", "comments", "share", "excess", "heading",
)


class Container:
    """A main or side element of the page; ``start`` and ``stop``: words of the page before it begins and ends."""

    __slots__ = ("above", "main", "strength", "comment", "slug", "plain", "start", "stop", "best", "side", "depth", "comments", "outer", "around")

    def __init__(self, above: "Container | None", element: tuple, start: int):
        self.above, (self.main, self.strength, self.comment, self.slug, self.plain) = above, element
        self.start = self.stop = start

    def settle(self) -> None:
        """What a block in this container inherits; containers around it are settled before."""
        a = self.above
        inherited = (a.best, a.side, a.depth, a.comments, a.outer, a.around) if a else (None, 0.0, 0, False, None, 0)
        self.best, self.side, self.depth, self.comments, self.outer, self.around = inherited
        if self.main:  # what lies around an article is its place on the page
            self.around += self.depth
            self.best, self.side, self.depth, self.outer = self, 0.0, 0, None
        if self.strength:
            self.side = max(self.side, self.strength)
            self.depth += 1
            self.comments = self.comments or self.comment
            self.outer = self.outer or self


@dataclass
class Block:
    text: str
    words: int
    linked: int
    container: Container | None
    heading: bool

    @property
    def links(self) -> float:
        return self.linked / self.words if self.words else 0.0


def _words_of(name: str) -> list[str]:
    return [p.lower() for p in NAME_PART.findall(name)]


def _strength(name: str) -> float:
    """The share of a name's words that are words of side containers; 0 if it tells of the layout."""
    words = _words_of(name)
    if not words or LAYOUT_NAMES.intersection(words):
        return 0.0
    return sum(w in SIDE_NAMES or w.startswith(SIDE_STEMS) for w in words) / len(words)


#: An element that is neither main nor side.
NEITHER = (False, 0.0, False, "", 0.0)


def _element(tag: str, attributes: str) -> tuple | None:
    """(main, strength of the hint that it is a side container, named for comments, id that could repeat a heading,
    strength without the id); None if hidden."""
    main, strength, comment, slug = tag in MAIN_TAGS, 1.0 if tag in SIDE_TAGS else FORM_STRENGTH * (tag in FORM_TAGS), False, ""
    if not attributes:
        return main, strength, comment, slug, strength
    found = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    style = found.get("style", "").replace(" ", "").lower()
    if HIDDEN.search(ATTRIBUTE.sub(" ", attributes)) or "display:none" in style or found.get("aria-hidden", "").lower() == "true":
        return None
    role = found.get("role", "").lower()
    strength = max(strength, float(role in SIDE_ROLES))
    main = main or role in ("main", "article")
    plain = strength
    if tag not in ("html", "body") and tag not in HEADINGS:
        classes, own_id = found.get("class", "").split(), found.get("id", "")
        words = {w for name in (*classes, own_id) for w in _words_of(name)}
        comment = bool(words & COMMENT_NAMES) and not words & LAYOUT_NAMES
        most = FORM_STRENGTH if main else 1.0  # a main element's own names are weak hints
        plain = max([strength, float(comment), *(min(most, _strength(c)) for c in classes)])
        strength = max(plain, min(most, _strength(own_id)))
        if strength > plain:
            slug = "-".join(_words_of(own_id))
        main = main or (strength == 0 and bool(words & MAIN_NAMES) and tag in ("div", "section", "td"))
    return main, strength, comment, slug, plain


def _tags(page: str) -> Iterator[tuple]:
    """("text", piece) and (tag, is_end, attributes), in page order; one pass, comments and raw elements skipped."""
    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            yield "text", page[at:]
            return
        if lt > at:
            yield "text", page[at:lt]
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            if end < 0:
                return
            at = end + 3
            continue
        nxt = page[lt + 1 : lt + 3]
        if not nxt or not (nxt[0] in "!?" or nxt[0].isascii() and nxt[0].isalpha() or nxt[0] == "/" and nxt[1:].isascii() and nxt[1:].isalpha()):
            yield "text", "<"
            at = lt + 1
            continue
        end = _tag_end(page, lt + 1)
        if end < 0:
            return
        at = end + 1
        if nxt[0] in "!?":
            continue
        closing = nxt[0] == "/"
        inner = page[lt + 1 + closing : end]
        m = re.match(r"[^\s/>]+", inner)
        tag = m[0].lower()
        yield tag, closing, inner[m.end() :]
        if not closing and tag in RAW and not inner.endswith("/"):
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
            if not close:
                return
            at = close.start()


def _tag_end(page: str, at: int) -> int:
    """Place of the ``>`` that ends a tag, quoted values skipped; the first ``>`` if a quote is never closed."""
    first = end = page.find(">", at)
    while end >= 0:
        m = QUOTE.search(page, at)
        if not m:
            return first
        if m[0] == ">":
            return m.start()
        close = page.find(m[0], m.end())
        # a quote not preceded by "=" is no value; neither is one that is never closed
        if close < 0 or page[at : m.start()].rstrip()[-1:] != "=":
            at = m.end()
        else:
            at = close + 1
    return end


def blocks(page: str | None) -> tuple[list[Block], list[Container]]:
    """The flat text blocks of a page, in order, and its main and side containers, settled."""
    out: list[Block] = []
    containers: list[Container] = []
    stack: list[tuple[str, Container | None, bool]] = []  # tag, innermost container, unseen
    open_tags: Counter[str] = Counter()
    pieces: list[str] = []
    linked: list[str] = []
    total = 0

    def close(at: int) -> None:
        for i in range(at, len(stack)):
            own = stack[i][1]
            if own is not None and (i == 0 or stack[i - 1][1] is not own):
                own.stop = total
        open_tags.subtract(tag for tag, _, _ in stack[at:])
        del stack[at:]

    def end_block() -> None:
        nonlocal total
        words = entities.unescape("".join(pieces)).split()
        if words:
            in_links = len(entities.unescape(" ".join(linked)).split())
            heading = any(open_tags[tag] > 0 for tag in HEADINGS)
            own = stack[-1][1] if stack else None
            text = " ".join(words)
            if own is not None and own.slug:
                # the id of a section that repeats its heading names the section's subject
                if heading and own.slug == "-".join(_words_of(text)):
                    own.strength = own.plain
                own.slug = ""
            out.append(Block(text, len(words), min(in_links, len(words)), own, heading))
            total += len(words)
        pieces.clear()
        linked.clear()

    for token in _tags(page or ""):
        if len(token) == 2:
            if not (stack and stack[-1][2]):
                pieces.append(token[1])
                if open_tags["a"] > 0:
                    linked.append(token[1])
            continue
        tag, closing, attributes = token
        element = NEITHER if closing else _element(tag, attributes)
        hidden = element is None
        notable = not hidden and (element[0] or element[1] > 0)
        if tag not in INLINE or notable or hidden:
            end_block()
        if closing:
            if open_tags[tag] > 0:
                at = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
                if tag in INLINE and (stack[at][2] or stack[at][1] is not (stack[at - 1][1] if at else None)):
                    end_block()
                close(at)
            continue
        if tag in VOID or tag in FOREIGN and attributes.endswith("/"):
            continue
        if tag not in INLINE:
            ended, low = (*ENDS.get(tag, ()), "p"), len(stack)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ended:
                    low = i
                elif stack[i][0] not in INLINE and stack[i][0] not in OPEN_ENDED:
                    break
            close(low)
        above, unseen = (stack[-1][1], stack[-1][2]) if stack else (None, False)
        if notable and not unseen:
            above = Container(above, element, total)
            containers.append(above)
        stack.append((tag, above, unseen or hidden or tag in UNSEEN))
        open_tags[tag] += 1
    end_block()
    close(0)
    for c in containers:
        c.settle()
    return out, containers


def features(found: list[Block], containers: list[Container]) -> list[tuple[float, ...]]:
    """One row of FEATURES per block; beyond the first and last block there is nothing (0 words, 0 links)."""
    total = max(1, sum(b.words for b in found))
    mains = [c for c in containers if c.main and c.stop > c.start]
    least = min((c.around for c in mains), default=0)
    rows = []
    for i, b in enumerate(found):
        before, after = (found[i - 1] if i else None), (found[i + 1] if i + 1 < len(found) else None)
        near = [v for n in (before, after) for v in ((float(n.words), n.links) if n else (0.0, 0.0))]
        c = b.container
        within = c is not None and c.best is not None
        around = (float(within), float(bool(mains) and not within))
        if c is None:
            around += (0.0, 0.0, 0.0, 1.0, 0.0)
        else:
            whole = max(1, c.best.stop - c.best.start) if within else total
            share = (c.outer.stop - c.outer.start) / whole if c.outer else 1.0
            around += (c.side, float(c.depth), float(c.comments), share, float(c.around - least if within else 0))
        rows.append((float(b.words), b.links, *near, *around, float(b.heading)))
    return rows


# ---- the tree

Node = float | tuple[int, float, "Node", "Node"]


def labelled(pages: tuple[str, ...] = LABELLED_PAGES) -> list[tuple[float, tuple[float, ...]]]:
    """(label, features) of every block of labelled pages; a block that begins with the mark is main text."""
    rows = []
    for page in pages:
        labels = [float(b.text.startswith(MAIN_MARK)) for b in blocks(page)[0]]
        rows += zip(labels, features(*blocks(page.replace(MAIN_MARK, ""))), strict=True)
    return rows


def fit_tree(spark: SparkSession, max_depth: int = 10) -> Node:
    """A decision tree over FEATURES fitted on the labelled table, as nested (feature, threshold, low, high)."""
    table = spark.createDataFrame([(label, Vectors.dense(row)) for label, row in labelled()], ["label", "features"])
    model = DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=1, maxBins=64, seed=7).fit(table)

    def walk(node) -> Node:
        if node.numDescendants() == 0:
            return float(node.prediction())
        split = node.split()
        return split.featureIndex(), split.threshold(), walk(node.leftChild()), walk(node.rightChild())

    return walk(model._java_obj.rootNode())


def is_main(tree: Node, row: tuple[float, ...]) -> bool:
    while isinstance(tree, tuple):
        feature, threshold, low, high = tree
        tree = low if row[feature] <= threshold else high
    return tree >= 0.5


def main_text(page: str | None, tree: Node) -> str:
    found, containers = blocks(page)
    return " ".join(b.text for b, row in zip(found, features(found, containers)) if is_main(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points of the text)."""
    tree = fit_tree(pages.sparkSession)

    @F.arrow_udf("string")
    def text_of(html: pa.Array) -> pa.Array:
        return pa.array([main_text(page, tree) for page in html.to_pylist()], pa.string())

    return pages.select("page_id", "url", text_of("html").alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
