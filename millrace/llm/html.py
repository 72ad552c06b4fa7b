"""Main text of web pages by composite text density.

A page becomes a tree of its elements, without those that never hold the article. Every
node has a density: its characters for each tag, adjusted by how much of it is links (Sun,
Song and Liao, "DOM Based Content Extraction via Text Density"). The node whose children's
densities have the greatest sum is the heart of the article. The least density on the path
from the body to it is the threshold for what stands beside that path, and for lists of links and
cards below it. Whether the heart is in an article or main is a weight only: what stands beside the
path in there needs links as well to be left out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from math import e, log

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.words import slices

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[A-Za-z][^\s/>]*)"
    r"(?P<rest>(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^>]*(?:>|\Z))", re.S)

# One attribute after the other, so that what stands inside a value is never taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# HTML's own element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
# Elements that stand apart from their neighbours; all others, unknown ones too, are part of a line.
BLOCKS = frozenset((
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html "
    "iframe legend li main menu nav object ol optgroup option p pre search section select summary "
    "svg table tbody td textarea tfoot th thead title tr ul video").split())
# What a start tag closes, if it is open.
CLOSES = {
    **dict.fromkeys((
        "address article aside blockquote center details dialog dir div dl fieldset figcaption "
        "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section "
        "table ul").split(), ("p",)),
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "a": ("a",),
}
# Open elements that a start or end tag of another kind does not reach behind.
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",),
          **dict.fromkeys(("tr", "td", "th"), ("table",)),
          "p": ("button", "table", "td", "th")}

# Elements that hold no article text (a form around the article does), and names of classes, ids
# and roles that tell the same.
BOILERPLATE = frozenset(
    "nav footer aside form script style noscript template iframe svg button select "
    "textarea dialog menu head title object canvas audio video map datalist".split())
# Names for what readers say, and for adverts: no part of an article, unless they stand at an
# element around it.
FOREIGN = frozenset((
    "comment comments respond reply replies disqus discussion ad ads advert adverts advertisement "
    "advertising adsense sponsored sponsor promo promotion cookie cookies consent gdpr popup modal "
    "newsletter subscribe share sharing social").split())
# Names for parts of the page around an article; an element that holds one is kept.
AROUND = frozenset((
    "nav navbar navigation menu sidebar aside footer header masthead banner breadcrumb breadcrumbs "
    "notice alert toolbar pagination pager related widget widgets skip complementary contentinfo "
    "search").split())

# Text that is read as one with its neighbours: the heart is looked for around it.
TEXT = frozenset((
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp "
    "small span strike strong sub sup time tt u var wbr "
    "h1 h2 h3 h4 h5 h6 p pre blockquote li dt dd ul ol dl figure figcaption br").split())
# Elements that put others together; lists of links, cards and menus are among them.
GROUPS = frozenset("div section article center details table ul ol dl p li".split())

# What ends a sentence: text that has it, outside links, may be an article's.
SENTENCE = re.compile("[.!?\u2026\u3002\uff01\uff1f]")
# How a notice of rights begins, wherever it stands, and what it says beside the article.
RIGHTS = re.compile(r"\s*(?:\u00a9|(?:copyright\s*)?(?:\(c\)|\u00a9)|copyright\s+\d{4})", re.I)
RIGHTS_BESIDE = re.compile(r"\s*(?:\u00a9|\(c\)|copyright\b)|.*\ball rights reserved\b", re.I | re.S)
# Elements that such a notice may fill.
RIGHTS_IN = frozenset("p div small section li center".split())
# Words of a heading over links that lead elsewhere; links below other headings are references.
ELSEWHERE = frozenset((
    "related more also popular recommended trending latest share follow next previous menu "
    "navigation tags categories").split())

_SPLIT = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")


class Page:
    """The tree of a page: its nodes in page order, a parent before its children."""

    def __init__(self, html: str) -> None:
        self.names, self.parents, self.attributes = ["html"], [-1], [""]
        # What a node holds, in order: texts, and numbers of nodes.
        self.items: list[list[str | int]] = [[]]
        self._read(html)

    def _open(self, name: str, attributes: str, parent: int) -> int:
        node = len(self.names)
        self.names.append(name)
        self.parents.append(parent)
        self.attributes.append(attributes)
        self.items.append([])
        self.items[parent].append(node)
        return node

    def _read(self, html: str) -> None:
        stack, at = [0], 0
        # How many elements of each name are open: what is not open needs no search.
        self.open = Counter()
        while True:
            found = _TAG.search(html, at)
            end = found.start() if found else len(html)
            if end > at:
                self.items[stack[-1]].append(unescape(html[at:end]))
            if not found:
                return
            at = found.end()
            if not found["name"]:
                continue
            name = found["name"].lower()
            if found["close"]:
                self._close(stack, (name,), SCOPES.get(name, ()))
                continue
            if name in CLOSES:
                self._close(stack, CLOSES[name], SCOPES.get(CLOSES[name][0], ()))
            node = self._open(name, found["rest"], stack[-1])
            if name in RAW:
                last = re.compile(rf"</{re.escape(name)}\b", re.I).search(html, at)
                at = last.start() if last else len(html)
            elif name in VOID:
                continue
            stack.append(node)
            self.open[name] += 1

    def _close(self, stack: list[int], names: tuple[str, ...], scope: tuple[str, ...]) -> None:
        """Close the innermost open element of these names, with all inside of it."""
        if not any(self.open[name] for name in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            own = self.names[stack[k]]
            if own in names:
                self.open.subtract(self.names[node] for node in stack[k:])
                del stack[k:]
                return
            if own in scope:
                return

    def words_of(self, node: int) -> tuple[set[str], bool]:
        """The words of a node's class, id and role, and whether it is hidden."""
        words, hidden = set(), False
        # The classes of an article say what it has ("comments-open"), so they are not taken apart.
        split = str.split if self.names[node] in ("article", "main") else _SPLIT.split
        for name, *values in _ATTRIBUTE.findall(self.attributes[node]):
            value, name = "".join(values), name.lower()
            if name in ("class", "id", "role"):
                words.update(w.lower() for w in split(value) if w)
            elif name == "style":
                hidden |= "display:none" in value.replace(" ", "").lower()
            elif name in ("hidden", "aria-hidden"):
                hidden |= name == "hidden" or value.lower() == "true"
        return words, hidden


def _article(page: Page) -> list[int]:
    """For each node the outermost article or main that it is in (itself included), or -1."""
    found: list[int] = []
    for node, (name, parent) in enumerate(zip(page.names, page.parents)):
        outer = found[parent] if parent >= 0 else -1
        found.append(node if outer < 0 and name in ("article", "main") else outer)
    return found


def _subtrees(page: Page, own: list[bool]) -> list[bool]:
    """Which nodes are marked themselves or hold one that is."""
    holds = list(own)
    for node in range(len(holds) - 1, 0, -1):
        holds[page.parents[node]] |= holds[node]
    return holds


def _prose(page: Page, dropped: list[bool]) -> bool:
    """Whether a sentence is left outside links."""
    linked: list[bool] = []
    for node, (name, parent) in enumerate(zip(page.names, page.parents)):
        linked.append(name == "a" or parent >= 0 and linked[parent])
        if not dropped[node] and not linked[node] and any(
                isinstance(i, str) and SENTENCE.search(i) for i in page.items[node]):
            return True
    return False


def _dropped(page: Page, article: list[int]) -> list[bool]:
    """Which nodes are not looked at, with all that is in them.

    Elements that never hold an article go, and so do those whose names tell that they are
    something else, unless they hold the article: a main, an h1 or an article that is not itself
    part of something else, or, if no sentence is left then, any of these. If there is still none,
    the article is in an element with such a name, and those that hold the heart of all that is
    left stay.
    """
    n = len(page.names)
    plain, named, foreign = [False] * n, [False] * n, [False] * n
    for node, (name, parent) in enumerate(zip(page.names, page.parents)):
        foreign[node] = parent >= 0 and foreign[parent]
        if parent < 0 or name in ("html", "body"):
            continue
        plain[node] = name in BOILERPLATE and name != "form" or (
            name == "header" and article[node] < 0)
        named[node] = name == "form"
        if page.attributes[node]:
            words, hidden = page.words_of(node)
            plain[node] |= hidden
            foreign[node] |= bool(words & FOREIGN)
            named[node] |= bool(words & (FOREIGN | AROUND))
    plain = _downwards(page, plain)
    marks = [name in ("main", "h1", "article") and not gone
             for name, gone in zip(page.names, plain)]
    outside = [mark and not inside for mark, inside in zip(marks, foreign)]
    for some in (outside, marks):
        holds = _subtrees(page, some)
        strict = _downwards(page, [gone or other and not held
                                   for gone, other, held in zip(plain, named, holds)])
        if _prose(page, strict):
            return strict
    # Something else within something else, as one comment of many, stays out of the search.
    inner = [other and any_above for other, any_above in zip(named, _above(page, named))]
    heart = _heart(page, article, _downwards(page, [a or b for a, b in zip(plain, inner)]))
    around = set()
    while heart > 0:
        around.add(heart)
        heart = page.parents[heart]
    return _downwards(page, [gone or other and not held and node not in around for node, (
        gone, other, held) in enumerate(zip(plain, named, holds))])


def _downwards(page: Page, own: list[bool]) -> list[bool]:
    """Which nodes are marked themselves or are in one that is."""
    found: list[bool] = []
    for mark, parent in zip(own, page.parents):
        found.append(mark or parent >= 0 and found[parent])
    return found


def _above(page: Page, own: list[bool]) -> list[bool]:
    """Which nodes are in one that is marked."""
    inside = _downwards(page, own)
    return [parent >= 0 and inside[parent] for parent in page.parents]


def _heart(page: Page, article: list[int], dropped: list[bool]) -> int:
    """The node with the greatest sum of its children's densities, 0 if nothing is left."""
    density, _ = _densities(page, dropped)
    sums = [0.0] * len(density)
    for node in range(1, len(density)):
        sums[page.parents[node]] += density[node]
    # A node of text alone is its own subtree.
    alive = [k for k in range(len(density)) if not dropped[k] and density[k] > 0]
    if not alive:
        return 0
    heart = max(alive, key=lambda k: (
        max(sums[k], density[k]) if k else 0.0, article[k] >= 0, -k))
    while page.names[heart] in TEXT and page.parents[heart] > 0:
        heart = page.parents[heart]
    return heart


def _referred(page: Page) -> list[bool]:
    """Which nodes are, or are in, what follows a heading that does not lead elsewhere."""
    own = [False] * len(page.names)
    nothing = [False] * len(page.names)
    for items in page.items:
        before = None
        for item in items:
            if isinstance(item, str):
                before = before if not item.strip() else None
                continue
            if before is not None and page.names[item] in ("ul", "ol", "dl"):
                said = set(re.findall(r"\w+", _text(page, before, nothing).lower()))
                own[item] = bool(said) and not said & ELSEWHERE
            before = item if re.fullmatch("h[2-6]", page.names[item]) else None
    return _downwards(page, own)


def _densities(page: Page, dropped: list[bool]) -> tuple[list[float], list[float]]:
    """The composite text density of every node, and the share of its characters in links."""
    n = len(page.names)
    chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    for node in range(n - 1, -1, -1):
        if dropped[node]:
            continue
        chars[node] += sum(len("".join(i.split())) for i in page.items[node] if isinstance(i, str))
        if page.names[node] == "a" and "href" in page.attributes[node].lower():
            link_chars[node], link_tags[node] = chars[node], link_tags[node] + 1
        parent = page.parents[node]
        if parent >= 0:
            chars[parent] += chars[node]
            tags[parent] += tags[node] + 1
            link_chars[parent] += link_chars[node]
            link_tags[parent] += link_tags[node]
    share = link_chars[0] / max(chars[0], 1)
    found = []
    for c, t, lc, lt in zip(chars, tags, link_chars, link_tags):
        if not c:
            found.append(0.0)
            continue
        t = max(t, 1)
        base = log(c / max(c - lc, 1) * lc + share * c + e)
        # Without links the base is e and the adjustment is all there is to it.
        found.append(c / t * log(max(c / max(lc, 1) * t / max(lt, 1), 1.0)) / max(log(base), 0.1))
    return found, [lc / max(c, 1) for c, lc in zip(chars, link_chars)]


def main_text(html: str) -> str:
    """The text of the article, in page order, its blocks joined by single spaces."""
    page = Page(html)
    article = _article(page)
    dropped = _dropped(page, article)
    density, linked = _densities(page, dropped)
    if not any(d > 0 and not gone for d, gone in zip(density, dropped)):
        return ""
    heart, referred = _heart(page, article, dropped), _referred(page)
    path = [heart]
    while page.parents[path[-1]] > 0:
        path.append(page.parents[path[-1]])
    least, kept = min(density[k] for k in path), set(path)
    below = [False] * len(density)
    for node in range(1, len(density)):
        parent = page.parents[node]
        below[node] = parent == heart or below[parent]
        if dropped[node] or node in kept or page.names[node] not in BLOCKS:
            continue
        thin = density[node] < least
        if page.names[node] in RIGHTS_IN and (RIGHTS if below[node] else RIGHTS_BESIDE).match(
                _text(page, node, dropped)):
            dropped[node] = True
        elif below[node]:
            dropped[node] = thin and not referred[node] and page.names[node] in GROUPS and (
                linked[node] > (0.9 if page.names[node] in ("p", "li") else 1 / 3))
        elif parent in kept and not re.fullmatch("h[1-6]", page.names[node]):
            inside = article[heart] >= 0 and article[node] == article[heart]
            dropped[node] = thin and (not inside or page.names[node] in GROUPS
                                      and linked[node] > 0.1)
    return _text(page, path[-1], dropped)


def _text(page: Page, top: int, dropped: list[bool]) -> str:
    """All text below ``top``; an element that is not inline stands apart from its neighbours."""
    out: list[str] = []
    stack: list[str | int] = [top]
    while stack:
        item = stack.pop()
        if isinstance(item, str):
            out.append(item)
        elif dropped[item]:
            out.append(" " if page.names[item] in BLOCKS else "")
        elif page.names[item] not in BLOCKS:
            stack.extend(reversed(page.items[item]))
        else:
            stack.append(" ")
            stack.extend(reversed(page.items[item]))
            stack.append(" ")
    return " ".join("".join(out).split())


SCHEMA = "page_id long, url string, text string, n_chars long"


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html).

    Character references are decoded, white space inside a block becomes one space, and blocks
    are joined by one. Markup that is broken is read as far as it goes: an element that is
    not closed ends with its parent. A page that has text outside all elements that never hold an
    article has a text, be it marked as an article or not; one that has none, and a null or empty
    html, have the empty text. Nothing is shuffled, and each row gives one row; null ids and urls stay null;
    columns other than those named are not read; an empty table gives no rows.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, pages_html in slices(batch, "html"):
                texts = [main_text(html) for html in pages_html.to_pylist()]
                yield pa.RecordBatch.from_arrays([
                    rows.column("page_id").cast(pa.int64()), rows.column("url").cast(pa.string()),
                    pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", "url", "html").mapInArrow(extract, SCHEMA)
