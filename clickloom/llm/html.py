"""Main text of web pages by tag-path ratios.

A page is read as a sequence of blocks, each with its path of block tags from the root;
inline tags belong to the block they are in. For each path of a page, text length,
punctuation, linked text and the number of blocks are added up; the ratio of a path is its
unlinked text per block, weighed by its punctuation per block. Ratios are smoothed over the
paths of one container, fused with the path's own, and paths below ``KEEP`` of the best are
dropped.

The containers are where the page's text is: the ratios, times text, are added up from the
leaves to the root, and from the root on the way goes to the child that has most of it as long
as that is ``HOLD`` of the page's. The element where this ends holds the main text, and all its
paths are one container, so that its lists, tables and short paragraphs stay with the long
ones. Other paths are smoothed over their parent, and must reach ``KEEP_OUTSIDE`` of the best.
A block of links alone, other than a paragraph or heading, has a path of its own, without ratio.

Parts that name themselves as something else (tags, roles and class names of menus,
adverts, forms, comments and the like) do not take part; a page with an ``article`` or
``main`` that has text is judged within it.

A form, or a part marked by its names only, may be a wrapper of the article. It takes part
if it holds most of the page's unlinked text, or the only ``article`` or ``main`` with text
and more than stands in no marked part. ``ADDED`` is an exception: comments and notices are
often longer than an article.
Where nothing unlinked is left, ``ADDED`` is no exception; if that gives nothing
either, all marks are disregarded.

Each page is read once, in linear time, on its own: no shuffle, and no page meets another.

Defined results: a null, empty or markup-only page gives the empty text. A page that breaks
off ends there; unclosed tags end with what contains them. Rows are read one by one, so
repeated or null ids give one row each. Other columns are not looked at.
"""

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from math import log1p

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

KEEP = 0.35
KEEP_OUTSIDE = 0.6
# The share of a page's weight that the element of the main text has.
HOLD = 0.6
# Element names of the HTML standard by kind, and names of parts of pages.
RAW = "script style noscript template iframe textarea title xmp noembed noframes"
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr picture img".split()
)
APART = set(
    "nav footer aside form head svg math canvas object select button menu dialog audio video map datalist applet".split()
)
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
PART_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar "
    "navigation menu breadcrumb breadcrumbs sidebar side footer foot comment comments disqus reply replies respond "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social related recommended recommendations widget search pagination "
    "pager copyright legal toolbar masthead topbar skip".split()
)
# Of these, what may hold more text than the article beside it.
ADDED = set(
    "comment comments disqus reply replies respond cookie cookies consent gdpr notice notices notification legal "
    "related recommended recommendations copyright".split()
)
HEADER_NAMES = {"header", "head", "topbar", "masthead"}
ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
CONTENT = {"article", "main"}
TEXTUAL = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>{RAW.replace(' ', '|')})(?=[\s/>])[^>]*+(?:>.*?(?:</(?P=raw)\s*+>|\Z)|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<more>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<more2>[^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
NAME_PARTS = re.compile(r"[^a-z]+")
# Names such as has-sidebar and no-comments tell what is in an element, not what it is.
TELLING = re.compile(r"(?:^|[-_])(?:has|with|no|without)[-_]")


# Kinds of elements that are apart; the last two may turn out to be wrappers.
HARD, MARKED, MARKED_ADDED = 1, 2, 3


def _apart(name: str, more: str, in_content: bool) -> int:
    """Whether an element is a part of the page that is not its article: 0 or its kind."""
    if name in APART and name != "form" or name == "header" and not in_content:
        return HARD
    form = MARKED if name == "form" else 0
    if not more or name in ("html", "body") or name in CONTENT and not in_content:
        return form
    values = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(more)}
    role = values.get("role", "").lower()
    if role in ROLES and role != "form" or values.get("aria-hidden") == "true":
        return HARD
    if re.search(r"(?:^|\s)hidden(?:\s|=|$)", ATTRIBUTE.sub(lambda m: m[1] if m[1] == "hidden" else " ", more)):
        return HARD
    if "display:none" in values.get("style", "").replace(" ", ""):
        return HARD
    given = f"{values.get('class', '')} {values.get('id', '')}".lower().split()
    names = {part for x in given if not TELLING.search(x) for part in NAME_PARTS.split(x)}
    if names & ADDED:
        return MARKED_ADDED
    if names & PART_NAMES or names & HEADER_NAMES and not in_content or role == "form":
        return MARKED
    return form


class Blocks:
    """The blocks of a page: (path, text, linked characters, inside an article, number of the
    innermost marked part or -1); and the marked parts: (number of the one around, kind)."""

    def __init__(self, page: str):
        self.found: list[tuple[str, str, int, bool, int]] = []
        self.marked: list[tuple[int, int]] = []
        # Open block elements: name, whether it or one around it is apart for certain, whether
        # in content, number of the innermost marked part.
        self.open: list[tuple[str, bool, bool, int]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.in_link = False
        at = 0
        for token in TOKEN.finditer(page):
            self.text(page[at : token.start()])
            at = token.end()
            name = token["name"] or token["name2"]
            if name:
                self.tag(name.lower(), token["end"] or token["end2"], token["more"] or token["more2"] or "")
            elif token["raw"] and token["raw"].lower() == "title":
                self.flush()
        self.text(page[at:])
        self.flush()

    def text(self, part: str) -> None:
        if part and not (self.open and self.open[-1][1]):
            self.parts.append(part)
            if self.in_link:
                self.linked += len(part)

    def flush(self) -> None:
        content = " ".join(html.unescape("".join(self.parts)).split())
        if content:
            path = "/".join([x[0] for x in self.open])
            if self.linked * 10 >= 9 * len(content) and not (self.open and self.open[-1][0] in TEXTUAL):
                path += "/a"
            _, _, in_content, part = self.open[-1] if self.open else ("", False, False, -1)
            self.found.append((path, content, min(self.linked, len(content)), in_content, part))
        self.parts, self.linked, self.in_link = [], 0, False

    def tag(self, name: str, end: str, more: str) -> None:
        if name == "br":
            self.text(" ")
        elif name == "a":
            self.in_link = not end
        elif name in INLINE and name not in APART:
            return
        elif end:
            self.flush()
            names = [x[0] for x in self.open]
            if name in names:
                del self.open[len(names) - 1 - names[::-1].index(name) :]
        else:
            self.flush()
            self.close_before(name)
            if name not in VOID and not more.rstrip().endswith("/"):
                _, apart, in_content, part = self.open[-1] if self.open else ("", False, False, -1)
                kind = 0 if apart else _apart(name, more, in_content)
                if kind in (MARKED, MARKED_ADDED):
                    self.marked.append((part, kind))
                    part = len(self.marked) - 1
                self.open.append((name, apart or kind == HARD, in_content or name in CONTENT, part))

    def close_before(self, name: str) -> None:
        """A new block ends an open paragraph; a list item, cell and so on its like."""
        ended = CLOSES.get(name, set()) | {"p"}
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] in ended:
                del self.open[i:]
            elif self.open[i][0] not in TEXTUAL:
                break


def main_element(weights: dict[str, float]) -> str:
    """The path of the innermost element that has ``HOLD`` of the weight, given by path."""
    below: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for path, weight in weights.items():
        names = path.split("/")
        for i in range(len(names) - 1):
            below["/".join(names[:i])]["/".join(names[: i + 1])] += weight
    least, at = HOLD * sum(weights.values()), ""
    while below[at]:
        child = max(below[at], key=below[at].get)
        if below[at][child] < least:
            break
        at = child
    return at


def kept_paths(blocks) -> set[str]:
    """The paths whose fused ratio is high enough."""
    sums = defaultdict(lambda: [0, 0, 0, 0])
    for path, content, linked, *_ in blocks:
        total = sums[path]
        for i, x in enumerate((len(content), len(PUNCTUATION.findall(content)), linked, 1)):
            total[i] += x
    own = {p: log1p((n - linked) / k) * (1 + log1p(marks / k)) for p, (n, marks, linked, k) in sums.items()}
    main = main_element({p: ratio * (sums[p][0] - sums[p][2]) for p, ratio in own.items()})

    def container(path: str) -> str:
        return main if not main or path.startswith(main + "/") else path.rpartition("/")[0]

    weights, totals = defaultdict(float), defaultdict(int)
    for p, ratio in own.items():
        weights[container(p)] += ratio * sums[p][0]
        totals[container(p)] += sums[p][0]
    smooth = {c: w / totals[c] for c, w in weights.items()}
    fused = {p: (ratio + smooth[container(p)]) / 2 for p, ratio in own.items() if ratio}
    best = max(fused.values(), default=0.0)
    least = {p: (KEEP if container(p) == main else KEEP_OUTSIDE) * best for p in fused}
    # Without any unlinked text nothing but what has no ratio at all could be kept.
    return {p for p, ratio in fused.items() if ratio >= least[p]}


def taking_part(page: Blocks) -> list[tuple]:
    """The blocks that are in no marked part, wrappers excepted."""
    if not page.marked:
        return page.found
    # Unlinked characters, and those in content, of each part with the parts in it; the last
    # place is the page (number -1). A part has a larger number than the one around it.
    size, inside = ([0] * (len(page.marked) + 1) for _ in range(2))
    for _, content, linked, in_content, part in page.found:
        size[part] += len(content) - linked
        inside[part] += (len(content) - linked) * in_content
    only, outside = inside[-1] == 0, size[-1]
    for i in range(len(page.marked) - 1, -1, -1):
        size[page.marked[i][0]] += size[i]
        inside[page.marked[i][0]] += inside[i]
    for kinds in ((MARKED,), (MARKED, MARKED_ADDED)):
        apart = []
        for i, (around, kind) in enumerate(page.marked):
            holds = only and 0 < inside[i] == inside[-1] and size[i] > outside
            wrapper = kind in kinds and (2 * size[i] > size[-1] or holds)
            apart.append(around >= 0 and apart[around] or not wrapper)
        left = [x for x in page.found if x[4] < 0 or not apart[x[4]]]
        if any(len(content) > linked for _, content, linked, *_ in left):
            return left
    return page.found


def main_text(page: str | None) -> str:
    blocks = taking_part(Blocks(page or ""))
    if any(x[3] for x in blocks):
        blocks = [x for x in blocks if x[3]]
    paths = kept_paths(blocks)
    return " ".join([content for path, content, *_ in blocks if path in paths])


def extract(page: Column) -> Column:
    """The main text of a page of HTML."""

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(x) for x in pages], dtype="object")

    return of(page)
