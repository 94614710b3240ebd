"""Operator 1: main text of web pages by composite text density.

Every page is parsed into a tree of block elements (inline markup is text).
After elements that say themselves that they are no article text are taken out
(navigation, footers, scripts, forms, adverts, comments ...; but not the nodes
round the article, and not those that hold most of the page's text, see
``_keep``), every node gets
its *composite density*: characters per tag, weighed down by the share of
characters and tags that belong to links. A node's *density sum* adds up the
densities of its children; the node with the largest sum holds the main text.
The smallest density on its path to the body is the threshold: siblings along
the path, outside the chosen subtree, belong to the text as far as they reach
it, and an ``article`` or ``main`` element around the chosen node is taken
whole.

Defined results: a null or empty page has empty text, so does one without
text; broken markup never fails (a tag cut off at the end is dropped, open
elements end with their parent, the content of scripts and the like is never
taken for markup); pages of any length and depth are parsed in
one linear pass; repeated rows give repeated results.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element and attribute names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul".split())
RAW = frozenset("script style noscript template textarea title iframe object svg math head select button "
                "canvas audio video map".split())
# The content of these is no markup: it ends at the next end tag of the same name.
PLAIN = {n: re.compile(rf"</{n}(?=[\s/>])", re.I) for n in ("script", "style", "title", "textarea", "iframe")}
UNWANTED = frozenset("nav footer aside form menu dialog fieldset".split())
WRAPPERS = frozenset("form fieldset".split())       # of these, the ones that can stand round a whole page
# A start tag of the key ends an open element of the value, up to the nearest element of the second value.
_LISTS = frozenset(("ul", "ol", "menu", "dir"))
_TABLE = frozenset(("table",))
ENDS = {
    "li": (("li",), _LISTS), "dt": (("dt", "dd"), frozenset(("dl",))), "dd": (("dt", "dd"), frozenset(("dl",))),
    "td": (("td", "th"), _TABLE), "th": (("td", "th"), _TABLE), "tr": (("tr",), _TABLE),
    "tbody": (("tbody", "thead", "tfoot"), _TABLE), "thead": (("tbody", "thead", "tfoot"), _TABLE),
    "tfoot": (("tbody", "thead", "tfoot"), _TABLE),
}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Words of class, id and role values that mark page furniture.
FURNITURE = frozenset(
    "ad ads adv advert advertisement advertising adbox adslot sponsor sponsored promo promotion banner "
    "nav navbar navigation menu breadcrumb breadcrumbs pager pagination toolbar topbar masthead header footer "
    "sidebar aside widget complementary contentinfo search related recommended teaser "
    "comment comments commentlist respond reply replies discussion disqus feedback "
    "cookie cookies consent gdpr notice notification alert popup modal overlay dialog disclaimer "
    "newsletter subscribe subscription signup login form share sharing social skip".split())

# Words that say nothing of what is in an element: with furniture words alone beside them it is furniture.
PLAIN_NAMES = frozenset(
    "box button buttons post posts article articles link links list lists container wrapper wrap slot unit bar block "
    "section area panel pane row col column inner outer content item items icon icons group main top bottom left "
    "right side site page primary secondary global mobile desktop sticky fixed floating inline text title heading "
    "label image img logo card cards module component region zone holder frame more".split())

COMMENTS = frozenset("comment comments commentlist respond reply replies discussion disqus feedback".split())
# With one of these a value tells what a page has, not what the element is: "has-sidebar", "comments-open".
STATES = frozenset("has have no not with without open opened closed enabled disabled off hide hides".split())
# What an element's own markup says of it: article text, a furniture word among others, furniture by name,
# furniture by element or hidden, reader comments.
CLEAN, MENTIONS, NAMED, NEVER, READERS = range(5)
# Share of the page's text that lets a marked node stay.
MOST = {MENTIONS: 0.5, NAMED: 0.9}

_MARKUP = re.compile(
    r"<!--(?:.*?--!?>|.*\Z)|<[!?][^>]*+(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z))*+)(>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _furniture(tag: str, attributes: str) -> int:
    """How far does the element itself say that it is no article text?"""
    mark = CLEAN if tag not in UNWANTED else MENTIONS if tag in WRAPPERS else NEVER
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            mark = max(mark, NEVER)
        elif name == "style":
            if _HIDDEN.search(value):
                mark = max(mark, NEVER)
        elif name != "aria-hidden":
            for part in value.split():
                words = [w.lower() for w in _WORDS.findall(part)]
                found = FURNITURE.intersection(words)
                if not found:
                    continue
                if not STATES.isdisjoint(words):
                    mark = max(mark, MENTIONS)
                elif not COMMENTS.isdisjoint(found):
                    mark = READERS
                else:
                    told = {w for w in words if len(w) > 1} - PLAIN_NAMES
                    mark = max(mark, NAMED if found.issuperset(told) else MENTIONS)
    return mark


class _Tree:
    """Block elements in page order: parallel lists, children after parents."""

    def __init__(self) -> None:
        self.tag: list[str] = []
        self.parent: list[int] = []
        self.mark: list[int] = []
        self.chars: list[int] = []
        self.link_chars: list[int] = []
        self.tags: list[int] = []
        self.link_tags: list[int] = []
        self.blocks: list[tuple[int, str]] = []      # (node, text) in page order

    def add(self, tag: str, parent: int, mark: int) -> int:
        for values, v in ((self.tag, tag), (self.parent, parent), (self.mark, mark), (self.chars, 0),
                          (self.link_chars, 0), (self.tags, 0), (self.link_tags, 0)):
            values.append(v)
        return len(self.tag) - 1


def _parse(page: str) -> _Tree:
    tree = _Tree()
    root = tree.add("body", -1, CLEAN)
    path = [root]
    depths: dict[str, list[int]] = {}      # where on the path the open elements of a name are
    open_links = 0
    raw = ""              # inside this element everything is skipped
    raw_depth = 0
    text: list[str] = []
    at = 0
    endless: set[str] = set()      # plain elements with no further end tag

    def end_block() -> None:
        if text:
            line = " ".join("".join(text).split())
            text.clear()
            if line:
                tree.blocks.append((path[-1], line))

    def take(piece: str) -> None:
        if piece and not raw:
            piece = html.unescape(piece) if "&" in piece else piece
            text.append(piece)
            n = len("".join(piece.split()))
            node = path[-1]
            tree.chars[node] += n
            if open_links:
                tree.link_chars[node] += n

    def close_to(depth: int) -> None:
        nonlocal open_links
        end_block()
        for node in path[depth:]:
            depths[tree.tag[node]].pop()
        del path[depth:]
        open_links = 0

    def innermost(tags) -> int:
        return max((depths[t][-1] for t in tags if depths.get(t)), default=0)

    while m := _MARKUP.search(page, at):
        if m.start() > at:
            take(page[at:m.start()])
        at = m.end()
        if m[2] is None or not m[4]:
            continue
        tag, closing = m[2].lower(), m[1]
        if tag in PLAIN and not closing and tag not in endless and not m[3].rstrip().endswith("/"):
            end = PLAIN[tag].search(page, at)
            if end:
                at = end.start()
                if raw and raw != tag:
                    continue
            else:
                endless.add(tag)
        if raw:
            if tag == raw:
                raw_depth += -1 if closing else (tag not in ("script", "style", "title", "textarea"))
                if raw_depth <= 0:
                    raw = ""
            elif raw == "head" and tag == "body":
                raw = ""
            continue
        if tag in RAW:
            if not closing and not m[3].rstrip().endswith("/"):
                raw, raw_depth = tag, 1
            continue
        if tag == "a":
            open_links = 0 if closing else 1
            if not closing:
                tree.tags[path[-1]] += 1
                tree.link_tags[path[-1]] += 1
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in BLOCK:
            continue
        if tag in ("html", "body"):
            end_block()
            continue
        if closing:
            if depths.get(tag):
                close_to(depths[tag][-1])
            else:
                end_block()
            continue
        end_block()
        if tag in ENDS:
            ended, within = ENDS[tag]
            depth = innermost(ended)
            if depth > innermost(within):
                close_to(depth)
        elif path[-1] != root:
            last = tree.tag[path[-1]]
            if last == "p" or (tag in HEADINGS and last in HEADINGS):
                close_to(len(path) - 1)
        if tag in VOID:
            continue
        node = tree.add(tag, path[-1], _furniture(tag, m[3]))
        depths.setdefault(tag, []).append(len(path))
        path.append(node)
        open_links = 0
    if at < len(page):
        take(page[at:])
    end_block()
    return tree


def _keep(tree: _Tree) -> list[bool]:
    """Which nodes stay: page furniture goes, unless the article is inside it.

    The article is in the unmarked ``article`` and ``main`` elements outside furniture and comments; if there are
    none, in those outside comments; if there are none either, a marked node that holds most of the page's text
    without links (``MOST``) stays. Inside an article a name that only mentions furniture ("share-price") goes if a third
    of its text is links. If nothing is left of the page, furniture by word stays, then comments do.
    """
    n = len(tree.tag)
    mark = tree.mark[:]
    inside = [False] * n          # below an article or main
    worst = [CLEAN] * n           # of the node and all around it
    around = [CLEAN] * n          # of all around it
    for i in range(1, n):
        p = tree.parent[i]
        inside[i] = inside[p] or tree.tag[p] in ("article", "main")
        if tree.tag[i] == "header" and not inside[i]:
            mark[i] = max(mark[i], NAMED)
        around[i] = worst[p]
        worst[i] = max(worst[p], mark[i])
    named = [i for i in range(n) if tree.tag[i] in ("article", "main")]
    articles = [i for i in named if mark[i] == CLEAN and around[i] <= MENTIONS]
    if not articles:
        articles = [i for i in named if worst[i] < READERS]
    holds = [False] * n
    for i in articles:
        holds[i] = True
    mass, whole = [c - lc for c, lc in zip(tree.chars, tree.link_chars)], tree.chars[:]
    for i in range(n - 1, 0, -1):
        p = tree.parent[i]
        whole[p] += whole[i]
        holds[p] = holds[p] or holds[i]
        if mark[i] < NEVER:
            mass[p] += mass[i]
    for fallback in ((), (MENTIONS, NAMED), (MENTIONS, NAMED, READERS)):
        stays = [True] * n
        for i in range(1, n):
            most = not articles and mark[i] in MOST and mass[i] > MOST[mark[i]] * mass[0]
            # a name such as "share-price" inside the article: its text decides
            own = mark[i] == MENTIONS and inside[i] and 3 * mass[i] >= 2 * whole[i]
            stays[i] = stays[tree.parent[i]] and (holds[i] or mark[i] == CLEAN or mark[i] in fallback or most or own)
        if any(c and s for c, s in zip(tree.chars, stays)):
            break
    return stays


def main_text(page: str | None) -> str:
    """The article of a page: blocks joined by an empty line."""
    if not page:
        return ""
    tree = _parse(page)
    if not tree.blocks:
        return ""
    stays = _keep(tree)
    n = len(tree.tag)
    chars = [c if s else 0 for c, s in zip(tree.chars, stays)]
    link_chars = [c if s else 0 for c, s in zip(tree.link_chars, stays)]
    tags = [c if s else 0 for c, s in zip(tree.tags, stays)]
    link_tags = [c if s else 0 for c, s in zip(tree.link_tags, stays)]
    for i in range(n - 1, 0, -1):
        if stays[i]:
            p = tree.parent[i]
            chars[p] += chars[i]
            link_chars[p] += link_chars[i]
            tags[p] += tags[i] + 1
            link_tags[p] += link_tags[i]
    link_share = link_chars[0] / max(1, chars[0])

    def density(i: int) -> float:
        c, lc, t, lt = chars[i], link_chars[i], max(1, tags[i]), max(1, link_tags[i])
        if not c:
            return 0.0
        base = math.log(c / max(1, c - lc) * lc + link_share * c + math.e)
        return c / t * math.log(max(1.0, c / max(1, lc) * t / lt)) / max(1.0, math.log(base))

    dense = [density(i) if s else 0.0 for i, s in enumerate(stays)]
    sums = [0.0] * n
    for i in range(1, n):
        sums[tree.parent[i]] += dense[i]
    best = max(range(n), key=lambda i: (sums[i], -i))
    if sums[best] == 0.0:
        best = 0
    taken = [False] * n
    path = [best]
    while path[-1] > 0:
        path.append(tree.parent[path[-1]])
    around = next((i for i in path if tree.tag[i] in ("article", "main")), best)
    threshold = min(dense[i] for i in path)
    on_path = set(path)
    for i in range(n):
        p = tree.parent[i]
        if i == around or (i and taken[p]):
            taken[i] = stays[i]
        elif i and around == best and p in on_path and i not in on_path:
            linked = link_chars[i] * 3 > chars[i]
            taken[i] = stays[i] and not linked and (dense[i] >= threshold or tree.tag[i] == "h1")
    own = around == 0 or any(taken)
    return "\n\n".join(line for node, line in tree.blocks if stays[node] and (taken[node] or not own))


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                  html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [main_text(h) for h in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.col(html_col).cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
