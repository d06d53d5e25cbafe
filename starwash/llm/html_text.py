"""HTML extraction by minimum-cut labelling.

A page is cut into text blocks (at block-level tags). A linear classifier gives each
block a log-odds of being content, from its surrounding tags, class and id words,
link share and text form; its size is the block's terminal capacity, to the content
or to the boilerplate side. Blocks next to each other, and blocks of one DOM parent, are
joined by smoothness edges, weaker across a change of zone. The minimum cut
separates content from boilerplate: first blocks whose own capacity outweighs all
edges that are still open get their label (which every minimum cut gives them) and
pass it on to their neighbours' capacities; what is left is solved by
augmenting paths.

The classifier is a logistic regression kept near prior weights, fitted on a
hash sample of about ``sample_pages`` whole pages. Labels come from the pages' own
semantic tags; each block is used once with and once without its tag and class
features, so that it learns text form, too, for pages without such tags.

Pages are independent: extraction is one narrow pass in Arrow batches.

Defined cases: null and empty html give an empty text; unclosed tags, cut-off pages
and unknown character references are read as far as they go; a page without
content blocks gives an empty text; an empty table uses the prior weights.
Output columns (text, n_chars) replace input columns of the same name.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starwash.llm.common import small_batches
from starwash.llm.linear import DenseRows, descend, sigmoid

# as HTML reads tags: quotes count only after "=", an unquoted value ends at white space or ">"
_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s>]*)"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|[^\s/>][^\s/>=]*(?:\s*=\s*{_VALUE})?)*)(?:>|\Z)|<[!?][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_UNQUOTED_END = re.compile(r"""=\s*[^\s"'>][^\s>]*\Z""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDING = re.compile(r"(?<![\w-])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
#: class tokens that begin so tell of a part elsewhere in the page
_TELLS = re.compile(r"(?:^|\s)(?:has|with|without|no|layout)[-_]\S*", re.I)

#: fixed values: how HTML treats elements
SKIPPED = frozenset("script style noscript template svg annotation annotation-xml iframe object canvas head title select textarea audio video".split())
RAW = frozenset("script style title textarea noscript iframe".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead tr ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: zones by tag, hints by words of class, id and role
ZONES = {"article": "article", "main": "article", "nav": "nav", "menu": "nav", "footer": "footer", "aside": "aside", "form": "form",
         "button": "form", "label": "form", "fieldset": "form", "dialog": "notice"}
HINTS = {
    "ad": "ad ads advert advertisement adbox sponsor sponsored promo promotion banner",
    "nav": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar tabs",
    "aside": "sidebar side widget related recommended share social tags toc",
    "notice": "cookie cookies consent notice gdpr alert popup modal overlay newsletter subscribe signup login paywall disclaimer",
    "comments": "comment comments disqus replies reply respond discussion",
    "footer": "footer foot copyright legal colophon",
    "top": "header masthead topbar logo branding",
    "content": "article content main post entry story",
}
_HINT_OF = {word: hint for hint, words in HINTS.items() for word in words.split()}
BAD = ("nav", "footer", "aside", "form", "ad", "notice", "comments", "top")

#: features and the prior weights that the fit stays near
PRIOR = {
    "bias": -0.3, "article": 3.0, "content": 1.5, "nav": -6.0, "footer": -5.5, "aside": -5.0, "form": -5.5, "ad": -6.5, "notice": -6.0,
    "comments": -6.5, "top": -4.5, "hidden": -6.5, "heading": 0.4, "paragraph": 0.8, "item": -0.3, "links_some": -0.7, "links_most": -2.0,
    "short": -0.6, "long": 1.0, "sentence": 0.5, "copyright": -1.5,
}
FEATURES = tuple(PRIOR)
_TAG_FEATURES = frozenset(("article", "content", "hidden", *BAD))


def hides(attributes: list[tuple[str, str]]) -> bool:
    """The attribute, a class of that name, or a style that hides the element; not overflow-hidden."""
    return any(name == "hidden" or (name == "class" and "hidden" in value.lower().split()) or (name == "style" and bool(_HIDING.search(value)))
               or (name == "aria-hidden" and value.strip().lower() == "true") for name, value in attributes)


def blocks_of(page: str) -> list[tuple[str, frozenset, int]]:
    """(text, features, parent) of every text block, in page order."""
    out: list = []
    # open elements: (tag, zone, node, skipped); a zone is the number of the nearest element with zones or hints
    stack = [("", 0, 0, False)]
    opened: Counter = Counter()
    text: list[str] = []
    linked = size = nodes = links = total = 0
    # of each zone: the one around it, the zones so far, its own hints, and the characters of blocks in it
    around, zones, hints, held = [0], [frozenset()], [()], [0]

    def flush():
        nonlocal text, linked, size, total
        if text:
            whole = " ".join(entities.unescape("".join(text)).split())
            if whole:
                out.append((whole, describe(whole, linked / max(size, 1)), parent(), stack[-1][1]))
                total += len(whole)
        text, linked, size = [], 0, 0

    def parent():
        for tag, _, node, _ in reversed(stack):
            if tag in BLOCK and tag not in ("p", "li") and not (len(tag) == 2 and tag[0] == "h"):
                return node
        return 0

    def describe(whole, share):
        tags = {t for t, *_ in stack[-4:]}
        found = set()
        words = whole.count(" ") + 1
        if tags & {"h1", "h2", "h3", "h4", "h5", "h6"}:
            found.add("heading")
        if "p" in tags:
            found.add("paragraph")
        if "li" in tags:
            found.add("item")
        if share > 0.6:
            found.add("links_most")
        elif share > 0.25:
            found.add("links_some")
        if words < 4:
            found.add("short")
        elif words >= 25:
            found.add("long")
        if whole[-1] in ".!?…":
            found.add("sentence")
        if "©" in whole or "(c)" in whole:
            found.add("copyright")
        return frozenset(found)

    def close_to(k):
        nonlocal links
        for j in range(len(stack) - 1, k - 1, -1):
            tag, zone, *_ = stack[j]
            opened[tag] -= 1
            links -= tag == "a"
            if zone != stack[j - 1][1]:  # what has come since it was opened
                held[zone] += total
        del stack[k:]

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        piece = page[at : m.start()] if m else page[at:]
        if piece and not stack[-1][3]:
            text.append(piece)
            size += len(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        if m.group(2) is None:
            continue
        tag = m.group(2).lower()
        if m.group(1):  # a closing tag
            if tag in BLOCK:
                flush()
            for k in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[k][0] == tag:
                    close_to(k)
                    break
                if stack[k][0] in BLOCK and tag not in BLOCK:
                    break  # an inline end tag does not close blocks
            continue
        if tag in ("br", "hr", "wbr"):
            if tag == "hr":
                flush()
            elif tag == "br":
                text.append(" ")
            continue
        if tag in VOID:
            continue
        if tag in BLOCK:
            flush()
            closes = CLOSES.get(tag, ())
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == "p" or stack[k][0] in closes:
                    close_to(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        _, zone, _, skipped = stack[-1]
        added, own = {ZONES[tag]} if tag in ZONES else set(), []
        if tag == "header" and "article" not in zones[zone]:
            added.add("top")
        if m.group(3).strip(" /"):
            attributes = [(name.lower(), "".join(values)) for name, *values in _ATTRIBUTE.findall(m.group(3))]
            for name, value in attributes:
                if name in ("class", "id", "role"):
                    own += (_HINT_OF[w] for w in map(str.lower, _WORD.findall(_TELLS.sub(" ", value))) if w in _HINT_OF)
            if hides(attributes):
                added.add("hidden")
        if tag in ("html", "body"):  # their classes name the kind of page, not a zone
            added, own = set(), []
        nodes += 1
        if tag not in RAW and tag not in BLOCK and m.group(3).rstrip().endswith("/") and not _UNQUOTED_END.search(m.group(3)):
            continue
        if added or own:
            around.append(zone)
            zones.append(zones[zone] | added)
            hints.append(tuple(own))
            held.append(-total)
            zone = len(around) - 1
        stack.append((tag, zone, nodes, skipped or tag in SKIPPED))
        opened[tag] += 1
        links += tag == "a"
        if tag in RAW:  # up to its end tag, whatever stands there
            close = re.compile(f"</{tag}\\b", re.I).search(page, at)
            at = close.start() if close else end
    flush()
    close_to(1)
    # an element with most of the page's text is no zone of it, whatever its classes say; a thread of comments can be that long
    most, settled = 0.5 * total, [frozenset()]
    for k in range(1, len(around)):
        settled.append(settled[around[k]] | {h for h in hints[k] if h in ("content", "comments") or held[k] <= most})
    return [(whole, found | zones[zone] | settled[zone], node) for whole, found, node, zone in out]


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """The side of each node (True: source) that minimises cut terminals and edges."""
    n = len(odds)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for i, j, w in edges:
        near[i][j] = near[i].get(j, 0.0) + w
        near[j][i] = near[j].get(i, 0.0) + w
    own, side = list(odds), [None] * n
    open_weight = [sum(x.values()) for x in near]
    ready = deque(range(n))
    while ready:  # a capacity that outweighs all open edges decides
        i = ready.popleft()
        if side[i] is not None or abs(own[i]) < open_weight[i] or (own[i] == 0 and near[i]):
            continue
        side[i] = own[i] > 0
        for j, w in near[i].items():
            if side[j] is None:
                own[j] += w if side[i] else -w
                open_weight[j] -= w
                ready.append(j)
    rest = [i for i in range(n) if side[i] is None]
    if rest:
        source, sink = n, n + 1
        room: dict[int, dict[int, float]] = {i: {j: w for j, w in near[i].items() if side[j] is None} for i in rest}
        room[source], room[sink] = {}, {}
        for i in rest:
            a, b = (source, i) if own[i] > 0 else (i, sink)
            room[a][b] = abs(own[i])
            room[b].setdefault(a, 0.0)
        while True:  # shortest augmenting paths
            before, line = {source: source}, deque([source])
            while line and sink not in before:
                i = line.popleft()
                for j, w in room[i].items():
                    if w > 1e-9 and j not in before:
                        before[j] = i
                        line.append(j)
            if sink not in before:
                break
            path, j = [], sink
            while j != source:
                path.append((before[j], j))
                j = before[j]
            flow = min(room[a][b] for a, b in path)
            for a, b in path:
                room[a][b] -= flow
                room[b][a] = room[b].get(a, 0.0) + flow
        for i in rest:
            side[i] = i in before
    return side


def extract(page: str | None, weights: dict[str, float], smooth: float = 0.8) -> str:
    """The main text of one page."""
    blocks = blocks_of(page) if page else []
    if not blocks:
        return ""
    odds = [max(-8.0, min(8.0, weights["bias"] + sum(weights[f] for f in b[1]))) for b in blocks]
    zone = [b[1] & _TAG_FEATURES for b in blocks]
    edges, last = [], {}
    for k, (_, _, parent) in enumerate(blocks):
        if k:
            edges.append((k - 1, k, smooth if zone[k - 1] == zone[k] else 0.2 * smooth))
        if parent in last and last[parent] != k - 1:
            edges.append((last[parent], k, 0.5 * smooth if zone[last[parent]] == zone[k] else 0.1 * smooth))
        last[parent] = k
    return "\n\n".join(b[0] for b, content in zip(blocks, minimum_cut(odds, edges)) if content)


def fit(pages: list[str], l2: float = 0.02) -> dict[str, float]:
    """Weights near the prior, from the semantic tags of the pages."""
    rows, y = [], []
    for page in pages:
        for _, found, _ in blocks_of(page):
            bad = any(f in found for f in BAD) or "hidden" in found
            if bad or "article" in found:
                for seen in (found, found - _TAG_FEATURES):
                    rows.append([f == "bias" or f in seen for f in FEATURES])
                    y.append(not bad)
    prior = np.array(list(PRIOR.values()))
    if not rows or len(set(y)) < 2:
        return dict(PRIOR)
    x, y = np.array(rows, float), np.array(y, float)
    offset, weight = x @ prior, 1 / len(y)
    w, _ = descend(DenseRows(x), lambda z: weight * (sigmoid(z + offset) - y), l2, 200, 0.25 * weight, 0.0)
    # the free intercept of the fit belongs to the sample's mix, not to the prior's scale: it is left out
    return dict(zip(FEATURES, (prior + w).tolist()))


def train(pages: DataFrame, sample_pages: int = 400, html_col: str = "html") -> dict[str, float]:
    """Fit on a hash sample of about ``sample_pages`` whole pages (never more than twice that)."""
    total = pages.count()
    share = 1.0 if total <= sample_pages else sample_pages / total
    text = F.col(html_col).cast("string")
    pick = F.pmod(F.xxhash64(F.lit(17), text), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = pages.select(text.alias("h")).filter(text.isNotNull() & pick).distinct().limit(2 * sample_pages).toPandas()
    return fit(sorted(sample["h"]))


def main_text(pages: DataFrame, weights: dict[str, float], html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``."""
    small_batches(pages.sparkSession)

    @F.pandas_udf("string")
    def content(page: pd.Series) -> pd.Series:
        return page.map(lambda p: extract(p if isinstance(p, str) else None, weights))

    return pages.withColumn("text", content(F.col(html_col).cast("string"))).withColumn("n_chars", F.length("text").cast("long"))
