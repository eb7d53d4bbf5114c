"""HTML extraction by minimum-cut labelling.

A page becomes blocks of text in page order. A classifier scores each block from its length,
its share of link text, its punctuation and the tags, classes and ids around it; the score is
the capacity of the block's edge to the source (content) or the sink (boilerplate). Edges
between neighbouring blocks, and between blocks that share a close ancestor, hold labels
together. The minimum cut, found by augmenting paths, parts content from boilerplate.

Scripts, styles, markup, comments, forms and hidden parts never become blocks. Character
references are decoded, white space in a block becomes one space, and content blocks are
joined by one space in page order. A form around an article or around parts of a page loses
its controls and labels only. Bad names at or above an outermost <main>, or at or above an
outermost <article> of a page without clean ones, do not count; nor do doubtful names inside an article when nothing else
of the page is content. Null and empty pages give an empty text. A page of any length and depth is read whole, in time
that grows with its length. Repeated rows are worked on each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left
from collections import Counter, deque

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by their role in a page.
SKIPPED = frozenset("script style noscript template svg math iframe object head title select textarea button".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
#: Elements without text of their own that stand inside a word or line.
UNSEEN = frozenset("img input picture source embed link meta area param track script style noscript template svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset("article main".split())
BOILERPLATE = frozenset("nav footer aside menu dialog".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BAD_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|footer|header|masthead|side-?bar|widget\w*|"
    r"cookie\w*|consent|notice\w*|popup|modal|newsletter|subscri\w*|social|shar(?:e|ing)|related|recommend\w*|comments?|repl(?:y|ies)|"
    r"disqus|discussion|responses?|login|signup|search|pagination|pager|toolbar|skip|legal|copyright)(?:[^a-z]|$)")
GOOD_WORDS = re.compile(r"(?:^|[^a-z])(?:article\w*|content|main|body|post|story|entry|text)(?:[^a-z]|$)")

#: Quotes hold a ``>`` only after an equals sign; nothing is matched twice.
TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                   r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')|[\"'=])*+)(?:>|\Z)", re.S)
QUOTED = re.compile(r"\"[^\"]*\"|'[^']*'")
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
#: Tokens that tell of the page's state or layout, not of what the element holds.
STATE = re.compile(r"(?:has|have|no|with|without|is|show|hide)[-_].*|.*[-_](?:open|opened|closed|enabled|disabled|on|off|active|visible)")
IDS = re.compile(r"(?:^|\s)id\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
#: Bad words that are no subject of a section of an article.
CLEAR = re.compile(r"(?:^|[^a-z])(?:ads?|advert\w*|sponsor\w*|comments?|disqus|side-?bar|widget\w*|newsletter|subscri\w*|login|signup|pager|pagination)(?:[^a-z]|$)")
FORM_END = re.compile(r"</form\s*>", re.I)
#: Elements that make a form around them a wrapper of the page.
WRAPPED = re.compile(r"<(?:article|main|h1|header|footer|nav|aside)[\s>/]", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
HIDDEN_FLAG = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)

#: Weights of the classifier; a positive score speaks for content.
BIAS, LONG, LINKED, ENDS, GOOD, BAD, HEADING, OUTSIDE = 0.2, 0.5, 3.5, 0.6, 4.0, 6.0, 0.8, 3.0
#: For a section of an article of which only the id is bad: long paragraphs stay.
WEAK = 5.5
#: Capacities of the edges between neighbours, and between blocks with a near common ancestor,
#: lowered by their difference in link text and by other names around them.
NEXT, NEAR = 1.0, 0.6


class Block:
    __slots__ = ("parts", "linked", "path", "good", "bad", "heading", "under", "weak", "text", "chars")

    def __init__(self, path, good, bad, heading, under, weak):
        self.parts, self.linked = [], 0
        self.path, self.good, self.bad, self.heading = path, good, bad, heading
        self.under, self.weak = under, weak


def bad_name(tag: str, named: str, phrases: bool = True) -> bool:
    """A bad word in the names; those of an article must be one as a whole. Without ``phrases``
    names of three and more words do not count."""
    tokens = [x for x in named.split() if not STATE.fullmatch(x) and (phrases or len(re.split("[-_]+", x)) < 3)]
    if tag in CONTENT:
        return tag == "article" and any(BAD_WORDS.fullmatch(x) for x in tokens)
    return bool(BAD_WORDS.search(" ".join(tokens)))


def named_of(rest: str) -> str:
    return " ".join(a or b or c for a, b, c in NAMED.findall(rest)).lower()


def hidden(rest: str) -> bool:
    return "hidden" in rest.lower() and bool(HIDDEN_FLAG.search(QUOTED.sub("", rest))) or bool(HIDDEN.search(rest))


def blocks_of(page: str, doubtful: bool = True) -> list[Block]:
    """Blocks with text in page order. Without ``doubtful`` only CLEAR bad names count inside
    an article."""
    out: list[Block] = []
    # tag, element number, good, bad, skipped, bad names at or above an outermost article, weak,
    # place of the nearest element at or above that is no inline one
    stack: list[tuple[str, int, int, int, int, int, bool, int]] = []
    opened: Counter[str] = Counter()
    current, number, at = None, 0, 0
    form_ends = [m.start() for m in FORM_END.finditer(page)]
    wrapped = [m.start() for m in WRAPPED.finditer(page)]

    def state():
        return stack[-1] if stack else ("", 0, 0, 0, 0, 0, False, -1)

    def some(tags) -> bool:
        return any(opened[t] for t in tags)

    def pop() -> str:
        gone = stack.pop()[0]
        opened[gone] -= 1
        return gone

    def text(raw: str):
        nonlocal current
        if state()[4] or not raw:
            return
        raw = html.unescape(raw)
        if current is None:
            if not raw.strip():
                return
            _, _, good, bad, _, under, weak, _ = state()
            current = Block(tuple(e[1] for e in stack[-3:-1]), good, bad, some(HEADINGS), under, weak)
            out.append(current)
        current.parts.append(raw)
        if opened["a"]:
            current.linked += len(raw)

    while at < len(page):
        found = TOKEN.search(page, at)
        if found is None:
            text(page[at:] if not page[at:].startswith("<") else "")
            break
        text(page[at:found.start()])
        at = found.end()
        closing, tag, rest = found.group(1), found.group(2), found.group(3)
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE and tag not in UNSEEN and not state()[4]:
            current = None
        if closing:
            if opened[tag]:
                while True:
                    gone = pop()
                    if gone not in INLINE and gone not in UNSEEN:
                        current = None
                    if gone == tag:
                        break
            continue
        if tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option") or tag in HEADINGS:
            # these end an open paragraph, and an open element of their own kind beside them
            while state()[7] >= 0 and stack[state()[7]][0] in ("p", tag):
                end = state()[7]
                while len(stack) > end:
                    pop()
        number += 1
        if tag in VOID or rest.endswith("/"):
            continue
        _, _, good, bad, skipped, under, weak, outer = state()
        named = named_of(rest)
        skipped = skipped or tag in SKIPPED or (opened["form"] and tag in ("label", "legend")) or hidden(rest)
        if tag == "form":
            end = bisect_left(form_ends, at)
            end = form_ends[end] if end < len(form_ends) else len(page)
            inner = bisect_left(wrapped, at)
            skipped = skipped or inner == len(wrapped) or wrapped[inner] >= end
        in_article = some(CONTENT)
        named_bad = bool(named) and tag not in ("html", "body") and bad_name(tag, named)
        if named_bad and in_article and not doubtful and tag not in CONTENT and not CLEAR.search(named):
            named_bad = False
        if tag in CONTENT:
            bad += named_bad
            if not in_article and not some(BOILERPLATE):
                under, bad = (0, 0) if tag == "main" else (bad, bad)
            good = 0 if bad else 1 if weak else 2
        elif named_bad and good == 2 and not bad and not CLEAR.search(named) and (
                not bad_name(tag, named, False) or (tag == "section" and not bad_name(tag, named_of(IDS.sub(" ", rest))))):
            good, weak = 1, True
        elif tag in BOILERPLATE or (tag == "header" and not in_article) or named_bad:
            good, bad = 0, bad + 1
        elif named and not bad and not good and tag not in ("html", "body") and GOOD_WORDS.search(named):
            good = 1
        if tag in ("script", "style", "textarea", "title"):
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        stack.append((tag, number, good, bad, int(bool(skipped)), under, weak, outer if tag in INLINE else len(stack)))
        opened[tag] += 1
    if not any(b.good == 2 for b in out):
        for block in out:
            if block.under:
                block.bad -= block.under
                block.good = 0 if block.bad else 2
    for block in out:
        block.text = " ".join("".join(block.parts).split())
        block.chars = max(1, len(block.text))
    return [b for b in out if b.text]


def score(block: Block, marked: bool) -> float:
    """Log-odds of content; ``marked``: some block of the page stands in a content element."""
    link_share = min(1.0, block.linked / block.chars)
    out = BIAS + LONG * (math.log(block.chars) - 3.5) - LINKED * link_share
    out += ENDS * (block.text[-1] in ".!?:;\"'”…") + HEADING * block.heading * (not block.bad)
    out += GOOD * block.good - BAD * block.bad - WEAK * block.weak
    if marked and not block.good:
        out -= OUTSIDE
    return out


def min_cut(costs: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source: positive costs are capacities from it, negative ones
    to the sink. Shortest augmenting paths, searched by levels."""
    n = len(costs)
    source, sink = n, n + 1
    graph: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    cap: list[float] = []

    def link(a, b, forth, back):
        graph[a].append(len(to))
        to.append(b)
        cap.append(forth)
        graph[b].append(len(to))
        to.append(a)
        cap.append(back)

    for k, cost in enumerate(costs):
        if cost > 0:
            link(source, k, cost, 0.0)
        elif cost < 0:
            link(k, sink, -cost, 0.0)
    for a, b, weight in edges:
        link(a, b, weight, weight)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            a = queue.popleft()
            for e in graph[a]:
                if cap[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [level[k] >= 0 for k in range(n)]
        nxt = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(cap[e] for e in path)
                for e in path:
                    cap[e] -= flow
                    cap[e ^ 1] += flow
                cut = next(k for k, e in enumerate(path) if cap[e] <= 1e-9)
                node = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while nxt[node] < len(graph[node]):
                e = graph[node][nxt[node]]
                if cap[e] > 1e-9 and level[to[e]] == level[node] + 1:
                    path.append(e)
                    node = to[e]
                    break
                nxt[node] += 1
            else:
                if node == source:
                    break
                level[node] = -1
                node = to[path.pop() ^ 1]


def labelled(blocks: list[Block]) -> tuple[list[float], list[bool]]:
    """(costs, labels of the minimum cut) of the blocks of a page."""
    marked = any(b.good == 2 for b in blocks)
    costs = [score(b, marked) for b in blocks]
    edges = []
    last_under: dict[int, int] = {}

    def link(a: int, b: int, weight: float):
        one, two = blocks[a], blocks[b]
        alike = 1.0 - abs(min(1.0, one.linked / one.chars) - min(1.0, two.linked / two.chars))
        edges.append((a, b, weight * alike * (1.0 if (one.good, one.bad) == (two.good, two.bad) else 0.25)))

    for k, block in enumerate(blocks):
        if k:
            link(k - 1, k, NEXT)
        for parent in block.path:
            if parent in last_under:
                link(last_under[parent], k, NEAR)
            last_under[parent] = k
    return costs, min_cut(costs, edges)


def main_text(page: str | None) -> tuple[str, int, int]:
    """(text of the content blocks, number of them, number of all blocks)."""
    blocks = blocks_of(page or "")
    if not blocks:
        return "", 0, 0
    kept = [b.text for b, content in zip(blocks, labelled(blocks)[1]) if content]
    if not kept:
        blocks = blocks_of(page, doubtful=False)
        kept = [b.text for b, content in zip(blocks, labelled(blocks)[1]) if content]
    return " ".join(kept), len(kept), len(blocks)


def _extract(frames):
    for frame in frames:
        found = [main_text(page) for page in frame["html"]]
        yield pd.DataFrame({"page_id": frame["page_id"].astype("Int64"), "url": frame["url"], "text": [t for t, _, _ in found],
                            "n_chars": [len(t) for t, _, _ in found], "n_content": [n for _, n, _ in found],
                            "n_blocks": [n for _, _, n in found]})


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars, n_content, n_blocks) of every row of (page_id, url, html)."""
    return pages.select("page_id", "url", "html").mapInPandas(
        _extract, "page_id long, url string, text string, n_chars long, n_content int, n_blocks int")
