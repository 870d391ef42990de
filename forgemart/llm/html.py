"""Main text of web pages by minimum cut.

A page is read into blocks of text; blocks in a row under the same elements form a node. A node's classifier cost
is a capacity: to the source if it looks like content, to the sink if it looks like boilerplate. Neighbours in page
order and nodes close in the document tree are joined by smoothness edges. The minimum cut between source and sink
labels all nodes at the least total cost. Pages are independent, so each is labelled where it is read.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "page_id long, url string, text string, n_chars long"

# Fixed lists of elements.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead title tr ul head iframe".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template svg math head title iframe object canvas select option textarea button audio video map datalist".split())
BOILERPLATE = frozenset("nav footer aside form menu dialog".split())
MAIN = frozenset("article main".split())
# An open element of these is ended by the start of another.
ENDED_BY = {
    "p": BLOCKS - {"body", "html", "head", "title"},
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "td": frozenset({"td", "th", "tr", "tbody"}),
    "th": frozenset({"td", "th", "tr", "tbody"}),
    "tr": frozenset({"tr", "tbody"}),
    "option": frozenset({"option"}),
}
CONTAINERS = frozenset("ul ol dl table article section div main body nav aside footer header form".split())
BAD_NAMES = re.compile(
    r"(?:^|[-_\s])(?:nav|navbar|navigation|menu|header|masthead|footer|sidebar|aside|ads?|adverts?|advertisement|banner|promo"
    r"|promotion|sponsor(?:ed)?|cookies?|consent|gdpr|notices?|popup|modal|newsletter|subscribe|subscription|share|sharing"
    r"|social|comments?|replies|reply|disqus|related|recommended|breadcrumbs?|pagination|pager|widget|login|signup|search"
    r"|toolbar|skip|copyright|legal)(?:$|[-_\s])"
)
GOOD_NAMES = re.compile(r"(?:^|[-_\s])(?:article|content|post|entry|story|main|body|text|prose)(?:$|[-_\s])")
_LAYOUT = re.compile(r"(?:with|without|has|no)[-_]\w+")

HARD, STRONG, ADJACENT, CLOSE = 1000.0, 8.0, 0.5, 1.0


class _Reader(HTMLParser):
    """Collects (text, linked characters, elements around) per block of text, in page order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int, float]] = []  # tag, number of the element, its cost
        self.blocks: list[tuple[str, int, tuple]] = []
        self.parts: list[str] = []
        self.linked = self.number = self.skipped = self.links = 0

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            around = tuple(x for x in self.stack if x[0] in BLOCKS or x[2])
            self.blocks.append((text, self.linked, around))
        self.parts, self.linked = [], 0

    def _pop(self) -> None:
        tag = self.stack.pop()[0]
        self.skipped -= tag in SKIPPED
        self.links -= tag == "a"

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.parts.append(" ")
        if tag in BLOCKS:
            self.flush()
        for depth in range(len(self.stack) - 1, -1, -1):
            above = self.stack[depth][0]
            if tag in ENDED_BY.get(above, ()):
                while len(self.stack) > depth:
                    self._pop()
                break
            if above in CONTAINERS:
                break
        if tag in VOID:
            return
        self.number += 1
        self.stack.append((tag, self.number, _cost(tag, dict(attrs))))
        self.skipped += tag in SKIPPED
        self.links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)  # HTML ignores the slash

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if any(x[0] == tag for x in self.stack):
            while self.stack[-1][0] != tag:
                self._pop()
            self._pop()

    def handle_data(self, data: str) -> None:
        if not self.skipped:
            self.parts.append(data)
            if self.links:
                self.linked += len(data)


def _cost(tag: str, attrs: dict) -> float:
    """What an element says about the text in it: above zero for content."""
    style = (attrs.get("style") or "").replace(" ", "").lower()
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style:
        return -HARD
    if tag in BOILERPLATE:
        return -HARD
    role = (attrs.get("role") or "").lower()
    if role in ("navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu"):
        return -HARD
    if tag in MAIN or role in ("main", "article"):
        return STRONG
    if tag in ("html", "body"):
        return 0.0
    names = _LAYOUT.sub(" ", f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower())
    if GOOD_NAMES.search(names) and not BAD_NAMES.search(names):
        return STRONG / 2
    if BAD_NAMES.search(names):
        return -HARD
    return -STRONG / 2 if tag == "header" else 0.0


def minimum_cut(capacities: dict[int, dict[int, float]], source: int, sink: int) -> set[int]:
    """The nodes on the source's side of a minimum cut, by shortest augmenting paths."""
    left: dict[int, dict[int, float]] = {}
    for a, edges in capacities.items():
        for b, c in edges.items():
            left.setdefault(a, {})[b] = left.get(a, {}).get(b, 0.0) + c
            left.setdefault(b, {}).setdefault(a, 0.0)
    while True:
        came, queue = {source: source}, deque([source])
        while queue and sink not in came:
            a = queue.popleft()
            for b, c in left.get(a, {}).items():
                if c > 1e-9 and b not in came:
                    came[b] = a
                    queue.append(b)
        if sink not in came:
            return set(came)
        path, b = [], sink
        while b != source:
            path.append((came[b], b))
            b = came[b]
        flow = min(left[a][b] for a, b in path)
        for a, b in path:
            left[a][b] -= flow
            left[b][a] += flow


def main_text(page: str | None) -> str:
    """The blocks labelled content, one per line; empty if there are none."""
    reader = _Reader()
    reader.feed(page or "")
    reader.close()
    reader.flush()
    nodes: list[dict] = []
    for text, linked, around in reader.blocks:
        # The block's own element apart, unless it is a container of text itself.
        place = around[:-1] if around and around[-1][0] not in CONTAINERS else around
        if not nodes or nodes[-1]["place"] != place:
            nodes.append({"place": place, "texts": [], "chars": 0, "linked": 0, "costs": [c for *_, c in around]})
        node = nodes[-1]
        node["texts"].append(text)
        node["chars"] += len(text)
        node["linked"] += linked
    source, sink = -1, -2
    graph: dict[int, dict[int, float]] = {source: {}, sink: {}}
    anywhere = any(c >= STRONG for n in nodes for c in n["costs"])
    for k, node in enumerate(nodes):
        cost = sum(node["costs"])
        if min(node["costs"], default=0) > -HARD:
            share = node["linked"] / node["chars"]
            cost += min(node["chars"] / 100, 3.0) - 6.0 * share + 0.1
            if anywhere and max(node["costs"], default=0) < STRONG / 2:
                cost -= STRONG  # outside the article that the page has
        graph[source if cost > 0 else k] = graph.get(source if cost > 0 else k, {})
        graph[source if cost > 0 else k][k if cost > 0 else sink] = abs(cost)
    for k in range(1, len(nodes)):
        a, b = nodes[k - 1]["place"], nodes[k]["place"]
        shared = sum(1 for x, y in zip(a, b) if x == y)
        weight = ADJACENT + CLOSE * shared / max(len(a), len(b), 1)
        for x, y in ((k - 1, k), (k, k - 1)):
            edges = graph.setdefault(x, {})
            edges[y] = edges.get(y, 0.0) + weight
    kept = minimum_cut(graph, source, sink)
    return "\n".join(text for k, node in enumerate(nodes) if k in kept for text in node["texts"])


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Null and empty pages, and pages without content, give an empty text. Repeated rows give repeated rows; null ids
    and urls stay null. Other columns are not read.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = [main_text(p) for p in frame["html"]]
            yield pd.DataFrame(
                {
                    "page_id": frame["page_id"].astype("Int64"),
                    "url": frame["url"],
                    "text": texts,
                    "n_chars": [len(t) for t in texts],
                }
            )

    return pages.select("page_id", "url", "html").mapInPandas(run, SCHEMA)
