"""Main text of web pages by a tree-structured graphical model.

Every element of a page is a binary variable, content or not. Its own potential is the sum of the log odds of its features:
tag, words of class, id and role, length of its text, share of link text. An edge ties it to its parent. Sum-product
messages go up and down the tree once each and give every element's exact marginal; text of elements that are likelier content
than not is the page's main text.

Training. A labelled page is one with an ``article`` or ``main`` element: elements inside it are content, except below elements
whose name says otherwise, all others are not. Feature and edge counts of up to ``SAMPLE`` such pages (on average, chosen by a hash
of id and url) give the log odds, kept within ``LEARNED``, so that what a few templates happen to hold cannot outvote
the names below, which count as labelled examples of their own.

A null page is empty; a page without content has an empty text. Broken markup never fails: unknown end tags are skipped, open
elements end with the page. Rows that repeat an id are extracted one by one. Other columns are not read.
"""

from __future__ import annotations

import bisect
import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SAMPLE = 20_000
LEARNED = 1.5
TIE = 6.0

# Names that markup conventions give to what is not, or is, the main text.
NEGATIVE_TAGS = set("nav footer aside form button select option textarea input label fieldset dialog menu head script style noscript template iframe object embed svg canvas audio video title meta link".split())
POSITIVE_TAGS = {"article", "main"}
NEGATIVE_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense adsbygoogle banner sponsor sponsored promo promotion popup modal overlay "
    "cookie cookies consent gdpr notice notices alert warning sidebar side rail widget widgets menu nav navbar navigation breadcrumb breadcrumbs "
    "pager pagination footer masthead toolbar topbar comment comments commentlist reply replies respond disqus discussion share sharing social related recommended "
    "newsletter subscribe subscription signup login search toc skip hidden complementary contentinfo".split()
)
POSITIVE_NAMES = set("content article post entry story main maincontent articlebody".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg"}
BLOCK = set(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html "
    "li main menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
# An element that begins ends open ones of these tags, up to the nearest of the second list.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_THROUGH = {"p", "div", "section"}  # blocks that do not bound this search
_KEEPS_PARAGRAPH = {"br", "button", "option", "title"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<[/!?a-zA-Z][^>]*\Z", re.DOTALL)
_NAMED = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Page:
    """The elements of a page in order of their beginnings, and its text runs with the element each stands in."""

    def __init__(self, source: str) -> None:
        self.parent, self.tag, self.names = [-1], [""], [()]
        self.runs: list[tuple[int, str]] = []  # element, text; element -1 is a border between blocks
        # Open elements; of each tag their places among these; for each the place of the nearest bounding block up to it.
        self.stack, self.open, self.limits = [0], {}, [0]
        stack = self.stack
        at, raw = 0, ""
        closers: dict[str, re.Pattern] = {}
        while at < len(source):
            if raw:
                m = closers.setdefault(raw, re.compile(rf"</{raw}\b[^>]*>", re.IGNORECASE)).search(source, at)
                self._text(stack[-1], source[at : m.start() if m else len(source)])
                self._cut(len(stack) - 1)
                if raw in BLOCK:
                    self.runs.append((-1, ""))
                at, raw = (m.end() if m else len(source)), ""
                continue
            m = _TAG.search(source, at)
            self._text(stack[-1], source[at : m.start() if m else len(source)])
            if m is None:
                break
            at = m.end()
            if m[2] is None:
                continue
            tag = m[2].lower()
            if tag in BLOCK:
                self.runs.append((-1, ""))
            if m[1]:
                self._close(tag)
                continue
            self._make_room(tag)
            self.parent.append(stack[-1])
            self.tag.append(tag)
            self.names.append(self._names(m[3]))
            if tag not in VOID and not (m[3].endswith("/") and tag in {"svg", "path"}):
                self._push(tag)
                if tag in RAW:
                    raw = tag

    def _text(self, element: int, text: str) -> None:
        if text:
            self.runs.append((element, text))

    def _push(self, tag: str) -> None:
        self.open.setdefault(tag, []).append(len(self.stack))
        self.limits.append(len(self.stack) if tag in BLOCK and tag not in _THROUGH else self.limits[-1])
        self.stack.append(len(self.tag) - 1)

    def _cut(self, at: int) -> None:
        """End the elements from place ``at`` of the stack on."""
        for element in self.stack[at:]:
            self.open[self.tag[element]].pop()
        del self.stack[at:], self.limits[at:]

    def _close(self, tag: str) -> None:
        places = self.open.get(tag)
        if places:
            self._cut(places[-1])

    def _make_room(self, tag: str) -> None:
        which, until = ENDS.get(tag, (set(), set()))
        if tag in BLOCK and tag not in _KEEPS_PARAGRAPH:
            which = which | {"p"}
        if not which:
            return
        # The nearest open element that bounds the search; elements of ``which`` do not bound it, unless ``until`` has them.
        limit = max((self.open[t][-1] for t in until if self.open.get(t)), default=0)
        at = self.limits[-1]
        while at > limit and self.tag[self.stack[at]] in which:
            at = self.limits[at - 1]
        limit = max(limit, at)
        cut = len(self.stack)
        for name in which:
            places = self.open.get(name, ())
            k = bisect.bisect_left(places, limit if name in until else limit + 1)
            if k < len(places):
                cut = min(cut, places[k])
        self._cut(cut)

    @staticmethod
    def _names(attributes: str) -> tuple[str, ...]:
        if "=" not in attributes:
            return ()
        found = (a or b or c for a, b, c in _NAMED.findall(attributes))
        return tuple(dict.fromkeys(n.lower() for value in found for n in _NAME.findall(value)))

    def features(self) -> list[tuple[str, ...]]:
        """Features of each element; the first stands for the whole page."""
        size = [0] * len(self.tag)
        linked = [0] * len(self.tag)
        for element, text in self.runs:
            if element >= 0:
                size[element] += len(text.split()) if len(text) < 400 else len(text) // 6
        for k in range(len(self.tag) - 1, 0, -1):
            if self.tag[k] == "a":
                linked[k] = size[k]
            size[self.parent[k]] += size[k]
            linked[self.parent[k]] += linked[k]
        out: list[tuple[str, ...]] = []
        for k, tag in enumerate(self.tag):
            words = size[k]
            links = 0 if not words else (1 + (3 * linked[k]) // words)
            out.append((f"tag {tag}", f"words {min(int(math.log2(words + 1)), 9)}", f"links {links}", *(f"name {n}" for n in self.names[k])))
        return out

    def labels(self) -> list[bool] | None:
        """Content or not, if the page has an element that says so."""
        if not POSITIVE_TAGS & set(self.tag):
            return None
        inside = [False] * len(self.tag)
        for k in range(1, len(self.tag)):
            refused = self.tag[k] in NEGATIVE_TAGS or any(n in NEGATIVE_NAMES for n in self.names[k])
            inside[k] = not refused and (inside[self.parent[k]] or self.tag[k] in POSITIVE_TAGS)
        return inside


def _known(feature: str) -> float:
    """The log odds that a name carries by itself."""
    kind, _, value = feature.partition(" ")
    if kind == "tag":
        return -9.0 if value in NEGATIVE_TAGS else 9.0 if value in POSITIVE_TAGS else -5.0 if value == "header" else 0.0
    if kind == "name":
        return -9.0 if value in NEGATIVE_NAMES else 4.0 if value in POSITIVE_NAMES else 0.0
    return 0.0


class Model:
    """Log odds of features and the two-by-two potential of an edge."""

    def __init__(self, counts: dict[str, tuple[float, float]], edges: dict[tuple[int, int], float]) -> None:
        yes = sum(v[1] for f, v in counts.items() if f.startswith("tag ")) + 1
        no = sum(v[0] for f, v in counts.items() if f.startswith("tag ")) + 1
        self.odds = {}
        for feature, (out, inside) in counts.items():
            learned = math.log((inside + 0.5) / yes) - math.log((out + 0.5) / no)
            self.odds[feature] = max(-LEARNED, min(LEARNED, learned))
        tie = lambda same, other: max(0.5, min(TIE, math.log((edges.get(same, 0) + 1) / (edges.get(other, 0) + 1))))
        self.inside, self.outside = tie((1, 1), (1, 0)), tie((0, 0), (0, 1))

    def _message(self, odds: float, up: bool) -> float:
        """What an element's log odds say to the other end of an edge."""
        a, b = (self.inside, self.outside) if up else (self.inside, self.outside)
        # Potential exp(a) for content with content, exp(b) for not with not, 1 otherwise.
        high = max(odds + a, 0.0)
        top = high + math.log(math.exp(odds + a - high) + math.exp(-high))
        high = max(odds, b)
        bottom = high + math.log(math.exp(odds - high) + math.exp(b - high))
        return top - bottom

    def marginals(self, page: Page) -> list[float]:
        """Log odds that each element is content, from messages up and then down the tree."""
        known = self.odds
        belief = [sum(known.get(f, 0.0) + _known(f) for f in features) for features in page.features()]
        belief[0] = 1.0  # bare text is content
        sent = [0.0] * len(belief)
        for k in range(len(belief) - 1, 0, -1):
            sent[k] = self._message(belief[k], True)
            belief[page.parent[k]] += sent[k]
        for k in range(1, len(belief)):
            belief[k] += self._message(belief[page.parent[k]] - sent[k], False)
        return belief


def main_text(page: Page, odds: list[float]) -> str:
    blocks, parts = [], []
    for element, text in [*page.runs, (-1, "")]:
        if element < 0:
            if parts and (block := " ".join(html.unescape("".join(parts)).split())):
                blocks.append(block)
            parts = []
        elif odds[element] > 0 and page.tag[element] not in RAW:
            parts.append(text)
    return "\n".join(blocks)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """html -> how often each feature and each edge occurs by label."""
    counts: Counter[tuple[str, int, int]] = Counter()
    for batch in batches:
        for source in batch.column(0).to_pylist():
            page = Page(source or "")
            labels = page.labels()
            if labels is None:
                continue
            for k, features in enumerate(page.features()):
                for f in features if k else ():
                    counts[f, int(labels[k]), -1] += 1
                if k:
                    counts["edge", int(labels[page.parent[k]]), int(labels[k])] += 1
    rows = list(counts.items())
    columns = [pa.array([k[j] for k, _ in rows], kind) for j, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
    yield pa.RecordBatch.from_arrays([*columns, pa.array([n for _, n in rows], pa.int64())], names=["feature", "label", "child", "n"])


def train(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", most_features: int = 100_000) -> Model:
    """The model of the labelled pages; features seen on few elements only are left to the names (``most_features`` are kept)."""
    has_label = F.col(html_column).rlike("(?i)<(article|main)\\b")
    rows = pages.where(has_label).select(F.col(html_column).alias("html"), F.xxhash64(id_column, url_column).alias("place"))
    total = rows.count()
    sample = rows.where(F.pmod("place", F.lit(1 << 30)) < F.lit(int((1 << 30) * min(1.0, SAMPLE / max(total, 1)))))
    counted = sample.select("html").mapInArrow(_count, "feature string, label bigint, child bigint, n bigint").groupBy("feature", "label", "child").agg(F.sum("n").alias("n"))
    counts: dict[str, list[float]] = {}
    edges: dict[tuple[int, int], float] = {}
    for feature, label, child, n in counted.orderBy(F.desc("n"), "feature", "label", "child").limit(most_features).collect():
        if feature == "edge":
            edges[label, child] = n
        else:
            counts.setdefault(feature, [0.0, 0.0])[label] += n
    return Model({k: (v[0], v[1]) for k, v in counts.items()}, edges)


def _extract(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for source in batch.column(2).to_pylist():
                page = Page(source or "")
                texts.append(main_text(page, model.marginals(page)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["id", "url", "text"])

    return run


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Per row of ``pages``: id, url and the main text."""
    model = train(pages, id_column, url_column, html_column)
    rows = pages.select(F.col(id_column).cast("bigint").alias("id"), F.col(url_column).alias("url"), F.col(html_column).alias("html"))
    return rows.mapInArrow(_extract(model), "id bigint, url string, text string")
