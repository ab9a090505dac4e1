"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page is a sequence of words and tags. A word scores by where it stands (its block element, links, the names
of the elements around it), a tag by its name; the weights are log odds counted on labelled pages, so words of
articles score above 0 and tags, menus and the like below. One linear scan finds the contiguous region with the
highest sum. In the region, blocks of negative score and blocks inside elements that are never article text
(scripts, menus, ...) are left out. A form, or a class, id or role that speaks of a sidebar, comments or the like,
takes from a word's score by how little of the page's text the element holds: one that holds all of it wraps the
page and takes nothing.

Labelled pages are those that mark their article themselves, with ``article`` or ``main``.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound on the labelled pages that weights are counted on.
SAMPLE = 4000
#: A name must occur on this share of the labelled pages to get a weight: which bounds the weights kept.
LEAST_SHARE = 0.002
_CLIP = 4.0
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)"
    # a quote opens a value only after the equals sign
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?)*+>|[^>]*(?:>|\Z))"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "template", "svg", "math", "select", "object"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand inside a line of text; all others begin and end a block.
_INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img".split()
)
_MARKED = {"article", "main"}
#: Elements that the lists below do not judge: they hold the page or its article.
_WHOLE = {"html", "body", *_MARKED}
_NEVER = {"nav", "footer", "aside", "header", "menu", "dialog", "button", "head"}
#: What a form or an element of these names takes from the score, times the share of the text that is not in it.
_ASIDE = 16.0
_NEVER_NAMES = set(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie "
    "cookies disqus footer menu modal nav navbar navigation newsletter notice pagination popup promo "
    "related respond search share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)


class _Element:
    """An element and what holds for its words. ``fresh`` are its names that no element around it has."""

    __slots__ = ("name", "parent", "marked", "hard", "soft", "never", "penalty", "n_words", "n_marked", "link", "fresh", "block", "named", "words")

    def __init__(self, name: str, parent: _Element | None, names: frozenset[str], fresh: frozenset[str]):
        self.name, self.parent, self.fresh = name, parent, fresh
        self.named, self.words = 0.0, [0, 0]
        self.link = name == "a" or bool(parent and parent.link)
        self.marked = name in _MARKED or bool(parent and parent.marked)
        inside = parent is not None and parent.marked
        # A header inside the article holds its headline; anywhere else it is the page's.
        self.hard = name in _NEVER and not (name == "header" and inside)
        self.soft = name not in _WHOLE and (name == "form" or bool(names & _NEVER_NAMES))
        self.never, self.penalty = False, 0.0
        self.n_words = self.n_marked = 0
        self.block = (parent.block if parent else "body") if name in _INLINE else name


def _judge(elements: list[_Element]) -> None:
    """Set ``never`` and ``penalty`` of a page's elements, parents first, by the words counted in each.

    What a page marks as its article decides, else all words outside ``_NEVER``.
    """
    for e in elements:
        e.never = e.name != "body" and (e.hard or bool(e.parent and e.parent.never))
    own = [(e, e.n_words) for e in elements]
    marked = any(e.marked and n for e, n in own)
    for e, n in own:
        e.n_words, e.n_marked = (0 if e.never else n), (n if e.marked else 0)
    for e in reversed(elements):
        if e.parent:
            e.parent.n_words += e.n_words
            e.parent.n_marked += e.n_marked
    whole = elements[0].n_marked if marked else elements[0].n_words
    for e in elements:
        share = (e.n_marked if marked else e.n_words) / whole if whole else 0.0
        above = e.parent if e.name != "body" else None
        e.penalty = above.penalty if above else 0.0
        if e.soft or e.hard and marked:
            e.penalty = min(e.penalty, -_ASIDE * (1 - share))
        e.never = bool(above and above.never) or e.penalty <= -_CLIP or e.hard and not marked


def _names(rest: str) -> frozenset[str]:
    if "=" not in rest:
        return frozenset()
    found = (a or b or c for a, b, c in _NAMES.findall(rest))
    return frozenset(n for value in found for n in re.split(r"[^a-z0-9]+", value.lower()) if n)


def events(page: str) -> tuple[list[tuple[str, str, _Element]], list[_Element]]:
    """('tag', name, element around it) and ('text', decoded text, element it is in), in page order, and the elements.

    The page is read to its end first, for an element is judged by what it holds. Elements come before those they hold.
    """
    elements: list[_Element] = []
    found = list(_parsed(page, elements))
    for kind, value, element in found:
        if kind == "text":
            element.n_words += len(value.split())
    _judge(elements)
    return found, elements


def _parsed(page: str, elements: list[_Element]) -> Iterator[tuple[str, object, _Element]]:
    """The events of a page, whose elements are listed in ``elements``.

    Raw elements (scripts, styles, ...) yield their tag only. End tags close the nearest element of their name
    and all inside it; a paragraph also ends where the next block begins. Nothing is required to be closed.
    """
    root = _Element("body", None, frozenset(), frozenset())
    stack = [root]
    elements.append(root)
    open_: Counter = Counter()
    open_names: set[str] = set()

    def close() -> _Element:
        last = stack.pop()
        open_[last.name] -= 1
        open_names.difference_update(last.fresh)
        return last

    at = 0
    for_search = _TAG.search
    while True:
        m = for_search(page, at)
        if m is None:
            if at < len(page):
                yield "text", entities.unescape(page[at:]), stack[-1]
            return
        if m.start() > at:
            yield "text", entities.unescape(page[at : m.start()]), stack[-1]
        at = m.end()
        if m["name"] is None:
            continue
        name = m["name"].lower()
        yield "tag", name, stack[-1]
        if m["end"]:
            if open_[name]:
                while len(stack) > 1 and close().name != name:
                    pass
            continue
        if name in _VOID:
            continue
        if name not in _INLINE and open_["p"]:
            while len(stack) > 1 and (stack[-1].name in _INLINE or stack[-1].name == "p"):
                if close().name == "p":
                    break
        if name in _RAW:
            ending = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = ending.end() if ending else len(page)
            continue
        if m["rest"].endswith("/>") and name not in _INLINE:
            continue
        names = _names(m["rest"])
        fresh = names - open_names
        stack.append(_Element(name, stack[-1], names, fresh))
        elements.append(stack[-1])
        open_[name] += 1
        open_names |= fresh


def _features(element: _Element) -> tuple[str, str]:
    """Where a word stands, besides the names around it; what marks the article itself is left out, for it is the label."""
    return f"block {element.block}" if element.block not in _MARKED else "block div", f"link {element.link}"


class Weights:
    """Scores of words and tags; without labelled pages plain ones, by which blocks of words outweigh tags."""

    def __init__(self, words: dict[str, float], tags: dict[str, float], base: float):
        self.words, self.tags, self.base = words, tags, base

    def name_elements(self, elements: list[_Element]) -> None:
        """Add up the weights of the names around each element, every name once; parents come first."""
        for e in elements:
            e.named = (e.parent.named if e.parent else 0.0) + sum(self.words.get(f"name {n}", 0.0) for n in e.fresh)

    def word(self, element: _Element) -> float:
        """Score of a word in an element that ``name_elements`` has seen."""
        if element.never:
            return -_CLIP
        total = self.base + element.named + sum(self.words.get(f, 0.0) for f in _features(element))
        if element.marked:
            total = max(total, 1.0)
        total += element.penalty
        return max(-_CLIP, min(_CLIP, total))

    def tag(self, name: str) -> float:
        return self.tags.get(name, -1.0)


PLAIN = Weights({"link True": -2.0}, {}, 1.0)


def count(page: str) -> tuple[bool, Counter]:
    """Whether the page marks its article, and its (kind, feature, inside) counts of words and tags."""
    found: Counter = Counter()
    labelled = False
    read, elements = events(page)
    for kind, value, element in read:
        labelled |= element.marked
        inside = element.marked and not element.never
        if kind == "tag":
            found["tag", value, inside] += 1
        elif (n := len(value.split())) and not element.never:
            found["all", "", inside] += n
            element.words[inside] += n
            for f in _features(element):
                found["word", f, inside] += n
        elif n:
            found["all", "", False] += n
    for e in reversed(elements):  # a name counts for all words in its element
        for inside in (False, True):
            if n := e.words[inside]:
                found.update({("word", f"name {name}", inside): n for name in e.fresh})
                if e.parent:
                    e.parent.words[inside] += n
    return labelled, found


def fit(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from about ``sample`` labelled pages at most, chosen by a hash of the html."""
    slim = pages.select(F.col("html").cast("string").alias("html")).where(F.lower("html").rlike("<(article|main)\\b"))
    n = slim.count()
    if not n:
        return PLAIN
    if n > sample:
        slim = slim.where(F.pmod(F.xxhash64("html"), F.lit(1 << 20)) < int((1 << 20) * sample / n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            pages_with: Counter = Counter()
            for page in batch.column(0).to_pylist():
                labelled, found = count(page)
                if labelled:
                    total.update(found)
                    pages_with.update({k for k in found})
            rows = [(*k, v, pages_with[k]) for k, v in total.items()]
            columns = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["kind", "feature", "inside", "n", "pages"])

    counted = slim.mapInArrow(run, "kind string, feature string, inside boolean, n bigint, pages bigint")
    inside, outside = F.col("inside"), ~F.col("inside")
    sums = (
        counted.groupBy("kind", "feature")
        .agg(
            F.sum(F.when(inside, F.col("n")).otherwise(0)).alias("inside"),
            F.sum(F.when(outside, F.col("n")).otherwise(0)).alias("outside"),
            F.sum("pages").alias("pages"),
        )
        .where(F.col("pages") >= F.lit(LEAST_SHARE * min(n, sample)))
        .collect()
    )
    whole = next((r for r in sums if r.kind == "all"), None)
    if whole is None:
        return PLAIN

    def odds(r) -> float:
        return math.log((r.inside + 1) / (r.outside + 1))

    words = {r.feature: max(-_CLIP, min(_CLIP, odds(r) - odds(whole))) for r in sums if r.kind == "word"}
    tags = {r.feature: -min(_CLIP, max(0.05, -odds(r))) for r in sums if r.kind == "tag"}
    return Weights(words, tags, max(0.5, odds(whole)))


def extract(page: str | None, weights: Weights) -> str:
    """The text of the best region: blocks in page order, white space and block borders one space each."""
    blocks: list[tuple[list[str], list[float]]] = [([], [])]
    items: list[tuple[float, int]] = []  # score, and the block of the words (-1: a tag)
    read, elements = events(page or "")
    weights.name_elements(elements)
    for kind, value, element in read:
        if kind == "tag":
            items.append((weights.tag(value), -1))
            if value not in _INLINE and blocks[-1][0]:
                blocks.append(([], []))
            continue
        n = len(value.split())
        score = weights.word(element)
        if n:
            items.append((n * score, len(blocks) - 1))
        blocks[-1][0].append(" " if element.never else value)  # a link or the like stays in its block
        blocks[-1][1].append(n * score)
    best, best_range, run, begin = 0.0, (0, 0), 0.0, 0
    for i, (score, _) in enumerate(items):
        if run <= 0:
            run, begin = 0.0, i
        run += score
        if run > best:
            best, best_range = run, (begin, i + 1)
    chosen = {block for _, block in items[slice(*best_range)] if block >= 0}
    kept = (" ".join("".join(parts).split()) for i, (parts, scores) in enumerate(blocks) if i in chosen and sum(scores) > 0)
    return " ".join(t for t in kept if t)


def main_text(pages: DataFrame, weights: Weights) -> DataFrame:
    """(page_id, url, text) for every row, where it is read. NULL and empty pages, and pages without words, give ''."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, weights) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string())], ["page_id", "url", "text"])

    slim = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return slim.mapInArrow(run, "page_id bigint, url string, text string")
