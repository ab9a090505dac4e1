"""Personal data: certain patterns, and more spans by boosted trees over candidates.

The base spans of a text are fixed patterns with a validity rule per kind. Beside them, generators of high
recall propose looser candidates, which overlap: written-out addresses with every end that a dot allows, and of a
run of digit groups every part that has a fitting number of digits. Trees score a candidate by its format, by
what it continues on either side and by the words around it; a candidate at or above its kind's threshold becomes a span
if it overlaps no base span and no better candidate.

There are no labelled spans, so the training set is made from the corpus: base spans as they stand and
rewritten in loose forms, some of them beside another number, are examples of personal data; all other candidates,
those that hold only a part of such a span or more than it as well, and base spans made invalid, are counter-examples.
A kind's threshold is the lowest score that keeps the wanted precision on rows that grew no tree.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import boosting

PRECISION = 0.98
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run is taken whole or not at all, so these never scan a run twice.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: Written-out addresses, bounded in length: local part and connector, then the first and further parts of the domain.
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:@|[(\[{] ?(?:at|AT|@) ?[)\]}]| at | AT ) ?(?=[A-Za-z0-9-])")
_LABEL = re.compile(r"[A-Za-z0-9-]{1,63}")
_DOT = re.compile(r" ?(?:\.|[(\[{] ?(?:dot|DOT|\.) ?[)\]}]| dot | DOT ) ?[A-Za-z0-9-]{2,24}")
#: A run of digit groups with little between them; taken possessively, so a long one is read once.
_RUN = re.compile(r"[0-9]++(?:[][ ./(),_-]{1,4}+[0-9]++)*+")
_GROUP = re.compile("[0-9]+")
#: What may stand between the groups of a kind, and how many groups or digits it has.
_BETWEEN = {
    "ip": re.compile(r" ?(?:\.|\[\.\]|\(\.\)|,) ?"),
    "card": re.compile("[ ./_-]{1,2}"),
    "phone": re.compile(r"[ ./()-]{1,2}"),
}
_MOST_DIGITS = 19
_PREFIX = re.compile(r"(?:\+ ?|00)?\(?$")
_HINTS = {
    "email": ("mail", "contact", "write", "schreib", "correo", "courriel"),
    "ip": ("ip", "host", "server", "addr", "adress"),
    "card": ("card", "visa", "karte", "carte", "tarjeta", "pay", "credit"),
    "phone": ("phone", "tel", "call", "fax", "mobil", "handy", "anruf", "llam", "cell"),
}
_SECRET = re.compile(r"(?:key|token|password|passwd|secret|version|id|isbn|no\.?|nr\.?)\W{0,3}$", re.I)
#: Candidates scored together.
_AT_ONCE = 10_000
Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _valid(kind: str, found: str) -> bool:
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[Span]:
    """Matches of local part, @ and dotted domain, leftmost first; linear in the text."""
    end, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > end and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, at + 1) if begin < at else None
        if m:
            end = m.end()
            yield begin, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> dict[str, list[Span]]:
    """Leftmost non-overlapping matches per kind, without those that break the kind's rule."""
    out = {"email": list(_emails(text))}
    for kind, pattern in (("ip", _IP), ("card", _CARD), ("phone", _PHONE)):
        out[kind] = [m.span() for m in pattern.finditer(text) if _valid(kind, m.group())]
    return out


def _addresses(text: str) -> Iterator[Span]:
    """Written-out addresses, each with every end; the next one may begin inside a domain."""
    m = _NAME.search(text)
    while m:
        label = _LABEL.match(text, m.end())
        end = label.end()
        for _ in range(4):
            part = _DOT.match(text, end)
            if not part:
                break
            end = part.end()
            yield m.start(), end
        m = _NAME.search(text, m.end())


def _numbers(text: str) -> Iterator[tuple[str, int, int]]:
    """Parts of runs of digit groups that a kind allows: at most ``_MOST_DIGITS`` parts begin at a group."""
    for run in _RUN.finditer(text):
        groups = [g.span() for g in _GROUP.finditer(text, run.start(), run.end())]
        first = text[run.start() - 1] if run.start() else " "
        for i, (begin, _) in enumerate(groups):
            if i == 0 and first.isalpha():
                continue
            digits, open_ = 0, {"ip", "card", "phone"}
            for j in range(i, len(groups)):
                if j > i:
                    between = text[groups[j - 1][1] : groups[j][0]]
                    open_ = {k for k in open_ if _BETWEEN[k].fullmatch(between)}
                n, end = j - i + 1, groups[j][1]
                digits += end - groups[j][0]
                if digits > _MOST_DIGITS or not open_:
                    break
                if end == run.end() and text[end : end + 1].isalpha():
                    break
                if "ip" in open_ and 4 <= n <= 6 and max(e - b for b, e in groups[i : j + 1]) <= 4:
                    yield "ip", begin, end
                if "card" in open_ and digits >= 12:
                    yield "card", begin, end
                if "phone" in open_ and 6 <= digits <= 17:
                    # a plus and a bracket before the first group belong to the number
                    lead = _PREFIX.search(text, max(0, begin - 4), begin)
                    yield "phone", lead.start(), end


def candidates(text: str) -> Iterator[tuple[str, int, int]]:
    """Loose candidates of all kinds, which overlap; their number is linear in the text's length."""
    if "@" in text or "at" in text or "AT" in text:
        for begin, end in _addresses(text):
            yield "email", begin, end
    yield from _numbers(text)


def features(text: str, kind: str, begin: int, end: int) -> list[float]:
    """Format of the span and its surroundings; nothing of the text outside 40 characters on either side."""
    found, before, after = text[begin:end], text[max(0, begin - 40) : begin], text[end : end + 40]
    digits = "".join(c for c in found if "0" <= c <= "9")
    groups = re.findall("[0-9]+", found)
    letters = sum(c.isalpha() for c in found)
    last = re.split("[^A-Za-z0-9-]+", found)[-1] if kind == "email" else ""
    lower = before.lower()
    numbers = [min(int(g), 10**6) for g in groups[:6]] if all(len(g) < 10 for g in groups[:6]) else [10**6]
    return [
        *(float(kind == k) for k in KINDS),
        float(len(found)),
        float(len(digits)),
        float(letters),
        float(len(groups)),
        float(max((len(g) for g in groups), default=0)),
        float(min((len(g) for g in groups), default=0)),
        float(luhn(digits)) if digits else 0.0,
        float(max(numbers, default=0) <= 255),
        float(found.count("@")),
        float(found.count(".")),
        float(found.count(" ")),
        float(found.count("-")),
        float("(" in found or "[" in found),
        float(found.startswith("+")),
        float(found.startswith("0")),
        float(2 <= len(last) <= 4 and last.isalpha()),
        float(any(h in lower for h in _HINTS[kind])),
        float(bool(_SECRET.search(before))),
        float(bool(before) and (before[-1].isalnum() or before[-1] in "=_-./")),
        float(bool(after) and (after[0].isalnum() or after[0] in "=_-/")),
        *_goes_on(found, before[::-1], groups[:1]),
        *_goes_on(found, after, groups[-1:]),
        float(kind == "email" and bool(_DOT.match(after))),
        float(kind == "phone" and len(groups) == 3 and [len(g) for g in groups] == [3, 3, 4]),
        float(kind == "card" and len(groups) == 4 and {len(g) for g in groups} == {4}),
        float(len(set(re.findall("[^0-9]+", found[1:]))) > 1),
    ]


_NEXT = re.compile(r"([][ ./(),_-]{0,4})([0-9]+)")


def _goes_on(found: str, beside: str, edge: list[str]) -> tuple[float, float, float]:
    """What follows a span: the length of a digit group there, whether its separator is one of the span's own, and
    whether it is as long as the span's group at that end."""
    m = _NEXT.match(beside)
    if not m or not edge:
        return 0.0, 0.0, 0.0
    between, group = m.groups()
    own = bool(between) and between.strip() in found and bool(between.strip() or " " in found)
    return float(len(group)), float(own), float(len(group) == len(edge[0]))


class Taken:
    """Disjoint spans in order; overlaps are looked up by bisection."""

    def __init__(self, spans: Iterable[Span] = ()):
        self.begins: list[int] = []
        self.ends: list[int] = []
        for begin, end in sorted(spans):
            if self.ends and begin < self.ends[-1]:  # spans of different kinds may overlap
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.begins.append(begin)
                self.ends.append(end)

    def overlaps(self, begin: int, end: int) -> bool:
        at = bisect.bisect_left(self.begins, end)  # the last span that begins before the end
        return at > 0 and self.ends[at - 1] > begin

    def add(self, begin: int, end: int) -> None:
        at = bisect.bisect_left(self.begins, begin)
        self.begins.insert(at, begin)
        self.ends.insert(at, end)


def _loosened(kind: str, found: str, turn: int) -> tuple[str, str]:
    """A loose form of a base span, and an invalid one."""
    digits = "".join(c for c in found if "0" <= c <= "9")
    if kind == "email":
        at, dot = ((" (at) ", " (dot) "), ("[at]", "[dot]"), (" at ", " dot "))[turn % 3]
        name, domain = found.split("@", 1)
        wrong = (f"{name} at {turn % 90}.{turn % 89}", f"{name} at {domain.split('.')[0]}. And")[turn // 3 % 2]
        labels = domain.split(".")
        if turn // 11 % 2:  # so that no number of labels stands for an address
            labels = labels[-2:]
        return name + at + dot.join(labels), wrong
    if kind == "ip":
        parts = found.split(".")
        return ("[.]", "(.)", " . ")[turn % 3].join(parts), ".".join([str(300 + turn % 600), *parts[1:]])
    if kind == "card":
        groups = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1 + turn % 8) % 10)
        return (".", "/", "  ")[turn % 3].join(groups), wrong
    local = digits[-10:]
    forms = (f"00{digits}", f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}")
    return forms[turn % 3], digits[:6]


#: What may stand beside a loose form in an example: mostly nothing, else another number.
_BESIDE = ("", "", "", " 2024-01-01", " 12/25", " 17", ", 555 0143", " (2)")


def examples(text: str) -> Iterator[tuple[str, list[float], int]]:
    """(kind, features, label) made from one text; label 1 for a candidate that is just the span."""
    base = base_spans(text)
    taken = Taken(s for spans in base.values() for s in spans)
    for kind, begin, end in candidates(text):
        if not taken.overlaps(begin, end):
            yield kind, features(text, kind, begin, end), 0
    for kind, spans in base.items():
        for begin, end in spans:
            yield kind, features(text, kind, begin, end), 1
            found, before, after = text[begin:end], text[max(0, begin - 40) : begin], text[end : end + 40]
            turn = zlib.crc32(found.encode("utf-8", "surrogatepass"))
            beside = _BESIDE[turn // 7 % len(_BESIDE)]
            forms = _loosened(kind, found, turn)
            twice = forms[0] + " " + forms[0] if kind == "phone" and turn % 5 == 0 else forms[0] + beside
            for label, form, shown in ((1, forms[0], twice), (0, forms[1], forms[1])):
                changed, at = before + shown + after, len(before)
                right = {(at, at + len(form)), (at + len(form) + 1, at + 2 * len(form) + 1) if shown == form + " " + form else ()}
                for k, b, e in candidates(changed):
                    if b < at + len(shown) and at < e:
                        yield k, features(changed, k, b, e), int(label and k == kind and (b, e) in right)


class Finder:
    """Base spans, and candidates that the trees accept."""

    def __init__(self, trees: boosting.Trees, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds

    def added(self, text: str, base: dict[str, list[Span]]) -> list[tuple[str, int, int]]:
        """Accepted candidates, best first; of equally good ones the longest, then the leftmost. None overlaps another."""
        taken = Taken(s for spans in base.values() for s in spans)
        out: list[tuple[str, int, int]] = []
        open_ = (c for c in candidates(text) if not taken.overlaps(c[1], c[2]))
        good: list[tuple[float, tuple[str, int, int]]] = []
        while part := list(itertools.islice(open_, _AT_ONCE)):
            scores = self.trees.score(np.array([features(text, *c) for c in part]))
            good += [(s, c) for s, c in zip(scores.tolist(), part) if s >= self.thresholds[c[0]]]
        for _, (kind, begin, end) in sorted(good, key=lambda s: (-s[0], s[1][1] - s[1][2], s[1][1], KINDS.index(s[1][0]))):
            if not taken.overlaps(begin, end):
                taken.add(begin, end)
                out.append((kind, begin, end))
        return out


def fit(docs: DataFrame, precision: float = PRECISION) -> Finder:
    """Fit trees and thresholds on all documents: every example of every text counts.

    Texts without a digit or an @ teach nothing. Rows are written once; trees and calibration go over them with Spark ML.
    """
    texts = docs.select(F.col("text").cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0).to_pylist():
                found = list(examples(t)) if t else []
                part = zlib.crc32(t.encode("utf-8", "surrogatepass")) % 4 if t else 0
                columns = [[k for k, _, _ in found], [x for _, x, _ in found], [y for _, _, y in found], [part] * len(found)]
                types = [pa.string(), pa.list_(pa.float64()), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["kind", "x", "y", "part"])

    rows = materialize(texts.mapInArrow(make, "kind string, x array<double>, y int, part int"), "candidates")
    trees = boosting.fit(rows, F.col("part") == 0)

    def rate(batches):
        for batch in batches:
            if len(batch):
                yield batch.assign(score=trees.score(np.array(batch["x"].tolist(), float)).round(6))[["kind", "score", "y"]]

    # Calibrated scores have few levels, so the counts below are few rows.
    rated = rows.where("part = 0").select("kind", "x", "y").mapInPandas(rate, "kind string, score double, y int")
    levels = rated.groupBy("kind", "score").agg(F.sum("y").alias("yes"), F.count(F.lit(1)).alias("n")).toPandas()
    thresholds = {}
    for kind in KINDS:
        own = levels[levels["kind"] == kind].sort_values("score", ascending=False)
        good = (own["yes"].cumsum() / own["n"].cumsum()).to_numpy() >= precision
        reached = own["score"].to_numpy()[good]
        thresholds[kind] = max(float(reached.min()), 0.5) if len(reached) else 2.0
    return Finder(trees, thresholds)


def spans(docs: DataFrame, finder: Finder) -> DataFrame:
    """(doc_id, base, spans) for every row, where it is read: arrays of (kind, begin, end) in code points, end exclusive.

    Both are ordered by begin, then kind as listed, then end; ``spans`` holds ``base`` and the added ones.
    NULL counts as the empty text. Repeated rows and NULL or repeated ids are rows of their own.
    """

    def ordered(found: list[tuple[str, int, int]]) -> list[dict]:
        found = sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))
        return [{"kind": k, "begin": b, "end": e} for k, b, e in found]

    span = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for t in batch.column(1).to_pylist():
                found = base_spans(t or "")
                own = [(k, b, e) for k, s in found.items() for b, e in s]
                base.append(ordered(own))
                every.append(ordered(own + finder.added(t or "", found)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(every, span)], ["doc_id", "base", "spans"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = "array<struct<kind: string, begin: bigint, end: bigint>>"
    return slim.mapInArrow(run, f"doc_id bigint, base {found}, spans {found}")


def redacted(text: str | None, found: list) -> str:
    """The text with every span (kind, begin, end) replaced by its kind in brackets; overlapping spans merge."""
    text, out, at = text or "", [], 0
    for kind, begin, end in sorted(found, key=lambda s: (s[1], -s[2])):
        if begin >= at:
            out += [text[at:begin], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])
