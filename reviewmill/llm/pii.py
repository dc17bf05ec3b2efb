"""Personal data: generated candidate spans, judged by boosted trees.

Fixed patterns give the base spans, which always stay. Beside them, generators
of high recall propose overlapping spans; trees boosted on the format and the
context of spans score them, and a threshold per kind, calibrated on all documents
that the trees were not fitted on, selects what is redacted as well.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.texts import slices

KINDS = ["email", "ip", "card", "phone"]
EMAIL, IP, CARD, PHONE = range(4)

# Documents and candidates that the trees are fitted on, at most.
FIT_DOCUMENTS, FIT_CANDIDATES = 6_000, 20_000
TREES, DEPTH = 16, 4
# Share of true spans among those selected in the held-out documents, at least.
PRECISION = 0.99
# Scores are counted in so many bins.
BINS = 10_000

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits is taken from its start, or long runs would be read again and again.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_LOOSE_AT = re.compile(
    r"[\w.%+-]{1,64}(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)"
    r"[\w-]{1,63}(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[\w-]{1,63}){1,8}"
)
_LOOSE_NUMBER = re.compile(r"[+(]{0,2}[0-9](?:[\x20().,/_-]{0,3}[0-9]){6,40}")
_CARD_GROUPS = re.compile(r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)+")
_DIGITS = re.compile(r"[0-9]+")
_SPELLED_AT = re.compile(r"\x20?[\[(](?:at|AT)[\])]\x20?")
_SPELLED_DOT = re.compile(r"\x20?[\[(](?:dot|DOT)[\])]\x20?")
_ADDRESS = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PLAIN_NUMBER = re.compile(r"[0-9.-]{7,}")
_HINT = re.compile(r"[@0-9]|[\[(](?:at|AT)[\])]")
_CUE = re.compile(
    r"(?i)(mail|kontakt|contact|address|tel|phone|fax|call|mobile|card|visa|credit|konto|account|ip|host|server)\W{0,3}$"
)
_HEX = re.compile(r"[0-9a-fA-F]*[a-fA-F][0-9a-fA-F]*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _octets(text: str) -> bool:
    parts = text.split(".")
    return len(parts) == 4 and all(
        p.isascii() and p.isdigit() and len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts
    )


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part can only end at the next @."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            # No part of a failed local run can be part of a later one.
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all base spans, in order of start, then kind."""
    found = [(s, EMAIL, e) for s, e in _emails(text)]
    found += [(m.start(), IP, m.end()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), CARD, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), PHONE, m.end()))
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of spans that may be personal data; they may overlap."""
    found = {(m.start(), EMAIL, m.end()) for m in _LOOSE_AT.finditer(text)}
    for pattern in (_LOOSE_NUMBER, _PLAIN_NUMBER):
        for m in pattern.finditer(text):
            start, end = m.span()
            digits = sum(c.isdigit() for c in m[0])
            if m[0].count(".") >= 3:
                found.add((start, IP, end))
            if 12 <= digits <= 20:
                found.add((start, CARD, end))
            if 7 <= digits <= 16:
                found.add((start, PHONE, end))
    for m in _CARD_GROUPS.finditer(text):
        # Cards may stand among other numbers: runs of whole groups with as many digits.
        groups = [(g.start(), g.end()) for g in _DIGITS.finditer(text, *m.span())]
        for i, (start, _) in enumerate(groups):
            digits = 0
            for low, end in groups[i : i + 8]:
                digits += end - low
                if digits > 19:
                    break
                if digits >= 14:
                    found.add((start, CARD, end))
    return sorted(found)


class Taken:
    """Spans that others may not touch; asks in the logarithm of their number."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        """``spans`` in order of start."""
        self._starts = [s for s, _, _ in spans]
        self._ends = list(accumulate((e for _, _, e in spans), max))

    def touches(self, start: int, end: int) -> bool:
        # Of the spans that begin before the end, the farthest reaches beyond the start or none does.
        before = bisect_left(self._starts, end)
        return before > 0 and self._ends[before - 1] > start


def true_span(text: str, start: int, kind: int, end: int) -> bool | None:
    """Whether a candidate is personal data by rules stricter than the base patterns, which
    also see what those miss; None where the rules cannot tell."""
    span = text[start:end]
    left, right = text[max(0, start - 24) : start], text[end : end + 1]
    whole = not (left[-1:].isalnum() or right.isalnum())
    digits = re.sub(r"[^0-9]", "", span)
    if kind == EMAIL:
        plain = _SPELLED_DOT.sub(".", _SPELLED_AT.sub("@", span))
        top = plain.rsplit(".", 1)[-1]
        return whole and _ADDRESS.fullmatch(plain) is not None and top.isalpha() and len(top) > 1
    if kind == IP:
        return whole and _octets(span) and left[-1:] != "." and not re.match(r"\.[0-9]", text[end : end + 2])
    if kind == CARD:
        # One printed layout, not digits of neighbours, and one of the first digits that cards have.
        sizes = [len(g) for g in _DIGITS.findall(span)]
        layout = len(sizes) == 1 or (len(set(sizes[:-1])) == 1 and sizes[0] == 4 and 2 <= sizes[-1] <= 7)
        good = 14 <= len(digits) <= 19 and luhn(digits) and layout and digits[0] in "3456"
        return good and whole and len(set(digits)) > 2
    cue = re.search(r"(?i)(tel|phone|fax|call|mobile|kontakt|contact)\W{0,3}\+?\(?$", left)
    if cue and 7 <= len(digits) <= 15 and whole:
        return True
    return None if span.startswith("+") or left.endswith("+") else False


FEATURES = (
    "kind length digits groups longest_group shortest_group dots hyphens spaces brackets plus at "
    "hidden_at luhn octets top_domain domain_labels different_digits zero_start before after "
    "hex_around cue line_start"
).split()


def features(text: str, start: int, kind: int, end: int) -> list[float]:
    """Format of a span and its context, in the order of FEATURES."""
    span = text[start:end]
    left, right = text[max(0, start - 24) : start], text[end : end + 2]
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    labels = re.split(r"\.|[\[(](?:dot|DOT)[\])]", span)
    around = (left[-1:], right[:1])
    return [
        kind,
        len(span),
        len(digits),
        len(groups),
        max(map(len, groups), default=0),
        min(map(len, groups), default=0),
        span.count("."),
        span.count("-"),
        span.count(" "),
        span.count("(") + span.count(")"),
        span.startswith("+") or left.endswith("+"),
        span.count("@"),
        bool(re.search(r"[\[(](?:at|AT)[\])]", span)),
        12 <= len(digits) <= 20 and luhn(digits),
        _octets(span),
        len(labels[-1].strip()),
        len(labels),
        len(set(digits)),
        digits.startswith("0"),
        _context(around[0]),
        _context(around[1]),
        any(c and _HEX.fullmatch(c) is not None for c in around),
        bool(_CUE.search(left)),
        start == 0 or text[start - 1] == "\n",
    ]


def _context(c: str) -> int:
    if not c or c.isspace():
        return 0
    return 1 if c.isalnum() else 2


def _loosened(text: str, start: int, kind: int, end: int) -> Iterator[tuple[str, int, int, int]]:
    """Forms in which people write the same data, as true examples; and spoiled ones."""
    span = text[start:end]
    forms = [span]
    if kind == EMAIL:
        forms += [span.replace("@", " (at) "), span.replace("@", "[at]").replace(".", " [dot] ")]
    elif kind == PHONE:
        forms += [span[1:].strip(), span.replace(" ", "-"), span.replace("(", "").replace(")", "")]
    elif kind == CARD:
        digits = re.sub(r"\D", "", span)
        forms += [" ".join(digits[i : i + 4] for i in range(0, len(digits), 4))]
    for form in forms:
        yield text[:start] + form + text[end:], start, kind, start + len(form)


def _example_rows(text: str | None) -> Iterator[tuple[int, float, list[float]]]:
    """(kind, label, features) of all base spans and candidates of a text."""
    if not text or not _HINT.search(text):
        return
    base = base_spans(text)
    for start, kind, end in base:
        first = max(0, start - 40)
        for around, s, k, e in _loosened(text[first : end + 40], start - first, kind, end - first):
            yield k, 1.0, list(map(float, features(around, s, k, e)))
    taken = Taken(base)
    for start, kind, end in candidates(text):
        if not taken.touches(start, end):
            label = true_span(text, start, kind, end)
            if label is not None:
                yield kind, float(label), list(map(float, features(text, start, kind, end)))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for held, text in zip(batch.column("held").to_pylist(), batch.column("text").to_pylist()):
            rows += [(held, *row) for row in _example_rows(text)]
        columns = list(zip(*rows)) or [(), (), (), ()]
        kinds = [pa.bool_(), pa.int32(), pa.float64(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["held", "kind", "label", "features"]
        )


def _score_counts(trees: Trees):
    """How many examples of a task have each score, by kind and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for fitted, text in zip(part.column("fitted").to_pylist(), part.column("text").to_pylist()):
                    rows += [(fitted, *row) for row in _example_rows(text)]
                if rows:
                    scores = trees.scores(np.array([r[3] for r in rows]))
                    bins = np.floor(scores * BINS).astype(np.int64).tolist()
                    total.update((f, k, int(label), b) for (f, k, label, _), b in zip(rows, bins))
        columns = [*zip(*total)] or [(), (), (), ()]
        names = ["fitted", "kind", "label", "bin", "n"]
        types = [pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip([*columns, list(total.values())], types)]
        yield pa.RecordBatch.from_arrays(arrays, names)

    return run


@dataclass(frozen=True)
class Trees:
    """Boosted regression trees as flat arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    cuts: tuple[float, ...]

    def scores(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        each = np.arange(len(rows))
        for root, weight in zip(self.roots, self.weights):
            node = np.full(len(rows), root)
            for _ in range(DEPTH + 1):
                goes = rows[each, self.feature[node]] <= self.threshold[node]
                node = np.where(goes, self.left[node], self.right[node])
            total += weight * self.value[node]
        return 1 / (1 + np.exp(-2 * total))


def _flatten(model) -> tuple[list, list[int]]:
    """(feature, threshold, left, right, value) of every node, and the roots."""
    nodes: list[list] = []

    def add(node) -> int:
        place = len(nodes)
        nodes.append([0, 0.0, place, place, node.prediction()])
        if node.subtreeDepth() > 0:
            split = node.split()
            nodes[place][:2] = [split.featureIndex(), split.threshold()]
            nodes[place][2] = add(node.leftChild())
            nodes[place][3] = add(node.rightChild())
        return place

    return nodes, [add(tree._call_java("rootNode")) for tree in model.trees]


NO_TREES = Trees(*[np.zeros(0, np.int64)] * 4, np.zeros(0), np.zeros(0, np.int64), np.zeros(0), (2.0,) * len(KINDS))


def fit_trees(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 5) -> Trees:
    """Fits on FIT_DOCUMENTS documents with a hint of personal data at most, taken by a
    hash of their ids; every fourth of these and all other documents are held out for
    the thresholds.

    Base spans, also in looser forms, are true examples. Candidates that touch no base span
    are labelled by ``true_span``: rules on the checks and layouts of whole spans, which find
    what the base patterns miss; those it cannot tell are no examples. A kind whose true spans all lie in documents fitted on is
    calibrated on these as well. A kind whose spans never reach PRECISION gets
    no threshold; without both sorts of examples nothing is added at all.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    hinted = texts.filter(F.col("text").rlike(_HINT.pattern) & F.col("id").isNotNull())
    order = F.xxhash64(F.lit(seed), "id")
    chosen = hinted.select("id").orderBy(order, "id").limit(FIT_DOCUMENTS).distinct()
    # Bounded by FIT_DOCUMENTS ids.
    sample = hinted.join(F.broadcast(chosen), "id").select((F.pmod(order, F.lit(4)) == 0).alias("held"), "text")
    rows = sample.mapInArrow(_examples, "held boolean, kind int, label double, features array<double>")
    rows = rows.orderBy(F.xxhash64("features", "label"), "held").limit(FIT_CANDIDATES).toPandas()
    if rows["label"].nunique() < 2 or rows["held"].nunique() < 2:
        return NO_TREES
    rows["features"] = rows["features"].map(list)
    fitted = spark.createDataFrame(rows[~rows["held"]][["label", "features"]]).coalesce(1)
    fitted = fitted.select("label", array_to_vector("features").alias("features")).cache()
    try:
        if fitted.select("label").distinct().count() < 2:
            return NO_TREES
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, maxBins=64, seed=seed).fit(fitted)
    finally:
        fitted.unpersist()
    nodes, roots = _flatten(model)
    feature, threshold, left, right, value = map(np.array, zip(*nodes))
    trees = Trees(feature, threshold, left, right, value, np.array(roots), np.array(model.treeWeights), ())
    last = chosen.agg(F.max(order)).first()[0]
    fit = F.coalesce(F.col("id").isNotNull() & (order <= last) & (F.pmod(order, F.lit(4)) != 0), F.lit(False))
    counts = texts.select(fit.alias("fitted"), "text").mapInArrow(
        _score_counts(trees), "fitted boolean, kind int, label int, bin int, n long"
    )
    # A row for each kind, label and bin at most.
    counts = counts.groupBy("fitted", "kind", "label", "bin").agg(F.sum("n").alias("n")).toPandas()
    cuts = []
    for kind in range(len(KINDS)):
        own = counts[counts["kind"] == kind]
        held = own[~own["fitted"].astype(bool)]
        cuts.append(_cut(held if held["label"].any() else own))
    return Trees(feature, threshold, left, right, value, trees.roots, trees.weights, tuple(cuts))


def _cut(counts: pd.DataFrame) -> float:
    """The lowest score from which on the share of true spans is PRECISION."""
    if not counts["label"].any():
        return 2.0
    bins = counts.assign(true=counts["n"] * counts["label"]).groupby("bin")[["true", "n"]].sum().sort_index(ascending=False)
    totals = bins.cumsum()
    good = np.flatnonzero(totals["true"] / totals["n"] >= PRECISION)
    if not len(good):
        return 2.0
    # Half way to the next lower score, at an even chance or better.
    last = bins.index[good[-1]]
    lower = bins.index[good[-1] + 1] + 1 if good[-1] + 1 < len(bins) else last
    return max(0.5, float(last + lower) / 2 / BINS)


def all_spans(text: str, trees: Trees) -> tuple[list, list]:
    """Base spans, and these with the selected candidates that touch none of them.

    Of selected candidates that overlap, the one with the better score is taken, then
    the longer, then the earlier one.
    """
    if not text or not _HINT.search(text):
        return [], []
    base = base_spans(text)
    if not len(trees.roots):
        return base, base
    taken = Taken(base)
    proposed = [c for c in candidates(text) if not taken.touches(c[0], c[2])]
    good: list[tuple[float, tuple[int, int, int]]] = []
    for first in range(0, len(proposed), 4096):
        some = proposed[first : first + 4096]
        scores = trees.scores(np.array([features(text, *c) for c in some], float))
        good += [(score, c) for score, c in zip(scores.tolist(), some) if score >= trees.cuts[c[1]]]
    return base, sorted(base + _best_apart(good))


def _best_apart(scored: list[tuple[float, tuple[int, int, int]]]) -> list[tuple[int, int, int]]:
    """Spans of which none overlap, better ones first; ``scored`` in order of start.

    Only spans that overlap, one after the other, are held against one another.
    """
    chosen, group, reach = [], [], 0
    for score, span in [*scored, (0.0, (1 << 62, 0, 1 << 62))]:
        if span[0] >= reach and group:
            group.sort(key=lambda x: (-x[0], x[1][0] - x[1][2], x[1]))
            own: list[tuple[int, int]] = []
            for _, (start, kind, end) in group:
                at = bisect_left(own, (start, end))
                before = at > 0 and own[at - 1][1] > start
                if not before and not (at < len(own) and own[at][0] < end):
                    own.insert(at, (start, end))
                    chosen.append((start, kind, end))
            group = []
        group.append((score, span))
        reach = max(reach, span[2])
    return chosen


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlaps become one."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[kind].upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def _judge(trees: Trees):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for text in part.column("text").to_pylist():
                    text = text or ""
                    base, spans = all_spans(text, trees)
                    counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
                    digest = hashlib.sha256(written(base).encode()).hexdigest()
                    rows.append((*counts, digest, written(spans), redact(text, spans)))
                columns = list(zip(*rows))
                kinds = [pa.int64()] * len(KINDS) + [pa.string()] * 3
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                    ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "redacted"],
                )

    return run


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_<kind> of base spans, base_sha256, spans, redacted.

    Spans are written ``kind:start:end`` in code points, by start and then kind;
    ``spans`` has the base spans and those that the trees add. Null and empty texts have
    none. Rows that repeat an id, or have none, are judged one by one. An empty table
    gives no rows; other columns are ignored. Texts never leave their task; a very long
    one takes time in proportion to its length.
    """
    trees = fit_trees(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(
        _judge(trees), f"doc_id long, {counts}, base_sha256 string, spans string, redacted string"
    )
