r"""Personal data by candidate gradient boosting (operator 7).

Generators propose overlapping spans with high recall: the four strict formats
and looser ones (spelled-out addresses with or without brackets, dotted quads,
digit groups with any separators). Boosted trees score a candidate by its digit groups and the words
around it, with the marks masked that make a span strict: a leading + and country
code, the kind of separators, @ against (at), the checksums. They learn strict
spans against all other candidates. All candidates of all documents count, none is
drawn: equal ones, of one kind, label and features, become one row that weighs as many
as it stands for, half of them (by the hash of their row) for the trees and half held
out for the thresholds. Features are whole numbers up to `MOST`, so the rows are as many
as there are feature vectors, however many documents there are. Candidates that no strict span explains and no checksum rules out are
unlabelled, not wrong: with c the mean score of a kind's held-out strict spans, one
of score g is personal data with probability (1-c)/c * g/(1-g) (Elkan and Noto
2008). Only such candidates are scored; one is added if its score reaches the
threshold of its kind, from which on held-out unlabelled ones have a probability of
`LEAST` or more each and of `PRECISION` or more on average, and if it touches no span kept so far; the
strict spans always stay. Offsets are code points, ends exclusive.

Null texts are empty. Documents are read one by one and may repeat; texts of any
length take time in proportion to their length. A kind without held-out strict
spans or without held-out unlabelled candidates gets none added. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
TREES, DEPTH, PRECISION, LEAST = 10, 3, 0.9, 0.5
#: larger features count as this; every value of one is a place to split at
MOST, BINS = 255, 1024
#: no longer read, as nothing is drawn; tests set it
DRAWN = 500

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]{1,64}(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]{1,64})+")
_WORDED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20(?:at|AT)\x20[A-Za-z0-9-]{1,64}(?:\x20(?:dot|DOT)\x20[A-Za-z0-9-]{1,64})+")
_GROUPS = re.compile(r"(?<![0-9])\(?[0-9](?:[\x20()./-]{0,2}[0-9])+")
_NOT_DIGITS = bytes(set(range(256)) - set(b"0123456789"))
# Words near personal data.
_HINTS = ("mail", "contact", "call", "tel", "phone", "fax", "mobile", "card", "visa", "credit", "account", "ip", "address", "server")
_AT, _DOT = re.compile(r"\x20?[\[(](?:at|AT)[\])]\x20?|\x20(?:at|AT)\x20"), re.compile(r"\x20?[\[(](?:dot|DOT)[\])]\x20?|\x20(?:dot|DOT)\x20")
N_FEATURES = 11
STRICT, RULED_OUT, OPEN = 1.0, 0.0, -1.0


def luhn(digits: str) -> bool:
    odd = [int(c) for c in digits[-1::-2]]
    even = [2 * int(c) for c in digits[-2::-2]]
    return (sum(odd) + sum(x - 9 * (x > 9) for x in even)) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from their @ so that long runs cost once."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        free = domain.end() if domain else at + 1
        if domain:
            yield start, free
        at = text.find("@", free)


def base_spans(text: str, many_digits: bool = True) -> list[tuple[str, int, int]]:
    found = [("email", a, b) for a, b in emails(text)]
    if many_digits:
        found += [("ip", *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            digits = _digits(m[0]) if m.end() - m.start() <= 40 else ""
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def candidates(text: str, many_digits: bool) -> list[tuple[str, int, int]]:
    """Looser spans; they may overlap the strict ones and each other."""
    found = []
    if "(at)" in text or "[at]" in text or "(AT)" in text or "[AT]" in text:
        found += [("email", *m.span()) for m in _SPELLED.finditer(text)]
    if " dot " in text or " DOT " in text:
        found += [("email", *m.span()) for m in _WORDED.finditer(text)]
    if many_digits:
        found += [("ip", *m.span()) for m in _IP.finditer(text)]
        for m in _GROUPS.finditer(text):
            n = len(_digits(m[0])) if m.end() - m.start() <= 60 else 0
            if 7 <= n <= 19:
                found.append(("card" if n >= 13 else "phone", *m.span()))
    return found


def masked(kind: str, span: str) -> str:
    """The span without what tells a strict one from a looser one: separators, country code, spelling of @."""
    if kind == "email":
        return _DOT.sub(".", _AT.sub("@", span))
    groups = re.findall(r"[0-9]+", span)
    if kind == "phone" and len(groups) > 1 and len(groups[0]) <= 3 and sum(map(len, groups)) > 10:
        groups = groups[1:]
    return " ".join(groups)


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    span = masked(kind, text[start:end])
    groups = [len(g) for g in re.findall(r"[0-9]+", span)]
    before = text[max(0, start - 30) : start].lower()
    found = [
        KINDS.index(kind),
        len(span),
        sum(groups),
        len(groups),
        max(groups, default=0),
        min(groups, default=0),
        groups[0] if groups else 0,
        groups[-1] if groups else 0,
        span.count("."),
        any(w in before for w in _HINTS),
        text[end : end + 1].isalnum() or text[max(0, start - 1) : start].isalnum(),
    ]
    return [float(min(n, MOST)) for n in found]


class Disjoint:
    """Spans that do not overlap each other, in order: whether another one touches them is a search by halves."""

    def __init__(self):
        self._starts: list[int] = []
        self._ends: list[int] = []

    def touched(self, start: int, end: int) -> bool:
        at = bisect_right(self._ends, start)
        return at < len(self._starts) and self._starts[at] < end

    def add(self, start: int, end: int) -> None:
        at = bisect_right(self._starts, start)
        self._starts.insert(at, start)
        self._ends.insert(at, end)


def by_kind(base: list[tuple[str, int, int]]) -> dict[str, Disjoint]:
    """The strict spans of each kind, which do not overlap."""
    out = {kind: Disjoint() for kind in KINDS}
    for kind, a, b in base:
        out[kind].add(a, b)
    return out


def unexplained(text: str, many_digits: bool, base: list[tuple[str, int, int]]) -> list[tuple[float, str, int, int]]:
    """The candidates that overlap no strict span of their kind, `OPEN` or `RULED_OUT`.

    Ruled out are those on strict spans of other kinds, card numbers that fail
    their checksum and dotted quads that are no address.
    """
    found, strict = [], by_kind(base)
    for kind, a, b in candidates(text, many_digits):
        touched = {k for k, spans_ in strict.items() if spans_.touched(a, b)}
        if kind not in touched:
            out = touched or kind == "ip" or (kind == "card" and not luhn(_digits(text[a:b])))
            found.append((RULED_OUT if out else OPEN, kind, a, b))
    return found


def _scan(data: bytes | None) -> tuple[str, bool]:
    """The text, and whether it has digits enough for a number format; '' if nothing can be found in it."""
    data = data or b""
    many = len(data.translate(None, _NOT_DIGITS)) >= 4
    if not many and b"@" not in data:
        low = data.lower()
        if not any(mark in low for mark in (b"(at)", b"[at]", b" dot ")):
            return "", False
    return data.decode("utf-8", "replace"), many


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        order, x, y, kinds = [], [], [], []
        for key, data in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
            text, many = _scan(data.as_py())
            if not text:
                continue
            base = base_spans(text, many)
            for n, (label, kind, a, b) in enumerate([(STRICT, *s) for s in base] + unexplained(text, many, base)):
                order.append(key + n)
                x.append(features(text, kind, a, b))
                y.append(label)
                kinds.append(kind)
        yield pa.RecordBatch.from_arrays([pa.array(order, pa.int64()), pa.array(kinds, pa.string()), pa.array(x, pa.list_(pa.float64())), pa.array(y, pa.float64())], names=["key", "kind", "x", "label"])


def _tree(node):
    """A tree of nested (feature, threshold, below, above) from a node of the model."""
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return int(split.featureIndex()), float(split.threshold()), _tree(node.leftChild()), _tree(node.rightChild())


def _predict(tree, x: list[float]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def margin(model: list, x: list[float]) -> float:
    return sum(weight * _predict(tree, x) for weight, tree in model)


def score(model: list, x: list[float]) -> float:
    return 1 / (1 + math.exp(-2 * margin(model, x)))


def calibrated(strict: list[tuple[float, int]], open_: list[tuple[float, int]]) -> float:
    """The least score from which the unlabelled ones are probable, each and on average; infinite without either.

    Both list each score once, with how many have it.
    """
    if not strict or not open_:
        return math.inf
    c = math.fsum(g * n for g, n in strict) / sum(n for _, n in strict)
    threshold, right, seen = math.inf, 0.0, 0
    for g, n in sorted(open_, reverse=True):
        chance = min(1.0, (1 - c) / c * g / (1 - g))
        if chance < LEAST:
            break
        right, seen = right + n * chance, seen + n
        if right >= PRECISION * seen:
            threshold = g
    return threshold


def _scored(shared):
    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score(shared.value, x) for x in batch.column("x").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("kind", "label", "n")), pa.array(scores, pa.float64())], names=["kind", "label", "n", "score"])

    return scored


def fit(docs: DataFrame) -> tuple[list, dict[str, float]]:
    """Boosted trees and, by kind, the calibrated score from which a candidate is added; from all candidates."""
    text, label = F.col("text").cast("binary"), F.col("label")
    keyed = docs.select(F.xxhash64(F.col("doc_id").cast("long"), text).alias("key"), text.alias("text"))
    rows = keyed.mapInArrow(_examples, "key long, kind string, x array<double>, label double")
    held = F.pmod(F.xxhash64("key", "x"), F.lit(2)) == 1
    counted = stored(rows.groupBy("kind", "label", "x", held.alias("held")).agg(F.count("*").alias("n")))
    # one number in ten passes the card checksum by chance, so nine that fail stand for one that passes and is none
    weight = F.col("n") * F.when((label == RULED_OUT) & (F.col("kind") == "card"), F.lit(1 / 9)).otherwise(1.0)
    train = counted.where(~F.col("held")).select("x", (label == STRICT).cast("double").alias("label"), weight.alias("weight"))
    if train.select("label").distinct().count() < 2:
        return [], {}
    # a row per feature vector, in one order, so that sums of fractions are the same in every run
    train = train.repartition(1).sortWithinPartitions("x", "label", "weight")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=BINS, seed=1, weightCol="weight")
    fitted = trees.fit(train.select(array_to_vector("x").alias("features"), "label", "weight"))
    model = [(w, _tree(t._java_obj.rootNode())) for w, t in zip(fitted.treeWeights, fitted.trees, strict=True)]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    told = counted.where(F.col("held") & (label != RULED_OUT)).mapInArrow(_scored(shared), "kind string, label double, n long, score double")
    scores = {(kind, tag): [] for kind in KINDS for tag in (STRICT, OPEN)}
    for r in told.groupBy("kind", "label", "score").agg(F.sum("n").alias("n")).collect():  # a few trees give few scores
        scores[r["kind"], r["label"]].append((r["score"], r["n"]))
    return model, {kind: calibrated(scores[kind, STRICT], scores[kind, OPEN]) for kind in KINDS}


def spans(data: bytes | None, model: list, thresholds: dict[str, float]) -> tuple[list, list]:
    """Strict spans, and all spans with the added ones, in the order of kind and start."""
    text, many = _scan(data)
    if not text:
        return [], []
    base = base_spans(text, many)
    every, added = list(base), Disjoint()
    if model:
        strict = by_kind(base)
        loose = [(score(model, features(text, k, a, b)), k, a, b) for label, k, a, b in unexplained(text, many, base) if label == OPEN]
        for g, kind, a, b in sorted(loose, key=lambda x: (-x[0], x[2], x[3])):
            if g >= thresholds[kind] and not added.touched(a, b) and not any(s.touched(a, b) for s in strict.values()):
                every.append((kind, a, b))
                added.add(a, b)
    order = {k: i for i, k in enumerate(KINDS)}
    return base, sorted(every, key=lambda s: (order[s[0]], s[1]))


def _told(found: list) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def _find(shared):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, thresholds = shared.value
        for batch in batches:
            out = [spans(t.as_py(), model, thresholds) for t in batch.column("text")]
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in out], pa.int64()) for k in KINDS]
            digests = pa.array([hashlib.sha256(_told(base).encode()).hexdigest() for base, _ in out], pa.string())
            told = [pa.array([_told(every) for _, every in out], pa.string()), pa.array([len(every) for _, every in out], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *counts, digests, *told], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_spans"])

    return find


def found(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans (of all of them)."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return read.mapInArrow(_find(shared), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long")


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every span of their text replaced by its kind in brackets; other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs))

    @F.udf("string", useArrow=True)
    def redact(text):
        if text is None:
            return None
        out, free = [], 0
        for kind, a, b in sorted(spans(text.encode("utf-8", "replace"), *shared.value)[1], key=lambda s: s[1]):
            if a >= free:
                out += [text[free:a], f"[{kind}]"]
                free = b
        return "".join(out) + text[free:]

    return docs.withColumn("text", redact(F.col("text").cast("string")))
