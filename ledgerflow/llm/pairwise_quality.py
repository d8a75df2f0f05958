"""Quality scores learned from preference pairs (operator 13).

A document of label 1 is preferred to one of label 0. By the Bradley-Terry model
the better document of a pair wins with a probability that grows with the
difference of their scores; a score is linear in features of the text, so the
weights are those of a logistic loss on feature differences, without a constant.
Scores then get their threshold from a quantile: the share of label 0 among all
labelled documents tells where in their order of scores the good ones begin.

Features are counts and shares of the whole text, nothing but the text is read
for them. Their means and spreads come from all documents, the quantile from all
labelled ones. Pairs are formed from about `TRAIN_ROWS` documents of each label,
drawn by the hash of their id, and `PARTNERS` partners for each.

Null and empty texts have features too and get a score. Rows are scored one by
one, so repeated rows get equal scores. A document labelled both ways has no
label; labels of unknown documents are not used. Without labels of both kinds
every score is 0.5. An empty table gives an empty result; other columns are not
read. A text's length only matters in proportion.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from math import log, log1p, sqrt

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import stored

#: documents of each label that pairs are drawn from, about, and partners of each
TRAIN_ROWS, PARTNERS = 4_000, 8
#: the score at which a document is predicted to be good
THRESHOLD = 0.3
REGULARISATION = 1e-3
_ACCURACY = 100_000  # of the quantile: its rank is right to one in so many

# byte classes whose shares are features
_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "symbol": b"#*$%&@^~=+_\\",
    "bracket": b"|<>[]{}()/",
    "bang": b"!?",
    "stop": b".,;:",
    "quote": b"'\"`-",
    "space": b" \t\r\n",
    "high": bytes(range(128, 256)),
}
_OF_BYTE = np.zeros((256, len(_CLASSES)))
for _n, _members in enumerate(_CLASSES.values()):
    _OF_BYTE[list(_members), _n] = 1
NAMES = (*_CLASSES, "words", "word_bytes", "distinct", "commonest", "doubled", "repeated", "lines", "same_lines", "ended", "short")


def measure(text: bytes) -> list[float]:
    """Features of a text, in the order of `NAMES`."""
    shares = np.bincount(np.frombuffer(text, np.uint8), minlength=256) @ _OF_BYTE / max(len(text), 1)
    words = text.split()
    n = len(words)
    counts = Counter(words)
    doubled = sum(map(operator.eq, words, islice(words, 1, None)))
    threes = max(n - 2, 0)
    repeated = threes - len(set(zip(words, islice(words, 1, None), islice(words, 2, None), strict=False)))
    lines = [line for line in text.split(b"\n") if line.strip()]
    ended = sum(line.rstrip().endswith((b".", b"!", b"?", b":")) for line in lines)
    return [
        *np.sqrt(shares).tolist(),
        min(log1p(n), 8.0),
        log1p(sum(map(len, words)) / max(n, 1)),
        log1p(len(counts)) / log1p(n) if n else 1.0,
        sqrt(max(counts.values(), default=0) / max(n, 1)),
        sqrt(doubled / max(n - 1, 1)),
        sqrt(repeated / max(threes, 1)),
        log1p(n / max(len(lines), 1)),
        sqrt(1 - len(set(lines)) / max(len(lines), 1)) if lines else 0.0,
        ended / max(len(lines), 1),
        1.0 if n < 10 else 0.0,
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measure(text.as_py() or b"") for text in batch.column("text")]
        columns = np.array(rows, float).reshape(-1, len(NAMES)).T
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c) for c in columns]], names=["doc_id", *NAMES])


def features(docs: DataFrame) -> DataFrame:
    """Stored (doc_id, *NAMES), one row per document."""
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return stored(read.mapInArrow(_measure, "doc_id long, " + ", ".join(f"{n} double" for n in NAMES)))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: the CRC-32 of the id as text divides by 5; null ids too."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 5 == 0, F.lit(True))


def known_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, good): one row per document that is labelled one way and not held out."""
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    return told.groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high")).where("low = high").select("doc_id", (F.col("low") == 1).alias("good"))


@dataclass(frozen=True)
class Ranking:
    """Weights on the features and the constant that puts the quantile's score at `THRESHOLD`."""

    weights: dict[str, float]
    constant: float

    def strength(self) -> Column:
        """The Bradley-Terry score: its differences are log odds of preference."""
        return sum((F.col(n) * F.lit(w) for n, w in self.weights.items()), F.lit(0.0))

    def score(self) -> Column:
        return 1 / (1 + F.exp(-(self.strength() + F.lit(self.constant))))


UNTAUGHT = Ranking({}, 0.0)


def pairs(labelled: DataFrame, spreads: dict[str, float], good: int, bad: int, rows: int = TRAIN_ROWS, partners: int = PARTNERS) -> DataFrame:
    """Preference pairs as scaled feature differences: `label` 1 for good minus bad, 0 for the same the other way round.

    `good` and `bad` are the numbers of labelled documents. Each label's rows
    are numbered; pair i joins the rows of number i and i + k times a stride, so
    that all rows of the more frequent label are used.
    """
    draw = F.xxhash64(F.lit("draw"), "doc_id").bitwiseAND((1 << 62) - 1) / float(1 << 62)
    wanted = F.when(F.col("good"), F.lit(rows / good)).otherwise(F.lit(rows / bad))
    number = F.row_number().over(Window.partitionBy("good").orderBy(F.xxhash64("doc_id"), "doc_id", *NAMES)) - 1
    scaled = F.array(*[F.col(n) / F.lit(spreads[n]) for n in NAMES])
    drawn = stored(labelled.where(draw < wanted).select("good", number.alias("number"), scaled.alias("x")))
    sizes = {r["good"]: r["n"] for r in drawn.groupBy("good").agg(F.count("*").alias("n")).collect()}
    most = max(sizes.values(), default=0)
    if len(sizes) < 2:
        return drawn.sparkSession.createDataFrame([], "x array<double>, label double")
    i, k = F.floor(F.col("id") / partners), F.col("id") % partners
    plan = drawn.sparkSession.range(most * partners).select((i % sizes[True]).alias("one"), ((i + k * 7919) % sizes[False]).alias("two"))
    one = drawn.where("good").select(F.col("number").alias("one"), F.col("x").alias("x_one"))
    two = drawn.where("NOT good").select(F.col("number").alias("two"), F.col("x").alias("x_two"))
    met = plan.join(one, "one").join(two, "two")
    ways = F.explode(F.array(F.struct(F.col("x_one").alias("a"), F.col("x_two").alias("b"), F.lit(1.0).alias("label")), F.struct(F.col("x_two").alias("a"), F.col("x_one").alias("b"), F.lit(0.0).alias("label"))))
    return met.select(ways.alias("w")).select(F.zip_with("w.a", "w.b", lambda a, b: a - b).alias("x"), "w.label")


def fit(measured: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, partners: int = PARTNERS) -> Ranking:
    """Learn from `features` of documents and (doc_id, quality); held-out rows are not used."""
    labelled = stored(measured.join(known_labels(labels), "doc_id"))
    sizes = {r["good"]: r["n"] for r in labelled.groupBy("good").agg(F.count("*").alias("n")).collect()}
    good, bad = sizes.get(True, 0), sizes.get(False, 0)
    if not good or not bad:
        return UNTAUGHT
    spread = measured.agg(*[F.stddev_pop(n).alias(n) for n in NAMES]).first().asDict()
    spreads = {n: s if s and s > 1e-9 else 1.0 for n, s in spread.items()}
    train = stored(pairs(labelled, spreads, good, bad, rows, partners)).select(array_to_vector("x").alias("features"), "label")
    if train.isEmpty():
        return UNTAUGHT
    model = LogisticRegression(fitIntercept=False, standardization=False, regParam=REGULARISATION, maxIter=60).fit(train)
    weights = {n: float(w) / spreads[n] for n, w in zip(NAMES, model.coefficients.toArray(), strict=True)}
    raw = Ranking(weights, 0.0)
    # the worst scores, as many as there are documents of label 0, and the next better one
    scores = labelled.select(raw.strength().alias("s"))
    last = scores.agg(F.percentile_approx("s", F.lit(bad / (good + bad)), F.lit(_ACCURACY)).alias("t")).first()["t"]
    above = scores.where(F.col("s") > last).agg(F.min("s").alias("t")).first()["t"]
    threshold = last if above is None else (last + above) / 2
    return Ranking(weights, log(THRESHOLD / (1 - THRESHOLD)) - threshold)


def scored(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, partners: int = PARTNERS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    measured = features(docs)
    ranking = fit(measured, labels, rows, partners)
    out = measured.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), ranking.score().alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
