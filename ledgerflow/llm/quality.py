"""Quality rules by distribution divergence (operator 1), DataFrame functions only.

A document's character classes and its common words are two histograms; each
is compared with the reference of the document's language by Jensen-Shannon
distance (base 2, 0 to 1). References are the mean histograms over all
documents of the language that pass the length guards, so they follow the
corpus. A histogram below its length guard gives no verdict. Languages outside
`COMMON` (null too) share one reference and are judged by character classes only.

Null and empty texts have no words and fail the base rule. Rows are judged one
by one: repeated rows get equal verdicts. An empty table gives an empty result;
other columns are carried untouched, whatever their names, or ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import WORD, stored

# Frequent function words of each language.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "was", "on"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"],
}
CLASSES = ("lower", "upper", "digit", "space", "symbol", "accented", "other")
#: length guards, and the distances above which a document is rejected
MIN_CHARS, MIN_WORDS = 400, 100
MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE = 0.28, 0.26
#: base rule
BASE_MIN_WORDS, BASE_REPEAT_PERCENT, WINDOW = 10, 20, 5


def _without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def measured(docs: DataFrame, carried: Sequence[str]) -> DataFrame:
    """(row, m): the named columns of each row, untouched in a struct of their own, and its measures.

    The measures need no reference, so a caller who stores the result measures
    every text once.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    packed = F.struct(*[F.col(f"`{c}`") for c in carried]) if carried else F.struct(F.lit(0).alias("none"))
    out = docs.select(packed.alias("row"), text.alias("text"), F.col("lang").cast("string").alias("lang"))
    # each class is taken out of what the classes before it left
    left = [F.col("text")]
    for pattern in ("[a-z]+", r"[\x20\x09-\x0D]+", "[A-Z]+", "[0-9]+", "[#*$%&|<>]+", r"[\x00-\x7F]+"):
        left.append(_without(left[-1], pattern))
    names = ("lower", "space", "upper", "digit", "symbol", "other")
    language = F.when(F.col("lang").isin(*COMMON), F.col("lang")).otherwise(F.lit("other"))
    lists = F.create_map(*[x for k, v in COMMON.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    out = out.withColumn("q", F.struct(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"), language.alias("language")))
    out = out.withColumn("left", F.struct(*[F.char_length(x).alias(f"n{i}") for i, x in enumerate(left)]))
    n = [F.col("left")[f"n{i}"] for i in range(len(left))]
    counts = {name: n[i] - n[i + 1] for i, name in enumerate(names)} | {"accented": n[-1]}
    every = sorted({w for v in COMMON.values() for w in v})
    out = out.withColumn("known", F.filter(F.col("q.words"), lambda w: w.isin(*every)))
    mine = F.coalesce(F.element_at(lists, F.col("q.language")), F.array().cast("array<string>"))
    out = out.withColumn("hist", F.transform(mine, lambda w: F.size(F.filter(F.col("known"), lambda x: x == w))))
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    out = out.withColumn("lines", lines).withColumn("windows", _repeat_words(F.col("q.words")))
    # windows that occur twice: neighbours in the order of their hashes; only documents that repeat something pay for it
    ordered = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), ordered))
    twins = F.filter("ordered", lambda x, j: (x["h"] == F.get("ordered", j - 1)["h"]) | (x["h"] == F.get("ordered", j + 1)["h"]))
    out = out.withColumn("twins", F.sort_array(F.transform(twins, lambda x: x["i"])))
    covered = F.aggregate(
        "twins",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(WINDOW), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    words = F.size(F.col("q.words"))
    measures = F.struct(
        F.col("q.language").alias("language"),
        words.alias("n_words"),
        n[0].alias("n_chars"),
        F.array(*[counts[c] for c in CLASSES]).alias("classes"),
        F.concat("hist", F.array(words - F.aggregate("hist", F.lit(0), lambda s, x: s + x))).alias("common"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).alias("n_repeat_words"),
    )
    return out.select("row", measures.alias("m"))


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: x / total)


def references_of(seen: DataFrame) -> DataFrame:
    """References from measured documents; see `references`."""
    seen = seen.select("m.language", F.when(F.col("m.n_chars") >= MIN_CHARS, _shares(F.col("m.classes"), F.col("m.n_chars"))).alias("c"), F.when(F.col("m.n_words") >= MIN_WORDS, _shares(F.col("m.common"), F.col("m.n_words"))).alias("w"))
    longest = max(map(len, COMMON.values())) + 1
    parts = [F.round(F.avg(F.get("c", F.lit(i))), 6).alias(f"c{i}") for i in range(len(CLASSES))]
    parts += [F.round(F.avg(F.get("w", F.lit(i))), 6).alias(f"w{i}") for i in range(longest)]
    means = seen.groupBy("language").agg(*parts)
    return stored(means.select(F.col("language").alias("ref_language"), F.array(*[f"c{i}" for i in range(len(CLASSES))]).alias("ref_classes"), F.array(*[f"w{i}" for i in range(longest)]).alias("ref_words")))


def references(docs: DataFrame) -> DataFrame:
    """One row per language of `COMMON` and one for all others: mean class and word shares.

    Keep the result, and documents judged later don't depend on their neighbours.
    """
    return references_of(measured(docs, []))


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (square root, base 2) of two histograms of shares."""

    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: part(a, F.coalesce(b, F.lit(0.0))) + part(F.coalesce(b, F.lit(0.0)), a))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x) / 2, F.lit(0.0)))


def _repeat_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more in the document."""
    n = F.size(words)
    return F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), F.greatest(n - WINDOW, F.lit(0))), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))


def verdicts(seen: DataFrame, refs: DataFrame) -> DataFrame:
    """(row, quality_...): measured documents against the references, which have one row per language and are broadcast."""
    out = seen.join(F.broadcast(refs), F.col("m.language") == F.col("ref_language"), "left")
    words, chars = F.col("m.n_words"), F.col("m.n_chars")
    char_distance = F.when(chars >= MIN_CHARS, js_distance(_shares(F.col("m.classes"), chars), F.col("ref_classes")))
    word_distance = F.when((words >= MIN_WORDS) & (F.col("m.language") != "other"), js_distance(_shares(F.col("m.common"), words), F.slice("ref_words", 1, F.size("m.common"))))
    out = out.select(
        "row",
        words.cast("long").alias("quality_n_words"),
        (chars - F.get("m.classes", F.lit(CLASSES.index("space")))).cast("long").alias("quality_word_chars"),
        F.get("m.classes", F.lit(CLASSES.index("symbol"))).cast("long").alias("quality_n_symbols"),
        F.col("m.n_dup_lines").cast("long").alias("quality_n_dup_lines"),
        F.col("m.n_repeat_words").cast("long").alias("quality_n_repeat_words"),
        char_distance.alias("quality_char_distance"),
        word_distance.alias("quality_word_distance"),
    )
    failed = (F.col("quality_n_words") < BASE_MIN_WORDS) | (100 * F.col("quality_n_repeat_words") > BASE_REPEAT_PERCENT * F.col("quality_n_words"))
    # one number of both sides of the join, so that a filter on the verdict stays above it and measures no text twice
    excess = F.greatest(
        F.coalesce("quality_char_distance", F.lit(0.0)) / MAX_CHAR_DISTANCE, F.coalesce("quality_word_distance", F.lit(0.0)) / MAX_WORD_DISTANCE, F.when(failed, F.lit(2.0)).otherwise(F.lit(0.0))
    )
    return out.withColumn("quality_base_failed", failed).withColumn("quality_kept", excess <= 1)


def judged(docs: DataFrame, refs: DataFrame) -> DataFrame:
    """The documents with the base measures, distances and the verdict; columns are prefixed `quality_`.

    A column of the documents with such a name gives way to the verdict's; the
    others stay as they are, whatever their names. Texts are measured when the
    result is computed: store or cache it before filtering it.
    """
    out = verdicts(measured(docs, docs.columns), refs)
    told = [c for c in out.columns if c != "row"]
    kept = [c for c in docs.columns if c.lower() not in told]
    return out.select(*[F.col("row")[c].alias(c) for c in kept], *told)


def judge_all(docs: DataFrame, carried: Sequence[str]) -> DataFrame:
    """(row, quality_...) of all documents, with references from these very documents; every text is measured once."""
    seen = stored(measured(docs, carried))
    return verdicts(seen, references_of(seen))


def keep_good(docs: DataFrame, refs: DataFrame | None = None) -> DataFrame:
    """The documents that pass, with their own columns only; references are made from them where none are given."""
    out = judge_all(docs, docs.columns) if refs is None else verdicts(measured(docs, docs.columns), refs)
    return out.where("quality_kept").select(*[F.col("row")[c].alias(c) for c in docs.columns])
