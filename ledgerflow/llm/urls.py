"""URL filter: rules, then naive Bayes over segmented hosts and paths (operator 10).

A rule is `host/path`: it fits its host and all subdomains if the url's path
starts with the rule's; the longest fitting rule decides. Other urls are scored:
a unigram Viterbi splits the letter runs of host labels and path parts into
words, and multinomial naive Bayes (add-one smoothing) weighs the words. The
unigram counts are those of all words of all page texts; they stay a table, and
every distinct run is split with the counts that its own substrings join to, so
no vocabulary passes through the driver and none is cut. What makes the rules
decide is masked before that: the last label of the host, the labels that any
rule's host names and as many first parts of the path as a rule looks at are no
words, so a verdict doesn't follow from them. Naive Bayes learns from
urls that a rule decides, of each verdict the `TRAIN_ROWS` / 2 of least row hash
among all of them, so a rare verdict is not lost; the prior is that of all decided
urls, moved by a constant that makes the sum of their probabilities right where the
drawn ones show it off. Words that no drawn url holds say nothing. A frequent url is
drawn as often as it occurs. Without urls of both verdicts everything else is
allowed; ties allow.

Null urls and urls without `://` have an empty host and path. Rows are judged one
by one and may repeat; an empty table gives an empty result. A letter run of any
length gives its substrings in parts of bounded size.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import ascii_lower, hot_join, stored

RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}
TRAIN_ROWS, LONGEST = 20_000, 24
#: first letters of substrings taken from a run at once
_PART = 4096
_RUN = re.compile(r"[^\W\d_]+|\d+")


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url column."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null."""
    found = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, start = rule.partition("/")
        mine = (host == name) | F.endswith(host, F.lit(f".{name}"))
        found.append(F.when(mine & F.startswith(path, F.lit(f"/{start}")), F.lit(rule)))
    return F.coalesce(*found, F.lit(None).cast("string"))


def masked(host: Column, path: Column, rules: dict[str, str]) -> tuple[Column, Column]:
    """Host and path without what rules look at: see the module's head."""
    names = sorted({label for rule in rules for label in rule.partition("/")[0].split(".")})
    depth = max((len([x for x in rule.partition("/")[2].split("/") if x]) for rule in rules), default=0)
    labels = F.split(host, r"\.")
    kept = F.filter(F.slice(labels, 1, F.size(labels) - 1), lambda x: ~x.isin(*names))
    rest = F.slice(F.split(path, "/"), depth + 2, F.greatest(F.size(F.split(path, "/")), F.lit(1)))
    return F.array_join(kept, "."), F.array_join(rest, "/")


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter[str] = Counter()
        for html in batch.column("html").to_pylist():
            counts.update(w for w in _RUN.findall((html or "").lower()) if 1 < len(w) <= LONGEST and not w.isdigit())
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def word_counts(pages: DataFrame) -> DataFrame:
    """(word, n): every word of two to `LONGEST` letters of all page texts."""
    return stored(pages.select("html").mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


class Segmenter:
    """Unigram Viterbi over a letter run; characters outside the vocabulary stand alone."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = (sum(counts.values()) if total is None else total) + 1
        self._cost = {w: math.log(total / n) for w, n in counts.items()}
        self._alone = math.log(total) + 5.0
        self._known: dict[str, list[str]] = {}

    def words(self, run: str) -> list[str]:
        got = self._known.get(run)
        if got is None:
            if len(self._known) > 200_000:
                self._known.clear()
            got = self._known[run] = self._split(run)
        return got

    def _split(self, run: str) -> list[str]:
        best, back = [0.0], [0]
        for end in range(1, len(run) + 1):
            options = [(best[end - 1] + self._cost.get(run[end - 1], self._alone), end - 1)]
            for start in range(max(0, end - LONGEST), end - 1):
                cost = self._cost.get(run[start:end])
                if cost is not None:
                    options.append((best[start] + cost, start))
            cost, start = min(options)
            best.append(cost)
            back.append(start)
        out, end = [], len(run)
        while end:
            out.append(run[back[end] : end])
            end = back[end]
        return out[::-1]

    def tokens(self, host: str, path: str) -> list[str]:
        """`h:` words of the host, `p:` words of the path; numbers count as one kind."""
        return [kind + w for kind, run in runs(host, path) for w in ([run] if run == "0" else self.words(run))]


def runs(host: str, path: str) -> list[tuple[str, str]]:
    """(`h:` or `p:`, run) of the host and the path; every number is `0`."""
    return [(kind, "0" if run.isdigit() else run) for kind, text in (("h:", host), ("p:", path.lower())) for run in _RUN.findall(text)]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    told = pa.list_(pa.struct([("kind", pa.string()), ("run", pa.string())]))
    for batch in batches:
        lists = [[{"kind": k, "run": r} for k, r in runs(h, p)] for h, p in zip(batch.column("seen_host").to_pylist(), batch.column("seen_path").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, told)], names=[*batch.schema.names, "runs"])


def _substrings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, sub): the distinct substrings of two to `LONGEST` letters of each run."""
    for batch in batches:
        for run in batch.column("run").to_pylist():
            # overlapping parts, so that no substring is missed; one may come twice
            for begin in range(0, max(len(run) - 1, 0), _PART):
                part = run[begin : begin + _PART + LONGEST - 1]
                subs = {part[a:b] for a in range(min(len(part), _PART)) for b in range(a + 2, min(a + LONGEST, len(part)) + 1)}
                if subs:
                    yield pa.RecordBatch.from_arrays([pa.array([run] * len(subs), pa.string()), pa.array(sorted(subs), pa.string())], names=["run", "sub"])


def _split_runs(total: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [Segmenter({k["sub"]: k["n"] for k in known}, total).words(run) for run, known in zip(batch.column("run").to_pylist(), batch.column("known").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("run"), pa.array(lists, pa.list_(pa.string()))], names=["run", "words"])

    return split


def segmented(rows: DataFrame, words: DataFrame) -> DataFrame:
    """`rows` (with seen_host and seen_path) and their tokens; `words` holds the count of every word once."""
    total = words.agg(F.sum("n")).first()[0] or 0
    kept = rows.columns
    marked = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema.fields)
    listed = marked.mapInArrow(_runs, f"{schema}, runs array<struct<kind:string,run:string>>")
    placed = stored(listed.select("row", *kept, F.posexplode_outer("runs").alias("at", "found")).select("row", *kept, "at", "found.kind", "found.run"))
    distinct = placed.where("run IS NOT NULL").select("run").distinct()
    pairs = distinct.mapInArrow(_substrings, "run string, sub string")
    hits = hot_join(pairs, words.withColumnRenamed("word", "sub"), "sub").select("run", F.struct("sub", "n").alias("hit"))
    every = hits.unionByName(distinct.select("run", F.lit(None).cast(hits.schema["hit"].dataType).alias("hit")))
    known = every.groupBy("run").agg(F.collect_set("hit").alias("known"))
    split = known.mapInArrow(_split_runs(total), "run string, words array<string>")
    told = hot_join(placed, split, "run", "left")
    some = F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", F.transform("words", lambda w: F.concat("kind", w)).alias("told"))))
    lists = F.transform(F.sort_array(some), lambda x: x["told"])
    return told.groupBy("row", *kept).agg(F.flatten(lists).alias("tokens")).drop("row")


def verdict_counts(labelled: DataFrame) -> dict[str, int]:
    return {r["verdict"]: r["count"] for r in labelled.groupBy("verdict").count().collect()}


def drawn(labelled: DataFrame, counts: dict[str, int]) -> DataFrame:
    """The `TRAIN_ROWS` / 2 rows of least hash of each verdict; with page_id too, rows of one url are drawn apart.

    Hashes far above the last one taken are left out first, so that what meets in one task does not grow with the table.
    """
    space, each = 1 << 40, TRAIN_ROWS // 2
    marked = labelled.withColumn("at", F.pmod(F.xxhash64(*[c for c in labelled.columns if c != "tokens"]), F.lit(space)))
    sample = labelled.limit(0)
    for verdict, n in sorted(counts.items()):
        near = marked.where((F.col("verdict") == verdict) & (F.col("at") < int(space * min(1.0, 2 * each / n))))
        sample = sample.unionByName(near.orderBy("at", "host", "path").limit(each).drop("at"))
    return sample


def odds_of(seen: DataFrame, verdicts: dict[str, int]) -> dict[str, float]:
    """Log odds of block against allow by token; '' holds the prior. A token without odds says nothing.

    `seen`: verdict, tokens of the drawn rows; `verdicts`: how many rows there
    are of each. The prior is moved until the drawn rows, weighed as there are
    rows of their verdict, are blocked as often as they should be on average.
    """
    allowed, blocked = verdicts.get("allow", 0), verdicts.get("block", 0)
    if not allowed or not blocked:
        return {}
    block = F.when(F.col("verdict") == "block", 1).otherwise(0)
    rows = seen.select(block.alias("y"), F.explode("tokens").alias("token"))
    counts = {r["token"]: (r["a"], r["b"]) for r in rows.groupBy("token").agg(F.sum(1 - F.col("y")).alias("a"), F.sum("y").alias("b")).collect()}
    size = len(counts) + 1
    a_all, b_all = (sum(c[i] for c in counts.values()) + size for i in (0, 1))
    odds = {t: math.log((b + 1) / b_all) - math.log((a + 1) / a_all) for t, (a, b) in counts.items()}
    told = [(r["verdict"], sum(odds[t] for t in r["tokens"])) for r in seen.collect()]  # the drawn rows, `TRAIN_ROWS` at most
    mine = {v: sum(x == v for x, _ in told) for v in ("allow", "block")}
    weighed = [(verdicts[v] / mine[v], s) for v, s in told]
    return odds | {"": balanced(weighed, blocked)}


def balanced(scores: list[tuple[float, float]], wanted: float) -> float:
    """The constant that, added to log odds (weight, value), makes their probabilities sum to `wanted`."""
    low, high = -60.0, 60.0
    for _ in range(80):
        middle = (low + high) / 2
        total = sum(w / (1 + math.exp(-max(-500.0, min(500.0, s + middle)))) for w, s in scores)
        low, high = (middle, high) if total < wanted else (low, middle)
    return (low + high) / 2


def _judge(model):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = model.value
        for batch in batches:
            lists = batch.column("tokens").to_pylist()
            scores = [odds[""] + sum(odds.get(t, 0.0) for t in tokens) if odds else 0.0 for tokens in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("page_id", "host", "path", "rule", "verdict")] + [pa.array([" ".join(t) for t in lists], pa.string()), pa.array(scores, pa.float64())],
                names=["page_id", "host", "path", "rule", "verdict", "tokens", "score"],
            )

    return judge


def judged(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, tokens, score (log odds of block)."""
    spark = pages.sparkSession
    host, path = parts(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    decided = F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])
    rows = rows.withColumn("verdict", F.element_at(decided, F.col("rule")))
    seen_host, seen_path = masked(F.col("host"), F.col("path"), rules)
    marked = rows.withColumn("seen_host", seen_host).withColumn("seen_path", seen_path)
    rows = stored(segmented(marked, word_counts(pages)).drop("seen_host", "seen_path"))
    labelled = rows.where("rule IS NOT NULL").select("page_id", "host", "path", "verdict", "tokens")
    counts = verdict_counts(labelled)
    model = spark.sparkContext.broadcast(odds_of(drawn(labelled, counts).select("verdict", "tokens"), counts))
    scored = rows.mapInArrow(_judge(model), "page_id long, host string, path string, rule string, verdict string, tokens string, score double")
    return scored.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))))
