"""Audit of how the sources of a language differ in their words (operator 11).

A language keeps the terms found in `MIN_DOCUMENTS` of its documents or more.
Its kept terms, sorted, become minimal acyclic transducers that give each term
its lexicographic ordinal; all texts are streamed through them to be counted
anew, and from there on a term is its ordinal: ties are broken by it and only
reported terms are spelled out again.

Sorting is by range, so a language's vocabulary is dealt over tasks, and one
transducer holds `SHARD` terms at most. Texts pass all transducers that fit in
`PASS_BYTES` together, which is what may be broadcast; a larger vocabulary takes
more passes over the texts.

Two sources are compared block of terms by block of terms: a task gets the
counts of at most two tiles of sources in one block and adds up their distances.

Null text, lang and source read as empty. A term is a run of ASCII letters and
non-ASCII characters, with A-Z in lower case. Rows that repeat count as often as
they occur. A document or word of any length is read whole. A language without
kept terms gives distances of 0 and no terms. An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import stored
from ledgerflow.llm.transducer import Transducer

MIN_DOCUMENTS, TOP, SMOOTHING, SCALE = 30, 50, 5, 1_000_000_000
#: terms in one transducer
SHARD = 100_000
#: transducers broadcast at once
PASS_BYTES = 64 << 20
#: sources in a tile, terms in a block (a power of two)
TILE, BLOCK = 64, 512
#: bytes of text counted before a task hands on what it has, and words of one text taken at once
_SLICE, _WORDS = 8 << 20, 1 << 20
#: a term in UTF-8 after lower-casing A-Z
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def _terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of bounded length."""
    text = text.lower()  # of bytes: A-Z only
    if len(text) <= _SLICE:
        yield _TERM.findall(text)
        return
    found = (m[0] for m in _TERM.finditer(text))
    while part := list(islice(found, _WORDS)):
        yield part


def _read(docs: DataFrame) -> DataFrame:
    def told(name: str, kind: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit("")).cast(kind).alias(name)

    return docs.select(told("lang", "string"), told("source", "string"), told("text", "binary"))


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, Counter[bytes]] = defaultdict(Counter)
    size = 0

    def handed_on() -> pa.RecordBatch:
        langs = [lang for lang, terms in seen.items() for _ in range(len(terms))]
        terms = [t for c in seen.values() for t in c]
        counts = [n for c in seen.values() for n in c.values()]
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(terms, pa.binary()), pa.array(counts, pa.int64())], names=["lang", "term", "documents"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            data = text.as_py()
            seen[lang].update(set().union(*_terms(data)))
            size += len(data)
            if size >= _SLICE:
                yield handed_on()
                seen.clear()
                size = 0
    yield handed_on()


def kept_terms(docs: DataFrame, least: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, term): terms, as UTF-8, of at least `least` documents of the language."""
    counts = _read(docs).select("lang", "text").mapInArrow(_document_counts, "lang string, term binary, documents long")
    return counts.groupBy("lang", "term").agg(F.sum("documents").alias("documents")).where(F.col("documents") >= least).select("lang", "term")


def _build(shard: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, terms = None, []

        def made() -> pa.RecordBatch:
            blob = Transducer.build(terms).to_bytes()
            return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([terms[0]], pa.binary()), pa.array([len(terms)], pa.int64()), pa.array([blob], pa.binary())], names=["lang", "first", "n", "blob"])

        for batch in batches:
            for next_lang, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist(), strict=True):
                if terms and (next_lang != lang or len(terms) == shard):
                    yield made()
                    terms = []
                lang = next_lang
                terms.append(term)
        if terms:
            yield made()

    return build


def vocabulary(kept: DataFrame, shard: int = SHARD) -> DataFrame:
    """Stored transducers: lang, first (term), n, base (ordinal of its first term in the language), blob."""
    built = kept.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(_build(shard), "lang string, first binary, n long, blob binary")
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    built = stored(built)  # the same shards for every reader, whatever bounds a range sort would draw again
    bases = built.select("lang", "first", "n").withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return stored(built.join(bases.drop("n"), ["lang", "first"]))


def _passes(shards: DataFrame, limit: int) -> Iterator[dict[str, list[tuple[int, bytes]]]]:
    """The transducers by language, with their bases, as many at a time as fit in `limit` bytes, one at least."""
    sizes = shards.select("lang", "first", F.octet_length("blob").alias("bytes")).orderBy("lang", "first").collect()  # a row per 100,000 terms or part of a sort
    groups, total = [], 0
    for row in sizes:
        if not groups or total + row["bytes"] > limit:
            groups.append([])
            total = 0
        groups[-1].append(row)
        total += row["bytes"]
    for group in groups:
        low, high = group[0], group[-1]
        key, bound = F.struct("lang", "first"), lambda r: F.struct(F.lit(r["lang"]).alias("lang"), F.lit(bytearray(r["first"])).alias("first"))
        out: dict[str, list[tuple[int, bytes]]] = defaultdict(list)
        for row in shards.where((key >= bound(low)) & (key <= bound(high))).select("lang", "base", "blob").collect():  # `limit` bytes
            out[row["lang"]].append((row["base"], bytes(row["blob"])))
        yield dict(out)


_OPENED: dict[int, dict[str, list[tuple[int, Transducer]]]] = {}


def _opened(shared) -> dict[str, list[tuple[int, Transducer]]]:
    """A pass's transducers, made ready once for a worker."""
    if shared.id not in _OPENED:
        _OPENED.clear()
        _OPENED[shared.id] = {lang: [(base, Transducer.from_bytes(b)) for base, b in shards] for lang, shards in shared.value.items()}
    return _OPENED[shared.id]


class _Shared:
    """A broadcast with a name of its own, by which workers remember it."""

    def __init__(self, broadcast):
        self.id, self._broadcast = broadcast._jbroadcast.id(), broadcast

    def __getstate__(self):
        return {"id": self.id, "_broadcast": self._broadcast}

    @property
    def value(self):
        return self._broadcast.value


def _recount(shared):
    def recount(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _opened(shared)
        seen: dict[str, dict[str, Counter[bytes]]] = defaultdict(lambda: defaultdict(Counter))
        size = 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, sources in seen.items():
                for source, words in sources.items():
                    for base, transducer in opened[lang]:
                        ordinals = transducer.ordinals(list(words))
                        known = np.flatnonzero(ordinals >= 0)
                        counts = np.fromiter(words.values(), np.int64, len(words))[known]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(known), pa.string()), pa.array([source] * len(known), pa.string()), pa.array(ordinals[known] + base), pa.array(counts)], names=["lang", "source", "ordinal", "n"]
                        )

        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text"), strict=True):
                if lang not in opened:
                    continue
                data = text.as_py()
                for part in _terms(data):
                    seen[lang][source].update(part)
                size += len(data)
                if size >= _SLICE:
                    yield from handed_on()
                    seen.clear()
                    size = 0
        yield from handed_on()

    return recount


def counted(docs: DataFrame, shards: DataFrame, limit: int = PASS_BYTES) -> DataFrame:
    """Stored occurrences of the kept terms: lang, source, ordinal, n."""
    read, schema = _read(docs), "lang string, source string, ordinal long, n long"
    out = docs.sparkSession.createDataFrame([], schema)
    for transducers in _passes(shards, limit):
        shared = _Shared(docs.sparkSession.sparkContext.broadcast(transducers))
        counts = read.mapInArrow(_recount(shared), schema)
        out = out.unionByName(stored(counts.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n"))))
    return out


def _spell(shared):
    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = _opened(shared)
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for row in rows:
                for base, transducer in opened.get(row["lang"], ()):
                    if base <= row["ordinal"] < base + transducer.size:
                        out.append(row | {"item": transducer.term(row["ordinal"] - base).decode("utf-8", "replace")})
            yield pa.RecordBatch.from_pylist(out, schema=batch.schema.append(pa.field("item", pa.string())))

    return spell


def spelled(rows: DataFrame, shards: DataFrame, limit: int = PASS_BYTES) -> DataFrame:
    """Adds `item`, the term of (lang, ordinal)."""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields) + ", item string"
    out = None
    for transducers in _passes(shards, limit):
        told = rows.mapInArrow(_spell(_Shared(rows.sparkSession.sparkContext.broadcast(transducers))), schema)
        out = told if out is None else out.unionByName(told)
    return out if out is not None else rows.sparkSession.createDataFrame([], schema)


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTHING) / (total + SMOOTHING * terms)), in whole numbers."""
    top = F.lit(SCALE).cast("decimal(20,0)") * (count + SMOOTHING).cast("decimal(18,0)")
    bottom = (total + F.lit(SMOOTHING) * terms).cast("decimal(38,0)")
    return F.call_function("div", top, bottom) + 1


def _distances(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    """Distances inside one block of terms between the sources of two tiles."""
    tile_a, tile_b = key[1].as_py(), key[2].as_py()
    offset = rows.column("offset").to_numpy(zero_copy_only=False)
    share = rows.column("share").to_numpy()
    names = rows.column("source").to_pylist()
    carriers = np.flatnonzero(offset < 0).tolist()
    place = {names[i]: k for k, i in enumerate(carriers)}
    tile = np.array([rows.column("tile")[i].as_py() for i in carriers], np.int64)
    width = rows.column("width")[carriers[0]].as_py() if carriers else 0
    table = np.repeat(share[carriers][:, None], width, axis=1) if carriers else np.zeros((0, 0), np.int64)
    there = np.flatnonzero(offset >= 0)
    table[[place[names[i]] for i in there.tolist()], offset[there]] = share[there]
    left = [names[i] for i in carriers]
    ones, others, values = [], [], []
    for a in np.flatnonzero(tile == tile_a).tolist():
        for b in np.flatnonzero(tile == tile_b).tolist():
            if tile_a != tile_b or a < b:
                ones.append(left[a])
                others.append(left[b])
                values.append(int(np.abs(table[a] - table[b]).sum()))
    return pa.table({"lang": pa.array([key[0].as_py()] * len(ones), pa.string()), "one": pa.array(ones, pa.string()), "other": pa.array(others, pa.string()), "value": pa.array(values, pa.int64())})


def divergence(docs: DataFrame, least: int = MIN_DOCUMENTS, shard: int = SHARD, limit: int = PASS_BYTES, tile: int = TILE) -> DataFrame:
    """lang, source, part (`pair` or `term`), item, value, rank: see the module's head.

    `pair`: every other source of the language by distance; `term`: the `TOP`
    terms of a source by how far their share lies above the language's.
    """
    shards = vocabulary(kept_terms(docs, least), shard)
    counts = counted(docs, shards, limit)
    groups = _read(docs).select("lang", "source").distinct()
    terms = shards.groupBy("lang").agg(F.sum("n").alias("terms"))
    totals = groups.join(counts.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left").join(terms, "lang", "left")
    by_lang = Window.partitionBy("lang")
    totals = stored(
        totals.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms"))
        .withColumn("lang_total", F.sum("total").over(by_lang))
        .withColumn("tiles", F.ceil(F.count("*").over(by_lang) / tile))
        .withColumn("tile", F.pmod(F.xxhash64("source"), "tiles"))
    )
    shares = counts.join(totals, ["lang", "source"]).withColumn("lang_n", F.sum("n").over(Window.partitionBy("lang", "ordinal")))
    shares = shares.select("lang", "source", "ordinal", "terms", "tiles", "tile", _share(F.col("n"), F.col("total"), F.col("terms")).alias("share"), _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")).alias("lang_share"))
    shares = stored(shares)
    return _term_part(shares, shards, limit).unionByName(_pair_part(shares, totals))


def _term_part(shares: DataFrame, shards: DataFrame, limit: int) -> DataFrame:
    above = shares.where("share > lang_share").select("lang", "source", "ordinal", (F.col("share") - F.col("lang_share")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal"))
    top = spelled(above.withColumn("rank", rank).where(F.col("rank") <= TOP), shards, limit)
    return top.select("lang", "source", F.lit("term").alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))


def _pair_part(shares: DataFrame, totals: DataFrame) -> DataFrame:
    block = F.floor(F.col("ordinal") / BLOCK).cast("long")
    found = shares.select("lang", "source", "tile", "tiles", block.alias("block"), (F.col("ordinal") % BLOCK).cast("long").alias("offset"), "share", F.lit(0).cast("long").alias("width"))
    # every source has a share, that of a count of 0, in every block of its language; without terms there is one block of width 0
    blocks = totals.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(F.col("terms") / BLOCK) - 1, F.lit(0)))))
    width = F.least(F.lit(BLOCK).cast("long"), F.col("terms") - F.col("block") * BLOCK)
    unseen = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0)
    rows = found.unionByName(blocks.select("lang", "source", "tile", "tiles", "block", F.lit(-1).cast("long").alias("offset"), unseen.alias("share"), width.alias("width")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rows = rows.select("lang", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"), "block", "source", "tile", "offset", "share", "width")
    part = rows.groupBy("lang", "low", "high", "block").applyInArrow(_distances, "lang string, one string, other string, value long")
    sums = part.groupBy("lang", "one", "other").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("one").alias("item"))))
    sums = sums.select("lang", both.alias("e"), "value").select("lang", "e.source", "e.item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return sums.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


SQL = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
),
words AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT r) >= {MIN_DOCUMENTS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (
    SELECT lang, source, term, v, coalesce(n, 0) AS n, sum(coalesce(n, 0)) OVER (PARTITION BY lang, source) AS total,
        sum(coalesce(n, 0)) OVER (PARTITION BY lang, term) AS lang_n, sum(coalesce(n, 0)) OVER (PARTITION BY lang) AS lang_total
    FROM groups JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN counted USING (lang, source, term)
),
shares AS (
    SELECT lang, source, term, n, 1 + {SCALE}::HUGEINT * (n + {SMOOTHING}) // (total + {SMOOTHING} * v) AS p,
        1 + {SCALE}::HUGEINT * (lang_n + {SMOOTHING}) // (lang_total + {SMOOTHING} * v) AS q
    FROM cells
),
pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
    LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
    GROUP BY ALL
),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM shares WHERE n > 0 AND p > q),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
