"""Source audit, Merkle manifest and pairwise quality against brute force, check SQL and edge cases."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import groupby

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerflow.llm import common, merkle, pairwise_quality, source_audit
from ledgerflow.llm.transducer import Transducer

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos string, share string, words string, n string"
LONG = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(40_000))
EDGE = [
    (1, None, "en", "a", 0, "x", "x", "x", "x", "x"),
    (2, "", None, None, None, "x", "x", "x", "x", "x"),
    (3, LONG, "en", "a", 1, None, None, None, None, None),
    (3, LONG, "en", "a", 1, None, None, None, None, None),
    (3, "other text", "en", "b", 1, "", "", "", "", ""),
    (None, "the of and", "xx", "b", 1, "x", "x", "x", "x", "x"),
    (5, "A b\tC\n\n d", "", "", 1, "x", "x", "x", "x", "x"),
    (7, "É" * 3000, "é", "日", 1, "x", "x", "x", "x", "x"),
]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


# --- transducers


@settings(max_examples=200, deadline=None)
@given(st.sets(st.binary(max_size=5), max_size=40), st.lists(st.binary(max_size=6), max_size=20))
def test_transducer_gives_lexicographic_ordinals(terms, others):
    ordered = sorted(terms)
    made = Transducer.from_bytes(Transducer.build(ordered).to_bytes())
    assert made.ordinals(ordered).tolist() == list(range(len(ordered)))
    place = {t: i for i, t in enumerate(ordered)}
    assert made.ordinals(others).tolist() == [place.get(t, -1) for t in others]
    assert [made.term(i) for i in range(len(ordered))] == ordered


def test_transducer_is_minimal():
    """As many states as there are distinct sets of right parts."""
    terms = sorted(a + b + c for a in (b"st", b"tr", b"") for b in (b"o", b"ee", b"a") for c in (b"p", b"ps", b"ing", b""))
    terms = sorted({t for t in terms if t})
    rights = {frozenset(t[len(p) :] for t in terms if t.startswith(p)) for p in {t[:i] for t in terms for i in range(len(t) + 1)}}
    assert Transducer.build(terms).states == len(rights)
    with pytest.raises(ValueError, match="ascending"):
        Transducer.build([b"b", b"a"])


# --- source audit


def brute_audit(rows, least):
    found = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    df, counts, groups = Counter(), defaultdict(Counter), set()
    for text, lang, source in rows:
        words = [w.translate(lower) for w in found.findall(text or "")]
        key = (lang or "", source or "")
        groups.add(key)
        counts[key].update(words)
        df.update((lang or "", w) for w in set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (x, t), n in df.items() if x == lang and n >= least]

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}

        mine = {s: shares(counts[lang, s]) for x, s in groups if x == lang}
        every = shares(sum((counts[lang, s] for s in mine), Counter()))
        for s, p in mine.items():
            pairs = sorted(((-sum(abs(p[t] - q[t]) for t in kept), o.encode(), o) for o, q in mine.items() if o != s))
            terms = sorted((every[t] - p[t], t.encode(), t) for t in kept if counts[lang, s][t] and p[t] > every[t])[:50]
            for part, items in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(items)]
    return sorted(out)


@pytest.mark.parametrize("least, shard, limit, tile", [(30, 100_000, 1 << 26, 64), (3, 40, 5_000, 2), (1, 7, 1, 1)])
def test_audit_in_shards_passes_and_tiles(spark, none, least, shard, limit, tile):
    """Many small transducers, several passes over the texts and tiles of two sources give the same rows."""
    rows = [(" ".join(f"t{chr(97 + (i * k) % 23)}é{'A' * (i * k % 3)}" for k in range(1, 2 + i % 9)), ("en", "de", None, "")[i % 4], ("s1", "s2", "s3", None, "ß")[i * 7 % 5]) for i in range(90)]
    rows = [r for r in rows if least != 1 or r[1] == "de"][: 24 if least == 1 else None]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")
    got = source_audit.divergence(frame, least, shard, limit, tile)
    assert sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in got.collect()) == brute_audit(rows, least)


def test_audit_edge_cases(edge, none):
    got = sorted(tuple(r) for r in source_audit.divergence(edge.select("*"), 1).collect())
    assert got == brute_audit([(r[1], r[2], r[3]) for r in EDGE], 1)
    nothing_kept = {(r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in source_audit.divergence(edge).collect()}
    assert nothing_kept == {("a", "pair", "b", 0, 1), ("b", "pair", "a", 0, 1)} | {x for x in nothing_kept if x[0] in ("",) and x[3] == 0}
    assert source_audit.divergence(none).collect() == []


def test_long_texts_are_read_in_parts(monkeypatch):
    monkeypatch.setattr(source_audit, "_SLICE", 100)
    monkeypatch.setattr(source_audit, "_WORDS", 7)
    parts = list(source_audit._terms(LONG.encode()))
    assert max(map(len, parts)) == 7 and [w for p in parts for w in p] == LONG.encode().split()


# --- Merkle manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def brute_manifest(rows):
    """rows: doc_id, source, lang, n_chars, text."""

    def tree(digests):
        proofs = [[] for _ in digests]
        level, spans = digests, [[i] for i in range(len(digests))]
        while len(level) > 1:
            up, over = [], []
            for i in range(0, len(level), 2):
                run = level[i : i + 2]
                for k, span in enumerate(spans[i : i + 2]):
                    for leaf in span:
                        proofs[leaf].append((run[:k], run[k + 1 :]))
                up.append(H(*run))
                over.append([x for s in spans[i : i + 2] for x in s])
            level, spans = up, over
        return level[0] if level else None, proofs

    leaves = [(r, H(*map(field, r))) for r in rows]
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    mine = {lang: sorted((x for x in leaves if x[0][2] == lang), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for lang in langs}
    lower = {lang: tree([h for _, h in mine[lang]]) for lang in langs}
    root, tops = tree([lower[lang][0] for lang in langs])
    out = []
    for n, lang in enumerate(langs):
        for (row, leaf), proof in zip(mine[lang], lower[lang][1], strict=True):
            path = proof + tops[n]
            hit = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = H(*map(field, (*row[:3], row[3] + 1, row[4]))) if hit else leaf
            for before, after in path:
                node = H(*before, node, *after)
            out.append((row[0], leaf, lower[lang][0], root, H(*[x for b, a in path for x in (*b, *a)]), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("every", [1, 2, 10])
def test_manifest_with_levels_stored_every_few(spark, every):
    rows = [((i * 37) % 101 if i % 19 else None, f"s{i % 3}" if i % 11 else None, (None, "", "en", "zz", "é")[(i % 16 > 0) + (i % 16 > 1) + (i % 16 > 2) + (i % 16 > 14)], i if i % 5 else None, "text " * (i % 4) if i % 7 else None) for i in range(120)]
    frame = spark.createDataFrame(rows + rows[:3], "doc_id long, source string, lang string, n_chars long, text string").repartition(5)
    got = merkle.verified(frame, merkle.every_seventh(), every)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r[c] for c in names) for r in got.collect()), key=repr)
    assert got == brute_manifest(rows + rows[:3])
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_manifest_edge_cases(edge, none):
    got = sorted((tuple(r) for r in merkle.verified(edge, merkle.every_seventh()).collect()), key=repr)
    assert got == brute_manifest([(r[0], r[3], r[2], r[4], r[1]) for r in EDGE])
    assert merkle.verified(none).collect() == []
    alone = merkle.verified(edge.where("doc_id = 1")).collect()
    assert len(alone) == 1 and alone[0]["leaf"] == alone[0]["root"] and alone[0]["proof_sha256"] == H() and alone[0]["verified"]


def test_manifest_stores_every_few_levels_only(spark):
    rows = spark.range(3000).select(F.lit("1x").alias("tree"), F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"), "id")
    tree = merkle.manifest(rows, "id", every=4)
    assert [level.count() for level in tree.levels] == [3000, 188, 12, 1]
    place = {r["pos"]: r["digest"] for r in tree.levels[0].collect()}
    paths = {r["pos"]: r["path"] for r in merkle._paths(tree.levels[0], merkle._above(tree, spark.sql("SELECT '1x' AS tree, cast(array() AS array<string>) AS path, '' AS subroot")), 4).collect()}
    root = tree.roots().first()["digest"]
    assert len(paths) == 3000 and all(len(p) == 12 and merkle.folded(place[i], p) == root for i, p in paths.items())


# --- pairwise quality


def test_pairwise_held_out_accuracy(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.01")
    docs, labels = common.table(spark, big, "documents"), common.table(spark, big, "labels")
    got = pairwise_quality.scored(docs, labels)
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    good, bad = ([r["score"] for r in held if r["quality"] == q] for q in (1, 0))
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) >= 0.98 * len(good) * len(bad)
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)


def test_pairwise_uses_no_held_out_label(spark, sf_dir):
    docs, labels = (common.table(spark, sf_dir, n) for n in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(pairwise_quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    measured = pairwise_quality.features(docs)
    assert pairwise_quality.fit(measured, labels) == pairwise_quality.fit(measured, turned)


def test_pairwise_recovers_strengths(spark):
    """One feature decides, a second is noise; its pairs are all there and the quantile parts the labels."""
    rows = [(i, "x " * 20 + ("junk! " * 20 if i % 4 == 0 else "word. " * 20) + "y " * (i * 7919 % 13)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i, _ in rows] + [(1, 0), (9999, 1), (2, None)], "doc_id long, quality int")
    known = pairwise_quality.known_labels(labels)
    want = {i: i % 4 != 0 for i, _ in rows if zlib.crc32(str(i).encode()) % 5 and i != 1} | ({9999: True} if zlib.crc32(b"9999") % 5 else {})
    assert {r["doc_id"]: r["good"] for r in known.collect()} == want
    got = {r["doc_id"]: r["predicted"] for r in pairwise_quality.scored(docs, labels).collect()}
    assert got == {i: int(i % 4 != 0) for i, _ in rows}
    labelled = pairwise_quality.features(docs).join(known, "doc_id")
    good = sum(v for k, v in want.items() if k != 9999)
    met = pairwise_quality.pairs(labelled, dict.fromkeys(pairwise_quality.NAMES, 1.0), good, len(want) - good - (9999 in want), partners=3)
    assert met.count() == 2 * 3 * good and met.where("label = 1").count() == 3 * good


def test_pairwise_edge_cases(spark, edge, none):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1)], "doc_id long, quality int")
    rows = pairwise_quality.scored(edge, labels).collect()
    assert len(rows) == len(EDGE) and all(not math.isnan(r["score"]) for r in rows)
    for _, same in groupby(sorted((r for r in rows if r["doc_id"] == 3), key=lambda r: r["score"]), key=lambda r: r["doc_id"]):
        assert len({r["score"] for r in same}) <= 2
    nothing = pairwise_quality.scored(edge, labels.where("false")).collect()
    assert {r["score"] for r in nothing} == {0.5} and {r["predicted"] for r in nothing} == {1}
    assert pairwise_quality.scored(none, labels).collect() == []
