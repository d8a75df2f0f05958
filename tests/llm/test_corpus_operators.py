"""The corpus operators against brute force, exact round trips, check SQL and edge cases."""

from __future__ import annotations

import hashlib
import math
import re
import tracemalloc
from collections import Counter, defaultdict
from dataclasses import replace
from pathlib import Path
from types import SimpleNamespace

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

import corpus_pipeline
from ledgerflow.llm import chat, common, exact_dedup, mixing, pieces, pii, piece_encoding, quality, simhash, substring_dedup, token_counts, urls
from ledgerflow.llm.entries import CHECKS, QUERIES

WORDS = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp long, edges string"
LONG = " ".join(f"w{i * 7919 % 1000}" for i in range(30_000))
EDGE = [
    (1, None, "en", "a", 0, "x", 1, "e"),
    (2, "", None, None, 0, "x", 1, "e"),
    (3, LONG, "en", "a", 1, "x", 1, "e"),
    (3, LONG, "en", "a", 1, "x", 1, "e"),
    (None, "the of and to in a is that it for was on", "xx", "b", 1, None, None, None),
    (5, "A b\tC\n\n d", "en", "b", 1, "x", 1, "e"),
    (6, "a B\tc\n\n D", "en", None, 1, "x", 1, "e"),
    (7, "a" * 3000, "de", "b", 1, "x", 1, "e"),
    (8, "日本  語 ñ². \U0001f9ff x", "fr", "c", 1, "x", 1, "e"),
]


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return common.table(spark, sf_dir, "documents").cache()


@pytest.fixture(scope="module")
def texts(documents):
    return [(r["doc_id"], r["text"]) for r in documents.collect()]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("key", sorted(CHECKS))
def test_check_sql(spark, sf_dir, key):
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    cursor = con.execute(CHECKS[key])
    columns = [c[0] for c in cursor.description]
    assert sorted(map(tuple, QUERIES[key](spark, sf_dir).select(*columns).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def brute_quality(text):
    words = WORDS.findall(text or "")
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(documents, texts, edge, none):
    want = defaultdict(list)
    for doc_id, text in [*texts, *((d, t) for d, t, *_ in EDGE)]:
        want[doc_id].append(brute_quality(text))
    refs = quality.references(documents)
    columns = [f"quality_{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    for row in quality.judged(documents.select("doc_id", "text", "lang").unionByName(edge.select("doc_id", "text", "lang")), refs).collect():
        assert tuple(row[c] for c in columns) in want[row["doc_id"]]
        n, repeat = row["quality_n_words"], row["quality_n_repeat_words"]
        assert row["quality_base_failed"] == (n < 10 or 100 * repeat > 20 * n)
        assert not (row["quality_base_failed"] and row["quality_kept"])
    assert quality.keep_good(none).columns == none.columns and quality.keep_good(none).count() == 0


def test_quality_distance_and_labels(spark, sf_dir, documents):
    p, q = [0.5, 0.5, 0.0], [0.1, 0.2, 0.7]
    got = spark.range(1).select(quality.js_distance(F.array(*map(F.lit, p)), F.array(*map(F.lit, q)))).first()[0]
    m = (np.array(p) + np.array(q)) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m, strict=True) if x > 0)
    assert got == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))
    judged = quality.judged(documents, quality.references(documents)).join(common.table(spark, sf_dir, "labels"), "doc_id").cache()
    clean = judged.where("quality = 1 AND NOT quality_base_failed")
    assert clean.where("NOT quality_kept").count() <= 0.01 * clean.count()
    assert judged.where("quality = 0 AND quality_kept").count() <= 0.5 * judged.where("quality = 0").count()


def test_chat_edge_cases(spark):
    odd = ["", " ", "\\", "\\\\c", "</turn>", " </turn>\n", "### User: x", "<\\/turn>", "\\###", "a: b", "日本\U0001f600", "x" * 50_000, None]
    rows = [(i % 3, i, role, text) for i, text in enumerate(odd) for role in ("assistant", "User", "a: \\c</turn>", None)]
    rows += [(None, None, "assistant", "t"), (0, 0, "assistant", ""), (0, 0, "assistant", "")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(frame)
    assert formatted.where("NOT round_trip").count() == 0
    for row in chat.read_back(formatted).collect():
        mine = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == row["conv_id"]))
        told = "".join(f"{r}\n{x}\n" for *_, r, x in mine)
        loss = "".join(x for *_, r, x in mine if r == "assistant")
        assert (row["n_turns"], row["turns_sha256"]) == (len(mine), hashlib.sha256(told.encode()).hexdigest())
        assert (row["loss_chars"], row["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_conversations(frame.where("false"))).count() == 0


def test_mixing(documents, texts, edge, none):
    rows = mixing.taken_words(documents).collect()
    sizes = {d: len(WORDS.findall(t or "")) for d, t in texts}
    assert {r["doc_id"]: r["size"] for r in rows} == sizes and len(rows) == len(texts)
    by_source = defaultdict(list)
    for r in rows:
        by_source[r["source"]].append(r)
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
    names = sorted(by_source)
    size = {s: sum(r["size"] for r in by_source[s]) for s in names}
    left, open_, target = 1.5 * sum(size.values()), {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}, {}
    while open_:
        share = left / sum(open_.values())
        full = [s for s, w in open_.items() if share * w > 2 * size[s]]
        for s in full or list(open_):
            target[s] = 2.0 * size[s] if full else share * open_[s]
            if full:
                left -= target[s]
            del open_[s]
    for s in names:
        assert by_source[s][0]["target"] == pytest.approx(target[s])
        assert abs(sum(r["taken"] for r in by_source[s]) - target[s]) <= max(r["size"] for r in by_source[s])
    assert sorted(rows, key=repr) == sorted(mixing.taken_words(documents.repartition(7)).collect(), key=repr)
    assert mixing.mix(documents).count() == sum(r["copies"] for r in rows)
    assert len(mixing.taken_words(edge).collect()) == len(EDGE) and mixing.mix(edge).columns == edge.columns
    assert mixing.taken_words(none).count() == 0 and mixing.mix(none).count() == 0


def test_pivotal_tree_over_many_blocks(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 20 as int))").alias("text"), F.expr("if(id % 3 = 0, 'a', 'b')").alias("source"))
    for r in mixing.taken_words(docs).groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("k")).collect():
        assert abs(r["k"] - r["t"]) <= 0.01 * r["t"]


@pytest.fixture(scope="module")
def unigram():
    """The tokenizer library on the same pieces, as a unigram model: model type 1, scores minus the rank."""
    import struct

    table = pieces.load()

    def fields(data):
        i = 0

        def number():
            nonlocal i
            x = shift = 0
            while True:
                c = data[i]
                i += 1
                x |= (c & 127) << shift
                shift += 7
                if c < 128:
                    return x

        while i < len(data):
            tag = number()
            if tag & 7 == 0:
                yield tag, number()
            else:
                n = {1: 8, 5: 4}.get(tag & 7) or number()
                yield tag, data[i : i + n]
                i += n

    def number(x):
        out = b""
        while x > 127:
            out, x = out + bytes([x & 127 | 128]), x >> 7
        return out + bytes([x])

    def put(items):
        return b"".join(number(t) + (number(v) if t & 7 == 0 else v if t & 7 in (1, 5) else number(len(v)) + v) for t, v in items)

    out = []
    for tag, value in fields(open(pieces.MODEL, "rb").read()):
        if tag >> 3 == 1:
            inside = list(fields(value))
            name = inside[0][1].decode()
            if name in table.scores:
                inside = [x for x in inside if x[0] >> 3 != 2] + [(2 << 3 | 5, struct.pack("<f", table.scores[name]))]
            value = put(sorted(inside, key=lambda x: x[0] >> 3))
        elif tag >> 3 == 2:
            value = put([(t, 1 if t >> 3 == 3 else v) for t, v in fields(value)])
        out.append((tag, value))
    return sentencepiece.SentencePieceProcessor(model_proto=put(out))


def test_encoding_and_counts(documents, texts, edge, none, unigram):
    both = documents.select("doc_id", "text").unionByName(edge.select("doc_id", "text"))
    # 32-bit sums of the library are exact on texts up to some thousand tokens
    want = {hashlib.sha256((t or "").encode()).hexdigest(): unigram.encode(t or "") for t in {t for _, t in texts} | {x[1] for x in EDGE} if len(t or "") < 20_000}
    rows = piece_encoding.round_trip(both).collect()
    assert len(rows) == len(texts) + len(EDGE) and all(r["same"] for r in rows)
    assert all(list(r["ids"]) == want[r["text_sha256"]] for r in rows if r["text_sha256"] in want)
    counted = Counter((r["doc_id"], r["n_tokens"]) for r in token_counts.token_counts(both).collect())
    assert counted == Counter((r["doc_id"], r["n_tokens"]) for r in rows)
    small = piece_encoding.round_trip(both, chunk_bytes=20_000).select("doc_id", "ids", "same").collect()
    assert sorted((r["doc_id"] or -1, list(r["ids"])) for r in small) == sorted((r["doc_id"] or -1, list(r["ids"])) for r in rows) and all(r["same"] for r in small)
    decoded = piece_encoding.decode(piece_encoding.encode(edge)).collect()
    assert sorted(r["decoded"] for r in decoded) == sorted(x[1] or "" for x in EDGE)
    assert piece_encoding.round_trip(none).count() == 0 and token_counts.token_counts(none).count() == 0


@pytest.mark.parametrize("by_letters", [True, False])
@pytest.mark.parametrize("block", [7, 1 << 20])
def test_units_of_a_column(texts, monkeypatch, by_letters, block):
    """Cut over whole columns, in blocks of any size, as text by text."""
    table = replace(pieces.load(), by_letters=by_letters)
    monkeypatch.setattr(pieces, "_CUT_BYTES", block)
    odd = ["", " ", "▁", " ▁ ", "a ▁b", "  x", "x  ", "x²³ a1b", "日本  語 ñ². \U0001f9ff x\tÿ", "", None]
    every = odd + [t for _, t in texts[: 20 if block < 100 else 200]]
    units, counts = table.cut(pa.array(every, pa.string()))
    want = [table.units(pieces.prepared(t or "")) for t in every]
    assert counts.tolist() == [len(w) for w in want]
    assert pieces.spaced(units).to_pylist() == [u for w in want for u in w]
    assert table.cut(pa.array([], pa.string()))[1].tolist() == [] and table.cut(pa.array(["", ""]))[1].tolist() == [0, 0]


def test_kinds_are_made_without_an_object_per_character():
    """Every worker makes the table; one string per code point would take it 70 MB."""
    tracemalloc.start()
    try:
        got = pieces.kinds.__wrapped__(True)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [int(got[ord(c)]) for c in " ▁aéñ語²9.\t"] == [0, 0, 1, 1, 1, 1, 2, 2, 2, 2]
    assert peak < 32 << 20, peak


def test_ids_of_a_column():
    """Units that step back together, long ones, unknown characters; a table that does not read back."""
    table = pieces.load()
    units = ["▁the", "▁" + "ab" * 4000, "\U0001f9ff語x", "▁x²³"] * 3 + [f"▁{i}" for i in range(40)]
    steps = ["A" * len(u) for u in units]  # every character a piece of its own
    got = piece_encoding.back_track(pa.array(units), pa.array(steps), table)
    assert got.to_pylist() == [[i for c in u for i in table.spell(c)] for u in units]
    assert piece_encoding.exactly(pa.array(units), got, table).to_pylist() == [True] * len(units)
    poor = replace(table, byte_ids=[0] * 256)
    got = piece_encoding.back_track(pa.array(units), pa.array(steps), poor)
    assert piece_encoding.exactly(pa.array(units), got, poor).to_pylist() == [all(c in table.ids for c in u) for u in units]


def test_a_chunk_keeps_no_object_per_unit():
    """A chunk of new words asks its owners within a few times its bytes, whatever order its streams come in."""
    words = [" ".join(f"{'abcdefghij'[i % 10]}{chr(97 + i // 10 % 26)}{chr(97 + i // 260 % 26)}{chr(97 + i // 6760 % 26)}{chr(97 + d)}q" for i in range(60_000)) for d in range(4)]
    size = sum(map(len, words))
    streams = [piece_encoding._stream(pa.RecordBatch.from_arrays([pa.array([d], pa.int64()), pa.array([t])], schema=piece_encoding._DOC)) for d, t in enumerate(words)]
    packed = pa.table({"chunk": [0] * 4, "at": pa.array(range(4), pa.int32()), "docs": streams})
    ask = piece_encoding._ask(SimpleNamespace(value=pieces.load()), 5)
    first = ask((pa.scalar(0),), packed)  # tables are made once
    tracemalloc.start()
    try:
        again = ask((pa.scalar(0),), packed.take([2, 0, 3, 1]))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert first.equals(again) and sorted(u for us in first["units"].to_pylist() for u in us) == sorted({u for t in words for u in pieces.load().units(pieces.prepared(t))})
    assert peak < 12 * size, peak / size  # 18 with the units as strings in a set


def brute_passages(texts):
    window, first = 50, {}
    words = [(d, (t or "").encode().split()) for d, t in texts]
    for d, w in words:
        for p in range(len(w) - window + 1):
            if d is not None:
                key = tuple(w[p : p + window])
                first[key] = min(first.get(key, d), d)
    for d, w in words:
        gone = set()
        for p in range(len(w) - window + 1):
            if d is not None and first[tuple(w[p : p + window])] < d:
                gone.update(range(p, p + window))
        yield d, len(w), len(gone), hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()


def test_passages(spark, documents, texts, none):
    def check(frame, rows):
        got = sorted(map(tuple, substring_dedup.digests(frame).collect()), key=repr)
        assert got == sorted(brute_passages(rows), key=repr)

    check(documents, texts)
    p = " ".join(f"p{i}" for i in range(60))
    q = " ".join(f"q{i}" for i in range(49))
    odd = [(1, f"a {p} b"), (2, f"c {p}"), (2, f"{p} d"), (3, q), (4, q), (5, None), (6, ""), (None, p), (7, "x " * 300), (8, "x " * 120), (9, p), (10, LONG), (11, LONG), (11, LONG)]
    frame = spark.createDataFrame(odd, "doc_id long, text string")
    check(frame, odd)
    cut = {(r["doc_id"], r["text"]) for r in substring_dedup.cut_repeats(frame).collect()}
    assert {(9, ""), (2, "c"), (2, "d"), (1, f"a {p} b"), (5, None)} <= cut
    assert substring_dedup.digests(none).count() == 0


def test_personal_data(spark, documents, texts, none):
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    odd = [(10_001, "a@b.co@d.com x@@y.z +1 (234) 555-6789 1.2.3.4.5.6.7.8 999.1.1.1 4111 1111 1111 1111 4111-1111-1111-1112"), (10_002, None), (10_003, "1" * 5000 + " " + "a" * 5000 + "@"), (10_002, "é😀 q@r.st 😀")]
    frame = documents.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string"))
    want = Counter()
    for d, t in [*texts, *odd]:
        t = t or ""
        spans = [("email", *m.span()) for m in email.finditer(t)]
        spans += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if max(map(int, m[0].split("."))) <= 255]
        spans += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(re.sub(r"\D", "", m[0])) <= 19 and pii.luhn(re.sub(r"\D", "", m[0]))]
        spans += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
        want[(d, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest())] += 1
    rows = pii.found(frame).collect()
    assert Counter((r["doc_id"], r["base_sha256"]) for r in rows) == want
    assert "[email]" in pii.redacted(frame).where("doc_id = 10001").first()["text"]
    assert pii.found(none).count() == 0


def test_personal_data_adds_look_alikes(spark):
    """National numbers and spelled-out addresses are added; dates, digits of hashes and failed checksums are not."""
    rows, want, junk = [], {}, {}
    for i in range(600):
        digits, name = f"{i * 7919 % 10**7:07d}", f"name{i}"
        phone, mail = f"({200 + i % 700}) {digits[:3]}-{digits[3:]}", f"{name} (at) host.org" if i % 8 < 4 else f"{name} at host dot org"
        strict, loose = f"call +1 {phone} or mail {name}@host.org", f"call {phone} or mail {mail}"
        hidden = f"on 2024-01-{i % 28 + 1:02d} hash ab{digits}cd, no 411111111111111{i % 10 if i % 10 != 1 else 2}"
        text = (strict, strict, loose, hidden)[i % 4]
        rows.append((i, text))
        if i % 4 == 2:
            want[i] = {("phone", phone), ("email", mail)}
        elif i % 4 == 3:
            junk[i] = set()
    told = pii.found(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    texts = dict(rows)
    got = {r["doc_id"]: {(k, texts[r["doc_id"]][int(a) : int(b)]) for k, a, b in (s.split(":") for s in r["spans"].split(",") if s)} for r in told}
    assert {i: got[i] for i in want} == want
    assert {i: got[i] for i in junk} == junk


def test_personal_data_rare_kind_is_learned(spark, monkeypatch):
    """Cards are one in a thousand candidates; they are drawn all the same, and the driver gets a bounded number."""
    monkeypatch.setattr(pii, "DRAWN", 60)
    valid = [n for n in (f"4{i:015d}" for i in range(10**6, 10**6 + 400)) if pii.luhn(n)][:24]
    rows = [(i, f"call +1 (2{i % 90 + 10}) 555-{i % 9000 + 1000} or mail name{i}@host.org") for i in range(4000)]
    rows += [(10_000 + i, f"card {n[:4]} {n[4:8]} {n[8:12]} {n[12:]}") for i, n in enumerate(valid)] + [(20_000 + i, f"card {n[:4]}/{n[4:8]}/{n[8:12]}/{n[12:]}") for i, n in enumerate(valid)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.found(frame).collect()}
    assert all(got[10_000 + i]["n_card"] == 1 for i in range(len(valid)))
    assert all(got[20_000 + i]["n_card"] == 0 and got[20_000 + i]["spans"].startswith("card:5:") for i in range(len(valid)))
    assert all(r["n_spans"] == len([s for s in r["spans"].split(",") if s]) for r in got.values())


def test_personal_data_is_learned_from_all_candidates(spark, monkeypatch):
    """No draw decides the trees or the thresholds, and each of many equal candidates counts."""
    rows = [(i, f"call {'+1 ' if i % 3 else ''}({200 + i % 700}) {i % 900 + 100}-{i * 7 % 9000 + 1000} or mail name{i:03d}{'@' if i % 2 else ' (at) '}host.org") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    told = lambda: sorted((r["doc_id"], r["spans"]) for r in pii.found(frame).collect())
    model, whole = pii.fit(frame), told()
    monkeypatch.setattr(pii, "DRAWN", 2)
    assert pii.fit(frame) == model and told() == whole
    assert all(s.count("phone") == 1 and s.count("email") == 1 for _, s in whole)
    # 9 of 10 unlabelled ones score low: the many at the lower score are counted, not the two scores
    assert pii.calibrated([(0.9, 10)], [(0.9, 10)]) == 0.9 and pii.calibrated([(0.9, 10)], [(0.9, 1), (0.84, 9)]) == 0.9


def test_personal_data_of_a_long_text_in_linear_time(spark):
    text = " ".join(f"a{i}@b.org +1 (234) 555-{i % 9000 + 1000} x ({200 + i % 700}) 555-1234 y 10.0.{i % 250}.1" for i in range(20_000))
    row = pii.found(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row["n_email"], row["n_phone"], row["n_ip"]) == (20_000, 20_000, 20_000)
    made = pii.Disjoint()
    for a, b in ((5, 8), (1, 3), (10, 12)):
        made.add(a, b)
    assert [made.touched(a, b) for a, b in ((0, 1), (2, 5), (3, 5), (8, 10), (7, 9), (11, 20), (12, 20))] == [False, True, False, False, True, True, False]


def test_exact_copies_edge_cases(edge, none):
    rows = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(edge).collect()}
    assert {(1, 2, 2, False), (2, 2, 2, True), (3, 3, 2, True), (5, 6, 2, False), (6, 6, 2, True), (None, None, 1, True)} <= rows
    kept = exact_dedup.drop_copies(edge)
    assert kept.columns == edge.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 2, 3, 3, 6, 7, 8]
    assert exact_dedup.exact_groups(none).count() == 0
    values = np.unique(np.random.default_rng(1).integers(0, 1 << 62, 1000, dtype=np.uint64))
    for shift in (0, 50, 60):
        part = values if shift else np.arange(9, dtype=np.uint64)
        assert (exact_dedup.golomb_decode(exact_dedup.golomb_encode(part, shift), len(part), shift) == part).all()


def brute_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_copies(documents, texts, edge, none):
    rows = simhash.near_groups(documents).collect()
    prints = {d: brute_print(t) for d, t in texts}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {d: f"{p:016x}" for d, p in prints.items()}
    ids = sorted(prints)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                lo, hi = sorted((find(a), find(b)))
                parent[hi] = lo
    assert {r["doc_id"]: r["component_id"] for r in rows} == {i: find(i) for i in ids}
    got = {(r["doc_id"], r["component_id"], r["fingerprint"]) for r in simhash.near_groups(edge).collect()}
    assert {(1, 1, "0" * 16), (2, 1, "0" * 16)} <= got and simhash.keep_first(edge).columns == edge.columns
    assert simhash.near_groups(none).count() == 0


def test_golay_keys_and_midpoints_lose_no_link(spark, monkeypatch):
    table = simhash._coset_patterns()
    assert sorted(Counter((table >= 0).sum(axis=1).tolist()).items()) == [(1, 277), (6, 1771)]
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    flips = [sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)) for _ in base]
    near = base ^ np.array(flips, np.uint64)
    for a, b in zip(zip(*simhash.segment_keys(base, table), strict=True), zip(*simhash.segment_keys(near, table), strict=True), strict=True):
        assert sum(bool(set(x[x >= 0].tolist()) & set(y[y >= 0].tolist())) for x, y in zip(a, b, strict=True)) >= 2
    dense = np.unique(np.uint64(77) ^ np.array([1 << int(a) | 1 << int(b) for a, b in rng.integers(0, 20, (200, 2))], np.uint64))
    frame = spark.createDataFrame([(int(x),) for x in dense.view(np.int64)], "fp long")
    edges = {(r["a"], r["b"]) for r in simhash.links(frame.withColumn("a", F.col("fp"))).collect()}
    assert edges and all(r["root"] == int(dense.min()) for r in common.components(spark.createDataFrame(list(edges), "a long, b long")).collect())
    points = next(simhash._midpoints(iter([__import__("pyarrow").RecordBatch.from_pydict({"fp": dense.view(np.int64)[:2]})])))
    assert points.num_rows == 2 * 2081


def test_url_filter(spark, sf_dir):
    urls_in = ["http://a.com/x", "https://q.example.com/en/1?x", "http://www.example.com/en/", "http://X.NET/es/1", "http://net/fr/", "http://a.org/en/1", "http://example.com", None, "nope", "a://B.com/p?q#r", ""]
    rows = [(i, u, "<p>blog about news</p>") for i, u in enumerate(urls_in)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in urls.judged(frame).collect()}
    assert [got[i]["rule"] for i in range(11)] == ["com/", "example.com/en/", "www.example.com/en/", "net/es/", "net/fr/", None, None, None, None, "com/", None]
    assert (got[9]["host"], got[9]["path"], got[7]["host"], got[8]["path"]) == ("b.com", "/p", "", "")
    assert got[3]["verdict"] == "block" and got[2]["verdict"] == "allow"
    assert urls.Segmenter({"blog": 50, "about": 30, "news": 20, "b": 1}).words("newsaboutblogx") == ["news", "about", "blog", "x"]
    assert urls.judged(frame.where("false")).count() == 0


def seen_parts(host, path):
    """What rules look at is no word: last label, labels that a rule names, first part of the path."""
    labels = [x for x in host.split(".")[:-1] if x not in ("com", "net", "example", "www")]
    return ".".join(labels), "/".join(path.split("/")[2:])


def unigram_counts(texts):
    return Counter(w for t in texts for w in re.findall(r"[^\W\d_]+", (t or "").lower()) if 1 < len(w) <= urls.LONGEST)


def brute_segment(run, counts):
    """The cheapest split of a short run, over all splits; the earlier cut wins ties from the right, as in the search."""
    total = sum(counts.values()) + 1
    cost = lambda w: math.log(total / counts[w]) if w in counts else (math.log(total) + 5 if len(w) == 1 else math.inf)
    splits = []
    for bits in range(1 << max(len(run) - 1, 0)):
        cuts = [0, *[i + 1 for i in range(len(run) - 1) if bits >> i & 1], len(run)]
        splits.append((sum(cost(run[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)), [run[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]))
    return min(c for c, _ in splits), splits


def test_url_segments_are_the_cheapest_of_all_splits():
    counts = unigram_counts(["cheap cheap pills pill farm far arm news ews on line online a"])
    for run in ("cheappills", "farmnews", "onlinefarm", "xarmz", "pillsonline"):
        words = urls.Segmenter(counts).words(run)
        best, splits = brute_segment(run, counts)
        assert "".join(words) == run and any(w == words and abs(c - best) < 1e-9 for c, w in splits)


def test_url_scores_equal_naive_bayes_by_hand(spark, sf_dir):
    """Tokens, odds, prior and verdicts of a whole table, by a plain program over all decided pages."""
    pages = common.table(spark, sf_dir.replace("sf0.001", "sf0.01"), "pages")
    got = urls.judged(pages).collect()
    segmenter = urls.Segmenter(unigram_counts(r["html"] for r in pages.select("html").collect()))
    assert all(r["tokens"].split() == segmenter.tokens(*seen_parts(r["host"], r["path"])) for r in got)
    decided = [(r["verdict"], r["tokens"].split()) for r in got if r["rule"]]
    n = Counter(v for v, _ in decided)
    assert max(n.values()) <= urls.TRAIN_ROWS // 2
    words = {v: Counter(t for x, tokens in decided if x == v for t in tokens) for v in n}
    size = len({t for c in words.values() for t in c}) + 1
    share = {v: {t: (c[t] + 1) / (sum(c.values()) + size) for t in words["allow"] | words["block"]} for v, c in words.items()}
    score = lambda tokens: sum(math.log(share["block"][t] / share["allow"][t]) for t in tokens if t in share["allow"])
    prior = {round(r["score"] - score(r["tokens"].split()), 6) for r in got}
    assert max(prior) - min(prior) < 1e-5
    chance = sum(1 / (1 + math.exp(-(score(t) + max(prior)))) for _, t in decided)
    assert chance == pytest.approx(n["block"], rel=1e-3)
    assert all(r["verdict"] == ("block" if r["score"] > 0 else "allow") for r in got if not r["rule"])


def test_url_words_decide_not_the_rules_marks(spark):
    """Same domain and path start, other words, other verdicts; hosts that were not learned from."""
    good, bad = "garden flowers recipes music travel books".split(), "casino poker slots jackpot gamble betting".split()
    rows = []
    for i in range(1200):
        words = bad if i % 3 == 0 else good
        a, b, c = (words[(i // 3 * k + k) % 6] for k in (1, 5, 7))
        rows.append((i, f"http://{a}{b}.net/es/{c}" if i % 3 == 0 else f"http://{a}{b}.com/x/{c}"))
    text = " ".join(good + bad)
    held = [(5000, "http://pokerslots.org/en/jackpot/gamble"), (5001, "http://gardenflowers.org/en/recipes/music"), (5002, "http://jackpotcasino.org/de/betting"), (5003, "http://travelbooks.org/de/garden"), (5004, "http://zzz.org/en/x")]
    frame = spark.createDataFrame([(i, u, text) for i, u in rows + held], "page_id long, url string, html string")
    got = {r["page_id"]: r for r in urls.judged(frame).collect()}
    assert [got[i]["verdict"] for i in range(5000, 5004)] == ["block", "allow", "block", "allow"]
    assert not any(t in ("h:net", "h:com", "h:org", "p:es", "p:en") for r in got.values() for t in r["tokens"].split())


def test_url_words_are_never_cut(spark):
    """A word of one in 120,000 still splits hosts, and tokens are those of all counts."""
    common_text = "<li>" * 60_000
    rows = [(1, "http://cheappills.org/farm/12/cheap-pills", common_text), (2, "http://news.com/x", common_text), (3, "http://pills.net/es/cheap", "cheap pills farm"), (3, None, None)]
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string")
    segmenter = urls.Segmenter(unigram_counts([common_text, common_text, "cheap pills farm", common_text]))
    got = urls.judged(pages).collect()
    assert Counter(r["page_id"] for r in got) == {1: 2, 2: 1, 3: 2}
    assert all(r["tokens"] == " ".join(segmenter.tokens(*seen_parts(r["host"], r["path"]))) for r in got)
    assert "h:cheap h:pills p:0 p:cheap p:pills" in {r["tokens"] for r in got}


def test_url_run_of_any_length(spark):
    """A letter run of 20,000 letters: its substrings come in parts, none is missed."""
    run = "cheappillsfarm" * 1500
    pages = spark.createDataFrame([(1, f"http://a.com/x/{run}", "cheap pills farm " * 3), (2, "http://b.net/fr/x", "x")], "page_id long, url string, html string")
    got = {r["page_id"]: r["tokens"].split() for r in urls.judged(pages).collect()}
    assert got[1][1:] == ["p:cheap", "p:pills", "p:farm"] * 1500


def test_url_rare_verdict_is_learned(spark, monkeypatch):
    """Three blocked urls among 1,500 decided ones are all drawn, and the prior counts all of them."""
    monkeypatch.setattr(urls, "TRAIN_ROWS", 40)
    text = "casino poker slots jackpot gamble garden flowers recipes"
    rows = [(i, f"http://garden{i}.com/flowers/recipes", text) for i in range(1497)]
    rows += [(i, "http://casino.net/es/poker/slots/jackpot/gamble", text) for i in range(2000, 2003)] + [(3000, "http://casino.org/poker/slots/jackpot/gamble", text), (3001, "http://garden.org/flowers/recipes", text)]
    got = {r["page_id"]: r for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[3000]["verdict"], got[3001]["verdict"]) == ("block", "allow")
    labelled = spark.createDataFrame([(r["page_id"], r["host"], r["path"], r["verdict"]) for r in got.values() if r["rule"]], "page_id long, host string, path string, verdict string")
    assert urls.verdict_counts(urls.drawn(labelled, urls.verdict_counts(labelled))) == {"allow": 20, "block": 3}


def test_pipeline(spark, sf_dir, documents, texts):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = common.stored(stage(spark, docs, sf_dir))
        assert out.columns == documents.columns and 0 < out.count() <= docs.count(), name
        docs = out
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len({t.encode().lower() for t in rows.values()}) == len(rows)
    mixed = common.stored(corpus_pipeline.STAGES[3][1](spark, docs, sf_dir))
    assert mixed.columns == documents.columns and max(Counter(r["doc_id"] for r in mixed.collect()).values()) <= 2
    last = corpus_pipeline.STAGES[4][1](spark, mixed, sf_dir)
    assert last.where("same").count() == mixed.count() == corpus_pipeline.run(spark, sf_dir).count()


def test_native_plans_have_no_python(spark, sf_dir):
    for key in ("op1_quality_divergence", "op2_chat_round_trip", "op3_pivotal_mixing"):
        plan = QUERIES[key](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in ("Python", "Arrow", "Pandas", "CartesianProduct") if x in plan]


CLASHING = "q q_left q_lines quality_kept ref_language gone_id gone_key cut_id cut_key kept my_id my_key row m a b fp size target copies chunk".split()


def test_filters_leave_columns_of_any_name_alone(spark):
    """Tables whose columns are named like those that operators use inside come back with their own values."""
    long_ = " ".join(f"word{i * 7919 % 211}" for i in range(200))
    docs = [(1, long_, "en", "s"), (2, long_.upper(), "en", "s"), (3, "short", "en", "s"), (4, None, None, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    frame = frame.select("*", *[F.concat(F.lit(f"{c}:"), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    refs = quality.references(frame)
    results = [quality.keep_good(frame), quality.keep_good(frame, refs), exact_dedup.drop_copies(frame), simhash.keep_first(frame), substring_dedup.cut_repeats(frame), mixing.mix(frame)]
    for out in results:
        assert out.columns == frame.columns
        rows = out.collect()
        assert all(r[c] == f"{c}:{r['doc_id']}" for r in rows for c in CLASHING)
    assert {r["doc_id"] for r in results[2].collect()} == {2, 3, 4}
    judged = quality.judged(frame, refs)
    assert judged.where("quality_kept IS NULL").count() == 0 and {"q", "q_left", "ref_language"} <= set(judged.columns)


def test_scratch_is_deleted(spark, tmp_path):
    folder = common.work_folder(spark)
    with common.scratch(spark):
        kept = common.stored(spark.range(5))
        place = kept.inputFiles()[0]
        kept.write.parquet(str(tmp_path / "out"))
    assert folder in place and not Path(place.removeprefix("file://")).parent.exists()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5
    assert Path(common.stored(spark.range(2)).inputFiles()[0].removeprefix("file://")).exists()


def test_extra_columns_with_clashing_names(edge):
    assert isinstance(edge.schema, T.StructType) and {"kept", "fp", "edges"} <= set(edge.columns)
    assert piece_encoding.encode(edge).count() == simhash.near_groups(edge).count() == len(EDGE)
