"""SentencePiece encoding and decoding by a relational lattice (operator 4).

Documents are gathered in chunks of about `CHUNK_BYTES` of text, whatever the
size of the table; a longer document is a chunk of its own. A chunk asks the owners of units (parts of
text no piece can span, see `pieces`) for its distinct units. An owner's units
become a lattice: their substrings up to the longest piece are exploded and
equi-joined to the piece table, the edges are grouped by unit, and the Viterbi
search is a fold over the edges in the order of their ends, the earlier start
first, so equal sums keep it. The fold keeps the best scores of the last
positions only and a string of the best last piece's length at each position.
Owners send every chunk the encodings it asked for and the chunk spells its
documents. Every distinct unit is searched once; texts are shuffled once. The
Python parts work on whole Arrow columns and keep no object per unit.

The piece table is a fixed file, so it may be broadcast. Null and empty texts
have no tokens. Decoding gives the text back but for U+2581, which reads as a
space. Rows are independent and may repeat; very long texts and words cost in
proportion to their length. An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import partitions
from ledgerflow.llm.pieces import MODEL, SPACE, Pieces, load, spaced

#: text of a chunk, which a task holds with its words and token ids
CHUNK_BYTES = 8 << 20
#: owners of units, at least so many per shuffle partition, and one for so many bytes of input
OWNERS_PER_PARTITION, OWNER_BYTES = 3, 4 << 20
_EDGE_BITS = 26  # of an edge's number: 6 for its length, the others for its rank; its end stands above
_EDGE = 1 << _EDGE_BITS
_BLOCK = 512  # characters of a long unit that are exploded together
_PART = 1024  # back pointers in one string while the fold goes on
_CODES = pa.list_(pa.int32())
_NO_CODES = pa.table({"codes": pa.array([], _CODES), "exact": pa.array([], pa.bool_())})
_DOC = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])
_HASHED = 1 << 18  # bytes of units that are hashed together
_FEW = 16  # units that still step back, which then do so one by one


def _stream(batch: pa.RecordBatch) -> bytes:
    """A batch as a compressed Arrow stream."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _pack(limit: int):
    """Consecutive documents of a task in chunks of at most `limit` bytes of text, as compressed Arrow streams."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, size, streams = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            rows = batch.select(["doc_id", "text"]).cast(_DOC)
            ends = np.cumsum(pc.binary_length(rows.column("text")).to_numpy(zero_copy_only=False))
            start, before = 0, 0
            while start < rows.num_rows:
                # as many rows as the chunk still takes, one at least where it is empty
                n = int(np.searchsorted(ends, before + limit - size, side="right")) - start
                if n <= 0 and streams:
                    chunk, size, streams = chunk + 1, 0, 0
                    continue
                n = max(n, 1)
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), pa.array([streams], pa.int32()), pa.array([_stream(rows.slice(start, n))], pa.binary())], names=["chunk", "at", "docs"])
                size, streams = size + int(ends[start + n - 1]) - before, streams + 1
                start, before = start + n, int(ends[start + n - 1])

    return pack


def _documents(packed: pa.Table) -> pa.Table:
    """The chunk's documents, in the order of its streams."""
    streams = sorted(zip(packed.column("at").to_pylist(), packed.column("docs"), strict=True), key=lambda x: x[0])
    return pa.concat_tables([pa.ipc.open_stream(blob.as_buffer()).read_all() for _, blob in streams])


@dataclass(frozen=True)
class _Wanted:
    """The chunk's distinct units by owner, sorted, the same whenever it is asked again."""

    units: pa.Array  # all of them, owner by owner
    owners: list[int]
    ends: np.ndarray  # of each owner's units, the first one's start before them
    words: pa.Array  # the place in `units` of every unit of the chunk, text by text
    counts: np.ndarray  # units of each text


def _owner(units: pa.LargeStringArray, owners: int) -> np.ndarray:
    """A hash of each unit's bytes and their places, by number of owners."""
    ends = np.frombuffer(units.buffers()[1], np.int64)[units.offset : units.offset + len(units) + 1]
    data = np.frombuffer(units.buffers()[2] or b"", np.uint8)
    out = np.empty(len(units), np.uint64)
    first = 0
    while first < len(units):  # as many units as have so many bytes, one at least
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + _HASHED, side="right")) - 1)
        part = data[ends[first] : ends[last]]
        starts = ends[first:last] - ends[first]
        weight = (np.arange(1, len(part) + 1) - np.repeat(starts, np.diff(ends[first : last + 1]))).astype(np.uint64)
        weight *= np.uint64(0x9E3779B97F4A7C15)
        weight ^= weight >> np.uint64(29)
        weight *= np.uint64(0xBF58476D1CE4E5B9)
        weight |= np.uint64(1)
        weight *= part + np.uint64(1)
        out[first:last] = np.add.reduceat(weight, starts)
        first = last
    out ^= out >> np.uint64(32)
    out *= np.uint64(0x94D049BB133111EB)
    return ((out >> np.uint64(33)) % np.uint64(owners)).astype(np.int64)


def _wanted(texts: pa.ChunkedArray, pieces: Pieces, owners: int) -> _Wanted:
    cuts = [pieces.cut(part) for part in texts.chunks]
    parts = [units for units, _ in cuts if len(units)] or [pa.array([], pa.large_string())]
    coded = pa.concat_arrays(pa.chunked_array(parts).dictionary_encode().chunks) if len(parts) > 1 else parts[0].dictionary_encode()
    distinct = spaced(coded.dictionary)
    order = pc.sort_indices(distinct).to_numpy()
    owner = _owner(distinct, owners)[order]
    by_owner = np.argsort(owner, kind="stable")
    order, owner = order[by_owner], owner[by_owner]
    starts = np.flatnonzero(np.diff(owner, prepend=-1))
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    words = pa.array(place[coded.indices.to_numpy()])
    return _Wanted(distinct.take(pa.array(order)), owner[starts].tolist(), np.append(starts, len(order)), words, np.concatenate([n for _, n in cuts] or [np.zeros(0, int)]))


def _ask(pieces, owners: int):
    def ask(key: tuple[pa.Scalar, ...], packed: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # of the chunk before
        wanted = _wanted(_documents(packed).column("text"), pieces.value, owners)
        units = pa.ListArray.from_arrays(pa.array(wanted.ends, pa.int32()), wanted.units.cast(pa.string()))
        return pa.table({"chunk": pa.array([key[0].as_py()] * len(units), pa.int64()), "owner": pa.array(wanted.owners, pa.int64()), "units": units})

    return ask


def viterbi(edges: Column, longest: int) -> Column:
    """Fold of sorted edges: lengths of the best last piece at each position, as characters.

    An edge is one number: its end, its rank and 63 - length, so the order is by
    end. A score is minus the rank; the fold keeps the least sum of ranks of a
    position above the 63 - length of its last piece, so the lesser number is the
    better split and, among equal sums, the one that starts earlier.
    """

    def back(x: Column) -> Column:
        """Minus the length of an edge's piece."""
        return (x.bitwiseAND(63) - 63).cast("int")

    def told(s: Column) -> Column:
        return F.concat(s["told"], F.char(F.lit(127) - s["cost"].bitwiseAND(63)))

    def step(s: Column, x: Column) -> Column:
        cost = x.bitwiseAND(_EDGE - 1)
        same_end = F.shiftright(x, _EDGE_BITS) == s["at"]
        less = F.least(s["cost"], F.element_at(s["best"], back(x)).bitwiseAND(~63) + cost)
        stays = F.struct(s["at"].alias("at"), s["best"].alias("best"), less.alias("cost"), s["told"].alias("told"), s["parts"].alias("parts"))
        before = F.when(back(x) == -1, s["cost"]).otherwise(F.element_at(s["best"], back(x) + 1))
        full = F.pmod(s["at"] + 1, F.lit(_PART)) == 0
        moves = F.struct(
            (s["at"] + 1).alias("at"),
            F.concat(F.slice(s["best"], F.greatest(F.size(s["best"]) - longest + 2, F.lit(1)), F.lit(longest)), F.array(s["cost"])).alias("best"),
            (before.bitwiseAND(~63) + cost).alias("cost"),
            F.when(full, F.lit("")).when(s["at"] > 0, told(s)).otherwise(s["told"]).alias("told"),
            F.when(full, F.array_append(s["parts"], told(s))).otherwise(s["parts"]).alias("parts"),
        )
        return F.when(same_end, stays).otherwise(moves)

    zero = F.lit(0).cast("long")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<bigint>").alias("best"), zero.alias("cost"), F.lit("").alias("told"), F.array().cast("array<string>").alias("parts"))
    return F.aggregate(edges, start, step, lambda s: F.concat(F.array_join(s["parts"], ""), told(s)))


def viterbi_short(edges: Column) -> Column:
    """What `viterbi` tells, for short units: the fold keeps the best sums of all positions in one array."""

    def step(best: Column, x: Column) -> Column:
        end = F.shiftright(x, _EDGE_BITS)
        start = (end - 63 + x.bitwiseAND(63)).cast("int")
        total = F.element_at(best, start + 1).bitwiseAND(~63) + x.bitwiseAND(_EDGE - 1)
        less = F.concat(F.slice(best, F.lit(1), end.cast("int")), F.array(F.least(F.element_at(best, -1), total)))
        return F.when(F.size(best) > end, less).otherwise(F.array_append(best, total))

    ends = F.aggregate(edges, F.array(F.lit(0).cast("long")), step, lambda best: F.slice(best, F.lit(2), F.size(best)))
    return F.array_join(F.transform(ends, lambda x: F.char(F.lit(127) - x.bitwiseAND(63))), "")


def lattice(units: DataFrame, table: DataFrame, longest: int, unknown: int) -> DataFrame:
    """Distinct (owner, unit, asked_by) with `steps`, what the fold tells of each. `table`: piece, rank; a fixed file, broadcast."""
    # long units are cut into blocks and grouped by a hash, so that no row of the lattice carries a long text;
    # one more edge of a long unit's first character carries it whole
    short = F.char_length("unit") <= _BLOCK
    no_text = F.lit(None).cast("string")
    begins = F.sequence(F.lit(0), F.char_length("unit") - 1, F.lit(_BLOCK))
    cut = F.transform(begins, lambda b: F.struct(b.alias("begin"), F.substr("unit", b + 1, F.lit(_BLOCK + longest - 1)).alias("text"), no_text.alias("whole")))
    first = F.struct(F.lit(0).alias("begin"), F.substr("unit", F.lit(1), F.lit(1)).alias("text"), F.col("unit").alias("whole"))
    blocks = F.when(short, F.array(F.struct(F.lit(0).alias("begin"), F.col("unit").alias("text"), no_text.alias("whole")))).otherwise(F.array_append(cut, first))
    # in order, so that grouping the edges finds them sorted
    ordered = units.select("owner", "asked_by", short.alias("short"), F.when(short, F.col("unit")).otherwise(F.sha2("unit", 256)).alias("key"), blocks.alias("blocks")).sortWithinPartitions("owner", "key", "short")
    texts = ordered.select("owner", "asked_by", "short", "key", F.explode("blocks").alias("b")).select("owner", "asked_by", "short", "key", "b.*")
    starts = texts.withColumn("start", F.explode(F.sequence(F.lit(0), F.least(F.lit(_BLOCK), F.char_length("text")) - 1)))
    ends = starts.withColumn("length", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.char_length("text") - F.col("start")))))
    parts = ends.withColumn("part", F.substr("text", F.col("start") + 1, F.col("length")))
    edges = parts.join(F.broadcast(table), F.col("part") == F.col("piece"), "left").where("piece IS NOT NULL OR length = 1")
    end = (F.col("begin") + F.col("start") + F.col("length")).cast("long")
    edge = F.shiftleft(end, _EDGE_BITS) + F.shiftleft(F.coalesce("rank", F.lit(unknown)), 6) + (F.lit(63) - F.col("length"))
    grouped = edges.select("owner", "key", "short", "whole", "asked_by", edge.alias("edge")).groupBy("owner", "key", "short")
    grouped = grouped.agg(F.sort_array(F.collect_list("edge")).alias("edges"), F.min("asked_by").alias("asked_by"), F.max("whole").alias("whole"))
    steps = F.when(F.col("short"), viterbi_short(F.col("edges"))).otherwise(viterbi(F.col("edges"), longest))
    return grouped.select("owner", F.coalesce("whole", "key").alias("unit"), "asked_by", steps.alias("steps"))


def back_track(units: pa.StringArray, steps: pa.StringArray, pieces: Pieces) -> pa.ListArray:
    """Token ids of each unit. A step is one byte, 64 and the length of the best piece that ends at a character."""
    ends = np.frombuffer(steps.buffers()[1], np.int32)[steps.offset : steps.offset + len(steps) + 1]
    told = np.frombuffer(steps.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    length = told.astype(np.int32) - 64
    begins = np.zeros(len(told), bool)
    first, at = ends[:-1], ends[1:]
    while len(at) > _FEW:  # all units step back together
        at = at - length[at - 1]
        begins[at] = True
        more = at > first
        first, at = first[more], at[more]
    for begin, end in zip(first.tolist(), at.tolist(), strict=True):  # the longest ones
        while end > begin:
            end -= int(length[end - 1])
            begins[end] = True
    starts = np.flatnonzero(begins)
    bounds = np.frombuffer(units.buffers()[1], np.int32)[units.offset : units.offset + len(units) + 1]
    data = np.frombuffer(units.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    characters = np.flatnonzero((data & 0xC0) != 0x80).astype(np.int32)
    offsets = np.append(characters[starts], len(data)).astype(np.int32)
    ids, counts = pieces.spell_all(pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)))
    sums = np.concatenate(([0], np.cumsum(counts)))
    return pa.ListArray.from_arrays(pa.array(sums[np.searchsorted(starts, ends)], pa.int32()), pa.array(ids, pa.int32()))


def exactly(units: pa.StringArray, codes: pa.ListArray, pieces: Pieces) -> pa.BooleanArray:
    """Which units their ids, as `back_track` gives them, are decoded to."""
    names, sizes = pieces.written_all(codes.values.to_numpy())
    sums = np.concatenate(([0], np.cumsum(sizes)))[codes.offsets.to_numpy()]
    bounds = np.frombuffer(units.buffers()[1], np.int32)[units.offset : units.offset + len(units) + 1]
    if np.array_equal(sums, bounds - bounds[0]):
        data = np.frombuffer(units.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        if np.array_equal(data, np.frombuffer(names.buffers()[2] or b"", np.uint8)[: sums[-1]]):
            return pa.array(np.ones(len(units), bool))
    return pa.array([pieces.written(ids) == unit for unit, ids in zip(units.to_pylist(), codes.to_pylist(), strict=True)], pa.bool_())


def _whole(column: pa.ChunkedArray) -> pa.Array:
    """A column as one array."""
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _reply(pieces):
    def reply(key: tuple[pa.Scalar, ...], asked: pa.Table, encoded: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        units, table = _whole(encoded.column("unit")), pieces.value
        codes = back_track(units, _whole(encoded.column("steps")), table)
        exact = exactly(units, codes, table)
        blobs = []
        for mine in asked.column("units"):
            at = pc.index_in(mine.values, value_set=units)
            if at.null_count:
                raise ValueError("a unit has no encoding")
            blobs.append(_stream(pa.RecordBatch.from_arrays([codes.take(at), exact.take(at)], names=["codes", "exact"])))
        return pa.table({"chunk": asked.column("chunk").cast(pa.int64()), "owner": asked.column("owner").cast(pa.int64()), "codes": pa.array(blobs, pa.binary())})

    return reply


def _spell(pieces, owners: int):
    def spell(packed: pa.Table, replies: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        docs = _documents(packed)
        texts = docs.column("text")
        wanted = _wanted(texts, pieces.value, owners)
        told = dict(zip(replies.column("owner").to_pylist(), replies.column("codes"), strict=True))
        lists = pa.concat_tables([pa.ipc.open_stream(told[owner].as_buffer()).read_all() for owner in wanted.owners] or [_NO_CODES])
        codes, exact = _whole(lists.column("codes")), _whole(lists.column("exact"))
        if len(codes) != len(wanted.units):
            raise ValueError("not every unit has an encoding")
        spelled = codes.take(wanted.words)
        ends = np.concatenate(([0], np.cumsum(wanted.counts)))
        ids = pa.ListArray.from_arrays(pa.array(spelled.offsets.to_numpy()[ends], pa.int32()), spelled.values)
        # units stand for whole runs of bytes, so a text of units that read back as they were does so, too
        same = ~pc.match_substring(_whole(texts), SPACE).to_numpy(zero_copy_only=False)
        if exact.false_count:
            odd = np.concatenate(([0], np.cumsum(~exact.to_numpy(zero_copy_only=False)[wanted.words.to_numpy()])))[ends]
            same &= odd[1:] == odd[:-1]
        digests = [hashlib.sha256(text.as_buffer()).hexdigest() for text in texts]
        return pa.table({"doc_id": docs.column("doc_id"), "text_sha256": pa.array(digests, pa.string()), "ids": ids, "same": pa.array(same, pa.bool_())})

    return spell


def _input_bytes(df: DataFrame) -> int:
    """Bytes that a frame reads, by Spark's estimate; 0 where it has none."""
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return estimate if estimate < 1 << 60 else 0


def encode(docs: DataFrame, model: str = MODEL, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, text_sha256 (of the text), ids (array of int), same (decoding gives the text back).

    Smaller chunks take less memory in a task and more requests to the owners of units.
    """
    spark = docs.sparkSession
    table = load(model)
    pieces = spark.sparkContext.broadcast(table)
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    owners = max(OWNERS_PER_PARTITION * partitions(spark), _input_bytes(read) // OWNER_BYTES)
    packed = read.mapInArrow(_pack(chunk_bytes), "chunk long, at int, docs binary")
    asked = packed.groupBy("chunk").applyInArrow(_ask(pieces, owners), "chunk long, owner long, units array<string>").repartition(owners, "owner")
    # reads every column of `asked`, so that both of its readers share one shuffle
    units = asked.select("owner", "chunk", F.explode_outer("units").alias("unit")).groupBy("owner", "unit").agg(F.min("chunk").alias("asked_by"))
    vocabulary = spark.createDataFrame([(p, int(-s)) for p, s in table.scores.items()], "piece string, rank int")
    encoded = lattice(units, vocabulary, table.longest, int(-table.unknown)).withColumnRenamed("owner", "unit_owner")
    replies = asked.groupBy("owner").cogroup(encoded.groupBy("unit_owner")).applyInArrow(_reply(pieces), "chunk long, owner long, codes binary")
    replies = replies.withColumnRenamed("chunk", "asking_chunk")
    return packed.groupBy("chunk").cogroup(replies.groupBy("asking_chunk")).applyInArrow(_spell(pieces, owners), "doc_id long, text_sha256 string, ids array<int>, same boolean")


def _unspell(pieces):
    def unspell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pieces.value
        for batch in batches:
            texts = [table.decode(ids.values.to_numpy(zero_copy_only=False).tolist()) if ids.is_valid else None for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"])

    return unspell


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """Adds `decoded`, the text of the column `ids`; other columns stay."""
    pieces = encoded.sparkSession.sparkContext.broadcast(load(model))
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    return encoded.mapInArrow(_unspell(pieces), schema)


def round_trip(docs: DataFrame, model: str = MODEL, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids, text_sha256, same."""
    return encode(docs, model, chunk_bytes).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text_sha256", "same")
