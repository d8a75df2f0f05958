"""Merkle manifest of a table, its levels checkpointed every few and recomputed between (operator 12).

A row is a leaf; the leaves of a tree stand in the order of doc_id and every two
neighbours become one node (the last alone, if it has none) until one is left.
The trees' roots are the leaves of one more tree.

Only every `EVERY`-th level is stored. An aligned subtree is what these levels
make of 2^`EVERY` stored nodes: its interior nodes live while a task folds it and
again while a task takes proofs out of it, and nowhere else. Proofs are taken
from the top down, so a subtree gets the rest of its path as one row.

A leaf's place in its tree is found by a range sort and the counts of the sorted
parts, so no tree passes through one task. Null doc_ids come first; rows of equal
doc_id stand in the order of their leaves. A null value of any field has its own
mark, so it differs from an empty one. Very long texts are hashed whole. An empty
table has no root and no proofs; other columns are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import stored

#: levels between two stored ones
EVERY = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NUMBERS = {"doc_id", "n_chars"}
_STEPS = "tree string, pos long, path array<string>, subroot string"


def _hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _field(name: str, add: int = 0) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    value = F.col(name)
    value = (value.cast("long") + add).cast("string") if name in _NUMBERS else value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(added_chars: int = 0) -> Column:
    """SHA-256 of a row's fields, as lowercase hex."""
    return F.sha2(F.concat(*[_field(f, added_chars if f == "n_chars" else 0) for f in FIELDS]).cast("binary"), 256)


def leaves(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Stored (tree, doc_id, leaf, altered, row): a tree per lang; `altered` is the leaf with one more char where `tampered` holds."""
    altered = F.when(tampered, leaf(1)) if tampered is not None else F.lit(None).cast("string")
    tree = F.coalesce(F.concat(F.lit("1"), F.col("lang").cast("string")), F.lit("0"))
    return stored(docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf().alias("leaf"), altered.alias("altered")).withColumn("row", F.monotonically_increasing_id()))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """Adds `pos` (from 0 in each `tree`, by `order`) and `n`, the tree's number of rows."""
    sorted_rows = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    numbered = stored(sorted_rows.withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    # one row for each part of a tree
    parts = numbered.groupBy("tree", part.alias("part")).agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("tree", "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("n"))
    return numbered.withColumn("part", part).join(parts, ["tree", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("at", "shift", "part")


def _height(n: int) -> int:
    """Levels from the leaves to the root of a tree of n leaves."""
    return (n - 1).bit_length()


def _interior(digests: list[str], levels: int) -> list[list[str]]:
    """The nodes of an aligned subtree, level by level."""
    out = [digests]
    for _ in range(levels):
        last = out[-1]
        out.append([_hash(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return out


def _siblings(nodes: list[list[str]], i: int) -> list[str]:
    """Steps of a proof inside the subtree: `<` or `>` and the sibling on that side; empty where there is none."""
    steps = []
    for row in nodes[:-1]:
        other = i ^ 1
        steps.append("" if other >= len(row) else ("<" if other < i else ">") + row[other])
        i >>= 1
    return steps


def folded(node: str, steps: list[str]) -> str:
    """The root that a node and the steps of its proof lead to."""
    for step in steps:
        node = _hash(step[1:], node) if step[:1] == "<" else _hash(node, step[1:])
    return node


def _by_subtree(level: DataFrame, every: int):
    return level.withColumn("subtree", F.shiftright("pos", every)).groupBy("tree", "subtree")


def _subtree(rows: pa.Table, every: int) -> tuple[pa.Table, list[list[str]]]:
    rows = rows.sort_by("pos")
    levels = min(every, _height(rows.column("n")[0].as_py()))
    return rows, _interior(rows.column("digest").to_pylist(), levels)


def _fold(every: int):
    def fold(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows, nodes = _subtree(rows, every)
        left = -(-rows.column("n")[0].as_py() // (1 << len(nodes) - 1))
        return pa.table({"tree": [key[0].as_py()], "pos": pa.array([key[1].as_py()], pa.int64()), "digest": nodes[-1], "n": pa.array([left], pa.int64())})

    return fold


@dataclass(frozen=True)
class Manifest:
    """Stored levels of all trees, lowest first: (tree, pos, digest, n), the leaves with the columns they came with."""

    levels: list[DataFrame]
    every: int

    def roots(self) -> DataFrame:
        """One row per tree: tree, digest."""
        tops = [level.where("n = 1").select("tree", "digest") for level in self.levels]
        out = tops[0]
        for top in tops[1:]:
            out = out.unionByName(top)
        return out


def manifest(rows: DataFrame, *order: str, every: int = EVERY) -> Manifest:
    """Fold the rows (tree, digest, ...) of each tree in the given order; a stored level is `every` above the last."""
    levels = [stored(placed(rows, *order))]
    while True:
        most = levels[-1].agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return Manifest(levels, every)
        open_trees = levels[-1].where("n > 1").select("tree", "pos", "digest", "n")
        levels.append(stored(_by_subtree(open_trees, every).applyInArrow(_fold(every), "tree string, pos long, digest string, n long")))


def _with_rest(nodes: DataFrame, above: DataFrame, every: int):
    """Subtrees beside the rest of their path."""
    rest = above.select(F.col("tree").alias("above_tree"), F.col("pos").alias("above_pos"), "path", "subroot")
    return _by_subtree(nodes, every).cogroup(rest.groupBy("above_tree", "above_pos"))


def _steps(every: int):
    def steps(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, inside = _subtree(nodes, every)
        rest, subroot = above.column("path")[0].as_py(), above.column("subroot")[0].as_py()
        paths = [_siblings(inside, i) + rest for i in range(nodes.num_rows)]
        return pa.table({"tree": nodes.column("tree"), "pos": nodes.column("pos"), "path": pa.array(paths, pa.list_(pa.string())), "subroot": pa.array([subroot] * nodes.num_rows, pa.string())})

    return steps


def _paths(level: DataFrame, above: DataFrame, every: int) -> DataFrame:
    return _with_rest(level.select("tree", "pos", "digest", "n"), above, every).applyInArrow(_steps(every), _STEPS)


def _above(tree: Manifest, starts: DataFrame) -> DataFrame:
    """For every subtree of the lowest level the steps from its top on: (tree, pos, path, subroot).

    `starts` has the steps from each tree's root on: (tree, path, subroot).
    """
    above = None
    for i in range(len(tree.levels) - 1, -1, -1):
        done = tree.levels[i].where("n = 1").select("tree").join(starts, "tree").select("tree", F.lit(0).cast("long").alias("pos"), "path", "subroot")
        above = done if above is None else done.unionByName(above)
        if i:
            above = stored(_paths(tree.levels[i], above, tree.every))
    return above


def _prove(root: str, every: int):
    def prove(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, inside = _subtree(nodes, every)
        rest, subroot = above.column("path")[0].as_py(), above.column("subroot")[0].as_py()
        proofs, ends = [], []
        for i, (mine, altered) in enumerate(zip(nodes.column("digest").to_pylist(), nodes.column("altered").to_pylist(), strict=True)):
            path = _siblings(inside, i) + rest
            proofs.append(_hash(*[s[1:] for s in path]))
            ends.append(folded(altered or mine, path))
        n = nodes.num_rows
        return pa.table(
            {
                "doc_id": nodes.column("doc_id"),
                "leaf": nodes.column("digest"),
                "subroot": pa.array([subroot] * n, pa.string()),
                "root": pa.array([root] * n, pa.string()),
                "proof_sha256": proofs,
                "folded_root": ends,
                "verified": [e == root for e in ends],
            }
        )

    return prove


def trees(docs: DataFrame, tampered: Column | None = None, every: int = EVERY) -> tuple[Manifest, Manifest]:
    """The manifest of the rows, a tree per lang, and that of the trees' roots (null lang first, then by bytes)."""
    lower = manifest(leaves(docs, tampered).withColumnRenamed("leaf", "digest"), "doc_id", "digest", "row", every=every)
    roots = lower.roots().select(F.lit("").alias("tree"), F.col("tree").alias("lower"), "digest")
    return lower, manifest(roots, "lower", every=every)


def _starts(upper: Manifest) -> DataFrame:
    """The steps from each lower tree's root to the root of all: (tree, path, subroot)."""
    top = upper.roots().select("tree", F.array().cast("array<string>").alias("path"), F.lit("").alias("subroot"))
    steps = _paths(upper.levels[0], _above(upper, top), upper.every)
    named = upper.levels[0].select(F.col("pos").alias("at"), "lower", "digest")
    return stored(named.join(steps.select("pos", "path"), F.col("at") == F.col("pos")).select(F.col("lower").alias("tree"), "path", F.col("digest").alias("subroot")))


def proofs(lower: Manifest, upper: Manifest) -> DataFrame:
    """The steps of every leaf from its place to the root: (tree, pos, path, subroot)."""
    return _paths(lower.levels[0], _above(lower, _starts(upper)), lower.every)


def verified(docs: DataFrame, tampered: Column | None = None, every: int = EVERY) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    `folded_root` starts from the leaf of the row as `tampered` left it and uses
    the siblings of the rows as they were.
    """
    lower, upper = trees(docs, tampered, every)
    top = upper.roots().first()  # one digest
    nodes = lower.levels[0].select("tree", "pos", "digest", "n", "doc_id", "altered")
    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return _with_rest(nodes, _above(lower, _starts(upper)), every).applyInArrow(_prove(top["digest"] if top else "", every), schema)


def every_seventh() -> Column:
    """Rows whose decimal doc_id has a CRC-32 that 7 divides; null doc_ids never."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 7 == 0, F.lit(False))


def _sql_leaf(chars: str) -> str:
    parts = {f: f if f != "n_chars" else chars for f in FIELDS}
    told = [f"coalesce(strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR), '-')" for v in parts.values()]
    return f"sha256({' || '.join(told)})"


SQL = f"""
WITH RECURSIVE crc AS (
    SELECT *, xor(list_reduce(
        flatten([[4294967295::UBIGINT]] || [[ascii(c)::UBIGINT, 256, 256, 256, 256, 256, 256, 256, 256] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
        lambda c, b: CASE WHEN b < 256 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 7 = 0 AS hit
    FROM documents
),
leaves AS (
    SELECT doc_id, lang, {_sql_leaf("n_chars")} AS leaf, CASE WHEN hit THEN {_sql_leaf("n_chars + 1")} END AS altered FROM crc
),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM leaves
),
nodes AS (
    SELECT lang, 0 AS level, pos, n, leaf AS digest FROM placed
    UNION ALL
    SELECT lang, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2
),
subroots AS (
    SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
),
tops AS (
    SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY level, pos // 2
),
steps AS (
    SELECT p.lang, p.pos, n.level AS level, CASE WHEN s.digest IS NULL THEN '' WHEN s.pos < n.pos THEN '<' || s.digest ELSE '>' || s.digest END AS step
    FROM placed p
    JOIN nodes n ON n.lang IS NOT DISTINCT FROM p.lang AND n.n > 1 AND n.pos = p.pos >> n.level
    LEFT JOIN nodes s ON s.lang IS NOT DISTINCT FROM p.lang AND s.level = n.level AND s.pos = xor(n.pos, 1)
    UNION ALL
    SELECT p.lang, p.pos, 1000 + n.level, CASE WHEN s.digest IS NULL THEN '' WHEN s.pos < n.pos THEN '<' || s.digest ELSE '>' || s.digest END
    FROM placed p
    JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
    JOIN tops n ON n.n > 1 AND n.pos = r.pos >> n.level
    LEFT JOIN tops s ON s.level = n.level AND s.pos = xor(n.pos, 1)
),
paths AS (SELECT lang, pos, list(step ORDER BY level) AS path FROM steps GROUP BY lang, pos),
told AS (
    SELECT p.doc_id, p.leaf, r.subroot, (SELECT digest FROM tops WHERE n = 1) AS root, coalesce(x.path, []) AS path, coalesce(p.altered, p.leaf) AS shown
    FROM placed p
    JOIN subroots r ON r.lang IS NOT DISTINCT FROM p.lang
    LEFT JOIN paths x ON x.lang IS NOT DISTINCT FROM p.lang AND x.pos = p.pos
),
ends AS (
    SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string([s[2:] FOR s IN path], ''), '')) AS proof_sha256,
        list_reduce(list_prepend(shown, path), lambda x, s: CASE WHEN s[1] = '<' THEN sha256(s[2:] || x) ELSE sha256(x || s[2:]) END) AS folded_root
    FROM told
)
SELECT *, folded_root = root AS verified FROM ends
"""
