"""Mixing sources to target weights by pivotal dependent rounding (operator 3), DataFrame functions only.

Every document of a source should be taken `target / source_size` times (0 to
`MAX_REPEATS`). The whole part is certain; the fraction is rounded by the
pivotal method: two documents meet, mass moves from one to the other at random
until one of them is 0 or 1, the other goes on to the next meeting. Documents
meet inside blocks in the order of their sizes, so mass moves between similar
sizes and a source's words stay near its target; what is left of a block goes
up to the next level, `FAN` blocks to one, until one document is left per
source. All draws are hashes of the document and a seed: reruns agree.

Size is the number of words of a text (null: 0). Sources without words have
target 0. Rows with equal doc_id, source and size can't be told apart: they
form one unit whose copies are dealt evenly over its rows. An empty table
gives an empty result; a null doc_id or source is a value like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import WORD, stored

WEIGHTS = (3, 1, 2)
TOTAL, MAX_REPEATS = 1.5, 2
#: documents, or residuals of blocks, that meet in one block
FAN = 512
SEED = 20_240_229
_EPS = 1e-9
_UNIT = ("source", "doc_id", "size")


def sized(docs: DataFrame) -> DataFrame:
    words = F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(WORD))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words.cast("long").alias("size"))


def targets(units: DataFrame) -> DataFrame:
    """One row per source: source_size, target and the number of units.

    The shares rise together, by weight, until the total is reached; a source
    that reaches `MAX_REPEATS` times its size stops there. In the order of that
    limit per weight the sources that stop are the first ones.
    """
    sources = units.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.count("*").alias("units"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((turn - 1) % len(WEIGHTS) + 1).cast("int"))
    sources = sources.withColumn("weight", weight.cast("double")).withColumn("limit", (F.col("source_size") * MAX_REPEATS).cast("double"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (F.sum("source_size").over(every) * TOTAL - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    sources = sources.withColumn("level", level).withColumn("open", F.col("level") <= F.col("limit") / F.col("weight"))
    final = F.min(F.when(F.col("open"), F.struct((F.col("limit") / F.col("weight")).alias("at"), "level"))).over(every)["level"]
    target = F.least(F.col("limit"), F.coalesce(final, F.lit(float("inf"))) * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"), "units")


def _draw(*parts: Column) -> Column:
    """Uniform in [0, 1), a hash of the parts."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11) / F.lit(float(1 << 53))


def _meet(items: Column) -> Column:
    """Fold the pivotal method over a block: places of the winners, and place and mass of the one left."""
    zero = F.struct(F.lit(-1).alias("at"), F.lit(0.0).alias("p"), F.array().cast("array<int>").alias("won"), F.lit(0).alias("i"))

    def step(s: Column, x: Column) -> Column:
        a, b, u = s["p"], x["p"], x["u"]
        both = a + b
        fits = both < 1 - _EPS
        # below 1 one of the two gives all it has; from 1 on one of them is taken and the rest stays
        newcomer_stays = F.when(fits, u * both < b).otherwise(u * (2 - both) >= 1 - b)
        rest = F.when(fits, both).otherwise(F.greatest(both - 1, F.lit(0.0)))
        winner = F.when(newcomer_stays, s["at"]).otherwise(s["i"])
        return F.struct(
            F.when(newcomer_stays, s["i"]).otherwise(s["at"]).alias("at"),
            rest.alias("p"),
            F.when(fits, s["won"]).otherwise(F.array_append(s["won"], winner)).alias("won"),
            (s["i"] + 1).alias("i"),
        )

    return F.aggregate(items, zero, step)


def _level(waiting: DataFrame) -> DataFrame:
    """One level of the tree: every row gets `extra` 0 or 1 or, the one left of its block, null."""
    block = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id"), F.col("size")), F.col("blocks"))
    item = F.struct("size", _draw(F.col("doc_id"), F.col("size"), F.col("blocks")).alias("u"), "doc_id", "p")
    blocks = waiting.groupBy("source", "blocks", block.alias("block")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    met = blocks.withColumn("end", _meet(F.col("items")))
    rows = met.select("source", "blocks", "end", F.posexplode("items").alias("at", "item"))
    left = (F.col("at") == F.col("end.at")) & (F.col("end.p") > _EPS)
    return rows.select(
        "source",
        F.col("item.doc_id").alias("doc_id"),
        F.col("item.size").alias("size"),
        F.when(left & (F.col("end.p") < 1 - _EPS), F.lit(None)).otherwise((F.array_contains("end.won", F.col("at")) | left).cast("long")).alias("extra"),
        F.col("end.p").alias("p"),
        "blocks",
    )


def mixed(docs: DataFrame) -> DataFrame:
    """One row per unit (source, doc_id, size): rows, source_size, target and `copies` of all its rows together."""
    units = stored(sized(docs).groupBy(*_UNIT).agg(F.count("*").alias("rows")))
    sources = stored(targets(units))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    named = sources.withColumnRenamed("source", "of")
    due = units.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("due", rate * F.col("rows"))
    due = due.withColumn("whole", F.floor(F.col("due") + _EPS)).withColumn("p", F.greatest(F.col("due") - F.col("whole"), F.lit(0.0)))
    due = due.withColumn("blocks", F.ceil(F.col("units") / FAN))

    waiting = due.where(F.col("p") > _EPS).select(*_UNIT, "p", "blocks")
    most = sources.agg(F.max("units")).first()[0] or 0
    settled = []
    while most > 0:
        done = stored(_level(waiting))
        settled.append(done.where("extra IS NOT NULL").select(*_UNIT, "extra"))
        most = 0 if most <= FAN else -(-most // FAN)
        waiting = done.where("extra IS NULL").select(*_UNIT, "p", F.ceil(F.col("blocks") / FAN).alias("blocks"))
        if not most:
            last = F.when(_draw(F.col("doc_id"), F.col("size"), F.lit("last")) < F.col("p"), F.lit(1)).otherwise(F.lit(0)).cast("long")
            settled.append(waiting.select(*_UNIT, last.alias("extra")))
    if not settled:
        return due.select(*_UNIT, "rows", "source_size", "target", F.col("whole").alias("copies"))
    extra = settled[0]
    for more in settled[1:]:
        extra = extra.unionByName(more)
    extra = extra.select(*[F.col(c).alias(f"{c}_x") for c in _UNIT], "extra")
    same = F.col("source").eqNullSafe(F.col("source_x")) & F.col("doc_id").eqNullSafe(F.col("doc_id_x")) & (F.col("size") == F.col("size_x"))
    out = due.join(extra, same, "left")
    return out.select(*_UNIT, "rows", "source_size", "target", (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies"))


def _copies_of_row(row: Column) -> Column:
    """The copies of a unit, dealt evenly over its rows; row counts from 0."""
    return F.floor(F.col("copies") * (row + 1) / F.col("rows")) - F.floor(F.col("copies") * row / F.col("rows"))


def taken_words(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    rows = mixed(docs).select("*", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"))
    rows = rows.withColumn("n", _copies_of_row(F.col("row")).cast("long"))
    return rows.select("doc_id", "source", "size", F.col("source_size").cast("long").alias("source_size"), F.col("target").cast("double").alias("target"), F.col("n").alias("copies"), (F.col("n") * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, all columns kept."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    words = F.regexp_count(F.coalesce(docs["text"].cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    plan = mixed(docs).where("copies > 0").select(*[F.col(c).alias(f"mix_{c}") for c in (*_UNIT, "rows", "copies")])
    keyed = docs.select(F.struct(*columns).alias("mix_doc"), docs["doc_id"].cast("long").alias("mix_left_id"), docs["source"].cast("string").alias("mix_left_source"), words.alias("mix_left_size"))
    same = F.col("mix_left_id").eqNullSafe(F.col("mix_doc_id")) & F.col("mix_left_source").eqNullSafe(F.col("mix_source")) & (F.col("mix_left_size") == F.col("mix_size"))
    met = keyed.join(plan, same).select("mix_doc", "mix_left_id", "mix_left_source", "mix_left_size", F.col("mix_rows").alias("rows"), F.col("mix_copies").alias("copies"))
    # rows that share a unit are numbered; most units are one row and need no order
    order = Window.partitionBy("mix_left_id", "mix_left_source", "mix_left_size").orderBy(F.xxhash64(F.col("mix_doc.text")))
    met = met.withColumn("n", _copies_of_row((F.row_number().over(order) - 1).cast("long")).cast("int")).where("n > 0")
    met = met.select("mix_doc", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("mix_copy"))
    return met.select("mix_doc.*")
