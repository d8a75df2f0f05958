r"""Chat formatting with a grammar round trip (operator 2), DataFrame functions only.

A turn is written `### Label: body </turn>` and a line feed. The labels System,
User and Assistant stand for the roles of that name in lower case; any other
role, null included (read as empty), is written `@` and the escaped role.
A body is first written as it is, parsed back and compared; where the parser
would not return the same text, or where the text holds a control string
(`###`, `</turn>`), it is written escaped: `\` as `\\`, `###` as `\###`,
`</turn>` as `<\/turn>`; in roles also `:` as `\c`. Reading back undoes exactly
that, so every text survives.

Turns are ordered by turn, then role, then text (nulls first), so repeated rows
and equal turn numbers have one order. A null text is empty; rows of a null
conv_id form one conversation. An empty table gives an empty result; other
columns are not read. A conversation becomes one string, so it is one row: its
length is bounded by what a conversation is, not by the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HEAD, END = "### ", " </turn>\n"
KNOWN = ("system", "user", "assistant")


def _escape(text: Column) -> Column:
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    escaped = F.replace(escaped, F.lit("###"), F.lit("\\###"))
    return F.replace(escaped, F.lit("</turn>"), F.lit("<\\/turn>"))


def _unescape(text: Column) -> Column:
    """Pieces between escaped backslashes hold only escaping ones."""
    plain = F.array_join(F.transform(F.split(text, r"\\\\"), lambda p: F.replace(F.replace(p, F.lit("\\c"), F.lit(":")), F.lit("\\"), F.lit(""))), "\\")
    return F.when(F.contains(text, F.lit("\\")), plain).otherwise(text)


def _label(role: Column) -> Column:
    return F.when(role.isin(*KNOWN), F.initcap(role)).otherwise(F.concat(F.lit("@"), F.replace(_escape(role), F.lit(":"), F.lit("\\c"))))


def _role(label: Column) -> Column:
    return F.when(F.startswith(label, F.lit("@")), _unescape(F.substr(label, F.lit(2)))).otherwise(F.lower(label))


def _segment(text: Column) -> Column:
    """One turn, without its end mark, as (role, text, place and length of the body)."""
    colon = F.instr(text, ": ")
    body = F.substr(text, colon + 2)
    return F.struct(
        _role(F.substr(text, F.lit(len(HEAD) + 1), colon - len(HEAD) - 1)).alias("role"),
        _unescape(body).alias("text"),
        (colon + 1).alias("offset"),
        F.char_length(body).alias("chars"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text, offset, chars)."""
    parts = F.split(formatted, r"\Q" + END + r"\E")
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), _segment)


def rendered_turn(role: Column, text: Column) -> Column:
    def render(body: Column) -> Column:
        return F.concat(F.lit(HEAD), _label(role), F.lit(": "), body, F.lit(END))

    # parse(render(text)) == text, seen on the body: no end mark inside, and unescaping changes nothing
    safe = ~F.contains(text, F.lit("</turn>")) & ~F.contains(text, F.lit("###")) & (_unescape(text) == text)
    return F.when(safe, render(text)).otherwise(render(_escape(text)))


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, n_turns, formatted, loss_spans (start, end of assistant bodies; code points), round_trip."""
    turns = rows.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    turns = turns.withColumn("rendered", rendered_turn(F.col("role"), F.col("text")))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = F.sum(F.char_length("rendered")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    turns = turns.select("conv_id", F.row_number().over(order).alias("at"), "role", "text", "rendered", F.coalesce(before, F.lit(0)).alias("start"))
    turns = turns.withColumn("parsed", F.element_at(parse(F.col("rendered")), 1))
    turn = F.struct("at", "rendered", "start", F.col("parsed.offset"), F.col("parsed.chars"), F.col("parsed.role").alias("role"), ((F.col("parsed.role") == F.col("role")) & (F.col("parsed.text") == F.col("text"))).alias("same"))
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    mine = F.filter("t", lambda x: x["role"] == "assistant")
    return grouped.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["rendered"]), "").alias("formatted"),
        F.transform(mine, lambda x: F.struct((x["start"] + x["offset"]).alias("start"), (x["start"] + x["offset"] + x["chars"]).alias("end"))).alias("loss_spans"),
        F.forall("t", lambda x: x["same"]).alias("round_trip"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The digest columns, all taken from the formatted text and its loss mask."""
    turns = parse(F.col("formatted"))
    told = F.array_join(F.transform(turns, lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    masked = F.transform("loss_spans", lambda s: _unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    out = formatted.select("conv_id", F.size(turns).cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"), F.array_join(masked, "").alias("loss"), F.char_length("formatted").cast("long").alias("formatted_chars"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def planted(spark: SparkSession) -> DataFrame:
    """Conversation -7: both turns quote the template's own control strings."""
    turn = F.col("id")
    role = F.when(turn == 0, F.lit("user")).otherwise(F.lit("assistant"))
    return spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), turn.alias("turn"), role.alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))


SQL = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) AS r(t)
),
sized AS (
    SELECT *,
        CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
             ELSE 1 + length(replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '<\/turn>'), ':', '\c')) END AS label_chars,
        CASE WHEN contains(text, '\') OR contains(text, '###') OR contains(text, '</turn>')
             THEN length(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '<\/turn>'))
             ELSE length(text) END AS body_chars
    FROM rows
)
SELECT conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(4 + label_chars + 2 + body_chars + 9) AS BIGINT) AS formatted_chars
FROM sized
GROUP BY conv_id
"""
