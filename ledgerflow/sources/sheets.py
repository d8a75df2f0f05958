"""Spreadsheet exports: type inference and snapshot loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.sources.staging import stamp_ingested_at

# fixed values: text column sizes of the target
EMPTY_TEXT, SHORT_TEXT, LONG_TEXT = "string(50)", "string(4000)", "string(max)"
SHORT_LIMIT = 4000


REJECTED = "_rejected"
_CSV = {"header": True, "escape": '"'}


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """CSV export of a sheet, every cell as text; cells may hold line breaks, so a file is one task."""
    return spark.read.options(**_CSV, multiLine=True).csv(path)


def write_export(df: DataFrame, path: str) -> None:
    """Sheet of text cells as CSV: quotes doubled, empty cells unquoted."""
    df.write.options(**_CSV).csv(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """CSV export read line by line, so a large file is many tasks: the header's columns as text and `_rejected`.

    A line with too few or too many cells or an open quote (a cell with a line
    break) fits no row: it is given whole in `_rejected`. Read such an export
    with `read_export`.
    """
    names = spark.read.options(**_CSV).csv(path).columns
    if REJECTED in names:
        raise ValueError(f"the sheet has a column {REJECTED}")
    lines = spark.read.text(path)
    header = lines.first()
    if header is None:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in [*names, REJECTED]]))
    schema = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in [*names, REJECTED])
    cells = F.from_csv("value", schema, {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": REJECTED})
    # every part of an export begins with the header; blank lines hold no row
    body = lines.where((F.col("value") != header[0]) & (F.trim("value") != ""))
    return body.select(cells.alias("cells")).select("cells.*")


def load_sheet(spark: SparkSession, path: str, run_ts: Column) -> tuple[DataFrame, DataFrame]:
    """Typed snapshot of an export and its rejected lines; every line of the file is in one of both."""
    rows = read_lines(spark, path)
    good = rows.where(F.col(REJECTED).isNull()).drop(REJECTED)
    rejected = rows.where(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("line"), run_ts.cast("timestamp_ntz").alias("_ingested_at"))
    return sheet_snapshot(good, run_ts), rejected


def column_facts(df: DataFrame) -> DataFrame:
    """One row with what type inference needs about every column, in a single pass."""

    def count(c: Column) -> Column:
        return F.count(F.when(c, 1))

    facts = [F.count(F.lit(1)).alias("rows")]
    for name in df.columns:
        c = F.col(f"`{name}`")
        facts.append(
            F.struct(
                F.count(c).alias("filled"),
                count(c.rlike("^[+-]?0[0-9]")).alias("padded"),
                count(F.lower(c).isin("true", "false")).alias("bools"),
                F.count(c.try_cast("bigint")).alias("ints"),
                F.count(c.try_cast("double")).alias("floats"),
                F.count(c.try_cast("timestamp_ntz")).alias("times"),
                F.max(F.length(c)).alias("longest"),
            ).alias(name)
        )
    return df.agg(*facts)


def inferred_type(rows: Column, facts: Column) -> Column:
    """Type of a text column from its facts.

    Whole numbers with empty cells are doubles and flags with empty cells are
    text, as a data frame column with missing values would be. A column with a
    leading zero (007) holds codes, not numbers.
    """
    filled, number = facts["filled"], facts["padded"] == 0
    return (
        F.when(filled == 0, EMPTY_TEXT)
        .when(facts["bools"] == rows, "boolean")
        .when(number & (facts["ints"] == rows), "bigint")
        .when(number & (facts["floats"] == filled), "double")
        .when(facts["times"] == filled, "timestamp_ntz")
        .when(facts["longest"] <= SHORT_LIMIT, SHORT_TEXT)
        .otherwise(LONG_TEXT)
    )


def types_row(df: DataFrame) -> DataFrame:
    """One row with the inferred type of every column, under the column's name."""
    facts = column_facts(df)
    return facts.select(*(inferred_type(F.col("rows"), F.col(f"`{c}`")).alias(c) for c in df.columns))


def infer_column_types(df: DataFrame) -> dict[str, str]:
    """Inferred type per column; brings one row of types to the driver."""
    return types_row(df).first().asDict()


def types_table(df: DataFrame) -> DataFrame:
    """(column_name, type) of every column."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return types_row(df).unpivot([], columns, "column_name", "type")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes NULL."""
    floating = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(f"`{c}`")) for c in floating})


def sheet_snapshot(df: DataFrame, run_ts: Column) -> DataFrame:
    """Typed copy of a text export: the target is recreated from it."""
    kinds = infer_column_types(df)
    typed = df.select(
        *(
            F.col(f"`{c}`").cast("string" if k.startswith("string") else k).alias(c)
            for c, k in kinds.items()
        )
    )
    return stamp_ingested_at(nan_to_null(typed), run_ts)
