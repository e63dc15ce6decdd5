"""The hand-kept sheet: one header row, ragged rows, every cell text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions.text import first_filled, normalise_columns, strip_text


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, missing trailing cells as ``""``, plus the row order as ``row_no``.

    A cell may hold line breaks and doubled quotes, so a file is read by one task; a
    folder of several files is read by as many.  ``row_no`` orders the rows by file path
    and, within a file, by line, which is what "the last row wins" needs.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, mode="PERMISSIVE", multiLine=True, escape='"')
    # Rows of one file lie in one task and in order; the id's low bits count them.
    placed = raw.select("*", F.col("_metadata.file_path").alias("__file__"), F.monotonically_increasing_id().alias("__line__"))
    files = placed.groupBy("__file__").agg(F.min("__line__").alias("__first__"))
    number = files.select(
        "__file__", "__first__", (F.row_number().over(Window.orderBy("__file__")) - 1).alias("__number__")
    )
    row_no = F.col("__number__").cast("long") * F.lit(1 << 33) + F.col("__line__") - F.col("__first__")
    joined = placed.join(number, "__file__").withColumn("row_no", row_no)
    return sheet_records(joined.select(*[F.col(f"`{c}`") for c in raw.columns], "row_no"))


def sheet_records(df: DataFrame) -> DataFrame:
    return df.na.fill("")


def sheet_role(sheet: DataFrame) -> DataFrame:
    """Sheet headers to the columns of the ``sheet`` role.

    The name falls back over its spellings row by row; other headers match in any
    case and spacing; an absent column is NULL throughout.
    """
    by_key = normalise_columns(sheet)
    names = [sheet[f"`{h}`"] for h in fv.SHEET_NAME_HEADERS if h in sheet.columns]
    keyed = by_key.columns
    reasons = [
        (F.col(f"`{strip_text(h)}`") if strip_text(h) in keyed else F.lit(None).cast("string")).alias(role)
        for role, h in fv.SHEET_REASON_HEADERS.items()
    ]
    name = first_filled(names) if names else F.lit(None).cast("string")
    named = sheet.withColumn("__sheet_name__", name)
    return normalise_columns(named).select(
        "row_no", F.col("__sheet_name__").alias("name"), *reasons
    )
