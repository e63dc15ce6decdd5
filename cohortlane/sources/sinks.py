"""Report outputs."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import json_cell


def drop_hidden(df: DataFrame, columns: tuple[str, ...] = ()) -> DataFrame:
    """Without the listed columns and without ``__`` metadata columns."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith("__") and c not in columns])


def as_text(df: DataFrame) -> DataFrame:
    """Every cell as text, the form rows have in an appended table."""
    return df.select(*[json_cell(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def stored_columns(spark, path: str) -> list[str] | None:
    """Column names of the table at ``path``; None where there is no table yet."""
    try:
        return spark.read.parquet(path).columns
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def check_columns(columns: list[str], stored: list[str] | None, path: str) -> None:
    """A frame may join a table only with the table's columns, in its order; else ValueError."""
    if stored is not None and list(columns) != list(stored):
        raise ValueError(f"columns {list(columns)} do not match those of {path}: {list(stored)}")


def append_table(df: DataFrame, path: str) -> None:
    """Append the text form.  The header is the schema of the table, so it is never repeated,
    and an empty frame adds no row.  A frame with other columns than the table is refused
    (ValueError) before anything is written: its cells would read back as NULL or not at all."""
    text = as_text(df)
    check_columns(text.columns, stored_columns(df.sparkSession, path), path)
    text.write.mode("append").parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder that all executors see: below spark.checkpoint.dir, or else below the warehouse.

    It belongs to the caller, who removes it once nothing reads from it any more.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/cohortlane-{uuid.uuid4().hex}"


def table_name(heading: str) -> str:
    return re.sub(r"[^a-z0-9]+", "_", heading.lower()).strip("_")


def write_report(df: DataFrame, folder: str, heading: str) -> str:
    path = f"{folder}/{table_name(heading)}"
    df.write.mode("overwrite").parquet(path)
    return path


def write_reports(reports: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """One dataset per heading; returns heading -> path."""
    return {heading: write_report(df, folder, heading) for heading, df in reports.items()}


def written_table(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write once, read many: cuts the lineage and survives the loss of executors."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def describe_failure(error: Exception) -> str:
    return json.dumps(str(error).splitlines())
