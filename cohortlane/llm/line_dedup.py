"""Line dedup: lines that several documents hold stay in the document with the smallest id only.

Everything is DataFrame functions. Lines are exploded to hashes, never shuffled as texts; a hash that
a third of all documents hold is counted per salt first and looked up per salt, so no task gets all
its rows. The kept lines are put together again by position, in slices between the dropped ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .columns import SPACES, lower_ascii, pack
from .store import Steps


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _slices(lines: Column, dropped: Column) -> Column:
    """lines without the positions in dropped (sorted, from 0); linear in the number of lines."""
    starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda p: p + 1))
    ends = F.concat(dropped, F.array(F.size(lines)))
    between = F.zip_with(starts, ends, lambda s, e: F.slice(lines, s + 1, e - s))
    return F.flatten(between)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_documents: int = 2, min_chars: int = 10
) -> DataFrame:
    """row (struct of all columns of docs), kept_text, n_lines, n_dropped; one row per row of docs.

    A text is split at \\n. A line's key is the line without white space at both ends, A-Z lower-cased.
    A key of at least min_chars characters in at least min_documents documents loses its lines except
    in the document with the smallest id. Defined cases: a null or empty text is one empty line; rows
    with equal ids are one document, each row losing its own lines; rows without an id are one document
    that comes after all others; lines that repeat within one document alone stay.
    """
    spark = docs.sparkSession
    steps = Steps(spark, "line_dedup")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed = docs.select(pack(docs))
    text, doc = F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")), F.col(f"row.`{id_col}`")
    packed = packed.select("row", doc.alias("doc"), F.xxhash64(text).alias("version"))

    source = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    lines = (
        source.select("doc", F.xxhash64("text").alias("version"), F.posexplode(lines_of(F.col("text"))))
        .select("doc", "version", "pos", line_key(F.col("col")).alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select(
            "doc",
            "version",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit(1), "key").alias("h2"),
            F.pmod(F.xxhash64("doc"), F.lit(salts)).alias("salt"),
        )
    )
    lines = steps.keep(lines, "lines")

    holders = lines.select("h1", "h2", "salt", "doc").distinct()
    counted = holders.groupBy("h1", "h2", "salt").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("least"))
    whole = W.partitionBy("h1", "h2")
    repeated = (
        counted.select(
            "h1", "h2", "salt", F.sum("n").over(whole).alias("documents"), F.min("least").over(whole).alias("first")
        )
        .filter(F.col("documents") >= min_documents)
        .select("h1", "h2", "salt", "first")
    )
    dropped = (
        lines.join(repeated, ["h1", "h2", "salt"])
        .filter(~F.col("doc").eqNullSafe(F.col("first")))
        .groupBy("doc", "version")
        .agg(F.sort_array(F.collect_set("pos")).alias("dropped"))
        .select(F.col("doc").alias("in_doc"), F.col("version").alias("in_version"), "dropped")
    )
    same = F.col("doc").eqNullSafe(F.col("in_doc")) & (F.col("version") == F.col("in_version"))
    lines_now = lines_of(F.col(f"row.`{text_col}`"))
    return (
        packed.join(dropped, same, "left")
        .select("row", "dropped", lines_now.alias("lines"))
        .select(
            "row",
            F.when(F.col("dropped").isNull(), F.coalesce(F.col(f"row.`{text_col}`"), F.lit("")))
            .otherwise(F.array_join(_slices(F.col("lines"), F.col("dropped")), "\n"))
            .alias("kept_text"),
            F.size("lines").cast("long").alias("n_lines"),
            F.coalesce(F.size(F.col("dropped")), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
