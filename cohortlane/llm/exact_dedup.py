"""Exact dedup by progressive refinement: length, then a hash of the first characters, then the whole text.

Everything is DataFrame functions. The one scan reads each text once and keeps only its length, a
hash of its first PREFIX characters and its SHA-256 (which the result reports for every row). Then
three rounds group the rows by a longer and longer key; a row whose group is alone after a round is
settled there and takes no part in the next one, so the 256-bit digest is shuffled only for rows whose
length and prefix both have company. No text is ever shuffled.

A group of copies may hold a third of all rows. Rows are salted by their id, counted per (key, salt)
with partial aggregation before the shuffle, and the per-salt counts are summed over a window that
holds at most one row per salt; the rows then look their group up by (key, salt). So no task holds a
whole group, whatever its size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .columns import pack
from .store import Steps

#: Characters of a text that the second round hashes.
PREFIX = 64


def _settle(rows: DataFrame, keys: Sequence[str], salts: int) -> DataFrame:
    """rows with size (rows sharing keys) and keep (the largest id among them, null if none has one)."""
    counted = rows.groupBy(*keys, "salt").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("top"))
    whole = W.partitionBy(*keys)
    totals = counted.select(
        *keys, "salt", F.sum("n").over(whole).alias("size"), F.max("top").over(whole).alias("keep")
    )
    return rows.join(totals, [*keys, "salt"])


def dedup_exact(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] | None = None
) -> DataFrame:
    """row (struct of the columns in carry, or all), keep_id, group_size, kept, text_sha256; one row per row of docs.

    Texts are compared as they are; a null text counts as the empty text. Of equal texts the row with
    the largest id stays: keep_id is that id for every row of the group, group_size the number of rows,
    kept is doc_id <=> keep_id (null-safe). Defined cases: repeated rows (equal id and text) are all
    kept when their id is the largest; rows without an id lose to any row with one, and a group whose
    rows all lack an id keeps them all with a null keep_id; empty tables give no rows; columns of any
    name are carried inside row, so none clashes.
    """
    spark = docs.sparkSession
    steps = Steps(spark, "exact_dedup")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    scanned = docs.select(
        pack(docs, carry),
        F.col(f"`{id_col}`").alias("doc"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(salts)).alias("salt"),
        F.octet_length(text).alias("len"),
        F.xxhash64(F.substring(text, 1, PREFIX)).alias("head"),
        F.sha2(text, 256).alias("text_sha256"),
    )
    rows = steps.keep(scanned, "rows")
    settled = []
    for level, keys in enumerate((["len"], ["len", "head"], ["len", "text_sha256"])):
        judged = steps.keep(_settle(rows, keys, salts), f"level{level}")
        last = level == 2
        done = judged if last else judged.filter(F.col("size") == 1)
        settled.append(done.select("row", "doc", "keep", "size", "text_sha256"))
        if not last:
            rows = judged.filter(F.col("size") > 1).select(*rows.columns)
    result = settled[0].unionByName(settled[1]).unionByName(settled[2])
    return result.select(
        "row",
        F.col("keep").alias("keep_id"),
        F.col("size").cast("long").alias("group_size"),
        F.col("doc").eqNullSafe(F.col("keep")).alias("kept"),
        "text_sha256",
    )
