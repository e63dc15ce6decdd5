"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source should be taken target / source size times. The whole part is taken at once;
the fractional parts are rounded together: two documents meet, mass in words moves from one to the
other at random (in the mean nothing changes) until one of them is taken wholly or not at all, and the
other goes on to meet the next. Blocks of documents do this side by side, what is left of each block
meets in the next level, up a tree to one left-over document per source, which gives part of its words.
So a source's total differs from its target by less than a word and the tree's rounding of doubles.

Everything is DataFrame functions. Random numbers are hashes of ids, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .columns import SPACE_CLASS, pack
from .store import Steps

#: Documents that meet in one block on average. Blocks are drawn by hash, so none is much larger.
BLOCK = 32


def word_count(text: Column) -> Column:
    """Number of runs of anything but white space; 0 for null."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), f"[{SPACE_CLASS}]+"), lambda w: w != "")
    return F.size(words).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """source, source_size, target per source of sized (source, size).

    Sources in order of their names, null last, get the weights in turn and share the total times share;
    no target exceeds most times the source's size, and what goes beyond is shared anew by weight. The
    level at which nothing is above its limit comes from a running sum over sources by limit per weight.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(named) - 1, F.lit(len(weights))) + 1)
    )
    sources = sources.select("source", "source_size", weight.alias("weight"))
    sources = sources.select(
        "*",
        (F.col("source_size") * F.lit(float(most))).alias("limit"),
        (F.col("source_size") * F.lit(float(most)) / F.col("weight")).alias("reach"),
    )
    whole = W.partitionBy(F.lit(1))
    rising = whole.orderBy(F.col("reach"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    onward = rising.rowsBetween(W.currentRow, W.unboundedFollowing)
    level = (
        F.sum("source_size").over(whole.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)) * F.lit(float(share))
        - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    ) / F.sum("weight").over(onward)
    # While the level is above a source's reach the source is full; the first that is not sets it for all.
    sources = sources.select("*", level.alias("level"), F.row_number().over(rising).alias("place"))
    sources = sources.withColumn(
        "common",
        F.min(F.when(F.col("level") <= F.col("reach"), F.struct("place", "level"))).over(
            whole.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        )["level"],
    )
    full = F.coalesce(F.col("reach") <= F.col("common"), F.lit(True))
    target = F.when(full, F.col("limit")).otherwise(F.col("weight") * F.col("common"))
    return sources.select("source", "source_size", target.alias("target"))


_UNIT = "struct<id:{id},size:bigint,mass:double,p:double,taken:double>"


def _meet(units: Column, seed: Column, unit: str) -> Column:
    """Pivotal rounding along a sorted array: struct(rest, done).

    rest is the unit that is still fractional, done are the others with taken 0.0 or 1.0.
    """
    nothing = F.lit(None).cast(unit)

    def settle(x: Column, p: Column) -> Column:
        return F.struct(
            x["id"].alias("id"), x["size"].alias("size"), x["mass"].alias("mass"), p.alias("p"), p.alias("taken")
        )

    def step(state: Column, new: Column) -> Column:
        old = state["rest"]
        up = F.least(old["mass"] * (1 - old["p"]), new["mass"] * new["p"])
        down = F.least(old["mass"] * old["p"], new["mass"] * (1 - new["p"]))
        draw = F.pmod(F.xxhash64(old["id"], new["id"], old["size"], new["size"], seed), F.lit(1 << 40)) / F.lit(float(1 << 40))
        rises = draw * (up + down) < down
        old_p = F.when(
            rises,
            F.when(old["mass"] * (1 - old["p"]) <= new["mass"] * new["p"], 1.0).otherwise(old["p"] + up / old["mass"]),
        ).otherwise(
            F.when(old["mass"] * old["p"] <= new["mass"] * (1 - new["p"]), 0.0).otherwise(old["p"] - down / old["mass"])
        )
        new_p = F.when(
            rises,
            F.when(new["mass"] * new["p"] <= old["mass"] * (1 - old["p"]), 0.0).otherwise(new["p"] - up / new["mass"]),
        ).otherwise(
            F.when(new["mass"] * (1 - new["p"]) <= old["mass"] * old["p"], 1.0).otherwise(new["p"] + down / new["mass"])
        )
        old_now, new_now = settle(old, old_p), settle(new, new_p)
        old_done = (old_p <= 0.0) | (old_p >= 1.0)
        met = F.struct(
            F.when(old_done, new_now).otherwise(old_now).cast(unit).alias("rest"),
            F.concat(state["done"], F.array(F.when(old_done, old_now).otherwise(new_now).cast(unit))).alias("done"),
        )
        first = F.struct(new.cast(unit).alias("rest"), state["done"].alias("done"))
        return F.when(old.isNull(), first).otherwise(met)

    start = F.struct(nothing.alias("rest"), F.array().cast(f"array<{unit}>").alias("done"))
    return F.aggregate(units, start, step)


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 42,
) -> DataFrame:
    """row (struct of all columns of docs), size, source_size, target, taken; one row per row of docs.

    taken is a number of words, repeats counted: size times 0, 1 or 2, but for one document of each
    source that gives a part to meet the target. Defined cases: a null text has size 0 and takes 0; a
    missing source is a source of its own, the last; equal rows, and rows with equal id, source and size,
    are taken alike and meet the others as one; a source of size 0 has target 0; no rows give no rows.
    """
    spark = docs.sparkSession
    steps = Steps(spark, "mixing")
    packed = docs.select(
        pack(docs),
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
    )
    narrow = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )
    sized = steps.keep(narrow, "sized")
    targets = steps.keep(source_targets(sized, weights, share, most), "targets")

    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rates = targets.select(F.col("source").alias("of"), rate.alias("rate"), "source_size")
    units = (
        sized.filter("size > 0")
        .groupBy("source", "id", "size")
        .agg(F.count(F.lit(1)).alias("rows"))
        .join(rates, F.col("source").eqNullSafe(F.col("of")))
        .select(
            "source",
            "id",
            "size",
            (F.col("size") * F.col("rows")).cast("double").alias("mass"),
            (F.col("rate") - F.floor("rate")).alias("p"),
        )
        .filter("p > 0")
    )
    kind = _UNIT.format(id=sized.schema["id"].dataType.simpleString())
    place = F.shiftrightunsigned(F.xxhash64("id", "size", F.lit(seed)), 1)
    fields = F.struct("id", "size", "mass", "p", F.lit(None).cast("double").alias("taken")).cast(kind)
    level = units.select("source", F.struct(place.alias("place"), fields.alias("unit")).alias("x"))
    level = steps.keep(level, "level_0")
    largest = level.groupBy("source").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    depth = max(1, math.ceil(math.log(max(largest, 2), BLOCK)))
    settled = None
    for n in range(depth):
        blocks = BLOCK ** (depth - 1 - n)
        met = (
            level.withColumn("block", F.pmod(F.col("x.place"), F.lit(blocks)))
            .groupBy("source", "block")
            .agg(F.sort_array(F.collect_list("x")).alias("xs"))
            .select(
                "source",
                F.col("xs")[0]["place"].alias("place"),
                _meet(F.transform("xs", lambda x: x["unit"]), F.lit(seed + n), kind).alias("met"),
            )
        )
        met = steps.keep(met, f"level_{n + 1}")
        done = met.select("source", F.explode("met.done").alias("u")).select(
            F.col("source").alias("of"), F.col("u.id").alias("of_id"), F.col("u.size").alias("of_size"), F.col("u.taken").alias("share")
        )
        settled = done if settled is None else settled.unionByName(done)
        level = met.select("source", F.struct("place", F.col("met.rest").alias("unit")).alias("x"))
    last = level.select(
        F.col("source").alias("of"), F.col("x.unit.id").alias("of_id"), F.col("x.unit.size").alias("of_size"), F.col("x.unit.p").alias("share")
    )
    settled = settled.unionByName(last)

    by_source = F.col("source").eqNullSafe(F.col("src.source"))
    joined = packed.join(targets.select(F.struct("source", "source_size", "target").alias("src")), by_source)
    same = (
        F.col("id").eqNullSafe(F.col("of_id"))
        & F.col("source").eqNullSafe(F.col("of"))
        & (F.col("size") == F.col("of_size"))
    )
    joined = joined.join(settled, same, "left")
    ratio = F.when(F.col("src.source_size") > 0, F.col("src.target") / F.col("src.source_size")).otherwise(F.lit(0.0))
    taken = F.col("size") * F.floor(ratio) + F.round(F.col("size") * F.coalesce("share", F.lit(0.0))).cast("long")
    return joined.select(
        "row",
        "size",
        F.col("src.source_size").alias("source_size"),
        F.col("src.target").alias("target"),
        taken.cast("long").alias("taken"),
    )
