"""One registered query per operator, over whole tables, with the parameters meant for production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    exact_dedup,
    hard_negatives,
    language_id,
    line_dedup,
    mixing,
    near_dedup,
    quality,
    secrets,
    spelling,
    substring_dedup,
    topk,
    url_filter,
)
from .columns import held_out
from .store import table

#: The rules of op10, as the contract gives them.
URL_RULES = (
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
)


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = secrets.scan_secrets(docs, carry=("doc_id",))

    def count(kind: str) -> Column:
        # One parameter alone: Spark fills a second one with the element's position.
        of_kind = F.filter("base", lambda span: span["kind"] == secrets.KINDS.index(kind))
        return F.size(of_kind).cast("long").alias(f"n_{kind}")

    return done.select(
        "row.doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secrets.span_text(F.col("base")), 256).alias("base_sha256"),
        secrets.span_text(F.concat("base", "random")).alias("spans"),
    )


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs.filter(~held_out("doc_id")))
    done = language_id.identify(docs.select("doc_id", "text"), model, carry=("doc_id",))
    return done.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "lang_pred", "score")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    model = quality.train(docs, labels.filter(~held_out("doc_id")))
    done = quality.score_quality(docs, model, carry=("doc_id",))
    return done.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "score", "predicted")


def op4_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = near_dedup.find_near_duplicates(docs, carry=("doc_id",))
    return done.select("row.doc_id", "n_shingles", "component_id", "kept")


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = line_dedup.dedup_lines(docs)
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("row.doc_id", "size", "source_size", "target", "taken")


def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings").select("vec_id", "embedding"))


def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = substring_dedup.dedup_passages(docs, carry=("doc_id",))
    return done.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    items = table(spark, folder, "benchmark").select("item_id", "text")
    done = decontamination.find_contamination(docs, items, carry=("doc_id",))
    return done.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES)


def op11_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    done = exact_dedup.dedup_exact(docs, carry=("doc_id",))
    return done.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spelling.group_variants(docs)


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine_hard_negatives(table(spark, folder, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_language_id,
        op3_quality,
        op4_near_dedup,
        op5_line_dedup,
        op6_mixing,
        op7_topk,
        op8_substring_dedup,
        op9_decontamination,
        op10_url_filter,
        op11_exact_dedup,
        op12_spelling_variants,
        op13_hard_negatives,
    )
}
