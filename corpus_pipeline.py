"""A corpus from raw documents to a mix, in stages that are each written and read again.

STAGES: (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlane.llm import decontamination, language_id, line_dedup, mixing, near_dedup
from cohortlane.llm.columns import held_out
from cohortlane.llm.store import BATCH_BYTES, Steps, table


def _with_text(packed: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The packed rows' own columns, with the text in another column put in place."""
    own = [F.col(text).alias("text") if c == "text" else F.col("row")[c].alias(c) for c in columns]
    return packed.select(*own)


def _rows(packed: DataFrame, columns: list[str]) -> DataFrame:
    return packed.select(*[F.col("row")[c].alias(c) for c in columns])


#: Languages the corpus keeps (None: every language the model learned), and the least posterior of a kept document.
KEPT_LANGUAGES: tuple[str, ...] | None = None
LEAST_POSTERIOR = 0.5


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that the language model rejects: no letter or no text, a language outside KEPT_LANGUAGES, or a
    posterior under LEAST_POSTERIOR. A model that learned no language (no labelled rows) rejects only documents
    without a letter. The others stay as they are."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    model = language_id.train(docs.filter(~held_out("doc_id")))
    judged = language_id.identify(docs, model)
    if not model.languages:
        keep = F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False))
    else:
        kept = model.languages if KEPT_LANGUAGES is None else KEPT_LANGUAGES
        keep = F.col("lang_pred").isin(*kept) & (F.col("score") >= LEAST_POSTERIOR)
    return _rows(judged.filter(keep), docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that several documents hold stay in the first of them; a document may end up empty."""
    return _with_text(line_dedup.dedup_lines(docs), docs.columns, "kept_text")


def keep_first_of_alike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    return _rows(near_dedup.find_near_duplicates(docs).filter("kept"), docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words a twentieth or more are benchmark passages go; all others stay whole."""
    items = table(spark, sf_dir, "benchmark")
    return _rows(decontamination.find_contamination(docs, items).filter("NOT contaminated"), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What each kept document gives to the mix."""
    done = mixing.mix_sources(docs)
    return done.select(
        F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "size", "source_size", "target", "taken"
    )


STAGES = [
    ("language ID", keep_known_languages),
    ("line dedup", drop_repeated_lines),
    ("near dedup", keep_first_of_alike),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: The stages' models and random rounding have no SQL form; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = Steps(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = steps.keep(stage(spark, docs, sf_dir), f"stage_{n}")
    return docs
