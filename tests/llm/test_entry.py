"""The registered corpus queries and the pipeline over the small tables."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from cohortlane.llm import language_id
from cohortlane.llm.language_id import has_letter
from cohortlane.llm.oracle import ORACLE
from cohortlane.llm.queries import QUERIES
from cohortlane_checks.compare import difference, duck

from . import cases
from .test_alike import brute_near, copies, shingles
from .test_filters import brute_contamination
from .test_models import targets

SMALL = "/root/testdata/sf0.001"


def test_every_operator_is_registered_once():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), duck(SMALL), ORACLE[name]) is None


def test_pipeline_stages_keep_columns_and_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("row", F.lit("own"))
    before = docs
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = stage(spark, before, SMALL)
        if n < len(corpus_pipeline.STAGES) - 1:
            assert after.columns == before.columns, name
        path = os.path.join(tmp_path, str(n))
        after.write.parquet(path)
        before = spark.read.parquet(path)
    assert 0 < before.count() <= docs.count()
    assert before.filter("taken < 0 OR taken > 2 * size").count() == 0


def test_pipeline_rows_are_those_of_plain_python(spark, tmp_path):
    """All but the random rounding, with awkward documents through all stages."""
    rng = random.Random(14)
    items = [(1, cases.prose(rng, 30, "be")), (2, None), (3, "nothing")]
    rows = cases.awkward(rng) + copies(rng)
    rows += [(2000, f"{items[0][1]} and more", "en", "b", 1), (2001, cases.prose(rng, 900) + " " + items[0][1], "en", "b", 1)]
    cases.frame(spark, rows, False).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    done = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "source", "size", "source_size", "target", "taken")
    got = cases.collected(done)

    from cohortlane.llm.columns import held_out

    model = language_id.train(cases.frame(spark, rows, False).filter(~held_out("doc_id")))
    said, sure = model.predict([r[1] for r in rows])
    left = [r for r, lang, p in zip(rows, said, sure) if lang in model.languages and p >= corpus_pipeline.LEAST_POSTERIOR]
    key = lambda line: cases.lower(line.strip(" \t\n\x0b\x0c\r"))
    held: dict[str, set] = {}
    for r in left:
        for line in r[1].split("\n"):
            if len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(r[0])
    first = {k: min((d for d in ids if d is not None), default=None) for k, ids in held.items() if len(ids) > 1}
    left = [(r[0], "\n".join(x for x in r[1].split("\n") if first.get(key(x), r[0]) == r[0]), *r[2:]) for r in left]
    kept = {(g[0], g[2]) for g in brute_near(left) if g[4]}
    left = [r for r in left if (r[0], len(shingles(r[1]))) in kept]
    clean = [r for r in left if not brute_contamination(r[1], items)[3]]
    assert len(clean) < len(left) < len(rows) and 2001 in {r[0] for r in clean}
    sizes: dict = {}
    for r in clean:
        sizes[r[3]] = sizes.get(r[3], 0) + len(cases.words_of(r[1]))
    names = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    of = targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    want = sorted(((r[0], r[3], len(cases.words_of(r[1])), sizes[r[3]]) for r in clean), key=repr)
    assert sorted((g[:4] for g in got), key=repr) == want
    for _, source, size, _, target, taken in got:
        assert target == pytest.approx(of[source]) and 0 <= taken <= 2 * size


def test_language_stage_without_labels_keeps_what_has_a_letter(spark):
    rows = [(1, "plain words here", None, "a", 1), (2, "12 34 !!", None, "a", 1), (3, None, None, "a", 1), (4, "\u00c9t\u00e9", None, "b", 1)]
    kept = corpus_pipeline.keep_known_languages(spark, cases.frame(spark, rows), SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in rows if has_letter(r[1])]


def test_language_stage_drops_languages_not_kept(spark, monkeypatch):
    rng = random.Random(2)
    english = [(i, " ".join(rng.choice(["the", "and", "which", "there", "would", "about"]) for _ in range(40)), "en", "a", 1) for i in range(1, 40)]
    german = [(i, " ".join(rng.choice(["und", "nicht", "werden", "über", "schön", "müssen"]) for _ in range(40)), "de", "a", 1) for i in range(40, 80)]
    monkeypatch.setattr(corpus_pipeline, "KEPT_LANGUAGES", ("en",))
    kept = corpus_pipeline.keep_known_languages(spark, cases.frame(spark, english + german), SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in english]
