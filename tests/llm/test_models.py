"""Language identification, quality and mixing: held-out accuracy, exact sums and awkward rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlane.llm import language_id, mixing, quality
from cohortlane.llm.columns import held_out
from cohortlane.llm.queries import QUERIES

from . import cases


def test_held_out_language_accuracy(spark, folder):
    done = QUERIES["op2_language_id"](spark, folder)
    truth = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    row = done.join(truth, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert row[0] >= 0.98 and row[1] > 100


def test_language_scores_are_sums_of_looked_up_grams(monkeypatch):
    rng = np.random.default_rng(1)
    logs = rng.normal(size=(2, language_id._NONE + 1)).astype(np.float32)
    logs[:, language_id._NONE] = 0
    model = language_id.Model(["a", "b"], logs, np.zeros(2))
    texts = ["Abc d\u00e9f", "x", "", "longer text " * 30]
    whole = model.scores(texts)
    monkeypatch.setattr(language_id, "PIECE", 7)
    assert np.allclose(model.scores(texts), whole, atol=1e-3)


def test_language_of_awkward_rows(spark):
    rows = cases.awkward(random.Random(2))
    docs = cases.frame(spark, rows)
    model = language_id.train(docs.filter(~held_out("doc_id")))
    assert set(model.languages) <= {"en", "de", "fr"}
    got = language_id.identify(docs, model).select("row.doc_id", "row.text", "row.score", "lang_pred", "score").collect()
    assert len(got) == len(rows)
    for _, text, kept, predicted, score in got:
        assert kept == "kept score"
        assert (predicted == "und") == (not language_id.has_letter(text))
        assert 0 <= score <= 1 and (score == 0) == (predicted == "und")
    nothing = language_id.train(cases.empty(spark))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    assert language_id.identify(cases.empty(spark), model).count() == 0


def test_quality_learns_shapes_and_pairs():
    rng = np.random.default_rng(3)
    x = rng.random((4000, len(quality.FEATURES)))
    y = ((x[:, 0] > 0.6) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    right = (model.score(x[3000:]) >= 0.5) == y[3000:]
    assert right.mean() > 0.9
    assert (1, 0) in model.pairs


def test_quality_of_held_out_and_awkward_rows(spark, folder):
    done = QUERIES["op3_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    got = done.join(labels, "doc_id").filter("held_out").toPandas()
    assert (got["predicted"] == got["quality"]).mean() > 0.9
    docs = cases.frame(spark, cases.awkward(random.Random(4)))
    given = spark.createDataFrame([(1, 1), (9, 0), (None, 1), (11, None), (2, 1), (2, 0)], "doc_id long, quality int")
    for labelled in (given, given.limit(0)):
        model = quality.train(docs, labelled)
        scored = quality.score_quality(docs, model).select("row.n", "score", "predicted").collect()
        assert len(scored) == docs.count()
        assert all(0 <= s <= 1 and p == (s >= 0.3) and n == "kept n" for n, s, p in scored)
    assert quality.score_quality(cases.empty(spark), model).count() == 0


def targets(sizes, weights, share=1.5, most=2.0):
    """Reshares what goes beyond the limits until nothing does."""
    open_, out, rest = set(sizes), {}, share * sum(sizes.values())
    while open_:
        level = rest / sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] * level > most * sizes[s]}
        if not full:
            return out | {s: weights[s] * level for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            rest -= out[s]
        open_ -= full
    return out


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(6)
    rows = cases.awkward(rng)
    rows += [(1000 + i, "w " * rng.randint(0, 60), "en", f"s{min(i % 40, 12)}", 1) for i in range(1500)]
    docs = cases.frame(spark, rows)
    done = mixing.mix_sources(docs).select("row.doc_id", "row.source", "row.target", "size", "source_size", F.col("target").alias("t"), "taken")
    got = [tuple(r) for r in done.collect()]
    assert len(got) == len(rows)
    assert sorted(((r[0], r[3]) for r in got), key=repr) == sorted(((r[0], len(cases.words_of(r[1]))) for r in rows), key=repr)
    sizes: dict = {}
    for r in got:
        sizes[r[1]] = sizes.get(r[1], 0) + r[3]
        assert r[2] == "kept target" and 0 <= r[6] <= 2 * r[3]
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    for s in names:
        own = [r for r in got if r[1] == s]
        assert {r[4] for r in own} == {sizes[s]}
        assert own[0][5] == pytest.approx(want[s])
        repeated = 2 if s in ("a", "c") else 1  # equal rows are taken alike, each with its part
        assert abs(sum(r[6] for r in own) - want[s]) <= repeated
        partial = [r for r in own if r[3] and r[6] % r[3]]
        assert len({r[0] for r in partial}) <= 1
    again = [tuple(r) for r in mixing.mix_sources(docs.repartition(5)).select("row.doc_id", "row.source", "row.target", "size", "source_size", F.col("target").alias("t"), "taken").collect()]
    assert sorted(again, key=repr) == sorted(got, key=repr)
    assert mixing.mix_sources(cases.empty(spark)).count() == 0
