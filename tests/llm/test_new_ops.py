"""Exact dedup, spelling variants and hard negatives against plain Python."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from cohortlane.llm import exact_dedup

from . import cases


def brute_exact(rows):
    groups: dict[str, list] = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        ids = groups[text or ""]
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        out.append((doc_id, keep, len(ids), doc_id == keep, cases.sha(text or "")))
    return sorted(out, key=repr)


def exact_rows(spark, rows, clashes=True):
    done = exact_dedup.dedup_exact(cases.frame(spark, rows, clashes))
    return cases.collected(done.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256"))


def test_exact_dedup_equals_brute_force_on_awkward_rows(spark):
    rng = random.Random(5)
    rows = cases.awkward(rng)
    base = cases.prose(rng, 40)
    # Same length and first characters, different ends; same length, other start; real copies.
    rows += [(30, base + "aa", "en", "a", 1), (31, base + "ab", "en", "a", 1), (32, "b" + base[1:] + "aa", "en", "a", 1)]
    rows += [(33 + i, base + "aa", "en", "a", 1) for i in range(5)]
    assert exact_rows(spark, rows) == brute_exact(rows)


def test_exact_dedup_without_ids_and_on_empty_tables(spark):
    rows = [(None, "same", None, None, None), (None, "same", None, None, None), (None, None, None, None, None)]
    assert exact_rows(spark, rows, False) == brute_exact(rows)
    assert exact_dedup.dedup_exact(cases.empty(spark)).count() == 0


def test_exact_dedup_of_one_large_group(spark):
    rows = [(i, "copy of one text", "en", "a", 1) for i in range(3000)] + [(5000, "other", "en", "a", 1)]
    got = exact_rows(spark, rows, False)
    assert got == brute_exact(rows)
    assert sum(1 for r in got if r[3]) == 2


def brute_variants(rows):
    import re
    import zlib

    counts: dict[str, int] = {}
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = cases.lower(run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 199 == 0:
                    p = h % len(run)
                    run = run[:p] + run[p + 1 :]
            counts[run] = counts.get(run, 0) + 1
    vocab = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        if abs(len(a) - len(b)) != 1:
            return False
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    nears = {w: [o for o in vocab if o != w and near(w, o)] for w in vocab}
    forms = {}
    for w, others in nears.items():
        best = min(others, key=lambda o: (-vocab[o], o), default=None)
        forms[w] = best if best is not None and vocab[best] >= 5 * vocab[w] else None
    out = []
    for w in vocab:
        root = w
        while forms[root] is not None:
            root = forms[root]
        f = forms[w]
        out.append((w, f, root, vocab[w], len(nears[w]), vocab[f] if f else None))
    return sorted(out, key=repr)


def variant_rows(spark):
    rng = random.Random(8)
    stems = ["language", "modeling", "tokenizer", "étésdeux", "dataset", "training", "quality"]
    made = {
        "language": ["languag", "lamguage", "languages", "langauge", "lnguage"],
        "modeling": ["modelling", "modeing", "Modeling"],
        "tokenizer": ["tokeniser", "tokenizers", "okenizer"],
        "dataset": ["datasets", "dataste"],
    }
    rows = []
    for i in range(1, 1200):
        words = []
        for _ in range(12):
            stem = rng.choice(stems)
            if stem in made and rng.random() < 0.15:
                stem = rng.choice(made[stem])
            words.append(stem.upper() if rng.random() < 0.05 else stem)
        rows.append((i, " ".join(words) + " x9y" + "×ab", "en", "a", 1))
    rows += [(None, "languag languag languag languag languag", "en", "a", 1), (2000, None, "en", "a", 1), (2001, "", "en", "a", 1)]
    # A chain: lanuag is near languag, which is near language.
    rows += [(3000, "lanuag " * 6, "en", "a", 1)]
    return rows


def test_spelling_variants_equal_brute_force(spark):
    from cohortlane.llm import spelling

    rows = variant_rows(spark)
    done = spelling.group_variants(cases.frame(spark, rows))
    got = cases.collected(done.select("word", "form", "root", "n", "n_near", "form_n"))
    want = brute_variants(rows)
    assert got == want
    assert any(r[1] is not None for r in want) and any(r[2] != r[1] and r[1] is not None for r in want)
    assert spelling.group_variants(cases.empty(spark)).count() == 0


def brute_negatives(rows):
    import math

    kept = []
    for vec_id, vec, label in rows:
        if vec_id is None or label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        if vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, label, [math.floor(256 * float(x)) for x in vec]))
    out = []
    for a_id, a_label, a in kept:
        if a_id % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(a, v)), i, lab) for i, lab, v in kept if i != a_id]
        scored.sort()
        pos = [(i, -s) for s, i, lab in scored if lab == a_label][:5]
        for p, ps in pos:
            neg = [(i, -s) for s, i, lab in scored if lab != a_label and 50 * ps <= -100 * s <= 95 * ps][:3]
            out += [(a_id, p, r + 1, i, ps, ns) for r, (i, ns) in enumerate(neg)]
    return sorted(out)


def negatives_rows(n=1500, seed=4):
    import numpy as np

    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(n):
        c = centres[i % 12] + 0.6 * rng.normal(size=16)
        c /= np.linalg.norm(c)
        rows.append((i, [float(x) for x in c], int(rng.integers(0, 10))))
    rows[3] = (3, [float("nan")] + rows[3][1][1:], 2)
    rows[5] = (5, None, 2)
    rows[6] = (6, [None] + rows[6][1][1:], 2)
    rows[8] = (8, rows[8][1], None)
    rows[9] = (9, [1e6] + rows[9][1][1:], 1)
    rows[11] = (11, rows[100][1], rows[100][2])  # a tie with anchor 100's own vector
    rows += [(2000 + k, rows[50][1], 4) for k in range(40)]  # many equal vectors
    rows += [(None, rows[1][1], 1)]
    return rows


def test_hard_negatives_equal_brute_force(spark):
    from cohortlane.llm import hard_negatives

    rows = negatives_rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("row", F.lit(1))
    got = sorted(tuple(r) for r in hard_negatives.mine_hard_negatives(df).collect())
    want = brute_negatives([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows])
    assert got == want
    assert len(want) > 100


def test_hard_negatives_of_empty_table(spark):
    from cohortlane.llm import hard_negatives

    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine_hard_negatives(df).count() == 0


def test_hard_negatives_in_small_tiles_and_chunks(spark, monkeypatch):
    from cohortlane.llm import hard_negatives

    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(hard_negatives, "NODES", 40)
    rows = negatives_rows(n=700, seed=9)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in hard_negatives.mine_hard_negatives(df).collect())
    want = brute_negatives([(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows])
    assert got == want
