"""Awkward documents that every operator has to stand, and plain-Python versions to compare with."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
#: Names that the operators use inside, as columns of the input.
CLASHES = (
    "row", "doc", "version", "id", "n", "node", "key", "keys", "pos", "size", "kept", "component_id", "spans", "score",
    "lang_pred", "target", "taken", "symbol", "words", "least", "found", "base", "h1", "salt", "dropped", "in_doc", "path",
)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def prose(rng: random.Random, n: int, stem: str = "") -> str:
    words = [stem + "".join(rng.choice("aeioustrnlmd") for _ in range(rng.randint(2, 8))) for _ in range(n)]
    return "\n".join(" ".join(words[i : i + 12]) for i in range(0, n, 12))


def edited(rng: random.Random, text: str, share: float) -> str:
    return " ".join("X" + w if rng.random() < share else w for w in text.split(" "))


def awkward(rng: random.Random) -> list[tuple]:
    """(doc_id, text, lang, source, n_chars) with nulls, empties, repeats, copies and a very long text."""
    base, other = prose(rng, 180), prose(rng, 160, "zu")
    passage = prose(rng, 70, "pa")
    license_line = "This line stands in Many documents."
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (2, base, "en", "a", 1),
        (3, edited(rng, base, 0.01), "en", "b", 1),
        (4, edited(rng, base, 0.03), "en", "b", None),
        (5, edited(rng, base, 0.2), None, "b", 1),
        (6, None, "en", "a", 0),
        (7, "", "en", None, 0),
        (8, " \t\n\r\x0b\x0c ", "de", "a", 3),
        (9, "12 34 !!", "de", "c", 3),
        (None, other, "de", "c", 5),
        (None, other, "de", "c", 5),
        (None, "nur ein \u00c4rger", "de", None, 5),
        (10, other, "de", "c", 5),
        (11, "one two", "en", "c", 5),
        (12, "One TWO", "en", "c", 5),
        (13, prose(rng, 40) + "\n" + passage + "\n" + prose(rng, 40), "en", "a", 9),
        (14, prose(rng, 10) + " " + passage + " " + prose(rng, 90), "en", "a", 9),
        (15, passage, "en", "a", 9),
        (16, "w " * 300 + passage, "en", "d", 9),
        (17, "w " * 400, "en", "d", 9),
        (18, prose(rng, 30_000), "en", "d", 9),
        (19, license_line + "\n\n" + prose(rng, 20), "en", "a", 9),
        (20, prose(rng, 20) + "\n  " + license_line.upper() + "\u0009", "en", "b", 9),
        (20, prose(rng, 20) + "\n" + license_line, "en", "b", 9),
        (21, "\u00c9t\u00e9 \U0001f600 " + "x" * 5000 + " password = 'abcDEF123456'", "fr", "b", 9),
    ]
    return rows


def frame(spark, rows: list[tuple], clashes: bool = True):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit(f"kept {c}") for c in CLASHES}) if clashes else df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def collected(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
