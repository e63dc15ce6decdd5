"""Column expressions that several operators share."""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What separates words, as a character class without its brackets.
SPACE_CLASS = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"


def lower_ascii(c: Column) -> Column:
    """A-Z become a-z and nothing else changes; a text of ASCII letters alone takes the faster way."""
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only, F.lower(c)).otherwise(
        F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    )


def held_out(doc_id: str) -> Column:
    """True for the fifth of the ids that no label is learned from; a missing id is held out."""
    rest = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5))
    return F.coalesce(rest == 0, F.lit(True))


def pack(docs: DataFrame, carry: Sequence[str] | None = None) -> Column:
    """The columns of docs (those in carry, or all) as one struct "row", so that no name can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row")


def packed_schema(packed: DataFrame, **added: T.DataType) -> T.StructType:
    """The type of a packed frame's row, and of the columns that an operator adds."""
    return T.StructType([T.StructField("row", packed.schema["row"].dataType), *(T.StructField(n, t) for n, t in added.items())])
