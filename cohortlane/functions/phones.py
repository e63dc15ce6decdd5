"""Phone columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip


def digits_only(c: Column) -> Column:
    """All ASCII digits of the text, country code kept; an empty string for NULL."""
    return F.coalesce(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))


def normalize_phone(c: Column) -> Column:
    """Comparison key: punctuation and the Indian country code dropped, last ten digits."""
    compact = F.translate(strip(F.coalesce(c, F.lit(""))), " -()", "")
    local = (
        F.when(compact.startswith("+91"), F.substr(compact, F.lit(4)))
        .when(compact.startswith("91") & (F.length(compact) > 10), F.substr(compact, F.lit(3)))
        .otherwise(compact)
    )
    return F.right(digits_only(local), F.lit(10))


def spread_blank(key: Column, row_id: Column) -> Column:
    """A join key in which blank phones do not pile up in one task.

    Blank keys match nothing; a non-digit key made of the row's own id keeps that true
    and spreads them over the partitions.
    """
    own = F.concat(F.lit("~"), F.coalesce(row_id.cast("string"), F.lit("")))
    return F.when(key == "", own).otherwise(key)
