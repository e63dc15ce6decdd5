"""Text, name and number-text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv


def strip(c: Column) -> Column:
    """Remove every kind of leading and trailing white space (F.trim alone takes spaces only)."""
    return F.trim(c, F.lit(fv.WHITESPACE))


def non_blank(c: Column) -> Column:
    return c.isNotNull() & (F.trim(c) != "")


def blank_to_null(c: Column, also: tuple[str, ...] = ()) -> Column:
    """Stripped text; NULL where nothing is left or the text is one of ``also`` in any case."""
    text = strip(c)
    if also:
        return F.when(~F.lower(text).isin("", *also), text)
    return F.nullif(text, F.lit(""))


def normalize_name(c: Column) -> Column:
    return blank_to_null(F.lower(c))


def not_in_normalised(c: Column, names: tuple[str, ...]) -> Column:
    """Case- and space-insensitive exclusion; a NULL text is excluded too, as in SQL NOT IN."""
    return ~F.lower(F.trim(c)).isin(*[n.strip().lower() for n in names])


def not_in_lowered(c: Column, names: tuple[str, ...]) -> Column:
    """Exclusion in any case; white space counts.  A NULL text is excluded too."""
    return ~F.lower(c).isin(*[n.lower() for n in names])


def full_name(first: Column, middle: Column, last: Column) -> Column:
    def optional(part: Column) -> Column:
        return F.when(part != "", F.concat(F.lit(" "), part)).otherwise("")

    return F.trim(F.concat(F.coalesce(first, F.lit("")), optional(middle), optional(last)))


def short_name(first: Column, last: Column) -> Column:
    """Two-part form; deliberately not trimmed."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def trim_alias(c: Column, name: str) -> Column:
    return F.trim(c).alias(name)


def yes_no(flag: Column) -> Column:
    return F.when(flag, fv.YES).otherwise(fv.NO)


def is_no(c: Column) -> Column:
    return F.lower(strip(c)) == "no"


def signed(n: Column) -> Column:
    return F.concat(F.when(n >= 0, "+").otherwise(""), n.cast("string"))


def days_label(name: Column, days: Column) -> Column:
    """``name (n days)`` from two days on, NULL before that."""
    return F.when(days >= 2, F.concat(name, F.lit(" ("), days.cast("int").cast("string"), F.lit(" days)")))


def inactivity_reason(food: Column, habit: Column, activity: Column) -> Column:
    missing = F.concat_ws(
        ", ",
        F.when(~food, fv.MISSING_MEAL),
        F.when(~habit, fv.MISSING_HABIT),
        F.when(~activity, fv.MISSING_ACTIVITY),
    )
    return F.when(food & habit & activity, fv.ACTIVE_TEXT).otherwise(missing)


def reason_override(c: Column, reason: Column) -> Column:
    """``reason`` in place of a "No" when a reason is given."""
    return F.when(is_no(c) & (reason != ""), reason).otherwise(c)


_NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
_NOT_FINITE = r"(?i)^[+-]?(nan|inf|infinity)$"


def parse_float(c: Column) -> Column:
    """Text to double, NULL when it is not a number; accepts exponents, ``1_000``, inf and nan."""
    text = strip(c.cast("string"))
    finite = F.when(text.rlike(_NUMBER), F.replace(text, F.lit("_"), F.lit("")))
    special = F.when(text.rlike(_NOT_FINITE), F.regexp_replace(text, r"(?i)^[+-](nan)$", "$1"))
    return F.coalesce(finite, special).try_cast("double")


def json_cell(c: Column, dtype: T.DataType) -> Column:
    """One cell as text: nested values as JSON, NULL as an empty string."""
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        c = F.to_json(c, {"ignoreNullFields": "false"})
    return F.coalesce(c.cast("string"), F.lit(""))


def normalise_columns(df: DataFrame) -> DataFrame:
    """Column names trimmed and lower-cased; among equal names the last column wins."""
    last = {strip_text(name): name for name in df.columns}
    return df.select(*[df[f"`{name}`"].alias(key) for key, name in last.items()])


def strip_text(name: str) -> str:
    return name.strip().lower()


def first_filled(columns: list[Column]) -> Column:
    """The first column whose text is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])
