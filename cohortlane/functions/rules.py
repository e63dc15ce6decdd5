"""Cell-format rules: which class a displayed value gets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .text import is_no, parse_float, strip


@dataclass(frozen=True)
class Rule:
    """``kind`` is ``no``, ``contains`` (with ``text``) or ``range`` (``low`` <= number < ``high``)."""

    column: str
    kind: str
    cell_class: str
    text: str = ""
    low: float | None = None
    high: float | None = None

    def holds(self, c: Column) -> Column:
        if self.kind == "no":
            return is_no(c.cast("string"))
        if self.kind == "contains":
            return F.lower(strip(c.cast("string"))).contains(self.text)
        number = parse_float(c)
        above = F.lit(True) if self.low is None else number >= F.lit(self.low)
        below = F.lit(True) if self.high is None else number < F.lit(self.high)
        return above & below & ~F.isnan(number)


# Rules of the user reports.
USER_RULES = (
    Rule("User Onboarded", "no", fv.CELL_RED),
    Rule("Goals Set", "no", fv.CELL_YELLOW),
    Rule("Smart Scale Logged", "no", fv.CELL_YELLOW),
    Rule("Meal Logged", "no", fv.CELL_YELLOW),
    Rule("Interaction (5 Days)", "no", fv.CELL_YELLOW),
    Rule("Meal Log (3 days)", "no", fv.CELL_YELLOW),
    Rule("Weight Log (7 days)", "no", fv.CELL_YELLOW),
    Rule("Days Since Last Interaction", "range", fv.CELL_RED, low=5),
    Rule("Days Since Last Interaction", "range", fv.CELL_YELLOW, low=2, high=5),
    Rule("On/Off Track", "contains", fv.CELL_ORANGE, text="off track"),
    Rule("Current Weight Lose", "range", fv.CELL_RED, high=0),
)

# Rules of the team report.
TEAM_RULES = (
    Rule("User Onboarded", "no", fv.COLOUR_RED),
    Rule("Goals Set", "no", fv.COLOUR_YELLOW),
    Rule("Smart Scale Logged", "no", fv.COLOUR_YELLOW),
    Rule("Meal Logged", "no", fv.COLOUR_YELLOW),
    Rule("Interaction (5 Days)", "no", fv.COLOUR_YELLOW),
    Rule("Meal Log (3 days)", "no", fv.COLOUR_YELLOW),
    Rule("Weight Log (7 days)", "no", fv.COLOUR_YELLOW),
    Rule("Weight Log(last 7 days )", "no", fv.COLOUR_YELLOW),
    Rule("Active Yesterday", "no", fv.COLOUR_RED),
    Rule("On/Off Track", "contains", fv.COLOUR_ORANGE, text="off track"),
    Rule("Current Weight Lose", "range", fv.COLOUR_RED, high=0),
)


def cell_classes(df: DataFrame, rules: tuple[Rule, ...] = USER_RULES) -> Column:
    """Map column name -> class.  Rules match names exactly; rules for absent columns never fire."""
    by_column: dict[str, Column] = {}
    for rule in rules:
        if rule.column in df.columns:
            hit = rule.holds(F.col(f"`{rule.column}`"))
            chain = by_column.get(rule.column)
            by_column[rule.column] = (
                F.when(hit, rule.cell_class) if chain is None else chain.when(hit, rule.cell_class)
            )
    return class_map(by_column)


def class_map(by_column: dict[str, Column]) -> Column:
    """Map of the entries whose class is not NULL."""
    if not by_column:
        return F.create_map().cast("map<string,string>")
    entries = F.array(
        *[F.struct(F.lit(name).alias("key"), c.alias("value")) for name, c in by_column.items()]
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def format_rules(df: DataFrame, keys: list[str], rules: tuple[Rule, ...] = USER_RULES) -> DataFrame:
    """Long form: one row per coloured cell."""
    return df.select(*[F.col(f"`{k}`") for k in keys], F.explode(cell_classes(df, rules))).select(
        *[F.col(f"`{k}`") for k in keys], F.col("key").alias("column_name"), F.col("value").alias("cell_class")
    )
