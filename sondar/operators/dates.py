"""Date rules: one run date, terms kept, children moved by their parent's shift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .skew import sized_join


def as_day(c: Column) -> Column:
    """The day of a date, a time or a text that starts with one; NULL if it names none."""
    return F.substring(F.trim(c.cast("string")), 1, 10).try_cast("date")


def preserve_term(df: DataFrame, issue: str, maturity: str, today: str, default_term: int = 30, least_term: int = 1) -> DataFrame:
    """issue becomes ``today`` and maturity keeps its distance in days: at least ``least_term``, ``default_term`` if unknown. The term is taken before either is overwritten; types stay."""
    term = F.greatest(F.coalesce(F.datediff(as_day(F.col(maturity)), as_day(F.col(issue))), F.lit(default_term)), F.lit(least_term))
    day = F.lit(today).cast("date")
    return df.withColumns({issue: day.cast(df.schema[issue].dataType), maturity: F.date_add(day, term).cast(df.schema[maturity].dataType)})


def shifts(parents: DataFrame, key: str, date: str, today: str) -> DataFrame:
    """key, dias: by how many days each parent's date moves to ``today``; parents without a date don't move their children."""
    return parents.groupBy(key).agg(F.max(F.datediff(F.lit(today).cast("date"), as_day(F.col(date)))).alias("dias"))


def shift_children(children: DataFrame, key: str, columns: list[str], moved: DataFrame, scratch: Scratch, spread: list[str]) -> DataFrame:
    """Children's dates moved by their parent's days; without a parent or a date they stay. Type and columns stay."""
    both = sized_join(children, moved, [key], "left", spread, scratch)
    new = {c: F.when(F.col("dias").isNotNull() & as_day(F.col(c)).isNotNull(), F.date_add(as_day(F.col(c)), F.col("dias")).cast(children.schema[c].dataType)).otherwise(F.col(c)) for c in columns}
    return both.withColumns(new).select(*children.columns)
