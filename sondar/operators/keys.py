"""Key forms and row states, each by its own name: they differ on purpose and are never merged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def norm_key(c: Column) -> Column:
    """Trimmed, without an all-zero fraction."""
    return F.regexp_replace(F.trim(c.cast("string")), r"\.0+$", "")


def norm_code(c: Column) -> Column:
    """Trimmed, without exactly one trailing ``.0``."""
    return F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")


def canon_key(c: Column) -> Column:
    """Trimmed; a decimal number without trailing zeros of its fraction, nor a bare point."""
    t = F.trim(c.cast("string"))
    return F.when(t.rlike(r"^[+-]?\d+\.\d*$"), F.regexp_replace(F.regexp_replace(t, "0+$", ""), r"\.$", "")).otherwise(t)


def fk_key(c: Column, numeric: bool) -> Column:
    """``canon_key`` of numeric columns; text as it is."""
    return canon_key(c) if numeric else c.cast("string")


def effective_null(df: DataFrame, column: str) -> Column:
    """NULL, or blank in a text column."""
    c = F.col(column)
    return c.isNull() | (F.trim(c) == "") if df.schema[column].dataType.typeName() == "string" else c.isNull()


def column(df: DataFrame, name: str) -> str:
    """The column of that name without regard to case; none or several raise."""
    hits = [c for c in df.columns if c.upper() == name.upper()]
    if len(hits) != 1:
        raise ValueError(f"{name}: {len(hits)} columns of that name")
    return hits[0]


def active_declared(df: DataFrame, name: str) -> DataFrame:
    """Rows active by their declared column: an exclusion date that is NULL (or blank), or an exclusion flag not S, Y or 1 (NULL is active). No other column is looked at."""
    if name.upper().startswith("IND_"):
        return df.where(~F.coalesce(F.trim(F.col(name)).isin("S", "Y", "1"), F.lit(False)))
    return df.where(effective_null(df, name))


def active_first(df: DataFrame, candidates: list[str]) -> DataFrame:
    """Rows whose first existing candidate column is NULL or blank; all rows if there is none."""
    names = {c.upper(): c for c in df.columns}
    for c in candidates:
        if c.upper() in names:
            return df.where(effective_null(df, names[c.upper()]))
    return df


def active_null(df: DataFrame, name: str) -> DataFrame:
    """Rows whose column is NULL; blanks are not."""
    return df.where(F.col(name).isNull())


def finite(c: Column) -> Column:
    """Neither NULL, NaN nor infinite."""
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
