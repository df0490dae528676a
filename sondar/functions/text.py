"""Column expressions for text: effective emptiness, key forms and character-class masks. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as a blank at either end of a text.
BLANKS = " \t\n\r\f\x0b"


def filled(c: Column) -> Column:
    """The text without outer blanks; NULL where nothing is left (NULL and blank mean the same)."""
    t = F.btrim(c.cast("string"), F.lit(BLANKS))
    return F.when(t != "", t)


def whole_key(c: Column) -> Column:
    """A whole number written in any form (outer blanks, zero fraction, exponent) as bigint; NULL if it is none."""
    d = filled(c).try_cast("decimal(38,10)")
    return F.when(d == F.floor(d), d.try_cast("bigint"))


def mask(c: Column) -> Column:
    """Exact character-class mask: digits 9, upper-case letters A, lower-case letters a, all else as it is."""
    t = F.regexp_replace(c, r"\p{Lu}", "A")
    t = F.regexp_replace(t, r"[\p{L}&&[^A]]", "a")
    return F.regexp_replace(t, r"\p{Nd}", "9")


def run_mask(c: Column) -> Column:
    """The mask with every run of one class, or of blanks, shortened to one sign: short for texts of any length."""
    t = F.regexp_replace(c, r"\p{Lu}+", "A")
    t = F.regexp_replace(t, r"[\p{L}&&[^A]]+", "a")
    t = F.regexp_replace(t, r"\p{Nd}+", "9")
    t = F.regexp_replace(t, r"\s+", " ")
    # words in a row say nothing more than one word does
    return F.regexp_replace(t, r"[Aa]+ [Aa ]*[Aa]", "a a")
