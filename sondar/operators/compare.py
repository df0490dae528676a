"""Differences between two copies of a dataset (problem 5): null-safe full outer join on the key, field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import filled, whole_key
from .prefix import ordinal
from .scratch import Scratch
from .skew import HOT_ROWS, hot_keys

#: A key with so many rows is hot: its versions are numbered in ranges of their values, not in one task.
VERSION_ROWS = HOT_ROWS
KEY = ("__key", "__raw")
DIFS = "array<struct<campo:string,esquerda:string,direita:string>>"


def normal(df: DataFrame, column: str, kind: str) -> Column:
    """A field in the form in which copies are compared, as text.

    kind: ``text`` (outer blanks removed, blank = NULL), ``second`` (a time without the fraction of its second), ``cents``
    (a number rounded to two decimals) or ``number`` (a whole number in any form).
    """
    c = F.col(f"`{column}`")
    if kind == "second":
        return F.date_format(F.date_trunc("second", c), "yyyy-MM-dd HH:mm:ss")
    if kind == "cents":
        return F.round(c, 2).try_cast("decimal(38,2)").cast("string")
    if kind == "number":
        return whole_key(c).cast("string")
    return filled(c)


def kind_of(column: str, a: T.DataType, b: T.DataType) -> str:
    """How a field is compared, from its types on both sides."""
    times, fractions = (T.TimestampType, T.TimestampNTZType, T.DateType), (T.DoubleType, T.FloatType, T.DecimalType)
    if isinstance(a, times) and isinstance(b, times):
        return "second"
    if isinstance(a, fractions) or isinstance(b, fractions):
        return "cents"
    if isinstance(a, T.IntegralType) or isinstance(b, T.IntegralType):
        return "number"
    return "text"


def _rows(df: DataFrame, key: str, kinds: dict[str, str]) -> DataFrame:
    """The key as __key (0 if it is no whole number) and __raw ('' if it is one, else '~' and its text), and the normalised fields as __row."""
    fields = F.struct(*(normal(df, c, k).alias(c) for c, k in kinds.items()), F.lit(None).cast("string").alias("__"))
    c = F.col(f"`{key}`")
    number = whole_key(c)
    raw = F.when(number.isNotNull(), F.lit("")).otherwise(F.concat(F.lit("~"), F.coalesce(filled(c), F.lit(""))))
    return df.select(F.coalesce(number, F.lit(0)).cast("bigint").alias("__key"), raw.alias("__raw"), fields.alias("__row"))


def _numbered(rest: DataFrame, hot: list[tuple], scratch: Scratch) -> DataFrame:
    """``rest`` (KEY, __side, __row; distinct) with __version: its place among its key's rows of that side, in the order of their values."""
    group = [*KEY, "__side"]
    w = Window.partitionBy(*KEY).orderBy("__side", "__row")
    is_hot = F.concat_ws("|", "__key", "__raw").isin([f"{k}|{r}" for k, r in hot])
    cold = rest.where(~is_hot) if hot else rest
    # both sides of a key lie behind each other: the second side's numbers start again
    out = cold.withColumn("__n", F.row_number().over(w)).withColumn("__first", F.min(F.when(F.col("__side") == 2, F.col("__n"))).over(Window.partitionBy(*KEY)))
    out = out.select(*group, "__row", F.when(F.col("__side") == 2, F.col("__n") - F.col("__first") + 1).otherwise(F.col("__n")).cast("bigint").alias("__version"))
    if hot:
        many = scratch.keep(ordinal(rest.where(is_hot), [*group, "__row"], "__at"))
        low = many.groupBy(*group).agg(F.min("__at").alias("__low"))  # a row a hot key and side
        out = out.unionByName(many.join(F.broadcast(low), group).select(*group, "__row", (F.col("__at") - F.col("__low") + 1).alias("__version")))
    return out


def differences(left: DataFrame, right: DataFrame, key: str, scratch: Scratch) -> DataFrame:
    """One row a key and version: chave, texto_chave, versao, situacao (so_origem, so_destino, valor, igual) and difs, an array of (campo, esquerda, direita).

    All columns that both sides have, but for the key, are compared in normal form (NaN counts as NULL). Repeated rows
    count once. A full outer join on key and normalised row, NULL equal to NULL, first finds the rows that both sides
    have (igual, versao 0). Of what only one side has, the n-th row of a key on one side is compared with its n-th row
    on the other (versao n), in the order of their values, at any size; a row without such a partner is one-sided. A key
    that is no whole number is matched by its text (texto_chave; chave is NULL then), empty keys with empty ones. An
    empty side leaves every key of the other one-sided.
    """
    there = set(right.columns)
    kinds = {c: kind_of(c, left.schema[c].dataType, right.schema[c].dataType) for c in left.columns if c in there and c != key}
    a, b = _rows(left, key, kinds), _rows(right, key, kinds)
    hot = sorted({k for df in (a, b) for k in hot_keys(df, list(KEY), VERSION_ROWS)})
    # repeats are combined before the shuffle, by which the join then finds both sides in place; the versions of a key spread with it
    x, y = (df.distinct().withColumn("__here", F.lit(True)).alias(n) for df, n in ((a, "x"), (b, "y")))
    same = F.lit(True)
    for c in (*KEY, "__row"):
        same = same & (F.col(f"x.{c}") == F.col(f"y.{c}"))  # rows are structs: their NULL fields are equal to each other
    both = x.join(y, same, "full").select(
        *(F.coalesce(f"x.{c}", f"y.{c}").alias(c) for c in (*KEY, "__row")),
        F.when(F.col("x.__here") & F.col("y.__here"), 0).when(F.col("x.__here"), 1).otherwise(2).alias("__side"),
    )
    both = scratch.keep(both)
    rest = _numbered(both.where(F.col("__side") > 0), hot, scratch)
    each = rest.groupBy(*KEY, "__version").agg(F.max(F.when(F.col("__side") == 1, F.col("__row"))).alias("__left"), F.max(F.when(F.col("__side") == 2, F.col("__row"))).alias("__right"))
    pairs = F.array(*(F.struct(F.lit(c).alias("campo"), F.col("__left").getField(c).alias("esquerda"), F.col("__right").getField(c).alias("direita")) for c in kinds)) if kinds else F.array().cast(DIFS)
    name = (F.when(F.col("__raw") == "", F.col("__key")).alias("chave"), F.when(F.col("__raw") != "", F.substring("__raw", 2, 2**31 - 1)).alias("texto_chave"))
    differ = each.select(
        *name,
        F.col("__version").alias("versao"),
        F.when(F.col("__right").isNull(), "so_origem").when(F.col("__left").isNull(), "so_destino").otherwise("valor").alias("situacao"),
        F.filter(pairs, lambda p: ~p["esquerda"].eqNullSafe(p["direita"])).alias("difs"),
    )
    return differ.unionByName(both.where(F.col("__side") == 0).select(*name, F.lit(0).cast("bigint").alias("versao"), F.lit("igual").alias("situacao"), F.array().cast(DIFS).alias("difs")))


def found(diff: DataFrame, name: str) -> DataFrame:
    """tabela, chave, coluna, diferenca: one row a one-sided key, or a differing field of a key. Keys that are no number are kept apart by their text, empty ones by their version."""
    side = F.col("situacao").isin("so_origem", "so_destino")
    each = diff.where(F.col("situacao") != "igual").select(
        "chave",
        "texto_chave",
        F.when(F.col("texto_chave") == "", F.col("versao")).alias("__v"),
        F.when(side, F.col("situacao")).otherwise("valor").alias("diferenca"),
        F.explode(F.when(side, F.array(F.lit(""))).otherwise(F.col("difs.campo"))).alias("coluna"),
    )
    # several versions of a key may differ in the same field
    return each.distinct().select(F.lit(name).alias("tabela"), "chave", "coluna", "diferenca")
