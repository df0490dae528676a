"""Cloning keyed rows K times: dense ordinals give new keys without a map of K rows a key; references follow."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import effective_null
from .prefix import ordinal
from .scratch import Scratch
from .skew import sized_join

K = "__k"


def next_start(top: int | None, band: int = 0, floor: int = 0) -> int:
    """The first new key: above the highest real one plus a band, and above a floor."""
    return max((top or 0) + band, floor) + 1


def key_map(df: DataFrame, pk: str) -> DataFrame:
    """old, ordinal: the place of each key in the order of the keys, from 0. One row a key; its clones' keys follow by arithmetic, so the map doesn't grow with the factor."""
    return ordinal(df.select(F.col(pk).alias("old")).dropna().distinct(), ["old"], "ordinal", 0)


def new_key(ordinal_: Column, k: Column, factor: int, start: int, step: int = 1) -> Column:
    """The key of clone ``k`` (1..factor) of the row in place ``ordinal_``."""
    return F.lit(start) + (ordinal_ * F.lit(factor) + k - 1) * F.lit(step)


def expand_map(mapping: DataFrame, factor: int, start: int, step: int = 1) -> DataFrame:
    """old, k, new: the map written out."""
    return mapping.select("old", F.explode(F.sequence(F.lit(1), F.lit(factor))).alias("k"), "ordinal").select("old", "k", new_key(F.col("ordinal"), F.col("k"), factor, start, step).alias("new"))


def multiply(df: DataFrame, factor: int) -> DataFrame:
    """Every row ``factor`` times, with __k from 1: in the row's own task, no join."""
    return df.withColumn(K, F.explode(F.sequence(F.lit(1), F.lit(factor))))


def clone_root(df: DataFrame, pk: str, mapping: DataFrame, factor: int, start: int, scratch: Scratch, step: int = 1) -> DataFrame:
    """Clones of a table with numbers of its own; type and order of columns stay. The map is joined before rows are multiplied."""
    both = sized_join(df, mapping.select(F.col("old").alias(pk), F.col("ordinal").alias("__ordinal")), [pk], "inner", [pk], scratch)
    out = multiply(both, factor).withColumn(pk, new_key(F.col("__ordinal"), F.col(K), factor, start, step).cast(df.schema[pk].dataType))
    return out.select(*df.columns, K)


def remap(clones: DataFrame, column: str, mapping: DataFrame, factor: int, start: int, scratch: Scratch, spread: list[str], step: int = 1) -> DataFrame:
    """A reference to a cloned parent follows to the clone with the same k if the parent is in the batch, else stays as it is (NULL too)."""
    kind = clones.schema[column].dataType
    both = sized_join(clones, mapping.select(F.col("old").alias(column), F.col("ordinal").alias("__ordinal")), [column], "left", spread, scratch)
    return both.withColumn(column, F.coalesce(new_key(F.col("__ordinal"), F.col(K), factor, start, step), F.col(column)).cast(kind)).select(*clones.columns)


def shift(df: DataFrame, columns: list[str], offset: int) -> DataFrame:
    """Key columns moved by an offset; NULL stays NULL and an overflow of the type raises."""
    return df.withColumns({c: (F.col(c) + F.lit(offset)).cast(df.schema[c].dataType) for c in columns})


def null_out(df: DataFrame, columns: list[str], not_null: set[str] = frozenset()) -> DataFrame:
    """Columns set to NULL of their type, but for those that may not be NULL."""
    return df.withColumns({c: F.lit(None).cast(df.schema[c].dataType) for c in columns if c in df.columns and c not in not_null})


def null_where_listed(df: DataFrame, column: str, keys: DataFrame, normal, scratch: Scratch) -> DataFrame:
    """A column set to NULL where its value, in a normal form, is among ``keys`` (valor, in that form)."""
    marked = sized_join(df.withColumn("__v", normal(F.col(column))), keys.select(F.col("valor").alias("__v")).distinct().withColumn("__hit", F.lit(True)), ["__v"], "left", df.columns[:1], scratch)
    return marked.withColumn(column, F.when(F.coalesce("__hit", F.lit(False)), F.lit(None).cast(df.schema[column].dataType)).otherwise(F.col(column))).select(*df.columns)


def guard_new(df: DataFrame, existing: DataFrame, pk: str) -> DataFrame:
    """Rows whose key the target doesn't hold yet; target keys are read within the batch's own range only."""
    low, high = df.agg(F.min(pk), F.max(pk)).first()
    if low is None:
        return df
    return df.join(existing.where(F.col(pk).between(low, high)).select(pk).distinct(), pk, "left_anti")


# --- codes and control numbers --------------------------------------------------------------------------------------


def placeholder(ordinal_: Column, prefix: str) -> Column:
    """prefix + the ordinal in base 36, five signs."""
    return F.concat(F.lit(prefix), F.lpad(F.upper(F.conv(ordinal_.cast("string"), 10, 36)), 5, "0"))


def operation_code(ordinal_: Column) -> Column:
    """Sixteen digits."""
    return F.lpad(ordinal_.cast("string"), 16, "0")


def control_numbers(df: DataFrame, key: str, side1: str, side2: str, prefix: str, start: int = 1) -> DataFrame:
    """key, lado, ordinal, numero: one number for each side of an operation; two ordinals where both sides name the same account (NULL equals NULL), else one for both. Seven digits after the prefix; more raise."""
    same = F.col(side1).eqNullSafe(F.col(side2))
    slots = df.select(key, F.explode(F.when(same, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("vaga"), same.alias("__same"))
    numbered = ordinal(slots, [key, "vaga"], "ordinal", start)
    sides = F.when(F.col("__same"), F.array("vaga")).otherwise(F.array(F.lit(1), F.lit(2)))
    number = F.when(F.col("ordinal") > 9_999_999, F.raise_error(F.lit("more than 9,999,999 control numbers"))).otherwise(F.concat(F.lit(prefix), F.lpad(F.col("ordinal").cast("string"), 7, "0")))
    return numbered.select(key, F.explode(sides).alias("lado"), "ordinal", number.alias("numero"))


def propagate(child: DataFrame, parent: DataFrame, on: str, column: str, scratch: Scratch, spread: list[str]) -> DataFrame:
    """The parent's code in the child, where the parent has one (one row a key: the least code if there are several)."""
    codes = parent.where(~effective_null(parent, column)).groupBy(on).agg(F.min(column).alias("__code"))
    return sized_join(child, codes, [on], "left", spread, scratch).withColumn(column, F.coalesce("__code", F.col(column))).select(*child.columns)


def tuples_met(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """Control tuples of ``a`` that ``b`` holds too; incomplete tuples meet nothing."""
    return a.select(*columns).dropna().distinct().join(b.select(*columns).dropna().distinct(), columns, "left_semi")


