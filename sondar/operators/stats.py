"""Descriptive statistics in single passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def beside(*frames: DataFrame) -> DataFrame:
    """Frames of one row each as one row with all their columns: stacked, then the one value of each column is taken. No cross join."""
    columns = [c for df in frames for c in df.columns]
    tall = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return tall.agg(*(F.max(c).alias(c) for c in columns))


def summary(df: DataFrame, columns: list[str], percentiles: tuple[float, ...] = ()) -> DataFrame:
    """coluna, n, nulos, minimo, maximo, media, desvio, and p<q> of approximate percentiles; NaN counts as NULL. One scan."""
    num = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(columns):
        v = num[c]
        aggs += [F.count_if(v.isNull()).alias(f"z{i}"), F.min(v).alias(f"a{i}"), F.max(v).alias(f"b{i}"), F.avg(v).alias(f"m{i}"), F.stddev(v).alias(f"s{i}"), *(F.percentile_approx(v, q).alias(f"p{i}_{j}") for j, q in enumerate(percentiles))]
    each = F.array(*(F.struct(F.lit(c).alias("coluna"), F.col("n"), F.col(f"z{i}").alias("nulos"), F.col(f"a{i}").alias("minimo"), F.col(f"b{i}").alias("maximo"), F.col(f"m{i}").alias("media"), F.col(f"s{i}").alias("desvio"), *(F.col(f"p{i}_{j}").alias(f"p{q:g}") for j, q in enumerate(percentiles))) for i, c in enumerate(columns)))
    return df.agg(*aggs).select(F.inline(each))


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """faixa, de, ate, n of equal bins from low to high (the last closed), empty ones too; values outside and NULLs are in none."""
    width = (high - low) / bins
    v = F.col(column).cast("double")
    at = F.least(F.floor((v - low) / width), F.lit(bins - 1)).cast("int")
    counts = df.where((v >= low) & (v <= high)).groupBy(at.alias("faixa")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("faixa"))
    return grid.join(F.broadcast(counts), "faixa", "left").select("faixa", (F.col("faixa") * width + low).alias("de"), ((F.col("faixa") + 1) * width + low).alias("ate"), F.coalesce("n", F.lit(0)).alias("n"))  # as many rows as bins


def coverage(a: DataFrame, b: DataFrame, columns: list[str]) -> DataFrame:
    """coluna, cobertura: the share of a's range (0 to 1) that b's range covers; a single value of a is covered wholly or not at all, and without values it is NULL. NaN counts as NULL."""
    def ends(df: DataFrame, side: str) -> DataFrame:
        v = [F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns]
        return df.agg(*(x for i, c in enumerate(v) for x in (F.min(c).alias(f"{side}lo{i}"), F.max(c).alias(f"{side}hi{i}"))))

    one = beside(ends(a, "a"), ends(b, "b"))
    point = lambda i: F.when(F.col(f"alo{i}") == F.col(f"ahi{i}"), F.col(f"alo{i}").between(F.col(f"blo{i}"), F.col(f"bhi{i}")).cast("double"))
    range_ = lambda i: F.try_divide(F.greatest(F.least(F.col(f"ahi{i}"), F.col(f"bhi{i}")) - F.greatest(F.col(f"alo{i}"), F.col(f"blo{i}")), F.lit(0.0)), F.col(f"ahi{i}") - F.col(f"alo{i}"))
    part = lambda i: F.coalesce(point(i), range_(i))
    return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("coluna"), part(i).alias("cobertura")) for i, c in enumerate(columns)))))


def null_rates(df: DataFrame) -> DataFrame:
    """coluna, nulos, parte of every column, in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)))
    return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("coluna"), F.col(f"c{i}").alias("nulos"), F.coalesce(F.try_divide(F.col(f"c{i}"), F.col("n")), F.lit(0.0)).alias("parte")) for i, c in enumerate(df.columns)))))


def counts(frames: dict[str, DataFrame]) -> DataFrame:
    """tabela, n of many frames in one action."""
    return reduce(DataFrame.unionByName, (df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("tabela"), "n") for t, df in frames.items()))
