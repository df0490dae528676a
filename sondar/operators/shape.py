"""Cardinality shapes: how many rows of each kind a root has, and how these vectors are distributed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


@dataclass(frozen=True)
class Metric:
    """A count of ``rows`` (None: not available) by their root in column ``by``."""

    name: str
    rows: DataFrame | None
    by: str


def counts(universe: DataFrame, root: str, metrics: list[Metric]) -> tuple[DataFrame, list[str]]:
    """One row a root with a column a metric: 0 where a root has no rows, NULL where the metric isn't available; and the names of these.

    All metrics are counted in one shuffle: their rows are stacked with a place each and counted by root and place.
    """
    out = universe.select(root).dropna().distinct()
    there = [m for m in metrics if m.rows is not None]
    skipped = [m.name for m in metrics if m.rows is None]
    if there:
        tall = None
        for m in there:
            part = m.rows.where(F.col(m.by).isNotNull()).select(F.col(m.by).alias(root), F.lit(m.name).alias("__m"))
            tall = part if tall is None else tall.unionByName(part)
        wide = tall.groupBy(root).agg(*(F.count_if(F.col("__m") == m.name).alias(m.name) for m in there))
        out = out.join(wide, root, "left")
    return out.select(root, *((F.coalesce(m.name, F.lit(0)) if m.rows is not None else F.lit(None)).cast("bigint").alias(m.name) for m in metrics)), skipped


def signature(names: list[str]) -> Column:
    """``A=1|B=2``; metrics that aren't available are left out."""
    return F.concat_ws("|", *(F.concat(F.lit(f"{n}="), F.col(n).cast("string")) for n in names))


def distribution(counts_: DataFrame, root: str, names: list[str], sample: int = 5) -> DataFrame:
    """assinatura, n, parte, exemplos: the roots of each shape, and the ``sample`` least of them (kept by rank before they are gathered)."""
    from pyspark.sql.window import Window

    sig = counts_.select(root, signature(names).alias("assinatura"))
    n = Scratch(counts_.sparkSession, "shape").keep(sig.groupBy("assinatura").agg(F.count(F.lit(1)).alias("n")))
    total = n.agg(F.sum("n")).first()[0]
    few = sig.withColumn("__r", F.row_number().over(Window.partitionBy("assinatura").orderBy(root))).where(F.col("__r") <= sample)
    ex = few.groupBy("assinatura").agg(F.concat_ws(",", F.sort_array(F.collect_list(root)).cast("array<string>")).alias("exemplos"))
    return n.join(ex, "assinatura").select("assinatura", "n", (F.col("n") / F.lit(total)).alias("parte"), "exemplos")


def marginals(counts_: DataFrame, names: list[str]) -> DataFrame:
    """metrica, faixa (0 to 4, 5+, ausente), n: of all metrics in one pass."""
    bucket = lambda c: F.when(F.col(c).isNull(), "ausente").when(F.col(c) >= 5, "5+").otherwise(F.col(c).cast("string"))
    return counts_.select(F.explode(F.array(*(F.struct(F.lit(c).alias("metrica"), bucket(c).alias("faixa")) for c in names))).alias("x")).groupBy("x.metrica", "x.faixa").agg(F.count(F.lit(1)).alias("n"))


def reference_match(counts_: DataFrame, want: dict[str, int]) -> DataFrame:
    """metrica, esperado, iguais, parte: how many roots have the expected count."""
    one = counts_.agg(F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(c) == v).alias(f"c{i}") for i, (c, v) in enumerate(want.items())))
    return one.select(F.inline(F.array(*(F.struct(F.lit(c).alias("metrica"), F.lit(v).alias("esperado"), F.col(f"c{i}").alias("iguais"), F.coalesce(F.try_divide(F.col(f"c{i}"), F.col("n")), F.lit(0.0)).alias("parte")) for i, (c, v) in enumerate(want.items())))))


def compare(a: DataFrame, b: DataFrame) -> DataFrame:
    """assinatura, situacao (so_aqui, so_la, ambos), parte_aqui, parte_la, deriva of two distributions."""
    x, y = a.select("assinatura", F.col("parte").alias("__a")), b.select("assinatura", F.col("parte").alias("__b"))
    zero = F.lit(0.0)
    return x.join(y, "assinatura", "full").select("assinatura", F.when(F.col("__b").isNull(), "so_aqui").when(F.col("__a").isNull(), "so_la").otherwise("ambos").alias("situacao"), F.coalesce("__a", zero).alias("parte_aqui"), F.coalesce("__b", zero).alias("parte_la"), (F.coalesce("__b", zero) - F.coalesce("__a", zero)).alias("deriva"))


def total_variation(compared: DataFrame) -> DataFrame:
    """distancia: half the sum of absolute drifts."""
    return compared.agg((F.sum(F.abs("deriva")) / 2).alias("distancia"))


def top_values(df: DataFrame, column: str, n: int = 50) -> DataFrame:
    """The ``n`` most frequent values with their counts, ties by value: a report."""
    return df.groupBy(F.col(column).alias("valor")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "valor").limit(n)


def fingerprint(keys: DataFrame, key: str) -> DataFrame:
    """n, impressao: a fingerprint of a set of keys that needs no order and no gathering: sums of two halves of each key's sha256."""
    k = keys.select(F.sha2(F.col(key).cast("string"), 256).alias("h")).where(F.col("h").isNotNull()).distinct()
    part = lambda i: F.sum(F.conv(F.substring("h", i, 12), 16, 10).cast("decimal(38,0)")).cast("string")
    return k.agg(F.count(F.lit(1)).alias("n"), F.sha2(F.concat_ws("|", F.coalesce(part(1), F.lit("0")), F.coalesce(part(13), F.lit("0"))), 256).alias("impressao"))
