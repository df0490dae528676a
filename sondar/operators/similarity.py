"""Similarity of columns across tables: exact and bottom-k Jaccard of value sets, PSI of distributions.

All measures come from one count of values (table, column, value), combined before its only shuffle of raw rows: sets
are its distinct rows, distributions its weights. Nothing is batched by file or sampled.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .prefix import PART_ROWS, TOP, running
from .scratch import Scratch


@dataclass(frozen=True)
class SimilarityConfig:
    least_values: int = 100
    least_distinct: int = 2
    set_limit: int = 100
    exact_limit: int = 100_000
    sketch: int = 2048
    points: int = 100
    bins: int = 10
    jaccard_match: float = 0.8
    psi_match: float = 0.05


def plans(tables: Mapping[str, DataFrame], excluded: Mapping[str, set[str]] = {}) -> list[tuple[str, str, str, str]]:
    """(table, column, type, family) of every column that can be compared: family text, bool, number, date or time; keys and the like are given in ``excluded``."""
    out = []
    for t, df in sorted(tables.items()):
        for f in df.schema.fields:
            if f.name in excluded.get(t, set()):
                continue
            k = f.dataType
            family = "text" if isinstance(k, T.StringType) else "bool" if isinstance(k, T.BooleanType) else "number" if isinstance(k, T.NumericType) else "date" if isinstance(k, T.DateType) else "time" if isinstance(k, (T.TimestampType, T.TimestampNTZType)) else None
            if family:
                out.append((t, f.name, json.dumps(k.jsonValue(), sort_keys=True), family))
    return out


def _normal(c: Column, family: str) -> tuple[Column, Column, Column]:
    """(value as text, as number, is it invalid): upper(trim) text with blank as NULL; -0 is 0; NaN and infinities are invalid; dates in days, times in microseconds."""
    none = F.lit(None).cast("double")
    if family == "text":
        t = F.upper(F.trim(c))
        return F.when(t != "", t), none, F.lit(False)
    if family == "bool":
        return c.cast("string"), none, F.lit(False)
    if family == "date":
        return F.date_format(c, "yyyy-MM-dd"), F.datediff(c, F.lit("1970-01-01").cast("date")).cast("double"), F.lit(False)
    if family == "time":
        us = F.unix_micros(c.cast("timestamp"))
        return us.cast("string"), us.cast("double"), F.lit(False)
    d = c.cast("double")
    bad = F.isnan(d) | (F.abs(d) == float("inf"))
    fine = F.when(c.isNotNull() & ~bad, c)
    return F.when(fine == 0, "0").otherwise(fine.cast("string")), F.when(fine == 0, 0.0).otherwise(fine.cast("double")), F.coalesce(bad, F.lit(False))


def value_counts(tables: Mapping[str, DataFrame], plan: list[tuple[str, str, str, str]]) -> DataFrame:
    """tabela, coluna, tipo, familia, valor, num, invalido, n: rows by value; NULLs have valor NULL. One scan a table, unpivoted in its stage."""
    parts = []
    for t in sorted({p[0] for p in plan}):
        each = []
        for _, c, kind, family in (p for p in plan if p[0] == t):
            text, num, bad = _normal(F.col(c), family)
            each.append(F.struct(F.lit(c).alias("coluna"), F.lit(kind).alias("tipo"), F.lit(family).alias("familia"), text.alias("valor"), num.alias("num"), bad.alias("invalido")))
        parts.append(tables[t].select(F.lit(t).alias("tabela"), F.inline(F.array(*each))))
    return reduce(DataFrame.unionByName, parts).groupBy("tabela", "coluna", "tipo", "familia", "valor", "num", "invalido").agg(F.count(F.lit(1)).alias("n"))


def profiles(values: DataFrame, config: SimilarityConfig = SimilarityConfig()) -> DataFrame:
    """One row a column: linhas, nulos, invalidos, validos, distintos, and rota: jaccard for text, bool and few numbers, else psi; ``inelegivel`` with too few values."""
    n = F.col("n")
    p = values.groupBy("tabela", "coluna", "tipo", "familia").agg(
        F.sum(n).alias("linhas"),
        F.sum(F.when(F.col("valor").isNull() & ~F.col("invalido"), n).otherwise(0)).alias("nulos"),
        F.sum(F.when(F.col("invalido"), n).otherwise(0)).alias("invalidos"),
        F.sum(F.when(F.col("valor").isNotNull(), n).otherwise(0)).alias("validos"),
        F.count("valor").alias("distintos"),
    )
    few = (F.col("validos") < config.least_values) | (F.col("distintos") < config.least_distinct)
    route = F.when(few, "inelegivel").when(F.col("familia").isin("text", "bool") | ((F.col("familia") == "number") & (F.col("distintos") <= config.set_limit)), "jaccard").otherwise("psi")
    return p.withColumn("rota", route)


def pairs(profiles_: DataFrame) -> DataFrame:
    """Pairs of columns of different tables and one type, each once (table a before b): situacao ok, inelegivel or rotas_diferentes. Metadata only: an equi join on the type."""
    c = ("tabela", "coluna", "rota", "validos", "distintos")
    a = profiles_.select("tipo", *(F.col(x).alias(f"{x}_a") for x in c))
    b = profiles_.select("tipo", *(F.col(x).alias(f"{x}_b") for x in c))
    both = a.join(b, "tipo").where(F.col("tabela_a") < F.col("tabela_b"))
    state = F.when((F.col("rota_a") == "inelegivel") | (F.col("rota_b") == "inelegivel"), "inelegivel").when(F.col("rota_a") != F.col("rota_b"), "rotas_diferentes").otherwise("ok")
    return both.withColumn("situacao", state).withColumn("id", F.sha2(F.to_json(F.array("tabela_a", "coluna_a", "tabela_b", "coluna_b")), 256))


PAIR = ["tabela_a", "coluna_a", "tabela_b", "coluna_b"]


def intersections(values: DataFrame) -> DataFrame:
    """PAIR, comuns: shared values of columns of different tables, by an inverted index: a join on (type, value), where a value meets once a column at most, then counts. No pairs of columns without a shared value come up."""
    v = values.where(F.col("valor").isNotNull()).select("tabela", "coluna", "tipo", "valor").distinct()
    a = v.select("tipo", "valor", F.col("tabela").alias("tabela_a"), F.col("coluna").alias("coluna_a"))
    b = v.select("tipo", "valor", F.col("tabela").alias("tabela_b"), F.col("coluna").alias("coluna_b"))
    return a.join(b, ["tipo", "valor"]).where(F.col("tabela_a") < F.col("tabela_b")).groupBy(*PAIR).agg(F.count(F.lit(1)).alias("comuns"))


def jaccard(values: DataFrame, pairs_: DataFrame, config: SimilarityConfig = SimilarityConfig()) -> DataFrame:
    """PAIR, comuns, jaccard, igual: exact, for pairs of sets of any size."""
    ok = (F.col("situacao") == "ok") & (F.col("rota_a") == "jaccard")
    both = pairs_.where(ok).join(intersections(values), PAIR, "left").withColumn("comuns", F.coalesce("comuns", F.lit(0)))
    j = F.col("comuns") / (F.col("distintos_a") + F.col("distintos_b") - F.col("comuns"))
    return both.select(*PAIR, "comuns", j.alias("jaccard"), (j >= config.jaccard_match).alias("igual"))


def bottom_k(values: DataFrame, k: int) -> DataFrame:
    """tabela, coluna, tipo, valor, h, posto: the ``k`` values of least sha256 of each column; first in 256 parts, then of what these leave, so no column is sorted in one task."""
    v = values.where(F.col("valor").isNotNull()).select("tabela", "coluna", "tipo", "valor").distinct().withColumn("h", F.sha2("valor", 256)).withColumn("__part", F.substring("h", 63, 2))
    part = Window.partitionBy("tabela", "coluna", "__part").orderBy("h", "valor")
    col = Window.partitionBy("tabela", "coluna").orderBy("h", "valor")
    some = v.withColumn("__r", F.row_number().over(part)).where(F.col("__r") <= k).drop("__r", "__part")
    return some.withColumn("posto", F.row_number().over(col)).where(F.col("posto") <= k)


def wilson(hits: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """The 95 % interval of a share."""
    p = hits / n
    mid, half, d = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)), 1 + z * z / n
    return F.greatest((mid - half) / d, F.lit(0.0)), F.least((mid + half) / d, F.lit(1.0))


def sketch_jaccard(values: DataFrame, pairs_: DataFrame, config: SimilarityConfig = SimilarityConfig(), over: int | None = None) -> DataFrame:
    """PAIR, amostra, comuns, jaccard, baixo, alto of pairs with a set beyond ``over`` (exact_limit if None), from the ``sketch`` least hashes of their union."""
    k, over = config.sketch, config.exact_limit if over is None else over
    big = pairs_.where((F.col("situacao") == "ok") & (F.col("rota_a") == "jaccard") & (F.greatest("distintos_a", "distintos_b") > over)).select("tipo", *PAIR)
    s = bottom_k(values, k).select("tabela", "coluna", "h", "valor")
    sides = [big.join(s.select(F.col("tabela").alias(f"tabela_{x}"), F.col("coluna").alias(f"coluna_{x}"), "h", "valor"), [f"tabela_{x}", f"coluna_{x}"]) for x in "ab"]
    union = sides[0].unionByName(sides[1]).groupBy(*PAIR, "h", "valor").agg((F.count(F.lit(1)) == 2).alias("__both"))
    w = Window.partitionBy(*PAIR).orderBy("h", "valor")
    kept = union.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k)
    got = kept.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("amostra"), F.count_if("__both").alias("comuns"))
    low, high = wilson(F.col("comuns"), F.col("amostra"))
    return got.select(*PAIR, "amostra", "comuns", (F.col("comuns") / F.col("amostra")).alias("jaccard"), low.alias("baixo"), high.alias("alto"))


def ranked(values: DataFrame, profiles_: DataFrame, scratch: Scratch) -> DataFrame:
    """tabela, coluna, tipo, num, n, antes, validos of psi columns: every value with how many rows lie before it; exact, by ranges of the column's span."""
    p = profiles_.where(F.col("rota") == "psi").select("tabela", "coluna", "validos", "distintos")
    v = values.where(F.col("num").isNotNull()).groupBy("tabela", "coluna", "tipo", "num").agg(F.sum("n").alias("n")).join(F.broadcast(p), ["tabela", "coluna"])  # a row a column
    span = v.groupBy("tabela", "coluna").agg(F.min("num").alias("__lo"), F.max("num").alias("__hi"))
    v = v.join(F.broadcast(span), ["tabela", "coluna"])  # a row a column
    v = v.withColumn("__o", F.least(F.floor((F.col("num") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * float(TOP - 1)), F.lit(TOP - 1)).cast("bigint"))
    parts = F.ceil(F.col("distintos") / F.lit(PART_ROWS)).cast("bigint")
    return running(v, ["tabela", "coluna"], "__o", ["num"], F.col("n"), parts, scratch, "antes").select("tabela", "coluna", "tipo", "num", "n", "antes", "validos")


def cuts(ranked_: DataFrame, spark: SparkSession, config: SimilarityConfig = SimilarityConfig()) -> DataFrame:
    """tipo, cortes: the inner cut points of each type's bins: nearest-rank points of every column (``points`` each, so that large columns don't outweigh small ones), pooled, their deciles; equal cuts once."""
    q = F.explode(F.sequence(F.lit(1), F.lit(config.points)))
    rank = lambda j, n, of: F.greatest(F.ceil(j * n / of), F.lit(1))
    pts = ranked_.select("tipo", "num", "n", "antes", "validos", q.alias("j")).where((rank(F.col("j"), F.col("validos"), config.points) > F.col("antes")) & (rank(F.col("j"), F.col("validos"), config.points) <= F.col("antes") + F.col("n")))
    # up to ``points`` values a column: small enough to rank within their type
    w = Window.partitionBy("tipo").orderBy("num")
    all_ = pts.select("tipo", "num").withColumn("__r", F.row_number().over(w)).withColumn("__t", F.count(F.lit(1)).over(Window.partitionBy("tipo")))
    j = F.explode(F.sequence(F.lit(1), F.lit(config.bins - 1)))
    picked = all_.select("tipo", "num", "__r", "__t", j.alias("j")).where(F.col("__r") == rank(F.col("j"), F.col("__t"), config.bins))
    return picked.groupBy("tipo").agg(F.array_sort(F.collect_set("num")).alias("cortes"))


def binned(ranked_: DataFrame, cuts_: DataFrame) -> DataFrame:
    """tabela, coluna, tipo, faixa, n on the full grid of bins: the bin of a value is the number of cuts below it."""
    v = ranked_.join(F.broadcast(cuts_), "tipo")  # a row a type
    at = F.size(F.filter("cortes", lambda c: c < F.col("num")))
    got = v.groupBy("tabela", "coluna", "tipo", at.alias("faixa")).agg(F.sum("n").alias("n"))
    grid = v.select("tabela", "coluna", "tipo", "cortes").distinct().select("tabela", "coluna", "tipo", F.explode(F.sequence(F.lit(0), F.size("cortes"))).alias("faixa"))
    return grid.join(got, ["tabela", "coluna", "tipo", "faixa"], "left").select("tabela", "coluna", "tipo", "faixa", F.coalesce("n", F.lit(0)).alias("n"))


def psi(bins: DataFrame, pairs_: DataFrame, config: SimilarityConfig = SimilarityConfig()) -> DataFrame:
    """PAIR, psi, igual: sum of (p - q) ln(p / q) over the bins, each smoothed by half a row."""
    total = Window.partitionBy("tabela", "coluna")
    size = F.count(F.lit(1)).over(total)
    share = bins.withColumn("p", (F.col("n") + 0.5) / (F.sum("n").over(total) + 0.5 * size))
    a, b = ([share.select(F.col("tabela").alias(f"tabela_{x}"), F.col("coluna").alias(f"coluna_{x}"), "faixa", F.col("p").alias(f"p_{x}")) for x in "ab"])
    ok = pairs_.where((F.col("situacao") == "ok") & (F.col("rota_a") == "psi")).select(*PAIR)
    each = ok.join(a, ["tabela_a", "coluna_a"]).join(b, ["tabela_b", "coluna_b", "faixa"])
    got = each.groupBy(*PAIR).agg(F.sum((F.col("p_a") - F.col("p_b")) * F.log(F.col("p_a") / F.col("p_b"))).alias("psi"))
    return got.withColumn("igual", F.col("psi") <= config.psi_match)


def integrity(profiles_: DataFrame, bins: DataFrame) -> DataFrame:
    """tabela, coluna, regra of columns whose counts don't add up: rows = nulls + valid + invalid; distinct <= valid; bins = valid. Empty if all is well."""
    p = profiles_.select("tabela", "coluna", F.explode(F.array(F.when(F.col("linhas") != F.col("nulos") + F.col("validos") + F.col("invalidos"), "linhas"), F.when(F.col("distintos") > F.col("validos"), "distintos"))).alias("regra")).where(F.col("regra").isNotNull())
    b = bins.groupBy("tabela", "coluna").agg(F.sum("n").alias("__n")).join(profiles_, ["tabela", "coluna"]).where(F.col("__n") != F.col("validos")).select("tabela", "coluna", F.lit("faixas").alias("regra"))
    return p.unionByName(b)
