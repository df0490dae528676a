"""What is checked before rows are loaded into a target, and how a load is undone."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import checks
from .keys import effective_null
from .stats import beside


@dataclass(frozen=True)
class Target:
    """A column of the target: octets of text, precision and scale of numbers, whether NULL is allowed."""

    octets: int | None = None
    precision: int | None = None
    scale: int = 0
    nullable: bool = True


def column_rules(df: DataFrame, target: Mapping[str, Target]) -> dict[tuple[str, str], Column]:
    """Row conditions that the target would refuse: numbers beyond (10^p - 1) / 10^s, more octets than the column has, NULL where none may be."""
    out: dict[tuple[str, str], Column] = {}
    for c in df.columns:
        t = target.get(c)
        if t is None:
            continue
        if t.precision:
            out["capacidade", c] = F.abs(F.col(c)) > F.lit(checks.capacity(t.precision, t.scale)).cast("decimal(38,10)")
        if t.octets:
            out["octetos", c] = F.octet_length(F.col(c)) > t.octets
        if not t.nullable:
            out["nulo", c] = F.col(c).isNull()
    return out


def preflight(df: DataFrame, table: str, target: Mapping[str, Target], unique: list[list[str]] = [], existing: Mapping[str, DataFrame] = {}, static: Mapping[tuple[str, ...], tuple[DataFrame, tuple[str, ...]]] = {}) -> DataFrame:
    """tabela, verificacao, colunas, violacoes of a load: column alignment, all column rules in one scan, keys repeated inside and met in the target, rows whose static parent is missing.

    ``existing``: frames of target keys by comma-joined key; ``static``: parents by child columns. Rows with a NULL part
    in a key are in no uniqueness or reference check.
    """
    spark = df.sparkSession
    off = checks.alignment(df.columns, list(target), [c for c, t in target.items() if not t.nullable])
    parts = [spark.createDataFrame([(table, "alinhamento", kind, len(names)) for kind, names in off.items()], checks.FINDING), checks.count_checks(df, table, column_rules(df, target))]
    for cols in unique:
        parts.append(checks.unique(df, table, cols))
        if ",".join(cols) in existing:
            parts.append(checks.pk_collision(df, existing[",".join(cols)], table, cols).withColumn("verificacao", F.lit("ja_no_destino")))
    parts += [checks.fk(df, [parent], table, cols, pcols, distinct=False).withColumn("verificacao", F.lit("pai_estatico")) for cols, (parent, pcols) in static.items()]
    return reduce(DataFrame.unionByName, parts)


def business_keys(roots: DataFrame, root_key: str, code: str, pattern: str, children: DataFrame, child_code: str, tuple_columns: list[str]) -> DataFrame:
    """regra, violacoes: codes against their pattern, codes of several roots, incomplete control tuples, complete ones that repeat, children whose code isn't their root's.

    ``children`` name their root by ``root_key``; a child of no root is not compared.
    """
    codes = roots.where(~effective_null(roots, code))
    one = codes.groupBy(root_key).agg(F.min(code).alias("__code"))
    some = reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in tuple_columns))
    every = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in tuple_columns))
    n = F.count(F.lit(1)).alias("violacoes")
    rules = {
        "formato": codes.where(~F.col(code).rlike(pattern)).agg(n),
        "codigo_repetido": codes.select(code, root_key).distinct().groupBy(code).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").agg(n),
        "tupla_incompleta": children.where(some & ~every).agg(n),
        "tupla_repetida": checks.duplicates(children, tuple_columns, True).agg(n),
        "codigo_da_raiz": children.join(one, root_key).where(~F.col(child_code).eqNullSafe(F.col("__code"))).agg(n),
    }
    return reduce(DataFrame.unionByName, (df.select(F.lit(r).alias("regra"), "violacoes") for r, df in rules.items()))


def without_child(roots: DataFrame, key: str, children: DataFrame) -> DataFrame:
    """Roots that lack a row they must have."""
    return roots.select(key).dropna().distinct().join(children.select(key), key, "left_anti")


def shift_report(frames: Mapping[str, tuple[DataFrame, str]], offset: int, capacity: Mapping[str, int]) -> DataFrame:
    """tabela, menor, maior, novo_menor, novo_maior, estouro, colide of a uniform key shift: does it leave the column's capacity, or move keys into the range there is."""
    parts = []
    for t, (df, pk) in frames.items():
        one = df.agg(F.min(pk).cast("bigint").alias("menor"), F.max(pk).cast("bigint").alias("maior"))
        low, high = F.col("menor") + offset, F.col("maior") + offset
        parts.append(one.select(F.lit(t).alias("tabela"), "menor", "maior", low.alias("novo_menor"), high.alias("novo_maior"), F.coalesce(high > capacity.get(t, 2**63 - 1), F.lit(False)).alias("estouro"), F.coalesce((low <= F.col("maior")) & (high >= F.col("menor")), F.lit(False)).alias("colide")))
    return reduce(DataFrame.unionByName, parts)


def ordinal_consistency(df: DataFrame, ordinal: str, key: str, code: str, pattern: str, start: int) -> DataFrame:
    """regra, violacoes of a code map: ordinals dense from ``start``, keys and codes distinct, codes of the pattern. Distinct counts are aggregated one by one."""
    n = df.agg(F.count(F.lit(1)).alias("n"), F.min(ordinal).alias("a"), F.max(ordinal).alias("b"), F.count_if(~F.coalesce(F.col(code).rlike(pattern), F.lit(False))).alias("bad"))
    d = beside(n, *(df.select(c).distinct().agg(F.count(c).alias(f"d{i}")) for i, c in enumerate((ordinal, key, code))))
    gaps = F.when(F.col("n") == 0, 0).otherwise(F.abs(F.col("a") - start) + F.abs(F.col("b") - (F.lit(start) + F.col("n") - 1)))
    rules = [("ordinal_denso", gaps + F.col("n") - F.col("d0")), ("chave_repetida", F.col("n") - F.col("d1")), ("codigo_repetido", F.col("n") - F.col("d2")), ("formato", F.col("bad"))]
    return d.select(F.inline(F.array(*(F.struct(F.lit(r).alias("regra"), v.cast("bigint").alias("violacoes")) for r, v in rules))))


def single_value(df: DataFrame, column: str):
    """The one value of a column; none or several raise. Two values are enough to know."""
    got = [r[0] for r in df.select(column).dropna().distinct().limit(2).collect()]
    if len(got) != 1:
        raise ValueError(f"{column}: not one value, e.g. {got}")
    return got[0]


def load_marks(frames: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """tabela, coluna, maximo: the highest key of each table before a load, in one action; NULL if it is empty."""
    return reduce(DataFrame.unionByName, (df.agg(F.max(pk).cast("bigint").alias("maximo")).select(F.lit(t).alias("tabela"), F.lit(pk).alias("coluna"), "maximo") for t, (df, pk) in frames.items()))


def roll_back(df: DataFrame, pk: str, mark: int | None, top: int | None = None) -> DataFrame:
    """The rows from before a load: keys up to the mark, and beyond ``top`` (others' later rows) if that is given. No mark: the table was empty."""
    old = F.lit(False) if mark is None else F.col(pk) <= mark
    return df.where(F.col(pk).isNull() | old | (F.lit(False) if top is None else F.col(pk) > top))


def explain_key(key: str, stages: Mapping[str, tuple[DataFrame, str]], normal) -> DataFrame:
    """etapa, linhas, exemplo: how many rows of each stage hold a key, in a normal form, in the order of the stages."""
    parts = [df.where(normal(F.col(c)) == key).agg(F.count(F.lit(1)).alias("linhas"), F.min(F.col(c).cast("string")).alias("exemplo")).select(F.lit(f"{i}:{name}").alias("etapa"), "linhas", "exemplo") for i, (name, (df, c)) in enumerate(stages.items())]
    return reduce(DataFrame.unionByName, parts)
