"""Constraint checks as one pass a table: conditional counts for column rules, grouped counts for keys, anti joins for references."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.catalog import TableSchema, TableSpec
from .stats import beside

FINDING = "tabela string, verificacao string, colunas string, violacoes bigint"


def _all_null_free(cols: list[str] | tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in cols))


def column_checks(df: DataFrame, not_null: list[str], decimals: Mapping[str, tuple[int, int]], texts: Mapping[str, int]) -> dict[tuple[str, str], Column]:
    """The row conditions that break a column's rule: NULL where none may be, |v| >= 10^(p-s), more characters than allowed. Columns that the table lacks are left out."""
    have = {c.upper(): c for c in df.columns}
    out = {("not_null", c): F.col(have[c.upper()]).isNull() for c in not_null if c.upper() in have}
    out |= {("decimal_domain", c): F.abs(F.col(have[c.upper()])) >= F.lit(Decimal(10) ** (p - s) if p - s < 38 else 1e38) for c, (p, s) in decimals.items() if c.upper() in have}
    return out | {("varchar_domain", c): F.length(have[c.upper()]) > n for c, n in texts.items() if c.upper() in have}


def count_checks(df: DataFrame, table: str, checks: Mapping[tuple[str, str], Column]) -> DataFrame:
    """Findings of all row conditions in one scan and one aggregation (NULL conditions don't count)."""
    if not checks:
        return df.sparkSession.createDataFrame([], FINDING)
    names = list(checks)
    one = df.agg(*(F.count_if(checks[k]).alias(f"c{i}") for i, k in enumerate(names)))
    each = F.array(*(F.struct(F.lit(table).alias("tabela"), F.lit(kind).alias("verificacao"), F.lit(col).alias("colunas"), F.col(f"c{i}").alias("violacoes")) for i, (kind, col) in enumerate(names)))
    return one.select(F.inline(each))


def _finding(n: DataFrame, table: str, kind: str, cols) -> DataFrame:
    return n.select(F.lit(table).alias("tabela"), F.lit(kind).alias("verificacao"), F.lit(",".join(cols)).alias("colunas"), F.col("n").alias("violacoes"))


def duplicates(df: DataFrame, cols, skip_null: bool) -> DataFrame:
    """Groups of equal keys: cols, n > 1. skip_null: rows with any NULL part are in no group (UNIQUE), else NULLs are equal (primary keys)."""
    rows = df.where(_all_null_free(cols)) if skip_null else df
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def pk_unique(df: DataFrame, table: str, pk) -> DataFrame:
    return _finding(duplicates(df, list(pk), False).agg(F.count(F.lit(1)).alias("n")), table, "pk_unique", pk)


def unique(df: DataFrame, table: str, cols) -> DataFrame:
    return _finding(duplicates(df, list(cols), True).agg(F.count(F.lit(1)).alias("n")), table, "unique", cols)


def pk_collision(df: DataFrame, other: DataFrame, table: str, pk) -> DataFrame:
    """Distinct keys that both frames hold."""
    both = df.select(*pk).dropna().distinct().join(other.select(*pk).dropna().distinct(), list(pk), "inner")
    return _finding(both.agg(F.count(F.lit(1)).alias("n")), table, "pk_collision", pk)


def orphans(child: DataFrame, parents: list[DataFrame], cols, parent_cols, distinct: bool = True) -> DataFrame:
    """Child keys (distinct tuples, or each row) without a parent in any of ``parents``; a key with a NULL part is not checked."""
    up = reduce(DataFrame.unionByName, (p.select(*(F.col(b).alias(a) for a, b in zip(cols, parent_cols))) for p in parents)).distinct()
    keys = child.select(*cols).dropna()
    return (keys.distinct() if distinct else keys).join(up, list(cols), "left_anti")


def fk(child: DataFrame, parents: list[DataFrame], table: str, cols, parent_cols, distinct: bool = True) -> DataFrame:
    return _finding(orphans(child, parents, cols, parent_cols, distinct).agg(F.count(F.lit(1)).alias("n")), table, "fk", cols)


def validate(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], schemas: Mapping[str, TableSchema], others: Mapping[str, DataFrame] = {}) -> DataFrame:
    """Findings of every check that specs and schemas ask for; ``others`` are frames of the same tables whose keys count as parents and must not be met by new keys.

    A reference whose parent table is nowhere is reported with violacoes NULL: it can't be verified.
    """
    parts = []
    for t, s in specs.items():
        if t not in tables:
            continue
        df, sch = tables[t], schemas.get(t, TableSchema())
        must = sorted({*s.not_null, *s.pk, *(c for c, r in sch.columns.items() if not r.nullable)})
        parts.append(count_checks(df, t, column_checks(df, must, {c: (r.precision, r.scale) for c, r in sch.columns.items() if r.precision}, {c: r.length for c, r in sch.columns.items() if r.length})))
        if s.pk:
            parts.append(pk_unique(df, t, s.pk))
            if t in others:
                parts.append(pk_collision(df, others[t], t, s.pk))
        parts += [unique(df, t, u) for u in sch.unique]
        for k in s.fks:
            parents = [x[k.parent] for x in (tables, others) if k.parent in x]
            if parents:
                parts.append(fk(df, parents, t, k.columns, k.parent_columns))
            else:
                parts.append(df.sparkSession.createDataFrame([(t, "fk", ",".join(k.columns), None)], FINDING))
    return reduce(DataFrame.unionByName, parts)


def sample(df: DataFrame, broken: Column, cols: list[str], n: int = 10) -> DataFrame:
    """Up to ``n`` rows that break a rule, the first by their columns: for reports."""
    return df.where(broken).select(*cols).orderBy(*cols).limit(n)


def one_pass_profile(df: DataFrame, keys: list[list[str]] = []) -> DataFrame:
    """One row a column: total, nulls, min and max as text, max octets; with it, distinct and NULL-free counts of ``keys``, each in a count of its own (several in one would expand every row)."""
    total = F.count(F.lit(1))
    aggs = [total.alias("total")]
    for c in df.columns:
        aggs += [F.count_if(F.col(c).isNull()).alias(f"n_{c}"), F.min(c).cast("string").alias(f"a_{c}"), F.max(c).cast("string").alias(f"b_{c}"), F.max(F.octet_length(F.col(c).cast("string"))).alias(f"o_{c}")]
    one = df.agg(*aggs)
    each = F.array(*(F.struct(F.lit(c).alias("coluna"), F.col("total"), F.col(f"n_{c}").alias("nulos"), F.col(f"a_{c}").alias("minimo"), F.col(f"b_{c}").alias("maximo"), F.col(f"o_{c}").alias("octetos")) for c in df.columns))
    out = one.select(F.inline(each)).withColumn("distintos", F.lit(None).cast("bigint"))
    for k in keys:
        d = df.where(_all_null_free(k)).select(*k).distinct().agg(F.count(F.lit(1)).alias("d"))
        n = df.agg(total.alias("total"), F.count_if(~_all_null_free(k)).alias("nulos"))
        out = out.unionByName(beside(n, d).select(F.lit("+".join(k)).alias("coluna"), "total", "nulos", F.lit(None).cast("string").alias("minimo"), F.lit(None).cast("string").alias("maximo"), F.lit(None).cast("int").alias("octetos"), F.col("d").alias("distintos")))
    return out


def alignment(columns: list[str], target: list[str], required: list[str]) -> dict[str, list[str]]:
    """Columns the target doesn't know, and required ones that are missing, without regard to case."""
    have, want = {c.upper() for c in columns}, {c.upper() for c in target}
    return {"desconhecidas": sorted(have - want), "ausentes": sorted({c.upper() for c in required} - have)}


def capacity(precision: int, scale: int) -> str:
    """The largest number of a NUMBER(p, s), as text."""
    from decimal import Decimal, localcontext

    with localcontext() as c:
        c.prec = 80
        return str((Decimal(10) ** precision - 1) / (Decimal(10) ** scale))


def classify_orphans(child: DataFrame, cols, parent: DataFrame, parent_cols, source_parent: DataFrame) -> DataFrame:
    """Orphans against ``parent``, with origem: ``processo`` if the source had the parent (it was lost on the way), else ``producao``."""
    lost = orphans(child, [parent], cols, parent_cols)
    src = source_parent.select(*(F.col(b).alias(a) for a, b in zip(cols, parent_cols))).dropna().distinct().withColumn("__there", F.lit(True))
    return lost.join(src, list(cols), "left").withColumn("origem", F.when(F.col("__there"), "processo").otherwise("producao")).drop("__there")


def clone_report(source: DataFrame, clones: DataFrame, pk: str, factor: int, start: int, not_null: list[str]) -> DataFrame:
    """regra, esperado, obtido of a clone: rows = source x factor, distinct keys, least key, NULLs where none may be."""
    n = source.agg((F.count(F.lit(1)) * factor).alias("n"))
    nulls = F.count_if(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in not_null))) if not_null else F.lit(0)
    got = clones.agg(F.count(F.lit(1)).alias("rows"), F.min(pk).cast("bigint").alias("least"), nulls.cast("bigint").alias("nulls"))
    distinct = clones.select(pk).distinct().agg(F.count(F.lit(1)).alias("keys"))
    one = beside(n, got, distinct)
    rows = [("linhas", F.col("n"), F.col("rows")), ("chaves_distintas", F.col("n"), F.col("keys")), ("menor_chave", F.lit(start).cast("bigint"), F.col("least")), ("nulos", F.lit(0).cast("bigint"), F.col("nulls"))]
    return one.select(F.inline(F.array(*(F.struct(F.lit(r).alias("regra"), a.cast("bigint").alias("esperado"), b.cast("bigint").alias("obtido")) for r, a, b in rows))))


def report(findings: DataFrame) -> tuple[dict, str, int]:
    """The findings (a row a check: as many as specs and schemas ask for) as a document, as text, and the exit code: 1 if any rule is broken. What can't be verified is counted apart and breaks nothing."""
    rows = [r.asDict() for r in findings.orderBy("tabela", "verificacao", "colunas").collect()]
    broken = [r for r in rows if r["violacoes"]]
    unknown = [r for r in rows if r["violacoes"] is None]
    doc = {"verificacoes": len(rows), "violadas": len(broken), "nao_verificaveis": len(unknown), "achados": rows}
    lines = [f"{len(rows)} checks, {len(broken)} broken, {len(unknown)} not verifiable"]
    lines += [f"  {r['tabela']} {r['verificacao']} ({r['colunas']}): {'not verifiable' if r['violacoes'] is None else r['violacoes']}" for r in broken + unknown]
    return doc, "\n".join(lines), int(bool(broken))
