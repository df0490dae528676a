"""Referential closures: the rows that belong to a set of roots, with their provenance, and sampling along references."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.catalog import ClonePlan, TableSpec, waves
from .checks import orphans
from .scratch import Scratch
from .skew import salted_join, sized_join

ROOT = "__root"


def closure(tables: Mapping[str, DataFrame], plans: Mapping[str, ClonePlan], root: str, roots: DataFrame, scratch: Scratch, passes: int = 10) -> dict[str, DataFrame]:
    """The provenance of every table: (key columns, __root) pairs of all rows that reach a root by principal links.

    ``roots``: the root's key column. A row belongs to each root of each parent it names by a principal link; other
    links pull no rows. Tables are taken parents first, so a graph without circles needs one pass; with circles it goes on
    until no pair is new, and raises after ``passes``. A table that nothing reaches is empty. Child rows may be skewed on
    their parent: hot parents are salted.
    """
    key = plans[root].pk
    order = waves({t: {k.fk.parent for k in p.links if k.principal} for t, p in plans.items()})
    prov = {root: scratch.keep(roots.select(*key).dropna().distinct().select(*key, F.col(key[0]).alias(ROOT)))}
    sizes = {root: prov[root].count()}
    for _ in range(passes):
        before = dict(sizes)
        for t in order:
            p = plans[t]
            parts = [prov[t]] if t in prov else []
            for k in p.links:
                if k.principal and k.fk.parent in prov:
                    up = prov[k.fk.parent].select(*(F.col(b).alias(a) for a, b in zip(k.fk.columns, k.fk.parent_columns)), ROOT)
                    cols = list(dict.fromkeys([*p.pk, *k.fk.columns]))
                    parts.append(salted_join(tables[t].select(*cols).dropna(subset=list(k.fk.columns)), up, list(k.fk.columns), "inner", list(p.pk)).select(*p.pk, ROOT))
            if parts:
                new = scratch.keep(reduce(DataFrame.unionByName, parts).distinct())
                if t in prov:
                    scratch.drop(prov[t])
                prov[t], sizes[t] = new, new.count()
        # pairs are only ever added, so equal counts are equal sets
        if sizes == before or not any(k.fk.parent in order[i:] for i, t in enumerate(order) for k in plans[t].links if k.principal):
            break
    else:
        raise RuntimeError(f"no fixed point after {passes} passes")
    empty = {t: tables[t].select(*plans[t].pk, F.lit(None).cast("bigint").alias(ROOT)).limit(0) for t in plans if t not in prov}
    return prov | empty


def rows_of(df: DataFrame, provenance: DataFrame, pk) -> DataFrame:
    """The rows of a table that are in its provenance."""
    return df.join(provenance.select(*pk).distinct(), list(pk), "left_semi")


def downsample(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], kept: dict[str, DataFrame], scratch: Scratch) -> dict[str, DataFrame]:
    """Rows whose every reference is kept or wholly NULL, parents first: ``kept`` gives the tables to start from."""
    out = dict(kept)
    for t in waves({t: {fk.parent for fk in s.fks} for t, s in specs.items()}):
        if t in out:
            continue
        df = tables[t]
        for k in specs[t].fks:
            if k.parent not in out:
                continue
            up = out[k.parent].select(*(F.col(b).alias(a) for a, b in zip(k.columns, k.parent_columns))).dropna().distinct().withColumn("__hit", F.lit(True))
            none = reduce(lambda a, b: a & b, (F.col(c).isNull() for c in k.columns))
            df = sized_join(df, up, list(k.columns), "left", df.columns[:1], scratch).where(F.col("__hit") | none).drop("__hit").select(*tables[t].columns)
        out[t] = df
    return out


def upclosure(tables: Mapping[str, DataFrame], specs: Mapping[str, TableSpec], some: Mapping[str, DataFrame], scratch: Scratch, passes: int = 10) -> dict[str, DataFrame]:
    """``some`` rows with every parent they name, their parents and so on, until none is missing. Parents that exist nowhere stay missing."""
    out = dict(some)
    for _ in range(passes):
        grown = False
        for t in reversed(waves({t: {fk.parent for fk in s.fks} for t, s in specs.items()})):
            for k in specs[t].fks if t in out else ():
                if k.parent not in tables:
                    continue
                have = out.get(k.parent, tables[k.parent].limit(0))
                missing = orphans(out[t], [have], k.columns, k.parent_columns).select(*(F.col(a).alias(b) for a, b in zip(k.columns, k.parent_columns)))
                more = scratch.keep(tables[k.parent].join(missing, list(k.parent_columns), "left_semi"))
                if not more.isEmpty():
                    out[k.parent], grown = scratch.keep(have.unionByName(more)), True
        if not grown:
            return out
    raise RuntimeError(f"no fixed point after {passes} passes")


def frontier(start: DataFrame, edges: DataFrame, hops: int, scratch: Scratch) -> DataFrame:
    """root, id, hop: what is reached from each (root, id) in up to ``hops`` steps along edges (id, next); the first hop counts. A circle adds nothing."""
    seen = scratch.keep(start.select("root", "id").distinct().withColumn("hop", F.lit(0)))
    last = seen
    for h in range(1, hops + 1):
        step = last.select("root", "id").join(edges.select("id", "next"), "id").select("root", F.col("next").alias("id")).distinct()
        last = scratch.keep(step.join(seen, ["root", "id"], "left_anti").withColumn("hop", F.lit(h)))
        if last.isEmpty():
            break
        seen = scratch.keep(seen.unionByName(last))
    return seen


