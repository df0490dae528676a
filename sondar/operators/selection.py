"""Choosing keys: pages in the order of a hash, domains minus exclusions, keys that are missing, admission against a target."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.catalog import ClonePlan, TableSpec
from .closure import ROOT, closure
from .keys import norm_key
from .scratch import Scratch
from .skew import salted_join


def rank_hash(key: Column, seed: str) -> Column:
    """The order in which keys are offered: sha256(seed:key), the same on any layout."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def page(keys: DataFrame, key: str, seed: str, size: int, after: tuple[str, object] | None = None) -> DataFrame:
    """The next ``size`` keys after a cursor (hash, key), with posto: their hash. Taken as a top-k, not a full sort."""
    ranked = keys.select(key).dropna().distinct().withColumn("posto", rank_hash(F.col(key), seed))
    if after is not None:
        ranked = ranked.where((F.col("posto") > after[0]) | ((F.col("posto") == after[0]) & (F.col(key) > after[1])))
    return ranked.orderBy("posto", key).limit(size)


def domain(roots: DataFrame, key: str, have: list[DataFrame], lack: list[DataFrame] = []) -> DataFrame:
    """Distinct keys that every frame of ``have`` holds and none of ``lack``: semi and anti joins on the key."""
    out = roots.select(key).dropna().distinct()
    for df in have:
        out = out.join(df.select(key), key, "left_semi")
    if lack:
        out = out.join(reduce(DataFrame.unionByName, (df.select(key) for df in lack)), key, "left_anti")
    return out


def missing_keys(child: DataFrame, column: str, existing: DataFrame, existing_column: str, table: str) -> DataFrame:
    """TABELA, COLUNA, VALOR: distinct referenced keys, in normal form, that no existing key equals; empty ones name nothing."""
    ref = child.select(norm_key(F.col(column)).alias("VALOR")).where(F.coalesce(F.col("VALOR"), F.lit("")) != "").distinct()
    there = existing.select(norm_key(F.col(existing_column)).alias("VALOR"))
    return ref.join(there, "VALOR", "left_anti").select(F.lit(table).alias("TABELA"), F.lit(column).alias("COLUNA"), "VALOR")


def merge_missing(old: DataFrame, new: DataFrame, replaced: list[tuple[str, str]]) -> DataFrame:
    """``new`` in place of the listed (table, column) pairs of ``old``; all other rows of ``old`` stay."""
    gone = reduce(lambda a, b: a | b, ((F.col("TABELA") == t) & (F.col("COLUNA") == c) for t, c in replaced), F.lit(False))
    return old.where(~gone).unionByName(new).distinct()


def rejected(provenance: DataFrame, refs: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """__root, fk: roots with a row whose reference resolves neither to a parent of the same root nor in the target.

    ``refs``: for each foreign key, (child references: __root, key; parents cloned with the roots: __root, key; target
    keys: key), keys as text in one form. All by joins: no set is held on the driver.
    """
    parts = []
    for name, (child, own, target) in refs.items():
        open_ = child.where(F.coalesce(F.col("key"), F.lit("")) != "").select("__root", "key").distinct().join(own.select("__root", "key"), ["__root", "key"], "left_anti")
        parts.append(open_.join(target.select("key"), "key", "left_anti").select("__root", F.lit(name).alias("fk")).distinct())
    bad = reduce(DataFrame.unionByName, parts)
    return bad.join(provenance.select("__root").distinct(), "__root", "left_semi")


def choose(candidates: DataFrame, key: str, n: int, seed: str, reject, scratch: Scratch, explicit: bool = False) -> DataFrame:
    """``n`` admissible keys: pages of candidates in hash order, rejected ones refilled from the next page.

    ``reject``: keys -> frame of those that can't be admitted. An explicit list is taken whole or not at all: nothing is
    put in place of a rejected key. Too few candidates raise.
    """
    if explicit:
        bad = reject(candidates)
        if not bad.isEmpty():
            raise ValueError(f"keys of the list are rejected, e.g. {[r[0] for r in bad.select(key).limit(5).collect()]}")
        return candidates
    got, have, after = None, 0, None
    while have < n:
        want = n - have + max(100, (n - have) // 10)
        offer = scratch.keep(page(candidates, key, seed, want, after))
        last = offer.orderBy(F.desc("posto"), F.desc(key)).first()
        if last is None:
            raise ValueError(f"{have} of {n} keys can be admitted")
        after = (last["posto"], last[key])
        fine = offer.join(reject(offer.select(key)).select(key), key, "left_anti")
        got = scratch.keep(fine if got is None else got.unionByName(fine))
        have = got.count()
    return got.orderBy("posto", key).limit(n).select(key)


def admission(tables: Mapping[str, DataFrame], plans: Mapping[str, ClonePlan], specs: Mapping[str, TableSpec], root: str, target: Mapping[str, DataFrame], scratch: Scratch):
    """The ``reject`` of ``choose`` for cloning into a target: keys -> those whose closure has a row that refers to nothing.

    The closure of the offered roots is built; every foreign key of its rows must name a row cloned with the same root, or
    a row of ``target`` (key frames of the parents that are there, by table; one that is missing there has no rows). NULL
    in any part of a reference names nothing and is fine.
    """
    key = plans[root].pk[0]

    def text(cols) -> Column:
        parts = [norm_key(F.col(c)) for c in cols]
        return F.when(reduce(lambda a, b: a & b, (p.isNotNull() for p in parts)), F.concat_ws("|", *parts)).alias("key")

    def reject(offer: DataFrame) -> DataFrame:
        prov = closure(tables, plans, root, offer, scratch)
        refs = {}
        for t, p in plans.items():
            cols = list(dict.fromkeys([*p.pk, *(c for fk in specs[t].fks for c in fk.columns)]))
            rows = salted_join(tables[t].select(*cols), prov[t].select(*p.pk, ROOT), list(p.pk), "inner", cols) if t != root else tables[t].select(*cols).join(prov[t], list(p.pk))
            for fk in specs[t].fks:
                own = prov[fk.parent].select(ROOT, text(fk.parent_columns)) if fk.parent in prov else offer.sparkSession.createDataFrame([], f"{ROOT} {dict(offer.dtypes)[offer.columns[0]]}, key string")
                there = target[fk.parent].select(text(fk.parent_columns)) if fk.parent in target else offer.sparkSession.createDataFrame([], "key string")
                refs[f"{t}.{','.join(fk.columns)}"] = (rows.select(ROOT, text(fk.columns)), own, there)
        return rejected(prov[root], refs).select(F.col(ROOT).alias(key)).distinct()

    return reject


def source_filters(df: DataFrame, equal: Mapping[str, object] = {}, above: Mapping[str, object] = {}, null: tuple[str, ...] = ()) -> tuple[DataFrame, list[str]]:
    """The rows that fulfil all filters, and a note for each filter whose column the table lacks, which is passed over."""
    have = {c.upper(): c for c in df.columns}
    notes = []
    for columns, make in ((equal, lambda c, v: F.col(c) == F.lit(v)), (above, lambda c, v: F.col(c) > F.lit(v)), (dict.fromkeys(null), lambda c, _: F.col(c).isNull())):
        for c, v in columns.items():
            if c.upper() in have:
                df = df.where(make(have[c.upper()], v))
            else:
                notes.append(f"{c}: no such column, filter passed over")
    return df, notes


def bernoulli(df: DataFrame, key: str, share: float, seed: str) -> DataFrame:
    """Each key with probability ``share``, by a hash of it in place of a random number: the same on any run and layout."""
    return df.where(F.substring(rank_hash(F.col(key), seed), 1, 13) < F.lit(format(int(share * 16**13), "013x")))
