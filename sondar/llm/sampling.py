"""Reproducible sample that stays stable as data grows (problem 2): stratified thresholds on a salted key hash.

A key is chosen if its hash lies below its threshold. The hash depends on salt and key alone, so neither layout nor
order of the rows matters. Each stratum has a fixed rate, hence a fixed threshold, and a key has the highest threshold
of the strata it was ever seen in: rows added later, of whatever load, can only raise it. A table of earlier thresholds
can only be raised too (by a higher rate), never lowered. So what was chosen once stays chosen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scratch import Scratch
from ..operators.skew import sized_join

#: Hex digits of the hash that are used: 52 bits.
DIGITS = 13


def threshold(rate: float) -> str:
    """The share as a bound of hashes: those below it are chosen."""
    return "g" if rate >= 1 else format(int(rate * 16**DIGITS), f"0{DIGITS}x")


@dataclass(frozen=True)
class SampleConfig:
    """rate: share of the keys of every stratum; rates: other shares for single strata."""

    rate: float = 0.10
    rates: tuple[tuple[str, float], ...] = ()
    salt: str = "amostra-1"


def key_hash(key: Column, salt: str) -> Column:
    """The first 13 hex digits of sha256(salt:key): even over all keys, the same everywhere."""
    return F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), key.cast("string")), 256), 1, DIGITS)


def bounded(rows: DataFrame, config: SampleConfig, previous: DataFrame | None, scratch: Scratch | None) -> DataFrame:
    """``rows`` (chave, estrato, ..) with limiar: the stratum's fixed threshold, or the one in ``previous`` (estrato, limiar) where that is higher."""
    fixed = F.lit(threshold(config.rate))
    if config.rates:  # a parameter: a row a stratum named in it
        rates = rows.sparkSession.createDataFrame([(s, threshold(r)) for s, r in dict(config.rates).items()], "estrato string, __fixed string")
        rows = rows.join(F.broadcast(rates), "estrato", "left")
        fixed = F.coalesce("__fixed", fixed)
    rows = rows.withColumn("limiar", fixed).drop("__fixed")
    if previous is None:
        return rows
    old = previous.groupBy("estrato").agg(F.max("limiar").alias("__old"))
    return sized_join(rows, old, ["estrato"], "left", ["chave"], scratch).withColumn("limiar", F.greatest("limiar", "__old")).drop("__old")


def _rows(df: DataFrame, key: str, stratum: str, load: str, config: SampleConfig, previous: DataFrame | None, scratch: Scratch | None) -> DataFrame:
    """chave, estrato, carga, limiar, h of every row with a key. NULL keys name nothing; a NULL stratum is the stratum ''; a NULL load counts as the last of all."""
    rows = df.where(F.col(key).isNotNull()).select(F.col(key).alias("chave"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("estrato"), F.coalesce(F.col(load).cast("int"), F.lit(2**31 - 1)).alias("carga"))
    return bounded(rows, config, previous, scratch).withColumn("h", key_hash(F.col("chave"), config.salt))


def _keyed(rows: DataFrame) -> DataFrame:
    """One row a key: chave, estrato, carga (first load of the rows), limiar, h. The stratum is that of the highest threshold; of several such, that of the first load; of several such, the last by name. Repeated rows are combined before the shuffle."""
    best = F.max(F.struct("limiar", (-F.col("carga")).alias("c"), "estrato")).alias("__b")
    return rows.groupBy("chave", "h").agg(best, F.min("carga").alias("carga")).select("chave", "__b.estrato", "carga", "__b.limiar", "h")


def stable_sample(df: DataFrame, key: str, stratum: str, load: str, config: SampleConfig, previous: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    """chave, estrato, carga, h, limiar of the chosen keys. Empty in, empty out.

    A key is chosen if any of its rows lies below that row's threshold, which is to say below the highest; rows that
    don't are left out before the shuffle. carga is the first load with a row that chooses the key, estrato the stratum
    with the highest threshold. Equal hashes of different keys (one in 2**52) are chosen together.
    """
    rows = _rows(df, key, stratum, load, config, previous, scratch)
    return _keyed(rows.where(F.col("h") < F.col("limiar"))).select("chave", "estrato", "carga", "h", "limiar")


def thresholds(df: DataFrame, key: str, stratum: str, load: str, config: SampleConfig, previous: DataFrame | None = None, scratch: Scratch | None = None) -> DataFrame:
    """estrato, limiar, chaves, escolhidas: the state to hand to the next run, with what it chooses of the keys so far."""
    keys = _keyed(_rows(df, key, stratum, load, config, previous, scratch))
    return keys.groupBy("estrato", "limiar").agg(F.count(F.lit(1)).alias("chaves"), F.count_if(F.col("h") < F.col("limiar")).alias("escolhidas"))
