"""Joins that survive a key holding a third of all rows, and broadcasts behind a check of size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch

#: A side may be broadcast up to so many rows, and so many bytes as written (unpacked, some tens of MB).
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 8_000_000
#: A key is hot from so many rows on; below that one task takes them with ease.
HOT_ROWS = 1_000_000
#: So many of the hottest keys are salted: any other key has less than one in so many of the rows.
HOT_KEYS = 256
#: Parts into which a hot key's rows are spread.
SALTS = 64


def hot_keys(df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> list[tuple]:
    """The keys of at least ``hot_rows`` rows, the ``HOT_KEYS`` hottest of them: so few that they may go to the driver.

    Rows are counted with map-side combine; NULL keys are no keys. A key beyond the list has less than 1 / HOT_KEYS of
    the rows, which adaptive execution can still split.
    """
    counts = df.select(*on).where(" and ".join(f"`{c}` is not null" for c in on)).groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
    some = counts.where(F.col("__n") >= hot_rows).orderBy(F.desc("__n"), *on).limit(HOT_KEYS).collect()
    return [tuple(r[c] for c in on) for r in some]


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str, spread: list[str], hot: list[tuple] | None = None) -> DataFrame:
    """``left`` join ``right`` where ``right`` has one row a key and ``left`` may be skewed. how: inner, left, left_semi or left_anti.

    Rows of hot keys, and rows whose key is NULL, are spread over ``SALTS`` parts by a hash of ``spread`` (columns of
    ``left``); the hot rows of ``right`` are repeated once a part. Nothing is repeated where no key is hot.
    """
    if hot is None:
        hot = hot_keys(left, on)

    def is_hot() -> Column:
        if len(on) == 1:
            return F.coalesce(F.col(on[0]).isin([k for (k,) in hot]), F.lit(False)) if hot else F.lit(False)
        out = F.lit(False)
        for key in hot:
            same = F.lit(True)
            for c, v in zip(on, key):
                same = same & (F.col(c) == F.lit(v))
            out = out | same
        return out

    part = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")
    null_key = F.lit(False)
    for c in on:
        null_key = null_key | F.col(c).isNull()
    l2 = left.withColumn("__salt", F.when(null_key | is_hot(), part).otherwise(F.lit(0)))
    if hot:
        r2 = right.withColumn("__salt", F.explode(F.when(is_hot(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))))
    else:
        r2 = right.withColumn("__salt", F.lit(0))
    return l2.join(r2, [*on, "__salt"], how).drop("__salt")


def sized_join(left: DataFrame, right: DataFrame, on: list[str], how: str, spread: list[str], scratch: Scratch, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``left`` join ``right`` (one row a key): ``right`` is written and counted, then broadcast if it has up to ``rows`` rows and ``BROADCAST_BYTES`` bytes, else joined with salted hot keys."""
    right, n, _ = scratch.counted(right)
    if n <= rows and scratch.bytes(right) <= BROADCAST_BYTES:
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, how, spread)
