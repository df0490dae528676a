"""References to records that do not exist (problem 3): signed reference and existence counts per key.

Every change is a delta: a referring row adds 1 to its key's references, its exclusion takes 1 away; a target row adds
1 to its key's existence and its exclusion takes 1 away. Keys with positive references and no existence are the current
orphans. A key that exists, but whose first active row came after a referring row, had no existence at that time.
Deltas add up, so a later batch is merged into the state without reading earlier rows again; counts are kept by time
there, so that a retraction restores the first time that is left.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, whole_key
from .scratch import Scratch
from .skew import sized_join

#: Stands for "no known date of inclusion": such a target row always existed.
ALWAYS = "0001-01-01 00:00:00"
STATE = ("__ref", "__key")
COUNTS = ("refs", "active", "ever")


@dataclass(frozen=True)
class Reference:
    """A column that names rows of another table.

    ``excluded`` and ``target_excluded`` are conditions on a row of either table, as SQL; ``born`` columns hold the time
    from which a row counts.
    """

    table: str
    column: str
    row_key: str
    excluded: str
    born: str
    target: str
    target_key: str
    target_excluded: str
    target_born: str


def referring(df: DataFrame, refs: list[Reference]) -> DataFrame:
    """The non-empty references of a table's rows that are not excluded, one row each, in one scan.

    Columns __ref (the reference's name), __row, __key (bigint; NULL if the text is no whole number), __born, __n = 1.
    """
    one = refs[0]
    each = F.array(*(F.struct(F.lit(f"{r.table}.{r.column}").alias("__ref"), filled(F.col(r.column)).alias("__text")) for r in refs))
    return (
        df.where(~F.coalesce(F.expr(one.excluded), F.lit(False)))
        .select(F.col(one.row_key).cast("bigint").alias("__row"), F.col(one.born).alias("__born"), F.explode(each).alias("__e"))
        .select("__row", "__born", "__e.__ref", "__e.__text")
        .where(F.col("__text").isNotNull())
        .select("__ref", "__row", whole_key(F.col("__text")).alias("__key"), "__born")
    )


def _deltas(ref: Column, at: Column, **counts: Column) -> list[Column]:
    """Columns of a delta: __ref, __key, at (the time the row counts from) and the signed counts refs, active, ever."""
    zero = F.lit(0).cast("bigint")
    return [ref.alias("__ref"), F.col("__key"), at.cast("timestamp_ntz").alias("at"), *(counts.get(c, zero).cast("bigint").alias(c) for c in COUNTS)]


def reference_deltas(rows: DataFrame) -> DataFrame:
    """Deltas of referring rows (as of ``referring``): +1 reference for its key."""
    return rows.where(F.col("__key").isNotNull()).select(*_deltas(F.col("__ref"), F.col("__born"), refs=F.lit(1)))


def existence_deltas(df: DataFrame, ref: Reference) -> DataFrame:
    """Deltas of target rows: +1 existence, and -1 again where the row is excluded; ``ever`` counts the rows there were."""
    gone = F.coalesce(F.expr(ref.target_excluded), F.lit(False))
    born = F.coalesce(F.col(ref.target_born).cast("timestamp_ntz"), F.lit(ALWAYS).cast("timestamp_ntz"))
    return df.withColumn("__key", whole_key(F.col(ref.target_key))).where(F.col("__key").isNotNull()).select(*_deltas(F.lit(f"{ref.table}.{ref.column}"), born, active=F.lit(1) - F.when(gone, 1).otherwise(0), ever=F.lit(1)))


def retracted(deltas: DataFrame) -> DataFrame:
    """The deltas that undo ``deltas``: of rows that were deleted, or whose earlier form a change replaces."""
    return deltas.select(*STATE, "at", *((-F.col(c)).alias(c) for c in COUNTS))


def excluded(deltas: DataFrame) -> DataFrame:
    """The deltas of excluding rows that ``deltas`` brought in: no reference and no existence any more, but the rows were there."""
    return deltas.select(*STATE, "at", (-F.col("refs")).alias("refs"), (-F.col("active")).alias("active"), F.lit(0).cast("bigint").alias("ever"))


def merge(*deltas: DataFrame) -> DataFrame:
    """The state after all of ``deltas`` (deltas, or earlier states): signed counts per key and time, so that anything counted can be taken back. One shuffle, combined before it."""
    every = reduce(DataFrame.unionByName, deltas)
    sums = every.groupBy(*STATE, "at").agg(*(F.sum(c).alias(c) for c in COUNTS))
    return sums.where(reduce(lambda x, y: x | y, (F.col(c) != 0 for c in COUNTS)))


def fold(*deltas: DataFrame) -> DataFrame:
    """Counts per key, with the first times of existence and of reference: of a state (as of ``merge``), or straight of deltas without any retraction, as those of a snapshot are. One shuffle, combined before it."""
    every = reduce(DataFrame.unionByName, deltas)
    first = lambda c: F.min(F.when(F.col(c) > 0, F.col("at")))
    return every.groupBy(*STATE).agg(*(F.sum(c).alias(c) for c in COUNTS), first("active").alias("first_active"), first("refs").alias("first_ref"))


def orphan_keys(state: DataFrame) -> DataFrame:
    """Keys with references and no existence, now or at the time of their first reference."""
    return state.where((F.col("refs") > 0) & ((F.col("active") <= 0) | (F.col("first_active") > F.col("first_ref"))))


def situation(born: Column) -> Column:
    """ausente, excluido or posterior of a reference made at ``born``, against its key's state; NULL if the target holds."""
    return F.when(F.coalesce(F.col("ever"), F.lit(0)) == 0, "ausente").when(F.col("active") <= 0, "excluido").when(F.col("first_active") > born, "posterior")


def orphans(tables: dict[str, DataFrame], refs: list[Reference], scratch: Scratch) -> DataFrame:
    """Every reference whose target does not hold: tabela, coluna, chave, situacao, periodo; each once.

    References of excluded rows and empty ones are left out. Text that is no whole number names nothing: ``ausente``. A
    row without a date has periodo NULL and is never ``posterior``; a target row without a date always existed. Repeated
    rows, on either side, change nothing. Referring rows are not shuffled while the orphan keys fit a broadcast;
    otherwise hot keys are salted.
    """
    by_table: dict[str, list[Reference]] = {}
    for r in refs:
        by_table.setdefault(r.table, []).append(r)
    rows = reduce(DataFrame.unionByName, (referring(tables[t], rs) for t, rs in by_table.items()))
    state = fold(reference_deltas(rows), *(existence_deltas(tables[r.target], r) for r in refs))
    bad = orphan_keys(state).select(*STATE, "active", "ever", "first_active")
    hits = sized_join(rows.where(F.col("__key").isNotNull()), bad, list(STATE), "inner", ["__row"], scratch)
    found = hits.select("__ref", "__row", "__born", situation(F.col("__born").cast("timestamp_ntz")).alias("situacao")).where(F.col("situacao").isNotNull())
    no_number = rows.where(F.col("__key").isNull()).select("__ref", "__row", "__born", F.lit("ausente").alias("situacao"))
    at = F.split(F.col("__ref"), r"\.")
    return (
        found.unionByName(no_number)
        .select(at[0].alias("tabela"), at[1].alias("coluna"), F.col("__row").alias("chave"), "situacao", F.date_format("__born", "yyyy-MM").alias("periodo"))
        .distinct()
    )
