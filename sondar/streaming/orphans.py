"""Orphan references kept up to date from streams of change deltas: the fold of problem 3, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.references import fold, merge, orphan_keys


def current(spark: SparkSession, state: str) -> DataFrame | None:
    """The state after the last whole batch, or None before the first. The pointer is the highest batch that was marked whole."""
    from ..sources.publish import Files

    files = Files(spark, state)
    if not files.exists(state):
        return None
    marks = [p.getPath().getName() for p in files.fs.listStatus(files.path(state))]
    done = [int(m.removeprefix("done-")) for m in marks if m.startswith("done-")]
    return spark.read.parquet(f"{state}/batch-{max(done)}") if done else None


def apply_batch(batch: DataFrame, number: int, state: str) -> None:
    """Merges a batch of deltas into the state: batch ``number`` is written from the one before it. Run again, it writes the same.

    States before the last whole one are deleted, so that two are kept at most.
    """
    from ..sources.publish import Files

    spark = batch.sparkSession
    files = Files(spark, state)
    if files.exists(f"{state}/done-{number}"):
        return
    old = current(spark, state)
    files.delete(f"{state}/batch-{number}")
    (merge(batch) if old is None else merge(old, batch)).write.parquet(f"{state}/batch-{number}")
    files.create(f"{state}/done-{number}", "")
    names = [p.getPath().getName() for p in files.fs.listStatus(files.path(state))]
    done = sorted(int(n.removeprefix("done-")) for n in names if n.startswith("done-"))
    for n in names:
        if n.startswith("batch-") and int(n.removeprefix("batch-")) not in done[-2:]:
            files.delete(f"{state}/{n}")


def orphans_now(spark: SparkSession, state: str) -> DataFrame | None:
    """The keys that are referred to and don't exist, now or at the time of their first reference."""
    df = current(spark, state)
    return None if df is None else orphan_keys(fold(df))


def maintain(deltas: DataFrame, state: str, checkpoint: str) -> StreamingQuery:
    """A streaming query over a stream of deltas (columns as of ``reference_deltas``) that keeps the state; a batch that runs again after a failure counts once."""
    return deltas.writeStream.foreachBatch(lambda df, n: apply_batch(df, n, state)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
