"""Tables written to cut lineage: in the shared folder that the session names, never on one machine of a cluster."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_LEFT: list[tuple[SparkSession, str]] = []


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset (tests, one machine) a temporary folder, set once."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        own = spark.sparkContext.getCheckpointDir()
        if own is None:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sondar-"))
            own = spark.sparkContext.getCheckpointDir()
        at = own
    return at.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Written intermediate tables of one operator call.

    ``keep`` writes a frame and reads it back, so that the plan behind it is neither run twice nor carried along; a
    lost executor loses nothing. ``drop`` deletes a table nobody reads any more. What is left goes at the end of the
    interpreter.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.at, self.n = spark, f"{folder(spark)}/sondar-{name}-{uuid.uuid4().hex}", 0
        self.paths: dict[int, str] = {}
        _LEFT.append((spark, self.at))

    def keep(self, df: DataFrame) -> DataFrame:
        return self.counted(df)[0]

    def counted(self, df: DataFrame, hits: Column | None = None) -> tuple[DataFrame, int, int]:
        """The kept frame, its rows, and how many of them fulfil ``hits``: counted while they are written."""
        self.n += 1
        path = f"{self.at}/{self.n}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.lit(False) if hits is None else hits).alias("hits")).write.mode("errorifexists").parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        return out, seen.get["rows"], seen.get["hits"]

    def bytes(self, df: DataFrame) -> int:
        """Bytes that a kept frame takes in its folder (columns packed and compressed)."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.paths[id(df)])
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(p).getLength()

    def drop(self, *frames: DataFrame) -> None:
        for df in frames:
            if path := self.paths.pop(id(df), None):
                _delete(self.spark, path)


@atexit.register
def _sweep() -> None:
    for spark, at in _LEFT:
        try:
            _delete(spark, at)
        except Exception:  # noqa: BLE001, S110 - the session may be gone already
            pass
