"""Publishing tables: written, read back and compared; staged and swapped; immutable artefacts with content ids."""

from __future__ import annotations

import hashlib
import json
import math
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.catalog import canonical, overlaps


class Files:
    """The few calls on a Hadoop file system that publishing needs."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.gateway, self.conf = spark.sparkContext._jvm, spark.sparkContext._gateway, spark.sparkContext._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(self.conf)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def delete(self, p: str) -> None:
        self.fs.delete(self.path(p), True)

    def rename(self, a: str, b: str) -> None:
        if not self.fs.rename(self.path(a), self.path(b)):
            raise OSError(f"{a} could not be renamed to {b}")

    def replace(self, p: str, text: str) -> None:
        """The file with a new content, in one step: a reader finds the old one or the new one."""
        jvm, new = self.jvm, f"{p}.{uuid.uuid4().hex}"
        self.create(new, text)
        how = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.gateway.new_array(how, 1)
        options[0] = how.OVERWRITE
        path = self.fs.makeQualified(self.path(p))
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.conf).rename(self.fs.makeQualified(self.path(new)), path, options)

    def mkdirs(self, p: str) -> None:
        self.fs.mkdirs(self.path(p))

    def create(self, p: str, text: str) -> None:
        """A new file; raises if it exists."""
        out = self.fs.create(self.path(p), False)
        try:
            out.write(bytearray(text, "utf-8"))
        finally:
            out.close()


def write_checked(df: DataFrame, path: str, partitions: int | None = None) -> int:
    """Written where nothing is, read back and counted: schema and rows must be what went in. The rows are counted on the way, so the plan runs once."""
    from pyspark.sql import Observation

    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("n"))
    (out.coalesce(partitions) if partitions else out).write.mode("errorifexists").parquet(path)
    n = seen.get["n"]
    back = df.sparkSession.read.parquet(path)
    if [(f.name, f.dataType) for f in back.schema] != [(f.name, f.dataType) for f in df.schema]:
        raise ValueError(f"{path}: the schema read back differs")
    if (m := back.count()) != n:
        raise ValueError(f"{path}: {n} rows written, {m} read back")
    return n


def snapshot_partitions(rows: int) -> int:
    return max(1, min(64, math.ceil(rows / 100_000)))


def guard(destination: str, sources: list[str]) -> None:
    """Raises if the destination is, holds or lies in a source."""
    for s in sources:
        if overlaps(destination, s):
            raise ValueError(f"{destination} overlaps {s}")


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], base: str, sources: list[str] = [], require_absent: bool = False) -> dict[str, int]:
    """All tables or none: written beside ``base`` and checked, then swapped in by renaming; what was there before comes back if that fails."""
    guard(base, sources)
    files, mark = Files(spark, base), uuid.uuid4().hex
    stage, old = f"{base}.__staging_{mark}", f"{base}.__previous_{mark}"
    if require_absent and files.exists(base):
        raise FileExistsError(base)
    try:
        counts = {t: write_checked(df, f"{stage}/{t}") for t, df in tables.items()}
        if require_absent and files.exists(base):
            raise FileExistsError(base)
    except BaseException:
        files.delete(stage)
        raise
    _swap(files, stage, base, old)
    return counts


def _swap(files: Files, stage: str, base: str, old: str) -> None:
    """``stage`` in the place of ``base`` by renaming; what was there comes back if that fails, and goes if it doesn't."""
    had = files.exists(base)
    if had:
        files.rename(base, old)
    try:
        files.rename(stage, base)
    except BaseException:
        if had:
            files.rename(old, base)
        raise
    if had:
        files.delete(old)


def replace_table(df: DataFrame, path: str) -> int:
    """One table in place of what lies at ``path``, which ``df`` may be read from: written beside it and checked, then swapped in. Tables beside it are not touched. Returns the rows."""
    files, mark = Files(df.sparkSession, path), uuid.uuid4().hex
    stage = f"{path}.__staging_{mark}"
    try:
        n = write_checked(df, stage)
    except BaseException:
        files.delete(stage)
        raise
    _swap(files, stage, path, f"{path}.__previous_{mark}")
    return n


def artefact(spark: SparkSession, folder: str, kind: str, content: dict) -> str:
    """An immutable JSON file named by its content's id; the same content again is the same file."""
    text = canonical(content)
    key = hashlib.sha256(text.encode()).hexdigest()
    files, path = Files(spark, folder), f"{folder}/{kind}-{key}.json"
    files.mkdirs(folder)
    if not files.exists(path):
        files.create(path, text)
    return path


def read_artefact(spark: SparkSession, path: str) -> dict:
    """The content, if it still has the id in its name."""
    rows = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"{path}: not one record")
    got = json.loads(rows[0][0])
    if hashlib.sha256(canonical(got).encode()).hexdigest() not in path:
        raise ValueError(f"{path}: the content was changed")
    return got


def run_directory(spark: SparkSession, base: str, run: str, tables: Mapping[str, DataFrame]) -> str:
    """A directory for one run that is never written again, and LATEST.json that names it once all is read back."""
    at = f"{base}/{run}"
    counts = publish(spark, tables, at, require_absent=True)
    Files(spark, base).replace(f"{base}/LATEST.json", canonical({"run": run, "rows": counts}))
    return at


def latest(spark: SparkSession, base: str) -> dict:
    """What LATEST.json says: the last whole run and its rows a table."""
    return json.loads(spark.read.text(f"{base}/LATEST.json", wholetext=True).first()[0])


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """One folder a value of ``by``, so that a filter on them reads no other. Rows are sorted within their task: it holds one open file at a time, and a hot value is written by many tasks."""
    df.sortWithinPartitions(*by).write.mode("errorifexists").partitionBy(*by).parquet(path)


def identities(by: list[str], wanted: list[tuple]) -> Column:
    """The condition that a row has one of ``wanted`` (at most 200) in its partition columns, in a form that prunes folders."""
    if len(wanted) > 200:
        raise ValueError("more than 200 identities: join a table of them")
    out = F.lit(False)
    for values in wanted:
        same = F.lit(True)
        for c, v in zip(by, values):
            same = same & (F.col(c) == F.lit(v))
        out = out | same
    return out


def reserve(ledger: list[dict], wanted: Mapping[str, int], floors: Mapping[str, int], step: int = 1) -> list[dict]:
    """The ledger with a new range a name: from beyond its last range and its floor, ``wanted`` keys long. Pure; the caller swaps the ledger file."""
    out = list(ledger)
    for name, n in sorted(wanted.items()):
        last = max((e["end"] for e in out if e["name"] == name), default=0)
        start = max(last + step, floors.get(name, 0) + 1)
        out.append({"name": name, "start": start, "end": start + (n - 1) * step, "step": step})
    return out
