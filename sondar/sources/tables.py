"""Parquet tables of one folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The table ``name`` of the folder ``base``: ``{base}/{name}.parquet``, a file or a folder of files."""
    return spark.read.parquet(f"{base}/{name}.parquet")


def optional_table(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """The table, or None if its path does not exist. Any other failure (rights, broken files) is raised."""
    try:
        return table(spark, base, name)
    except AnalysisException as e:
        if (e.getCondition() or "").startswith("PATH_NOT_FOUND"):
            return None
        raise


def tables(spark: SparkSession, base: str, names: list[str]) -> dict[str, DataFrame]:
    """Those of ``names`` that exist."""
    return {n: df for n in names if (df := optional_table(spark, base, n)) is not None}
