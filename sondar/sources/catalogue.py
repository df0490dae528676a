"""SQL catalogues: named sections of one text, run over temporary views."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

BEGIN, END = re.compile(r"^--\s*BEGIN QUERY:\s*(\S+)\s*$"), re.compile(r"^--\s*END QUERY:\s*(\S+)\s*$")


def sections(text: str, source: str = "catalogue") -> dict[str, str]:
    """The named sections of a catalogue. A name twice, a section in another, or one without an end or a query raises."""
    out: dict[str, str] = {}
    name, lines = None, []
    for line in text.splitlines():
        if m := BEGIN.match(line.strip()):
            if name or m[1] in out:
                raise ValueError(f"{source}: section {m[1]} begins twice or inside {name}")
            name, lines = m[1], []
        elif m := END.match(line.strip()):
            if name != m[1]:
                raise ValueError(f"{source}: {m[1]} ends, but {name} is open")
            out[name], name = "\n".join(lines).strip().rstrip(";"), None
        elif name:
            lines.append(line)
    if name:
        raise ValueError(f"{source}: section {name} has no end")
    return out


def section(text: str, name: str, source: str = "catalogue") -> str:
    """One section; unknown or empty (but for comments) raises."""
    got = sections(text, source)
    if name not in got:
        raise ValueError(f"{source}: no section {name}")
    if not re.sub(r"--[^\n]*", "", got[name]).strip():
        raise ValueError(f"{source}: section {name} is empty")
    return got[name]


def run(spark: SparkSession, sql: str, frames: Mapping[str, DataFrame]) -> DataFrame:
    """The query over ``frames``: each ``{{RAW_NAME}}`` or ``{name}`` stands for its frame, bound as an argument, not as text."""
    text = re.sub(r"\{\{RAW_(\w+)\}\}", lambda m: "{" + m[1].lower() + "}", sql)
    used = {n.lower(): df for n, df in frames.items() if "{" + n.lower() + "}" in text}
    return spark.sql(text, **used)


def keys_only(df: DataFrame, name: str) -> DataFrame:
    """The contract of a domain query: one column of that name, distinct, without NULL."""
    if [c.upper() for c in df.columns] != [name.upper()]:
        raise ValueError(f"the query must give {name} alone, not {df.columns}")
    return df.toDF(name).dropna().distinct()
