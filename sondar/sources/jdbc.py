"""Reads of relational sources in parallel partitions. Planning is pure; reading goes through Spark's JDBC source."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Source:
    """url, table and the driver's properties (user, password, driver...)."""

    url: str
    table: str
    properties: dict[str, str]


def subquery(sql: str) -> str:
    return f"({sql}) t"


def read_query(spark: SparkSession, s: Source, sql: str) -> DataFrame:
    """One query in one partition: dictionary look-ups and scalars."""
    return spark.read.format("jdbc").options(url=s.url, dbtable=subquery(sql), **s.properties).load()


def first_value(spark: SparkSession, s: Source, sql: str):
    row = read_query(spark, s, sql).first()
    return row[0] if row else None


def limited(table: str, n: int) -> str:
    return subquery(f"SELECT * FROM {table} FETCH FIRST {n} ROWS ONLY")


def date_predicates(column: str, low: dt.date | None, high: dt.date | None, n: int) -> list[str]:
    """``n`` half-open ranges that hold every row once: the first takes NULLs and all below, the last all above. ``1=1`` without a range."""
    if low is None or high is None or low >= high or n < 2:
        return ["1=1"]
    edges = [low + (high - low) * i // n for i in range(1, n)]
    edges = sorted(set(edges) - {low})
    text = [f"DATE '{e:%Y-%m-%d}'" for e in edges]
    if not text:
        return ["1=1"]
    mid = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(text, text[1:])]
    return [f"{column} < {text[0]} OR {column} IS NULL", *mid, f"{column} >= {text[-1]}"]


def in_lists(column: str, keys: Iterable, size: int = 900) -> list[str]:
    """IN predicates of up to ``size`` quoted keys each, for small rests only; larger sets are read and joined."""
    text = sorted({"'" + str(k).replace("'", "''") + "'" for k in keys})
    return [f"{column} IN ({','.join(text[i : i + size])})" for i in range(0, len(text), size)]


ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"  # of extended row ids (fixed value)


def row_id(object_id: int, file: int, block: int, row: int) -> str:
    """The extended row id of a place: object (6 signs), file (3), block (6), row (3), base 64."""
    def digits(n: int, width: int) -> str:
        out = ""
        for _ in range(width):
            n, r = divmod(n, 64)
            out = ALPHABET[r] + out
        return out

    return digits(object_id, 6) + digits(file, 3) + digits(block, 6) + digits(row, 3)


def extent_ranges(extents: list[tuple[int, int, int]], n: int) -> list[list[tuple[int, int, int]]]:
    """About ``n`` groups of (file, first block, last block) of like size: extents in order, cut where a group is full."""
    total = sum(blocks for _, _, blocks in extents)
    if not total:
        return []
    want = max(1, -(-total // max(1, n)))
    out, room = [[]], want
    for file, start, blocks in sorted(extents):
        while blocks:
            if not room:
                out.append([])
                room = want
            take = min(blocks, room)
            out[-1].append((file, start, start + take - 1))
            start, blocks, room = start + take, blocks - take, room - take
    return out


def row_id_predicates(object_id: int, extents: list[tuple[int, int, int]], n: int) -> list[str]:
    """Predicates over ranges of row ids that together hold every block of the extents once."""
    one = lambda f, a, b: f"ROWID BETWEEN CHARTOROWID('{row_id(object_id, f, a, 0)}') AND CHARTOROWID('{row_id(object_id, f, b, 32767)}')"
    return [" OR ".join(f"({one(*r)})" for r in group) for group in extent_ranges(extents, n)]


def numeric_options(column: str, low: int | None, high: int | None, n: int) -> dict[str, str]:
    """Spark's own numeric partitioning, or nothing if there is no range."""
    if low is None or high is None or low == high or n < 2:
        return {}
    return {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(n)}


def between(table: str, columns: list[str], pk: str, low: int, high: int) -> str:
    """Keys of a batch's own range."""
    return subquery(f"SELECT {', '.join(columns)} FROM {table} WHERE {pk} BETWEEN {int(low)} AND {int(high)}")


def read(spark: SparkSession, s: Source, *, limit: int | None = None, column: str | None = None, kind: str = "number", bounds: tuple | None = None, rows: list[str] | None = None, n: int = 32) -> DataFrame:
    """A table in the best partitions there are: one if limited; ranges of a named numeric or date column; else row id ranges; else one."""
    if limit is not None:
        return spark.read.format("jdbc").options(url=s.url, dbtable=limited(s.table, limit), **s.properties).load()
    if column and kind == "date" and bounds:
        return spark.read.jdbc(s.url, s.table, predicates=date_predicates(column, *bounds, n), properties=s.properties)
    if column and bounds and (opts := numeric_options(column, *bounds, n)):
        return spark.read.format("jdbc").options(url=s.url, dbtable=s.table, **opts, **s.properties).load()
    if rows:
        return spark.read.jdbc(s.url, s.table, predicates=rows, properties=s.properties)
    return spark.read.format("jdbc").options(url=s.url, dbtable=s.table, **s.properties).load()


def append(df: DataFrame, s: Source, batch: int = 10_000) -> None:
    """Rows appended; each partition commits once, so a task that runs again repeats its rows: load into a staging table and merge where that matters."""
    df.write.format("jdbc").mode("append").options(url=s.url, dbtable=s.table, batchsize=str(batch), isolationLevel="READ_COMMITTED", **s.properties).save()


def insert_sql(table: str, columns: list[str], computed: dict[str, str]) -> str:
    """An INSERT with one place a column, but for those that the database computes (clock, user)."""
    given = [c for c in columns if c not in computed]
    return f"INSERT INTO {table} ({', '.join([*given, *computed])}) VALUES ({', '.join(['?'] * len(given) + list(computed.values()))})"


def append_computed(df: DataFrame, connect, table: str, computed: dict[str, str], batch: int = 10_000) -> None:
    """Like ``append`` with database-side expressions. ``connect`` makes a DB-API connection in the task; one commit a partition, rolled back on any error."""
    columns = df.columns
    sql = insert_sql(table, columns, computed)
    given = [i for i, c in enumerate(columns) if c not in computed]

    def put(rows) -> None:
        con = connect()
        try:
            cur, some = con.cursor(), []
            for r in rows:
                some.append(tuple(r[i] for i in given))
                if len(some) == batch:
                    cur.executemany(sql, some)
                    some = []
            if some:
                cur.executemany(sql, some)
            con.commit()
        except BaseException:
            con.rollback()
            raise
        finally:
            con.close()

    df.foreachPartition(put)


def delete_above(table: str, pk: str, above: int, top: int, chunk: int = 100_000) -> list[str]:
    """Statements that delete the keys above a mark up to ``top``, a chunk each; nothing beyond what was loaded."""
    return [f"DELETE FROM {table} WHERE {pk} > {a} AND {pk} <= {min(a + chunk, top)}" for a in range(above, top, chunk)]
