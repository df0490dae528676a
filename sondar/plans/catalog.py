"""The catalogue of keyed tables and the planning on it: pure functions on the driver, over metadata only."""

from __future__ import annotations

import csv
import io
import json
import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    name: str
    pk: tuple[str, ...] = ()
    fks: tuple[ForeignKey, ...] = ()
    static: bool = False
    not_null: tuple[str, ...] = ()


@dataclass(frozen=True)
class ColumnRule:
    """Declared type of a column: precision and scale of numbers, length of text in characters, whether NULL is allowed."""

    nullable: bool = True
    precision: int | None = None
    scale: int = 0
    length: int | None = None


@dataclass(frozen=True)
class TableSchema:
    columns: Mapping[str, ColumnRule] = field(default_factory=dict)
    unique: tuple[tuple[str, ...], ...] = ()


def bare(name: str) -> str:
    """A table's name without its owner, in upper case."""
    return name.strip().rpartition(".")[2].upper()


def normalise(raw: Mapping[str, Mapping]) -> dict[str, TableSpec]:
    """Specs from plain dicts: names without owner and in upper case, ``fks`` for ``foreign_keys``, foreign keys to the very same columns of the own table dropped. Two names that become one raise."""
    out: dict[str, TableSpec] = {}
    for name, cfg in raw.items():
        own = bare(name)
        if own in out:
            raise ValueError(f"two specs for table {own}")
        fks = []
        for fk in cfg.get("foreign_keys") or cfg.get("fks") or []:
            k = ForeignKey(tuple(c.upper() for c in fk["columns"]), bare(fk["parent_table"]), tuple(c.upper() for c in fk["parent_columns"]))
            if len(k.columns) != len(k.parent_columns):
                raise ValueError(f"{own}: foreign key {k.columns} does not fit {k.parent_columns}")
            if not (k.parent == own and k.columns == k.parent_columns):
                fks.append(k)
        out[own] = TableSpec(own, tuple(c.upper() for c in cfg.get("pk_cols") or ()), tuple(fks), bool(cfg.get("static")), tuple(c.upper() for c in cfg.get("not_null_cols") or ()))
    return out


def waves(needs: Mapping[str, Iterable[str]]) -> list[str]:
    """Names with what they need first. A circle is opened at the name with the fewest open needs, then the first by name."""
    left = {n: {d for d in ds if d in needs and d != n} for n, ds in needs.items()}
    out: list[str] = []
    while left:
        free = sorted(n for n, ds in left.items() if not ds)
        take = free or [min(left, key=lambda n: (len(left[n]), n))]
        out += take
        for n in take:
            del left[n]
        for ds in left.values():
            ds.difference_update(take)
    return out


def load_order(tables: list[str], specs: Mapping[str, TableSpec], strict: bool = False) -> list[str]:
    """``tables`` with parents before children, in the given order where that leaves a choice. What is on or behind a circle comes last in the given order, or raises if ``strict``."""
    needs = {t: {fk.parent for fk in specs[t].fks if fk.parent in tables and fk.parent != t} if t in specs else set() for t in tables}
    out: list[str] = []
    while len(out) < len(tables):
        free = next((t for t in tables if t not in out and needs[t] <= set(out)), None)
        if free is None and strict:
            raise ValueError(f"circle among {sorted(set(tables) - set(out))}")
        if free is None:
            return out + [t for t in tables if t not in out]
        out.append(free)
    return out


@dataclass(frozen=True)
class Link:
    """A foreign key to a cloned parent. principal: it names the parent's whole key by the same columns, so it decides which rows belong to a root."""

    fk: ForeignKey
    principal: bool


@dataclass(frozen=True)
class ClonePlan:
    table: str
    pk: tuple[str, ...]
    links: tuple[Link, ...]
    inherits: bool  # the key follows a parent's, or else gets numbers of its own


def clone_plans(specs: Mapping[str, TableSpec], root: str, numeric: Mapping[str, set[str]], also_static: Iterable[str] = ()) -> dict[str, ClonePlan]:
    """How each table that isn't static gets its new keys; every problem is named before it raises.

    ``numeric``: numeric columns of each table. A key with a part in a foreign key to a cloned parent follows the
    parent; a single numeric column in no foreign key gets new numbers; nothing else can be cloned. Every table but the
    root needs a principal link. Foreign keys that don't aim at a whole key are left as they are.
    """
    fixed = {t for t, s in specs.items() if s.static} | set(also_static)
    cloned = [t for t in specs if t not in fixed]
    plans, wrong = {}, []
    if root not in cloned:
        wrong.append(f"{root}: the root must be cloned")
    for t in sorted(cloned):
        s = specs[t]
        links = tuple(Link(fk, fk.parent != t and fk.columns == specs[fk.parent].pk) for fk in s.fks if fk.parent in cloned and fk.parent_columns == specs[fk.parent].pk)
        inside = {c for k in links for c in k.fk.columns if k.fk.parent != t}
        if not s.pk:
            wrong.append(f"{t}: no primary key")
        elif set(s.pk) & inside:
            plans[t] = ClonePlan(t, s.pk, links, True)
        elif len(s.pk) == 1 and s.pk[0] in numeric.get(t, set()) and not any(s.pk[0] in fk.columns for fk in s.fks):
            plans[t] = ClonePlan(t, s.pk, links, False)
        else:
            wrong.append(f"{t}: no rule for new values of {s.pk}")
        if t in plans and t != root and not any(k.principal for k in links):
            wrong.append(f"{t}: no principal link to a cloned parent")
    if wrong:
        raise ValueError("; ".join(wrong))
    return plans


def shift_columns(specs: Mapping[str, TableSpec], table: str) -> list[str]:
    """Columns that move with a uniform key shift: foreign keys to tables that aren't static, and the own key of a table that isn't, unless it points to a static one."""
    s = specs[table]
    fixed = {c for fk in s.fks if fk.parent in specs and specs[fk.parent].static for c in fk.columns}
    moved = {c for fk in s.fks if fk.parent not in specs or not specs[fk.parent].static for c in fk.columns}
    own = set() if s.static else set(s.pk)
    return sorted((own | moved) - fixed)


def ancestors(specs: Mapping[str, TableSpec], tables: Iterable[str]) -> list[str]:
    """``tables`` with all parents, their parents and so on."""
    seen, todo = set(), list(tables)
    while todo:
        t = todo.pop()
        if t not in seen:
            seen.add(t)
            todo += [fk.parent for fk in specs[t].fks if fk.parent in specs] if t in specs else []
    return sorted(seen)


def open_circles(specs: Mapping[str, TableSpec], audit: tuple[str, ...] = ("_ATUALIZ",)) -> tuple[dict[str, TableSpec], list[tuple[str, ForeignKey]]]:
    """Specs without audit links and without the links that close circles, and what was dropped: a graph without circles."""
    dropped: list[tuple[str, ForeignKey]] = []
    kept = {t: [fk for fk in s.fks if not any(c.endswith(a) for c in fk.columns for a in audit) or dropped.append((t, fk))] for t, s in specs.items()}
    order = {t: i for i, t in enumerate(waves({t: {fk.parent for fk in fks} for t, fks in kept.items()}))}
    for t, fks in kept.items():
        back = [fk for fk in fks if fk.parent in order and fk.parent != t and order[fk.parent] > order[t]]
        dropped += [(t, fk) for fk in back]
        kept[t] = [fk for fk in fks if fk not in back]
    return {t: TableSpec(t, s.pk, tuple(kept[t]), s.static, s.not_null) for t, s in specs.items()}, dropped


def _dump(text: str) -> list[dict[str, str]]:
    """Rows of a dictionary dump; headers without regard to case and blanks."""
    return [{(k or "").strip().upper(): (v or "").strip() for k, v in r.items()} for r in csv.DictReader(io.StringIO(text))]


def specs_from_constraints(text: str) -> tuple[dict[str, TableSpec], list[str]]:
    """Specs from a dump of constraints (TABLE_NAME, CONSTRAINT_NAME, CONSTRAINT_TYPE P/R/U, COLUMN_NAME, POSITION, R_CONSTRAINT_NAME); foreign keys whose parent is unknown or of another width are reported and left out."""
    cons: dict[str, dict] = {}
    for r in _dump(text):
        c = cons.setdefault(r["CONSTRAINT_NAME"], {"t": bare(r["TABLE_NAME"]), "k": r["CONSTRAINT_TYPE"], "to": r.get("R_CONSTRAINT_NAME", ""), "cols": []})
        c["cols"].append((int(r.get("POSITION") or 1), r["COLUMN_NAME"].upper()))
    cols = {n: tuple(x for _, x in sorted(c["cols"])) for n, c in cons.items()}
    pk = {c["t"]: cols[n] for n, c in cons.items() if c["k"] == "P"}
    fks: dict[str, list[ForeignKey]] = {}
    notes = []
    for n, c in sorted(cons.items()):
        if c["k"] != "R":
            continue
        to = cons.get(c["to"])
        if to is None:
            notes.append(f"{n}: parent constraint {c['to']} is missing")
        elif len(cols[n]) != len(cols[c["to"]]):
            notes.append(f"{n}: {len(cols[n])} columns for {len(cols[c['to']])}")
        else:
            fks.setdefault(c["t"], []).append(ForeignKey(cols[n], to["t"], cols[c["to"]]))
    names = sorted({c["t"] for c in cons.values()})
    return {t: TableSpec(t, pk.get(t, ()), tuple(fks.get(t, ()))) for t in names}, notes


def schema_from_dump(columns: str, uniques: Mapping[str, Iterable[Iterable[str]]] = {}) -> dict[str, TableSchema]:
    """Schemas from a dump of columns (TABLE_NAME, COLUMN_NAME, DATA_TYPE, DATA_PRECISION, DATA_SCALE, DATA_LENGTH, NULLABLE)."""
    out: dict[str, dict[str, ColumnRule]] = {}
    for r in _dump(columns):
        num = lambda k: int(r[k]) if r.get(k) else None  # noqa: B023, E731
        text = "CHAR" in r["DATA_TYPE"].upper()
        out.setdefault(bare(r["TABLE_NAME"]), {})[r["COLUMN_NAME"].upper()] = ColumnRule(r.get("NULLABLE", "Y").upper() != "N", None if text else num("DATA_PRECISION"), num("DATA_SCALE") or 0, num("DATA_LENGTH") if text else None)
    return {t: TableSchema(c, tuple(tuple(u) for u in uniques.get(t, ()))) for t, c in out.items()}


def clone_safety(specs: Mapping[str, TableSpec], schemas: Mapping[str, TableSchema], cloned: Iterable[str]) -> list[tuple[str, str, str]]:
    """Static findings (table, kind, detail) on cloning: unique keys that would repeat, nullable links, keys that dictionary and specs disagree on."""
    cloned, out = set(cloned), []
    for t in sorted(cloned):
        s = specs[t]
        moved = set(s.pk) | {c for fk in s.fks if fk.parent in cloned for c in fk.columns}
        sch = schemas.get(t, TableSchema())
        for u in sch.unique:
            if not set(u) & moved:
                out.append((t, "unique_repete", ",".join(u)))
        for fk in s.fks:
            if fk.parent in cloned and all(sch.columns.get(c, ColumnRule()).nullable for c in fk.columns):
                out.append((t, "fk_anulavel", ",".join(fk.columns)))
            if fk.parent not in specs:
                out.append((t, "pai_desconhecido", fk.parent))
        for c in s.pk:
            if sch.columns and c not in sch.columns:
                out.append((t, "coluna_ausente", c))
    return out


def pack_by_size(sizes: Mapping[str, float], buckets: int) -> list[list[str]]:
    """Longest-processing-time packing: each name, largest first, into the lightest bucket (then the first)."""
    out: list[list[str]] = [[] for _ in range(max(1, buckets))]
    load = [0.0] * len(out)
    for n in sorted(sizes, key=lambda n: (-sizes[n], n)):
        i = load.index(min(load))
        out[i].append(n)
        load[i] += sizes[n]
    return out


def copies_needed(asked: int, factor: int, got: int) -> int:
    """The factor that makes up for fewer roots than asked for."""
    if got <= 0:
        raise ValueError("no roots")
    return factor if got >= asked else math.ceil(asked * factor / got)


def overlaps(a: str, b: str) -> bool:
    """Whether one path is the other, or lies below it, by whole segments."""
    x, y = a.rstrip("/").split("/"), b.rstrip("/").split("/")
    n = min(len(x), len(y))
    return x[:n] == y[:n]


def canonical(obj) -> str:
    """The JSON text from which content ids are taken."""
    return json.dumps(obj, sort_keys=True, separators=(",", ":"), ensure_ascii=True)
