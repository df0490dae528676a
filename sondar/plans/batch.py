"""Plans, snapshots and reservations of a batch: content-addressed JSON whose lineage is checked before anything is made."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Mapping

from .catalog import ClonePlan, canonical


def content_id(obj) -> str:
    return hashlib.sha256(canonical(obj).encode()).hexdigest()


def batch_plan(product: str, plans: Mapping[str, ClonePlan], rows: Mapping[str, int], factor: int, starts: Mapping[str, int], snapshot: Mapping[str, str]) -> dict:
    """What is to be made: each table's key rule, first key and number of new keys, and the ids of the schemas it was made from."""
    tables = {t: {"pk": list(p.pk), "rule": "parent" if p.inherits else "own", "start": None if p.inherits else starts[t], "keys": rows.get(t, 0) * factor} for t, p in sorted(plans.items())}
    body = {"product": product, "factor": factor, "tables": tables, "snapshot": dict(snapshot)}
    return body | {"id": content_id(body)}


def check_plan(plan: Mapping) -> None:
    """Raises if the plan's content isn't what its id says."""
    if content_id({k: v for k, v in plan.items() if k != "id"}) != plan.get("id"):
        raise ValueError("the plan was changed")


def check_reservation(plan: Mapping, ranges: Mapping[str, Mapping], floors: Mapping[str, int]) -> list[str]:
    """Why a reservation doesn't fit a plan: wrong plan, missing or short ranges, ranges below the plan's start or the keys that are there now. Empty if it does."""
    check_plan(plan)
    out = []
    for t, p in plan["tables"].items():
        if p["rule"] != "own" or not p["keys"]:
            continue
        r = ranges.get(t)
        if r is None:
            out.append(f"{t}: no range")
            continue
        if r.get("plan") not in (None, plan["id"]):
            out.append(f"{t}: range of another plan")
        if r["end"] - r["start"] + 1 < p["keys"]:
            out.append(f"{t}: {p['keys']} keys in {r['end'] - r['start'] + 1}")
        if r["start"] < p["start"] or r["start"] <= floors.get(t, r["start"] - 1):
            out.append(f"{t}: range begins at {r['start']}")
    return out


def schema_id(df) -> str:
    """The id of a frame's schema, to compare a snapshot with what is read back."""
    return content_id(df.schema.jsonValue())


def compare_and_swap(read: Callable[[], tuple[object, dict]], write: Callable[[dict, object], bool], change: Callable[[dict], dict], attempts: int = 5, pause: float = 0.05) -> dict:
    """A change to a shared ledger that others may change too: read with its version, write only if the version still holds, try again if not."""
    for i in range(attempts):
        version, state = read()
        new = change(state)
        if write(new, version):
            return new
        time.sleep(pause * (i + 1))
    raise RuntimeError(f"the ledger kept changing over {attempts} attempts")


def lease(name: str, acquire: Callable[[str], bool], release: Callable[[], None], wait: float = 5.0, pause: float = 0.05):
    """A context in which a named lease is held; ``acquire`` creates it if it isn't there and says so."""
    from contextlib import contextmanager

    @contextmanager
    def held():
        token, until = f"{name}:{uuid.uuid4().hex}", time.monotonic() + wait
        while not acquire(token):
            if time.monotonic() > until:
                raise TimeoutError(name)
            time.sleep(pause)
        try:
            yield token
        finally:
            release()

    return held()


def schedule(jobs: Mapping[str, set[str]], run: Callable[[str], None], workers: int = 4) -> dict[str, str]:
    """Runs jobs with what they need first, up to ``workers`` at once: each ends ``feito``, ``falhou`` or ``pulado`` (a need failed)."""
    from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

    state: dict[str, str] = {}
    todo = {j: {d for d in ds if d in jobs} for j, ds in jobs.items()}
    with ThreadPoolExecutor(workers) as pool:
        active = {}
        while todo or active:
            for j in sorted(todo):
                if any(state.get(d) in ("falhou", "pulado") for d in todo[j]):
                    state[j] = "pulado"
                    del todo[j]
                elif all(state.get(d) == "feito" for d in todo[j]) and len(active) < workers:
                    active[pool.submit(run, j)] = j
                    del todo[j]
            if not active:
                if todo and all(ds - set(state) for ds in todo.values()):
                    raise ValueError(f"circle among {sorted(todo)}")
                continue
            for f in wait(active, return_when=FIRST_COMPLETED).done:
                state[active.pop(f)] = "falhou" if f.exception() else "feito"
    return state
