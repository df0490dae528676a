"""Filling fixed-capacity containers with whole items (problem 6): exact-complement hashing on the histogram of lengths.

How many items there are of each length fits in an array of capacity + 1 numbers, whatever the data's size. The plan is
made on it: containers are filled exactly where an open gap has a complement of one, two or three available lengths
(looked up by length, hashed pair and triple sums), many containers of the same make at a time; what finds no exact
complement goes where it fits best. The plan is a list of container makes with their numbers; items take their places
by their ordinal within their length, which is counted in parallel.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import PART_ROWS, even_hash, running
from ..operators.scratch import Scratch


@dataclass(frozen=True)
class Make:
    """``times`` containers, each holding ``items``: (length, number) pairs."""

    items: tuple[tuple[int, int], ...]
    times: int

    def used(self) -> int:
        return sum(length * n for length, n in self.items)


class _Stock:
    """Numbers of items left of each length, with the lengths that are left in order."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.n = np.zeros(capacity + 1, dtype=np.int64)
        for length, k in counts.items():
            self.n[length] = k
        self.witness: dict[int, tuple[int, int]] = {}

    def largest(self, most: int, taken: dict[int, int]) -> int:
        """The largest length up to ``most`` of which an item is left beside those taken; 0 if none."""
        for length in np.flatnonzero(self.n[: most + 1])[::-1]:
            if length and self.n[length] > taken.get(int(length), 0):
                return int(length)
        return 0

    def single(self, gap: int, taken: dict[int, int]) -> tuple[int, ...] | None:
        return (gap,) if self.n[gap] > taken.get(gap, 0) else None

    def _free(self, taken: dict[int, int]) -> np.ndarray:
        if not taken:
            return self.n
        free = self.n.copy()
        for length, k in taken.items():
            free[length] -= k
        return free

    def pair(self, gap: int, taken: dict[int, int], free: np.ndarray | None = None) -> tuple[int, ...] | None:
        """Two lengths that add up to the gap; a pair found before is tried first (the hash index of pair sums)."""
        free = self._free(taken) if free is None else free
        old = self.witness.get(gap)
        if old and free[old[0]] > 0 and free[old[1]] > (old[0] == old[1]):
            return old
        low = np.arange(1, gap // 2 + 1)
        ok = (free[low] > 0) & (free[gap - low] > 0)
        if gap % 2 == 0 and gap >= 2 and free[gap // 2] < 2:
            ok[-1] = False
        at = np.flatnonzero(ok)
        if not at.size:
            return None
        # the pair of which most containers can be made
        best = at[np.argmax(np.minimum(free[low[at]], free[gap - low[at]]))]
        self.witness[gap] = (int(gap - low[best]), int(low[best]))
        return self.witness[gap]

    def triple(self, gap: int, taken: dict[int, int], tries: int | None = None) -> tuple[int, ...] | None:
        """Three lengths that add up to the gap: a length whose complement is a pair sum. Lengths most at hand first; all of them, or up to ``tries``."""
        free = self._free(taken)
        some = np.flatnonzero(free[: max(gap - 1, 0)])
        some = some[some > 0]
        # sums of two available lengths, by convolution; some of them need a length twice that is there once, so pair() decides
        there = np.fft.rfft(free[: gap + 1] > 0, 2 * gap + 2)
        some = some[np.fft.irfft(there * there, 2 * gap + 2)[gap - some] > 0.5]
        for x in some[np.argsort(-free[some], kind="stable")][:tries]:
            free[x] -= 1
            got = self.pair(int(gap - x), {}, free)
            free[x] += 1
            if got:
                return (int(x), *got)
        return None


def _pile(lengths: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for length in lengths:
        out[length] = out.get(length, 0) + 1
    return out


def plan(counts: dict[int, int], capacity: int) -> list[Make]:
    """Container makes for ``counts`` items of each length from 1 to ``capacity``. Every item is in exactly one container.

    Work and result are bounded by the capacity, not by the number of items: each step uses up a length, or sets it
    aside. Ties go to the more plentiful length, then to the shorter one. Every length is tried as the
    third of a triple before the gap is narrowed by the largest item that fits. Where items are so few that exact containers leave
    more of the others open than they save, best fit alone is taken if that needs fewer containers.
    """
    stock = _Stock({k: v for k, v in counts.items() if k > 0 and v > 0}, capacity)
    makes: list[Make] = []
    aside: dict[int, int] = {}
    while True:
        length = stock.largest(capacity, {})
        if not length:
            break
        taken, gap = {length: 1}, capacity - length
        exact = gap == 0
        while gap and not exact:
            rest = stock.single(gap, taken) or stock.pair(gap, taken) or stock.triple(gap, taken)
            if rest:
                for x in rest:
                    taken[x] = taken.get(x, 0) + 1
                exact = True
                break
            nxt = stock.largest(gap - 1, taken)
            if not nxt:
                break
            k = max(1, min(gap // nxt - 1, int(stock.n[nxt]) - taken.get(nxt, 0)))  # leave room for an exact end
            taken[nxt] = taken.get(nxt, 0) + k
            gap -= k * nxt
        if not exact:  # no exact container with this length: all that is left of it waits for the best fit
            aside[length] = aside.get(length, 0) + int(stock.n[length])
            stock.n[length] = 0
            continue
        times = min(int(stock.n[x]) // k for x, k in taken.items())
        for x, k in taken.items():
            stock.n[x] -= k * times
        makes.append(Make(tuple(sorted(taken.items(), reverse=True)), times))
    makes += best_fit(aside, capacity)
    number = lambda ms: sum(m.times for m in ms)
    least = -(-sum(k * v for k, v in counts.items() if k > 0 and v > 0) // capacity)
    if aside and number(makes) > least:
        other = best_fit({k: v for k, v in counts.items() if k > 0 and v > 0}, capacity)
        if number(other) < number(makes):
            return other
    return makes


def best_fit(counts: dict[int, int], capacity: int) -> list[Make]:
    """Best fit, longest first: each item into the container with the least gap that holds it, groups of like containers at a time."""
    gaps: list[int] = []
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}

    def put(gap: int, items: dict[int, int], times: int) -> None:
        if gap not in open_:
            open_[gap] = []
            insort(gaps, gap)
        open_[gap].append((items, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at == len(gaps):
                each = capacity // length
                if full := left // each:
                    put(capacity - each * length, {length: each}, full)
                if left % each:
                    put(capacity - (left % each) * length, {length: left % each}, 1)
                break
            gap = gaps[at]
            items, times = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
                gaps.pop(at)
            # the container just used has the least gap that holds the next item too, until it is full
            each = gap // length
            k = min(left // each, times)
            left -= each * k
            some = left if k < times else 0  # fewer than a container takes, for one more of them
            left -= some
            for n, many in ((each, k), (some, 1 if some else 0), (0, times - k - (1 if some else 0))):
                if many:
                    put(gap - n * length, items | ({length: items.get(length, 0) + n} if n else {}), many)
    return [Make(tuple(sorted(items.items(), reverse=True)), times) for gap in gaps for items, times in open_[gap]]


def places(makes: list[Make], capacity: int) -> np.ndarray:
    """Rows (length, first ordinal, items of it in a container, first container), sorted: where the n-th item of a length goes."""
    nxt = np.zeros(capacity + 1, dtype=np.int64)
    rows, container = [], 1
    for m in makes:
        for length, k in m.items:
            rows.append((length, int(nxt[length]), k, container))
            nxt[length] += k * m.times
        container += m.times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def _container(at: np.ndarray) -> Column:
    """The container of (length, ordinal), by binary search in the plan (its size depends on the capacity alone)."""
    key = at[:, 0] * (1 << 44) + at[:, 1]

    @F.pandas_udf("bigint")
    def find(length: pd.Series, ordinal: pd.Series) -> pd.Series:
        if not len(length):
            return pd.Series([], dtype="int64")
        size, n = length.to_numpy(dtype=np.int64), ordinal.to_numpy(dtype=np.int64)
        if not len(at):
            return pd.Series(np.ones(len(size), dtype=np.int64))
        i = np.clip(np.searchsorted(key, size * (1 << 44) + n, side="right") - 1, 0, None)
        return pd.Series(np.where(size == 0, 1, at[i, 3] + (n - at[i, 1]) // at[i, 2]))

    return find(F.col("tokens"), F.col("__n"))


def pack(items: DataFrame, key: str, capacity: int, scratch: Scratch) -> tuple[DataFrame, list[Make]]:
    """``items`` (key, tokens) put into containers: key, parte, token_de, token_ate, tokens, num_container; and the plan.

    Only an item longer than the capacity is divided: into parts of the full capacity and one rest, token_de to
    token_ate (the first inside, the last outside). Items of no tokens take no room and lie in the first container. NULL
    keys are keys like others; the same key twice is two items. No items, no containers.
    """
    n = F.greatest(F.ceil(F.col("tokens") / F.lit(capacity)).cast("int"), F.lit(1))
    parts = items.select(F.col(key), F.col("tokens").alias("__all"), F.explode(F.sequence(F.lit(1), n)).alias("parte"))
    start = (F.col("parte") - 1).cast("bigint") * capacity
    parts = parts.select(key, "parte", start.alias("token_de"), F.least(F.col("__all"), start + capacity).alias("token_ate")).withColumn("tokens", F.col("token_ate") - F.col("token_de"))
    counts = {r.tokens: r.n for r in parts.groupBy("tokens").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity + 1 rows
    makes = plan(counts, capacity)
    many = [(k, -(-v // PART_ROWS)) for k, v in sorted(counts.items()) if v > PART_ROWS]
    hashed = parts.withColumn("__h", even_hash(F.col(key), F.col("parte")))
    cut = F.lit(1)
    if many:  # a row a plentiful length: at most capacity + 1 of them, which bounds the broadcast whatever the data
        wide = items.sparkSession.createDataFrame(many, "tokens bigint, __cut bigint")
        hashed = hashed.join(F.broadcast(wide), "tokens", "left")
        cut = F.coalesce("__cut", F.lit(1))
    numbered = running(hashed, ["tokens"], "__h", [key, "parte"], F.lit(1), cut, scratch, "__n")
    return numbered.withColumn("num_container", _container(places(makes, capacity))).select(key, "parte", "token_de", "token_ate", "tokens", "num_container"), makes
