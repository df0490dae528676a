import random

import pytest
from conftest import rows

from sondar.operators import hierarchy, skew


def brute(parents):
    """{id: (root, depth, path, size)} and circles, by walking up."""
    up = {i: p if p in parents else None for i, p in parents.items()}
    out, below = {}, {i: 0 for i in parents}
    for i in parents:
        seen, x = [], i
        while x is not None and x not in seen:
            seen.append(x)
            x = up[x]
        if x is None:
            path = seen[::-1]
            out[i] = [path[0], len(path) - 1, path]
        else:
            at = seen.index(x)
            path = seen[: at + 1][::-1]
            out[i] = [min(seen[at:]), -1, path]
        for a in out[i][2]:
            below[a] += 1
    return {i: (*v, below[i]) for i, v in out.items()}


def forest(rng, n, kind):
    ids = list(range(1, n + 1))
    rng.shuffle(ids)
    p = {}
    for j, i in enumerate(ids):
        if kind == "chain":
            p[i] = ids[j - 1] if j % 200 else None
        elif kind == "star":
            p[i] = ids[0] if j and rng.random() < 0.6 else ids[rng.randrange(j)] if j else None
        else:
            p[i] = ids[rng.randrange(j)] if j and rng.random() < 0.8 else None
    for i in rng.sample(ids, max(1, n // 25)):  # circles, loops and links that lead nowhere
        p[i] = rng.choice([i, rng.choice(ids), 10**9 + i])
    return p


@pytest.mark.parametrize(("kind", "seed"), [("random", 1), ("chain", 2), ("star", 3)])
def test_against_brute_force(spark, scratch, kind, seed, monkeypatch):
    if kind == "star":
        monkeypatch.setattr(skew.hot_keys, "__defaults__", (20,))
        monkeypatch.setattr(hierarchy, "HOT_ROWS", 20)
    parents = forest(random.Random(seed), 700, kind)
    df = spark.createDataFrame([(i, p, 0) for i, p in parents.items()] + [(i, p, 1) for i, p in list(parents.items())[:20]], "id bigint, p bigint, depth int")
    tree = scratch.keep(hierarchy.hierarchy(df, "id", {"x": "p"}, scratch))
    got = {r.id: (r.root, r.depth, list(r.path), r.size) for r in tree.collect()}
    want = brute(parents)
    assert got == want
    down = {(r.ancestor, r.id, r.steps) for r in hierarchy.descendants(tree).collect()}
    assert down == {(a, i, len(v[2]) - 1 - j) for i, v in want.items() for j, a in enumerate(v[2][:-1])}
    members = {r.id: r.circle for r in hierarchy.circle_members(df, "id", {"x": "p"}, scratch).collect()}
    assert members == {i: want[i][0] for i in members} and set(members) == {i for i, v in want.items() if v[1] == -1 and v[2] == [i]}
    short = scratch.keep(hierarchy.hierarchy(df, "id", {"x": "p"}, scratch, paths=False))
    assert {r.id for r in short.where("linked").collect()} == {i for i, p in parents.items() if p is not None}
    few = hierarchy.hierarchy(df, "id", {"x": "p"}, scratch, paths=False, alone=False)
    assert {r.id for r in short.collect()} - {r.id for r in few.collect()} == {i for i, p in parents.items() if p is None and i not in parents.values()}
    assert {r.id: (r.root, r.depth, r.size) for r in short.collect()} == {i: (v[0], v[1], v[3]) for i, v in want.items()}


def test_large_ids_keep_their_value(spark, scratch):
    big = 2**62
    df = spark.createDataFrame([(big + 1, None), (big + 2, big + 1), (big + 3, big + 2)], "id bigint, p bigint")
    tree = hierarchy.hierarchy(df, "id", {"x": "p"}, scratch)
    assert rows(tree, "id", "root", "depth") == [(big + 1, big + 1, 0), (big + 2, big + 1, 1), (big + 3, big + 1, 2)]


def test_odd_cases(spark, scratch):
    schema = "id bigint, p bigint, q bigint, h string, parent int"
    assert hierarchy.hierarchy(spark.createDataFrame([], schema), "id", {"x": "p"}, scratch).collect() == []
    data = [(1, None, 1, "z", 0), (2, 1, 3, "z", 0), (3, 99, 2, None, 0), (None, 1, None, "z", 0), (2, 1, 3, "z", 0), (2, None, 3, "z", 0)]
    tree = hierarchy.hierarchy(spark.createDataFrame(data, schema), "id", {"x": "p", "y": "q"}, scratch)
    assert rows(tree, "h", "id", "root", "depth", "size") == sorted([("x", 1, 1, 0, 2), ("x", 2, 1, 1, 1), ("x", 3, 3, 0, 1), ("y", 1, 1, -1, 1), ("y", 2, 2, -1, 1), ("y", 3, 2, -1, 1)])


def test_long_chain_and_long_circle(spark, scratch):
    n = 100_000
    df = spark.range(1, 2 * n + 1).selectExpr("id", f"case when id = 1 then null when id = {n} + 1 then 2 * {n} else id - 1 end as p")
    tree = scratch.keep(hierarchy.hierarchy(df, "id", {"x": "p"}, scratch, paths=False))
    line, ring = tree.where(f"id <= {n}"), tree.where(f"id > {n}")
    assert line.where(f"root = 1 and depth = id - 1 and size = {n} - id + 1").count() == n
    assert ring.where(f"root = {n} + 1 and depth = -1 and on_circle").count() == n
