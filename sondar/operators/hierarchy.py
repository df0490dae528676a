"""Parent-child links to full hierarchies (problem 4): bottom-up leaf peeling, whole chains at a time.

A node waits for as many children as it has, and knows the exclusive or of their ids, so the last child left is known
without a look-up. Every round peels the leaves of what is left, and with each leaf the run of only-child ancestors
above it, which would be peeled one by one in the rounds to follow. Such a chain sends its number, its top's id and the
size of its subtree to the parent it hangs on. A round leaves at most half of the leaves, so the rounds are few (the
Strahler number of the forest), however deep it is. Within a chain, nodes find their leaf by doubling: each holds a
pointer, a distance and a sum, so memory does not grow with the chain's length. Nothing is peeled on a circle: what is
left is the circles. In the reverse order of peeling, chains get root and depth (and the path, if asked for) from the
node they hang on.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .skew import HOT_ROWS, hot_keys, salted_join

LONG = "array<bigint>"
NODE = ("h", "id", "parent", "kids", "kid", "size")


@dataclass(frozen=True)
class Round:
    """chains: h, leaf, steps (from the leaf to the top), top, hang; tall: h, id, leaf, dist, size, linked of their nodes above the leaf, if there are any."""

    chains: DataFrame
    number: int
    tall: DataFrame | None
    tall_rows: int


@dataclass(frozen=True)
class Peeled:
    rounds: list[Round]
    ring: DataFrame  # the nodes left: those on circles
    ring_rows: int
    alone: DataFrame | None  # nodes without parent and children


def waiting(df: DataFrame, key: str, parents: list[str]) -> DataFrame:
    """h (the place in ``parents``), id, parent, kids (children that have a row), kid (exclusive or of their ids), size = 1.

    Rows without a key are left out. A key in several different rows keeps its least link that is not NULL. Both groupings
    and their join are by id, so each side is shuffled once; repeats, and the children of one parent, are combined before.
    """
    wide = df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("bigint").alias("id")).agg(*(F.min(F.col(c).cast("bigint")).alias(f"p{i}") for i, c in enumerate(parents)))
    each = F.array(*(F.struct(F.lit(i).alias("h"), F.col(f"p{i}").alias("p")) for i in range(len(parents))))
    up = wide.select(F.col("id").alias("kid"), F.explode(each).alias("e")).where(F.col("e.p").isNotNull())
    mine = [F.col("e.h") == i for i in range(len(parents))]
    counts = [a for i, m in enumerate(mine) for a in (F.count_if(m).alias(f"n{i}"), F.bit_xor(F.when(m, F.col("kid"))).alias(f"x{i}"))]
    both = wide.join(up.groupBy(F.col("e.p").alias("id")).agg(*counts), "id", "left")
    zero = F.lit(0).cast("bigint")
    rows = F.array(*(F.struct(F.lit(i).alias("h"), F.col(f"p{i}").alias("parent"), F.coalesce(f"n{i}", zero).alias("kids"), F.coalesce(f"x{i}", zero).alias("kid")) for i in range(len(parents))))
    return both.select("id", F.explode(rows).alias("e")).select("e.h", "id", "e.parent", "e.kids", "e.kid", F.lit(1).cast("bigint").alias("size"))


def _thin(rest: DataFrame, scratch: Scratch) -> tuple[DataFrame, int]:
    """Nodes with one child left, with ptr (the first node below that has none or several, or one on a circle), kind (its children), dist to it and the sum of sizes below, and how many they are."""
    t, c = rest.where(F.col("kids") == 1).alias("t"), rest.alias("c")
    first = t.join(c, (F.col("t.h") == F.col("c.h")) & (F.col("t.kid") == F.col("c.id"))).select("t.*", F.col("t.kid").alias("ptr"), F.lit(1).cast("bigint").alias("dist"), F.col("c.size").alias("below"), F.col("c.kids").alias("kind"))
    cur, number, open_ = scratch.counted(first, F.col("kind") == 1)
    while open_:
        t, u = cur.where(F.col("kind") == 1).alias("t"), cur.alias("u")
        # pointers at thin nodes are all different: no key is hot
        further = t.join(u, (F.col("t.h") == F.col("u.h")) & (F.col("t.ptr") == F.col("u.id"))).select(*(F.col(f"t.{c}") for c in NODE), "u.ptr", (F.col("t.dist") + F.col("u.dist")).alias("dist"), (F.col("t.below") + F.col("u.below")).alias("below"), "u.kind")
        old, was = cur, open_
        cur, _, open_ = scratch.counted(cur.where(F.col("kind") != 1).unionByName(further), F.col("kind") == 1)
        scratch.drop(old)
        if open_ == was:  # every chain's nodes come nearer to its end; those on circles never do
            break
    return cur, number


def peel(df: DataFrame, key: str, parents: list[str], scratch: Scratch, alone: bool = True) -> Peeled:
    """The rounds of peeling the hierarchies that ``parents`` (link columns) make of ``df``, bottom up, and what no round peels."""
    nodes = waiting(df, key, parents)
    apart = F.col("parent").isNull() & (F.col("kids") == 0)
    kept, _, leaves = scratch.counted(nodes if alone else nodes.where(~apart), (F.col("kids") == 0) & F.col("parent").isNotNull())
    rest = kept.where(~apart) if alone else kept
    rounds: list[Round] = []
    rows = None
    while leaves:
        thin, tall_rows = _thin(rest, scratch)
        ends = rest.where(F.col("kids") == 0).select("h", F.col("id").alias("leaf"), "parent", "size")
        if tall_rows:
            tall = thin.where(F.col("kind") == 0).select("h", "id", F.col("ptr").alias("leaf"), "dist", (F.col("size") + F.col("below")).alias("size"), "parent")
            tops = tall.groupBy("h", "leaf").agg(F.max(F.struct("dist", "id", "parent", "size")).alias("top"))
            chains = ends.join(tops, ["h", "leaf"], "left").select(
                "h", "leaf", F.coalesce("top.dist", F.lit(0)).cast("bigint").alias("steps"), F.coalesce("top.id", "leaf").alias("top"),
                F.when(F.col("top").isNull(), F.col("parent")).otherwise(F.col("top.parent")).alias("hang"), F.coalesce("top.size", "size").alias("total"), "size",
            )
        else:
            tall = None
            chains = ends.select("h", "leaf", F.lit(0).cast("bigint").alias("steps"), F.col("leaf").alias("top"), F.col("parent").alias("hang"), F.col("size").alias("total"), "size")
        chains, number, _ = scratch.counted(chains)
        rounds.append(Round(chains, number, tall, tall_rows))
        sent = chains.where(F.col("hang").isNotNull()).groupBy("h", F.col("hang").alias("id")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor("top").alias("x"), F.sum("total").alias("s"))
        # a thin node's child is not peeled without it, so only nodes with several children hear from below
        wide = rest.where(F.col("kids") > 1).join(sent, ["h", "id"], "left")
        zero = F.lit(0).cast("bigint")
        heard = wide.select("h", "id", "parent", (F.col("kids") - F.coalesce("n", zero)).alias("kids"), F.col("kid").bitwiseXOR(F.coalesce("x", zero)).alias("kid"), (F.col("size") + F.coalesce("s", zero)).alias("size"))
        rest, rows, leaves = scratch.counted(heard.unionByName(thin.where(F.col("kind") != 0).select(*NODE)), F.col("kids") == 0)
    if rows is None:
        rows = rest.count()
    return Peeled(rounds, rest, rows, kept.where(apart) if alone else None)


def circles(ring: DataFrame, scratch: Scratch) -> DataFrame:
    """Of nodes on circles: h, id, size and root (the circle's least id), by doubling: each knows the least id of so many nodes from it on; once no node hears of a lesser one, all know their circle's."""
    cur = ring.select("h", "id", F.col("parent").alias("ptr"), F.col("id").alias("root"), F.lit(False).alias("less"), "size")
    while True:
        a, b = cur.alias("a"), cur.alias("b")
        grown = a.join(b, (F.col("a.h") == F.col("b.h")) & (F.col("a.ptr") == F.col("b.id"))).select("a.h", "a.id", "b.ptr", F.least("a.root", "b.root").alias("root"), (F.col("b.root") < F.col("a.root")).alias("less"), "a.size")
        cur, _, changed = scratch.counted(grown, F.col("less"))
        if not changed:
            return cur.select("h", "id", "root", "size")


def _solved(r: Round, above: DataFrame | None, paths: bool) -> DataFrame:
    """h, id, root, depth, path, size, linked of the nodes of a round's chains, from those of the nodes they hang on."""
    empty = F.array().cast(LONG)
    look = [F.col("root").alias("__root"), F.col("depth").alias("__depth"), (F.col("path") if paths else empty).alias("__path")]
    low = r.chains.where(F.col("hang").isNotNull())
    if above is None:
        hung = low.select("*", F.lit(None).cast("bigint").alias("__root"), F.lit(None).cast("int").alias("__depth"), empty.alias("__path"))
    else:
        # children of one node may be a third of all rows: salted where they are
        hung = salted_join(low, above.select("h", F.col("id").alias("hang"), *look), ["h", "hang"], "left", ["leaf"], hot_keys(low, ["h", "hang"]) if r.number >= HOT_ROWS else [])
    # tops of trees hang on nothing, or on a node without a row
    hung = hung.unionByName(r.chains.where(F.col("hang").isNull()), allowMissingColumns=True)
    first = F.when(F.col("__depth") == -1, -1).otherwise(F.coalesce(F.col("__depth") + 1, F.lit(0)))  # of the chain's top
    base = hung.select("h", "leaf", "steps", F.coalesce("__root", "top").alias("root"), first.alias("__first"), F.coalesce("__path", empty).alias("__path"), "size", F.col("hang").isNotNull().alias("__hung"))
    depth = lambda down: F.when(F.col("__first") == -1, -1).otherwise(F.col("__first") + down).cast("int").alias("depth")
    if not paths:
        ends = base.select("h", F.col("leaf").alias("id"), "root", depth(F.col("steps")), "size", (F.col("__hung") | (F.col("steps") > 0)).alias("linked"))
        if r.tall is None:
            return ends
        tall = r.tall.select("h", "leaf", "id", "dist", F.col("size").alias("__size"), F.col("parent").isNotNull().alias("linked"))
        # one chain may be a third of all rows
        each = salted_join(tall, base.where(F.col("steps") > 0).drop("size"), ["h", "leaf"], "inner", ["id"], hot_keys(tall, ["h", "leaf"]) if r.tall_rows >= HOT_ROWS else [])
        return ends.unionByName(each.select("h", "id", "root", depth(F.col("steps") - F.col("dist")), F.col("__size").alias("size"), "linked"))
    # a chain's ids stand in one list, from the top down: no longer than the path of its leaf, which is part of the result
    own = F.array(F.struct("leaf", "size"))
    if r.tall is None:
        line = base.withColumn("__line", own)
    else:
        lists = r.tall.groupBy("h", "leaf").agg(F.sort_array(F.collect_list(F.struct((-F.col("dist")).alias("o"), F.col("id").alias("leaf"), "size"))).alias("__up"))
        up = F.transform("__up", lambda x: F.struct(x["leaf"].alias("leaf"), x["size"].alias("size")))
        line = base.join(lists, ["h", "leaf"], "left").withColumn("__line", F.concat(F.coalesce(up, F.array().cast("array<struct<leaf:bigint,size:bigint>>")), own))
    line = line.withColumn("__down", F.concat("__path", F.col("__line.leaf")))
    each = line.select("h", "root", "__first", "__hung", "__down", F.size("__path").alias("__n"), F.posexplode("__line").alias("__i", "__x"))
    return each.select("h", F.col("__x.leaf").alias("id"), "root", depth(F.col("__i")), F.slice("__down", F.lit(1), F.col("__n") + F.col("__i") + 1).alias("path"), F.col("__x.size").alias("size"), (F.col("__hung") | (F.col("__i") > 0)).alias("linked"))


def _named(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumn("h", F.array(*map(F.lit, names))[F.col("h")])


def hierarchy(df: DataFrame, key: str, parents: dict[str, str], scratch: Scratch, paths: bool = True, alone: bool = True) -> DataFrame:
    """h, id, root, depth, path (if asked for), size, linked, on_circle of every node of every hierarchy (``parents``: its name and link column).

    path runs from the root down to the node itself; size counts the node and all below it; linked says whether its link
    is not NULL. A link to a node without a row ends there: the node is its own root at depth 0. On a circle, and below
    one, root is the least id of the circle and depth -1; the path of a node below one starts at the circle's node that
    it hangs on, and a circle's node has itself as path and the size of what hangs on it. Rows without a key are no
    nodes; a key in several rows is one node with its least link. Each node once; without ``alone`` those that have
    neither parent nor children are left out. Empty in, empty out.
    """
    done = peel(df, key, list(parents.values()), scratch, alone)
    path = [F.array("id").alias("path")] if paths else []
    parts = []
    if done.ring_rows:
        ring = circles(done.ring, scratch)
        parts.append(scratch.keep(ring.select("h", "id", "root", F.lit(-1).alias("depth"), *path, "size", F.lit(True).alias("linked"), F.lit(True).alias("on_circle"))))
    for i, r in enumerate(reversed(done.rounds)):
        part = _solved(r, _union(parts), paths).withColumn("on_circle", F.lit(False))
        parts.append(part if i == len(done.rounds) - 1 else scratch.keep(part))
    if alone or not parts:
        single = (done.alone if alone else done.ring).select("h", "id", F.col("id").alias("root"), F.lit(0).alias("depth"), *path, "size", F.lit(False).alias("linked"), F.lit(False).alias("on_circle"))
        parts.append(single)
    return _named(_union(parts), list(parents))


def _union(parts: list[DataFrame]) -> DataFrame | None:
    out = None
    for p in parts:
        out = p if out is None else out.unionByName(p)
    return out


def descendants(tree: DataFrame) -> DataFrame:
    """h, ancestor, id, steps: every node below every node, once, from the paths (no group is gathered; a row's path gives its ancestors)."""
    each = tree.select("h", "id", F.size("path").alias("__n"), F.posexplode("path").alias("__i", "ancestor"))
    return each.where(F.col("__i") < F.col("__n") - 1).select("h", "ancestor", "id", (F.col("__n") - 1 - F.col("__i")).alias("steps"))


def circle_members(df: DataFrame, key: str, parents: dict[str, str], scratch: Scratch) -> DataFrame:
    """h, circle (its least id), id of all nodes on circles: what peeling leaves."""
    ring = circles(peel(df, key, list(parents.values()), scratch, alone=False).ring, scratch)
    return _named(ring, list(parents)).select("h", F.col("root").alias("circle"), "id")
