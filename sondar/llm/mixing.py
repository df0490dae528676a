"""Mixing sources to target weights (problem 7): temperature mixing, realised as budgeted block permutations.

The mixture is q proportional to p ** (1 - a) * w ** a, where p are the sources' own token shares and w the target
weights (all equal if there are none): a = 0 keeps the natural mix, a = 1 meets the targets. The exponent a is bisected
to the largest that a repetition limit allows under the budget, or to a target entropy. Each source then gives its
share of the budget: whole passes over all of its documents, each over the source's blocks in a permutation of its own,
and a last pass as far as the budget goes; documents are dealt to blocks of the mixture so that each of those holds it.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import filled
from ..operators.prefix import PART_ROWS, even_hash, running
from ..operators.scratch import Scratch


#: Documents that a block of a source should have: blocks are what a pass permutes.
BLOCK_DOCS = 64


@dataclass(frozen=True)
class Source:
    """A source with a target: its documents, tokens, weight and highest number of uses of a document."""

    name: str
    docs: int
    tokens: int
    weight: float
    limit: int


@dataclass(frozen=True)
class Mixture:
    """exponent, total budget, and the tokens each source is to give."""

    exponent: float
    budget: float
    share: dict[str, float]


def blend(sources: list[Source], exponent: float) -> dict[str, float]:
    """Normalised weights p ** (1 - a) * w ** a; sources without tokens or weight get none."""
    total = sum(s.tokens for s in sources)
    raw = {s.name: math.exp((1 - exponent) * math.log(s.tokens / total) + exponent * math.log(s.weight)) if s.tokens and s.weight > 0 else 0.0 for s in sources}
    z = sum(raw.values())
    return {k: v / z if z else 0.0 for k, v in raw.items()}


def _bisect(good, low: float, high: float, steps: int = 60) -> float:
    """The largest exponent that is good, if all below a good one are."""
    if good(high):
        return high
    for _ in range(steps):
        mid = (low + high) / 2
        low, high = (mid, high) if good(mid) else (low, mid)
    return low


def largest_budget(sources: list[Source], share: dict[str, float]) -> float:
    """The most tokens that a mixture can have within every source's limit of repetitions."""
    return min((s.limit * s.tokens / share[s.name] for s in sources if share.get(s.name, 0) > 0), default=0.0)


def mixture(sources: list[Source], budget: float | None = None, entropy: float | None = None) -> Mixture:
    """The mixture to realise.

    Without a budget: the targets themselves (exponent 1), as large as the repetition limits allow. With one: the
    exponent nearest to 1 under which that budget keeps the limits; if not even the natural mix does, the budget is
    cut. With an entropy (in nats): the exponent that gives it, between the natural mix and the targets, where entropy
    changes one way (else the largest that is found).
    """
    if entropy is not None:
        def h(a: float) -> float:
            return entropy_of(blend(sources, a))

        up = h(1.0) >= h(0.0)
        exponent = _bisect(lambda a: h(a) <= entropy if up else h(a) >= entropy, 0.0, 1.0)
    elif budget is not None:
        exponent = _bisect(lambda a: largest_budget(sources, blend(sources, a)) >= budget, 0.0, 1.0)
    else:
        exponent = 1.0
    share = blend(sources, exponent)
    most = largest_budget(sources, share)
    return Mixture(exponent, min(budget, most) if budget is not None else most, share)


def entropy_of(share: dict[str, float]) -> float:
    """The entropy of normalised weights, in nats."""
    return -sum(q * math.log(q) for q in share.values() if q > 0)


def sources_of(docs: DataFrame, targets: DataFrame) -> list[Source]:
    """Documents and tokens of every source that has a target; ``targets`` (source, peso_alvo, max_repeticoes) is metadata of a few rows."""
    name = F.lower(filled(F.col("source")))
    want = targets.where(name.isNotNull()).groupBy(name.alias("source")).agg(F.max("peso_alvo").alias("w"), F.max("max_repeticoes").alias("m"))
    have = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    rows = want.join(have, "source", "left").orderBy("source").collect()
    total = sum(float(r.w or 0) for r in rows) or 1.0
    return [Source(r.source, r.n or 0, r.t or 0, float(r.w or 0) / total, int(r.m or 0)) for r in rows]


def usable(documents: DataFrame) -> DataFrame:
    """doc_id, source (lower case, no outer blanks), tokens of documents with a source and at least one token."""
    return documents.select("doc_id", F.lower(filled(F.col("source"))).alias("source"), "tokens").where(F.col("source").isNotNull() & (F.col("tokens") > 0))


def _permutation(salt: str, source: str, use: int, bits: int) -> tuple[int, int]:
    """A permutation x -> (a x + c) mod 2**bits of a source's blocks, of its own for every use: a is odd, so no two blocks meet."""
    seed = int.from_bytes(hashlib.sha256(f"{salt}:{source}:{use}".encode()).digest()[:16], "big")
    mask = (1 << bits) - 1
    return (seed & mask) | 1, (seed >> 64) & mask


def collect_mixture(docs: DataFrame, sources: list[Source], mix: Mixture, scratch: Scratch, block_tokens: int = 1_000_000, salt: str = "mistura-1") -> DataFrame:
    """source, doc_id, passagem, bloco, posicao, tokens: the documents of the mixture, each use a row.

    A salted hash deals a source's documents to blocks of about ``BLOCK_DOCS`` and orders them within; every pass takes the
    blocks in a permutation of its own (ties by doc_id). posicao is the number of tokens of the source before a document.
    Documents are taken as long as they fit in the source's share; then one more of those left, whose length comes nearest
    to the rest. bloco runs over the whole mixture, about ``block_tokens`` each. A document without tokens, or of a source
    without a target, is in no mixture. Empty in, empty out.
    """
    rows = []
    for s in sources:
        goal = mix.budget * mix.share.get(s.name, 0.0)
        if goal <= 0 or not s.tokens:
            continue
        bits = min(30, max(0, math.ceil(math.log2(max(1, s.docs / BLOCK_DOCS)))))
        for use in range(1, min(s.limit, math.ceil(goal / s.tokens - 1e-9)) + 1):
            rows.append((s.name, use, goal, (use - 1) * s.tokens, max(1, -(-s.docs // PART_ROWS)), bits, *_permutation(salt, s.name, use, bits)))
    # metadata: a row a source with a target and use of it
    plan = docs.sparkSession.createDataFrame(rows, "source string, passagem int, __due double, __before bigint, __parts bigint, __bits int, __a bigint, __c bigint")
    uses = docs.select("source", "doc_id", "tokens").join(F.broadcast(plan), "source").withColumn("__h0", even_hash(F.lit(salt), "doc_id"))
    # 52 bits: the block, then the place within it
    width = F.lit(52) - F.col("__bits")
    block = F.call_function("shiftright", F.col("__h0"), width)
    moved = F.call_function("shiftleft", (F.col("__a") * block + F.col("__c")) % F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("__bits")), width)
    hashed = uses.withColumn("__h", moved + F.col("__h0") - F.call_function("shiftleft", block, width)).drop("__h0", "__bits", "__a", "__c")
    placed = running(hashed, ["source", "passagem"], "__h", ["doc_id"], F.col("tokens"), F.col("__parts"), scratch, "__start")
    placed = scratch.keep(placed.select("source", "doc_id", "passagem", "tokens", "__h", "__due", (F.col("__start") + F.col("__before")).cast("bigint").alias("posicao")))
    inside = F.col("posicao") + F.col("tokens") <= F.col("__due")
    kept = placed.where(inside)
    used = kept.groupBy("source").agg(F.sum("tokens").alias("__used"))  # a row a source with a target
    # one more use fills what is left best: the one whose length is nearest to it
    left = placed.where(~inside).join(F.broadcast(used), "source", "left").withColumn("__used", F.coalesce("__used", F.lit(0)).cast("bigint"))
    gap = F.col("__due") - F.col("__used")
    off = F.abs(gap - F.col("tokens"))
    last = left.where(off < gap).groupBy("source").agg(F.min(F.struct(off.alias("o"), "__h", "doc_id", "passagem", "tokens", F.col("__used").alias("posicao"), "__due")).alias("__b"))
    filler = last.select("source", "__b.doc_id", "__b.passagem", "__b.tokens", "__b.posicao", "__b.__due")
    blocks = max(1, math.ceil(mix.budget / block_tokens))
    block_no = F.least(F.floor(F.col("posicao") / F.col("__due") * blocks), F.lit(blocks - 1)).cast("int")
    return kept.drop("__h").unionByName(filler).select("source", "doc_id", "passagem", block_no.alias("bloco"), "posicao", "tokens")


def report(chosen: DataFrame, sources: list[Source], mix: Mixture) -> DataFrame:
    """A row a source with a target: its weight, what it has, what was used, the share reached and the most uses of a document."""
    spark = chosen.sparkSession
    uses = chosen.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("u"), F.sum("tokens").alias("t"))
    used = uses.groupBy("source").agg(F.sum("t").alias("tokens_usados"), F.count(F.lit(1)).alias("documentos_usados"), F.max("u").alias("usos_maximos"))
    plan = spark.createDataFrame([(s.name, s.weight, s.limit, s.docs, s.tokens, mix.share.get(s.name, 0.0), mix.exponent) for s in sources], "source string, peso_alvo double, max_repeticoes int, documentos bigint, tokens_disponiveis bigint, peso_misturado double, expoente double")
    out = plan.join(used, "source", "left").na.fill(0, ["tokens_usados", "documentos_usados", "usos_maximos"])
    total = F.sum("tokens_usados").over(Window.partitionBy(F.lit(0)))  # a row a source with a target
    return out.withColumn("parte_alcancada", F.coalesce(F.try_divide(F.col("tokens_usados"), total), F.lit(0.0)))
