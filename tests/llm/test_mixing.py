import math

from pyspark.sql import functions as F

from sondar.llm import mixing
from sondar.llm.mixing import Source


def docs(spark, spec):
    return spark.createDataFrame([(f"{s}{i}", s, t) for s, sizes in spec.items() for i, t in enumerate(sizes)], "doc_id string, source string, tokens bigint")


def test_blend_and_exponents():
    s = [Source("a", 10, 800, 0.5, 1), Source("b", 10, 200, 0.5, 2), Source("c", 0, 0, 0.2, 2)]
    assert mixing.blend(s, 0.0) == {"a": 0.8, "b": 0.2, "c": 0.0}
    assert all(abs(v - w) < 1e-9 for v, w in zip(mixing.blend(s, 1.0).values(), (0.5, 0.5, 0)))
    m = mixing.mixture(s)
    assert m.exponent == 1.0 and abs(m.budget - 800) < 1e-6  # b's 200 twice are half of 800
    m = mixing.mixture(s, budget=1000)
    # with 1000 tokens b may give 400 at most: the exponent stops where its share is 0.4
    assert 0 < m.exponent < 1 and abs(m.share["b"] - 0.4) < 1e-6 and m.budget == 1000
    assert mixing.mixture(s, budget=5000).budget <= 1000 + 1e-6  # not even the natural mix reaches it
    h = -sum(q * math.log(q) for q in (0.7, 0.3))
    m = mixing.mixture(s, entropy=h)
    assert abs(m.share["a"] - 0.7) < 1e-6


def test_shares_limits_and_layout(spark, scratch):
    spec = {"a": [10] * 300 + [37] * 20, "b": [5, 7, 11] * 20, "c": [100] * 9}
    d = docs(spark, spec)
    targets = spark.createDataFrame([("A ", 0.5, 1), ("b", 0.3, 3), ("c", 0.2, 2), ("falta", 0.1, 2)], "source string, peso_alvo double, max_repeticoes int")
    src = mixing.sources_of(d, targets)
    mix = mixing.mixture(src)
    out = mixing.collect_mixture(d, src, mix, scratch, block_tokens=300)
    again = mixing.collect_mixture(d.repartition(9), src, mix, scratch, block_tokens=300)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(out) == key(again)
    uses = {tuple(r)[:2]: r.n for r in out.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    limits = {"a": 1, "b": 3, "c": 2}
    assert all(n <= limits[s] for (s, _), n in uses.items())
    assert out.groupBy("source", "doc_id", "passagem").count().where("count > 1").isEmpty()
    rep = {r.source: r for r in mixing.report(out, src, mix).collect()}
    assert rep["falta"].tokens_usados == 0
    for s, w in (("a", 0.5 / 1.1), ("b", 0.3 / 1.1), ("c", 0.2 / 1.1)):
        assert abs(rep[s].tokens_usados - mix.budget * mix.share[s]) <= 50
        assert abs(mix.share[s] - w / (1 / 1.1)) < 1e-9
    # every block but the last few uses holds the mixture
    blocks = out.groupBy("bloco").agg(F.sum("tokens").alias("t"), F.sum(F.when(F.col("source") == "a", F.col("tokens"))).alias("a")).collect()
    assert all(abs((r.a or 0) / r.t - 0.5) < 0.25 for r in blocks if r.t > 200)


def test_odd_cases(spark, scratch):
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, peso_alvo double, max_repeticoes int")
    none = spark.createDataFrame([], "doc_id string, source string, tokens bigint")
    src = mixing.sources_of(none, targets)
    assert mixing.collect_mixture(none, src, mixing.mixture(src), scratch).collect() == []
    raw = spark.createDataFrame([("1", " A", 0, "x"), ("2", None, 5, "x"), ("3", "a ", 4, "x"), ("4", "sem alvo", 9, "x"), ("5", "", 1, "x")], "doc_id string, source string, tokens bigint, posicao string")
    d = mixing.usable(raw)
    assert sorted(r.doc_id for r in d.collect()) == ["3", "4"]
    src = mixing.sources_of(d, targets)
    out = mixing.collect_mixture(d, src, mixing.mixture(src), scratch)
    assert sorted((r.doc_id, r.passagem) for r in out.collect()) == [("3", 1), ("3", 2)]


def test_blocks_are_permuted_anew_in_every_pass(spark, scratch, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 4)
    d = docs(spark, {"a": [10] * 200, "b": [10] * 100})
    src = mixing.sources_of(d, spark.createDataFrame([("a", 0.4, 1), ("b", 0.6, 3)], "source string, peso_alvo double, max_repeticoes int"))
    out = mixing.collect_mixture(d, src, mixing.mixture(src), scratch)
    order = {p: [r.doc_id for r in out.where(f"source = 'b' and passagem = {p}").orderBy("posicao").collect()] for p in (1, 2, 3)}
    assert all(sorted(o) == sorted(order[1]) and len(o) == 100 for o in order.values()) and order[1] != order[2] != order[3]
    # blocks move as they are: most neighbours stay neighbours
    pairs = [{*zip(o, o[1:])} for o in order.values()]
    assert len(pairs[0] & pairs[1]) > 50
    assert [r.posicao for r in out.where("source = 'b'").orderBy("posicao").collect()] == list(range(0, 3000, 10))


def test_the_permutations_are_permutations():
    for bits in range(9):
        a, c = mixing._permutation("s", "f", 2, bits)
        assert sorted((a * x + c) % (1 << bits) for x in range(1 << bits)) == list(range(1 << bits))
