from conftest import rows
from pyspark.sql import functions as F

from sondar.llm.sampling import SampleConfig, stable_sample, thresholds


def frame(spark, n, extra=()):
    return spark.createDataFrame([(i, i % 4 if i % 9 else None, i // 100, "x") for i in range(n)] + list(extra), "id bigint, tipo int, carga_n int, chave string")


def pick(df, **kw):
    return {r.chave for r in stable_sample(df, "id", "tipo", "carga_n", SampleConfig(**kw)).collect()}


def test_same_on_any_layout_and_order(spark):
    df = frame(spark, 2000)
    a = pick(df)
    assert a == pick(df.repartition(13)) == pick(df.orderBy(F.desc("id")).coalesce(1)) == pick(df.unionByName(df.limit(300)))
    assert 0.07 < len(a) / 2000 < 0.13
    assert pick(df, salt="other") != a


def test_what_was_chosen_stays(spark):
    chosen = set()
    for n in (200, 700, 2000):
        now = pick(frame(spark, n))
        assert chosen <= now
        chosen = now


def test_strata_rates_and_raised_thresholds(spark, scratch):
    df = frame(spark, 2000)
    assert pick(df, rate=0.0) == set() and len(pick(df, rate=1.0)) == 2000
    some = pick(df, rate=0.05, rates=(("1", 0.5),))
    ones = {i for i in range(2000) if i % 9 and i % 4 == 1}
    assert 0.4 < len(some & ones) / len(ones) < 0.6 and len(some - ones) < 150
    high = thresholds(df, "id", "tipo", "carga_n", SampleConfig(rate=0.3))
    low = stable_sample(df, "id", "tipo", "carga_n", SampleConfig(rate=0.1), high.select("estrato", "limiar"), scratch)
    assert {r.chave for r in low.collect()} == pick(df, rate=0.3)  # a lower rate lowers nothing
    assert {r.estrato for r in high.collect()} == {"0", "1", "2", "3", ""}


def test_a_key_in_several_strata(spark):
    df = spark.createDataFrame([(1, 5, 2), (1, 4, 1), (1, None, 3), (None, 1, 1)], "id bigint, tipo int, carga_n int")
    got = rows(stable_sample(df, "id", "tipo", "carga_n", SampleConfig(rate=1.0)), "chave", "estrato", "carga")
    assert got == [(1, "4", 1)]


def test_a_late_row_of_an_earlier_load_drops_nothing(spark):
    config = {"rate": 0.1, "rates": (("1", 0.6), ("2", 0.02))}
    before = frame(spark, 2000)
    late = before.selectExpr("id", "cast(id % 3 as int) as tipo", "cast(-1 as int) as carga_n", "chave")
    assert pick(before, **config) <= pick(before.unionByName(late), **config)
    assert pick(late, **config) <= pick(before.unionByName(late), **config)


def test_ten_thousand_strata(spark):
    df = spark.range(20_000).selectExpr("id", "id % 10000 as tipo", "1 as carga_n")
    assert len(pick(df, rate=0.0, rates=tuple((str(i), 1.0) for i in range(0, 10_000, 2)))) == 10_000


def test_empty(spark):
    df = frame(spark, 10).limit(0)
    assert pick(df) == set() and thresholds(df, "id", "tipo", "carga_n", SampleConfig()).collect() == []
