import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from sondar.operators import checks, clone, closure, dates, keys, prefix, repair, selection, shape, similarity, skew, stats
from sondar.plans import catalog
from sondar.sources import jdbc, publish, tables


def test_key_forms(spark):
    df = spark.createDataFrame([(x,) for x in ["343.0000", " 1200 ", "1.50", "1.0", "1.", "abc.0", "", None, "-0.10"]], "k string")
    got = [tuple(r) for r in df.select(keys.norm_key(F.col("k")), keys.norm_code(F.col("k")), keys.canon_key(F.col("k"))).collect()]
    assert got == [("343", "343.0000", "343"), ("1200", "1200", "1200"), ("1.50", "1.50", "1.5"), ("1", "1", "1"), ("1.", "1.", "1"), ("abc", "abc", "abc.0"), ("", "", ""), (None, None, None), ("-0.10", "-0.10", "-0.1")]
    with pytest.raises(ValueError):
        keys.column(df, "nope")
    assert keys.column(df, "K") == "k"


def test_active_rows(spark):
    df = spark.createDataFrame([(1, None, "N"), (2, " ", "S"), (3, "2024", "1"), (4, None, None), (5, None, "Y")], "i int, dat_exclusao string, ind_excluido string")
    ids = lambda d: sorted(r.i for r in d.collect())
    assert ids(keys.active_declared(df, "dat_exclusao")) == [1, 2, 4, 5] and ids(keys.active_declared(df, "ind_excluido")) == [1, 4]
    assert ids(keys.active_null(df, "dat_exclusao")) == [1, 4, 5] and ids(keys.active_first(df, ["X", "DAT_EXCLUSAO"])) == [1, 2, 4, 5] and len(ids(keys.active_first(df, ["X"]))) == 5


def test_checks_on_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, None, 5.0), (1, "ab", 100.0), (None, "ab", None), (None, "abc", -1000.0)], "a int, b string, c double")
    got = {tuple(r)[1:3]: r.violacoes for r in checks.count_checks(df, "t", checks.column_checks(df, ["a", "b", "zz"], {"c": (4, 2)}, {"B": 2})).collect()}
    assert got == {("not_null", "a"): 2, ("not_null", "b"): 1, ("decimal_domain", "c"): 2, ("varchar_domain", "B"): 1}
    assert checks.pk_unique(df, "t", ["a"]).first().violacoes == 2  # NULLs are equal in a key
    assert checks.unique(df, "t", ["a", "b"]).first().violacoes == 0
    assert checks.fk(df, [spark.createDataFrame([(1,)], "x int")], "t", ["a"], ["x"]).first().violacoes == 0
    empty = df.limit(0)
    assert [r.violacoes for r in checks.count_checks(empty, "t", checks.column_checks(empty, ["a"], {}, {})).collect()] == [0]
    assert checks.one_pass_profile(empty, [["a"]]).count() == 4
    assert checks.alignment(["A", "x"], ["a", "b"], ["b"]) == {"desconhecidas": ["X"], "ausentes": ["B"]}
    assert checks.capacity(4, 2) == "99.99"
    assert [r.a for r in checks.sample(df, F.col("b") == "ab", ["a", "b"]).collect()] == [None, 1]


def test_closure_with_a_circle(spark, scratch):
    raw = {"r": {"pk_cols": ["rid"]}, "a": {"pk_cols": ["aid"], "fks": [{"columns": ["rid"], "parent_table": "r", "parent_columns": ["rid"]}, {"columns": ["bid"], "parent_table": "b", "parent_columns": ["bid"]}]}, "b": {"pk_cols": ["bid"], "fks": [{"columns": ["aid"], "parent_table": "a", "parent_columns": ["aid"]}]}}
    specs = catalog.normalise(raw)
    plans = catalog.clone_plans(specs, "R", {"R": {"RID"}, "A": {"AID"}, "B": {"BID"}})
    frames = {"R": spark.createDataFrame([(1,), (2,)], "RID int"), "A": spark.createDataFrame([(10, 1, None), (11, None, 100), (12, None, 101), (13, None, None)], "AID int, RID int, BID int"), "B": spark.createDataFrame([(100, 10), (101, 11), (102, 13)], "BID int, AID int")}
    prov = closure.closure(frames, plans, "R", frames["R"].where("RID = 1"), scratch)
    assert rows(prov["A"]) == [(10, 1), (11, 1), (12, 1)] and rows(prov["B"]) == [(100, 1), (101, 1)]
    assert rows(closure.rows_of(frames["A"], prov["A"], ["AID"]), "AID") == [(10,), (11,), (12,)]
    none = closure.closure(frames, plans, "R", frames["R"].limit(0), scratch)
    assert all(df.isEmpty() for df in none.values())


def test_clones(spark, scratch):
    r = spark.createDataFrame([(5, "x"), (2, "y"), (9, None)], "id int, name string")
    m = clone.key_map(r, "id")
    start = clone.next_start(9, band=10)
    out = clone.clone_root(r, "id", m, 2, start, scratch)
    assert rows(out, "id", "name", clone.K) == sorted([(20, "y", 1), (21, "y", 2), (22, "x", 1), (23, "x", 2), (24, None, 1), (25, None, 2)], key=repr) and out.schema["id"].dataType.typeName() == "integer"
    ch = spark.createDataFrame([(1, 5, 5), (2, 77, None), (3, None, 2)], "c int, id int, ordinal int")
    got = clone.remap(clone.multiply(ch, 2), "id", m, 2, start, scratch, ["c"])
    assert rows(got, "c", "id", clone.K) == sorted([(1, 22, 1), (1, 23, 2), (2, 77, 1), (2, 77, 2), (3, None, 1), (3, None, 2)], key=repr)
    rep = {x.regra: (x.esperado, x.obtido) for x in checks.clone_report(r, out, "id", 2, start, ["id"]).collect()}
    assert all(a == b for a, b in rep.values()) and clone.next_start(None) == 1 and clone.next_start(5, 0, 50) == 51
    assert clone.clone_root(r.limit(0), "id", clone.key_map(r.limit(0), "id"), 2, 1, scratch).isEmpty()
    assert rows(clone.guard_new(out, r.unionByName(out.select("id", "name").limit(2)), "id"), "id") and clone.guard_new(r.limit(0), r, "id").isEmpty()
    with pytest.raises(Exception, match="OVERFLOW|overflow"):
        clone.shift(spark.createDataFrame([(2**31 - 1,)], "k int"), ["k"], 10).collect()


def test_codes_and_control_numbers(spark, scratch):
    df = spark.createDataFrame([(1, "a", "b"), (2, "a", "a"), (3, None, None), (4, None, "a")], "id int, p1 string, p2 string")
    got = rows(clone.control_numbers(df, "id", "p1", "p2", "100"), "id", "lado", "numero")
    assert got == [(1, 1, "1000000001"), (1, 2, "1000000001"), (2, 1, "1000000002"), (2, 2, "1000000003"), (3, 1, "1000000004"), (3, 2, "1000000005"), (4, 1, "1000000006"), (4, 2, "1000000006")]
    with pytest.raises(Exception, match="9,999,999"):
        clone.control_numbers(df, "id", "p1", "p2", "100", start=9_999_999).collect()
    c = spark.range(3).select(clone.placeholder(F.col("id") + 35, "P"), clone.operation_code(F.col("id")))
    assert [tuple(r) for r in c.collect()][1] == ("P00010", "0000000000000001")
    par = spark.createDataFrame([("a", "X"), ("a", "W"), ("b", " ")], "p1 string, p2 string")
    assert rows(clone.propagate(df, par, "p1", "p2", scratch, ["id"]), "id", "p2") == sorted([(1, "W"), (2, "W"), (3, None), (4, "a")], key=repr)


def test_ordinals_on_any_layout(spark, scratch):
    rng = random.Random(5)
    data = [(rng.choice([None, rng.randint(0, 50)]), i) for i in range(500)]
    df = spark.createDataFrame(data, "a int, b int")
    want = sorted(data, key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    for parts in (1, 6):
        got = {(r.a, r.b): r.ordinal for r in prefix.ordinal(df.repartition(parts), ["a", "b"]).collect()}
        assert [got[x] for x in want] == list(range(1, 501))
    assert prefix.ordinal(df.limit(0), ["a"]).collect() == []
    h = df.withColumn("h", prefix.even_hash("b")).withColumn("g", F.coalesce("a", F.lit(-1)) % 3)
    run = prefix.running(h, ["g"], "h", ["b"], F.col("b"), F.lit(7), scratch)
    by = {}
    for r in sorted(run.collect(), key=lambda r: (r.g, r.h, r.b)):
        assert r.start == by.get(r.g, 0)
        by[r.g] = r.start + r.b


def test_salted_join_is_the_plain_join(spark, scratch):
    left = spark.createDataFrame([(i, 7 if i % 3 else i % 11 if i % 7 else None) for i in range(300)], "i int, k int")
    right = spark.createDataFrame([(k, k * 2) for k in range(0, 11, 2)] + [(7, 14), (None, 5)], "k int, v int")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = rows(left.join(right, "k", how))
        assert rows(skew.salted_join(left, right, ["k"], how, ["i"], [(7,)])) == want
        assert rows(skew.sized_join(left, right, ["k"], how, ["i"], scratch, rows=0)) == want
    assert skew.hot_keys(left, ["k"], hot_rows=50) == [(7,)]


def test_dates(spark, scratch):
    t = lambda d: dt.datetime(*d)
    df = spark.createDataFrame([(1, t((2024, 1, 1)), t((2024, 1, 11))), (2, None, t((2024, 1, 1))), (3, t((2024, 1, 5)), t((2024, 1, 1))), (4, None, None)], "id int, i timestamp_ntz, m timestamp_ntz")
    got = {r.id: (r.i.day, (r.m - r.i).days) for r in dates.preserve_term(df, "i", "m", "2026-06-30").collect()}
    assert got == {1: (30, 10), 2: (30, 30), 3: (30, 1), 4: (30, 30)}
    ch = spark.createDataFrame([(1, "2024-01-03"), (2, "2024-01-03"), (9, "x"), (1, None)], "id int, d string")
    moved = dates.shift_children(ch, "id", ["d"], dates.shifts(df, "id", "i", "2024-01-31"), scratch, ["d"])
    assert rows(moved) == sorted([(1, "2024-02-02"), (2, "2024-01-03"), (9, "x"), (1, None)], key=repr)


def test_selection(spark, scratch):
    k = spark.range(50).withColumnRenamed("id", "k")
    first = selection.page(k, "k", "s", 10)
    last = first.orderBy(F.desc("posto")).first()
    second = selection.page(k.repartition(7), "k", "s", 10, (last["posto"], last["k"]))
    assert {r.k for r in first.collect()}.isdisjoint({r.k for r in second.collect()})
    got = selection.choose(k, "k", 20, "s", lambda x: x.where("k % 2 = 1"), scratch)
    assert got.count() == 20 and got.where("k % 2 = 1").isEmpty()
    with pytest.raises(ValueError, match="25 of 30"):
        selection.choose(k, "k", 30, "s", lambda x: x.where("k % 2 = 1"), scratch)
    with pytest.raises(ValueError, match="rejected"):
        selection.choose(k, "k", 0, "s", lambda x: x.where("k = 1"), scratch, explicit=True)
    c = spark.createDataFrame([("1.0",), (" 2",), ("",), (None,), ("9",), ("9.0",)], "r string")
    assert rows(selection.missing_keys(c, "r", spark.createDataFrame([(1,), (2,)], "x bigint"), "x", "t")) == [("t", "r", "9")]


def test_repair_and_frames(spark, scratch):
    df = spark.createDataFrame([(1, "5.0", "a"), (2, "6", None), (3, None, "c")], "id int, ref string, __hit string")
    lost = spark.createDataFrame([("T", "REF", "5"), ("T", "OUTRA", "6")], "TABELA string, COLUNA string, VALOR string")
    out = repair.repair(df.drop("__hit"), "ref", lost, "t", scratch)
    assert rows(out) == sorted([(1, None), (2, "6"), (3, None)], key=repr)
    assert [r.violacoes for r in repair.repair_report(df.drop("__hit"), out, "ref", ["id"]).collect()] == [0, 0]
    assert rows(repair.frame_differences(df, df.where("id < 3").withColumn("ref", F.when(F.col("id") == 1, "x").otherwise(F.col("ref"))), ["id"])) == [(1, "diferente"), (3, "so_esperado")]


def test_shapes(spark):
    u = spark.createDataFrame([(1,), (2,), (3,), (None,), (1,)], "r int")
    m = spark.createDataFrame([(1,), (1,), (2,), (None,), (99,)], "x int")
    c, skipped = shape.counts(u, "r", [shape.Metric("a", m, "x"), shape.Metric("b", None, "x")])
    assert rows(c) == sorted([(1, 2, None), (2, 1, None), (3, 0, None)], key=repr) and skipped == ["b"]
    d = {r.assinatura: (r.n, r.exemplos) for r in shape.distribution(c, "r", ["a", "b"]).collect()}
    assert d == {"a=2": (1, "1"), "a=1": (1, "2"), "a=0": (1, "3")}
    assert shape.fingerprint(u, "r").first() == shape.fingerprint(u.repartition(3).distinct(), "r").first() != shape.fingerprint(u.where("r > 1"), "r").first()
    assert shape.counts(u.limit(0), "r", [shape.Metric("a", m, "x")])[0].isEmpty()


def test_similarity_against_brute_force(spark, scratch):
    rng = random.Random(2)
    a = [(rng.choice("abcdefgh") * rng.randint(1, 40), rng.gauss(0, 1), i) for i in range(600)]
    b = [(rng.choice("fghijkl") * rng.randint(1, 40) + " ", rng.gauss(0.3, 1), i) for i in range(500)] + [("", float("nan"), None), (None, float("inf"), None), ("x", -0.0, None)]
    f = {"t1": spark.createDataFrame(a, "s string, d double, k int"), "t2": spark.createDataFrame(b, "s string, d double, k int")}
    plan = similarity.plans(f, {"t1": {"k"}, "t2": {"k"}})
    v = scratch.keep(similarity.value_counts(f, plan))
    p = similarity.profiles(v)
    pairs = similarity.pairs(p)
    x, y = {s.strip().upper() for s, *_ in a if s and s.strip()}, {s.strip().upper() for s, *_ in b if s and s.strip()}
    want = len(x & y) / len(x | y)
    assert abs(similarity.jaccard(v, pairs).where("coluna_a = 's'").first().jaccard - want) < 1e-12
    sk = similarity.sketch_jaccard(v, pairs, similarity.SimilarityConfig(sketch=100), over=0).where("coluna_a = 's'").first()
    assert sk.amostra == 100 and sk.baixo <= want <= sk.alto
    exact = similarity.sketch_jaccard(v, pairs, over=0).where("coluna_a = 's'").first()
    assert abs(exact.jaccard - want) < 1e-12
    prof = {(r.tabela, r.coluna): r for r in p.collect()}
    assert prof["t2", "d"].invalidos == 2 and prof["t2", "d"].rota == "psi" and prof["t2", "s"].nulos == 2
    r = similarity.ranked(v, p, scratch)
    cuts = similarity.cuts(r, spark)
    bins = similarity.binned(r, cuts)
    assert similarity.integrity(p, bins).isEmpty() and bins.agg(F.sum("n")).first()[0] == 600 + 501
    assert 0 < similarity.psi(bins, pairs).first().psi < 0.5
    assert similarity.bottom_k(v, 5).groupBy("tabela", "coluna").count().where("count > 5").isEmpty()


def test_stats(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (5.0,), (3.0,)], "v double")
    r = stats.summary(df, ["v"], (0.5,)).first()
    assert (r.n, r.nulos, r.minimo, r.maximo, r.media, r["p0.5"]) == (5, 2, 1.0, 5.0, 3.0, 3.0)
    assert [x.n for x in stats.histogram(df, "v", 1.0, 5.0, 4).orderBy("faixa").collect()] == [1, 0, 1, 1]
    assert stats.coverage(df, df.where("v < 4"), ["v"]).first().cobertura == 0.5
    two, none = spark.createDataFrame([(2.0,)], "v double"), spark.createDataFrame([(None,)], "v double")
    assert [stats.coverage(a, b, ["v"]).first().cobertura for a, b in ((two, df), (two, df.where("v > 2")), (none, df))] == [1.0, 0.0, None]
    assert stats.null_rates(df.limit(0)).first().parte == 0.0 and stats.summary(df.limit(0), ["v"]).first().n == 0


def test_publish(spark, tmp_path):
    base = str(tmp_path / "out")
    a = spark.range(5)
    assert publish.publish(spark, {"a": a, "b": a.limit(0)}, base) == {"a": 5, "b": 0}
    assert publish.publish(spark, {"a": a.limit(2)}, base) == {"a": 2}
    assert spark.read.parquet(f"{base}/a").count() == 2 and not (tmp_path / "out" / "b").exists()
    assert [p.name for p in tmp_path.iterdir()] == ["out"]  # nothing staged is left
    with pytest.raises(FileExistsError):
        publish.publish(spark, {"a": a}, base, require_absent=True)
    with pytest.raises(ValueError, match="overlaps"):
        publish.publish(spark, {"a": a}, base, [base + "/a"])
    with pytest.raises(Exception):  # noqa: B017
        publish.publish(spark, {"a": a, "b": a.select(F.raise_error(F.lit("no")).alias("x"))}, base)
    assert spark.read.parquet(f"{base}/a").count() == 2 and [p.name for p in tmp_path.iterdir()] == ["out"]
    path = publish.artefact(spark, str(tmp_path / "art"), "plano", {"b": 1, "a": [1, 2]})
    assert publish.artefact(spark, str(tmp_path / "art"), "plano", {"a": [1, 2], "b": 1}) == path
    assert publish.read_artefact(spark, path) == {"a": [1, 2], "b": 1}
    publish.run_directory(spark, str(tmp_path / "runs"), "r1", {"a": a})
    assert (tmp_path / "runs" / "LATEST.json").exists()
    publish.run_directory(spark, str(tmp_path / "runs"), "r2", {"a": a})
    assert publish.latest(spark, str(tmp_path / "runs"))["run"] == "r2"
    parts = str(tmp_path / "parts")
    publish.write_partitioned(spark.range(9).selectExpr("id", "id % 3 as x", "id % 2 as y"), parts, ["x", "y"])
    got = spark.read.parquet(parts).where(publish.identities(["x", "y"], [(0, 0), (2, 1)]))
    assert sorted(r.id for r in got.collect()) == [0, 5, 6] and spark.read.parquet(parts).where(publish.identities(["x"], [])).isEmpty()
    assert tables.optional_table(spark, base, "none") is None and list(tables.tables(spark, base, ["none"])) == []


def test_rows_appended_with_database_expressions(spark):
    calls = []

    class Cursor:
        def executemany(self, sql, data):
            calls.append((sql, list(data)))

    class Connection:
        def cursor(self):
            return Cursor()

        commit = rollback = close = lambda self: None

    class Local:  # runs partitions here, as tasks would
        columns = ["a", "b"]

        def foreachPartition(self, f):
            f(iter([(1, "x"), (2, "y"), (3, "z")]))

    jdbc.append_computed(Local(), Connection, "t", {"b": "USER"}, batch=2)
    assert calls == [("INSERT INTO t (a, b) VALUES (?, USER)", [(1,), (2,)]), ("INSERT INTO t (a, b) VALUES (?, USER)", [(3,)])]


def test_exact_jaccard_has_no_largest_set(spark, scratch):
    f = {t: spark.createDataFrame([(f"v{i}",) for i in range(low, low + 300)], "s string") for t, low in (("t1", 0), ("t2", 100))}
    v = scratch.keep(similarity.value_counts(f, similarity.plans(f)))
    got = similarity.jaccard(v, similarity.pairs(similarity.profiles(v)), similarity.SimilarityConfig(exact_limit=100)).collect()
    assert [(r.comuns, r.jaccard) for r in got] == [(200, 0.5)]


def test_a_side_of_few_but_wide_rows_is_not_broadcast(spark, scratch, monkeypatch):
    left = spark.range(50).selectExpr("id % 5 as k", "id")
    right = spark.range(5).selectExpr("id as k", "sha2(cast(id as string), 256) as w")
    plan = lambda df: df._jdf.queryExecution().toString()
    small = skew.sized_join(left, right, ["k"], "inner", ["id"], scratch)
    assert "strategy=broadcast" in plan(small)
    monkeypatch.setattr(skew, "BROADCAST_BYTES", 10)
    wide = skew.sized_join(left, right, ["k"], "inner", ["id"], scratch)
    assert "strategy=broadcast" not in plan(wide) and rows(wide, "k", "id", "w") == rows(small, "k", "id", "w")


def test_report_of_findings(spark):
    f = spark.createDataFrame([("t", "fk", "a", None), ("t", "not_null", "b", 0), ("t", "unique", "c", 3)], checks.FINDING)
    doc, text, code = checks.report(f)
    assert (doc["verificacoes"], doc["violadas"], doc["nao_verificaveis"], code) == (3, 1, 1, 1)
    assert text.splitlines() == ["3 checks, 1 broken, 1 not verifiable", "  t unique (c): 3", "  t fk (a): not verifiable"]
    assert checks.report(f.where("violacoes = 0"))[2] == 0 and checks.report(f.limit(0))[0]["achados"] == []


def test_a_table_replaced_by_what_is_read_from_it(spark, tmp_path):
    path = str(tmp_path / "base" / "t")
    assert publish.replace_table(spark.range(5), path) == 5
    assert publish.replace_table(spark.read.parquet(path).where("id > 1"), path) == 3
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [2, 3, 4]
    assert [p.name for p in (tmp_path / "base").iterdir()] == ["t"]
