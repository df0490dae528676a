import datetime as dt
from decimal import Decimal

from conftest import rows

from sondar.operators import compare

A = "k bigint, nome string, sit int, val decimal(18,2), em timestamp_ntz, so_a string, campo string"
B = "k string, nome string, sit int, val double, em timestamp_ntz, situacao string, campo string"
T = dt.datetime(2024, 5, 1, 10, 0, 0, 123456)


def test_differences(spark, scratch):
    a = spark.createDataFrame([(1, "Ação ", 1, Decimal("10.50"), T, "x", "f"), (1, "Ação ", 1, Decimal("10.50"), T, "x", "f"), (2, None, None, None, None, "x", None), (3, "b", 1, Decimal("2.00"), T, "x", "f"), (4, "só aqui", 1, None, None, "x", "f"), (None, "sem", 1, None, None, "x", "f"), (None, None, 1, None, None, "x", "f")], A)
    b = spark.createDataFrame([("1.0", " Ação", 1, 10.4999999, T.replace(microsecond=9), "y", "f"), (" 2 ", "  ", None, None, None, "y", ""), ("3", "B", 2, None, T.replace(second=1), "y", "f"), ("05", "só lá", 1, None, None, "y", "f"), ("abc", "sem", 1, None, None, "y", "f")], B)
    got = rows(compare.found(compare.differences(a, b, "k", scratch), "t"))
    assert got == sorted([("t", 3, "nome", "valor"), ("t", 3, "sit", "valor"), ("t", 3, "val", "valor"), ("t", 3, "em", "valor"), ("t", 4, "", "so_origem"), ("t", 5, "", "so_destino"), ("t", None, "", "so_origem"), ("t", None, "", "so_origem"), ("t", None, "", "so_destino")], key=repr)
    d = {r.chave: r for r in compare.differences(a, b, "k", scratch).where("situacao = 'valor'").collect()}
    assert {(x.campo, x.esquerda, x.direita) for x in d[3].difs} >= {("nome", "b", "B"), ("val", "2.00", None), ("sit", "1", "2")}


def test_versions_of_a_key(spark, scratch, monkeypatch):
    a = spark.createDataFrame([(1, x, 1) for x in "abc"] + [(2, "q", 1), (3, "m", 1), (3, "n", 1)], "k bigint, nome string, sit int")
    b = spark.createDataFrame([(1, x, 1) for x in "ab"] + [(2, "q", 1), (3, "n", 1), (3, "o", 1)], "k bigint, nome string, sit int")
    # a row that one side lacks is one-sided; equal rows cancel, so that m meets o
    want = [("t", 1, "", "so_origem"), ("t", 3, "nome", "valor")]
    assert rows(compare.found(compare.differences(a, b, "k", scratch), "t")) == want
    monkeypatch.setattr(compare, "VERSION_ROWS", 2)
    assert rows(compare.found(compare.differences(a, b, "k", scratch), "t")) == want
    assert compare.found(compare.differences(a, a.repartition(7), "k", scratch), "t").collect() == []


def test_one_missing_row_among_thousands(spark, scratch, monkeypatch):
    a = spark.range(4000).selectExpr("7L as k", "format_string('n%05d', id) as nome")
    b = a.where("nome <> 'n01234'")
    want = [(7, 1, "so_origem")]
    pick = lambda d: rows(d.where("situacao <> 'igual'"), "chave", "versao", "situacao")
    assert pick(compare.differences(a, b, "k", scratch)) == want
    c = b.where("nome <> 'n03000'").unionAll(spark.sql("select 7L as k, 'novo' as nome"))
    for rows_ in (10**6, 10):
        monkeypatch.setattr(compare, "VERSION_ROWS", rows_)
        assert pick(compare.differences(a, b, "k", scratch)) == want
        got = compare.differences(a, c, "k", scratch).where("situacao <> 'igual'")
        assert rows(got, "versao", "situacao", "difs") == [(1, "valor", [("nome", "n01234", "novo")]), (2, "so_origem", [("nome", "n03000", None)])]


def test_versions_pair_alike_at_any_size(spark, scratch, monkeypatch):
    a = spark.createDataFrame([(k, f"n{i:03}" if i else None, 1) for k in (1, 2) for i in range(60)], "k bigint, nome string, sit int")
    b = spark.createDataFrame([(k, f"n{i:03}" if i else None, 1 if i < 50 else 2) for k in (1, 2) for i in range(58)], "k bigint, nome string, sit int")
    want = rows(compare.differences(a, b, "k", scratch))
    assert sorted(r[2:4] for r in want if r[3] != "igual" and r[0] == 1) == [*((i, "valor") for i in range(1, 9)), (9, "so_origem"), (10, "so_origem")]
    monkeypatch.setattr(compare, "VERSION_ROWS", 2)
    assert rows(compare.differences(a.repartition(5), b.repartition(3), "k", scratch)) == want


def test_keys_that_are_no_number(spark, scratch):
    a = spark.createDataFrame([("A-1", "x"), (" A-2", "x"), (None, "p"), ("", "q"), (" ", "r")], "k string, nome string")
    b = spark.createDataFrame([("A-1 ", "y"), (None, "q")], "k string, nome string")
    got = rows(compare.found(compare.differences(a, b, "k", scratch), "t"))
    assert got == sorted([("t", None, "nome", "valor"), ("t", None, "", "so_origem"), ("t", None, "", "so_origem"), ("t", None, "", "so_origem")], key=repr)
    d = compare.differences(a, b, "k", scratch)
    assert rows(d.where("texto_chave <> ''"), "texto_chave", "situacao") == [("A-1", "valor"), ("A-2", "so_origem")]


def test_empty_sides(spark, scratch):
    a = spark.createDataFrame([(1, "x")], "k bigint, nome string")
    assert rows(compare.found(compare.differences(a, a.limit(0), "k", scratch), "t")) == [("t", 1, "", "so_origem")]
    assert rows(compare.found(compare.differences(a.limit(0), a, "k", scratch), "t")) == [("t", 1, "", "so_destino")]
    assert compare.differences(a.limit(0), a.limit(0), "k", scratch).collect() == []
    assert compare.found(compare.differences(a.select("k"), a.select("k"), "k", scratch), "t").collect() == []
    long = spark.createDataFrame([(1, "é" * 300_000)], "k bigint, nome string")
    assert compare.found(compare.differences(long, long, "k", scratch), "t").collect() == []
