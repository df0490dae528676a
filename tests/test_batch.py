import pytest
from conftest import rows
from pyspark.sql import functions as F

from sondar.operators import keys, preflight
from sondar.plans import batch, catalog


def plan():
    raw = {"r": {"pk_cols": ["id"]}, "c": {"pk_cols": ["id", "n"], "fks": [{"columns": ["id"], "parent_table": "r", "parent_columns": ["id"]}]}}
    plans = catalog.clone_plans(catalog.normalise(raw), "R", {"R": {"ID"}})
    return batch.batch_plan("x", plans, {"R": 10, "C": 30}, 2, {"R": 101}, {"R": "abc"})


def test_plan_and_reservation():
    p = plan()
    batch.check_plan(p)
    assert p == plan() and p["tables"]["C"]["start"] is None and p["tables"]["R"]["keys"] == 20
    with pytest.raises(ValueError, match="changed"):
        batch.check_plan(p | {"factor": 3})
    ok = {"R": {"start": 101, "end": 120, "plan": p["id"]}}
    assert batch.check_reservation(p, ok, {"R": 100}) == []
    assert len(batch.check_reservation(p, ok, {"R": 101})) == 1  # keys came in the meantime
    assert len(batch.check_reservation(p, {"R": {"start": 50, "end": 60, "plan": "other"}}, {})) == 3
    assert batch.check_reservation(p, {}, {}) == ["R: no range"]


def test_ledger_changes_survive_others():
    state = {"v": 0, "d": {"n": 0}}
    others = [True, True, False]

    def read():
        return state["v"], dict(state["d"])

    def write(new, version):
        if others and others.pop(0):  # someone else was faster
            state["v"] += 1
            state["d"] = {"n": state["d"]["n"] + 100}
        if version != state["v"]:
            return False
        state["v"], state["d"] = state["v"] + 1, new
        return True

    assert batch.compare_and_swap(read, write, lambda s: {"n": s["n"] + 1}, pause=0) == {"n": 201}
    with pytest.raises(RuntimeError):
        batch.compare_and_swap(read, lambda *_: False, dict, attempts=2, pause=0)
    held = []
    with batch.lease("l", lambda t: not held and not held.append(t), held.clear):
        with pytest.raises(TimeoutError), batch.lease("l", lambda t: not held, held.clear, wait=0.1, pause=0.01):
            pass
    assert held == []


def test_schedule():
    done = []

    def run(j):
        if j == "bad":
            raise ValueError(j)
        done.append(j)

    got = batch.schedule({"a": set(), "b": {"a"}, "bad": set(), "c": {"bad"}, "d": {"c", "b"}, "e": {"gone"}}, run)
    assert got == {"a": "feito", "b": "feito", "bad": "falhou", "c": "pulado", "d": "pulado", "e": "feito"}
    assert done.index("a") < done.index("b")
    with pytest.raises(ValueError, match="circle"):
        batch.schedule({"x": {"y"}, "y": {"x"}}, run)
    assert batch.schedule({}, run) == {}


def test_preflight(spark):
    df = spark.createDataFrame([(1, "é" * 3, 99.5, 5), (1, "abc", 100.0, None), (None, None, None, 7)], "id int, t string, v double, fk int")
    T = preflight.Target
    got = {tuple(r)[1:3]: r.violacoes for r in preflight.preflight(df, "x", {"id": T(nullable=False), "t": T(octets=5), "v": T(precision=4, scale=2), "outra": T(nullable=False)}, [["id"]], {"id": spark.createDataFrame([(1,)], "id int")}, {("fk",): (spark.createDataFrame([(5,)], "k int"), ("k",))}).collect()}
    assert got == {("alinhamento", "desconhecidas"): 1, ("alinhamento", "ausentes"): 1, ("octetos", "t"): 1, ("capacidade", "v"): 1, ("nulo", "id"): 1, ("unique", "id"): 1, ("ja_no_destino", "id"): 1, ("pai_estatico", "fk"): 1}
    none = preflight.preflight(df.limit(0), "x", {"id": T(nullable=False), "t": T(), "v": T(), "fk": T()}, [["id"]])
    assert none.where("violacoes <> 0").isEmpty()


def test_load_helpers(spark):
    df = spark.createDataFrame([(1,), (5,), (9,), (None,)], "k int")
    assert rows(preflight.roll_back(df, "k", 4)) == sorted([(1,), (None,)], key=repr)
    assert rows(preflight.roll_back(df, "k", None, 8)) == sorted([(9,), (None,)], key=repr)
    assert preflight.load_marks({"t": (df, "k"), "e": (df.limit(0), "k")}).orderBy("tabela").collect()[0].maximo is None
    assert preflight.single_value(spark.createDataFrame([(3,), (3,), (None,)], "k int"), "k") == 3
    with pytest.raises(ValueError):
        preflight.single_value(df, "k")
    m = spark.createDataFrame([(1, 10, "A1"), (2, 11, "A2"), (4, 11, "B")], "o int, k int, c string")
    assert {r.regra: r.violacoes for r in preflight.ordinal_consistency(m, "o", "k", "c", "^A", 1).collect()} == {"ordinal_denso": 1, "chave_repetida": 1, "codigo_repetido": 0, "formato": 1}
    assert preflight.shift_report({"t": (df, "k")}, 3, {"t": 10}).first()[1:] == (1, 9, 4, 12, True, True)
    got = preflight.explain_key("5", {"a": (df, "k"), "b": (df.where("k < 5"), "k")}, keys.norm_key)
    assert [(r.etapa, r.linhas) for r in got.orderBy("etapa").collect()] == [("0:a", 1), ("1:b", 0)]
    r = spark.createDataFrame([(1, "A"), (2, "A"), (3, "b")], "id int, c string")
    ch = spark.createDataFrame([(1, "A", 1, 1), (2, "X", 1, 1), (3, None, 1, None), (9, "q", None, None)], "id int, c2 string, p int, q int")
    assert {x.regra: x.violacoes for x in preflight.business_keys(r, "id", "c", "^[A-Z]$", ch, "c2", ["p", "q"]).collect()} == {"formato": 1, "codigo_repetido": 1, "tupla_incompleta": 1, "tupla_repetida": 1, "codigo_da_raiz": 2}
    assert rows(preflight.without_child(r, "id", ch.where(F.col("p").isNotNull()))) == []
