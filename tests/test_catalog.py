import datetime as dt

import pytest

from sondar.plans import catalog as c
from sondar.sources import catalogue, jdbc
from sondar.sources.publish import reserve, snapshot_partitions

RAW = {
    "own.root": {"pk_cols": ["id"], "foreign_keys": [{"columns": ["id"], "parent_table": "OWN.ROOT", "parent_columns": ["id"]}]},
    "child": {"pk_cols": ["cid"], "fks": [{"columns": ["id"], "parent_table": "root", "parent_columns": ["id"]}, {"columns": ["kind"], "parent_table": "kinds", "parent_columns": ["kind"]}]},
    "part": {"pk_cols": ["cid", "n"], "fks": [{"columns": ["cid"], "parent_table": "child", "parent_columns": ["cid"]}, {"columns": ["other"], "parent_table": "child", "parent_columns": ["cid"]}]},
    "kinds": {"pk_cols": ["kind"], "static": True},
}


def test_normalise():
    s = c.normalise(RAW)
    assert set(s) == {"ROOT", "CHILD", "PART", "KINDS"} and s["ROOT"].fks == () and s["KINDS"].static
    assert [f.parent for f in s["CHILD"].fks] == ["ROOT", "KINDS"]
    with pytest.raises(ValueError, match="two specs"):
        c.normalise({"a.t": {}, "b.t": {}})
    with pytest.raises(ValueError, match="does not fit"):
        c.normalise({"t": {"fks": [{"columns": ["a", "b"], "parent_table": "p", "parent_columns": ["x"]}]}})


def test_clone_plans():
    s = c.normalise(RAW)
    p = c.clone_plans(s, "ROOT", {"ROOT": {"ID"}, "CHILD": {"CID"}})
    assert not p["ROOT"].inherits and not p["CHILD"].inherits and p["PART"].inherits
    assert [k.principal for k in p["CHILD"].links] == [True] and [k.principal for k in p["PART"].links] == [True, False]
    with pytest.raises(ValueError) as e:
        c.clone_plans(c.normalise(RAW | {"lone": {"pk_cols": ["x"]}, "bare": {}}), "ROOT", {"ROOT": {"ID"}})
    assert all(x in str(e.value) for x in ("LONE", "BARE", "CHILD"))  # every problem at once
    with pytest.raises(ValueError, match="root must be cloned"):
        c.clone_plans(s, "KINDS", {})


def test_orders():
    assert c.waves({"c": ["b"], "b": ["a"], "a": []}) == ["a", "b", "c"]
    assert c.waves({"a": ["b"], "b": ["a"], "c": ["a", "b"]}) == ["a", "b", "c"]  # the circle opens at the first by name
    assert c.waves({"a": ["a", "gone"]}) == ["a"]
    s = c.normalise(RAW)
    assert c.load_order(["PART", "KINDS", "CHILD", "ROOT"], s) == ["KINDS", "ROOT", "CHILD", "PART"]
    with pytest.raises(ValueError, match="circle"):
        c.load_order(["A", "B"], c.normalise({"a": {"fks": [{"columns": ["x"], "parent_table": "b", "parent_columns": ["y"]}]}, "b": {"fks": [{"columns": ["x"], "parent_table": "a", "parent_columns": ["y"]}]}}), strict=True)
    assert c.load_order(["A", "B"], c.normalise({"a": {"fks": [{"columns": ["x"], "parent_table": "b", "parent_columns": ["y"]}]}, "b": {"fks": [{"columns": ["x"], "parent_table": "a", "parent_columns": ["y"]}]}})) == ["A", "B"]
    assert c.ancestors(s, ["PART"]) == ["CHILD", "KINDS", "PART", "ROOT"]
    assert c.shift_columns(s, "CHILD") == ["CID", "ID"] and c.shift_columns(s, "KINDS") == []


def test_open_circles():
    s = c.normalise({"a": {"pk_cols": ["x"], "fks": [{"columns": ["y"], "parent_table": "b", "parent_columns": ["y"]}, {"columns": ["usu_atualiz"], "parent_table": "u", "parent_columns": ["i"]}]}, "b": {"pk_cols": ["y"], "fks": [{"columns": ["x"], "parent_table": "a", "parent_columns": ["x"]}]}, "u": {"pk_cols": ["i"]}})
    out, dropped = c.open_circles(s)
    assert len(dropped) == 2 and sum(len(t.fks) for t in out.values()) == 1
    c.load_order(list(out), out)


def test_dictionary_dumps():
    text = " table_name ,CONSTRAINT_NAME,CONSTRAINT_TYPE,COLUMN_NAME,POSITION,R_CONSTRAINT_NAME\nO.A,PA,P,id,1,\nB,PB,P,id,1,\nB,PB,P,n,2,\nB,FB,R,a_id,1,PA\nB,FX,R,z,1,GONE\nA,FW,R,q,1,PB\n"
    s, notes = c.specs_from_constraints(text)
    assert s["B"].pk == ("ID", "N") and s["B"].fks == (c.ForeignKey(("A_ID",), "A", ("ID",)),) and len(notes) == 2
    sch = c.schema_from_dump("TABLE_NAME,COLUMN_NAME,DATA_TYPE,DATA_PRECISION,DATA_SCALE,DATA_LENGTH,NULLABLE\nB,ID,NUMBER,10,2,22,N\nB,T,VARCHAR2,,,30,Y\n", {"B": [["T"]]})
    assert sch["B"].columns == {"ID": c.ColumnRule(False, 10, 2), "T": c.ColumnRule(True, None, 0, 30)}
    found = c.clone_safety(c.normalise(RAW), {"CHILD": c.TableSchema({"ID": c.ColumnRule(), "CID": c.ColumnRule(False)}, (("NAME",), ("ID",)))}, ["ROOT", "CHILD", "PART"])
    assert ("CHILD", "unique_repete", "NAME") in found and ("CHILD", "unique_repete", "ID") not in found and ("CHILD", "fk_anulavel", "ID") in found


def test_small_planners():
    assert c.pack_by_size({"a": 5, "b": 4, "c": 3, "d": 3}, 2) == [["a", "d"], ["b", "c"]]
    assert c.copies_needed(10, 2, 7) == 3 and c.copies_needed(10, 2, 12) == 2
    with pytest.raises(ValueError):
        c.copies_needed(1, 1, 0)
    assert c.overlaps("/a/b", "/a/b/c") and c.overlaps("/a/b/", "/a/b") and not c.overlaps("/a/b", "/a/bc")
    assert snapshot_partitions(0) == 1 and snapshot_partitions(250_000) == 3 and snapshot_partitions(10**9) == 64
    led = reserve(reserve([], {"x": 10}, {"x": 99}), {"x": 5, "y": 1}, {"x": 99})
    assert [(e["name"], e["start"], e["end"]) for e in led] == [("x", 100, 109), ("x", 110, 114), ("y", 1, 1)]


def test_jdbc_planners():
    p = jdbc.date_predicates("d", dt.date(2024, 1, 1), dt.date(2024, 1, 11), 3)
    assert p == ["d < DATE '2024-01-04' OR d IS NULL", "d >= DATE '2024-01-04' AND d < DATE '2024-01-07'", "d >= DATE '2024-01-07'"]
    assert jdbc.date_predicates("d", None, None, 3) == ["1=1"] == jdbc.date_predicates("d", dt.date(2024, 1, 1), dt.date(2024, 1, 1), 3)
    groups = jdbc.extent_ranges([(1, 0, 10), (2, 100, 30), (1, 50, 5)], 4)
    blocks = [(f, b) for g in groups for f, a, z in g for b in range(a, z + 1)]
    assert len(blocks) == len(set(blocks)) == 45 and 4 <= len(groups) <= 5 and jdbc.extent_ranges([], 3) == []
    assert jdbc.row_id(0, 0, 0, 0) == "A" * 18 and jdbc.row_id(1, 2, 63, 64) == "AAAAAB" + "AAC" + "AAAAA/" + "ABA"
    assert jdbc.in_lists("k", ["a'b", 1, 2], 2) == ["k IN ('1','2')", "k IN ('a''b')"]
    assert jdbc.numeric_options("k", 1, 1, 4) == {} and jdbc.numeric_options("k", 1, 9, 4)["numPartitions"] == "4"
    assert jdbc.insert_sql("t", ["a", "b", "dt"], {"dt": "SYSDATE"}) == "INSERT INTO t (a, b, dt) VALUES (?, ?, SYSDATE)"
    assert jdbc.delete_above("t", "k", 10, 35, 10) == ["DELETE FROM t WHERE k > 10 AND k <= 20", "DELETE FROM t WHERE k > 20 AND k <= 30", "DELETE FROM t WHERE k > 30 AND k <= 35"]


def test_sql_catalogue(spark):
    text = "-- BEGIN QUERY: a\nSELECT id FROM {{RAW_T}} WHERE id > 1;\n-- END QUERY: a\n-- BEGIN QUERY: b\n-- nothing\n-- END QUERY: b\n"
    assert catalogue.section(text, "a") == "SELECT id FROM {{RAW_T}} WHERE id > 1"
    for name in ("b", "c"):
        with pytest.raises(ValueError):
            catalogue.section(text, name)
    for bad in (text + text, "-- BEGIN QUERY: a\nx", "-- BEGIN QUERY: a\n-- BEGIN QUERY: b\n"):
        with pytest.raises(ValueError):
            catalogue.sections(bad)
    got = catalogue.keys_only(catalogue.run(spark, catalogue.section(text, "a"), {"t": spark.range(4)}), "id")
    assert sorted(r.id for r in got.collect()) == [2, 3]
    with pytest.raises(ValueError):
        catalogue.keys_only(spark.range(2).selectExpr("id", "id as x"), "id")
