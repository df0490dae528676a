import datetime as dt
import random

import pytest
from conftest import rows

from sondar.operators import references, skew
from sondar.operators.references import Reference
from sondar.streaming import orphans as stream

REF = Reference("c", "ref", "id", "gone is not null", "born", "t", "k", "coalesce(btrim(off), '') in ('S')", "born")


def frames(spark, children, targets):
    return {
        "c": spark.createDataFrame(children, "id bigint, ref string, born timestamp_ntz, gone timestamp_ntz, refs int"),
        "t": spark.createDataFrame(targets, "k string, born timestamp_ntz, off string, `key` int"),
    }


def brute(children, targets):
    def number(x):
        try:
            return int(float(x.strip())) if x.strip() else None
        except ValueError:
            return "?"

    out = set()
    for id_, ref, born, gone, _ in children:
        if gone or ref is None or not ref.strip():
            continue
        hits = [t for t in targets if t[0] is not None and number(t[0]) == number(ref)]
        active = [t for t in hits if (t[2] or "").strip() != "S"]
        state = "ausente" if not hits else "excluido" if not active else "posterior" if born and all(t[1] and t[1] > born for t in active) else None
        if state:
            out.add(("c", "ref", id_, state, born and f"{born:%Y-%m}"))
    return sorted(out, key=repr)


def sample(rng, n, hot=0.3):
    day = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 9000))
    form = lambda k: rng.choice([str(k), f" {k}", f"{k}.0", f"{k}.000 ", f"{k}"])
    children = [(i, rng.choice([None, "", "  ", "abc", "-1"]) if rng.random() < 0.1 else form(7 if rng.random() < hot else rng.randint(1, 60)), day() if rng.random() > 0.05 else None, day() if rng.random() < 0.2 else None, 1) for i in range(n)]
    targets = [(form(rng.randint(1, 50)), day() if rng.random() > 0.1 else None, rng.choice([None, "N", "S", " S "]), 1) for _ in range(60) if rng.random() > 0.1]
    return children + children[:9], targets + targets[:5]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, scratch, seed, monkeypatch):
    children, targets = sample(random.Random(seed), 400)
    f = frames(spark, children, targets)
    want = brute(children, targets)
    assert rows(references.orphans(f, [REF], scratch)) == want
    # the way beyond a broadcast, with a hot key that is salted
    monkeypatch.setattr(skew.sized_join, "__defaults__", (0,))
    monkeypatch.setattr(skew.hot_keys, "__defaults__", (20,))
    assert rows(references.orphans(f, [REF], scratch)) == want


def test_nothing(spark, scratch):
    f = frames(spark, [], [])
    assert references.orphans(f, [REF], scratch).collect() == []
    f = frames(spark, [(1, "5", None, None, 1)], [])
    assert rows(references.orphans(f, [REF], scratch)) == [("c", "ref", 1, "ausente", None)]


def test_folding_in_batches_is_folding_at_once(spark, tmp_path):
    children, targets = sample(random.Random(9), 300)
    f = frames(spark, children, targets)
    ref = references.reference_deltas(references.referring(f["c"], [REF]))
    ex = references.existence_deltas(f["t"], REF)
    whole = rows(references.fold(ref, ex))
    parts = ref.unionByName(ex).randomSplit([0.3, 0.3, 0.4], seed=1)
    state = references.merge(parts[0])
    for p in parts[1:]:
        state = references.merge(state, p)
    assert rows(references.fold(state)) == whole
    # a stream of the same deltas, in batches, one of which comes twice
    for i, p in enumerate(parts):
        stream.apply_batch(p, i, str(tmp_path / "state"))
    stream.apply_batch(parts[1], 1, str(tmp_path / "state"))
    assert rows(references.fold(stream.current(spark, str(tmp_path / "state")))) == whole
    assert len(list((tmp_path / "state").glob("batch-*"))) == 2


def test_stream(spark, tmp_path):
    children, targets = sample(random.Random(4), 100)
    f = frames(spark, children, targets)
    deltas = references.reference_deltas(references.referring(f["c"], [REF])).unionByName(references.existence_deltas(f["t"], REF))
    deltas.repartition(3).write.parquet(str(tmp_path / "in"))
    q = stream.maintain(spark.readStream.schema(deltas.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")), str(tmp_path / "state"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert rows(references.fold(stream.current(spark, str(tmp_path / "state")))) == rows(references.fold(deltas))


def test_insert_delete_insert_in_a_stream_is_the_snapshot(spark, tmp_path):
    children, targets = sample(random.Random(6), 200)
    f = frames(spark, children, targets)
    refs = references.reference_deltas(references.referring(f["c"], [REF]))
    ex = references.existence_deltas(f["t"], REF)
    half, rest = refs.unionByName(ex).randomSplit([0.5, 0.5], seed=2)
    early = ex.where("active = 1").selectExpr("__ref", "__key", "timestamp_ntz '2001-01-01 00:00:00' as at", "refs", "active", "ever")
    at = str(tmp_path / "state")
    # rows come, among them some that are taken back later, and some that come, go and come again
    for i, d in enumerate((half.unionByName(early), rest.unionByName(references.retracted(half)), references.retracted(early), half)):
        stream.apply_batch(d, i, at)
    assert rows(references.fold(stream.current(spark, at))) == rows(references.fold(refs, ex))
    assert rows(stream.orphans_now(spark, at)) == rows(references.orphan_keys(references.fold(refs, ex)))
    # a row that is excluded later is the same as one that came excluded
    one = spark.createDataFrame([("9", dt.datetime(2024, 1, 1), None, 0)], "k string, born timestamp_ntz, off string, `key` int")
    gone = one.selectExpr("k", "born", "'S' as off", "key")
    now = references.merge(references.existence_deltas(one, REF), references.excluded(references.existence_deltas(one, REF)))
    assert rows(references.fold(now)) == rows(references.fold(references.existence_deltas(gone, REF)))
