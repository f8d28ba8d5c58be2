"""Reconciliation, audits of writes, ordered loads, long keys and maintained means, against plain recomputation."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from panelfold.operators import impute, quality
from panelfold.sources import sinks
from panelfold.streaming.maintained import MaintainedMeans


def test_content_differences(spark):
    schema = "k int, a string, b int"
    rows = [(k, f"t{k}", k) for k in range(200)] + [(7, "t7", 7), (None, None, 1), (None, "x", None)]
    source = spark.createDataFrame(rows, schema)
    assert quality.reconcile_content(source, source.repartition(7).select("b", "a", "k"), ["k"]).count() == 0
    other = [r for r in rows if r[0] not in (3, 9)] + [(300, "new", 1)]
    other = [(k, "changed", b) if k == 20 else (k, a, None) if k == 21 else (k, None, 5) if k == 22 else (k, a, b) for k, a, b in other]
    other.remove((7, "t7", 7))
    other[other.index((None, None, 1))] = (None, "1", None)  # a NULL that changes its place
    got = {r.k: (r.status, sorted(r.columns)) for r in quality.reconcile_content(source, spark.createDataFrame(other, schema), ["k"], parts=16).collect()}
    assert got == {
        3: ("missing", []), 9: ("missing", []), 300: ("extra", []), 20: ("changed", ["a"]), 21: ("changed", ["b"]), 22: ("changed", ["a", "b"]),
        7: ("changed", []), None: ("changed", ["a", "b"]),
    }
    with pytest.raises(ValueError):
        quality.reconcile_content(source, source.drop("b"), ["k"])


def test_digest_ignores_order_and_counts_copies(spark):
    df = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    one = sorted(map(tuple, quality.content_digest(df, ["k"], 8).collect()))
    assert one == sorted(map(tuple, quality.content_digest(df.orderBy(F.desc("k")).repartition(5), ["k"], 8).collect())) and len(one) == 8
    assert one != sorted(map(tuple, quality.content_digest(df.unionAll(df.limit(2)), ["k"], 8).collect()))


def test_audit_of_a_write(spark, tmp_path):
    df = spark.createDataFrame([(1990, None, "x"), (1992, 2.0, None), (1991, None, "y")], "year int, v double, t string")
    seen = quality.WriteAudit(spark, "facts", df.columns)
    seen.of(df).write.parquet(str(tmp_path / "f"))
    assert seen.report().collect() == quality.audit({"facts": spark.read.parquet(str(tmp_path / "f"))}).collect()
    assert seen.empty_cells() == {"year": 0, "v": 2, "t": 1}
    none = quality.WriteAudit(spark, "none", ["t"])
    none.of(df.select("t").where("false")).write.parquet(str(tmp_path / "g"))
    assert none.report().first().asDict() == {"table_name": "none", "row_count": 0, "first_period": None, "last_period": None, "null_pct": 0.0, "status": "complete"}


def test_loads_and_deletes_in_any_order(spark, tmp_path):
    """Every order of arrival gives the table that the numbers' order gives."""
    loads = {1: [(k, t, 1.0) for k in range(4) for t in (1, 2)], 3: [(1, 1, 3.0), (5, 2, 3.0)], 5: [(0, 1, 5.0)]}
    deletes = {2: [1, 2], 4: [0, 5]}
    want = {}
    for at in range(1, 6):
        for k in deletes.get(at, ()):
            want = {key: v for key, v in want.items() if key[0] != k}
        want |= {(k, t): v for k, t, v in loads.get(at, ())}
    r = random.Random(1)
    for turn in range(2):
        path, steps = str(tmp_path / f"t{turn}"), [*range(1, 6), *r.sample(range(1, 6), 3)]
        r.shuffle(steps)
        for at in steps:
            if at in deletes:
                sinks.delete_ordered(spark, path, spark.createDataFrame([(k,) for k in deletes[at]], "k int"), ["k"], "t", at)
            else:
                sinks.upsert_ordered(spark, path, spark.createDataFrame(loads[at], "k int, t int, v double"), ["k", "t"], ["v"], "t", at)
        assert {(x.k, x.t): x.v for x in sinks.read_ordered(spark, path).collect()} == want, steps


@pytest.mark.parametrize("spacing", ["position", "period"])
def test_segments_equal_one_window(spark, spacing):
    r = random.Random(2)
    rows = []
    for k, n in (("long", 300), ("b", 40), ("c", 1), ("none", 20)):
        at = sorted(r.sample(range(3 * n + 3), n))
        rows += [(k, t, None if k == "none" or r.random() < 0.8 else float(r.randint(0, 99)), None if t < n else float(t)) for t in at]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, t int, a double, b double").repartition(3)
    got = impute.interpolate_long(df, ["k"], "t", ["a", "b"], spacing, segments=9)
    want = {(x.k, x.t): (x.a, x.b) for x in impute.interpolate(df, ["k"], "t", ["a", "b"], spacing).collect()}
    found = {(x.k, x.t): (x.a, x.b) for x in got.collect()}
    assert found.keys() == want.keys() and got.columns == df.columns
    assert all(x == y or abs(x - y) < 1e-9 for key in want for x, y in zip(found[key], want[key]))
    with pytest.raises(Exception, match="repeated"):
        impute.interpolate_long(df.unionAll(df.limit(1)), ["k"], "t", ["a", "b"], spacing, segments=9).collect()
    assert impute.interpolate_long(df.where("false"), ["k"], "t", ["a"], spacing).count() == 0


def test_a_long_key_lies_in_bounded_segments(spark, monkeypatch):
    kept = []
    stage = impute.stage
    monkeypatch.setattr(impute, "stage", lambda df, label: kept.append(stage(df, label)) or kept[-1])
    df = spark.range(100_000).selectExpr("'one' AS k", "id AS t", "CASE WHEN id % 1000 = 0 THEN CAST(id AS double) END AS v")
    out = impute.interpolate_long(df, ["k"], "t", ["v"], segments=16)
    assert out.where("abs(v - least(t, 99000)) > 1e-6").count() == 0
    assert kept[0].groupBy("__segment").count().agg(F.max("count")).first()[0] < 20_000


def _means(rows):
    out = defaultdict(list)
    for _, g, v, _ in rows.values():
        out[g].append(v)
    known = lambda vs: [v for v in vs if v is not None]
    return {g: (len(vs), round(sum(known(vs)) / len(known(vs)), 6) if known(vs) else None) for g, vs in out.items()}


def test_means_follow_late_and_repeated_batches(spark, tmp_path, monkeypatch):
    r = random.Random(5)
    store = MaintainedMeans(spark, str(tmp_path / "s"), ["k"], ["g"], ["v"], "seq", buckets=4)
    rows, batches = {}, []
    for n in range(4):
        batch = [(r.randint(0, 15), r.choice("ab") if n else "c", r.choice([None, 0.1, 2.5, 7.3]), r.randint(0, 5) + n / 10) for _ in range(8)]
        batch = list({b[0]: b for b in batch}.values())
        batches.append(batch)
        for b in batch:
            if b[0] not in rows or rows[b[0]][3] <= b[3]:
                rows[b[0]] = b
        frame = spark.createDataFrame(batch, "k int, g string, v double, seq double")
        if n == 2:  # breaks off between the groups and the rows
            with monkeypatch.context() as m:
                m.setattr("panelfold.streaming.maintained.upsert_partitions", lambda *a, **k: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    store.apply(frame, f"batch{n}")
        store.apply(frame, f"batch{n}")
        got = {x.g: (x.n, None if x.v is None else round(x.v, 6)) for x in store.read().collect()}
        assert got == _means(rows)
    store.apply(spark.createDataFrame(batches[1], "k int, g string, v double, seq double"), "batch1")
    store.apply(spark.createDataFrame(batches[1], "k int, g string, v double, seq double"), "again")
    assert {x.g: (x.n, None if x.v is None else round(x.v, 6)) for x in store.read().collect()} == _means(rows)
