"""The panel that is kept up to date, against imputing all of it."""

from __future__ import annotations

import os
import random

import pytest

from panelfold.operators.impute import impute_panel
from panelfold.plans.delta import PanelStore

SCHEMA = "k string, t int, a double, b double"


def _frame(spark, rows):
    return spark.createDataFrame([(k, t, *v) for (k, t), v in rows.items()], SCHEMA)


def _stamps(root):
    return {os.path.relpath(d, root): {f: os.stat(os.path.join(d, f)).st_mtime_ns for f in files if f.endswith(".parquet")} for d, _, files in os.walk(root) if "bucket=" in d}


def _same(store, spark, rows, **how):
    want = impute_panel(_frame(spark, rows), ["k"], "t", ["a", "b"], **how).select("k", "t", "a", "b")
    assert sorted(map(tuple, store.read().collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("how", [{}, {"constant": 7.0}, {"digits": 1}])
def test_loads_equal_the_whole_history(spark, tmp_path, how):
    r = random.Random(4)
    value = lambda: r.choice([None, None, float(r.randint(0, 40))])
    keys = [f"k{i}" for i in range(12)]
    rows = {(k, t): (value(), value() if t > 2 else None) for k in keys[:9] for t in range(6)}
    rows |= {("none", t): (None, None) for t in range(6)}
    store = PanelStore(spark, str(tmp_path / "s"), ["k"], "t", ["a", "b"], buckets=2, **how)
    store.load(_frame(spark, rows))
    _same(store, spark, rows, **how)
    for _ in range(1):
        feed = {(k, t): (value(), value()) for k in r.sample(keys, 3) for t in r.sample(range(8), 3)}
        rows |= feed
        store.load(_frame(spark, feed))
        _same(store, spark, rows, **how)
        again = store.load(_frame(spark, feed))
        assert not again.rewritten and not again.moved


def test_only_what_changes_is_rewritten(spark, tmp_path):
    rows = {(f"k{i}", t): (float(i * 10 + t), 1.0) for i in range(20) for t in range(5)}
    store = PanelStore(spark, str(tmp_path / "s"), ["k"], "t", ["a", "b"], buckets=8)
    store.load(_frame(spark, rows))
    before = _stamps(tmp_path / "s")
    # One cell of the highest key: no median moves.
    rows[("k19", 3)] = (1000.0, 1.0)
    done = store.load(_frame(spark, {("k19", 3): (1000.0, 1.0)}))
    after = _stamps(tmp_path / "s")
    bucket = done.buckets[0]
    assert len(done.buckets) == 1 and done.rewritten == [(bucket, 3)] and done.ranked == [3] and done.moved == 0
    changed = {p for p in after if after[p] != before.get(p)}
    assert {p for p in changed if not p.startswith("raw")} == {f"imputed/bucket={bucket}/t=3", f"interpolated/bucket={bucket}/t=3", f"cells/bucket={bucket}"}
    assert {p.split("/")[1] for p in changed} == {f"bucket={bucket}"}
    _same(store, spark, rows)


def test_a_median_that_moves_reaches_the_rows_it_fills(spark, tmp_path):
    rows = {(f"k{i}", t): (float(i), None) for i in range(9) for t in range(3)} | {("gap", t): (None, None) for t in range(3)}
    store = PanelStore(spark, str(tmp_path / "s"), ["k"], "t", ["a", "b"], buckets=16)
    store.load(_frame(spark, rows))
    feed = {("k0", 1): (50.0, None)}
    rows |= feed
    done = store.load(_frame(spark, feed))
    assert done.moved == 1 and len(done.rewritten) == 2  # of the period; the partitions of k0 and gap
    _same(store, spark, rows)
    feed = {("k3", 2): (3.0, 8.0)}
    rows |= feed
    store.load(_frame(spark, feed))
    _same(store, spark, rows)


def test_a_load_that_broke_off_is_repeated(spark, tmp_path, monkeypatch):
    rows = {(f"k{i}", t): (float(i * t) if (i + t) % 3 else None, 2.0) for i in range(8) for t in range(4)}
    feed = {("k1", 2): (70.0, None), ("new", 1): (None, 5.0)}
    for part in ("imputed", "interpolated"):
        store = PanelStore(spark, str(tmp_path / part), ["k"], "t", ["a", "b"], buckets=2)
        store.load(_frame(spark, rows))
        write = PanelStore._overwrite

        def broken(self, df, name, by, write=write, part=part):
            if name == part:
                raise RuntimeError("lost")
            write(self, df, name, by)

        monkeypatch.setattr(PanelStore, "_overwrite", broken)
        with pytest.raises(RuntimeError):
            store.load(_frame(spark, feed))
        monkeypatch.setattr(PanelStore, "_overwrite", write)
        store.load(_frame(spark, feed))
        _same(store, spark, rows | feed)


def test_empty_feed(spark, tmp_path):
    store = PanelStore(spark, str(tmp_path / "s"), ["k"], "t", ["a", "b"])
    assert store.load(_frame(spark, {})).buckets == []
