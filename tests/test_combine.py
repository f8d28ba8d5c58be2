import pytest
from pyspark.sql import functions as F

from panelfold.operators import combine, quality, shape, upsert


def test_merge_matches_null_keys(spark, rows):
    a = spark.createDataFrame([("x", 1, None, 1.0), ("y", 1, "Y", 2.0)], "e string, t int, c string, a double")
    b = spark.createDataFrame([("x", 1, None, 5.0), ("z", 1, "Z", 6.0)], "e string, t int, c string, b double")
    c = spark.createDataFrame([("y", 1, "Y", 9.0)], "e string, t int, c string, d double")
    out = combine.merge_feeds([a, b, c], ["e", "t", "c"])
    assert rows(out) == [("x", 1, None, 1.0, 5.0, None), ("y", 1, "Y", 2.0, None, 9.0), ("z", 1, "Z", None, 6.0, None)]


def test_merge_refuses_repeats(spark):
    a = spark.createDataFrame([("x", 1.0), ("x", 2.0)], "e string, a double")
    b = spark.createDataFrame([("x", 1.0)], "e string, b double")
    with pytest.raises(Exception, match="repeats a key"):
        combine.merge_feeds([a, b], ["e"]).collect()
    with pytest.raises(ValueError):
        combine.merge_feeds([b, b], ["e"])


def test_pivot_last_wins_first_name_kept(spark, rows):
    data = [("A", 2000, "p", 1.0, 1, "one"), ("A", 2000, "p", 2.0, 2, "two"), ("A", 2000, "q", 7.0, 0, "zero"), ("B", 2001, "zz", 1.0, 1, "b")]
    df = spark.createDataFrame(data, "k string, t int, tag string, v double, seq int, name string")
    out = combine.pivot_feeds(df, ["k", "t"], "tag", "v", ["seq"], {"P": "p", "Q": "q"}, ["name"])
    assert rows(out) == [("A", 2000, "zero", 2.0, 7.0), ("B", 2001, "b", None, None)]


def test_orphans_and_cascade(spark, rows):
    dim = spark.createDataFrame([("a", 1), ("b", -1), ("c", None)], "k string, v int")
    fact = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1), ("x", 1), (None, 1)], "k string, t int")
    assert rows(combine.orphans(fact, dim, "k"), "k") == [(None,), ("x",)]
    kept, facts = combine.cascade_delete(dim, {"f": fact}, "k", F.col("v") < 0)
    assert rows(kept, "k") == [("a",), ("c",)] and rows(facts["f"], "k") == [("a",), ("c",)]


def test_left_join_where_keeps_all_left_rows(spark, rows):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = spark.createDataFrame([("a", 2021, 1.0), ("b", 2022, 2.0)], "k string, t int, v double")
    out = combine.left_join_where(left, right, ["k"], F.col("t") == 2022)
    assert rows(out, "k", "v") == [("a", None), ("b", 2.0)]


def test_average_then_join_does_not_multiply(spark, rows):
    dim = spark.createDataFrame([("a",), ("b",)], "k string")
    f = spark.createDataFrame([("a", 1.0), ("a", 3.0)], "k string, v double")
    g = spark.createDataFrame([("a", 10.0), ("a", 20.0), ("a", 60.0)], "k string, w double")
    assert rows(combine.average_then_join(dim, {"f": (f, "v"), "g": (g, "w")}, "k")) == [("a", 2.0, 30.0), ("b", None, None)]


def test_lookup_default(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    look = spark.createDataFrame([("a", 5), ("b", None)], "k string, p int")
    assert rows(shape.with_lookup(df, look, "k", "p", 9)) == [("a", 5), ("b", 9), ("c", 9)]


KEYS, UPDATE = ["k", "t"], ["v"]
TABLE = "k string, t int, v double, name string, at timestamp"


def table(spark, data):
    return spark.createDataFrame([(*r, None) for r in data], TABLE)


def test_upsert_protects_and_is_idempotent(spark, rows):
    target = table(spark, [("a", 1, 1.0, "old"), ("b", 1, 2.0, "old"), ("c", 1, 3.0, "old")])
    source = table(spark, [("b", 1, 20.0, "new"), ("c", 1, 3.0, "new"), ("d", 1, 4.0, "new")])
    once = upsert.merge_upsert(target, source, KEYS, UPDATE, action=True)
    assert rows(once, "k", "v", "name", "_action") == [
        ("a", 1.0, "old", "untouched"), ("b", 20.0, "old", "updated"), ("c", 3.0, "old", "unchanged"), ("d", 4.0, "new", "inserted"),
    ]
    first = once.drop("_action")
    twice = upsert.merge_upsert(first, source, KEYS, UPDATE, action=True)
    assert rows(twice.drop("_action")) == rows(first)
    assert rows(upsert.upsert_counts(twice)) == [("unchanged", 3), ("untouched", 1)]


def test_upsert_stamps(spark):
    target = table(spark, [("a", 1, 1.0, "x"), ("b", 1, 2.0, "x")])
    source = table(spark, [("a", 1, 9.0, "x"), ("b", 1, 2.0, "x"), ("c", 1, 1.0, "x")])
    out = {r["k"]: r["at"] for r in upsert.merge_upsert(target, source, KEYS, UPDATE, touch=["at"]).collect()}
    assert out["a"] is not None and out["b"] is not None and out["c"] is not None  # also on a match that changes nothing


def test_upsert_null_clears_a_value(spark, rows):
    target, source = table(spark, [("a", 1, 1.0, "x")]), table(spark, [("a", 1, None, "x")])
    assert rows(upsert.merge_upsert(target, source, KEYS, UPDATE), "k", "v") == [("a", None)]


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "only")], "k string, seq int, v string")
    assert rows(upsert.latest_per_key(df, ["k"], ["seq"])) == [("a", 2, "new"), ("b", 1, "only")]


def test_find_column_prefers_keyword_order():
    cols = ["Death rate - men", "Age-standardized death RATE"]
    assert shape.find_column(["age-standardized", "death rate"], cols) == cols[1]
    assert shape.find_column(["death rate"], cols) == cols[0]
    assert shape.find_column(["none"], cols) is None
    assert shape.find_column(["x"], []) is None


def test_checked_column():
    assert shape.checked_column("a", ["a", "b"]) == "a"
    with pytest.raises(ValueError):
        shape.checked_column("a; drop", ["a"])


def test_sample_and_top(spark, rows):
    df = spark.createDataFrame([(i, i % 3) for i in range(50)], "k int, v int")
    a = rows(shape.repeatable_sample(df, 10, ["k"], 1))
    assert len(a) == 10 and a == rows(shape.repeatable_sample(df.repartition(9), 10, ["k"], 1))
    assert a != rows(shape.repeatable_sample(df, 10, ["k"], 2))
    assert len(rows(shape.repeatable_sample(df, 99, ["k"], 1))) == 50
    assert [r["k"] for r in shape.top_n(df, "v", 3, ["k"]).collect()] == [2, 5, 8]
    assert [r["k"] for r in shape.top_n(df, "v", 3, ["k"], ascending=True).collect()] == [0, 3, 6]


def test_quality_reports(spark, rows):
    df = spark.createDataFrame([("a", 1990, 1.0, 1.0), ("a", 1990, None, None), ("b", 1991, -2.0, -2.0)], "k string, year int, v double, w double")
    assert rows(quality.missing_report(df)) == [("v", 1), ("w", 1)]
    assert rows(quality.duplicate_keys(df, ["k", "year"])) == [(1, 1)]
    # a NULL on both sides is still a difference
    assert rows(quality.identical_columns(df, [("v", "w")]), "identical") == [(False,)]
    assert rows(quality.identical_columns(df.na.drop(), [("v", "w")]), "identical") == [(True,)]
    assert rows(quality.range_check(df, ["v"])) == [("v", -2.0, 1.0, 1)]
    report = quality.audit({"t": df}).first()
    assert (report["row_count"], report["first_period"], report["last_period"], report["null_pct"], report["status"]) == (3, 1990, 1991, 16.67, "incomplete")
    with pytest.raises(Exception, match="too many NULL"):
        quality.audit({"t": df}, raise_on=True).collect()
    assert quality.audit({"t": df.limit(0)}).first()["null_pct"] == 0.0
    assert rows(quality.describe_all(df, ["k"])) == [("k", 3, 2, "a", 2)]
    with pytest.raises(Exception, match="repeated key"):
        quality.assert_unique(df, ["k", "year"]).collect()
    assert quality.assert_unique(df, ["k", "year", "v"]).count() == 3
    assert rows(quality.reconcile({"t": df}, {"t": df.limit(1)})) == [("t", 3, 1, False)]


def test_describe_skips_null(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    r = quality.describe_numeric(df, ["v"]).first()
    assert (r["n"], r["mean"], r["median"], r["min"], r["max"]) == (2, 2.0, 2.0, 1.0, 3.0)
    empty = quality.describe_numeric(df.limit(0), ["v"]).first()
    assert empty["n"] == 0 and empty["median"] is None
