"""What the larger tables brought out, on small rows of their own."""

from __future__ import annotations

import datetime
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelfold.checks import joining, loading, testbed
from panelfold.llm import quality, queries, toxicity
from panelfold.operators import combine
from panelfold.operators.upsert import latest_per_key
from panelfold.streaming import maintained


@pytest.fixture
def shuffled_joins(spark):
    """Joins as between large tables: none is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_merge_with_shuffled_joins(spark, tmp_path, shuffled_joins):
    day = [datetime.datetime(y, 5, 1) for y in (1997, 1998)]
    orders = [
        (1, 10, "F", 100.0, day[0], "5-LOW"), (2, 10, "F", 100.0, day[1], "5-LOW"), (3, 11, "O", 100.0, day[1], "2-HIGH"), (4, 12, "P", 100.0, day[1], "2-HIGH"),
    ]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(orders, schema).write.parquet(str(tmp_path / "orders.parquet"))
    got = sorted(map(tuple, loading.upsert_merge(spark, str(tmp_path)).collect()))
    assert got == [
        (1, 10, 100.0, "5-LOW", "untouched"), (2, 10, 100.0, "5-LOW", "unchanged"), (3, 11, 101.0, "2-HIGH", "updated"), (4, 12, 101.0, "0-NEW", "inserted"),
    ]


def test_panel_shuffles_each_row_once_a_key(spark, tmp_path, shuffled_joins):
    """Facts are joined as they were grouped: one shuffle by (country, year) each, and line items pass one by their order."""
    day = [datetime.datetime(y, 5, 1) for y in (1997, 1998)]
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "X", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "a", 0, 5.0, "BUILDING")], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "orders": (
            [(1, 1, "F", 10.0, day[0], "1-URGENT"), (1, 1, "F", 20.0, day[0], "1-URGENT"), (2, 1, "F", 30.0, day[1], "2-HIGH")],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
        "lineitem": (
            [(1, 2.0, 1.0, 0.01, day[0]), (1, 3.0, None, 0.02, day[0]), (2, 4.0, 1.5, None, day[0]), (2, 4.0, 1.5, 0.0, None), (None, 9.0, 9.0, 0.0, day[0]), (2, 5.0, 2.5, 0.03, day[1])],
            "l_orderkey long, l_quantity double, l_extendedprice double, l_tax double, l_shipdate timestamp",
        ),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    facts = {r.year: r for r in testbed.fact_cardiovascular(spark, str(tmp_path)).collect()}
    # order 1 is there twice, so each of its lines counts twice
    assert {y: (r.deaths_total, r.high_sbp_deaths, r.smoking_deaths, r.deaths_per_100k) for y, r in facts.items()} == {
        1997: (500, 14.0, 6.0, 350 / 50000), 1998: (100, 5.0, 3.0, 250 / 10000), None: (100, 4.0, 0.0, 150 / 10000),
    }
    panel = testbed.panel(spark, str(tmp_path))
    assert sorted(r.year for r in panel.collect()) == [1997, 1998]
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", panel._jdf.queryExecution().sparkPlan().toString() + panel._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1])
    by = [tuple(re.sub(r"#\d+L?", "", k).split(", ")) for k in keys]
    assert sum(k[0] == "l_orderkey" for k in by) == 1 and sum(k == ("country_code", "year") or len(k) == 2 for k in by) == 4, by


def test_a_landed_file_is_not_one_tasks(spark, tmp_path, monkeypatch):
    """The rows of a batch that comes in one partition are dealt before they are reduced by key."""
    seen = []

    def reduced(rows, keys, order):
        every = F.sum(F.xxhash64(*rows.columns) % 7)  # so that no column is left out of the dealing
        parts = rows.groupBy(F.spark_partition_id()).agg(F.count("*").alias("count"), every).collect()
        seen.append([r["count"] for r in parts])
        return latest_per_key(rows, keys, order)

    monkeypatch.setattr(maintained, "latest_per_key", reduced)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        batch = spark.range(100_000).selectExpr("id % 99999 AS k", "id % 3 AS g", "double(id) AS v", "id AS seq").coalesce(1)
        store = maintained.MaintainedMeans(spark, str(tmp_path / "s"), ["k"], ["g"], ["v"], "seq", buckets=2)
        store.apply(batch, "one")
        assert sum(r.n for r in store.read().collect()) == 99_999
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(seen[0]) > 1 and max(seen[0]) < 60_000, seen


def test_every_labelled_text_is_a_training_row(spark):
    documents = spark.range(17_000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    labels = spark.range(17_000).selectExpr("id AS doc_id", "int(id % 2) AS toxic")
    rows = toxicity.training_rows(documents, labels, "toxic", F.col("doc_id") % 3 != 1)
    assert rows.count() == sum(i % 3 != 1 for i in range(17_000))
    training = []
    with pytest.MonkeyPatch.context() as m:
        m.setattr(queries.quality, "fit", lambda rows, label: training.append(rows.count()) or quality.Ensemble((), 0.0))
        m.setattr(queries, "read", lambda spark, d, name: {"documents": documents, "labels": labels.withColumnRenamed("toxic", "quality")}[name])
        queries.QUERIES["op2_quality"](spark, "")
    assert training == [sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in range(17_000))]


def test_texts_that_train_nothing_are_not_moved(spark, shuffled_joins, monkeypatch):
    """A short list of labels goes to the texts; a longer one has them shuffled without those it cannot hold."""
    documents = spark.range(3000).selectExpr("id AS doc_id", "concat('t', id) AS text")
    labels = spark.range(0, 6000, 10).selectExpr("id AS doc_id", "int(id % 20 = 0) AS toxic").union(spark.createDataFrame([(0, 0), (None, 1), (10, None)], "doc_id long, toxic int"))
    want = [(i, f"t{i}", int(i % 20 == 0)) for i in range(0, 3000, 10) if i % 3 != 1]
    rows = toxicity.training_rows(documents, labels, "toxic", F.col("doc_id") % 3 != 1)
    assert "Exchange hashpartitioning" not in rows._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, rows.collect())) == want
    monkeypatch.setattr(toxicity.sizing, "BROADCAST_BYTES", 0)
    rows = toxicity.training_rows(documents, labels, "toxic", F.col("doc_id") % 3 != 1)
    assert sorted(map(tuple, rows.collect())) == want
    chosen = labels.where("toxic IS NOT NULL").select(F.col("doc_id").alias("row")).distinct()
    assert toxicity._possible(documents.withColumnRenamed("doc_id", "row"), chosen).count() < 600  # of 3,000, 300 of them chosen


def test_quality_takes_the_statistics_of_a_text_once(spark):
    """Fitting and scoring by stored statistics is the same as by texts, and no text is moved."""
    docs = spark.createDataFrame([(i, None if i == 7 else "Good words. " * (i % 9) if i % 2 else "BUY! | " * (i % 11), i % 2) for i in range(200)], "doc_id long, text string, good int").coalesce(1)
    by_text = quality.fit(docs, "good")
    held = quality.measured(docs)
    assert held.columns == ["doc_id", "good", "statistics"] and quality.fit(held, "good") == by_text
    scores = [sorted((r.doc_id, r.score) for r in df.collect()) for df in (quality.score_texts(docs, by_text), quality.score_texts(held, by_text, statistic="statistics"))]
    assert scores[0] == scores[1] and len({s for _, s in scores[0]}) > 1


def test_calibration_sums_equal_the_whole(spark):
    r = np.random.default_rng(3)
    x = np.column_stack([np.ones(300), r.normal(size=(300, 3))])
    y = (x @ [0.5, 2.0, -1.0, 0.0] + r.normal(size=300) > 0).astype(int)
    df = spark.createDataFrame([(*map(float, a), int(b)) for a, b in zip(x, y)], "a double, b double, c double, d double, y int").repartition(5)
    w = toxicity._logistic(df, ["a", "b", "c", "d"], "y")
    p = 1 / (1 + np.exp(-x @ w))
    assert np.abs(x.T @ (p - y) + 1e-2 * w).max() < 1e-6  # the penalised likelihood has no slope there


def test_orders_are_reduced_once_for_all_feeds(spark, tmp_path):
    day = [datetime.datetime(y, 5, 1) for y in (1997, 1998)]
    orders = [
        (1, 7, "F", 1.0, day[0], "5-LOW"), (2, 7, "F", 2.0, day[0], "2-HIGH"), (2, 7, "F", 2.0, day[0], "2-HIGH"), (3, 7, "O", None, day[1], "5-LOW"),
        (4, None, "P", 3.0, None, None),
    ]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(orders, schema).write.parquet(str(tmp_path / "orders.parquet"))
    feeds = loading._feeds(spark, str(tmp_path), ["a", "b", "c", "d", "e"])
    got = [sorted(map(tuple, f.select("Entity", "Year", f.columns[3]).collect()), key=str) for f in feeds]
    text = lambda cents: str(cents / 65536)
    assert got == [
        [("E7", 1997, text(200)), ("E7", 1998, None), (None, None, text(300))], [("E7", 1997, text(200))], [("E7", 1997, text(200))],
        [("E7", 1997, text(100)), ("E7", 1998, None)], [("E7", 1998, None)],
    ]
    assert all("Exchange" not in f._jdf.queryExecution().executedPlan().toString() for f in feeds)


def test_pages_of_all_indicators_come_from_one_grouping(spark, tmp_path):
    day = [datetime.datetime(y, 5, 1) for y in (1997, 1998)]
    orders = [
        (1, 7, "F", 1.0, day[0], "5-LOW"), (2, 7, "F", 2.0, day[1], "2-HIGH"), (2, 7, "F", 2.0, day[1], "2-HIGH"), (3, 7, "O", None, day[1], "5-LOW"),
        (4, None, "P", 3.0, day[0], None), (5, 8, "P", 4.0, None, "1-URGENT"),
    ]
    schema = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame(orders, schema).write.parquet(str(tmp_path / "orders.parquet"))
    records = loading._indicator_records(spark, str(tmp_path))
    assert "Exchange" not in records._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.feed_no, r.at, r.countryiso3code, r.date, r.value) for r in records.where("code IS NOT NULL AND tag IN ('SP.DYN.LE00.IN', 'SP.DYN.LE00.MA.IN')").collect())
    code = {k: r for k, r in spark.range(7, 9).select("id", testbed.letters("id")).collect()}
    text = lambda cents: None if cents is None else str(cents / 64)
    assert [g for g in got if g[2] == code[7]] == [
        (0, 0, code[7], "1997", text(100)), (0, 1, code[7], "1998", text(200)), (1, 0, code[7], "1997", None), (1, 1, code[7], "1998", text(200)),
    ]
    assert [g[4] for g in got if g[2] == code[8]] == [text(400), text(400)] and records.where("code IS NULL").count() == len(loading._API)


def test_documents_are_dealt_over_tasks(spark, tmp_path):
    """A customer table of one file is dealt by its key before its documents are made and read."""
    tables = {
        "region": ([(0, "ASIA")], "r_regionkey int, r_name string"),
        "nation": ([(0, "X", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(k, "a", 0, 5.0, "BUILDING") for k in (1, 2, 2, None)], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = joining.parsed_documents(spark, str(tmp_path))
    assert "hashpartitioning(c_custkey" in docs._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.c_custkey or 0, r.subregion) for r in docs.collect()) == [(0, "X"), (1, "X"), (2, "X"), (2, "X")]


def test_two_whole_numbers_order_a_pivot_as_they_do_in_turn(spark):
    low, high = -(1 << 31), (1 << 31) - 1
    cells = [(low, high), (-1, low), (-1, high), (0, low), (0, -1), (0, 0), (0, high), (1, low), (high, high)]
    spark_rows = spark.createDataFrame([("k", "t", float(i), f"n{i}", *c) for i, c in enumerate(cells)], "k string, tag string, v double, name string, a int, b int")
    rows = spark_rows.select("k", "tag", "v", "name", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("a", "b")])
    assert not rows.schema["a"].nullable
    for n in range(1, len(cells) + 1):
        for df in (rows.where(F.col("v") < n), spark_rows.where(F.col("v") < n)):
            assert combine.pivot_feeds(df, ["k"], "tag", "v", ["a", "b"], {"x": "t"}, ["name"]).first() == ("k", "n0", n - 1.0)
