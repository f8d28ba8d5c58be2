import json

import pytest
from pyspark.sql import functions as F

from panelfold import schemas
from panelfold.operators.combine import merge_feeds
from panelfold.plans import etl
from panelfold.sources import files, sinks
from panelfold.streaming.incremental import stream_upsert


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


def test_csv_keeps_na_and_drops_nan(spark, tmp_path, rows):
    path = write(tmp_path, "f.csv", "Entity,Code,Year,v\nNamibia,NA,2000,1.5\nWorld,,2000,NaN\n")
    out = files.read_csv(spark, path, "Entity string, Code string, Year int, v double")
    assert rows(out) == [("Namibia", "NA", 2000, 1.5), ("World", None, 2000, None)]
    assert dict(files.read_csv(spark, path).dtypes)["v"] == "string"


def test_csv_refuses_moved_columns(spark, tmp_path):
    path = write(tmp_path, "f.csv", "Code,Entity\nA,B\n")
    with pytest.raises(Exception):  # noqa: B017
        files.read_csv(spark, path, "Entity string, Code string").collect()


def test_missing_feed_fails(spark, tmp_path):
    with pytest.raises(Exception):  # noqa: B017
        files.read_csv(spark, str(tmp_path / "none.csv"), "a string").collect()


def test_load_first_available(spark, tmp_path, rows):
    write(tmp_path / "two", "t.csv", "a\n1\n")
    out = files.load_first_available(spark, "t", [str(tmp_path / "one"), str(tmp_path / "two")], "a int")
    assert rows(out) == [(1,)]
    with pytest.raises(FileNotFoundError):
        files.load_first_available(spark, "t", [str(tmp_path / "one")])


def test_sync_skips_missing_and_replaces(spark, tmp_path, rows):
    src, out = tmp_path / "src", str(tmp_path / "out")
    write(src, "a.csv", "x\n1\n2\n")
    assert rows(sinks.sync_csv(spark, str(src), ["a", "b"], out)) == [("a", 2)]
    write(src, "a.csv", "x\n7\n")
    assert rows(sinks.sync_csv(spark, str(src), ["a"], out)) == [("a", 1)]


def test_create_tables_is_idempotent(spark):
    sinks.create_tables(spark, schemas.TABLES)
    sinks.create_tables(spark, schemas.TABLES)
    for name, schema in schemas.TABLES.items():
        assert [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in schema]
    assert schemas.measures("dim_countries")[0] == "country_name" and len(schemas.measures("dim_countries")) == 11
    assert [len(schemas.measures(f)) for f in schemas.FACTS] == [11, 9, 10, 10]


def test_pages(spark, tmp_path, rows):
    ok = json.dumps([{"page": 1}, [{"countryiso3code": "abc", "date": "2000", "value": 1.5, "country": {"value": "A"}},
                                   {"countryiso3code": "", "date": "2000", "value": None, "country": None}]])
    write(tmp_path / "p", "1.json", ok)
    write(tmp_path / "p", "2.json", json.dumps([{"message": "none"}, None]))
    write(tmp_path / "p", "3.json", json.dumps([{"message": "error"}]))
    out = files.explode_pages(files.read_pages(spark, str(tmp_path / "p")), "body", schemas.PAGED_RECORD)
    assert rows(out, "at", "countryiso3code", "value") == [(0, "abc", "1.5"), (1, "", None)]


DOCS = [
    {"cca2": "AA", "cca3": " abc ", "name": {"common": " Land "}, "region": "Asia", "subregion": "Eastern Asia", "area": 10.5, "latlng": [1.5, -2.0],
     "capital": ["X", "Y"], "languages": {"a": "One", "b": "Two"}, "currencies": {"AAA": {"name": "q"}, "BBB": {}}},
    {"cca2": "BB", "cca3": "TCD", "name": {"common": "Low"}, "region": "", "subregion": "Western Europe", "area": -1, "latlng": [], "capital": [],
     "languages": {}, "currencies": {}},
    {"cca2": None, "cca3": "DDD", "name": {"common": ""}, "region": "Asia"},
    {"cca3": "TOOLONG", "name": {"common": "n"}},
    {"cca3": "EEE", "name": {"common": "E"}, "area": None},
]


def test_countries_from_documents(spark, tmp_path):
    path = write(tmp_path, "c.json", json.dumps(DOCS))
    pop = spark.createDataFrame([("EEE", "77.9"), (" eee", "0"), ("", "5"), ("ABC", None)], "countryiso3code string, value string")
    out = etl.clean_countries(etl.extract_countries(files.read_json(spark, path, schemas.COUNTRY_JSON, lines=False), etl.population_lookup(pop)))
    got = {r["country_code"]: r.asDict() for r in out.collect()}
    assert sorted(got) == ["ABC", "EEE", "TCD"]
    a, e, t = got["ABC"], got["EEE"], got["TCD"]
    assert (a["country_name"], a["population"], a["area_km2"], a["capital"], a["languages"], a["currency"]) == ("Land", 630, 10.5, "X, Y", "One, Two", "AAA, BBB")
    assert (a["income_group"], a["lat"], a["lon"]) == ("Upper middle income", 1.5, -2.0)
    # an area of -1 gives -60 people, which is no population
    assert (t["income_group"], t["population"], t["region"], t["capital"], t["languages"], t["currency"]) == ("Low income", 5_000_000, "Global", "N/A", "Official", "USD")
    assert (e["income_group"], e["population"], e["area_km2"], e["sub_region"], e["lat"]) == ("Lower middle income", 77, 1000.0, "General", 0.0)
    assert all(v is not None for r in got.values() for v in r.values())


def test_indicators_drop_zero_and_bad_codes(spark, rows):
    data = [("A", "SP.DYN.LE00.IN", 0, "abc", "2000", "70.5", "First"), ("A", "SP.DYN.LE00.IN", 1, "ABC ", "2000", "71.5", "Second"),
            ("A", "SH.DYN.MORT", 0, "ABC", "2000", "0", "x"), ("A", "SH.DYN.MORT", 1, "AB", "2000", "5", "x"), ("A", "SH.DYN.MORT", 2, "ABC", "2001", None, "x")]
    df = spark.createDataFrame(data, "f string, tag string, at int, countryiso3code string, date string, value string, n string")
    df = df.withColumn("country", F.struct(F.col("n").alias("value")))
    out = etl.extract_indicators(df, "tag", ["at"])
    assert rows(out, "country_code", "year", "country_name", "life_expectancy_total", "under5_mortality_per_1000") == [("ABC", 2000, "First", 71.5, None)]


def test_failed_feeds_leave_null_columns(spark):
    countries = spark.createDataFrame([("ABC", 1000)], "country_code string, population long")
    raw = spark.createDataFrame([("ABC", "n", 2000, 70.0), ("ABC", "n", 2002, 72.0), ("XXX", "n", 2000, 1.0), ("ABC", "n", 1980, 1.0)],
                                "country_code string, country_name string, year int, life_expectancy_total double")
    out = etl.clean_life(raw, countries).orderBy("year").collect()
    assert [(r["year"], r["life_expectancy_total"], r["life_expectancy_male"], r["life_expectancy_female"]) for r in out] == [(2000, 70.0, 67.5, 72.5), (2002, 72.0, 69.5, 74.5)]
    assert out[0]["physicians_per_1000"] is None


def test_epidemic_from_feeds(spark):
    countries = spark.createDataFrame([("ABC", 1000), ("DEF", 0)], "country_code string, population long")
    keys = "Entity string, Code string, Year int"
    prev = spark.createDataFrame([("A", "ABC", 2000, "1.0"), ("World", None, 2000, "9"), ("D", "DEF", 2000, "bad")], f"{keys}, `Prevalence in adults` string")
    new = spark.createDataFrame([("A", "ABC", 2000, "20")], f"{keys}, `Number of new HIV infections` string")
    raw = merge_feeds([prev, new], ["Entity", "Code", "Year"])
    got = {r["country_code"]: r for r in etl.clean_epidemic(raw, countries).collect()}
    assert sorted(got) == ["ABC", "DEF"]
    # D takes the year's median prevalence; measures no feed gave end at the constant
    assert got["DEF"]["prevalence_pct"] == 1.0 and got["ABC"]["pct_on_antiretroviral"] == 0.01
    assert got["ABC"]["new_infections_per_1000"] == 20.0 and got["DEF"]["new_infections_per_1000"] == 0.002
    assert got["ABC"]["people_living_with_hiv"] == 10 and got["DEF"]["people_living_with_hiv"] == 62000


SCHEMA = "k string, v double, name string"


def test_versions_and_replay(spark, tmp_path, rows):
    table = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        sinks.read_version(spark, table)
    first = spark.createDataFrame([("a", 1.0, "one")], SCHEMA)
    second = spark.createDataFrame([("a", 2.0, "two"), ("b", 5.0, "b")], SCHEMA)
    for _ in range(2):  # a replay of both batches changes nothing
        sinks.upsert_version(spark, table, first, ["k"], ["v"], at=1)
        sinks.upsert_version(spark, table, second, ["k"], ["v"], at=2)
        assert rows(sinks.read_version(spark, table)) == [("a", 2.0, "one"), ("b", 5.0, "b")]
    assert sinks.versions(spark, table) == [1, 2]
    (tmp_path / "t" / "version=3").mkdir()  # an unfinished version is not read
    assert sinks.versions(spark, table) == [1, 2]


def test_stream_picks_up_new_files_only(spark, tmp_path, rows):
    landing, table, progress = (str(tmp_path / x) for x in ("in", "t", "c"))
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        stream_upsert(spark, landing, schema, table, ["k"], ["v"], progress, files_per_batch=1)

    spark.createDataFrame([("a", 1.0, "one")], SCHEMA).coalesce(1).write.parquet(landing)
    run()
    done = sinks.versions(spark, table)
    run()
    assert sinks.versions(spark, table) == done
    spark.createDataFrame([("a", 9.0, "two"), ("b", 2.0, "b")], SCHEMA).coalesce(1).write.mode("append").parquet(landing)
    run()
    assert rows(sinks.read_version(spark, table)) == [("a", 9.0, "one"), ("b", 2.0, "b")]


FACT = "k string, v double, name string, year int"


def test_partition_upsert_rewrites_only_touched_years(spark, tmp_path, rows):
    table = str(tmp_path / "t")
    start = spark.createDataFrame([("a", 1.0, "one", 2000), ("b", 2.0, "one", 2000), ("a", 3.0, "one", 2001)], FACT)
    assert rows(sinks.upsert_partitions(spark, table, start, ["k", "year"], ["v"], "year")) == [(2000,), (2001,)]
    before = sorted(p.name for p in (tmp_path / "t" / "year=2001").iterdir())
    load = spark.createDataFrame([("a", 9.0, "two", 2000), ("c", 5.0, "two", 2000), ("z", 7.0, "two", 2002)], FACT)
    for _ in range(2):
        assert rows(sinks.upsert_partitions(spark, table, load, ["k", "year"], ["v"], "year")) == [(2000,), (2002,)]
        assert rows(spark.read.parquet(table), "k", "v", "name", "year") == [
            ("a", 3.0, "one", 2001), ("a", 9.0, "one", 2000), ("b", 2.0, "one", 2000), ("c", 5.0, "two", 2000), ("z", 7.0, "two", 2002),
        ]
    assert sorted(p.name for p in (tmp_path / "t" / "year=2001").iterdir()) == before
    with pytest.raises(ValueError):
        sinks.upsert_partitions(spark, table, load, ["k"], ["v"], "year")


def test_partition_upsert_keeps_columns_a_load_lacks(spark, tmp_path, rows):
    table = str(tmp_path / "t")
    start = spark.createDataFrame([("a", 1.0, "one", 2000), ("b", 2.0, "two", 2000)], FACT)
    sinks.upsert_partitions(spark, table, start, ["k", "year"], ["v"], "year")
    load = spark.createDataFrame([("a", 9.0, 5, 2000), ("c", 3.0, 6, 2000)], "k string, v double, extra int, year int")
    sinks.upsert_partitions(spark, table, load, ["k", "year"], ["v", "extra"], "year")
    assert rows(spark.read.parquet(table), "k", "v", "name", "extra", "year") == [
        ("a", 9.0, "one", 5, 2000), ("b", 2.0, "two", None, 2000), ("c", 3.0, None, 6, 2000),
    ]


def test_partition_upsert_of_text_partitions(spark, tmp_path):
    table = str(tmp_path / "t")
    for v in (1.0, 2.0):
        load = spark.createDataFrame([("a", v, "01"), ("a", v, "x")], "k string, v double, p string")
        sinks.upsert_partitions(spark, table, load, ["k", "p"], ["v"], "p")
    assert sorted(x.name for x in (tmp_path / "t").glob("p=*")) == ["p=01", "p=x"]
    back = spark.read.schema("k string, v double, p string").parquet(table)
    assert sorted((r.p, r.v) for r in back.collect()) == [("01", 2.0), ("x", 2.0)]


def test_partition_upsert_stamps(spark, tmp_path):
    table = str(tmp_path / "t")
    load = lambda v: spark.createDataFrame([("a", v, 2000)], "k string, v double, year int")
    sinks.upsert_partitions(spark, table, load(1.0), ["k", "year"], ["v"], "year", touch=["updated_at"], stamp=["loaded_at"])
    first = spark.read.parquet(table).first()
    sinks.upsert_partitions(spark, table, load(1.0), ["k", "year"], ["v"], "year", touch=["updated_at"], stamp=["loaded_at"])
    second = spark.read.parquet(table).first()
    assert first.loaded_at == second.loaded_at is not None and second.updated_at > first.updated_at


def test_a_second_feed_and_a_new_checkpoint_lose_nothing(spark, tmp_path, rows):
    table = str(tmp_path / "t")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run(landing, progress, **more):
        stream_upsert(spark, str(tmp_path / landing), schema, table, ["k"], ["v"], str(tmp_path / progress), **more)

    def land(landing, *data):
        spark.createDataFrame(list(data), SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / landing))

    land("one", ("a", 1.0, "one"))
    run("one", "c1")
    land("one", ("b", 2.0, "one"))
    run("one", "c1")
    land("two", ("z", 9.0, "two"))
    run("two", "c2")
    assert rows(sinks.read_version(spark, table), "k", "v") == [("a", 1.0), ("b", 2.0), ("z", 9.0)]
    land("one", ("a", 5.0, "one"))
    run("one", "c3")  # everything once more from the first folder, in one batch
    assert rows(sinks.read_version(spark, table), "k") == [("a",), ("b",), ("z",)]
    land("two", ("y", 8.0, "two"))
    run("two", "c2", keep=2)
    assert rows(sinks.read_version(spark, table), "k") == [("a",), ("b",), ("y",), ("z",)]
    assert len(sinks.versions(spark, table)) == 2


def test_a_replayed_load_writes_its_own_version(spark, tmp_path, rows):
    table = str(tmp_path / "t")
    one, two = (spark.createDataFrame([x], SCHEMA) for x in (("a", 1.0, "one"), ("b", 2.0, "two")))
    claims = []
    for load, df in (("f:0", one), ("g:0", two), ("f:0", one), ("g:0", two)):
        at, parent = sinks.claim_version(spark, table, load)
        sinks.upsert_version(spark, table, df, ["k"], ["v"], at, parent=parent)
        claims.append((at, parent))
    assert claims == [(0, -1), (1, 0), (0, -1), (1, 0)]
    assert rows(sinks.read_version(spark, table), "k") == [("a",), ("b",)]


def test_json_lines(spark, tmp_path, rows):
    path = write(tmp_path, "l.json", '{"k": "a"}\n{"k": "b"}\n{"k": "c"}\n')
    assert rows(files.read_json(spark, path, "k string")) == [("a",), ("b",), ("c",)]
    assert rows(files.read_json(spark, write(tmp_path, "d.json", '[{"k": "a"},\n {"k": "b"}]'), "k string", lines=False)) == [("a",), ("b",)]
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_json(spark, write(tmp_path, "x.json", '{"k": "a"}\n{"k": \n'), "k string").collect()


def test_broken_pages_are_not_dropped(spark):
    good = json.dumps([{"page": 1}, [{"countryiso3code": "abc", "date": "2000", "value": 1.5, "country": None}]])
    pages = spark.createDataFrame([(1, good), (2, good[:-9]), (3, "<html>"), (4, '{"a": 1}'), (5, None)], "n int, body string")
    assert [r.n for r in pages.where(~files.is_page("body")).orderBy("n").collect()] == [2, 3, 4]
    assert files.explode_pages(pages.where(files.is_page("body")), "body", schemas.PAGED_RECORD).count() == 1
    with pytest.raises(Exception, match="not a page"):
        files.explode_pages(pages, "body", schemas.PAGED_RECORD).collect()


def test_filters_on_numbers_reach_the_scan_of_own_tables(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, 2000), ("b", float("nan"), 2001)], "k string, v double, year int")
    back = sinks.replace_table(df, str(tmp_path / "t"), ["year"])
    assert [r.v for r in back.orderBy("k").collect()] == [1.0, None]
    plan = back.where("v > 0.5 AND year = 2000")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(v,0.5)" in plan and "PartitionFilters: [isnotnull(year" in plan


def test_repeated_countries_are_one(spark):
    docs = [{"cca3": "ABC", "name": {"common": "One"}, "area": 1.0}, {"cca3": "abc ", "name": {"common": "Two"}, "area": 2.0}, {"cca3": "DEF", "name": {"common": "D"}}]
    raw = spark.createDataFrame(docs, schemas.COUNTRY_JSON)
    pop = spark.createDataFrame([], "countryiso3code string, value string")
    out = etl.clean_countries(etl.extract_countries(raw, etl.population_lookup(pop)))
    assert sorted(r.country_code for r in out.collect()) == ["ABC", "DEF"]


def test_partitioned_stream(spark, tmp_path, rows):
    landing, table, progress = (str(tmp_path / x) for x in ("in", "t", "c"))
    for v in (1.0, 2.0):
        spark.createDataFrame([("a", v, "n", 2000)], FACT).coalesce(1).write.mode("append").parquet(landing)
        schema = spark.read.parquet(landing).schema
        stream_upsert(spark, landing, schema, table, ["k", "year"], ["v"], progress, partition="year")
    assert rows(spark.read.parquet(table), "k", "v", "year") == [("a", 2.0, 2000)]


def test_feature_and_metric_files(spark, tmp_path, rows):
    names = ["z", "a", "region_Asia"]
    sinks.write_features(spark, names, str(tmp_path / "f"))
    assert sinks.read_features(spark, str(tmp_path / "f")) == names
    m = spark.createDataFrame([("r", 0.98765, 1.23456, 0.5, 1.005)], "model string, r2 double, rmse double, mae double, mape double")
    sinks.write_metrics(m, str(tmp_path / "m"))
    assert rows(spark.read.json(str(tmp_path / "m")), "r2", "rmse", "mae") == [(0.9876, 1.235, 0.5)] or rows(
        spark.read.json(str(tmp_path / "m")), "r2", "rmse", "mae"
    ) == [(0.9877, 1.235, 0.5)]


def test_bucketed_facts_meet_without_a_shuffle(spark, tmp_path):
    from panelfold.plans.star import CARDIO, EPIDEMIC, LIFE, METABOLIC, flat_panel
    from panelfold.sources import sinks

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = []
        for name, columns in (("life", LIFE), ("cardio", CARDIO), ("epidemic", EPIDEMIC), ("metabolic", METABOLIC)):
            rows = spark.range(400).selectExpr("CAST(id % 20 AS string) AS country_code", "CAST(1990 + id div 20 AS int) AS year", *[f"CAST(id AS double) AS {c}" for c in columns.values()])
            facts.append(sinks.write_bucketed(rows, f"bucketed_{name}", ["country_code", "year"], 8, str(tmp_path / name)))
        dim = spark.range(20).selectExpr("CAST(id AS string) AS country_code", "'r' AS region", "'i' AS income_group")
        panel = flat_panel(dim, *facts)
        assert panel.count() == 400
        both = facts[0].join(facts[1], ["country_code", "year"]).join(facts[2], ["country_code", "year"]).join(facts[3], ["country_code", "year"])
        assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
        # What is left are the two sides of the join with the dimension.
        assert panel._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("life", "cardio", "epidemic", "metabolic"):
            spark.sql(f"DROP TABLE IF EXISTS bucketed_{name}")
