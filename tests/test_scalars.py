from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelfold.functions import formulas as fm
from panelfold.functions import scalars as sc


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("text", "number", "whole"),
    [("1.5", 1.5, 2), ("2.5", 2.5, 2), ("-3.5", -3.5, -4), ("x", None, None), ("", None, None), ("NaN", None, None),
     ("Infinity", None, None), ("-Infinity", None, None), (None, None, None), ("0", 0.0, 0), ("1e300", 1e300, None)],
)
def test_safe_numbers(spark, text, number, whole):
    c = F.lit(text).cast("string")
    assert one(spark, sc.safe_double(c)) == number
    assert one(spark, sc.safe_long(c)) == whole


def test_coerce_keeps_infinity_but_not_nan(spark):
    assert one(spark, sc.coerce_numeric(F.lit("Infinity"))) == float("inf")
    assert one(spark, sc.coerce_numeric(F.lit("NaN"))) is None
    assert one(spark, sc.coerce_numeric(F.lit("n/a"))) is None


def test_half_even_matches_numpy(spark):
    rng = np.random.default_rng(0)
    values = [0.125, 0.375, 2.5, 3.5, -0.125, 1e9 + 0.5, *rng.normal(0, 1000, 500).tolist()]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for digits in (0, 2, 3, 4):
        got = [r[0] for r in df.select(sc.half_even("v", digits)).collect()]
        assert got == np.round(values, digits).tolist()


def test_clip_keeps_null(spark):
    assert one(spark, sc.clip(F.lit(None).cast("double"), 0.0, 5.0)) is None
    assert one(spark, sc.clip(F.lit(-1.0), 0.0, 5.0)) == 0.0
    assert one(spark, sc.clip(F.lit(9.0), 0.0, 5.0)) == 5.0


@pytest.mark.parametrize(("code", "ok"), [(" abc ", True), ("AB", False), ("", False), (None, False), ("ABCD", False)])
def test_codes(spark, code, ok):
    c = F.lit(code).cast("string")
    assert one(spark, sc.is_code(c)) is ok
    if ok:
        assert one(spark, sc.clean_code(c)) == "ABC"


def test_text_defaults(spark):
    assert one(spark, sc.text_or(F.lit(""), "N/A")) == "N/A"
    assert one(spark, sc.text_or(F.lit(None).cast("string"), "N/A")) == "N/A"
    assert one(spark, sc.text_or(F.lit("abcdef"), "N/A", 3)) == "abc"
    assert one(spark, sc.text_or(F.lit("NA"), "N/A")) == "NA"


def test_falsy_and_positive(spark):
    assert one(spark, sc.falsy_to_null(F.lit(0.0))) is None
    assert one(spark, sc.number_or(F.lit("0"), 1000.0)) == 1000.0
    assert one(spark, sc.number_or(F.lit("-1"), 1000.0)) == -1.0
    assert one(spark, sc.positive_or(F.lit(-1.0), F.lit(7.0))) == 7.0
    assert one(spark, sc.positive_or(F.lit(None).cast("double"), F.lit(7.0))) == 7.0


def test_category_rank(spark):
    assert one(spark, sc.category_rank(F.lit("High"), ["Critical", "High"])) == 2
    assert one(spark, sc.category_rank(F.lit("none"), ["Critical", "High"])) == 0
    assert one(spark, sc.category_rank(F.lit(None).cast("string"), ["Critical"])) == 0


def test_empty_selection_means_all_known(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "g string")
    assert rows(df.where(sc.in_or_all("g", []))) == [("a",), ("b",)]
    assert rows(df.where(sc.in_or_all("g", ["b"]))) == [("b",)]


def test_cardio_formulas(spark):
    df = spark.createDataFrame([(100.0, 50.0), (400.0, 10.0), (1.0, 0.0)], "r double, s double")
    got = df.select(*[e.alias(n) for n, e in fm.cardio_indicators("r", "s", F.lit(200.0)).items()]).collect()
    assert [r["dalys_per_100k"] for r in got] == [215.0, 860.0, 2.15]
    assert [r["share_of_deaths_pct"] for r in got] == [15.75, 58.0, 12.0]
    assert [r["high_cholesterol_deaths"] for r in got] == [34.0, 6.8, 0.0]
    assert [r["obesity_deaths"] for r in got] == [26.0, 5.2, 0.0]
    zero = df.select(*[e.alias(n) for n, e in fm.cardio_indicators("r", "s", F.lit(0.0)).items()]).first()
    assert zero["share_of_deaths_pct"] == 58.0


def test_epidemic_formulas(spark):
    df = spark.createDataFrame([(0.5, 200.4, 1000.6, 0.0, 1_000_000), (0.0, 0.0, 0.0, 3.0, 1000)], "p double, d double, n double, r double, pop long")
    a, b = df.select(*[e.alias(k) for k, e in fm.epidemic_indicators("p", "d", "n", "r", "pop").items()]).collect()
    assert a["aids_deaths_per_100k"] == 20.04 and b["aids_deaths_per_100k"] == 3.0
    assert a["people_living_with_hiv"] == 3100 and b["people_living_with_hiv"] == 10
    # the estimates read the counts before they are rounded
    assert a["new_child_infections"] == round(1000.6 * 0.075) and a["new_infections_total"] == 1001
    assert a["children_orphaned_by_aids"] == round(200.4 * 1.65) and a["aids_deaths_total"] == 200
    assert b["children_living_with_hiv"] == 1


def test_metabolic_formulas(spark):
    df = spark.createDataFrame([(0.0, 10.0, 20.0), (9.5, 10.0, 60.0), (None, 200.0, 60.0)], "p double, d double, o double")
    df = df.withColumn("p", fm.diabetes_prevalence("p", "d", "o"))
    assert [r["p"] for r in df.collect()] == [9.5, 9.5, 26.0]
    got = df.select(*[e.alias(k) for k, e in fm.metabolic_indicators("p", "d", "o").items()]).collect()
    assert [r["overweight_prevalence_pct"] for r in got] == [37.0, 85.0, 85.0]
    assert [r["mean_bmi_male"] for r in got] == [25.4, 31.8, 31.8]
    assert got[0]["diabetes_health_spend_usd"] == 125 + 9.5 * 48


def test_gendered_life_and_ratio(spark):
    df = spark.createDataFrame([(70.0, None, 0.0), (70.0, 66.0, 75.0)], "t double, m double, f double")
    got = df.select(*[e.alias(k) for k, e in fm.gendered_life("t", "m", "f").items()]).collect()
    assert [tuple(r) for r in got] == [(67.5, 72.5), (66.0, 75.0)]
    z = spark.createDataFrame([(1.0, 0.0), (1.0, 4.0)], "a double, b double").select(fm.safe_ratio("a", "b")).collect()
    assert [r[0] for r in z] == [None, 0.25]


def test_decimal_overflow_fails(spark):
    from panelfold.sources.sinks import conform
    from pyspark.sql import types as T

    df = spark.createDataFrame([(12345.678,)], "v double")
    ok = conform(df, T.StructType.fromDDL("v decimal(8,3), extra string")).first()
    assert ok["v"] == Decimal("12345.678") and ok["extra"] is None
    with pytest.raises(Exception, match="(?i)overflow|out_of_range|cannot be represented"):
        conform(df, T.StructType.fromDDL("v decimal(6,3)")).collect()
