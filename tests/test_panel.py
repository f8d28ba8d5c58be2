import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelfold.operators import clean, impute, quantiles

SCHEMA = "k string, t int, v double"


def reference_fill(df):
    """Known values as a line over row positions, level beyond its ends."""
    parts = []
    for _, rows in df.sort_values("t").groupby("k", sort=True):
        known = rows["v"].notna().to_numpy()
        if known.any():
            at = np.arange(len(rows))
            rows = rows.assign(v=np.interp(at, at[known], rows["v"].to_numpy()[known]))
        parts.append(rows)
    return pd.concat(parts)


def random_panel(seed, keys=25, years=20, gaps=0.6):
    rng = np.random.default_rng(seed)
    grid = [(f"k{k:02d}", int(t), float(rng.normal(50, 20))) for k in range(keys) for t in rng.permutation(np.arange(1990, 1990 + years))]
    df = pd.DataFrame(grid, columns=["k", "t", "v"])
    df.loc[rng.random(len(df)) < gaps, "v"] = np.nan
    df.loc[df["k"] == "k00", "v"] = np.nan
    return df.sample(frac=1, random_state=seed)


def to_spark(spark, df):
    data = [(k, int(t), None if math.isnan(v) else float(v)) for k, t, v in df.itertuples(index=False)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_interpolation_matches_pandas(spark, seed):
    df = random_panel(seed)
    want = reference_fill(df.copy())
    got = impute.interpolate(to_spark(spark, df), ["k"], "t", ["v"]).orderBy("k", "t").toPandas()
    assert np.allclose(got["v"].astype(float), want["v"].to_numpy(), equal_nan=True, atol=1e-9)
    assert got["v"].isna().sum() == want["v"].isna().sum() == 20


def test_impute_order_matches_pandas(spark):
    df = random_panel(7)
    want = reference_fill(df.copy())
    year = want.groupby("t")["v"].transform("median")
    want["v"] = want["v"].fillna(year).fillna(want["v"].median()).round(3)
    out = impute.impute_panel(to_spark(spark, df), ["k"], "t", ["v"], digits=3, flags=True)
    got = out.orderBy("k", "t").toPandas()
    assert np.allclose(got["v"], want["v"], atol=1.01e-3) and (np.abs(got["v"] - want["v"].to_numpy()) < 1e-9).mean() > 0.99
    assert got["v_imputed"].sum() == df["v"].isna().sum()


def test_overall_median_is_taken_before_period_fill(spark, rows):
    # period 2 holds only a key without values, so it has no median of its own
    data = [("a", 1, 1.0), ("b", 1, 2.0), ("c", 1, 9.0), ("z", 1, None), ("z", 2, None)]
    out = impute.impute_panel(spark.createDataFrame(data, SCHEMA), ["k"], "t", ["v"])
    assert rows(out, "k", "t", "v")[-2:] == [("z", 1, 2.0), ("z", 2, 2.0)]
    const = impute.impute_panel(spark.createDataFrame(data, SCHEMA), ["k"], "t", ["v"], constant=0.01)
    assert rows(const, "k", "t", "v")[-2:] == [("z", 1, 2.0), ("z", 2, 0.01)]


def test_spacing(spark, rows):
    df = spark.createDataFrame([("a", 1999, 9.0), ("a", 1991, None), ("a", 1990, 0.0)], SCHEMA)
    assert rows(impute.interpolate(df, ["k"], "t", ["v"]))[1][2] == 4.5
    assert rows(impute.interpolate(df, ["k"], "t", ["v"], spacing="period"))[1][2] == 1.0
    with pytest.raises(ValueError):
        impute.interpolate(df, ["k"], "t", ["v"], spacing="other")


def test_repeated_period_fails(spark):
    df = spark.createDataFrame([("a", 1990, 1.0), ("a", 1990, 2.0)], SCHEMA)
    with pytest.raises(Exception, match="repeated"):
        impute.interpolate(df, ["k"], "t", ["v"]).collect()


def test_empty_and_single_row(spark, rows):
    empty = spark.createDataFrame([], SCHEMA)
    assert rows(impute.impute_panel(empty, ["k"], "t", ["v"])) == []
    single = spark.createDataFrame([("a", 1990, None)], SCHEMA)
    assert rows(impute.impute_panel(single, ["k"], "t", ["v"])) == [("a", 1990, None)]


def test_directional_fills(spark, rows):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5.0), ("a", 3, None)], SCHEMA)
    assert [r[2] for r in rows(impute.fill_forward(df, ["k"], "t", ["v"]))] == [None, 5.0, 5.0]
    assert [r[2] for r in rows(impute.fill_backward(df, ["k"], "t", ["v"]))] == [5.0, 5.0, None]


@pytest.mark.parametrize("scale", [1e-9, 1.0, 1e12])
def test_quantiles_match_numpy(spark, scale):
    rng = np.random.default_rng(5)
    # one group holds most rows; another repeats one value; negatives and zero occur
    groups = {"hot": rng.normal(0, 1, 3000) * scale, "flat": np.full(50, 3.0 * scale), "one": np.array([-2.0 * scale]),
              "mixed": np.concatenate([np.zeros(5), rng.normal(0, 5, 41) * scale])}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("none", None)]
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(data, "g string, v double").repartition(7)
    out = {r["g"]: r for r in quantiles.exact_quantiles(df, ["g"], ["v"], probs, overall=True).collect()}
    everything = np.concatenate(list(groups.values()))
    for g, vs in {**groups, None: everything}.items():
        assert out[g]["n"] == len(vs) and out[g]["all_groups"] == (g is None)
        assert np.allclose(out[g]["quantiles"], np.quantile(vs, probs), rtol=1e-12, atol=0)
    assert "none" not in out


def test_quantiles_treat_a_null_group_as_a_group(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    out = {r["g"]: r["quantiles"][0] for r in quantiles.exact_quantiles(df, ["g"], ["v"], [0.5]).collect()}
    assert out == {None: 2.0, "a": 5.0}


def test_quantiles_beyond_the_broadcast_bound(spark, monkeypatch):
    """Many groups: the picked cells exceed the bound, so both sides are shuffled."""
    from panelfold.operators import sizing

    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 100)
    data = [(g, float(v)) for g in range(20) for v in range(g + 1)]
    df = spark.createDataFrame(data, "g int, v double")
    out = {r["g"]: r["quantiles"][0] for r in quantiles.exact_quantiles(df, ["g"], ["v"], [0.5]).collect()}
    assert out == {g: g / 2 for g in range(20)}


@pytest.mark.parametrize("limit", [1, 7, 40])
def test_full_cells_are_split(spark, monkeypatch, limit):
    """All values lie in one narrow band, so they share a cell of the fixed grid and it must be split."""
    monkeypatch.setattr(quantiles, "MAX_CELL_ROWS", limit)
    rng = np.random.default_rng(2)
    bands = {"narrow": 100 + rng.random(400) * 1e-3, "skew": 100 + rng.random(300) ** 40 * 1e-3,
             "ties": np.repeat([100.0, 100.0001, 100.0002], [50, 1, 60]), "minus": -100 - rng.random(200) * 1e-3}
    df = spark.createDataFrame([(g, float(v)) for g, vs in bands.items() for v in vs], "g string, v double").repartition(5)
    probs = [0.0, 0.01, 0.25, 0.5, 0.501, 0.99, 1.0]
    out = {r["g"]: r for r in quantiles.exact_quantiles(df, ["g"], ["v"], probs, overall=True).collect()}
    for g, vs in {**bands, None: np.concatenate(list(bands.values()))}.items():
        assert out[g]["n"] == len(vs)
        assert np.allclose(out[g]["quantiles"], np.quantile(vs, probs), rtol=1e-13, atol=0)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=40), st.floats(0, 1))
def test_any_quantile_of_any_list(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = quantiles.exact_quantiles(df, [], ["v"], [p]).first()["quantiles"][0]
    assert math.isclose(got, float(np.quantile(np.array(values, dtype=float), p)), rel_tol=1e-9, abs_tol=1e-30 + 1e-9 * max(map(abs, values)))


def test_sentinel_reaches_the_overall_median(spark, rows):
    data = [("a", 1, 10.0), ("a", 2, 960.0), ("a", 3, 20.0), ("b", 1, 950.0), ("c", 1, None), ("c", 2, 40.0)]
    out = rows(clean.repair_sentinel(spark.createDataFrame(data, SCHEMA), "k", ["v"], 950))
    # a2 and c1 take their key's median; b has none and takes that of 10, 15, 20, 40, 40
    assert out == [("a", 1, 10.0), ("a", 2, 15.0), ("a", 3, 20.0), ("b", 1, 20.0), ("c", 1, 40.0), ("c", 2, 40.0)]
    bad = clean.sentinel_rows(spark.createDataFrame(data, SCHEMA), ["v"], 950)
    assert rows(bad, "k", "t") == [("a", 2), ("b", 1)]


def test_overrides_and_trim(spark, rows):
    df = spark.createDataFrame([("NAM", None, 1.0), ("MAC", " x ", 2.0), ("SJM", "y", -1.0)], "k string, s string, a double")
    out = clean.override_cells(clean.trim_text(df), "k", {"s": {"NAM": "NA", "MAC": "Macau"}, "a": {"SJM": 62049.0}})
    assert rows(out) == [("MAC", "Macau", 2.0), ("NAM", "NA", 1.0), ("SJM", "y", 62049.0)]
    assert out.schema == df.schema


def test_valid_rows(spark, rows):
    df = spark.createDataFrame([("abc", "n"), ("ab", "n"), (None, "n"), ("xyz", " "), ("xyz", None)], "c string, n string")
    assert rows(clean.valid_rows(df, "c", "n")) == [("abc", "n")]
    assert df.where(F.lit(True)).count() == 5


INF = float("inf")


@pytest.mark.parametrize("how", [quantiles.exact_quantiles, quantiles.bounded_quantiles])
@pytest.mark.parametrize(
    "values,want",
    [([1.0, INF, INF], INF), ([-INF, -INF, 2.0], -INF), ([-1.7e308, 1.7e308], 0.0), ([-INF, INF], None), ([5e-324, 5e-324], 5e-324), ([1.0, INF], INF), ([], None)],
)
def test_medians_of_doubles_of_full_width(spark, how, values, want):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    got = [r.quantiles[0] for r in how(df, ["g"], ["v"], [0.5]).collect()]
    assert got == ([want] if values else [])


@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=30))
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_both_ways_to_quantiles_agree(spark, values):
    df = spark.createDataFrame([(k % 2, v) for k, v in enumerate(values)], "g int, v double")
    probs = [0.0, 0.25, 0.5, 1.0]
    both = [sorted((r.g, r.n, tuple(r.quantiles)) for r in how(df, ["g"], ["v"], probs).collect()) for how in (quantiles.exact_quantiles, quantiles.bounded_quantiles)]
    assert both[0] == both[1]


def test_nothing_stays_persisted_and_staged_folders_can_go(spark):
    from panelfold.session import release_staged

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    df = spark.createDataFrame([("a", 1990 + k, float(k) if k % 3 else None) for k in range(12)], "k string, t int, v double")
    impute.impute_panel(df, ["k"], "t", ["v"], digits=2).collect()
    clean.repair_sentinel(df, "k", ["v"], 9.0).collect()
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    # not called here for the whole session: other tests read what they have staged
    assert callable(release_staged)


def test_a_key_of_sentinels_only_takes_the_overall_median(spark, rows):
    df = spark.createDataFrame([("a", 1, 999.0), ("a", 2, 999.0), ("b", 1, 1.0), ("b", 2, 3.0), ("b", 3, 999.0), (None, 1, 5.0)], "k string, t int, v double")
    assert rows(clean.repair_sentinel(df, "k", ["v"], 950.0)) == [(None, 1, 5.0), ("a", 1, 2.5), ("a", 2, 2.5), ("b", 1, 1.0), ("b", 2, 3.0), ("b", 3, 2.0)]


@pytest.mark.parametrize("fill", [impute.fill_forward, impute.fill_backward])
def test_fills_refuse_a_repeated_period(spark, fill):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0)], "k string, t int, v double")
    with pytest.raises(Exception, match="repeated"):
        fill(df, ["k"], "t", ["v"]).collect()
