import numpy as np
import pandas as pd
import pytest
from helpers import frame, ordered, same, series

from aqspark.operators import clean as C, explore as Ex, quantiles as Q, scale as Sc
from aqspark.plans import pipelines as P
from aqspark.spec import ObsSpec

SPEC = ObsSpec(bucket_days=3)
COLUMNS = ["aqi", "pm2_5", "pm10"]


def test_fills_reach_over_buckets(spark):
    pdf = series(1, nulls=0.4)
    pdf.loc[200:700, "aqi"] = np.nan
    pdf.loc[pdf.city == "b", "pm10"] = np.nan
    df = frame(spark, pdf)
    groups = ordered(pdf).groupby("city")[COLUMNS]
    same(ordered(C.forward_fill(df, SPEC)), groups.ffill(), COLUMNS)
    same(ordered(C.backward_fill(df, SPEC)), groups.bfill(), COLUMNS)
    both = groups.ffill()
    both["city"] = ordered(pdf)["city"]
    same(ordered(C.fill(df, SPEC)), both.groupby("city")[COLUMNS].bfill(), COLUMNS)


def test_missing_values_take_the_median_of_the_filled_frame(spark):
    pdf = series(2, nulls=0.2)
    pdf.loc[pdf.city == "b", "pm10"] = np.nan
    filled = ordered(pdf)
    filled[COLUMNS] = filled.groupby("city")[COLUMNS].ffill()
    filled[COLUMNS] = filled.groupby("city")[COLUMNS].bfill()
    filled["pm10"] = filled["pm10"].fillna(filled["pm10"].median())
    df = frame(spark, pdf)
    same(ordered(P.handle_missing(df, SPEC)), filled, COLUMNS)
    same(ordered(C.impute(df, SPEC)), filled, COLUMNS)


@pytest.mark.parametrize(
    "values",
    [
        [1.0], [1.0, 2.0], [5.0] * 40, [1.0, 2.0, 3.0, 10.0], list(range(5)), [0.0, 1e300, -1e300, 3.0, 4.0],
        list(np.random.default_rng(0).lognormal(0, 3, 20000)),
        [7.0] * 9000 + list(np.random.default_rng(1).uniform(0, 100, 11000)),
        list(np.round(np.random.default_rng(2).normal(0, 1, 5000), 1)),
    ],
)
def test_exact_quantiles(spark, values):
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = spark.createDataFrame(pd.DataFrame({"v": np.array(values, dtype=float)}))
    got = {r["prob"]: r["value"] for r in Q.exact_quantiles(df, ["v"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(pd.Series(values).quantile(p), rel=1e-12, abs=1e-12)


def test_quantiles_per_group_with_a_hot_group(spark):
    pdf = series(3, nulls=0.1)
    names = {f"{c}_{p}": (c, p) for c in COLUMNS for p in (0.25, 0.5)}
    got = Q.quantiles_wide(frame(spark, pdf), names, ["city"]).toPandas().set_index("city")
    for city, g in pdf.groupby("city"):
        for n, (c, p) in names.items():
            assert got.loc[city, n] == pytest.approx(g[c].quantile(p), rel=1e-12)


def test_winsorise_caps_and_counts(spark):
    pdf = series(4, (("a", 300), ("b", 200)))
    pdf.loc[[3, 10, 400], "aqi"] = [9000.0, -9000.0, 9000.0]
    pdf.loc[7, "pm10"] = np.nan
    got = ordered(C.winsorise(frame(spark, pdf), count_as="capped"))
    expected = ordered(pdf)
    outside = 0
    for c in COLUMNS:
        q1, q3 = pdf[c].quantile(0.25), pdf[c].quantile(0.75)
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        outside += int(((pdf[c] < low) | (pdf[c] > high)).sum())
        expected[c] = expected[c].clip(low, high)
    same(got, expected, COLUMNS)
    assert got["capped"].sum() == outside
    each = ordered(C.winsorise(frame(spark, pdf), ["aqi"], by=["city"]))
    q1, q3 = pdf[pdf.city == "b"]["aqi"].quantile([0.25, 0.75])
    assert each[each.city == "b"]["aqi"].max() == pytest.approx(min(9000, q3 + 1.5 * (q3 - q1)))


def test_first_arrival_wins_and_range_is_kept(spark):
    pdf = pd.DataFrame(
        {
            "city": ["a", "a", "a", "x", "a"],
            "timestamp": pd.to_datetime(["2025-01-01", "2025-01-01", "2025-01-02", "2025-01-01", "2025-01-03"]),
            "aqi": [7.0, 9.0, 700.0, 5.0, np.nan],
            "seq": [2, 1, 3, 4, 5],
        }
    )
    got = ordered(C.clean(frame(spark, pdf), ObsSpec(seq="seq"), ["a"]))
    assert got["aqi"].tolist() == [9.0, 500.0]
    assert C.clean(frame(spark, pdf), ObsSpec(seq="seq")).count() == 3


def test_scaling_uses_training_rows_only(spark):
    pdf = series(5, (("a", 400),))
    pdf["split"] = np.where(np.arange(len(pdf)) < 300, "train", "test")
    pdf["flat"] = 4.0
    got = ordered(Sc.robust_scale(frame(spark, pdf), ["aqi", "flat"]))
    train = pdf[pdf.split == "train"]["aqi"]
    expected = (ordered(pdf)["aqi"] - train.median()) / (train.quantile(0.75) - train.quantile(0.25))
    assert np.allclose(got["aqi"], expected) and (got["flat"] == 0).all()


def test_summaries(spark):
    pdf = series(6, nulls=0.2)
    df = frame(spark, pdf)
    corr = pdf[COLUMNS].corr()
    for r in Ex.correlation_matrix(df, COLUMNS).collect():
        assert r["corr"] == pytest.approx(corr.loc[r["a"], r["b"]], abs=1e-12)
    counts, edges = np.histogram(pdf["aqi"].dropna(), 30)
    bins = ordered(Ex.histogram(df, "aqi"), "bin")
    assert bins["rows"].tolist() == counts.tolist() and np.allclose(bins["low"], edges[:-1])
    x = pdf["aqi"].dropna().to_numpy()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    density = np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.allclose(ordered(Ex.density_curve(df, "aqi"), "point")["density"], density)
    profile = {r["column"]: r["nulls"] for r in C.null_profile(df).collect()}
    assert profile["aqi"] == pdf["aqi"].isna().sum() and profile["city"] == 0


def test_correlations_of_many_columns_with_constant_and_unknown_ones(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame(rng.normal(size=(3000, 44)), columns=[f"c{i}" for i in range(44)])
    pdf["c1"] = pdf["c0"] * 2 + rng.normal(size=3000)
    pdf.loc[::7, "c2"] = np.nan
    pdf["c3"], pdf["c4"] = 4.0, np.nan
    expected = pdf.corr()
    found = Ex.correlation_matrix(spark.createDataFrame(pdf), list(pdf.columns)).collect()
    assert len(found) == 44 * 44
    for r in found:
        want = expected.loc[r["a"], r["b"]]
        assert r["corr"] is None if np.isnan(want) else r["corr"] == pytest.approx(want, abs=1e-9)
    assert all(r["corr"] is None for r in Ex.correlation_matrix(spark.createDataFrame(pdf).limit(0), ["c0", "c1"]).collect())
