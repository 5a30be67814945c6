import numpy as np
import pandas as pd
import pytest
from helpers import frame, ordered, rising, same, series

from aqspark.operators import blocks as B, features as Ft
from aqspark.spec import LAGS, ObsSpec

# small blocks and buckets: every city spans several
SMALL = ObsSpec(bucket_days=7, block_rows=1500)


def expected_features(g):
    g = g.sort_values("timestamp").copy()
    x, past = g["aqi"], g["aqi"].shift(1)
    for k in LAGS:
        g[f"aqi_lag_{k}"] = x.shift(k)
    for p in ("pm2_5", "pm10", "no2", "o3"):
        g[f"{p}_lag_1"] = g[p].shift(1)
    for d in (3, 7, 14):
        g[f"aqi_roll_mean_{d}d"] = past.rolling(24 * d, min_periods=1).mean()
        g[f"aqi_roll_std_{d}d"] = past.rolling(24 * d, min_periods=1).std().fillna(0)
    g["aqi_diff_1h"], g["aqi_diff_3h"] = x.diff(1), x.diff(3)
    g["aqi_pct_1h"] = x.pct_change(1).replace([np.inf, -np.inf], 0)
    g["pm_ratio"] = g["pm2_5"] / g["pm10"].replace(0, np.nan).fillna(1)
    g["no2_o3_ratio"] = g["no2"] / g["o3"].replace(0, np.nan).fillna(1)
    for s in (12, 24, 72):
        g[f"aqi_ewm_{s}h"] = past.ewm(span=s, adjust=False).mean()
    ts = g["timestamp"].dt
    g["hour"], g["day_of_week"], g["day_of_month"] = ts.hour, ts.dayofweek, ts.day
    g["month"], g["quarter"], g["is_weekend"] = ts.month, ts.quarter, (ts.dayofweek >= 5).astype(int)
    for name, part, period in (("hour", g["hour"], 24), ("month", g["month"], 12), ("dow", g["day_of_week"], 7)):
        g[f"{name}_sin"], g[f"{name}_cos"] = np.sin(2 * np.pi * part / period), np.cos(2 * np.pi * part / period)
    return g


def per_city(pdf, fn):
    return ordered(pd.concat([fn(g) for _, g in pdf.groupby("city")]))


def test_all_features_equal_pandas_over_many_blocks(spark):
    pdf = series()
    df = frame(spark, pdf)
    got = ordered(Ft.all_features(df, SMALL))
    expected = per_city(pdf, expected_features)
    names = Ft.feature_names(df, SMALL)
    assert set(names) <= set(expected.columns)
    same(got, expected, names)


def test_single_operators_agree_with_all_features(spark):
    pdf = series(1)
    df = frame(spark, pdf)
    expected = per_city(pdf, expected_features)
    tiny = SMALL.with_(block_rows=50)
    same(ordered(Ft.lag_features(df, tiny)), expected, [f"aqi_lag_{k}" for k in LAGS])
    same(ordered(Ft.pollutant_lags(df, tiny)), expected, ["pm2_5_lag_1", "o3_lag_1"])
    rolled = [f"aqi_roll_{k}_{d}d" for d in (3, 7, 14) for k in ("mean", "std")]
    same(ordered(Ft.rolling_features(df, tiny)), expected, rolled)
    same(ordered(Ft.diff_features(df, tiny)), expected, ["aqi_diff_1h", "aqi_diff_3h"])
    same(ordered(Ft.ewm_features(df, tiny)), expected, [f"aqi_ewm_{s}h" for s in (12, 24, 72)])


def test_rolling_skips_gaps_like_pandas(spark):
    pdf = series(2, nulls=0.3)
    got = ordered(Ft.rolling_features(frame(spark, pdf), SMALL.with_(block_rows=400)))

    def rolled(g):
        g = g.sort_values("timestamp").copy()
        for d in (3, 7, 14):
            w = g["aqi"].shift(1).rolling(24 * d, min_periods=1)
            g[f"aqi_roll_mean_{d}d"], g[f"aqi_roll_std_{d}d"] = w.mean(), w.std().fillna(0)
        return g

    same(got, per_city(pdf, rolled), [f"aqi_roll_{k}_{d}d" for d in (3, 7, 14) for k in ("mean", "std")])


def test_rolling_deviation_of_a_constant_stretch_is_zero(spark):
    pdf = series(3, (("a", 1500),))
    pdf.loc[500:1300, "aqi"] = 123.4
    got = ordered(Ft.rolling_features(frame(spark, pdf), SMALL))
    assert got.loc[900:1300, "aqi_roll_std_14d"].max() < 1e-12


def test_pct_change_carries_long_gaps(spark):
    pdf = series(4, (("a", 1500), ("b", 60)))
    pdf.loc[100:900, "pm10"] = np.nan
    got = ordered(Ft.pct_change(frame(spark, pdf), ObsSpec(bucket_days=2, block_rows=64), "pm10"))

    def change(g):
        g = g.sort_values("timestamp").copy()
        held = g["pm10"].ffill()
        g["pm10_pct_1h"] = (held / held.shift(1) - 1).replace([np.inf, -np.inf], 0)
        return g

    same(got, per_city(pdf, change), ["pm10_pct_1h"])


@pytest.mark.parametrize("spans", [(3, 200), (2, 12)])
def test_ewm_of_unlike_spans(spark, spans):
    pdf = series(5, (("a", 2500),))
    got = ordered(Ft.ewm_features(frame(spark, pdf), SMALL, spans=spans))
    past = ordered(pdf)["aqi"].shift(1)
    expected = pd.DataFrame({f"aqi_ewm_{s}h": past.ewm(span=s, adjust=False).mean() for s in spans})
    same(got, expected, list(expected.columns))


@pytest.mark.parametrize("block_rows, spans", [(64, (12, 24, 72)), (16384, (12, 24, 72)), (16384, (2, 200)), (100, (3, 500))])
def test_ewm_over_gaps_equals_pandas(spark, block_rows, spans):
    rng = np.random.default_rng(6)
    pdf = series(6, (("a", 2600), ("b", 700), ("c", 3), ("d", 40)), nulls=0.3)
    a = pdf.index[pdf.city == "a"]
    pdf.loc[a[200:900], "aqi"] = np.nan  # longer than blocks, and longer than any weight lasts
    pdf.loc[a[1200:1700], "aqi"] = np.where(rng.uniform(size=500) < 0.02, 7.0, np.nan)
    pdf.loc[pdf.index[pdf.city == "b"][:90], "aqi"] = np.nan  # unknown at first
    pdf.loc[pdf.city == "d", "aqi"] = np.nan  # never known
    got = ordered(Ft.ewm_features(frame(spark, pdf), SMALL.with_(block_rows=block_rows), spans=spans))

    def weighted(g):
        g = g.sort_values("timestamp").copy()
        for s in spans:
            g[f"aqi_ewm_{s}h"] = g["aqi"].shift(1).ewm(span=s, adjust=False).mean()
        return g

    same(got, per_city(pdf, weighted), [f"aqi_ewm_{s}h" for s in spans])


def test_all_features_over_gaps_equal_pandas(spark):
    pdf = series(9, nulls=0.2)
    pdf.loc[300:800, "aqi"] = np.nan
    df = frame(spark, pdf)
    for spec in (SMALL, ObsSpec(bucket_days=30)):
        got = ordered(Ft.all_features(df, spec))

        def features(g):
            g = expected_features(g)
            held = g["aqi"].ffill()
            g["aqi_pct_1h"] = (held / held.shift(1) - 1).replace([np.inf, -np.inf], 0)
            return g

        same(got, per_city(pdf, features), [c for c in Ft.feature_names(df, spec) if c not in ("pm_ratio", "no2_o3_ratio")], 1e-8)


def test_rolling_strict(spark):
    pdf = series(7, nulls=0.01)
    got = ordered(Ft.rolling_strict(frame(spark, pdf), SMALL.with_(block_rows=64)))

    def strict(g):
        g = g.sort_values("timestamp").copy()
        g["aqi_roll_24h"] = g["aqi"].rolling(24).mean()
        return g

    same(got, per_city(pdf, strict), ["aqi_roll_24h"])


def test_result_does_not_depend_on_partitions_or_other_cities(spark):
    pdf = series(8, (("a", 900), ("b", 300)))
    names = ["aqi_lag_24", "aqi_roll_std_7d", "aqi_ewm_72h"]
    both = ordered(Ft.all_features(frame(spark, pdf), SMALL))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        again = ordered(Ft.all_features(frame(spark, pdf).repartition(7), SMALL.with_(bucket_days=1)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    alone = ordered(Ft.all_features(frame(spark, pdf[pdf.city == "b"]), SMALL))
    same(again, both, names, 1e-10)
    same(alone, both[both.city == "b"].reset_index(drop=True), names, 1e-10)


def test_positions_break_ties_by_arrival(spark):
    pdf = pd.DataFrame({"city": "a", "timestamp": pd.to_datetime(["2025-01-01"] * 3 + ["2025-03-01"]), "seq": [2, 0, 1, 5]})
    got = ordered(B.with_position(frame(spark, pdf), ObsSpec(seq="seq")), "_pos")
    assert got["seq"].tolist() == [0, 1, 2, 5] and got["_pos"].tolist() == [0, 1, 2, 3]


def test_thirty_rows_have_the_expected_columns(spark):
    out = Ft.all_features(frame(spark, rising(30)), ObsSpec())
    assert {"hour", "hour_sin", "aqi_lag_24", "aqi_roll_mean_3d", "aqi_diff_1h", "pm_ratio", "aqi_ewm_24h"} <= set(out.columns)
    assert out.count() == 30
    # short history: the column is there and unknown
    assert Ft.all_features(frame(spark, rising(3)), ObsSpec()).where("aqi_lag_24 IS NOT NULL").count() == 0
