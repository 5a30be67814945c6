import numpy as np
import pandas as pd
import pytest
from helpers import frame, ordered, rising, series

from aqspark.operators import blocks as B, clean as C, features as Ft, horizon as H
from aqspark.plans import pipelines as P
from aqspark.spec import ObsSpec

SPEC = ObsSpec(bucket_days=5, block_rows=100)


def by_rows(pdf, hours):
    out = []
    for city, g in ordered(pdf).groupby("city"):
        for h in range(1, hours + 1):
            out.append(g.assign(timestamp_offset=h, target_aqi=g["aqi"].shift(-h)))
    out = pd.concat(out).dropna(subset=["target_aqi"])
    return out.sort_values(["city", "timestamp", "timestamp_offset"]).reset_index(drop=True)


def test_targets_are_rows_ahead(spark):
    pdf = series(1, (("a", 700), ("b", 80), ("c", 2)), nulls=0.2)
    got = ordered(H.horizon_targets(frame(spark, pdf), SPEC, 30), "city", "timestamp", "timestamp_offset")
    expected = by_rows(pdf, 30)
    assert got[["city", "timestamp", "timestamp_offset", "target_aqi"]].equals(
        expected[["city", "timestamp", "timestamp_offset", "target_aqi"]].astype(got.dtypes[["city", "timestamp", "timestamp_offset", "target_aqi"]])
    )


def test_targets_at_the_very_hour(spark):
    pdf = series(2, (("a", 900), ("b", 80)), nulls=0.1)
    pdf.loc[5, "timestamp"] += pd.Timedelta("1us")  # not on the hour of any other reading
    got = ordered(H.horizon_targets_time(frame(spark, pdf), ObsSpec(bucket_days=2), 72), "city", "timestamp", "timestamp_offset")
    value = {(r.city, r.timestamp): r.aqi for r in pdf.dropna(subset=["aqi"]).itertuples()}
    expected = [
        (r.city, r.timestamp, h, value[r.city, r.timestamp + pd.Timedelta(hours=h)])
        for r in ordered(pdf).itertuples() for h in range(1, 73) if (r.city, r.timestamp + pd.Timedelta(hours=h)) in value
    ]
    assert list(got[["city", "timestamp", "timestamp_offset", "target_aqi"]].itertuples(index=False, name=None)) == expected


def test_ninety_rows(spark):
    featured = C.drop_incomplete(Ft.all_features(frame(spark, rising(90)), ObsSpec()))
    out = H.horizon_targets(featured, ObsSpec(), 3)
    # pct_1h from 0 is defined, so only the 24-row lag costs rows
    assert featured.count() == 66 and out.count() == 192
    names = H.feature_columns(out)
    assert "timestamp_offset" in names and not {"aqi", "target_aqi", "aqi_diff_1h", "aqi_diff_3h", "aqi_pct_1h"} & set(names)
    row = out.where("timestamp_offset = 3").orderBy("timestamp").first()
    assert row["target_aqi"] == row["aqi"] + 3


@pytest.fixture(scope="module")
def numbered(spark):
    pdf = ordered(series(3, (("a", 900), ("b", 300), ("c", 4))))
    pdf["i"] = np.arange(len(pdf))
    return frame(spark, pdf).persist(), pdf


def test_global_index_and_weights(spark, numbered):
    df, pdf = numbered
    got = ordered(B.with_global_index(df, SPEC), "i")
    assert (got["_idx"] == got["i"]).all() and (got["_n"] == len(pdf)).all()
    import pyspark.sql.functions as F

    weighted = ordered(B.with_global_index(df, SPEC, weight=F.col("i") % 3), "i")
    w = pdf["i"] % 3
    assert (weighted["_idx"] == (w.cumsum() - w)).all() and (weighted["_n"] == w.sum()).all()


def test_split(spark, numbered):
    df, pdf = numbered
    got = ordered(H.temporal_split(df, SPEC), "i")
    cut = int(len(pdf) * 0.8)
    assert (got["split"] == np.where(got["i"] < cut, "train", "test")).all()
    timed = H.temporal_split(df, SPEC, mode="time", cut="2025-01-10").toPandas()
    assert ((timed["timestamp"] < "2025-01-10") == (timed["split"] == "train")).all()


@pytest.mark.parametrize("keep", [2, 7, 100, 999, 1083, 5000])
def test_even_sample(spark, numbered, keep):
    df, pdf = numbered
    got = sorted(r["i"] for r in H.even_sample(df, SPEC, keep).select("i").collect())
    n = len(pdf)
    expected = list(range(n)) if n <= keep else np.linspace(0, n - 1, keep, dtype=int).tolist()
    assert got == expected


def test_folds(spark, numbered):
    df, pdf = numbered
    n = len(pdf)
    got = H.time_series_folds(df, SPEC, rows_per_fold=300).toPandas()
    splits = min(5, max(2, n // 300))
    size = n // (splits + 1)
    for f in range(splits):
        start = n - (splits - f) * size
        part = got[got.fold == f]
        assert sorted(part[part.role == "train"]["i"]) == list(range(start))
        assert sorted(part[part.role == "test"]["i"]) == list(range(start, start + size))
    assert got["fold"].nunique() == splits
    runs = ordered(H.contiguous_folds(df, SPEC, 7), "i")
    assert (runs["fold"] == np.repeat(np.arange(7), [len(p) for p in np.array_split(np.arange(n), 7)])).all()


def test_job_numbers_rows_like_the_operators(spark):
    pdf = series(4, (("a", 200), ("b", 120)))
    pdf["seq"] = range(len(pdf))
    prepared = P.preprocess_job(frame(spark, pdf), ObsSpec(seq="seq", bucket_days=4), hours=5)
    got = prepared.frame().toPandas().sort_values("_idx").reset_index(drop=True)
    assert got["_idx"].tolist() == list(range(len(got)))
    key = got[["city", "timestamp", "timestamp_offset"]]
    assert key.equals(key.sort_values(["city", "timestamp", "timestamp_offset"]).reset_index(drop=True))
    assert (got["split"] == "train").sum() == int(len(got) * 0.8) == prepared.train().first()["_n"]
    assert "seq" not in prepared.features and "aqi_lag_24" in prepared.features
    centers = {r["column"]: r["center"] for r in prepared.parameters.collect()}
    assert centers["pm2_5"] == pytest.approx(got[got.split == "train"]["pm2_5"].median())
