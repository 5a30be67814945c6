import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def frame(spark, pdf, time="timestamp"):
    """A Spark frame in shuffled row order, with zone-less time and null instead of NaN."""
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=3))
    if time in pdf.columns and str(pdf[time].dtype).startswith("datetime"):
        df = df.withColumn(time, F.col(time).cast("timestamp_ntz"))
    floats = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def series(seed=0, cities=(("a", 2600), ("b", 700), ("c", 3)), nulls=0.0):
    """Hourly readings with missing hours; city ``a`` holds most rows."""
    rng = np.random.default_rng(seed)
    parts = []
    for city, n in cities:
        times = pd.date_range("2025-01-01", periods=n, freq="h")
        kept = np.sort(rng.choice(n, max(1, int(n * 0.9)), replace=False))
        part = pd.DataFrame(
            {
                "city": city,
                "timestamp": times[kept],
                "aqi": np.round(rng.uniform(0, 300, len(kept)), 1),
                "pm2_5": rng.uniform(0, 50, len(kept)),
                "pm10": np.round(rng.uniform(0, 3, len(kept))),
                "no2": rng.uniform(0, 9, len(kept)),
                "o3": rng.uniform(1, 9, len(kept)),
            }
        )
        for c in ("aqi", "pm2_5", "pm10"):
            part.loc[rng.uniform(size=len(kept)) < nulls, c] = np.nan
        parts.append(part)
    return pd.concat(parts, ignore_index=True)


def ordered(df, *keys):
    pdf = df.toPandas() if hasattr(df, "toPandas") else df
    return pdf.sort_values(list(keys or ("city", "timestamp"))).reset_index(drop=True)


def same(got, expected, columns, tol=1e-9):
    assert len(got) == len(expected)
    for c in columns:
        x, y = got[c].astype(float).to_numpy(), expected[c].astype(float).to_numpy()
        assert (np.isnan(x) == np.isnan(y)).all(), c
        assert np.nanmax(np.abs(x - y), initial=0.0) < tol, c


def fixture(rows, **columns):
    """Hourly rows of one city as in the documented fixtures."""
    base = {
        "timestamp": pd.date_range("2026-01-01", periods=rows, freq="h"),
        "city": ["Testville"] * rows,
        "co": [300.0] * rows, "no": [1.0] * rows, "no2": [10.0] * rows, "o3": [20.0] * rows, "so2": [2.0] * rows, "nh3": [0.5] * rows,
    }
    return pd.DataFrame({**base, **columns})


def rising(rows):
    return fixture(rows, aqi=np.arange(rows) * 1.0, pm2_5=np.arange(rows) * 1.0, pm10=np.arange(1, rows + 1) * 1.0)


def flat(rows):
    return fixture(rows, aqi=[80.0] * rows, pm2_5=[20.0] * rows, pm10=[40.0] * rows)
