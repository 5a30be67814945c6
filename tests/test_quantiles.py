import struct

import numpy as np
import pytest
from helpers import frame, series
from pyspark.sql import functions as F

from aqspark.operators import horizon as H, quantiles as Q
from aqspark.operators.scale import scale_parameters
from aqspark.plans import pipelines as P
from aqspark.spec import ObsSpec

PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def test_bits_order_like_doubles(spark):
    rng = np.random.default_rng(0)
    edges = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), float("-inf"), 0.1, -0.1]
    powers = [2.0**k for k in range(-1074, 1024, 7)]
    v = edges + powers + [float(np.nextafter(x, 0)) for x in powers[1:]] + [float(x) for x in rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500)]
    for r in Q.ordered_bits(spark.createDataFrame([(x,) for x in v], "value double")).collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(r["value"])))[0]
        assert r["_bits"] == (-bits if r["value"] < 0 else bits)


@pytest.mark.parametrize("by, weight", [([], None), ([], "w"), (["g"], None), (["g"], "w")])
def test_log_spread_values_with_an_outlier(spark, by, weight):
    rng = np.random.default_rng(1)
    y = np.concatenate([10.0 ** rng.uniform(-5, 5, 5000), [1e300] * 3, -(10.0 ** rng.uniform(-3, 3, 500)), np.round(rng.normal(size=500))])
    w = rng.integers(-1, 5, len(y))
    df = spark.createDataFrame([(float(a), int(b), i % 3) for i, (a, b) in enumerate(zip(y, w))] + [(None, 3, 0), (float("nan"), 3, 1), (1.0, None, 9)], "x double, w int, g int").where("g < 9")
    got = {(r["g"] if by else 0, r["prob"]): r["value"] for r in Q.exact_quantiles(df.repartition(5), ["x"], PROBS, by, weight).collect()}
    for k in range(3 if by else 1):
        own = slice(k, None, 3) if by else slice(None)
        rows = np.repeat(y[own], np.maximum(w[own], 0)) if weight else y[own]
        assert all(got[k, p] == pytest.approx(np.quantile(rows, p), rel=1e-12) for p in PROBS)


def test_no_pass_counts_more_than_its_digits(spark):
    values = Q.ordered_bits(spark.range(300_000).select(F.expr("pow(10D, 600 * rand(3) - 300)").alias("value")))
    for digit in range(4):
        shift = 48 - 16 * digit
        assert values.groupBy(F.expr(f"shiftright(_bits, {shift + 16})" if digit else "'x'")).agg(F.expr(f"count(DISTINCT shiftright(_bits, {shift}))").alias("n")).agg(F.max("n")).first()[0] <= 65_536


def test_the_scaler_of_weighted_rows_is_that_of_the_expanded_frame(spark):
    pdf = series(1, (("a", 300), ("b", 90)), nulls=0.05)
    pdf["seq"] = range(len(pdf))
    prepared = P.preprocess_job(frame(spark, pdf), ObsSpec(seq="seq"), hours=30)
    rows = lambda df: {r["column"]: (r["center"], r["scale"]) for r in df.collect()}
    assert rows(prepared.parameters) == rows(scale_parameters(prepared.train(), prepared.features))


def test_targets_by_time_at_any_rate(spark):
    rows = [("a", f"2025-01-0{1 + i // 96} {i // 4 % 24:02d}:{15 * (i % 4):02d}:00", float(i)) for i in range(96 * 3)] + [("a", "2025-01-02 00:00:00", -1.0), ("b", "2025-01-01 00:07:00", 5.0)]
    df = spark.createDataFrame(rows, "city string, timestamp string, aqi double").withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    got = H.horizon_targets_time(df, ObsSpec(bucket_days=1), 5)
    a, b = df.alias("a"), df.alias("b")
    ahead = F.timestamp_diff("SECOND", F.col("a.timestamp"), F.col("b.timestamp"))
    expected = a.join(b, F.col("a.city") == F.col("b.city")).where(ahead.between(3600, 5 * 3600) & (ahead % 3600 == 0)).select("a.city", "a.timestamp", "a.aqi", (ahead / 3600).cast("int"), "b.aqi")
    assert sorted(map(tuple, got.select("city", "timestamp", "aqi", H.OFFSET, H.TARGET).collect())) == sorted(map(tuple, expected.collect()))
