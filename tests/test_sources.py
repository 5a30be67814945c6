import json

import numpy as np
import pandas as pd
import pytest
from helpers import frame, ordered, series
from pyspark.sql import functions as F

from aqspark.sources import observations as O, payloads as Pl, store as St
from aqspark.spec import ObsSpec

SPEC = ObsSpec()


def test_upsert_is_idempotent_and_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "table")
    pdf = series(1, (("a", 2000), ("b", 300)))
    base = frame(spark, pdf)
    St.upsert_features(path, base, SPEC)
    january = lambda: {f for f in spark.read.parquet(path).inputFiles() if "month_key=2025-01" in f}
    files = january()
    change = pdf[pdf.timestamp >= "2025-03-01"].head(50).assign(aqi=999.0)
    new = pd.concat([change, change.head(3).assign(city="z")])
    once = ordered(St.upsert_features(path, frame(spark, new), SPEC))
    twice = ordered(St.upsert_features(path, frame(spark, new), SPEC))
    assert len(once) == len(pdf) + 3 and once.equals(twice) and (once["aqi"] == 999).sum() == 53
    assert files and january() == files


def test_later_arrival_wins_inside_a_batch(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.0, 1), ("a", 3.0, 3), ("a", 2.0, 2)], "city string, aqi double, seq int").withColumn(
        "timestamp", F.lit("2025-01-01").cast("timestamp_ntz")
    )
    out = St.upsert_features(str(tmp_path / "t"), rows, ObsSpec(seq="seq")).collect()
    assert [r["aqi"] for r in out] == [3.0]
    merged = O.merge_history(rows, rows.withColumn("aqi", F.col("aqi") * 10), ObsSpec(seq="seq")).collect()
    assert [r["aqi"] for r in merged] == [30.0]


def test_prepare_for_store(spark):
    df = spark.createDataFrame(
        [("a", float("inf"), 1), (None, 1.0, 2), ("b", float("nan"), None)], "City string, `PM2-5 Raw` double, n int"
    ).withColumn("Timestamp", F.lit("2025-01-01 10:00:00").cast("timestamp"))
    out = St.prepare_for_store(df, SPEC)
    assert out.columns == ["city", "pm2_5_raw", "n", "timestamp"] and dict(out.dtypes)["timestamp"] == "timestamp_ntz"
    assert sorted((r["city"], r["pm2_5_raw"], r["n"]) for r in out.collect()) == [("a", 0.0, 1), ("b", 0.0, 0)]


def test_training_window_keeps_all_when_nothing_is_recent(spark):
    df = frame(spark, series(2, (("a", 200),)))
    total = df.count()
    assert St.training_window(df, "2030-01-01", SPEC).count() == total
    assert St.training_window(df, "2030-01-01", SPEC, fallback_all=False).count() == 0
    assert 0 < St.training_window(df, "2025-01-08", SPEC, 2).count() < total


def test_source_priority(spark):
    full = spark.range(3)
    assert O.source_priority([lambda: spark.read.parquet("/no/such"), spark.range(0), full]).count() == 3
    with pytest.raises(ValueError, match="no source has data"):
        O.source_priority([spark.range(0)])


def test_snapshots_and_latest(spark, tmp_path):
    for v in (1, 10, 9):
        St.write_snapshot(spark.range(v), str(tmp_path), v)
    assert St.latest_snapshot(spark.read.parquet(str(tmp_path))).count() == 10
    df = frame(spark, series(3, (("a", 200), ("b", 10))))
    assert St.latest_features(df, SPEC, 20).count() == 29
    assert St.latest_features(df, SPEC, 5, "b").agg(F.min("timestamp")).first()[0] > df.where("city = 'b'").agg(F.min("timestamp")).first()[0]


def test_unmatched_places_are_shown(spark):
    places = spark.createDataFrame([("x",), ("y",)], "place string")
    gazetteer = spark.createDataFrame([("x", 2.0), ("x", 1.0)], "place string, lat double")
    matched, unmatched = O.geocode_join(places, gazetteer, "place", ["lat"])
    assert [tuple(r) for r in matched.collect()] == [("x", 1.0)] and [r["place"] for r in unmatched.collect()] == ["y"]


def test_payloads(spark):
    weather = {"main": {"temp": 1, "feels_like": 2.5, "humidity": 3, "pressure": 4}, "wind": {"speed": 5}, "clouds": {"all": 6}, "weather": [{"main": "Rain"}]}
    air = {"list": [{"dt": 1735689600 + 3600 * i, "main": {"aqi": i + 1}, "components": {"pm2_5": 6.0 * (i + 1), "co": 1}} for i in range(3)]}
    df = spark.createDataFrame([(json.dumps(weather), json.dumps(air))], "w string, a string")
    w = Pl.parse_weather_payload(df.select("w"), "w").first()
    assert (w["temp"], w["wind_deg"], w["visibility"], w["weather_main"]) == (1.0, 0.0, 10000.0, "Rain")
    a = Pl.parse_air_payload(df.select("a"), "a").first()
    assert (a["aqi"], a["owm_aqi"], a["pm2_5"], a["nh3"]) == (25.0, 1, 6.0, 0.0)
    h = ordered(Pl.explode_history_payload(df.select("a"), "a"), "timestamp")
    assert h["timestamp"].tolist() == list(pd.date_range("2025-01-01", periods=3, freq="h"))
    assert np.allclose(h["pm2_5"], [6, 12, 18]) and "owm_aqi" not in h.columns


def test_a_folder_has_few_files(spark, tmp_path):
    hours = spark.range(0, 4000, 1, 12).select(F.concat(F.lit("c"), F.col("id") % 20).alias("city"), F.expr("TIMESTAMP_NTZ '2025-01-01 00:00:00' + make_dt_interval(0, CAST(id AS INT))").alias("timestamp"), F.col("id").cast("double").alias("aqi"))
    path = str(tmp_path / "processed")
    St.write_processed(hours.repartition(12), path, ObsSpec())
    read = spark.read.parquet(path)
    folders = read.select("month_key", "shard").distinct().count()
    assert read.count() == 4000 and len(read.inputFiles()) == folders


def test_columns_added_by_a_later_upsert_stay(spark, tmp_path):
    from aqspark.sources import store
    from aqspark.spec import ObsSpec

    spec, path = ObsSpec(), str(tmp_path / "table")
    row = lambda day, **more: spark.createDataFrame([{"city": "a", "timestamp": day, "aqi": 1.0, **more}]).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    St.upsert_features(path, row("2025-01-01"), spec)
    St.upsert_features(path, row("2025-02-01", temp=7.0), spec)
    out = St.upsert_features(path, row("2025-02-02"), spec)
    assert sorted((str(r["timestamp"])[:10], r["temp"]) for r in out.collect()) == [("2025-01-01", None), ("2025-02-01", 7.0), ("2025-02-02", None)]
    assert St.prepare_for_store(row("2025-01-01").withColumn("aqi", F.lit(None).cast("double")), spec, zero_fill=False).first()["aqi"] is None


def _files(df):
    """How many files the scans of a query would read, after pruning."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_key" in plan or "month_key" in plan.split("PartitionFilters: ", 1)[1][:400]
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_reads_of_the_table_prune_months_and_shards(spark, tmp_path):
    pdf = series(4, (("a", 4000), ("b", 3000), ("c", 2500), ("d", 900)))
    St.upsert_features(str(tmp_path / "t"), frame(spark, pdf), SPEC)
    table, plain = St.open_features(spark, str(tmp_path / "t")), frame(spark, pdf)
    keys = lambda df: sorted(map(tuple, df.select("city", "timestamp").collect()))
    for as_of, days in (("2025-06-10", 20), ("2025-05-01", 3), ("2031-01-01", 90)):
        window = St.training_window(table, as_of, SPEC, days)
        assert keys(window) == keys(St.training_window(plain, as_of, SPEC, days))
        months = {f.split("month_key=")[1][:7] for f in _files(window)}
        assert min(months) >= "2025-04" or as_of > "2030"
    for city, n in (("a", 48), ("d", 5000), ("b", 1500), ("nowhere", 5)):
        latest = St.latest_features(table, SPEC, n, city)
        assert keys(latest) == keys(St.latest_features(plain, SPEC, n, city))
        scanned = _files(St.rows_of_entity(table, SPEC, city, n))
        assert len({f.split("shard=")[1][:1] for f in scanned}) == (city != "nowhere")
        months = {f.split("month_key=")[1][:7] for f in scanned}
        assert n > 1500 or len(months) <= n // 600 + 2
