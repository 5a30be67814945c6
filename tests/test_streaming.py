import numpy as np
import pandas as pd
from helpers import frame, ordered, series
from pyspark.sql import functions as F

from aqspark.operators import features as Ft
from aqspark.sources import store as St
from aqspark.spec import ObsSpec
from aqspark.streaming import jobs as J

SPEC = ObsSpec()


def feed(spark, folder, parts):
    """One file per part, read one per micro-batch in order."""
    schema = None
    for i, pdf in enumerate(parts):
        df = frame(spark, pdf)
        schema = df.schema
        df.coalesce(1).write.mode("append").parquet(f"{folder}/{i:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(folder)


def test_features_equal_batch_with_late_rows_and_gaps(spark, tmp_path):
    pdf = series(1, (("a", 1700), ("b", 200), ("c", 3)))
    pdf.loc[pdf.sample(frac=0.1, random_state=9).index, "aqi"] = np.nan
    late = pdf.sample(60, random_state=5)
    rest = pdf.drop(late.index)
    first = rest[rest.timestamp < "2025-03-01"]
    second = rest[rest.timestamp >= "2025-03-01"]
    stream = feed(spark, str(tmp_path / "in"), [first, second, late])
    J.stream_features(stream, str(tmp_path / "obs"), str(tmp_path / "feat"), str(tmp_path / "cp"), SPEC, lookback_days=10).awaitTermination()
    got = ordered(St.read_features(spark, str(tmp_path / "feat")))
    df = frame(spark, pdf)
    expected = ordered(Ft.all_features(df, SPEC)).fillna(0)
    assert len(got) == len(expected)
    for c in Ft.feature_names(df, SPEC):
        assert np.allclose(got[c].astype(float), expected[c].astype(float), atol=1e-8), c


def test_a_late_row_of_one_city_doesnt_widen_the_months_of_others(spark, tmp_path):
    pdf = series(6, (("a", 3000), ("b", 3000), ("c", 3000), ("d", 3000), ("e", 3000)))
    St.write_processed(frame(spark, pdf), str(tmp_path / "obs"), SPEC, 8)
    since = spark.createDataFrame([("a", "2025-02-03 00:00:00"), ("b", "2025-05-01 00:00:00")], "city string, _since string").withColumn("_since", F.col("_since").cast("timestamp_ntz"))
    context = J._context(spark, str(tmp_path / "obs"), since, SPEC, 8, 10)
    shard = {r[0]: r[1] for r in frame(spark, pdf).select("city", St.partition_columns(SPEC, 8)[St.SHARD]).distinct().collect()}
    assert shard["a"] != shard["b"]
    assert {r[0] for r in context.select("city").distinct().collect()} == {"a", "b"}
    # b is read from its own first month on (with what its features can see before), not from that of a
    first = {r[0]: r[1] for r in context.groupBy("city").agg(F.min("timestamp")).collect()}
    assert first["b"].month >= 2 and first["a"].month == 1
    filters = [x for x in context._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: ")[1:]]
    assert sum("(month_key" in x[:300] and "shard" in x[:300] for x in filters) >= 2


def test_upsert_and_daily(spark, tmp_path):
    pdf = series(2, (("a", 200), ("b", 60)))
    changed = pdf.head(40).assign(aqi=1.0)
    J.stream_upsert(feed(spark, str(tmp_path / "in"), [pdf, changed]), str(tmp_path / "t"), str(tmp_path / "cp"), SPEC).awaitTermination()
    table = St.read_features(spark, str(tmp_path / "t"))
    assert table.count() == len(pdf) and table.where("aqi = 1").count() >= 40
    half = pdf.timestamp < "2025-01-03 12:00"
    stream = feed(spark, str(tmp_path / "in2"), [pdf[half], pdf[~half]])
    J.stream_daily(stream, str(tmp_path / "d"), str(tmp_path / "cp2"), SPEC, delay="30 days").awaitTermination()
    got, expected = ordered(St.read_features(spark, str(tmp_path / "d"))), ordered(J.batch_daily(frame(spark, pdf), SPEC))
    assert len(got) == len(expected) and np.allclose(got["aqi_mean"], expected["aqi_mean"]) and (got["rows"] == expected["rows"]).all()


def test_ingest_drops_repeats(spark, tmp_path):
    pdf = series(3, (("a", 100),))
    J.stream_ingest(feed(spark, str(tmp_path / "in"), [pd.concat([pdf, pdf.head(30)])]), str(tmp_path / "t"), str(tmp_path / "cp"), SPEC).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).agg(F.count("*"), F.countDistinct("timestamp")).first() == (len(pdf), len(pdf))
