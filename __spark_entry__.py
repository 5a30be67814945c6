"""Registered queries over the driver's tables, each with its SQL counterpart where SQL can express it.

The tables hold no air-quality readings, so readings are derived from them: ``events`` becomes hourly
observations per event type. Every query runs over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from aqspark import spec as S
from aqspark.functions import calendar as Cal, scalar as X
from aqspark.operators import attribution as A, blocks as B, clean as C, evaluate as E, explore as Ex
from aqspark.operators import features as Ft, forecast as Fc, horizon as H, ml as M, quantiles as Q, scale as Sc
from aqspark.plans import pipelines as P
from aqspark.sources import observations as O, payloads as Pl, registry as R, store as St
from aqspark.sources.staging import new_path, stage
from aqspark.spec import ObsSpec
from aqspark.streaming import jobs as J

SPEC = ObsSpec()
RAW = ObsSpec(seq="event_id")
AS_OF = "2024-01-31 00:00:00"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLES[name] = sql
        return fn

    return register


# ---- derived inputs ------------------------------------------------------------------------


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def readings(spark: SparkSession, d: str) -> DataFrame:
    """One row per event: city, timestamp, aqi, k, event_id."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, d, "events").select(
        F.col("event_type").alias("city"), F.col("ts").alias("timestamp"), F.col("value").alias("aqi"), k.alias("k"), "event_id"
    )


READINGS = """readings AS (SELECT event_type AS city, ts AS timestamp, value AS aqi,
  CAST(json_extract(props, '$.k') AS INT) AS k, event_id FROM events)"""


def _hour(c: str) -> Column:
    return F.date_trunc("hour", F.col(c)).cast("timestamp_ntz")


def obs(spark: SparkSession, d: str, entity: str = "event_type") -> DataFrame:
    """Hourly means and extremes per entity; decimal sums make them the same in every engine."""
    k = F.get_json_object("props", "$.k").cast("int").alias("k")
    events = table(spark, d, "events").select(F.col(entity).cast("string").alias("city"), _hour("ts").alias("timestamp"), "value", k)
    n = F.count("*")
    return events.groupBy("city", "timestamp").agg(
        (F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / n).alias("aqi"),
        (F.sum("k").cast("double") / n).alias("pm2_5"),
        F.max("k").cast("double").alias("pm10"),
        F.min("k").cast("double").alias("no2"),
        F.max("value").alias("o3"),
    )


OBS = """obs AS (SELECT event_type AS city, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS timestamp,
  CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS aqi, CAST(SUM(k) AS DOUBLE) / COUNT(*) AS pm2_5,
  CAST(MAX(k) AS DOUBLE) AS pm10, CAST(MIN(k) AS DOUBLE) AS no2, MAX(value) AS o3
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events) GROUP BY 1, 2)"""


def gappy(spark: SparkSession, d: str) -> DataFrame:
    """Observations with gaps: zeros and high values unknown, ``o3`` never reported by one city."""
    return obs(spark, d).select(
        "city",
        "timestamp",
        F.when(F.col("pm10") <= 90, F.col("aqi")).alias("aqi"),
        F.nullif("no2", F.lit(0.0)).alias("no2"),
        F.when(F.col("city") != "error", F.col("o3")).alias("o3"),
    )


GAPPY = OBS + """, gappy AS (SELECT city, timestamp, CASE WHEN pm10 <= 90 THEN aqi END AS aqi, NULLIF(no2, 0.0) AS no2,
  CASE WHEN city <> 'error' THEN o3 END AS o3 FROM obs)"""


def rounded(c: str | Column) -> Column:
    """Five decimals, half up, with a tolerance so that last-bit differences of engines cannot flip a tie."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * 1e5 + 0.5001) / 1e5


def R5(expr: str, name: str | None = None) -> str:
    return f"floor(({expr}) * 1e5 + 0.5001) / 1e5" + (f" AS {name}" if name else "")


def show(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return df.select(*keys, *[rounded(v).alias(v) for v in values])


KEY = ["city", "timestamp"]
W = "OVER (PARTITION BY city ORDER BY timestamp)"


def rows_frame(lo: str, hi: str) -> str:
    return f"OVER (PARTITION BY city ORDER BY timestamp ROWS BETWEEN {lo} AND {hi})"


# ---- sources and sinks ---------------------------------------------------------------------


@query("read_observations", f"WITH {OBS} SELECT city, timestamp, {R5('aqi', 'aqi')}, {R5('pm2_5', 'pm2_5')} FROM obs")
def _(spark, d):
    path = new_path(spark, "csv")
    obs(spark, d).select("timestamp", "city", "aqi", "pm2_5").write.csv(path, header=True)
    return show(O.read_observations(spark, path, "csv"), KEY, ["aqi", "pm2_5"])


@query(
    "parse_weather_payload",
    f"""WITH {READINGS} SELECT event_id, aqi AS temp, CAST(k AS DOUBLE) AS feels_like, CAST(k AS DOUBLE) AS humidity,
    1000.0::DOUBLE + k AS pressure, aqi / 10.0::DOUBLE AS wind_speed, CASE WHEN k % 2 = 0 THEN 0.0::DOUBLE ELSE CAST(k AS DOUBLE) END AS wind_deg,
    CAST(k AS DOUBLE) AS clouds, CASE WHEN k % 3 = 0 THEN 10000.0::DOUBLE ELSE CAST(k AS DOUBLE) END AS visibility, city AS weather_main
    FROM readings""",
)
def _(spark, d):
    k = F.col("k").cast("double")
    payload = F.to_json(
        F.struct(
            F.struct(
                F.col("aqi").alias("temp"), k.alias("feels_like"), k.alias("humidity"), (F.lit(1000.0) + k).alias("pressure")
            ).alias("main"),
            F.struct((F.col("aqi") / 10.0).alias("speed"), F.when(F.col("k") % 2 != 0, k).alias("deg")).alias("wind"),
            F.struct(k.alias("all")).alias("clouds"),
            F.when(F.col("k") % 3 != 0, k).alias("visibility"),
            F.array(F.struct(F.col("city").alias("main"))).alias("weather"),
        )
    )
    return Pl.parse_weather_payload(readings(spark, d).select("event_id", payload.alias("payload")))


def _air_item(shift_hours: int) -> Column:
    k = F.col("k").cast("double")
    seconds = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.date_trunc("second", "timestamp").cast("timestamp_ntz"))
    return F.struct(
        (seconds + 3600 * shift_hours).alias("dt"),
        F.struct((F.col("k") % 7).alias("aqi")).alias("main"),
        F.struct(
            F.when(F.col("k") % 10 != 0, F.col("aqi") * 1.2).alias("pm2_5"),
            k.alias("pm10"),
            F.when(F.col("k") % 2 != 0, k).alias("co"),
        ).alias("components"),
    )


def epa_sql(owm: str, pm: str) -> str:
    pm = f"COALESCE({pm}, 0.0::DOUBLE)"

    def one_decimal(v: str) -> str:
        # half up on the printed digits; rounding a double first multiplies it by ten and may land on a tie
        return f"CAST(round(CAST(CAST({v} AS VARCHAR) AS DECIMAL(30, 18)), 1) AS DOUBLE)"

    whens = " ".join(
        f"WHEN {pm} BETWEEN {c_lo}::DOUBLE AND {c_hi}::DOUBLE THEN "
        + one_decimal(f"{(i_hi - i_lo) / (c_hi - c_lo)!r}::DOUBLE * ({pm} - {c_lo}::DOUBLE) + {i_lo}::DOUBLE")
        for c_lo, c_hi, i_lo, i_hi in S.PM25_BREAKPOINTS
    )
    coarse = " ".join(f"WHEN {owm} = {k} THEN {v}::DOUBLE" for k, v in S.COARSE_AQI.items())
    return f"CASE {whens} {coarse} ELSE {S.COARSE_AQI_DEFAULT}::DOUBLE END"


AIR = f"""air AS (SELECT *, k % 7 AS owm, CASE WHEN k % 10 <> 0 THEN aqi * 1.2::DOUBLE END AS pm FROM readings)"""
AIR_COLUMNS = """COALESCE(pm, 0.0::DOUBLE) AS pm2_5, CAST(k AS DOUBLE) AS pm10, CASE WHEN k % 2 <> 0 THEN CAST(k AS DOUBLE) ELSE 0.0::DOUBLE END AS co,
    0.0::DOUBLE AS no, 0.0::DOUBLE AS no2, 0.0::DOUBLE AS o3, 0.0::DOUBLE AS so2, 0.0::DOUBLE AS nh3"""


@query(
    "parse_air_payload",
    f"WITH {READINGS}, {AIR} SELECT event_id, {epa_sql('owm', 'pm')} AS aqi, owm AS owm_aqi, {AIR_COLUMNS} FROM air",
)
def _(spark, d):
    payload = F.to_json(F.struct(F.array(_air_item(0), _air_item(1)).alias("list")))
    return Pl.parse_air_payload(readings(spark, d).select("event_id", payload.alias("payload")))


@query(
    "explode_history_payload",
    f"""WITH {READINGS}, {AIR} SELECT event_id, CAST(date_trunc('second', timestamp) AS TIMESTAMP) + h * INTERVAL 1 HOUR AS timestamp,
    {epa_sql('owm', 'pm')} AS aqi, {AIR_COLUMNS} FROM air, (VALUES (0), (1), (2)) v(h)""",
)
def _(spark, d):
    payload = F.to_json(F.struct(F.array(*[_air_item(h) for h in range(3)]).alias("list")))
    return Pl.explode_history_payload(readings(spark, d).select("event_id", payload.alias("payload")))


@query(
    "geocode_join",
    """SELECT c_custkey, c_name, n_name, COALESCE(n_regionkey, -1) AS n_regionkey, (n_name IS NULL) AS unmatched FROM customer
    LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 5 <> 0) n ON c_nationkey = n.n_nationkey""",
)
def _(spark, d):
    gazetteer = table(spark, d, "nation").where("n_nationkey % 5 <> 0").withColumnRenamed("n_nationkey", "c_nationkey")
    places = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    matched, unmatched = O.geocode_join(places, gazetteer, "c_nationkey", ["n_name", "n_regionkey"])
    both = matched.withColumn("unmatched", F.lit(False)).unionByName(
        unmatched.withColumn("unmatched", F.lit(True)), allowMissingColumns=True
    )
    return both.drop("c_nationkey").fillna(-1, subset=["n_regionkey"])


@query("source_priority", f"WITH {OBS} SELECT city, CAST(COUNT(*) AS BIGINT) AS rows FROM obs GROUP BY city")
def _(spark, d):
    missing = lambda: spark.read.parquet(f"{d}/no_such_table.parquet")
    empty = obs(spark, d).where(F.lit(False))
    return O.source_priority([missing, empty, lambda: obs(spark, d)]).groupBy("city").agg(F.count("*").alias("rows"))


@query(
    "fresh_within_ttl",
    f"WITH {READINGS} SELECT event_id, city FROM readings WHERE TIMESTAMP '2024-01-15 12:00:00' - timestamp < INTERVAL 36000 SECOND",
)
def _(spark, d):
    return O.fresh_within_ttl(readings(spark, d), "2024-01-15 12:00:00", "timestamp", 36000).select("event_id", "city")


def _halves(spark, d) -> tuple[DataFrame, DataFrame]:
    """Hourly readings, earlier and later arrivals; many keys are in both."""
    rows = readings(spark, d).withColumn("timestamp", _hour("timestamp"))
    return rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")


@query(
    "merge_history",
    f"""WITH {READINGS}, h AS (SELECT *, CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS t FROM readings)
    SELECT city, t AS timestamp, aqi, event_id FROM h
    QUALIFY row_number() OVER (PARTITION BY city, t ORDER BY event_id % 2 DESC, event_id DESC) = 1""",
)
def _(spark, d):
    existing, incoming = _halves(spark, d)
    return O.merge_history(existing, incoming, RAW).select(*KEY, "aqi", "event_id")


@query(
    "prepare_for_store",
    f"""WITH {OBS} SELECT city, timestamp, CASE WHEN pm10 > 50 THEN aqi ELSE 0.0::DOUBLE END AS air_index,
    CASE WHEN pm10 > 0 THEN no2 / pm10 ELSE 0.0::DOUBLE END AS no2_share FROM obs WHERE pm10 <> 7""",
)
def _(spark, d):
    share = F.when(F.col("pm10") > 0, F.col("no2") / F.nullif("pm10", F.lit(0.0))).otherwise(F.lit(float("inf")))
    raw = obs(spark, d).select(
        F.when(F.col("pm10") != 7, F.col("city")).alias("City"),
        F.col("timestamp").alias("Timestamp"),
        F.when(F.col("pm10") > 50, F.col("aqi")).otherwise(F.lit(float("nan"))).alias("Air Index"),
        share.alias("no2-share"),
    )
    return St.prepare_for_store(raw, SPEC)


@query(
    "upsert_features",
    f"""WITH {OBS}, inc AS (SELECT city, timestamp, aqi + 1000 AS aqi FROM obs WHERE pm10 >= 50
    UNION ALL SELECT city, timestamp + INTERVAL 31 DAY, aqi FROM obs WHERE pm10 < 10)
    SELECT city, timestamp, {R5('aqi', 'aqi')} FROM (SELECT city, timestamp, aqi FROM inc
    UNION ALL SELECT city, timestamp, aqi FROM obs WHERE (city, timestamp) NOT IN (SELECT (city, timestamp) FROM inc))""",
)
def _(spark, d):
    base = obs(spark, d).select(*KEY, "aqi", "pm10")
    changed = base.where("pm10 >= 50").select(*KEY, (F.col("aqi") + 1000).alias("aqi"))
    later = base.where("pm10 < 10").select("city", (F.col("timestamp") + F.expr("INTERVAL 31 DAY")).alias("timestamp"), "aqi")
    path = new_path(spark, "table")
    St.upsert_features(path, base.drop("pm10"), SPEC)
    return show(St.upsert_features(path, changed.unionByName(later), SPEC), KEY, ["aqi"])


def _stored(spark, d) -> DataFrame:
    """Observations of two months more, so that there are months to leave out, as a partitioned table."""
    o = obs(spark, d).select(*KEY, "pm10")
    earlier = o.withColumn("timestamp", F.col("timestamp") - F.expr("INTERVAL 62 DAY"))
    path = new_path(spark, "table")
    St.upsert_features(path, o.unionByName(earlier), SPEC)
    return St.open_features(spark, path)


STORED = OBS + ", stored AS (SELECT city, timestamp, pm10 FROM obs UNION ALL SELECT city, timestamp - INTERVAL 62 DAY, pm10 FROM obs)"


@query(
    "training_window_table",
    f"""WITH {STORED} SELECT 'recent' AS window, city, timestamp, pm10 FROM stored WHERE timestamp >= TIMESTAMP '2024-01-21 00:00:00'
    UNION ALL SELECT 'none', city, timestamp, pm10 FROM stored""",
)
def _(spark, d):
    table_ = _stored(spark, d)
    recent = St.training_window(table_, AS_OF, SPEC, 10)
    none = St.training_window(table_, "2030-01-01", SPEC, 10)
    return recent.withColumn("window", F.lit("recent")).unionByName(none.withColumn("window", F.lit("none"))).select("window", *KEY, "pm10")


@query("latest_features_table", f"WITH {STORED} SELECT city, timestamp, pm10 FROM stored WHERE city = 'click' ORDER BY timestamp DESC LIMIT 900")
def _(spark, d):
    return St.latest_features(_stored(spark, d), SPEC, 900, "click")


@query(
    "training_window",
    f"""WITH {OBS} SELECT 'recent' AS window, city, timestamp, pm10 FROM obs WHERE timestamp >= TIMESTAMP '2024-01-21 00:00:00'
    UNION ALL SELECT 'none', city, timestamp, pm10 FROM obs""",
)
def _(spark, d):
    o = obs(spark, d)
    recent = St.training_window(o, AS_OF, SPEC, 10)
    none = St.training_window(o, "2030-01-01", SPEC, 10)
    return (
        recent.withColumn("window", F.lit("recent")).unionByName(none.withColumn("window", F.lit("none"))).select("window", *KEY, "pm10")
    )


@query(
    "latest_features",
    f"""WITH {OBS}, r AS (SELECT *, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) AS n FROM obs)
    SELECT 'all' AS scope, city, timestamp, pm10 FROM r WHERE n <= 48 UNION ALL
    SELECT 'one', city, timestamp, pm10 FROM r WHERE n <= 120 AND city = 'click'""",
)
def _(spark, d):
    o = obs(spark, d)
    every = St.latest_features(o, SPEC, 48).withColumn("scope", F.lit("all"))
    one = St.latest_features(o, SPEC, 120, "click").withColumn("scope", F.lit("one"))
    return every.unionByName(one).select("scope", *KEY, "pm10")


@query(
    "write_processed",
    f"WITH {OBS} SELECT city, timestamp, {R5('aqi', 'aqi')}, CAST(hour(timestamp) AS INT) AS hour FROM obs",
)
def _(spark, d):
    path = new_path(spark, "processed")
    St.write_processed(Cal.calendar_features(obs(spark, d)), path, SPEC)
    return show(St.read_features(spark, path), [*KEY, "hour"], ["aqi"])


@query("latest_snapshot", f"WITH {OBS} SELECT city, timestamp, pm10, 3 AS version FROM obs WHERE pm10 > 20")
def _(spark, d):
    root = new_path(spark, "snapshots")
    for version, least in ((1, 0), (2, 60), (3, 20)):
        St.write_snapshot(obs(spark, d).where(F.col("pm10") > least).select(*KEY, "pm10"), root, version)
    return St.latest_snapshot(spark.read.parquet(root))


@query(
    "list_cities",
    f"WITH {OBS} SELECT DISTINCT city, city = 'click' AS is_default, (SELECT COUNT(DISTINCT city) FROM obs) AS total FROM obs",
)
def _(spark, d):
    return O.city_listing(obs(spark, d), SPEC, "click")


def _versions(spark, d) -> DataFrame:
    """Model versions derived from supplier rows."""
    return table(spark, d, "supplier").select(
        F.col("s_suppkey").cast("int").alias("version"),
        F.col("s_name").alias("model_name"),
        F.when(F.col("s_nationkey") % 3 == 0, F.col("s_acctbal")).alias("rmse"),
        F.concat(F.lit("2024-01-"), F.format_string("%02d", F.col("s_nationkey") + 1)).alias("trained_at"),
        F.col("s_nationkey").alias("nation"),
    )


VERSIONS = """versions AS (SELECT CAST(s_suppkey AS INT) AS version, s_name AS model_name, CASE WHEN s_nationkey % 3 = 0 THEN s_acctbal END AS rmse,
  printf('2024-01-%02d', s_nationkey + 1) AS trained_at, s_nationkey AS nation FROM supplier)"""


@query(
    "registry_best",
    f"""WITH {VERSIONS}, a AS (SELECT 'scored' AS kind, version, model_name, rmse FROM versions ORDER BY rmse NULLS LAST, version LIMIT 1),
    b AS (SELECT 'unscored' AS kind, version, model_name, rmse FROM versions WHERE rmse IS NULL ORDER BY version DESC LIMIT 1)
    SELECT * FROM a UNION ALL SELECT * FROM b""",
)
def _(spark, d):
    v = _versions(spark, d).select("version", "model_name", "rmse")
    scored = R.registry_best(v).withColumn("kind", F.lit("scored"))
    unscored = R.registry_best(v.where("rmse IS NULL")).withColumn("kind", F.lit("unscored"))
    return scored.unionByName(unscored).select("kind", "version", "model_name", "rmse")


@query(
    "newest_metadata",
    f"""WITH {VERSIONS}, m AS (SELECT * FROM versions WHERE version = (SELECT max(version) FROM versions WHERE nation < 12)
    UNION ALL SELECT * FROM versions WHERE version = (SELECT max(version) FROM versions WHERE nation >= 12)),
    best AS (SELECT * FROM m ORDER BY trained_at DESC LIMIT 1)
    SELECT p_partkey, best.model_name, COALESCE(best.rmse, p_retailprice) AS rmse FROM part, best""",
)
def _(spark, d):
    v = _versions(spark, d)
    first = v.where("nation < 12").orderBy(F.desc("version")).limit(1)
    second = v.where("nation >= 12").orderBy(F.desc("version")).limit(1)
    newest = R.newest_metadata(first, second)
    forecasts = table(spark, d, "part").select("p_partkey", F.lit("old").alias("model_name"), F.col("p_retailprice").alias("rmse"))
    return R.apply_metadata(forecasts, newest, ("model_name", "rmse"))


# ---- projections, filters, scalar functions ------------------------------------------------

CALENDAR_SQL = """CAST(hour(timestamp) AS INT) AS hour, CAST(isodow(timestamp) - 1 AS INT) AS day_of_week, CAST(day(timestamp) AS INT) AS day_of_month,
    CAST(month(timestamp) AS INT) AS month, CAST(isodow(timestamp) >= 6 AS INT) AS is_weekend, CAST(quarter(timestamp) AS INT) AS quarter"""
CYCLIC_EXPR = {
    f"{name}_{fn}": f"{fn}(2 * pi() * {part} / {period}.0::DOUBLE)"
    for name, part, period in (("hour", "hour(timestamp)", 24), ("month", "month(timestamp)", 12), ("dow", "(isodow(timestamp) - 1)", 7))
    for fn in ("sin", "cos")
}
CYCLIC_SQL = ", ".join(R5(e, n) for n, e in CYCLIC_EXPR.items())


@query("calendar_features", f"WITH {OBS} SELECT city, timestamp, {CALENDAR_SQL} FROM obs")
def _(spark, d):
    return Cal.calendar_features(obs(spark, d)).select(*KEY, *Cal.CALENDAR)


@query("cyclic_features", f"WITH {OBS} SELECT city, timestamp, {CYCLIC_SQL} FROM obs")
def _(spark, d):
    return show(Cal.cyclic_features(obs(spark, d)), KEY, list(Cal.CYCLIC))


@query("owm_to_epa", f"WITH {READINGS}, {AIR} SELECT event_id, {epa_sql('owm', 'pm')} AS strict, {epa_sql('owm', 'floor(pm * 10) / 10.0::DOUBLE')} AS contiguous FROM air")
def _(spark, d):
    r = readings(spark, d).withColumns({"owm": F.col("k") % 7, "pm": F.when(F.col("k") % 10 != 0, F.col("aqi") * 1.2)})
    return r.select(
        "event_id", X.owm_to_epa("owm", "pm").alias("strict"), X.owm_to_epa("owm", "pm", "contiguous").alias("contiguous")
    )


def category_sql(v: str, part: int, mode: str = "strict") -> str:
    low, whens = 0, []
    for row in S.CATEGORIES:
        test = f"{v} BETWEEN {row[0]} AND {row[1]}" if mode == "strict" else f"{v} >= {low} AND {v} <= {row[1]}"
        whens.append(f"WHEN {test} THEN '{row[part]}'")
        low = row[1]
    return f"CASE WHEN {v} IS NULL THEN NULL {' '.join(whens)} ELSE '{S.CATEGORIES[-1][part]}' END"


@query(
    "aqi_category",
    f"""WITH {OBS} SELECT city, timestamp, {category_sql('aqi', 2)} AS label, {category_sql('aqi', 3)} AS color, {category_sql('aqi', 4)} AS emoji,
    {category_sql('aqi', 2, 'contiguous')} AS contiguous FROM obs""",
)
def _(spark, d):
    cat = X.aqi_category("aqi")
    return obs(spark, d).select(*KEY, cat["label"].alias("label"), cat["color"].alias("color"), cat["emoji"].alias("emoji"), X.aqi_category("aqi", "contiguous")["label"].alias("contiguous"))


@query(
    "category_class",
    f"""WITH {OBS} SELECT city, timestamp, CASE WHEN aqi <= 50 THEN 'bg-good' WHEN aqi <= 100 THEN 'bg-moderate' WHEN aqi <= 150 THEN 'bg-sensitive'
    WHEN aqi <= 200 THEN 'bg-unhealthy' WHEN aqi <= 300 THEN 'bg-very' ELSE 'bg-haz' END AS class FROM obs""",
)
def _(spark, d):
    return obs(spark, d).select(*KEY, X.category_class("aqi").alias("class"))


@query("alert_flag", f"WITH {OBS} SELECT city, timestamp, aqi > 150 AS alert FROM obs")
def _(spark, d):
    return obs(spark, d).select(*KEY, X.alert_flag("aqi").alias("alert"))


@query("alert_level", f"WITH {OBS} SELECT city, timestamp, CASE WHEN aqi > 200 THEN 'danger' WHEN aqi > 150 THEN 'warning' ELSE 'none' END AS level FROM obs")
def _(spark, d):
    return obs(spark, d).select(*KEY, X.alert_level("aqi").alias("level"))


@query("clip_range", f"WITH {GAPPY} SELECT city, timestamp, {R5('CASE WHEN aqi IS NOT NULL THEN LEAST(GREATEST(aqi * 20 - 300, 0), 500) END', 'aqi')} FROM gappy")
def _(spark, d):
    return show(C.clip_target(gappy(spark, d).withColumn("aqi", F.col("aqi") * 20 - 300), SPEC), KEY, ["aqi"])


RATIO_SQL = {
    "pm_ratio": "pm2_5 / COALESCE(NULLIF(pm10, 0), 1)",
    "no2_o3_ratio": "no2 / COALESCE(NULLIF(o3, 0), 1)",
}


@query("pollutant_ratios", f"WITH {OBS} SELECT city, timestamp, {', '.join(R5(e, n) for n, e in RATIO_SQL.items())} FROM obs")
def _(spark, d):
    return show(Ft.ratio_features(obs(spark, d)), KEY, list(RATIO_SQL))


@query("filter_cities", f"WITH {OBS} SELECT city, timestamp, pm10 FROM obs WHERE city IN ('click', 'view')")
def _(spark, d):
    listed = spark.createDataFrame([("click",), ("view",), ("view",)], "name string")
    both = C.filter_entities(obs(spark, d), listed, SPEC)
    return C.filter_entities(both, ["click", "view", "other"], SPEC).select(*KEY, "pm10")


@query(
    "match_city",
    f"WITH {OBS} SELECT city, timestamp, lower(city) = lower('CLICK') AS ignore_case, city = 'click' AS exact, upper(city[1]) || city[2:] = 'View' AS title FROM obs",
)
def _(spark, d):
    titled = X.match_name(X.title_case("city"), "  vIEW ", "title")
    return obs(spark, d).select(
        *KEY, X.match_name("city", "CLICK", "ignore_case").alias("ignore_case"), X.match_name("city", "click").alias("exact"), titled.alias("title")
    )


@query("drop_null_target", f"WITH {GAPPY} SELECT city, timestamp, no2 FROM gappy WHERE aqi IS NOT NULL")
def _(spark, d):
    return C.drop_null_target(gappy(spark, d), SPEC).select(*KEY, "no2")


@query("drop_incomplete", f"WITH {GAPPY} SELECT city, timestamp, no2, o3 FROM gappy WHERE aqi IS NOT NULL AND no2 IS NOT NULL AND o3 IS NOT NULL")
def _(spark, d):
    return C.drop_incomplete(gappy(spark, d)).select(*KEY, "no2", "o3")


@query(
    "zero_fill_payload",
    f"WITH {OBS} SELECT city, timestamp, CASE WHEN no2 = 0 THEN 0.0::DOUBLE ELSE {R5('pm10 / no2')} END AS share, CASE WHEN pm10 > 90 THEN 0.0::DOUBLE ELSE pm10 END AS pm10 FROM obs",
)
def _(spark, d):
    share = F.when(F.col("no2") == 0, F.lit(float("-inf"))).otherwise(F.col("pm10") / F.nullif("no2", F.lit(0.0)))
    raw = obs(spark, d).select(*KEY, share.alias("share"), F.when(F.col("pm10") <= 90, F.col("pm10")).alias("pm10"))
    return show(Pl.zero_fill_payload(raw), [*KEY, "pm10"], ["share"])


@query(
    "feature_columns",
    f"""WITH {OBS} SELECT feature, {R5('m', 'mean')} FROM (UNPIVOT (SELECT avg(pm2_5) AS pm2_5, avg(pm10) AS pm10, avg(no2) AS no2, avg(o3) AS o3,
    avg(CAST(hour(timestamp) AS DOUBLE)) AS hour FROM obs) ON pm2_5, pm10, no2, o3, hour INTO NAME feature VALUE m)""",
)
def _(spark, d):
    df = obs(spark, d).withColumns({"hour": F.hour("timestamp"), "aqi_diff_1h": F.lit(0.0), "target_aqi": F.col("aqi")})
    names = H.feature_columns(df)
    means = df.agg(*[F.avg(c).alias(c) for c in names])
    cells = [F.struct(F.lit(c).alias("feature"), rounded(c).alias("mean")) for c in names]
    return means.select(F.explode(F.array(*cells)).alias("e")).select("e.*")


@query("align_features", f"WITH {OBS} SELECT city, timestamp, o3, 0.0::DOUBLE AS temp, pm10 FROM obs")
def _(spark, d):
    return Fc.align_features(obs(spark, d), ["o3", "temp", "pm10"], KEY)


@query("round_report", "SELECT o_orderkey, round(o_totalprice, 1) AS aqi, round(o_totalprice / 7, 2) AS pollutant, round(o_totalprice / 1000000, 4) AS metric FROM orders")
def _(spark, d):
    price = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey", X.report(price, "aqi").alias("aqi"), X.report(price / 7, "pollutant").alias("pollutant"), X.report(price / 1000000, "metric").alias("metric")
    )


@query(
    "feature_display_name",
    """SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(n, '[a-zA-Z]+|[^a-zA-Z]+'), lambda x: upper(x[1]) || lower(x[2:])), '') AS display, lower(replace(p_name, ' ', '_')) AS slug
    FROM (SELECT p_partkey, p_name, replace(replace(p_name, ' ', '_') || '_lag_' || p_size || 'h', '_', ' ') AS n FROM part)""",
)
def _(spark, d):
    name = F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("_lag_"), F.col("p_size").cast("string"), F.lit("h"))
    return table(spark, d, "part").select("p_partkey", X.display_name(name).alias("display"), X.slug("p_name").alias("slug"))


@query("forecast_date", "SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 3 + 1 AS INT), '%Y-%m-%d') AS date FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", X.forecast_date("o_orderdate", (F.col("o_orderkey") % 3 + 1)).alias("date"))


# ---- aggregations --------------------------------------------------------------------------


@query(
    "dedupe_first",
    f"""WITH {READINGS}, h AS (SELECT city, CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS timestamp, aqi, k, event_id FROM readings)
    SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY city, timestamp ORDER BY event_id) = 1""",
)
def _(spark, d):
    return C.dedupe_first(readings(spark, d).withColumn("timestamp", _hour("timestamp")), RAW)


@query(
    "median_impute",
    f"""WITH {GAPPY}, m AS (SELECT quantile_cont(aqi, 0.5) AS aqi, quantile_cont(no2, 0.5) AS no2, quantile_cont(o3, 0.5) AS o3 FROM gappy)
    SELECT city, timestamp, {', '.join(R5(f'COALESCE(g.{c}, m.{c})', c) for c in ('aqi', 'no2', 'o3'))} FROM gappy g, m""",
)
def _(spark, d):
    return show(C.median_impute(gappy(spark, d), ["aqi", "no2", "o3"]), KEY, ["aqi", "no2", "o3"])


@query(
    "null_profile",
    f"""WITH {GAPPY} SELECT "column", CAST(n AS BIGINT) AS nulls FROM (UNPIVOT (SELECT COUNT(*) - COUNT(city) AS city, COUNT(*) - COUNT(timestamp) AS timestamp,
    COUNT(*) - COUNT(aqi) AS aqi, COUNT(*) - COUNT(no2) AS no2, COUNT(*) - COUNT(o3) AS o3 FROM gappy) ON city, timestamp, aqi, no2, o3 INTO NAME "column" VALUE n)""",
)
def _(spark, d):
    return C.null_profile(gappy(spark, d))


def fences_sql(columns, source: str = "obs", by: str = "") -> str:
    qs = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3" for c in columns)
    return f"(SELECT {by + ', ' if by else ''}{qs} FROM {source} {'GROUP BY ' + by if by else ''})"


FENCED = ("aqi", "pm2_5", "pm10")


def _fence_columns(c: str) -> dict[str, str]:
    return {
        f"{c}_q1": f"{c}_q1", f"{c}_q3": f"{c}_q3",
        f"{c}_low": f"{c}_q1 - 1.5::DOUBLE * ({c}_q3 - {c}_q1)", f"{c}_high": f"{c}_q3 + 1.5::DOUBLE * ({c}_q3 - {c}_q1)",
    }


_ALL_FENCES = {n: e for c in FENCED for n, e in _fence_columns(c).items()}
FENCE_SELECT = ", ".join(R5(e, n) for n, e in _ALL_FENCES.items())


@query("iqr_fences", f"WITH {OBS} SELECT 'all' AS scope, {FENCE_SELECT} FROM {fences_sql(FENCED)} UNION ALL SELECT city, {FENCE_SELECT} FROM {fences_sql(FENCED, by='city')}")
def _(spark, d):
    o = obs(spark, d)
    whole = C.iqr_fences(o, list(FENCED)).withColumn("scope", F.lit("all"))
    each = C.iqr_fences(o, list(FENCED), ["city"]).withColumnRenamed("city", "scope")
    return show(whole.unionByName(each), ["scope"], list(_ALL_FENCES))


def _capped(c: str) -> str:
    f = _fence_columns(c)
    return f"LEAST(GREATEST({c}, {f[c + '_low']}), {f[c + '_high']})"


CLIPPED_SQL = " + ".join(f"CAST({c} < {_fence_columns(c)[c + '_low']} OR {c} > {_fence_columns(c)[c + '_high']} AS INT)" for c in FENCED)


@query("winsorise", f"WITH {OBS} SELECT city, timestamp, {', '.join(R5(_capped(c), c) for c in FENCED)}, {CLIPPED_SQL} AS clipped FROM obs, {fences_sql(FENCED)} f")
def _(spark, d):
    return show(C.winsorise(obs(spark, d), count_as="clipped"), [*KEY, "clipped"], list(FENCED))


SPLIT_SQL = """indexed AS (SELECT *, row_number() OVER (ORDER BY city, timestamp) - 1 AS i, COUNT(*) OVER () AS n FROM obs),
  split AS (SELECT *, CASE WHEN i < floor(n * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM indexed)"""


@query(
    "robust_scale",
    f"""WITH {OBS}, {SPLIT_SQL}, p AS (SELECT quantile_cont(pm10, 0.5) AS c1, quantile_cont(pm10, 0.75) - quantile_cont(pm10, 0.25) AS s1,
    quantile_cont(o3, 0.5) AS c2, quantile_cont(o3, 0.75) - quantile_cont(o3, 0.25) AS s2 FROM split WHERE split = 'train')
    SELECT city, timestamp, split, {R5('(pm10 - c1) / s1', 'pm10')}, {R5('(o3 - c2) / s2', 'o3')}, 0.0::DOUBLE AS flat FROM split, p""",
)
def _(spark, d):
    parts = H.temporal_split(obs(spark, d), SPEC).withColumn("flat", F.lit(4.0))
    return show(Sc.robust_scale(parts, ["pm10", "o3", "flat"]), [*KEY, "split"], ["pm10", "o3", "flat"])


def _hourly(spark, d) -> DataFrame:
    """A forecast-like frame: 1-based hour offsets per city with the observed value as prediction."""
    first = F.lit("2023-12-31 23:00:00").cast("timestamp_ntz")
    return obs(spark, d).select("city", F.timestamp_diff("HOUR", first, F.col("timestamp")).cast("int").alias("timestamp_offset"), F.col("aqi").alias("predicted"))


@query(
    "daily_rollup",
    f"""WITH {OBS} SELECT city, CAST(datediff('day', TIMESTAMP '2024-01-01', timestamp) + 1 AS INT) AS day,
    {R5('avg(aqi)', 'aqi_mean')}, {R5('max(aqi)', 'aqi_max')}, {R5('min(aqi)', 'aqi_min')} FROM obs GROUP BY 1, 2""",
)
def _(spark, d):
    return show(Fc.daily_rollup(_hourly(spark, d), SPEC), ["city", "day"], ["aqi_mean", "aqi_max", "aqi_min"])


METRICS_SQL = """avg(abs({y} - {p})) AS mae, sqrt(avg(({y} - {p}) * ({y} - {p}))) AS rmse, 1 - sum(({y} - {p}) * ({y} - {p})) / (var_pop({y}) * count({y})) AS r2"""


@query(
    "regression_metrics",
    f"WITH {OBS} SELECT city, {R5('mae', 'mae')}, {R5('rmse', 'rmse')}, {R5('r2', 'r2')} FROM (SELECT city, {METRICS_SQL.format(y='aqi', p='pm2_5')} FROM obs GROUP BY city)",
)
def _(spark, d):
    return show(E.regression_metrics(obs(spark, d), "aqi", "pm2_5", ["city"]), ["city"], ["mae", "rmse", "r2"])


@query("cv_summary", f"WITH {OBS} SELECT city, {R5('avg(aqi)', 'cv_rmse_mean')}, {R5('stddev_pop(aqi)', 'cv_rmse_std')} FROM obs GROUP BY city")
def _(spark, d):
    return show(E.cv_summary(obs(spark, d), ["city"], "aqi"), ["city"], ["cv_rmse_mean", "cv_rmse_std"])


@query(
    "histogram",
    f"""WITH {OBS}, e AS (SELECT min(aqi) AS lo, max(aqi) AS hi, (max(aqi) - min(aqi)) / 30 AS w FROM obs),
    c AS (SELECT CAST(LEAST(floor((aqi - lo) / w), 29) AS INT) AS bin, COUNT(*) AS n FROM obs, e GROUP BY 1)
    SELECT CAST(g.bin AS INT) AS bin, {R5('lo + g.bin * w', 'low')}, {R5('lo + (g.bin + 1) * w', 'high')}, COALESCE(n, 0) AS rows
    FROM range(30) g(bin) CROSS JOIN e LEFT JOIN c ON c.bin = g.bin""",
)
def _(spark, d):
    return show(Ex.histogram(obs(spark, d), "aqi"), ["bin", "rows"], ["low", "high"])


@query(
    "density_curve",
    f"""WITH {OBS}, e AS (SELECT min(aqi) AS lo, max(aqi) AS hi, COUNT(*) AS n, stddev_samp(aqi) * pow(COUNT(*), -0.2) AS h FROM obs)
    SELECT CAST(p AS INT) AS point, {R5('x', 'x')}, {R5('sum(exp(-0.5 * ((x - aqi) / h) ** 2)) / any_value(n * h * sqrt(2 * pi())) * 1000', 'density')}
    FROM (SELECT p, lo + p * (hi - lo) / 199.0::DOUBLE AS x, n, h FROM range(200) g(p), e), obs GROUP BY p, x""",
)
def _(spark, d):
    curve = Ex.density_curve(obs(spark, d), "aqi").withColumn("density", F.col("density") * 1000)
    return show(curve, ["point"], ["x", "density"])


_NUM = ("aqi", "no2", "o3")


@query(
    "correlation_matrix",
    f"WITH {GAPPY} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, {R5(f'corr({a}, {b})', 'corr')} FROM gappy" for a in _NUM for b in _NUM),
)
def _(spark, d):
    return show(Ex.correlation_matrix(gappy(spark, d)), ["a", "b"], ["corr"])


@query("coverage_summary", f"WITH {OBS} SELECT city, COUNT(*) AS rows, min(timestamp) AS first_time, max(timestamp) AS last_time FROM obs GROUP BY city")
def _(spark, d):
    return Ex.coverage_summary(obs(spark, d), SPEC)


@query("total_coverage", f"WITH {OBS} SELECT CAST(COUNT(*) AS BIGINT) AS rows, COUNT(DISTINCT city) AS entities, min(timestamp) AS first_time, max(timestamp) AS last_time FROM obs")
def _(spark, d):
    return Ex.total_coverage(obs(spark, d), SPEC)


@query(
    "mean_abs_importance",
    f"""WITH {READINGS} SELECT feature, {R5('m', 'importance')} FROM (SELECT 'f' || k AS feature, avg(abs(aqi - 50)) AS m FROM readings GROUP BY 1) ORDER BY m DESC, feature LIMIT 15""",
)
def _(spark, d):
    long = readings(spark, d).select(F.concat(F.lit("f"), F.col("k").cast("string")).alias("feature"), (F.col("aqi") - 50).alias("attribution"))
    return show(E.mean_abs_importance(long), ["feature"], ["importance"])


# ---- windows -------------------------------------------------------------------------------

LAG_SQL = {f"aqi_lag_{k}": f"lag(aqi, {k}) {W}" for k in S.LAGS}
POLLUTANT_LAG_SQL = {f"{p}_lag_1": f"lag({p}, 1) {W}" for p in S.LAGGED_POLLUTANTS}
MEAN_SQL = {f"aqi_roll_mean_{n}d": f"avg(aqi) {rows_frame(f'{24 * n} PRECEDING', '1 PRECEDING')}" for n in S.ROLLING_DAYS}
STD_SQL = {f"aqi_roll_std_{n}d": f"COALESCE(stddev_samp(aqi) {rows_frame(f'{24 * n} PRECEDING', '1 PRECEDING')}, 0)" for n in S.ROLLING_DAYS}
DIFF_SQL = {f"aqi_diff_{k}h": f"aqi - lag(aqi, {k}) {W}" for k in (1, 3)}


def pct_sql(v: str) -> str:
    prev = f"lag({v}, 1) {W}"
    return f"CASE WHEN {prev} = 0 AND {v} <> 0 THEN 0 ELSE {v} / NULLIF({prev}, 0) - 1 END"


def columns_sql(parts: dict[str, str]) -> str:
    return ", ".join(R5(e, n) for n, e in parts.items())


def ewm_ctes(source: str = "obs", column: str = "aqi") -> str:
    step = ", ".join(f"(1 - 2.0::DOUBLE / {s + 1}) * e.y{s} + 2.0::DOUBLE / {s + 1} * s.{column}" for s in S.EWM_SPANS)
    seed = ", ".join(f"{column} AS y{s}" for s in S.EWM_SPANS)
    return f"""s AS (SELECT *, row_number() {W} AS rn FROM {source}),
  e AS (SELECT city, rn, {seed} FROM s WHERE rn = 1 UNION ALL SELECT s.city, s.rn, {step} FROM e JOIN s ON s.city = e.city AND s.rn = e.rn + 1)"""


EWM_SQL = {f"aqi_ewm_{s}h": f"e.y{s}" for s in S.EWM_SPANS}


@query("lag_features", f"WITH {OBS} SELECT city, timestamp, {columns_sql(LAG_SQL)} FROM obs")
def _(spark, d):
    return show(Ft.lag_features(obs(spark, d), SPEC), KEY, list(LAG_SQL))


@query("pollutant_lags", f"WITH {OBS} SELECT city, timestamp, {columns_sql(POLLUTANT_LAG_SQL)} FROM obs")
def _(spark, d):
    return show(Ft.pollutant_lags(obs(spark, d), SPEC), KEY, list(POLLUTANT_LAG_SQL))


@query("rolling_mean", f"WITH {OBS} SELECT city, timestamp, {columns_sql(MEAN_SQL)} FROM obs")
def _(spark, d):
    return show(Ft.rolling_features(obs(spark, d), SPEC), KEY, list(MEAN_SQL))


@query("rolling_std", f"WITH {OBS} SELECT city, timestamp, {columns_sql(STD_SQL)} FROM obs")
def _(spark, d):
    return show(Ft.rolling_features(obs(spark, d), SPEC), KEY, list(STD_SQL))


@query("diff_features", f"WITH {OBS} SELECT city, timestamp, {columns_sql(DIFF_SQL)} FROM obs")
def _(spark, d):
    return show(Ft.diff_features(obs(spark, d), SPEC), KEY, list(DIFF_SQL))


@query(
    "pct_change",
    f"""WITH {OBS}, h AS (SELECT city, timestamp, last_value(CASE WHEN no2 <> 3 THEN no2 END IGNORE NULLS) {rows_frame('UNBOUNDED PRECEDING', 'CURRENT ROW')} AS v FROM obs)
    SELECT city, timestamp, {R5(pct_sql('v'), 'no2_pct_1h')} FROM h""",
)
def _(spark, d):
    gaps = obs(spark, d).withColumn("no2", F.when(F.col("no2") != 3, F.col("no2")))
    return show(Ft.pct_change(gaps, SPEC, "no2"), KEY, ["no2_pct_1h"])


@query("ewm_features", f"WITH RECURSIVE {OBS}, {ewm_ctes()} SELECT s.city, s.timestamp, {columns_sql(EWM_SQL)} FROM s LEFT JOIN e ON e.city = s.city AND e.rn = s.rn - 1")
def _(spark, d):
    return show(Ft.ewm_features(obs(spark, d), SPEC), KEY, list(EWM_SQL))


def gap_ctes() -> str:
    """The recursion with gaps: ``g`` counts the rows since the last known one."""
    def step(k: int) -> str:
        a, q = f"(2.0::DOUBLE / {k + 1})", f"pow(1 - 2.0::DOUBLE / {k + 1}, e.g + 1)"
        return f"CASE WHEN s.aqi IS NULL THEN e.y{k} WHEN e.y{k} IS NULL THEN s.aqi ELSE ({q} * e.y{k} + {a} * s.aqi) / ({q} + {a}) END"

    seed = ", ".join(f"aqi AS y{k}" for k in S.EWM_SPANS)
    return f"""s AS (SELECT *, row_number() {W} AS rn FROM gappy), e AS (SELECT city, rn, 0 AS g, {seed} FROM s WHERE rn = 1
  UNION ALL SELECT s.city, s.rn, CASE WHEN s.aqi IS NULL THEN e.g + 1 ELSE 0 END, {", ".join(map(step, S.EWM_SPANS))} FROM e JOIN s ON s.city = e.city AND s.rn = e.rn + 1)"""


GAP_SQL = f"WITH RECURSIVE {GAPPY}, {gap_ctes()} SELECT s.city, s.timestamp, {{}} FROM s LEFT JOIN e ON e.city = s.city AND e.rn = s.rn - 1"


@query("ewm_gaps", GAP_SQL.format(columns_sql(EWM_SQL)))
def _(spark, d):
    return show(Ft.ewm_features(gappy(spark, d), SPEC), KEY, list(EWM_SQL))


@query("all_features_gaps", GAP_SQL.format(columns_sql(EWM_SQL)))
def _(spark, d):
    return show(Ft.all_features(gappy(spark, d), SPEC), KEY, list(EWM_SQL))


def ffill_sql(c: str) -> str:
    return f"last_value({c} IGNORE NULLS) {rows_frame('UNBOUNDED PRECEDING', 'CURRENT ROW')}"


def bfill_sql(c: str) -> str:
    return f"first_value({c} IGNORE NULLS) {rows_frame('CURRENT ROW', 'UNBOUNDED FOLLOWING')}"


@query("ffill", f"WITH {GAPPY} SELECT city, timestamp, {columns_sql({c: ffill_sql(c) for c in _NUM})} FROM gappy")
def _(spark, d):
    return show(C.forward_fill(gappy(spark, d), SPEC), KEY, list(_NUM))


@query("bfill", f"WITH {GAPPY} SELECT city, timestamp, {columns_sql({c: bfill_sql(c) for c in _NUM})} FROM gappy")
def _(spark, d):
    return show(C.backward_fill(gappy(spark, d), SPEC), KEY, list(_NUM))


@query(
    "horizon_targets",
    f"""WITH {GAPPY}, r AS (SELECT *, row_number() {W} AS rn FROM gappy)
    SELECT a.city, a.timestamp, CAST(b.rn - a.rn AS INT) AS timestamp_offset, {R5('b.aqi', 'target_aqi')}
    FROM r a JOIN r b ON a.city = b.city AND b.rn BETWEEN a.rn + 1 AND a.rn + 72 WHERE b.aqi IS NOT NULL""",
)
def _(spark, d):
    return show(H.horizon_targets(gappy(spark, d), SPEC), [*KEY, "timestamp_offset"], ["target_aqi"])


@query(
    "horizon_targets_time",
    f"""WITH {GAPPY} SELECT a.city, a.timestamp, CAST(datediff('hour', a.timestamp, b.timestamp) AS INT) AS timestamp_offset, {R5('b.aqi', 'target_aqi')}
    FROM gappy a JOIN gappy b ON a.city = b.city AND b.timestamp > a.timestamp AND b.timestamp <= a.timestamp + INTERVAL 72 HOUR WHERE b.aqi IS NOT NULL""",
)
def _(spark, d):
    return show(H.horizon_targets_time(gappy(spark, d), SPEC), [*KEY, "timestamp_offset"], ["target_aqi"])


@query(
    "rolling_24h_strict",
    f"""WITH {GAPPY} SELECT city, timestamp, CASE WHEN count(aqi) {rows_frame('23 PRECEDING', 'CURRENT ROW')} = 24
    THEN {R5('avg(aqi) ' + rows_frame('23 PRECEDING', 'CURRENT ROW'))} END AS aqi_roll_24h FROM gappy""",
)
def _(spark, d):
    return show(Ft.rolling_strict(gappy(spark, d), SPEC), KEY, ["aqi_roll_24h"])


TAIL_SQL = "tail AS (SELECT city, timestamp, aqi, row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) AS r FROM obs)"
SLOPE_SQL = "CASE WHEN max(r) >= 6 THEN (max(CASE WHEN r = 1 THEN aqi END) - max(CASE WHEN r = 6 THEN aqi END)) / 5 ELSE 0 END"


@query("recent_slope", f"WITH {OBS}, {TAIL_SQL} SELECT city, {R5(SLOPE_SQL, 'recent_slope')} FROM tail GROUP BY city")
def _(spark, d):
    return show(Fc.recent_slope(obs(spark, d), SPEC), ["city"], ["recent_slope"])


FEATURE_SQL = {**LAG_SQL, **POLLUTANT_LAG_SQL, **MEAN_SQL, **STD_SQL, **DIFF_SQL, "aqi_pct_1h": pct_sql("aqi"), **RATIO_SQL}
FEATURES_CTE = f"""feats AS (SELECT city, timestamp, aqi, pm2_5, pm10, no2, o3, {CALENDAR_SQL}, {', '.join(f'{e} AS {n}' for n, e in CYCLIC_EXPR.items())},
  {', '.join(f'{e} AS {n}' for n, e in FEATURE_SQL.items())}, row_number() {W} AS rn FROM obs),
  featured AS (SELECT feats.*, {', '.join(f'{e} AS {n}' for n, e in EWM_SQL.items())} FROM feats LEFT JOIN e ON e.city = feats.city AND e.rn = feats.rn - 1)"""
FEATURES_WITH = f"WITH RECURSIVE {OBS}, {ewm_ctes()}, {FEATURES_CTE}"
FEATURE_NAMES = [*CYCLIC_EXPR, *FEATURE_SQL, *EWM_SQL]


@query("all_features", f"{FEATURES_WITH} SELECT city, timestamp, {', '.join(Cal.CALENDAR)}, {', '.join(R5(n, n) for n in FEATURE_NAMES)} FROM featured")
def _(spark, d):
    return show(Ft.all_features(obs(spark, d), SPEC), [*KEY, *Cal.CALENDAR], FEATURE_NAMES)


# ---- order, limits, splits -----------------------------------------------------------------


@query("order_series", f"WITH {OBS} SELECT city, timestamp, CAST(row_number() {W} - 1 AS BIGINT) AS position FROM obs")
def _(spark, d):
    return B.with_position(obs(spark, d), SPEC).select(*KEY, F.col("_pos").alias("position")).orderBy(*KEY)


@query("last_n", f"WITH {OBS} SELECT city, timestamp, pm10 FROM obs QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) <= 48")
def _(spark, d):
    return Fc.last_n(obs(spark, d), SPEC, 48).select(*KEY, "pm10")


@query("head_n", f"WITH {OBS} SELECT city, timestamp, pm10 FROM obs ORDER BY city, timestamp LIMIT 100")
def _(spark, d):
    return Fc.head_n(obs(spark, d), KEY, 100).select(*KEY, "pm10")


@query("top_k_features", f"WITH {OBS} SELECT city || ' ' || hour(timestamp) AS feature, {R5('max(aqi)', 'importance')} FROM obs GROUP BY 1 ORDER BY max(aqi) DESC, 1 LIMIT 7")
def _(spark, d):
    long = obs(spark, d).groupBy(F.concat_ws(" ", "city", F.hour("timestamp").cast("string")).alias("feature")).agg(F.max("aqi").alias("importance"))
    return show(E.top_k_features(long, 7), ["feature"], ["importance"])


BOARD_SQL = "(SELECT s_name AS model_name, CAST(s_nationkey AS DOUBLE) AS rmse, s_acctbal AS mae FROM supplier)"


@query(
    "leaderboard",
    f"SELECT model_name, rmse, mae, row_number() OVER (ORDER BY rmse, mae, model_name) = 1 AS best FROM {BOARD_SQL}",
)
def _(spark, d):
    board = table(spark, d, "supplier").select(F.col("s_name").alias("model_name"), F.col("s_nationkey").cast("double").alias("rmse"), F.col("s_acctbal").alias("mae"))
    best = E.best_model(board).select("model_name").scalar()
    return E.leaderboard(board).withColumn("best", F.col("model_name") == best)


@query(
    "temporal_split",
    f"WITH {OBS}, {SPLIT_SQL} SELECT city, timestamp, split, CASE WHEN timestamp < TIMESTAMP '2024-01-25 00:00:00' THEN 'train' ELSE 'test' END AS by_time FROM split",
)
def _(spark, d):
    by_position = H.temporal_split(obs(spark, d).select(*KEY), SPEC)
    cut = H.temporal_split(by_position.withColumnRenamed("split", "by_position"), SPEC, mode="time", cut="2024-01-25")
    return cut.select(*KEY, F.col("by_position").alias("split"), F.col("split").alias("by_time"))


INDEXED = "ix AS (SELECT *, row_number() OVER (ORDER BY city, timestamp) - 1 AS i, COUNT(*) OVER () AS n FROM obs)"


@query(
    "even_sample",
    f"""WITH {OBS}, {INDEXED}, picks AS (SELECT DISTINCT CASE WHEN k = 499 THEN n - 1 ELSE CAST(floor(k * ((n - 1) / 499.0::DOUBLE)) AS BIGINT) END AS i
    FROM range(500) g(k), (SELECT max(n) AS n FROM ix)) SELECT city, timestamp, pm10 FROM ix JOIN picks USING (i)""",
)
def _(spark, d):
    return H.even_sample(obs(spark, d), SPEC, 500).select(*KEY, "pm10")


@query(
    "time_series_folds",
    f"""WITH {OBS}, {INDEXED}, p AS (SELECT LEAST(5, GREATEST(2, max(n) // 500)) AS s FROM ix),
    f AS (SELECT f, s, n, n // (s + 1) AS size, i, city, timestamp FROM ix, p, range(5) g(f) WHERE f < s)
    SELECT city, timestamp, CAST(f AS INT) AS fold, CASE WHEN i < n - (s - f) * size THEN 'train' ELSE 'test' END AS role
    FROM f WHERE i < n - (s - f - 1) * size""",
)
def _(spark, d):
    return H.time_series_folds(obs(spark, d), SPEC, rows_per_fold=500).select(*KEY, "fold", "role")


@query("contiguous_folds", f"WITH {OBS} SELECT city, timestamp, CAST(ntile(3) OVER (ORDER BY city, timestamp) - 1 AS INT) AS fold FROM obs")
def _(spark, d):
    return H.contiguous_folds(obs(spark, d), SPEC).select(*KEY, "fold")


# ---- set operations ------------------------------------------------------------------------


@query("union_cities", f"WITH {OBS} SELECT city, timestamp, pm10, CASE WHEN city <> 'view' THEN o3 END AS o3 FROM obs")
def _(spark, d):
    o = obs(spark, d).select(*KEY, "pm10", "o3")
    parts = [o.where(F.col("city") == c) if c != "view" else o.where("city = 'view'").drop("o3") for c in [*CITIES, "error"]]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _current(spark, d) -> DataFrame:
    """One new reading per city, an hour after its last one; the target is not reported."""
    return obs(spark, d).groupBy("city").agg(
        (F.max("timestamp") + F.expr("INTERVAL 1 HOUR")).alias("timestamp"), F.max("pm10").alias("pm10"), F.max("o3").alias("temp")
    )


@query(
    "append_observation",
    f"""WITH {OBS}, last AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1),
    cur AS (SELECT city, max(timestamp) + INTERVAL 1 HOUR AS timestamp, max(pm10) AS pm10, max(o3) AS temp FROM obs GROUP BY city)
    SELECT city, timestamp, {R5('aqi', 'aqi')}, {R5('pm2_5', 'pm2_5')}, pm10, no2, NULL::DOUBLE AS temp FROM obs UNION ALL
    SELECT cur.city, cur.timestamp, {R5('aqi', 'aqi')}, {R5('pm2_5', 'pm2_5')}, cur.pm10, no2, temp FROM cur JOIN last ON last.city = cur.city""",
)
def _(spark, d):
    out = Fc.append_observation(obs(spark, d), _current(spark, d), SPEC)
    return show(out, [*KEY, "pm10", "no2", "temp"], ["aqi", "pm2_5"])


LATEST_WITH = f"""WITH RECURSIVE {OBS.replace('obs AS', 'base AS', 1)}, obs AS (SELECT * FROM base UNION ALL
  SELECT city, max(timestamp) + INTERVAL 1 HOUR, 100.0::DOUBLE, 0.0::DOUBLE, max(pm10), 0.0::DOUBLE, 0.0::DOUBLE FROM base GROUP BY city),
  {ewm_ctes()}, {FEATURES_CTE}"""


@query(
    "latest_payload",
    f"""{LATEST_WITH} SELECT city, timestamp, aqi, pm10, t.temp, {', '.join(R5(f'COALESCE({n}, 0)', n) for n in FEATURE_NAMES)}
    FROM featured JOIN (SELECT city AS c2, max(o3) AS temp FROM base GROUP BY 1) t ON c2 = city QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1""",
)
def _(spark, d):
    current = _current(spark, d).withColumn("aqi", F.lit(100.0))
    out = P.latest_payload(stage(obs(spark, d), "obs"), current, SPEC)
    return show(out, [*KEY, "aqi", "pm10", "temp"], FEATURE_NAMES)


def _future_daily(spark, d) -> DataFrame:
    hourly = Fc.simulated_path(obs(spark, d), SPEC).withColumnRenamed("simulated", "predicted")
    return Fc.daily_rollup(hourly, SPEC)


SIM_CTES = f"""{TAIL_SQL}, last AS (SELECT city, max(timestamp) AS t, max(CASE WHEN r = 1 THEN aqi END) AS a, {SLOPE_SQL} AS slope FROM tail GROUP BY city),
  sim AS (SELECT city, CAST(i AS INT) AS i, t + i * INTERVAL 1 HOUR AS at, a,
  LEAST(GREATEST(a + LEAST(GREATEST(slope, -2.5), 2.5) * LEAST(i, 24) + 4 * sin(2 * pi() * hour(t + i * INTERVAL 1 HOUR) / 24.0::DOUBLE), 0), 500) AS v
  FROM last, range(1, 73) g(i))"""
DAILY_SIM = "(SELECT city, CAST((i - 1) // 24 + 1 AS INT) AS day, avg(v) AS m, max(v) AS hi, min(v) AS lo FROM sim GROUP BY 1, 2)"


@query(
    "trend_series",
    f"""WITH {OBS}, {SIM_CTES} SELECT city, 'history' AS series, timestamp, {R5('aqi', 'value')} FROM tail WHERE r <= 48
    UNION ALL SELECT city, 'forecast', t, {R5('a')} FROM last
    UNION ALL SELECT city, 'forecast', CAST(DATE '2024-01-31' + day AS TIMESTAMP), {R5('round(m, 1)')} FROM {DAILY_SIM}""",
)
def _(spark, d):
    o = obs(spark, d)
    daily = Fc.daily_report(_future_daily(spark, d), AS_OF)
    out = Fc.trend_series(o, daily, Fc.last_n(o, SPEC, 1), SPEC)
    return show(out, ["city", "series", "timestamp"], ["value"])


# ---- forecast ------------------------------------------------------------------------------


@query("simulated_path", f"WITH {OBS}, {SIM_CTES} SELECT city, i AS timestamp_offset, {R5('v', 'simulated')} FROM sim")
def _(spark, d):
    return show(Fc.simulated_path(obs(spark, d), SPEC), ["city", "timestamp_offset"], ["simulated"])


def future_lag_sql(k: int) -> str:
    return f"CASE WHEN sim.i <= {k} THEN COALESCE((SELECT aqi FROM tail WHERE tail.city = sim.city AND r = {k} - sim.i + 1), sim.a) ELSE (SELECT v FROM sim p WHERE p.city = sim.city AND p.i = sim.i - {k}) END"


@query("future_lags", f"WITH {OBS}, {SIM_CTES} SELECT city, i AS timestamp_offset, {', '.join(R5(future_lag_sql(k), f'aqi_lag_{k}') for k in S.LAGS)} FROM sim")
def _(spark, d):
    return show(Fc.future_lags(obs(spark, d), SPEC), ["city", "timestamp_offset"], list(LAG_SQL))


HELD = [*MEAN_SQL, *STD_SQL, *POLLUTANT_LAG_SQL, *RATIO_SQL, *EWM_SQL, "pm2_5", "pm10", "no2", "o3"]


@query(
    "future_features",
    f"""{FEATURES_WITH}, {SIM_CTES}, held AS (SELECT * FROM featured QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1),
    fut AS (SELECT sim.city, sim.i, sim.at AS timestamp, {', '.join(f'{future_lag_sql(k)} AS aqi_lag_{k}' for k in S.LAGS)} FROM sim)
    SELECT fut.city, fut.i AS timestamp_offset, {CALENDAR_SQL.replace('timestamp', 'fut.timestamp')}, {CYCLIC_SQL.replace('timestamp', 'fut.timestamp')},
    {', '.join(R5(f'fut.{n}', n) for n in LAG_SQL)}, {', '.join(R5(f'held.{n}', n) for n in HELD)}, 0.0::DOUBLE AS aqi_diff_1h, 0.0::DOUBLE AS aqi_pct_1h
    FROM fut JOIN held ON held.city = fut.city""",
)
def _(spark, d):
    future = Fc.future_features(Ft.all_features(obs(spark, d), SPEC), SPEC)
    fixed = ["city", "timestamp_offset", *Cal.CALENDAR, "aqi_diff_1h", "aqi_pct_1h"]
    return show(future, fixed, [*Cal.CYCLIC, *LAG_SQL, *HELD])


ML_FEATURES = ["pm2_5", "pm10", "no2", "o3", "hour", "timestamp_offset"]


def _spread(df: DataFrame) -> DataFrame:
    """Dealt evenly before it is written, so that a fit reads it in many tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _training_frame(spark, d, hours: int = S.HORIZON) -> DataFrame:
    """Horizon rows of all observations with a few raw features, marked train / test."""
    frame = H.horizon_targets(obs(spark, d).withColumn("hour", F.hour("timestamp")), SPEC, hours)
    return stage(_spread(H.temporal_split(frame, SPEC)), "frame")


@query("forecast")
def _(spark, d):
    train = _training_frame(spark, d)
    model = M.fit_ridge(train, ML_FEATURES)
    future = Fc.future_features(obs(spark, d), SPEC)
    return Fc.forecast(future, model, ML_FEATURES, SPEC)


@query(
    "daily_report",
    f"""WITH {OBS}, {SIM_CTES} SELECT city, day, strftime(DATE '2024-01-31' + day, '%Y-%m-%d') AS date, round(m, 1) AS aqi_mean, round(hi, 1) AS aqi_max, round(lo, 1) AS aqi_min,
    {category_sql('m', 2)} AS category, {category_sql('m', 3)} AS color, {category_sql('m', 4)} AS emoji, m > 150 AS alert FROM {DAILY_SIM}""",
)
def _(spark, d):
    return Fc.daily_report(_future_daily(spark, d), AS_OF)


@query(
    "forecast_document",
    f"""WITH {OBS}, {VERSIONS}, {SIM_CTES}, best AS (SELECT * FROM versions WHERE rmse IS NOT NULL ORDER BY rmse, version LIMIT 1),
    cur AS (SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY city ORDER BY timestamp DESC) = 1),
    days AS (SELECT city, list({{day: day, date: strftime(DATE '2024-01-31' + day, '%Y-%m-%d'), aqi_mean: round(m, 1), aqi_max: round(hi, 1), aqi_min: round(lo, 1),
      category: {category_sql('m', 2)}, color: {category_sql('m', 3)}, emoji: {category_sql('m', 4)}, alert: m > 150}} ORDER BY day) AS l FROM {DAILY_SIM} GROUP BY city)
    SELECT cur.city, {category_sql('aqi', 2)} AS current_category, model_name, len(l)::INT AS forecast_days, to_json({{city: cur.city, current_aqi: round(aqi, 1), current_category: {category_sql('aqi', 2)},
      current_color: {category_sql('aqi', 3)}, current_emoji: {category_sql('aqi', 4)}, current_alert: aqi > 150, current_weather: '{{}}'::JSON,
      current_pollutants: {{pm2_5: round(pm2_5, 2), pm10: round(pm10, 2), no2: round(no2, 2), o3: round(o3, 2), co: 0.0::DOUBLE}}, daily_predictions: l, model_name: model_name,
      model_metrics: {{mae: rmse, rmse: rmse, r2: 0.0::DOUBLE, trained_at: trained_at}}, forecast_days: len(l), generated_at: '2024-01-31T00:00:00.000'}})::VARCHAR AS document
    FROM cur JOIN days ON days.city = cur.city, best""",
)
def _(spark, d):
    o = obs(spark, d)
    report = Fc.daily_report(_future_daily(spark, d), AS_OF)
    meta = _versions(spark, d).withColumns({"mae": F.col("rmse"), "r2": F.lit(0.0)})
    doc = Fc.forecast_document(report, Fc.last_n(o, SPEC, 1), R.registry_best(meta), SPEC, AS_OF)
    return doc.select("city", "current_category", "model_name", "forecast_days", F.to_json(F.struct("*")).alias("document"))


# ---- models --------------------------------------------------------------------------------


def _coefficients(spark, model, features) -> DataFrame:
    fitted = model.stages[-1]
    rows = [*zip(features, fitted.coefficients.toArray().tolist()), ("intercept", fitted.intercept)]
    return show(spark.createDataFrame(rows, "term string, value double"), ["term"], ["value"])


@query(
    "fit_linear",
    f"WITH {OBS} SELECT 'pm2_5' AS term, {R5('regr_slope(aqi, pm2_5)', 'value')} FROM obs UNION ALL SELECT 'intercept', {R5('regr_intercept(aqi, pm2_5)')} FROM obs",
)
def _(spark, d):
    return _coefficients(spark, M.fit_linear(obs(spark, d), ["pm2_5"], "aqi"), ["pm2_5"])


@query(
    "fit_ridge",
    f"""WITH {OBS}, r AS (SELECT regr_sxy(aqi, pm2_5) / (regr_sxx(aqi, pm2_5) + 50000) AS b, avg(aqi) AS y, avg(pm2_5) AS x FROM obs)
    SELECT 'pm2_5' AS term, {R5('b', 'value')} FROM r UNION ALL SELECT 'intercept', {R5('y - b * x')} FROM r""",
)
def _(spark, d):
    return _coefficients(spark, M.fit_ridge(obs(spark, d), ["pm2_5"], "aqi", alpha=50000.0), ["pm2_5"])


def _scored(spark, d, fit) -> DataFrame:
    frame = _training_frame(spark, d)
    model = fit(frame.where("split = 'train'"))
    return M.score(model, frame.where("split = 'test'"))


@query("fit_random_forest")
def _(spark, d):
    return _scored(spark, d, lambda t: M.fit_random_forest(t, ML_FEATURES))


@query("fit_gbt")
def _(spark, d):
    return _scored(spark, d, lambda t: M.fit_gbt(t, ML_FEATURES))


@query("random_search")
def _(spark, d):
    """Every candidate that has a grid; large grids are sampled."""
    folded = stage(_spread(H.contiguous_folds(_training_frame(spark, d), SPEC)), "folds")
    tables = [M.random_search(c, folded, ML_FEATURES)[2].withColumn("model_name", F.lit(c.name)) for c in M.candidates() if c.grid]
    return reduce(DataFrame.unionByName, tables)


@query("cross_validate")
def _(spark, d):
    folded = stage(_spread(H.time_series_folds(H.even_sample(_training_frame(spark, d), SPEC), SPEC)), "folds")
    return M.cross_validate(M.candidate("Linear Regression"), folded, ML_FEATURES)


def _compared(spark, d):
    frame = _training_frame(spark, d)
    folded = stage(_spread(H.time_series_folds(frame.where("split = 'train'"), SPEC)), "folds")
    return M.train_compare(frame.where("split = 'train'"), frame.where("split = 'test'"), folded, ML_FEATURES, M.candidates())


@query("train_compare")
def _(spark, d):
    return E.leaderboard(_compared(spark, d)[0])


@query("registry_save")
def _(spark, d):
    frame = _training_frame(spark, d)
    root = new_path(spark, "registry")
    for version, alpha in ((1, 1.0), (2, 1e6)):
        model = M.fit_ridge(frame.where("split = 'train'"), ML_FEATURES, alpha=alpha)
        metrics = M.score(model, frame.where("split = 'test'")).first().asDict()
        R.registry_save(spark, root, model, {"model_name": f"Ridge {alpha}", **metrics}, ML_FEATURES, version, AS_OF)
    model, best = R.registry_load(spark, root)
    return best.drop("path", "config", "feature_names")


@query(
    "linear_attribution",
    f"""WITH {OBS}, m AS (SELECT avg(pm10) AS m1, avg(o3) AS m2 FROM obs) SELECT city, timestamp, 'pm10' AS feature, {R5('2 * (pm10 - m1)', 'attribution')} FROM obs, m
    UNION ALL SELECT city, timestamp, 'o3', {R5('-0.5 * (o3 - m2)')} FROM obs, m""",
)
def _(spark, d):
    return show(A.linear_attribution(obs(spark, d), {"pm10": 2.0, "o3": -0.5}, KEY), [*KEY, "feature"], ["attribution"])


@query(
    "sampled_attribution",
    f"""WITH {OBS}, s AS (SELECT avg(pm10) AS x1, avg(o3) AS x2, var_pop(pm10) AS v1, var_pop(o3) AS v2, covar_pop(pm10, o3) AS v12, covar_pop(pm10, aqi) AS y1, covar_pop(o3, aqi) AS y2 FROM obs),
    m AS (SELECT x1, x2, (y1 * v2 - y2 * v12) / (v1 * v2 - v12 * v12) AS b1, (y2 * v1 - y1 * v12) / (v1 * v2 - v12 * v12) AS b2 FROM s)
    SELECT city, timestamp, 'pm10' AS feature, {R5('b1 * (pm10 - x1)', 'attribution')} FROM obs, m
    UNION ALL SELECT city, timestamp, 'o3', {R5('b2 * (o3 - x2)')} FROM obs, m""",
)
def _(spark, d):
    o = stage(obs(spark, d), "obs")
    model = M.fit_linear(o, ["pm10", "o3"], "aqi")
    return show(A.sampled_attribution(o, model, ["pm10", "o3"], KEY, 2, o), [*KEY, "feature"], ["attribution"])


@query("tree_attribution")
def _(spark, d):
    """Exact values of a boosted model with the default parameters; they add up to the difference from the mean row's prediction."""
    o, names = stage(obs(spark, d), "obs"), ["pm2_5", "pm10", "no2", "o3"]
    return A.tree_attribution(o, M.fit_gbt(o, names, "aqi"), names, KEY, o)


@query("forecast_documents_job")
def _(spark, d):
    o, registry = stage(obs(spark, d), "obs"), new_path(spark, "registry")
    model = M.fit_ridge(H.horizon_targets(o.withColumn("hour", F.hour("timestamp")), SPEC), ML_FEATURES)
    R.registry_save(spark, registry, model, {"model_name": "Ridge Regression"}, ML_FEATURES, None, AS_OF)
    documents, _ = P.forecast_documents_job(o, _current(spark, d).drop("temp"), registry, SPEC, AS_OF)
    return documents.select("city", "current_aqi", "current_category", "model_name", "forecast_days", F.to_json("daily_predictions").alias("days"), F.to_json("top_features").alias("top_features"))


# ---- streaming -----------------------------------------------------------------------------


def _stream(spark, df: DataFrame, files: int = 1, per_trigger: int | None = None) -> DataFrame:
    """The rows as a file stream; with ``files`` in time order each file can be its own batch."""
    path = new_path(spark, "stream")
    ordered = df.repartitionByRange(files, "timestamp") if files > 1 else df
    ordered.write.parquet(path)
    reader = spark.readStream.schema(df.schema)
    return (reader.option("maxFilesPerTrigger", per_trigger) if per_trigger else reader).parquet(path)


@query("stream_ingest", f"WITH {READINGS} SELECT city, timestamp, aqi, event_id FROM readings QUALIFY row_number() OVER (PARTITION BY city, timestamp ORDER BY event_id) = 1")
def _(spark, d):
    r = readings(spark, d).drop("k")
    path = new_path(spark, "ingested")
    J.stream_ingest(_stream(spark, r.unionByName(r)), path, new_path(spark, "cp"), SPEC).awaitTermination()
    return spark.read.schema(r.schema).parquet(path)


@query(
    "stream_upsert",
    f"""WITH {READINGS}, h AS (SELECT city, CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS timestamp, aqi, event_id FROM readings)
    SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY city, timestamp ORDER BY event_id DESC) = 1""",
)
def _(spark, d):
    hourly = readings(spark, d).drop("k").withColumn("timestamp", _hour("timestamp"))
    path = new_path(spark, "table")
    J.stream_upsert(_stream(spark, hourly, 2, 1), path, new_path(spark, "cp"), RAW).awaitTermination()
    return St.read_features(spark, path).select(*KEY, "aqi", "event_id")


@query("stream_features", f"{FEATURES_WITH} SELECT city, timestamp, {', '.join(R5(f'COALESCE({n}, 0)', n) for n in FEATURE_NAMES)} FROM featured")
def _(spark, d):
    """The table holds 0 where a feature is not known yet."""
    features = new_path(spark, "features")
    query_ = J.stream_features(_stream(spark, obs(spark, d), 2, 1), new_path(spark, "obs"), features, new_path(spark, "cp"), SPEC)
    query_.awaitTermination()
    return show(St.read_features(spark, features), KEY, FEATURE_NAMES)


@query("stream_gaps", GAP_SQL.format(columns_sql({n: f"coalesce({e}, 0)" for n, e in EWM_SQL.items()})))
def _(spark, d):
    """Unknown readings stay unknown in the stream's windows."""
    features = new_path(spark, "features")
    J.stream_features(_stream(spark, gappy(spark, d), 2, 1), new_path(spark, "obs"), features, new_path(spark, "cp"), SPEC).awaitTermination()
    return show(St.read_features(spark, features), KEY, list(EWM_SQL))


@query(
    "stream_daily",
    f"""WITH {READINGS} SELECT city, CAST(date_trunc('day', timestamp) AS TIMESTAMP) AS timestamp, COUNT(*) AS rows, {R5('avg(aqi)', 'aqi_mean')},
    {R5('max(aqi)', 'aqi_max')}, {R5('min(aqi)', 'aqi_min')} FROM readings GROUP BY 1, 2""",
)
def _(spark, d):
    path = new_path(spark, "daily")
    J.stream_daily(_stream(spark, readings(spark, d).drop("k"), 2, 1), path, new_path(spark, "cp"), SPEC).awaitTermination()
    return show(St.read_features(spark, path), ["city", "timestamp", "rows"], ["aqi_mean", "aqi_max", "aqi_min"])


# ---- jobs ----------------------------------------------------------------------------------

CLEAN_CTES = f"""{READINGS}, clean AS (SELECT city, timestamp, LEAST(GREATEST(aqi * 3, 0), 500) AS aqi, k FROM
  (SELECT city, CAST(date_trunc('hour', timestamp) AS TIMESTAMP) AS timestamp, CASE WHEN k <> 5 THEN aqi END AS aqi, k, event_id FROM readings
  QUALIFY row_number() OVER (PARTITION BY city, 2 ORDER BY event_id) = 1) WHERE aqi IS NOT NULL AND city <> 'error')"""
CLEAN_CTES = CLEAN_CTES.replace("PARTITION BY city, 2", "PARTITION BY city, date_trunc('hour', timestamp)")


def _raw(spark, d) -> DataFrame:
    value = F.when(F.col("k") != 5, F.col("aqi") * 3)
    return readings(spark, d).withColumns({"timestamp": _hour("timestamp"), "aqi": value})


CITIES = ["click", "view", "purchase", "signup"]


@query("clean_data", f"WITH {CLEAN_CTES} SELECT city, timestamp, {R5('aqi', 'aqi')}, k FROM clean")
def _(spark, d):
    return show(P.clean_data(_raw(spark, d), RAW, CITIES), [*KEY, "k"], ["aqi"])


def missing_sql(c: str) -> str:
    return f"COALESCE({ffill_sql(c)}, {bfill_sql(c)})"


@query(
    "handle_missing",
    f"""WITH {GAPPY}, f AS (SELECT city, timestamp, {', '.join(f'{missing_sql(c)} AS {c}' for c in _NUM)} FROM gappy),
    m AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}' for c in _NUM)} FROM f)
    SELECT city, timestamp, {', '.join(R5(f'COALESCE(f.{c}, m.{c})', c) for c in _NUM)} FROM f, m""",
)
def _(spark, d):
    return show(P.handle_missing(stage(gappy(spark, d), "gappy"), SPEC), KEY, list(_NUM))


CAPPED_SQL = f"""WITH RECURSIVE {CLEAN_CTES}, fence AS (SELECT {{group}}quantile_cont(aqi, 0.25) AS aqi_q1, quantile_cont(aqi, 0.75) AS aqi_q3 FROM clean {{by}}),
  obs AS (SELECT clean.city, timestamp, {_capped('aqi')} AS aqi, 0.0::DOUBLE AS pm2_5, 0.0::DOUBLE AS pm10, 0.0::DOUBLE AS no2, 0.0::DOUBLE AS o3 FROM clean {{join}}),
  {ewm_ctes()}, {FEATURES_CTE}"""
JOB_FEATURES = [n for n in FEATURE_NAMES if n not in POLLUTANT_LAG_SQL and n not in RATIO_SQL]
COMPLETE = "aqi_lag_24 IS NOT NULL AND aqi_pct_1h IS NOT NULL"


@query(
    "backfill_job",
    CAPPED_SQL.format(group="city, ", by="GROUP BY city", join="JOIN fence ON fence.city = clean.city")
    + f" SELECT city, timestamp, {R5('aqi', 'aqi')}, {', '.join(R5(n, n) for n in JOB_FEATURES)} FROM featured WHERE {COMPLETE}",
)
def _(spark, d):
    out = P.backfill_job(_raw(spark, d).drop("k"), RAW, new_path(spark, "table"), CITIES)
    return show(out, KEY, ["aqi", *JOB_FEATURES])


@query(
    "preprocess_job",
    CAPPED_SQL.format(group="", by="", join=", fence")
    + f""", ready AS (SELECT *, row_number() {W} AS pos FROM featured WHERE {COMPLETE}),
    frame AS (SELECT a.city, a.timestamp, CAST(b.pos - a.pos AS INT) AS timestamp_offset, b.aqi AS target_aqi FROM ready a JOIN ready b
    ON a.city = b.city AND b.pos BETWEEN a.pos + 1 AND a.pos + 72),
    numbered AS (SELECT *, row_number() OVER (ORDER BY city, timestamp, timestamp_offset) - 1 AS i, COUNT(*) OVER () AS n FROM frame)
    SELECT city, timestamp, timestamp_offset, {R5('target_aqi', 'target_aqi')}, CASE WHEN i < floor(n * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM numbered""",
)
def _(spark, d):
    prepared = P.preprocess_job(_raw(spark, d).drop("k"), RAW, CITIES)
    return show(prepared.frame(), [*KEY, "timestamp_offset", "split"], ["target_aqi"])


@query("train_job")
def _(spark, d):
    prepared = P.preprocess_job(obs(spark, d).withColumn("event_id", F.lit(0)), RAW)
    return P.train_job(prepared, registry=new_path(spark, "registry"), trained_at=AS_OF).results


@query("forecast_job")
def _(spark, d):
    o = stage(obs(spark, d), "obs")
    model = M.fit_linear(H.horizon_targets(o.withColumn("hour", F.hour("timestamp")), SPEC), ML_FEATURES)
    return P.forecast_job(o, _current(spark, d).drop("temp"), model, ML_FEATURES, SPEC, AS_OF)[1]


@query("ingest_job", f"WITH {OBS} SELECT city, max(timestamp) + INTERVAL 1 HOUR AS timestamp, 100.0::DOUBLE AS aqi, max(pm10) AS pm10, max(o3) AS temp FROM obs GROUP BY city")
def _(spark, d):
    o = stage(obs(spark, d), "obs")
    current = _current(spark, d).withColumn("aqi", F.lit(100.0))
    out = P.ingest_job(o.where("pm10 > 40"), o.where("pm10 <= 60"), current, SPEC, new_path(spark, "table"))
    return out.select(*KEY, "aqi", "pm10", "temp")


@query(
    "exact_quantiles",
    """SELECT 'all' AS l_returnflag, 'l_extendedprice' AS "column", p AS prob, floor(v * 1e5 + 0.5001) / 1e5 AS value FROM (SELECT unnest([0.01::DOUBLE, 0.5, 0.99]) AS p,
    unnest(quantile_cont(l_extendedprice, [0.01, 0.5, 0.99])) AS v FROM lineitem) UNION ALL
    SELECT l_returnflag, 'l_extendedprice', p, floor(v * 1e5 + 0.5001) / 1e5 FROM (SELECT l_returnflag, unnest([0.01::DOUBLE, 0.5, 0.99]) AS p,
    unnest(quantile_cont(l_extendedprice, [0.01, 0.5, 0.99])) AS v FROM lineitem GROUP BY 1)""",
)
def _(spark, d):
    li = table(spark, d, "lineitem")
    probs = [0.01, 0.5, 0.99]
    whole = Q.exact_quantiles(li, ["l_extendedprice"], probs).withColumn("l_returnflag", F.lit("all"))
    each = Q.exact_quantiles(li, ["l_extendedprice"], probs, ["l_returnflag"])
    return show(whole.unionByName(each), ["l_returnflag", "column", "prob"], ["value"])


# ---- corpus operators, if that subpackage is installed ---------------------------------------

try:
    import corpus_pipeline
    from aqspark.llm import queries as _corpus
except ImportError:
    pass
else:
    _QUERIES.update(_corpus.QUERIES)
    _ORACLES.update(_corpus.ORACLES)
    _QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        _ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL

# ---- driver contract -----------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Hourly features of all entities on the smallest tables."""
    return _QUERIES["all_features"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
