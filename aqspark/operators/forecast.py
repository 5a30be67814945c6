"""Future feature rows, forecasts, daily roll-up, and the report document."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F, Window as W
from pyspark.ml import Transformer

from aqspark import spec as S
from aqspark.functions import scalar as X
from aqspark.functions.calendar import calendar_parts, cyclic_parts
from aqspark.operators.blocks import BUCKET, by_group, calendar_bucket
from aqspark.operators.horizon import OFFSET
from aqspark.spec import ObsSpec

FUTURE_POLLUTANTS = S.POLLUTANTS


def last_n(df: DataFrame, spec: ObsSpec, n: int, keep_rank: str | None = None) -> DataFrame:
    """The latest ``n`` rows of every entity.

    The counts per (entity, bucket) tell which buckets the rows are in; older buckets are dropped, and rows are
    ranked inside their bucket, so that a busy entity is split over tasks for any ``n``.
    """
    newest = [F.col(c).desc() for c in spec.order]
    out = keep_rank or "_rank"
    cut = df.withColumn(BUCKET, calendar_bucket(spec))
    later = W.partitionBy(spec.entity).orderBy(F.col(BUCKET).desc()).rowsBetween(W.unboundedPreceding, -1)
    counts = cut.groupBy(spec.entity, BUCKET).agg(F.count("*").alias("_n"))
    needed = counts.withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0))).where(F.col("_later") < n)
    needed = needed.select(F.col(spec.entity).alias("_of"), F.col(BUCKET).alias("_in"), "_later")
    inside = F.row_number().over(W.partitionBy(spec.entity, BUCKET).orderBy(*newest))
    same = F.col(spec.entity).eqNullSafe(F.col("_of")) & F.col(BUCKET).eqNullSafe(F.col("_in"))
    ranked = by_group(cut.join(needed, same), spec, BUCKET).withColumn(out, F.col("_later") + inside)
    return ranked.where(F.col(out) <= n).select(*df.columns, *([keep_rank] if keep_rank else []))


def head_n(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def series_tail(df: DataFrame, spec: ObsSpec, n: int) -> DataFrame:
    """One row per entity: its latest row, and ``_tail``, its last ``n`` target values, newest first."""
    rest = [c for c in df.columns if c != spec.entity]
    item = F.struct(F.col("_rank").alias("rank"), F.col(spec.target).cast("double").alias("value"))
    return (
        last_n(df, spec, n, keep_rank="_rank")
        .groupBy(spec.entity)
        .agg(
            F.min_by(F.struct(*rest), "_rank").alias("_row"),
            F.transform(F.array_sort(F.collect_list(item)), lambda e: e["value"]).alias("_tail"),
        )
        .select(spec.entity, "_row.*", "_tail")
    )


def slope_of(tail: Column) -> Column:
    """Mean of the last five differences, 0 with fewer than six values."""
    return F.when(F.size(tail) >= 6, (tail[0] - tail[5]) / 5).otherwise(F.lit(0.0))


def recent_slope(df: DataFrame, spec: ObsSpec) -> DataFrame:
    return series_tail(df, spec, 6).select(spec.entity, slope_of(F.col("_tail")).alias("recent_slope"))


def simulated_value(last: Column, slope: Column, step: Column, hour: Column) -> Column:
    """Trend held to 24 steps of at most 2.5 each, plus a daily wave of height 4, inside the index range."""
    # 2.5, 24, 4, 0 and 500
    wave = 4 * F.sin(F.lit(2 * math.pi) * hour / F.lit(24.0))
    # no argument is ever null here, so plain bounds do
    trend = F.least(F.greatest(slope, F.lit(-2.5)), F.lit(2.5)) * F.least(step, F.lit(24))
    return F.least(F.greatest(last + trend + wave, F.lit(S.AQI_MIN)), F.lit(S.AQI_MAX))


def _steps(df: DataFrame, spec: ObsSpec, hours: int) -> DataFrame:
    tails = series_tail(df, spec, max(max(S.LAGS), 6))
    out = tails.withColumn(OFFSET, F.explode(F.sequence(F.lit(1), F.lit(hours))))
    return out.withColumns(
        {
            "_at": F.col(spec.time) + F.make_dt_interval(hours=F.col(OFFSET)),
            "_last": F.coalesce(F.col("_tail")[0], F.lit(S.FUTURE_DEFAULTS["aqi"])),
            "_slope": slope_of(F.col("_tail")),
        }
    )


def _simulated(spec: ObsSpec, step: Column) -> Column:
    # the wave depends on the hour of the day only
    return simulated_value(F.col("_last"), F.col("_slope"), step, (F.hour(spec.time) + step) % 24)


def simulated_path(df: DataFrame, spec: ObsSpec, hours: int = S.HORIZON) -> DataFrame:
    """(entity, offset, simulated value): a closed form per step, no loop over steps."""
    return _steps(df, spec, hours).select(spec.entity, OFFSET, _simulated(spec, F.col(OFFSET)).alias("simulated"))


def _lag_at(spec: ObsSpec, lag: int) -> Column:
    """History while it lasts, the simulated path after that; the latest value if history is too short."""
    step = F.col(OFFSET)
    known = F.coalesce(F.get("_tail", F.lit(lag) - step), F.col("_last"))
    return F.when(step <= lag, known).otherwise(_simulated(spec, step - lag))


def future_lags(df: DataFrame, spec: ObsSpec, hours: int = S.HORIZON, lags=S.LAGS) -> DataFrame:
    columns = [_lag_at(spec, k).alias(f"{spec.target}_lag_{k}") for k in lags]
    return _steps(df, spec, hours).select(spec.entity, OFFSET, *columns)


def future_features(df: DataFrame, spec: ObsSpec, hours: int = S.HORIZON, carry: list[str] = ()) -> DataFrame:
    """``hours`` feature rows per entity from its featured history.

    Calendar columns and lags move with the step; rolling, weighted, ratio and pollutant columns are
    held at the latest row; changes are 0. ``carry`` names further columns to hold.
    """
    t = spec.target
    last = F.col("_last")

    def held(name: str, default: Column) -> Column:
        return F.coalesce(F.col(name), default) if name in df.columns else default

    parts = calendar_parts(F.col("_at"))
    out = {**parts, **cyclic_parts(parts)}
    out |= {f"{t}_lag_{k}": _lag_at(spec, k) for k in S.LAGS}
    for d in S.ROLLING_DAYS:
        out[f"{t}_roll_mean_{d}d"] = held(f"{t}_roll_mean_{d}d", last)
        out[f"{t}_roll_std_{d}d"] = held(f"{t}_roll_std_{d}d", F.lit(0.0))
    out |= {f"{t}_{name}": F.lit(0.0) for name in ("diff_1h", "diff_3h", "pct_1h")}
    out |= {f"{p}_lag_1": held(f"{p}_lag_1", F.lit(0.0)) for p in S.LAGGED_POLLUTANTS}
    out |= {name: held(name, F.lit(S.FUTURE_DEFAULTS[name])) for name, _, _ in S.RATIOS}
    out |= {f"{t}_ewm_{s}h": held(f"{t}_ewm_{s}h", last) for s in S.EWM_SPANS}
    out |= {p: F.col(p) for p in (*FUTURE_POLLUTANTS, *carry) if p in df.columns}
    frame = _steps(df, spec, hours)
    return frame.select(spec.entity, *[c.alias(n) for n, c in out.items()], OFFSET)


def align_features(df: DataFrame, features: list[str], keep: list[str] = ()) -> DataFrame:
    """The model's columns in its order; what is missing is 0, what is extra is dropped."""
    return df.select(*keep, *[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in features])


def forecast(
    future: DataFrame, model: Transformer, features: list[str], spec: ObsSpec, prediction: str = "prediction"
) -> DataFrame:
    """(entity, offset, predicted): aligned, scored by the fitted pipeline, clipped to the index range."""
    keep = [c for c in (spec.entity, OFFSET) if c not in features]
    aligned = align_features(future, features, keep)
    scored = model.transform(aligned)
    return scored.select(
        spec.entity, OFFSET, X.clip(prediction, S.AQI_MIN, S.AQI_MAX).alias("predicted")
    )


def daily_rollup(hourly: DataFrame, spec: ObsSpec, value: str = "predicted") -> DataFrame:
    day = (F.floor((F.col(OFFSET) - 1) / F.lit(24)) + 1).cast("int")
    return hourly.groupBy(spec.entity, day.alias("day")).agg(
        F.avg(value).alias("aqi_mean"), F.max(value).alias("aqi_max"), F.min(value).alias("aqi_min")
    )


def daily_report(daily: DataFrame, as_of, mode: str = "strict") -> DataFrame:
    """Daily roll-up with date label, rounded values, category and alert. The category and the alert
    look at the unrounded mean."""
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz")
    cat = X.aqi_category("aqi_mean", mode)
    rest = [c for c in daily.columns if c not in ("day", "aqi_mean", "aqi_max", "aqi_min")]
    return daily.select(
        *rest,
        "day",
        X.forecast_date(as_of, "day").alias("date"),
        *[X.report(c, "aqi").alias(c) for c in ("aqi_mean", "aqi_max", "aqi_min")],
        cat["label"].alias("category"),
        cat["color"].alias("color"),
        cat["emoji"].alias("emoji"),
        X.alert_flag("aqi_mean").alias("alert"),
    )


def forecast_document(report: DataFrame, current: DataFrame, metadata: DataFrame, spec: ObsSpec, as_of, attribution: DataFrame | None = None) -> DataFrame:
    """One nested row per entity: current state, days in order, model and metrics.

    ``current`` has one row per entity; ``metadata`` is one row (see ``registry_best``); days per
    entity are bounded by the forecast length.
    """
    day_fields = [c for c in report.columns if c != spec.entity]
    days = report.groupBy(spec.entity).agg(F.array_sort(F.collect_list(F.struct(*day_fields))).alias("daily_predictions"))
    cat = X.aqi_category(spec.target)
    now = F.struct(*[F.col(c) if c in current.columns else F.lit(None).cast("double").alias(c) for c in ("temp", "humidity", "wind_speed", "pressure")])
    measured = F.struct(
        *[
            X.report(F.coalesce(F.col(p).cast("double"), F.lit(0.0)) if p in current.columns else F.lit(0.0), "pollutant").alias(p)
            for p in ("pm2_5", "pm10", "no2", "o3", "co")
        ]
    )
    model_fields = [c for c in ("mae", "rmse", "r2", "trained_at") if c in metadata.columns]
    model = metadata.select(
        F.struct(F.col("model_name").alias("model_name"), F.struct(*model_fields).alias("model_metrics")).alias("m")
    ).scalar()
    head = current.select(
        spec.entity,
        X.report(spec.target, "aqi").alias("current_aqi"),
        cat["label"].alias("current_category"),
        cat["color"].alias("current_color"),
        cat["emoji"].alias("current_emoji"),
        X.alert_flag(spec.target).alias("current_alert"),
        now.alias("current_weather"),
        measured.alias("current_pollutants"),
    )
    doc = head.join(days, spec.entity).withColumns(
        {
            "model_name": model["model_name"],
            "model_metrics": model["model_metrics"],
            "forecast_days": F.size("daily_predictions"),
            "generated_at": F.lit(as_of).cast("timestamp_ntz"),
        }
    )
    if attribution is not None:
        # at most a handful of top features, per entity if the attribution has the entity
        by = [spec.entity] if spec.entity in attribution.columns else []
        item = F.struct(X.report("importance", "metric").alias("importance"), F.col("feature"))
        top = attribution.groupBy(*by).agg(F.collect_list(item).alias("t")).select(
            *by, F.transform(F.sort_array("t", asc=False), lambda e: F.struct(e["feature"].alias("feature"), e["importance"].alias("importance"))).alias("top_features")
        )
        doc = doc.join(top, spec.entity, "left") if by else doc.withColumn("top_features", top.scalar())
    return doc


def append_observation(history: DataFrame, current: DataFrame, spec: ObsSpec) -> DataFrame:
    """History plus one current row per entity of ``current`` (which holds entity, time and any readings).

    A reading that the current row does not carry as a column is taken from the entity's latest row, else
    0; a column neither side has stays absent; other columns of the new row are null.
    """
    carried = [c for c in (spec.target, *S.POLLUTANTS, *S.WEATHER) if c in history.columns and c not in current.columns]
    row = current
    if carried:
        latest = history.groupBy(spec.entity).agg(F.max_by(F.struct(*carried), _newest(spec)).alias("_known"))
        row = current.join(latest, spec.entity, "left")
        known = F.col("_known")
        row = row.withColumns({c: F.when(known.isNull(), F.lit(0.0)).otherwise(known[c]) for c in carried}).drop("_known")
    if spec.target not in row.columns:
        row = row.withColumn(spec.target, F.lit(0.0))
    return history.unionByName(row, allowMissingColumns=True)


def _newest(spec: ObsSpec) -> Column:
    return F.struct(*spec.order)


def trend_series(history: DataFrame, daily: DataFrame, current: DataFrame, spec: ObsSpec, hours: int = 48) -> DataFrame:
    """(entity, series, time, value): the latest hours of history, then the current value at the last
    history time followed by the daily means at their dates."""
    t = spec.time
    recent = last_n(history, spec, hours).select(
        spec.entity, F.lit("history").alias("series"), F.col(t), F.col(spec.target).cast("double").alias("value")
    )
    last_time = history.groupBy(spec.entity).agg(F.max(t).alias(t))
    start = current.select(spec.entity, F.col(spec.target).cast("double").alias("value")).join(last_time, spec.entity)
    ahead = start.select(spec.entity, F.lit("forecast").alias("series"), t, "value").unionByName(
        daily.select(
            spec.entity,
            F.lit("forecast").alias("series"),
            F.col("date").cast("timestamp_ntz").alias(t),
            F.col("aqi_mean").alias("value"),
        )
    )
    return recent.unionByName(ahead)
