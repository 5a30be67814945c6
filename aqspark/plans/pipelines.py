"""Jobs: the operators composed from landed data to feature table, model and forecast.

Operators are lazy; jobs write a table wherever several later passes would repeat a stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, functions as F

from aqspark import spec as S
from aqspark.operators import attribution as A, clean as C, evaluate as E, features as Ft, forecast as Fc, horizon as H, ml as M
from aqspark.operators.blocks import with_global_index
from aqspark.operators.evaluate import best_model, leaderboard
from aqspark.operators.scale import scale_parameters
from aqspark.sources import observations as O, registry as R, store as St
from aqspark.sources.payloads import zero_fill_payload
from aqspark.sources.staging import stage
from aqspark.spec import ObsSpec


def clean_data(df: DataFrame, spec: ObsSpec, entities=None) -> DataFrame:
    return C.clean(df, spec, entities)


def handle_missing(df: DataFrame, spec: ObsSpec, by: list[str] = ()) -> DataFrame:
    """Forward fill, backward fill, then medians for columns an entity never reported.

    The filled table is written once; one pass tells which columns still need a median, mostly none.
    """
    columns = [c for c in C.numeric_columns(df) if c != spec.seq]
    filled = stage(C.fill(df, spec, columns), "filled")
    nulls = {r["column"]: r["nulls"] for r in C.null_profile(filled.select(*columns)).collect()}
    missing = [c for c in columns if nulls[c]]
    return C.median_impute(filled, missing, by) if missing else filled


@dataclass
class Prepared:
    """A staged frame with one row per observation and the array of its targets, plus the fitted scaler."""

    near: DataFrame
    features: list[str]
    scaler: SQLTransformer
    parameters: DataFrame
    test_fraction: float

    def frame(self) -> DataFrame:
        """(columns, offset, target, index, count, split): expanded from the staged table by a narrow step."""
        expanded = H.expand_horizons(self.near, "_idx")
        first_test = F.floor(F.col("_n") * F.lit(1 - self.test_fraction))
        return expanded.withColumn("split", F.when(F.col("_idx") < first_test, "train").otherwise("test"))

    def train(self) -> DataFrame:
        """Training rows; they come first in order, so their index runs from 0 to their count."""
        rows = self.frame().where(F.col("split") == "train")
        return rows.withColumn("_n", F.floor(F.col("_n") * F.lit(1 - self.test_fraction)))

    def scale_parameters(self) -> DataFrame:
        """Medians and quartile distances over the training rows. A row counts as often as it has horizons among them, so that the
        expanded frame isn't read; the horizons themselves are counted by the lists of them, of which there are few."""
        first_test = F.floor(F.col("_n") * F.lit(1 - self.test_fraction))
        weight = F.greatest(F.lit(0), F.least(first_test - F.col("_idx"), F.size(H.NEXT)))
        rows = self.near.withColumn("_w", weight.cast("int"))
        offsets = F.slice(F.transform(H.NEXT, lambda e: e["h"]), F.lit(1), F.col("_w"))
        lists = rows.groupBy(offsets.alias("_offsets")).agg(F.count("*").alias("_w"))
        counts = lists.select("_w", F.explode("_offsets").alias(H.OFFSET)).groupBy(H.OFFSET).agg(F.sum("_w").alias("_w"))
        of_rows = scale_parameters(rows, [c for c in self.features if c != H.OFFSET], "_w")
        return of_rows.unionByName(scale_parameters(counts, [H.OFFSET], "_w"))

    def test(self) -> DataFrame:
        return self.frame().where(F.col("split") == "test")


def preprocess_job(
    raw: DataFrame, spec: ObsSpec, entities=None, hours: int = S.HORIZON, test_fraction: float = S.TEST_FRACTION,
    processed_path: str | None = None,
) -> Prepared:
    """Clean, impute, cap, build features (unless an ``hour`` column says that was done), drop incomplete
    rows, number, split and fit the scaler.

    The frame with one row per horizon is never written or shuffled: rows are numbered before they are expanded, and the
    scaler is fitted on weighted rows.
    """
    plain = spec.with_(seq=None)
    cleaned = stage(clean_data(raw, spec, entities), "cleaned")
    if cleaned.isEmpty():
        raise ValueError("no rows left after cleaning")
    imputed = handle_missing(cleaned, plain)
    # fences are fitted on the written table; the capped rows are read twice by the feature windows
    capped = stage(C.winsorise(imputed), "capped")
    featured = capped if "hour" in capped.columns else Ft.all_features(capped, plain)
    complete = C.drop_incomplete(featured)
    if processed_path:
        St.write_processed(complete, processed_path, plain)
        complete = St.read_features(raw.sparkSession, processed_path)
    else:
        complete = stage(complete, "processed")
    arrays = H.horizon_arrays(complete, plain, hours)
    near = stage(with_global_index(arrays, plain, weight=F.size(H.NEXT)), "horizons")
    names = [c for c in H.feature_columns(complete, spec=plain) if c != spec.seq] + [H.OFFSET]
    prepared = Prepared(near, names, None, None, test_fraction)
    prepared.parameters = stage(prepared.scale_parameters(), "scaler")
    prepared.scaler = M.scaling_stage(prepared.parameters, names)
    return prepared


def backfill_job(raw: DataFrame, spec: ObsSpec, path: str | None, entities=None, shards: int = 4) -> DataFrame:
    """Features of landed history for all entities at once, with medians and fences per entity; upserted
    into the table at ``path`` if one is given."""
    plain = spec.with_(seq=None)
    cleaned = stage(clean_data(raw, spec, entities), "cleaned")
    imputed = handle_missing(cleaned, plain, by=[spec.entity])
    capped = stage(C.winsorise(imputed, by=[spec.entity]), "capped")
    featured = C.drop_incomplete(Ft.all_features(capped, plain))
    return featured if path is None else St.upsert_features(path, featured, plain, shards)


def latest_payload(history: DataFrame, current: DataFrame, spec: ObsSpec) -> DataFrame:
    """The newest complete feature row of every entity in ``current``.

    Only as many recent rows as a feature can see are read into the windows. The current reading replaces
    one that history has for the same time. Weather columns are filled
    forward and backward, and take the current value where history has none.
    """
    asked = current.select(spec.entity).distinct()
    names = [c for c in (spec.target, *S.POLLUTANTS, *S.WEATHER)]
    now = current.select(
        spec.entity,
        spec.time,
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in current.columns else F.lit(0.0).alias(c) for c in names],
    )
    recent = Fc.last_n(history.join(asked, spec.entity, "left_semi"), spec, Ft.feature_reach() + 1)
    context = recent.join(now.select(*spec.key), spec.key, "left_anti").unionByName(now, allowMissingColumns=True)
    # the windows below read this more than once; it is small, at most the reach of a feature per entity
    filled = stage(C.fill(context, spec.with_(seq=None), list(S.WEATHER)), "context")
    featured = Ft.all_features(filled, spec.with_(seq=None))
    return zero_fill_payload(Fc.last_n(featured, spec.with_(seq=None), 1))


def ingest_job(history: DataFrame, landed_history: DataFrame, current: DataFrame, spec: ObsSpec, path: str, shards: int = 4) -> DataFrame:
    """Merge parsed history, build the newest feature row per entity, upsert it. Frames come from
    ``sources.payloads``."""
    merged = stage(O.merge_history(history, landed_history, spec), "history")
    return St.upsert_features(path, latest_payload(merged, current, spec), spec.with_(seq=None), shards)


@dataclass
class Trained:
    results: DataFrame
    models: dict[str, PipelineModel]
    features: list[str]


def train_job(
    prepared: Prepared, models: list[M.Candidate] | None = None, tune: bool = False, n_iter: int = 20,
    max_cv_rows: int = S.MAX_CV_ROWS, folds: int = S.CV_FOLDS, registry: str | None = None, version: int | None = None,
    trained_at: str = "",
) -> Trained:
    """Compare candidates on the prepared frame; with ``registry`` the best one is saved there."""
    train = prepared.train()
    i, n = F.col("_idx"), F.col("_n")
    sampled = train.withColumn("_idx", H.sample_hit(i, n, max_cv_rows)).where(i.isNotNull())
    size = F.least(n, F.lit(max_cv_rows))
    member = F.explode(H.expanding_members(i, size, folds, 5000))
    kept = [*prepared.features, H.TARGET]
    folded = stage(sampled.withColumn("_m", member).select(*kept, "_m.fold", "_m.role"), "folds")
    if tune:
        train = train.withColumn("fold", H.contiguous_fold(i, n, 3))
    table, fitted = M.train_compare(
        train, prepared.test(), folded, prepared.features, models or M.candidates(), scaler=prepared.scaler, tune=tune, n_iter=n_iter
    )
    table = leaderboard(table)
    if registry:
        best = best_model(table).first().asDict()
        R.registry_save(
            table.sparkSession, registry, fitted[best["model_name"]], best, prepared.features, version, trained_at
        )
    return Trained(table, fitted, prepared.features)


def future_job(history: DataFrame, current: DataFrame, spec: ObsSpec, days: int = S.FORECAST_DAYS, history_rows: int | None = None, entities=None) -> DataFrame:
    """The feature rows of the next ``days`` days of every entity in ``current``, from its latest rows and its current reading.

    ``history_rows``: by default as many rows as a feature can reach back. An entity's forecast does not depend on
    the others: its gaps take its own medians, and a column it never reported counts as 0. A series
    shorter than a lag is forecast from the rows it has.
    """
    plain = spec.with_(seq=None)
    known = [c for c in history.columns if c in (*plain.key, plain.target, *S.POLLUTANTS, *S.WEATHER)]
    recent = Fc.last_n(history.join(current.select(spec.entity).distinct(), spec.entity, "left_semi"), spec, history_rows or Ft.feature_reach() + 1)
    seq = "_seq"
    observed = Fc.append_observation(recent.select(*known).withColumn(seq, F.lit(0)), current.withColumn(seq, F.lit(1)), plain)
    cleaned = stage(clean_data(observed, plain.with_(seq=seq), entities).drop(seq), "cleaned")
    imputed = handle_missing(cleaned, plain, by=[spec.entity])
    imputed = imputed.fillna(0, subset=C.numeric_columns(imputed))
    # a small table, and a plan of its own: the optimizer is slow on the filter and the rank together
    featured = stage(C.drop_incomplete_or_short(stage(Ft.all_features(stage(imputed, "imputed"), plain), "features"), plain), "featured")
    carry = [c for c in S.WEATHER if c in featured.columns]
    return Fc.future_features(featured, plain, days * 24, carry)


def forecast_job(
    history: DataFrame, current: DataFrame, model: PipelineModel, features: list[str], spec: ObsSpec, as_of: str,
    days: int = S.FORECAST_DAYS, history_rows: int | None = None, entities=None,
) -> tuple[DataFrame, DataFrame]:
    """(hourly, daily) forecasts of every entity in ``current``; see :func:`future_job`."""
    plain = spec.with_(seq=None)
    future = future_job(history, current, spec, days, history_rows, entities)
    hourly = stage(Fc.forecast(future, model, features, plain), "hourly")
    return hourly, Fc.daily_report(Fc.daily_rollup(hourly, plain), as_of)


def forecast_documents_job(
    history: DataFrame, current: DataFrame, registry: str, spec: ObsSpec, as_of: str, days: int = S.FORECAST_DAYS, top: int = 15, entities=None,
) -> tuple[DataFrame, DataFrame]:
    """(documents, missing): a document per entity with days, model, metrics and its own top features, by the best model of the registry;
    and the entities of ``current`` that got none, because cleaning left nothing of them.

    Features are attributed on the rows that were forecast, against the mean of all of them.
    """
    plain = spec.with_(seq=None)
    model, metadata = R.registry_load(history.sparkSession, registry)
    features = list(metadata.first()["feature_names"])
    future = stage(future_job(history, current, spec, days, None, entities), "future")
    daily = Fc.daily_report(Fc.daily_rollup(Fc.forecast(future, model, features, plain), plain), as_of)
    aligned = Fc.align_features(future, features, [c for c in (spec.entity, H.OFFSET) if c not in features])
    parts = A.attribution(aligned, model, features, [spec.entity, H.OFFSET], aligned)
    importance = E.mean_abs_importance(parts, top, [spec.entity])
    # one reading per entity: the current one, where it lacks a column the latest of history
    now = Fc.last_n(Fc.append_observation(history.join(current.select(spec.entity).distinct(), spec.entity, "left_semi"), current, plain), plain, 1)
    documents = Fc.forecast_document(stage(daily, "daily"), now, metadata, plain, as_of, importance)
    missing = current.select(spec.entity).distinct().join(daily.select(spec.entity).distinct(), spec.entity, "left_anti")
    return documents, missing


def train_from_table_job(
    spark, sources: list[str], registry: str, spec: ObsSpec, as_of: str, days: int = S.TRAINING_DAYS, models: list[M.Candidate] | None = None, tune: bool = False, **options,
) -> Trained:
    """Train on the first of ``sources`` (feature tables, the preferred one first) that has rows, over its last ``days`` days, and save the best model."""
    for path in sources:
        table = St.open_features(spark, path) if St._exists(spark, path) else None
        if table is not None and not table.isEmpty():
            raw = St.training_window(table, as_of, spec, days)
            return train_job(preprocess_job(raw, spec, **options), models, tune, registry=registry, trained_at=as_of)
    raise ValueError("no source has rows")
