"""Fitting, tuning and comparing regressors on horizon frames.

Loops here run over models, parameter points and folds, of which there are a few dozen; every fit and
every score inside them is a distributed job over one written table of scaled vectors, and a few run at a time. Linear models need
no such loop: the sums of products of each fold, a matrix as wide as the features, come from one pass, and
all folds and penalties are solved from them. Trees whose rows fit into a task need none either: each point and fold is fitted and scored in tasks of one job.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import Lock
from typing import Callable
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, functions as F

from aqspark import spec as S
from aqspark.operators import boosting as Bo, forest as Fo, horizon as H
from aqspark.operators.boosting import BoostingRegressor
from aqspark.operators.evaluate import cv_summary, regression_metrics
from aqspark.operators.forest import ForestRegressor
from aqspark.sources.staging import stage, staging_root

LABEL = H.TARGET
VECTOR = "features"
#: Fits that run at the same time.
PARALLEL_FITS = 3
#: Trees remember the node of each row instead of walking all trees so far, and cut that lineage in the shared folder;
#: the statistics of a whole level fit into this many megabytes of a task where they can.
_TREES = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 1024}


@dataclass(frozen=True)
class Candidate:
    """``build(params, train)`` returns an unfitted regressor reading ``features`` and ``label``."""

    name: str
    build: Callable[[dict, DataFrame, str], Estimator]
    params: dict = field(default_factory=dict)
    grid: dict | None = None


def _linear(params: dict, train: DataFrame, label: str) -> Estimator:
    return LinearRegression(featuresCol="features", labelCol=label, regParam=0.0, solver="normal")


def _ridge(params: dict, train: DataFrame, label: str) -> Estimator:
    """Penalty ``alpha`` on plain squared coefficients. The solver divides the loss by the row count and
    the label's deviation, so the penalty is divided alike."""
    n, deviation = train.agg(F.count(label), F.stddev_pop(label)).first()
    reg = params["alpha"] * deviation / n if n and deviation else 0.0
    return LinearRegression(
        featuresCol="features", labelCol=label, elasticNetParam=0.0, standardization=False, solver="normal", regParam=reg
    )


def _forest(params: dict, train: DataFrame, label: str) -> Estimator:
    """A split needs two children, so the least leaf is half the least split."""
    return ForestRegressor(
        params["n_estimators"], params["max_depth"], max(1, params["min_samples_split"] // 2), params["max_features"], S.SEED, "features", label
    )


def _boosting(params: dict, train: DataFrame, label: str) -> Estimator:
    rate, columns = params.get("subsample", 1.0), str(params.get("colsample", "all"))
    return BoostingRegressor(params["n_estimators"], params["learning_rate"], params["max_depth"], rate, columns, S.SEED, _boosting_by_passes(params, train, label), "features", label)


def _boosting_by_passes(params: dict, train: DataFrame, label: str) -> Estimator:
    return GBTRegressor(
        featuresCol="features",
        labelCol=label,
        maxIter=params["n_estimators"],
        stepSize=params["learning_rate"],
        maxDepth=params["max_depth"],
        subsamplingRate=params.get("subsample", 1.0),
        featureSubsetStrategy=str(params.get("colsample", "all")),
        seed=S.SEED,
        **_TREES,
    )


def candidates() -> list[Candidate]:
    # Model parameters and search grids
    return [
        Candidate("Linear Regression", _linear),
        Candidate("Ridge Regression", _ridge, {"alpha": 1.0}, {"alpha": [0.01, 0.1, 1.0, 10.0, 100.0]}),
        Candidate(
            "Random Forest",
            _forest,
            {"n_estimators": 120, "max_depth": None, "min_samples_split": 2, "max_features": "all"},
            {
                "n_estimators": [100, 200, 300],
                "max_depth": [None, 10, 20, 30],
                "min_samples_split": [2, 5, 10],
                "max_features": ["sqrt", "log2"],
            },
        ),
        Candidate(
            "Gradient Boosting",
            _boosting,
            {"n_estimators": 120, "learning_rate": 0.05, "max_depth": 5},
            {
                "n_estimators": [100, 200, 300],
                "learning_rate": [0.01, 0.05, 0.1],
                "max_depth": [3, 5, 7],
                "subsample": [0.7, 0.8, 1.0],
            },
        ),
        # stands in for a boosting library that samples rows and columns
        Candidate(
            "Sampled Gradient Boosting",
            _boosting,
            {"n_estimators": 200, "learning_rate": 0.05, "max_depth": 6, "subsample": 0.8, "colsample": 0.8},
            {
                "n_estimators": [200, 300, 500],
                "learning_rate": [0.01, 0.05, 0.1],
                "max_depth": [4, 6, 8],
                "subsample": [0.7, 0.8, 0.9],
                "colsample": [0.7, 0.8, 1.0],
            },
        ),
    ]


def candidate(name: str, **params) -> Candidate:
    found = next(c for c in candidates() if c.name == name)
    return Candidate(found.name, found.build, {**found.params, **params}, found.grid)


def scaling_stage(parameters: DataFrame, features: list[str]) -> SQLTransformer:
    """The fitted scaler as a pipeline stage; two numbers per feature come to the driver."""
    fitted = {r["column"]: (r["center"], r["scale"]) for r in parameters.collect()}
    scaled = ", ".join(
        f"(CAST(`{c}` AS DOUBLE) - {fitted[c][0]!r}D) / {fitted[c][1]!r}D AS `{c}__scaled`" for c in features if c in fitted
    )
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


def preparation(features: list[str], scaler: SQLTransformer | None = None) -> list:
    inputs = [f"{c}__scaled" for c in features] if scaler else list(features)
    stages = [scaler] if scaler else []
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def vectors(df: DataFrame, features: list[str], label: str = LABEL, scaler=None, keep: list[str] = ()) -> DataFrame:
    """The scaled features as one vector, the label and ``keep``, written once for all fits. A frame that has vectors is returned as it is."""
    if VECTOR in df.columns:
        return df
    return stage(PipelineModel(preparation(features, scaler)).transform(df).select(VECTOR, label, *keep), "vectors")


def fit(c: Candidate, train: DataFrame, features: list[str], label: str = LABEL, scaler=None) -> PipelineModel:
    """The fitted pipeline, which reads plain columns; ``train`` may hold them or their vectors."""
    _shared_checkpoints(train)
    prepared = preparation(features, scaler)
    rows = train if VECTOR in train.columns else PipelineModel(prepared).transform(train).select(VECTOR, label)
    return PipelineModel([*prepared, c.build(c.params, rows, label).fit(rows)])


def _shared_checkpoints(df: DataFrame) -> None:
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(staging_root(df.sparkSession))


def _at_once(spark, tasks: list[Callable]) -> list:
    """Results of independent jobs, a few at a time, in order."""
    with ThreadPool(PARALLEL_FITS) as pool:
        return pool.map(lambda run: inheritable_thread_target(spark)(run)(), tasks, 1)


def fit_linear(train, features, label=LABEL, scaler=None):
    return fit(candidate("Linear Regression"), train, features, label, scaler)


def fit_ridge(train, features, label=LABEL, scaler=None, alpha: float = 1.0):
    return fit(candidate("Ridge Regression", alpha=alpha), train, features, label, scaler)


def fit_random_forest(train, features, label=LABEL, scaler=None, **params):
    return fit(candidate("Random Forest", **params), train, features, label, scaler)


def fit_gbt(train, features, label=LABEL, scaler=None, sampled: bool = False, **params):
    c = candidate("Sampled Gradient Boosting" if sampled else "Gradient Boosting", **params)
    return fit(Candidate(c.name, _boosting_by_passes, c.params, c.grid), train, features, label, scaler)


def score(model: PipelineModel, df: DataFrame, label: str = LABEL) -> DataFrame:
    predicted = model.stages[-1].transform(df) if VECTOR in df.columns else model.transform(df)
    return regression_metrics(predicted, label, "prediction")


# ---- linear models from sums of products -----------------------------------------------------


def moments(df: DataFrame, label: str, by: list[str]) -> dict[tuple, np.ndarray]:
    """For each key the matrix of sums of products of (1, vector, label): additive, so tasks add up their rows and
    keys can be added and subtracted. There are as many matrices as folds."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for batch in rows:
            if not batch.num_rows:
                continue
            v = batch.column("v")
            x = np.column_stack([np.ones(batch.num_rows), v.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), batch.column("y").to_numpy(zero_copy_only=False)])
            keys = list(zip(*(batch.column(k).to_pylist() for k in by))) if by else [()] * batch.num_rows
            for key in dict.fromkeys(keys):
                own = x[[k == key for k in keys]]
                sums[key] = sums.get(key, 0) + own.T @ own
        for key, m in sums.items():
            columns = [pa.array([k] * m.size, t) for k, t in zip(key, kinds)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(m.size, dtype=np.int32)), pa.array(m.ravel())], names=[*by, "cell", "value"])

    rows = df.select(*by, vector_to_array(VECTOR).alias("v"), F.col(label).cast("double").alias("y"))
    kinds = [pa.int32() if rows.schema[k].dataType.simpleString() == "int" else pa.string() for k in by]
    schema = ", ".join([*(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in by), "cell int", "value double"])
    out: dict[tuple, dict[int, float]] = {}
    for r_ in rows.mapInArrow(run, schema).groupBy(*by, "cell").agg(F.sum("value").alias("value")).collect():
        out.setdefault(tuple(r_[k] for k in by), {})[r_["cell"]] = r_["value"]
    square = lambda cells: np.array([cells[i] for i in range(len(cells))]).reshape(int(round(len(cells) ** 0.5)), -1)
    return {key: square(cells) for key, cells in out.items()}


def solve(m: np.ndarray, alpha: float) -> np.ndarray:
    """Intercept and coefficients with a penalty ``alpha`` on plain squared coefficients; the shortest ones if columns depend on each other."""
    n, sums, product = m[0, 0], m[0, 1:], m[1:, 1:]
    centred = product - np.outer(sums, sums) / n
    w = np.linalg.lstsq(centred[:-1, :-1] + alpha * np.eye(len(centred) - 1), centred[:-1, -1], rcond=None)[0]
    return np.concatenate([[(sums[-1] - sums[:-1] @ w) / n], w])


def rmse_of(m: np.ndarray, beta: np.ndarray) -> float:
    residual = np.concatenate([-beta, [1.0]])
    return float(np.sqrt(max(residual @ m @ residual, 0.0) / m[0, 0]))


def _is_linear(c: Candidate) -> bool:
    return c.build in (_linear, _ridge)


# ---- errors of trees, folds side by side ---------------------------------------------------------


@dataclass
class Folds:
    """Chunks of the training and the held rows of each fold (``part``), in the bins of its training rows."""

    chunks: DataFrame
    sizes: dict[int, list[int]]


_folds: WeakKeyDictionary[DataFrame, tuple[Lock, dict]] = WeakKeyDictionary()
_folding = Lock()


def _folds_in_tasks(rows: DataFrame, label: str, marks: dict[int, tuple]) -> Folds | None:
    """Made once for all candidates on one frame; none if the rows of a fold don't fit into a task. ``marks``: what tells training and held rows of each fold."""
    with _folding:
        lock, made = _folds.setdefault(rows, (Lock(), {}))
    with lock:
        if (label, str(marks)) not in made:
            made[label, str(marks)] = _fold_bins(rows, label, marks)
        return made[label, str(marks)]


def _fold_bins(rows: DataFrame, label: str, marks: dict[int, tuple]) -> Folds | None:
    plain = rows.select(vector_to_array(VECTOR).alias("v"), F.col(label).cast("double").alias("y"), *[c for c in rows.columns if c not in (VECTOR, label)])
    count = lambda m: F.coalesce(F.sum(m.cast("long")), F.lit(0))
    n = plain.agg(F.max(F.size("v")), *[count(m) for both in marks.values() for m in both]).first()
    trained, held = n[1::2], n[2::2]
    if not all(trained):
        raise ValueError("no rows to fit")
    if max(n[1:]) > Fo.TASK_ROWS or not Bo.fits(max(map(sum, zip(trained, held))), n[0]):
        return None
    part = {k: [plain.where(m).select("v", "y") for m in both] for k, both in marks.items()}
    cuts = dict(zip(marks, _at_once(rows.sparkSession, [lambda k=k: Fo.candidate_cuts(part[k][0], n[0]) for k in marks])))
    tables = [Fo.binned(df, cuts[k]).select(F.lit(k).alias("part"), F.lit(is_held).alias("held"), "*") for k in marks for df, is_held in zip(part[k], (False, True))]
    return Folds(stage(reduce(DataFrame.unionAll, tables), "folds"), {k: [len(c) + 1 for c in cuts[k]] for k in marks})


def _is_tree(c: Candidate) -> bool:
    return c.build in (_forest, _boosting)


def _tree_errors(points: list[Candidate], folds: Folds) -> list[dict[int, float]]:
    """For each point of a forest or of boosting its error on the held rows of each fold. Points that differ in the number of trees alone share one run, forests also those that differ in depth."""
    forest = points[0].build is _forest
    runs: dict[str, dict] = {}
    own = []
    for c in points:
        p = c.params
        if forest:
            made = ForestRegressor(p["n_estimators"], p["max_depth"], max(1, p["min_samples_split"] // 2), p["max_features"], S.SEED)
            k = len(next(iter(folds.sizes.values())))
            run, want = {"least": made.least, "strategy": made.strategy, "subset": Fo.features_per_split(made.strategy, k)}, (made.trees, made.depth)
            key = str((run["least"], run["subset"]))
        else:
            run, want = {"step": p["learning_rate"], "depth": p["max_depth"], "rate": p.get("subsample", 1.0), "columns": str(p.get("colsample", "all"))}, p["n_estimators"]
            key = str(run)
        runs.setdefault(key, {**run, "wanted": set()})["wanted"].add(want)
        own.append((key, want))
    at = {key: i for i, key in enumerate(runs)}
    found = (Fo if forest else Bo).errors(folds.chunks, folds.sizes, list(runs.values()), S.SEED)
    return [{part: found[at[key], part][want] for part in folds.sizes} for key, want in own]


def sampled_points(grid: dict, n_iter: int = 20, seed: int = S.SEED) -> list[dict]:
    """All points of a small grid, else ``n_iter`` of them without repetition, the same for one seed."""
    points = [dict(zip(grid, values)) for values in product(*grid.values())]
    return points if len(points) <= n_iter else random.Random(seed).sample(points, n_iter)


def random_search(
    c: Candidate, train: DataFrame, features: list[str], label: str = LABEL, scaler=None, fold: str = "fold",
    n_iter: int = 20, folds: int = 3,
) -> tuple[Candidate, PipelineModel, DataFrame]:
    """Mean fold RMSE per grid point, refit of the best on all rows. ``train`` carries a fold column
    (:func:`horizon.contiguous_folds`). Returns the tuned candidate, its model and the score table.

    Linear models take one pass for all points and folds. Trees are fitted in tasks, all points and folds side by side; points that differ
    in the number of trees alone share one run. Folds too large for a task are fitted one by one: boosting once for points that differ in the number of stages
    alone, as the shorter runs are the first stages of the longest one, which has the same seeds.
    """
    spark = train.sparkSession
    rows = vectors(train, features, label, scaler, [fold])
    points = sampled_points(c.grid, n_iter)
    tuned = [Candidate(c.name, c.build, {**c.params, **point}, c.grid) for point in points]
    if _is_linear(c):
        each = moments(rows.withColumn(fold, F.col(fold).cast("int")), label, [fold])
        total = sum(each.values())
        errors = [[rmse_of(each[k,], solve(total - each[k,], t.params.get("alpha", 0.0))) for k in range(folds)] for t in tuned]
    elif _is_tree(c) and (parts := _folds_in_tasks(rows, label, {k: (F.col(fold) != k, F.col(fold) == k) for k in range(folds)})):
        errors = [[e[k] for k in range(folds)] for e in _tree_errors(tuned, parts)]
    else:
        groups: dict[str, list[int]] = {}
        for i, point in enumerate(points):
            alike = {k: v for k, v in point.items() if k != "n_estimators" or c.build is not _boosting}
            groups.setdefault(str(alike), []).append(i)

        def fold_errors(members: list[int], k: int) -> dict[int, float]:
            longest = max(members, key=lambda i: tuned[i].params["n_estimators"])
            model = fit(tuned[longest], rows.where(F.col(fold) != k), features, label, scaler)
            held = rows.where(F.col(fold) == k)
            if len(members) == 1:
                return {longest: score(model, held, label).first()["rmse"]}
            if isinstance(model.stages[-1], Fo.ForestModel):  # this fold fits into a task, another one doesn't
                return {i: score(fit(tuned[i], rows.where(F.col(fold) != k), features, label, scaler), held, label).first()["rmse"] for i in members}
            loss = model.stages[-1].evaluateEachIteration(held, "squared")
            return {i: float(np.sqrt(loss[tuned[i].params["n_estimators"] - 1])) for i in members}

        jobs = [(members, k) for members in groups.values() for k in range(folds)]
        found = _at_once(spark, [lambda m=m, k=k: fold_errors(m, k) for m, k in jobs])
        errors = [[f[i] for (m, _), f in zip(jobs, found) if i in m] for i in range(len(points))]
    scored = [(i, str(point), float(sum(e) / len(e))) for i, (point, e) in enumerate(zip(points, errors))]
    best = tuned[min(scored, key=lambda x: (x[2], x[0]))[0]]
    table = spark.createDataFrame(scored, "point int, params string, mean_rmse double")
    return best, fit(best, rows, features, label, scaler), table


def cross_validate(c: Candidate, folded: DataFrame, features: list[str], label: str = LABEL, scaler=None) -> DataFrame:
    """(fold, rmse) over rows marked (fold, role) by :func:`horizon.time_series_folds`. Linear models take one pass for all folds."""
    spark = folded.sparkSession
    rows = vectors(folded, features, label, scaler, ["fold", "role"])
    if _is_linear(c):
        each = moments(rows.withColumn("fold", F.col("fold").cast("int")), label, ["fold", "role"])
        numbers = sorted({k for k, role in each if role == "train"})
        found = [rmse_of(each[k, "test"], solve(each[k, "train"], c.params.get("alpha", 0.0))) for k in numbers]
    else:
        numbers = sorted(r[0] for r in rows.select("fold").distinct().collect())  # at most the number of folds
        marks = {k: tuple((F.col("fold") == k) & (F.col("role") == role) for role in ("train", "test")) for k in numbers}

        def one(k: int) -> float:
            part = rows.where(F.col("fold") == k)
            model = fit(c, part.where(F.col("role") == "train"), features, label, scaler)
            return score(model, part.where(F.col("role") == "test"), label).first()["rmse"]

        if _is_tree(c) and numbers and (parts := _folds_in_tasks(rows, label, marks)):
            errors = _tree_errors([c], parts)[0]
            found = [errors[k] for k in numbers]
        else:
            found = _at_once(spark, [lambda k=k: one(k) for k in numbers])
    return spark.createDataFrame(list(zip(numbers, found)), "fold int, rmse double")


def train_compare(
    train: DataFrame, test: DataFrame, folded: DataFrame, features: list[str], models: list[Candidate],
    label: str = LABEL, scaler=None, tune: bool = False, n_iter: int = 20, folds: int = 3,
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Fit every candidate (tuned if asked), cross-validate, score the hold-out. Returns the result table,
    rounded to 4 decimals, and the fitted pipelines by name."""
    spark = train.sparkSession
    fold = ["fold"] if tune and "fold" in train.columns else []
    train, test = vectors(train, features, label, scaler, fold), vectors(test, features, label, scaler)
    folded = vectors(folded, features, label, scaler, ["fold", "role"])

    def one(c: Candidate) -> tuple[PipelineModel, tuple]:
        if tune and c.grid:
            c, model, _ = random_search(c, train, features, label, scaler, n_iter=n_iter, folds=folds)
        else:
            model = fit(c, train, features, label, scaler)
        held = score(model, test, label).first()
        cv = cv_summary(cross_validate(c, folded, features, label, scaler)).first()
        return model, (c.name, held["mae"], held["rmse"], held["r2"], cv["cv_rmse_mean"], cv["cv_rmse_std"])

    # boosting, whose stages follow one another, begins first and leaves cores to the others
    order = sorted(range(len(models)), key=lambda i: (models[i].build is not _boosting, -i))
    found = dict(zip(order, _at_once(spark, [lambda c=models[i]: one(c) for i in order])))
    fitted, rows = {c.name: found[i][0] for i, c in enumerate(models)}, [found[i][1] for i in range(len(models))]
    if not rows:
        raise ValueError("no model candidates")
    names = ["mae", "rmse", "r2", "cv_rmse_mean", "cv_rmse_std"]
    table = spark.createDataFrame(rows, "model_name string, " + ", ".join(f"{n} double" for n in names))
    return table.withColumns({n: F.round(n, 4) for n in names}), fitted
