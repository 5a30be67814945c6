"""Trees grown in tasks: boosting against Spark ML, errors of points against single fits, models that don't come to the driver."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from aqspark.operators import boosting as Bo, forest as Fo, ml as M

NAMES = ["u", "v", "w"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.integers(0, 9, 900), rng.integers(0, 7, 900), rng.integers(0, 20, 900)]).astype(float)
    y = np.sin(x[:, 0]) * x[:, 1] + (x[:, 2] > 11) * x[:, 0] + rng.normal(scale=0.3, size=900)
    df = spark.createDataFrame(pd.DataFrame(x, columns=NAMES).assign(y=y, fold=np.arange(900) // 300)).coalesce(2)
    return M.vectors(df, NAMES, "y", None, ["fold"])


def predictions(model, df):
    return [r[0] for r in model.transform(df).select("prediction").collect()]


def test_stages_are_those_of_spark(vectors):
    params = {"n_estimators": 8, "max_depth": 3, "learning_rate": 0.2}
    own = M.fit(M.candidate("Gradient Boosting", **params), vectors, NAMES, "y").stages[-1]
    theirs = M.fit_gbt(vectors, NAMES, "y", **params).stages[-1]
    assert own.treeWeights == list(theirs.treeWeights) and own.getNumTrees == 8
    assert np.allclose(predictions(own, vectors), predictions(theirs, vectors), atol=1e-8)


def test_a_fit_takes_few_jobs(spark, vectors):
    spark.sparkContext.setJobGroup("stages", "stages")
    M.fit(M.candidate("Sampled Gradient Boosting", n_estimators=60), vectors, NAMES, "y")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("stages")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) < 30


def test_larger_tables_are_fitted_by_passes(vectors, monkeypatch):
    monkeypatch.setattr(Bo, "TASK_CELLS", 100)
    c = M.candidate("Gradient Boosting", n_estimators=2, max_depth=2)
    assert type(M.fit(c, vectors, NAMES, "y").stages[-1]).__name__ == "GBTRegressionModel"
    assert M._folds_in_tasks(vectors, "y", {0: (F.col("fold") != 0, F.col("fold") == 0)}) is None


@pytest.mark.parametrize("name, grid", [
    ("Random Forest", {"n_estimators": [3, 5], "max_depth": [None, 2], "min_samples_split": [2, 6], "max_features": ["sqrt", "log2"]}),
    ("Sampled Gradient Boosting", {"n_estimators": [2, 4], "max_depth": [3], "subsample": [0.7], "colsample": [0.5]}),
])
def test_points_in_tasks_equal_single_fits(vectors, name, grid):
    c = M.candidate(name)
    c = M.Candidate(name, c.build, c.params, grid)
    found = {r["params"]: r["mean_rmse"] for r in M.random_search(c, vectors, NAMES, "y")[2].collect()}
    points = M.sampled_points(grid)
    assert len(found) == len(points)
    for point in (points[0], points[-1]):
        own = M.Candidate(name, c.build, {**c.params, **point})
        single = [M.score(M.fit(own, vectors.where(F.col("fold") != k), NAMES, "y"), vectors.where(F.col("fold") == k), "y").first()["rmse"] for k in range(3)]
        assert found[str(point)] == pytest.approx(np.mean(single), abs=1e-9)


def test_a_large_forest_is_scored_in_parts(vectors, tmp_path, monkeypatch):
    model = M.fit_random_forest(vectors, NAMES, "y", n_estimators=9).stages[-1]
    whole = predictions(model, vectors)
    monkeypatch.setattr(Fo, "NODES_AT_ONCE", model.totalNumNodes // 12)
    monkeypatch.setattr(Fo, "ROWS_AT_ONCE", 400)
    monkeypatch.setattr(Fo.StoredTrees, "read", lambda *_: pytest.fail("trees came to the driver"))
    model.write().save(str(tmp_path / "forest"))
    again = Fo.ForestModel.load(str(tmp_path / "forest"))
    for m in (model, again):
        assert np.allclose(sorted(predictions(m, vectors)), sorted(whole), atol=1e-12) and m.transform(vectors).columns == [*vectors.columns, "prediction"]


def test_forests_saved_before_are_read(spark, vectors, tmp_path):
    model = M.fit(M.candidate("Random Forest", n_estimators=3, max_depth=4), vectors, NAMES, "y")
    path = str(tmp_path / "model")
    model.write().save(path)
    trees = [(t, *(bytearray(tree[name].astype(kind).tobytes()) for name, kind in Fo._KINDS.items())) for t, tree in enumerate(model.stages[-1].trees)]
    old = spark.createDataFrame(trees, "tree int, " + ", ".join(f"{name} binary" for name in Fo._KINDS))
    old.write.mode("overwrite").parquet(next(str(p) for p in (tmp_path / "model" / "stages").glob("*/trees")))
    assert predictions(PipelineModel.load(path).stages[-1], vectors) == predictions(model.stages[-1], vectors)


def test_odd_tables(spark, vectors):
    one = vectors.limit(1).withColumn("y", F.lit(4.0))
    assert predictions(M.fit(M.candidate("Gradient Boosting", n_estimators=3), one, NAMES, "y").stages[-1], one) == [4.0]
    with pytest.raises(ValueError, match="no rows"):
        M.fit(M.candidate("Gradient Boosting"), vectors.where("fold = 7"), NAMES, "y")
    with pytest.raises(Exception, match="a label is unknown"):
        M.fit(M.candidate("Gradient Boosting"), vectors.withColumn("y", F.lit(None).cast("double")), NAMES, "y")
