"""Forests against a plain recursive tree, and shared passes against growth in one task."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from aqspark.operators import forest as Fo, ml as M

NAMES = ["u", "v", "w"]


def plain(x, y, w, depth, least):
    """Predictions of a tree that tries every value of every feature as a cut."""
    mean = np.average(y, weights=w)
    best, split = 1e-9, None
    for f in range(x.shape[1]) if depth else ():
        for cut in np.unique(x[:, f])[:-1]:
            side = x[:, f] <= cut
            a, b = w[side].sum(), w[~side].sum()
            if min(a, b) >= least:
                gain = a * (np.average(y[side], weights=w[side]) - mean) ** 2 + b * (np.average(y[~side], weights=w[~side]) - mean) ** 2
                if gain > best + 1e-9:
                    best, split = gain, side
    out = np.full(len(y), mean)
    if split is not None:
        for side in (split, ~split):
            out[side] = plain(x[side], y[side], w[side], depth - 1, least)
    return out


def rows(n, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 7, n), rng.normal(size=n)])
    return x, np.sin(x[:, 0]) * x[:, 1] + (x[:, 2] > 0.3) + rng.normal(scale=0.1, size=n)


@pytest.mark.parametrize("depth, least", [(100, 1), (4, 1), (100, 5), (0, 1)])
def test_grown_tree_is_the_plain_one(depth, least):
    x, y = rows(400)
    x[:, 2] = np.round(x[:, 2] * 5).clip(-8, 8) + 8
    w = np.random.default_rng(1).integers(1, 4, len(y)).astype(np.uint8)
    feature, cut, left, value = Fo.grow(x.astype(np.uint8), y, w, [12, 7, 17], depth, least, 3, np.random.default_rng(0))
    tree = {"feature": feature, "threshold": cut.astype(float), "left": left, "value": value}
    assert np.allclose(Fo._walk(tree, x), plain(x, y, w, depth, least), atol=1e-9)
    assert (left >= 0).sum() * 2 + 1 == len(left)


def frame(spark, x, y):
    return spark.createDataFrame(pd.DataFrame(x, columns=NAMES).assign(y=y)).repartition(3)


@pytest.mark.parametrize("params", [{}, {"max_depth": 5}, {"min_samples_split": 10}])
def test_shared_passes_grow_the_same_trees(spark, params, monkeypatch):
    x, y = rows(1200)
    vectors = M.vectors(frame(spark, x, y), NAMES, "y")
    c = M.candidate("Random Forest", n_estimators=4, **params)
    whole, split = (c.build(c.params, vectors, "y") for _ in range(2))
    split.task_rows = 150
    one, two = whole.fit(vectors), split.fit(vectors)
    assert one.totalNumNodes == two.totalNumNodes > 50
    monkeypatch.setattr(Fo, "CELLS", 2000)  # a few nodes a pass
    three = split.fit(vectors)
    for other in (two, three):
        both = one.transform(vectors).withColumnRenamed("prediction", "p").withColumn("id", F.monotonically_increasing_id())
        same = other.transform(vectors).withColumn("id", F.monotonically_increasing_id()).join(both, "id")
        assert same.where("abs(p - prediction) > 1e-9").count() == 0 and same.count() == 1200


def test_cuts(spark):
    x = np.column_stack([np.arange(1000) % 3, np.ones(1000), np.arange(1000)])
    values = M.vectors(frame(spark, x, x[:, 0]), NAMES, "y").select(Fo.vector_to_array("features").alias("v"))
    a, b, c = Fo.candidate_cuts(values, 3)
    assert a.tolist() == [0, 1] and b.tolist() == [] and len(c) == Fo.BINS and (np.diff(c) > 20).all() and c[0] == 0


@pytest.mark.parametrize("strategy", ["sqrt", "log2"])
def test_saved_forest_predicts_alike(spark, tmp_path, strategy):
    x, y = rows(1500, 3)
    df = frame(spark, x, y)
    model = M.fit_random_forest(df, NAMES, "y", n_estimators=30, max_features=strategy)
    assert M.score(model, df, "y").first()["rmse"] < 0.4 * y.std()
    model.write().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    p = [[r[0] for r in m.transform(df).select("prediction").collect()] for m in (model, again)]
    assert p[0] == p[1] and len(p[0]) == 1500
    assert model.transform(df.limit(0)).count() == 0


def test_odd_tables(spark):
    one = frame(spark, np.zeros((1, 3)), np.array([4.0]))
    model = M.fit_random_forest(one, NAMES, "y", n_estimators=5)
    assert model.transform(one).first()["prediction"] == 4.0
    with pytest.raises(ValueError, match="no rows"):
        M.fit_random_forest(one.limit(0), NAMES, "y")
    with pytest.raises(Exception, match="a label is unknown"):
        M.fit_random_forest(one.withColumn("y", F.lit(None).cast("double")), NAMES, "y")
