import math

import numpy as np
import pandas as pd
import pytest
from helpers import frame, series
from pyspark.sql import functions as F

from aqspark.operators import attribution as A, evaluate as E, ml as M
from aqspark.plans import pipelines as P
from aqspark.sources import registry as R, store as St
from aqspark.spec import ObsSpec

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3)) * [1, 5, 0.2] + [0, 3, -1]
    y = x @ [2.0, -0.3, 4.0] + 7 + rng.normal(size=400) * 0.1
    pdf = pd.DataFrame(x, columns=FEATURES).assign(y=y, id=range(400))
    return spark.createDataFrame(pdf).persist(), x, y


def test_ridge_is_the_textbook_ridge(data):
    df, x, y = data
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (0.01, 10.0, 1000.0):
        w = M.fit_ridge(df, FEATURES, "y", alpha=alpha).stages[-1].coefficients.toArray()
        assert np.allclose(w, np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc), atol=1e-9)


def test_metrics_and_leaderboard(spark, data):
    df, x, y = data
    model = M.fit_linear(df, FEATURES, "y")
    got = M.score(model, df, "y").first()
    p = np.array([r["prediction"] for r in model.transform(df).orderBy("id").collect()])
    assert got["mae"] == pytest.approx(np.abs(y - p).mean()) and got["rmse"] == pytest.approx(np.sqrt(((y - p) ** 2).mean()))
    assert got["r2"] == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    board = spark.createDataFrame([("x", 2.0, 1.0), ("y", 1.0, 5.0), ("z", 1.0, 4.0)], "model_name string, rmse double, mae double")
    assert [r["model_name"] for r in E.leaderboard(board).collect()] == ["z", "y", "x"] and E.best_model(board).first()["model_name"] == "z"


def test_attributions(data):
    df, x, y = data
    model = M.fit_linear(df, FEATURES, "y")
    w = dict(zip(FEATURES, model.stages[-1].coefficients.toArray()))
    exact = A.linear_attribution(df, w, ["id"]).toPandas().set_index(["id", "feature"])["attribution"]
    sampled = A.sampled_attribution(df.where("id < 20"), model, FEATURES, ["id"], 2, df).toPandas().set_index(["id", "feature"])["attribution"]
    assert np.allclose(sampled, exact.loc[sampled.index], atol=1e-9)
    # for any model the parts add up to the difference from the background prediction
    trees = M.fit_random_forest(df, FEATURES, "y", n_estimators=5, max_depth=4)
    parts = A.sampled_attribution(df.where("id < 20"), trees, FEATURES, ["id"], 6, df).groupBy("id").agg(F.sum("attribution").alias("s"))
    base = trees.transform(df.agg(*[F.avg(c).alias(c) for c in FEATURES])).first()["prediction"]
    for r in parts.join(trees.transform(df), "id").collect():
        assert r["s"] == pytest.approx(r["prediction"] - base, abs=1e-9)
    assert E.mean_abs_importance(A.linear_attribution(df, w, ["id"]), 2).count() == 2


@pytest.mark.parametrize("name, params", [("Random Forest", {"n_estimators": 7, "max_depth": 6}), ("Gradient Boosting", {"n_estimators": 6, "max_depth": 4, "learning_rate": 0.4})])
def test_tree_attribution_is_the_mean_over_all_orders(spark, name, params):
    rng = np.random.default_rng(2)
    names = list("uvwxyz")
    x = np.round(rng.normal(size=(300, 6)), 1)
    y = x[:, 0] * x[:, 1] + np.where(x[:, 2] > 0, 3 * x[:, 3], x[:, 4]) + x[:, 5]
    df = spark.createDataFrame(pd.DataFrame(x, columns=names).assign(target=y, id=range(300)))
    model = M.fit(M.candidate(name, **params), df, names, "target")
    few, mean = x[:8], x.mean(axis=0)
    # predictions of all mixtures of each row with the mean row
    sets = [[(s >> j) & 1 for j in range(6)] for s in range(64)]
    mixed = [(i, s, *map(float, np.where(sets[s], few[i], mean))) for i in range(len(few)) for s in range(64)]
    p = {(r["i"], r["s"]): r["prediction"] for r in model.transform(spark.createDataFrame(mixed, ["i", "s", *names])).collect()}
    weight = [math.factorial(k) * math.factorial(5 - k) / math.factorial(6) for k in range(6)]
    expected = {(i, names[j]): sum(weight[sum(sets[s])] * (p[i, s | 1 << j] - p[i, s]) for s in range(64) if not sets[s][j]) for i in range(len(few)) for j in range(6)}
    for chunk in (200_000, 20):
        got = {(r["id"], r["feature"]): r["attribution"] for r in A.tree_attribution(df.where("id < 8"), model, names, ["id"], df, chunk).collect()}
        assert got.keys() == expected.keys() and all(got[k] == pytest.approx(expected[k], abs=1e-9) for k in got)


def test_search_grids():
    small = M.sampled_points({"alpha": [1, 2]})
    assert small == [{"alpha": 1}, {"alpha": 2}]
    grid = M.candidate("Gradient Boosting").grid
    points = M.sampled_points(grid, 20)
    assert len(points) == 20 == len({str(p) for p in points}) and points == M.sampled_points(grid, 20)


def test_search_picks_the_lowest_error(spark, data):
    df, _, _ = data
    best, _, table = M.random_search(M.candidate("Ridge Regression"), df.withColumn("fold", (F.col("id") / 134).cast("int")), FEATURES, "y")
    rows = table.collect()
    assert len(rows) == 5 and best.params["alpha"] == 0.01 == eval(min(rows, key=lambda r: r["mean_rmse"])["params"])["alpha"]


@pytest.mark.parametrize("name, params", [("Linear Regression", {}), ("Ridge Regression", {"alpha": 25.0})])
def test_one_pass_equals_single_fits(spark, data, name, params):
    df, _, _ = data
    c = M.candidate(name, **params)
    marks = [(F.col("id") < 100 * (k + 1), F.col("id") < 100 * (k + 2), k) for k in range(3)]
    folded = [df.where(upto).select("*", F.lit(k).alias("fold"), F.when(first, "train").otherwise("test").alias("role")) for first, upto, k in marks]
    whole = folded[0].union(folded[1]).union(folded[2])
    got = {r["fold"]: r["rmse"] for r in M.cross_validate(c, whole, FEATURES, "y").collect()}
    for k, part in enumerate(folded):
        model = M.fit(c, part.where("role = 'train'"), FEATURES, "y")
        assert got[k] == pytest.approx(M.score(model, part.where("role = 'test'"), "y").first()["rmse"], abs=1e-8)
    thirds = df.withColumn("fold", (F.col("id") / 134).cast("int"))
    if c.grid:
        for r in M.random_search(c, thirds, FEATURES, "y")[2].collect():
            own = M.candidate(name, **eval(r["params"]))
            single = [M.score(M.fit(own, thirds.where(F.col("fold") != k), FEATURES, "y"), thirds.where(F.col("fold") == k), "y").first()["rmse"] for k in range(3)]
            assert r["mean_rmse"] == pytest.approx(np.mean(single), abs=1e-8)


def test_dependent_columns_are_solved(spark, data):
    df, _, _ = data
    twice = df.withColumn("d", F.col("a") * 2).withColumn("fold", (F.col("id") / 134).cast("int"))
    m = M.moments(M.vectors(twice, [*FEATURES, "d"], "y"), "y", [])[()]
    own = M.moments(M.vectors(twice, FEATURES, "y"), "y", [])[()]
    assert M.rmse_of(m, M.solve(m, 0.0)) == pytest.approx(M.rmse_of(own, M.solve(own, 0.0)), abs=1e-8)


def test_shorter_boosting_runs_are_read_from_the_longest(spark, data):
    df, _, _ = data
    # samples of rows depend on how the table is cut into tasks, so all fits read the same vectors
    thirds = M.vectors(df.withColumn("fold", (F.col("id") / 134).cast("int")), FEATURES, "y", None, ["fold"])
    c = M.candidate("Gradient Boosting", max_depth=2, learning_rate=0.3)
    c = M.Candidate(c.name, c.build, c.params, {"n_estimators": [2, 4, 6], "subsample": [0.7, 1.0]})
    best, model, table = M.random_search(c, thirds, FEATURES, "y")
    rows = {r["params"]: r["mean_rmse"] for r in table.collect()}
    assert len(rows) == 6 and model.stages[-1].getNumTrees == best.params["n_estimators"]
    for params in ({"n_estimators": 2, "subsample": 0.7}, {"n_estimators": 4, "subsample": 1.0}):
        own = M.Candidate(c.name, c.build, {**c.params, **params})
        single = [M.score(M.fit(own, thirds.where(F.col("fold") != k), FEATURES, "y"), thirds.where(F.col("fold") == k), "y").first()["rmse"] for k in range(3)]
        assert rows[str(params)] == pytest.approx(np.mean(single), abs=1e-9)


def test_default_forest_is_fitted(spark, data):
    df, _, y = data
    model = M.fit_random_forest(df, FEATURES, "y")
    assert len(model.stages[-1].trees) == 120 and M.score(model, df, "y").first()["rmse"] < 0.3 * y.std()


def test_train_and_forecast_round_trip(spark, tmp_path):
    pdf = series(1, (("a", 400), ("b", 150)))
    pdf["seq"] = range(len(pdf))
    spec = ObsSpec(seq="seq")
    prepared = P.preprocess_job(frame(spark, pdf), spec, hours=4, processed_path=str(tmp_path / "processed"))
    models = [M.candidate("Linear Regression"), M.candidate("Ridge Regression"), M.candidate("Gradient Boosting", n_estimators=3, max_depth=3)]
    trained = P.train_job(prepared, models, max_cv_rows=500, registry=str(tmp_path / "registry"), trained_at="2025-01-01")
    rows = trained.results.collect()
    assert [r["rmse"] for r in rows] == sorted(r["rmse"] for r in rows) and len(rows) == 3
    model, best = R.registry_load(spark, str(tmp_path / "registry"))
    meta = best.first()
    assert R.next_version(spark, str(tmp_path / "registry")) == 2 and meta["version"] == 1
    assert meta["model_name"] == rows[0]["model_name"] and meta["feature_count"] == len(prepared.features)
    now = pdf.groupby("city").tail(1).assign(timestamp=lambda d: d.timestamp + pd.Timedelta(hours=1)).drop(columns="seq")
    hourly, daily = P.forecast_job(frame(spark, pdf), frame(spark, now), model, list(meta["feature_names"]), spec, "2025-02-01")
    assert hourly.count() == 144 and daily.count() == 6
    assert hourly.where("predicted < 0 OR predicted > 500 OR predicted IS NULL").count() == 0
    nobody = now.head(1).assign(city="nowhere", aqi=np.nan, timestamp=pd.NaT)
    documents, missing = P.forecast_documents_job(frame(spark, pdf), frame(spark, pd.concat([now, nobody])), str(tmp_path / "registry"), spec, "2025-02-01", top=4)
    docs = {r["city"]: r for r in documents.collect()}
    assert set(docs) == {"a", "b"} and [r[0] for r in missing.collect()] == ["nowhere"]
    tops = docs["a"]["top_features"]
    assert len(tops) == 4 and [t["importance"] for t in tops] == sorted((t["importance"] for t in tops), reverse=True)
    St.write_processed(frame(spark, pdf.assign(city=pdf.city.str.upper())), str(tmp_path / "table"), spec)
    again = P.train_from_table_job(spark, [str(tmp_path / "none"), str(tmp_path / "table")], str(tmp_path / "second"), spec, "2025-01-20", 90, models[:2], hours=3)
    assert again.results.count() == 2 and R.registry_versions(spark, str(tmp_path / "second")).count() == 1
