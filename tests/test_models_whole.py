"""The registered model queries do the whole job: all horizons, all candidates, the default parameters."""

import __spark_entry__ as entry
from aqspark import spec as S
from aqspark.operators import ml as M
from aqspark.plans import pipelines as P
from test_queries import DIR


def test_training_frame_has_all_horizons(spark):
    frame = entry._training_frame(spark, DIR)
    assert {r[0] for r in frame.select("timestamp_offset").distinct().collect()} == set(range(1, S.HORIZON + 1))


def test_jobs_fit_on_all_horizons(spark, monkeypatch):
    seen = []

    def fitted(train, *args, **kwargs):
        seen.append(train.agg({"timestamp_offset": "max"}).first()[0])
        return None

    def prepared(raw, spec, entities=None, hours=S.HORIZON, **kwargs):
        seen.append(hours)
        raise StopIteration

    monkeypatch.setattr(M, "fit_linear", fitted)
    monkeypatch.setattr(P, "forecast_job", lambda *args, **kwargs: (None, None))
    monkeypatch.setattr(P, "preprocess_job", prepared)
    entry.queries()["forecast_job"](spark, DIR)
    try:
        entry.queries()["train_job"](spark, DIR)
    except StopIteration:
        pass
    assert seen == [S.HORIZON, S.HORIZON]


def test_candidates_have_their_default_parameters(spark, monkeypatch):
    """A linear model stands in for each fit; what was asked for is noted."""
    asked, real = [], M.fit

    def noted(c, train, features, label=M.LABEL, scaler=None):
        asked.append((c.name, tuple(sorted(c.params.items(), key=str))))
        return real(M.candidate("Linear Regression"), train, features, label, scaler)

    monkeypatch.setattr(M, "fit", noted)
    whole = {c.name: tuple(sorted(c.params.items(), key=str)) for c in M.candidates()}
    for name, expected in (("fit_random_forest", {"Random Forest"}), ("fit_gbt", {"Gradient Boosting"}), ("train_compare", set(whole))):
        asked.clear()
        entry.queries()[name](spark, DIR)
        assert set(asked) == {(n, whole[n]) for n in expected}


def test_random_search_and_train_job_take_all_candidates(spark, monkeypatch):
    seen = []

    def searched(c, *args, **kwargs):
        seen.append(c)
        return c, None, spark.createDataFrame([(0, "", 0.0)], "point int, params string, mean_rmse double")

    def compared(train, test, folded, features, models, **kwargs):
        seen.extend(models)
        raise StopIteration

    monkeypatch.setattr(M, "random_search", searched)
    assert entry.queries()["random_search"](spark, DIR).count() == sum(c.grid is not None for c in M.candidates())
    assert seen == [c for c in M.candidates() if c.grid]
    seen.clear()
    monkeypatch.setattr(M, "train_compare", compared)
    try:
        entry.queries()["train_job"](spark, DIR)
    except StopIteration:
        pass
    assert seen == M.candidates()
