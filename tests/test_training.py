"""The rows that the models are fitted on: the stored split, no stored node ids."""

import os
import threading
import time

import pytest

from obs_analytics.operators import modeling
from obs_analytics.plans import registry, training
from obs_analytics.plans.frames import Frames
from obs_analytics.schema import FEATURES, KEY_COLUMNS, LABEL, MODEL_NAMES, RAW_SCHEMA


def _rows(spark, n=400):
    import datetime as dt

    first = dt.date(1999, 1, 1)
    made = [(f"ST{i % 7}", first + dt.timedelta(days=i // 7), 10.0 + i % 7, 20.0, 100.0, "name", float(i % 5), "a", 300.0 + i * 37 % 90, "b",
             100.0 + i * 11 % 70, "c", 200.0 + i * 53 % 80, "d") for i in range(n)]
    return Frames(spark.createDataFrame(made, RAW_SCHEMA))


def test_split_is_stored_as_the_models_columns(spark):
    frames = _rows(spark)
    models = training.TrainedModels(frames, partitions=4)
    columns = [*KEY_COLUMNS, *FEATURES, LABEL]
    for side, plain in ((True, frames.train), (False, frames.test)):
        assert models._side(side).columns == columns
        assert sorted(map(tuple, models._side(side).collect()), key=str) == sorted(map(tuple, plain.select(columns).collect()), key=str)
    assert "FileScan parquet" in models.test._jdf.queryExecution().executedPlan().toString()


def test_forest_checkpoints_no_node_ids(spark, tmp_path):
    models = training.TrainedModels(_rows(spark), partitions=4)
    models._training()
    context, before = spark.sparkContext, spark.sparkContext.getCheckpointDir()
    context.setCheckpointDir(str(tmp_path))
    # a file in the folder's place: whatever is checkpointed fails
    folder = context.getCheckpointDir().removeprefix("file:")
    os.rmdir(folder)
    open(folder, "w").close()
    scaled = models.feature_model.transform(models._training()).select("scaledFeatures", LABEL)
    try:
        # a pass per level and group of nodes: more than ten passes
        modeling.regressor(MODEL_NAMES[1], memory_mb=1).fit(scaled)
    finally:
        context._jsc.sc().setCheckpointDir(before)


def test_checks_read_the_stored_split(spark, monkeypatch):
    """The mean and the linear model's residuals come from it, not from a second
    run over the trailing mean."""
    models = training.TrainedModels(_rows(spark), partitions=4)
    base, names = models.train.agg({LABEL: "avg"}).first()[0], MODEL_NAMES[:1]
    models.models(names), models.test.count()
    monkeypatch.setattr(registry, "trained", lambda *_: models)
    monkeypatch.setattr(models, "scored", lambda: modeling.score(models.models(names), models.test))
    monkeypatch.setattr(models, "frames", None)  # whatever reads the frames again fails
    monkeypatch.setattr(training.TrainedModels, "_spark", spark)
    row = registry.REGISTRY["models_beat_mean"].build(spark, "").first()
    tavg = [r[LABEL] for r in models.test.select(LABEL).collect()]
    assert row.N_ROWS == len(tavg)
    assert row.BASE_RMSE == pytest.approx((sum((x - base) ** 2 for x in tavg) / len(tavg)) ** 0.5)
    assert registry.REGISTRY["linear_optimality"].build(spark, "").count() == len(FEATURES)


def test_missing_models_are_fitted_at_the_same_time(spark, monkeypatch):
    frames = _rows(spark)
    alone = training.TrainedModels(frames, partitions=4)
    alone = {n: alone.model(n) for n in MODEL_NAMES[:2]}
    both, make = threading.Barrier(2, timeout=120), modeling.regressor

    def regressor(*args, **kwargs):
        both.wait()  # passed only while the other fit is under way
        return make(*args, **kwargs)

    monkeypatch.setattr(training, "regressor", regressor)
    models = training.TrainedModels(frames, partitions=4)
    found = models.models(MODEL_NAMES[:2])
    assert models.fitted == [training.FEATURE_STAGES, *MODEL_NAMES[:2]]
    assert models.models(MODEL_NAMES[:2]) == found
    linear, forest = (lambda m: m[MODEL_NAMES[0]].stages[-1]), (lambda m: m[MODEL_NAMES[1]].stages[-1])
    assert list(linear(found).coefficients) == pytest.approx(list(linear(alone).coefficients))
    assert forest(found).totalNumNodes == forest(alone).totalNumNodes
    assert list(forest(found).featureImportances.toArray()) == pytest.approx(list(forest(alone).featureImportances.toArray()))


def test_forest_caches_its_points_alone(spark):
    models = training.TrainedModels(_rows(spark), partitions=4)
    scaled = models.feature_model.transform(models._training()).select("scaledFeatures", LABEL)
    kept = spark.sparkContext._jsc.getPersistentRDDs
    before, seen, ended = set(kept()), [], threading.Event()

    def watch():
        while not ended.wait(0.01):
            seen.append(len(set(kept()) - before))

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        # a pass per level and group of nodes: more than ten passes
        modeling.regressor(MODEL_NAMES[1], memory_mb=1).fit(scaled)
    finally:
        ended.set()
        watcher.join()
    assert max(seen) == 1


def test_tree_learners_follow_one_another(spark, monkeypatch):
    make, under_way, met = modeling.regressor, [], []

    class Linear:
        def __init__(self, name):
            self.name = name

        def fit(self, rows):
            met.extend((self.name, other) for other in under_way)
            under_way.append(self.name)
            time.sleep(0.5)
            try:
                return make(MODEL_NAMES[0]).fit(rows)
            finally:
                under_way.remove(self.name)

    monkeypatch.setattr(training, "regressor", lambda name, *_: Linear(name))
    models = training.TrainedModels(_rows(spark), partitions=4)
    assert list(models.models()) == MODEL_NAMES
    assert models.fitted == [training.FEATURE_STAGES, *MODEL_NAMES]
    assert not {tuple(sorted(pair)) for pair in met} & {tuple(sorted(MODEL_NAMES[1:]))}
