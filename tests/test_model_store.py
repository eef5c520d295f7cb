"""R4's training settings and the store of fitted models."""

import pytest

from obs_analytics.plans import training
from obs_analytics.plans.analysis import release, run_from_files
from obs_analytics.plans.frames import Frames
from obs_analytics.schema import MODEL_NAMES
from obs_analytics.sources import raw_observations

from .conftest import SF001


@pytest.fixture
def quick(monkeypatch):
    """Every model is the linear one, so that fits are cheap."""
    real = training.regressor
    monkeypatch.setattr(training, "regressor", lambda name, label, memory: real(MODEL_NAMES[0], label, memory))


def test_second_run_fits_nothing(spark, tmp_path):
    raw_observations(spark, SF001).coalesce(1).write.option("header", "true").csv(str(tmp_path / "csv"))
    run = lambda **more: run_from_files(
        spark, str(tmp_path / "csv/*.csv"), str(tmp_path / "table"), early_end=1996, late_start=2000, names=MODEL_NAMES[:1],
        **{"partitions": 8, "memory_mb": 32, "store": str(tmp_path / "models"), **more})
    first = run()
    assert first["_models"].fitted == [MODEL_NAMES[0], training.FEATURE_STAGES] or first["_models"].fitted == [training.FEATURE_STAGES, MODEL_NAMES[0]]
    assert first["_models"]._training().rdd.getNumPartitions() == 8
    want = [tuple(r) for r in first["model_comparison"].collect()], [tuple(r) for r in first["forecast_yearly"].collect()]
    second = run()
    assert second["_models"].fitted == []
    assert ([tuple(r) for r in second["model_comparison"].collect()], [tuple(r) for r in second["forecast_yearly"].collect()]) == want
    assert run(partitions=4)["_models"].fitted  # other settings are other models
    release(second)


def test_goes_on_where_it_was_cut_off(spark, tmp_path, quick):
    store, frames = str(tmp_path / "models"), Frames(raw_observations(spark, SF001))
    cut = training.TrainedModels(frames, partitions=4, store=store)
    cut.model(MODEL_NAMES[0])
    rest = training.TrainedModels(frames, partitions=4, store=store)
    rest.scored(MODEL_NAMES)
    assert rest.fitted == list(MODEL_NAMES[1:])


def test_half_written_model_is_fitted_again(spark, tmp_path, quick, monkeypatch):
    store, frames = str(tmp_path / "models"), Frames(raw_observations(spark, SF001))
    real = training.ModelStore.save

    def stopped(self, session, name, model):
        if name == MODEL_NAMES[0]:
            model.write().overwrite().save(f"{self._at(name)}/model")
            raise KeyboardInterrupt
        real(self, session, name, model)

    monkeypatch.setattr(training.ModelStore, "save", stopped)
    with pytest.raises(KeyboardInterrupt):
        training.TrainedModels(frames, partitions=4, store=store).model(MODEL_NAMES[0])
    monkeypatch.setattr(training.ModelStore, "save", real)
    again = training.TrainedModels(frames, partitions=4, store=store)
    again.model(MODEL_NAMES[0])
    assert again.fitted == [MODEL_NAMES[0]]


def test_fingerprint_ignores_layout(spark):
    train = Frames(raw_observations(spark, SF001)).train
    one = training.fingerprint(train, a=1)
    assert training.fingerprint(train.repartition(7), a=1) == one
    assert training.fingerprint(train, a=2) != one and training.fingerprint(train.limit(100), a=1) != one
