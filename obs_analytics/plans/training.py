"""Fitted models shared by the model, forecast and report queries.

Fitting is the one place where Spark acts while a plan is built (Spark ML
runs its jobs inside ``fit``). The keyed split, cut to the models' columns, is
written once as Parquet to the shared checkpoint folder and both its sides are
read from there, so the trailing mean is computed once and a lost executor
costs a re-read. With a ``store`` every
fitted stage is saved under a fingerprint of the training rows and settings:
a driver that is started again, or a later run on the same data, loads what is
finished and fits the rest.
"""

from __future__ import annotations

import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.modeling import (BOOSTED_EXECUTION, FOREST_EXECUTION, fit_feature_stages, regressor, score,
                                  training_frame)
from ..schema import (FEATURES, GBT_PARAMS, KEY_COLUMNS, LABEL, LR_PARAMS, MODEL_NAMES, RF_PARAMS,
                      TRAINING_PARTITIONS, TREE_MEMORY_MB)
from ..session import stored
from .frames import Frames

FEATURE_STAGES = "feature stages"
TREE_LEARNERS = MODEL_NAMES[1:]  # each caches the training rows while it is fitted


class ModelStore:
    """Saved pipelines below one folder, one per fingerprint and name. A saved
    model counts once its marker is written, so a half-written one is fitted
    and written again."""

    def __init__(self, folder: str, fingerprint: str):
        self.path = f"{folder.rstrip('/')}/{fingerprint}"

    def _at(self, name: str) -> str:
        return f"{self.path}/{name.lower().replace(' ', '-')}"

    def load(self, spark, name: str) -> PipelineModel | None:
        try:
            spark.read.parquet(f"{self._at(name)}/finished").count()
        except AnalysisException:  # no such folder
            return None
        return PipelineModel.load(f"{self._at(name)}/model")

    def save(self, spark, name: str, model: PipelineModel) -> None:
        model.write().overwrite().save(f"{self._at(name)}/model")
        spark.range(1).write.mode("overwrite").parquet(f"{self._at(name)}/finished")


def fingerprint(train: DataFrame, **settings) -> str:
    """Hash of the training rows, in any order and layout, and of the settings."""
    row = F.xxhash64(*KEY_COLUMNS, *FEATURES, LABEL)
    found = train.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"), F.sum(F.pmod(row, F.lit(1 << 31))).alias("s")).first()
    told = json.dumps([found.n, found.x, found.s, settings], sort_keys=True, default=str)
    return hashlib.sha256(told.encode()).hexdigest()[:32]


class TrainedModels:
    """Lazily fitted feature stages and regressors over one ``Frames``.

    ``partitions`` and ``memory_mb`` are model settings of the tree learners
    (``training_frame``, ``regressor``); ``checkpoint=False`` leaves the split
    and the training frame as plans. ``fitted`` lists what this object fitted."""

    def __init__(self, frames: Frames, partitions: int = TRAINING_PARTITIONS, checkpoint: bool = True,
                 memory_mb: int = TREE_MEMORY_MB, store: str | None = None):
        self.frames, self.partitions, self.checkpoint, self.memory_mb, self.folder = frames, partitions, checkpoint, memory_mb, store
        self.fitted: list[str] = []
        self._split: DataFrame | None = None
        self._frame: DataFrame | None = None
        self._store: ModelStore | None = None
        self._models: dict[str, PipelineModel] = {}

    @property
    def _spark(self):
        return self.frames.raw.sparkSession

    def _side(self, train: bool) -> DataFrame:
        if self._split is None:
            # only these columns pass the shuffles of the trailing mean
            self._split = self.frames.split.select(*KEY_COLUMNS, *FEATURES, LABEL, "IS_TRAIN")
            if self.checkpoint:
                self._split = stored(self._split, "split")
        return self._split.filter(F.col("IS_TRAIN") if train else ~F.col("IS_TRAIN")).drop("IS_TRAIN")

    def _training(self) -> DataFrame:
        if self._frame is None:
            self._frame = training_frame(self._side(True), FEATURES, LABEL, self.partitions, self.checkpoint)
        return self._frame

    def _found(self, name: str) -> PipelineModel | None:
        """The model of this name from memory or from the store."""
        if name not in self._models:
            if self.folder and self._store is None:
                self._store = ModelStore(self.folder, fingerprint(
                    self._side(True), partitions=self.partitions, memory_mb=self.memory_mb, linear=LR_PARAMS,
                    forest=[RF_PARAMS, FOREST_EXECUTION], boosted=[GBT_PARAMS, BOOSTED_EXECUTION]))
            found = self._store.load(self._spark, name) if self._store else None
            if found is None:
                return None
            self._models[name] = found
        return self._models[name]

    def _kept(self, name: str, fit) -> PipelineModel:
        """The model that ``fit`` makes, in memory and in the store."""
        self._models[name] = fit()
        if self._store:
            self._store.save(self._spark, name, self._models[name])
        return self._models[name]

    @property
    def feature_model(self) -> PipelineModel:
        found = self._found(FEATURE_STAGES)
        if found is None:
            found = self._kept(FEATURE_STAGES, lambda: fit_feature_stages(self._training(), FEATURES))
            self.fitted.append(FEATURE_STAGES)
        return found

    def _fit(self, name: str) -> PipelineModel:
        prep = self.feature_model
        scaled = prep.transform(self._training()).select("scaledFeatures", LABEL)
        return PipelineModel(stages=[*prep.stages, regressor(name, LABEL, self.memory_mb).fit(scaled)])

    def _fit_all(self, names) -> None:
        for n in names:
            self._kept(n, partial(self._fit, n))

    def model(self, name: str) -> PipelineModel:
        return self.models([name])[name]

    def models(self, names=MODEL_NAMES) -> dict[str, PipelineModel]:
        """These models; the linear one is fitted beside the tree learners, which follow
        one another: each caches all training rows, and two such caches at a time do not
        fit the executors' memory and go to their disks. Each fit draws by its own seed."""
        missing = [n for n in names if self._found(n) is None]
        if missing:
            self.feature_model, self._training()  # made once, before the fits share them
            lanes = [[n for n in missing if (n in TREE_LEARNERS) == trees] for trees in (False, True)]
            target = inheritable_thread_target(self._spark)
            with ThreadPoolExecutor(len(lanes)) as pool:
                waiting = [pool.submit(target(self._fit_all), lane) for lane in lanes]
            for w in waiting:
                w.result()
            self.fitted += missing
        return {n: self._models[n] for n in names}

    @property
    def train(self) -> DataFrame:
        return self._side(True)

    @property
    def test(self) -> DataFrame:
        return self._side(False)

    def scored(self, names=MODEL_NAMES) -> DataFrame:
        return score(self.models(names), self.test)

    def release(self) -> None:
        """Forget the fitted models and the split (a store keeps its models)."""
        self._models.clear()
        self._split = self._frame = self._store = None
