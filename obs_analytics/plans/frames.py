"""The shared frames of the job, built from a source of raw observations.

``Frames`` builds plans only: raw -> cleaned observations -> features with
the trailing mean -> model rows -> keyed split. Nothing is pinned: a job of
many queries lands its observations first, so that each reads a pruned scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.cleaning import model_rows, prepare_observations
from ..operators.sampling import hash_split
from ..operators.windows import trailing_mean


@dataclass
class Frames:
    raw: DataFrame
    window_strategy: str = "blocked"

    @property
    def obs(self) -> DataFrame:
        """Cleaned, featured and imputed rows, without the trailing mean."""
        return prepare_observations(self.raw)

    @property
    def features(self) -> DataFrame:
        """obs plus TAVG_30DAY_AVG per station."""
        return trailing_mean(self.obs, "TAVG", "DATE", by=["STATION"], strategy=self.window_strategy)

    @property
    def model_rows(self) -> DataFrame:
        return model_rows(self.features)

    @property
    def split(self) -> DataFrame:
        return hash_split(self.model_rows)

    @property
    def train(self) -> DataFrame:
        return self.split.filter(F.col("IS_TRAIN")).drop("IS_TRAIN")

    @property
    def test(self) -> DataFrame:
        return self.split.filter(~F.col("IS_TRAIN")).drop("IS_TRAIN")
