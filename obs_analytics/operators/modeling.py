"""Spark ML feature stages, the three regressors, fitting
and scoring.

The feature stages (assembler + standard scaler) are fitted once and
shared by the three models; the scaled training frame is written to the
checkpoint directory first, so the many passes of the tree learners read
a short, reliable lineage that survives the loss of an executor.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from ..schema import (FEATURES, GBT_PARAMS, KEY_COLUMNS, LABEL, LR_PARAMS, MODEL_NAMES,
                      RF_PARAMS, TRAINING_PARTITIONS, TREE_MEMORY_MB)
from .metrics import MODEL


def feature_stages(features=FEATURES) -> list:
    """M1 + M2: assemble the features and standardise to mean 0, sd 1."""
    return [VectorAssembler(inputCols=list(features), outputCol="features"),
            StandardScaler(inputCol="features", outputCol="scaledFeatures",
                           withMean=True, withStd=True)]


# Neither tree learner caches node ids. The forest's would be 400 bytes a row and
# Spark keeps several rounds of them, more than the training points, so on large
# tables they fill the executors' disks; without them each pass walks the trees
# from the root: more CPU, the same trees, and nothing to checkpoint. The
# boosted trees are shallow and one per round, where the cache costs more than it
# saves (59 s -> 84 s); they checkpoint their running predictions.
FOREST_EXECUTION = {"cacheNodeIds": False, "checkpointInterval": -1}
BOOSTED_EXECUTION = {"cacheNodeIds": False, "checkpointInterval": 10}


def regressor(name: str, label: str = LABEL, memory_mb: int = TREE_MEMORY_MB):
    """M3-M5: the reference's three estimators with its settings.

    ``memory_mb`` is the tree learners' budget for split statistics per task.
    It decides which nodes are split in one pass, and with that the order of
    the forest's random draws, so it is a model parameter with a fixed default
    and never follows the heap or the core count. A 100-tree, depth-10 forest
    on eight task slots needs about eight times this much heap."""
    common = {"featuresCol": "scaledFeatures", "labelCol": label, "predictionCol": "prediction"}
    if name == MODEL_NAMES[0]:
        return LinearRegression(**common, **LR_PARAMS)
    if name == MODEL_NAMES[1]:
        return RandomForestRegressor(**common, **RF_PARAMS, **FOREST_EXECUTION, maxMemoryInMB=memory_mb)
    if name == MODEL_NAMES[2]:
        return GBTRegressor(**common, **GBT_PARAMS, **BOOSTED_EXECUTION, maxMemoryInMB=memory_mb)
    raise ValueError(f"unknown model {name!r}")


def training_frame(train: DataFrame, features=FEATURES, label: str = LABEL,
                   partitions: int = TRAINING_PARTITIONS, checkpoint: bool = True) -> DataFrame:
    """Fix the training rows' layout (hash of the key, sorted inside each
    partition) so tree bagging draws the same rows on every run, and cut
    the lineage with a reliable checkpoint.

    Bagging draws by partition, so ``partitions`` is a model parameter: its
    default is a constant, and a larger training set takes a larger number
    (about 1 million rows, 100 MB, per partition) whatever the cluster.
    """
    spark = train.sparkSession
    n = partitions
    if checkpoint:
        ensure_checkpoint_dir(spark)
    laid = (train.select(*KEY_COLUMNS, *features, label)
            .repartition(n, *KEY_COLUMNS).sortWithinPartitions(*KEY_COLUMNS))
    return laid.checkpoint(eager=True) if checkpoint else laid


def fit_feature_stages(train: DataFrame, features=FEATURES) -> PipelineModel:
    return Pipeline(stages=feature_stages(features)).fit(train)


def score(models: dict[str, Transformer], df: DataFrame, label: str | None = LABEL,
          keep=KEY_COLUMNS) -> DataFrame:
    """Scored rows of every model, stacked with a MODEL column.

    The models are applied one after another to the same rows, each prediction
    kept under its own name, and the predictions are exploded at the end: the
    rows are scanned once however many models there are."""
    held = [c for c in keep if c in df.columns] + ([label] if label and label in df.columns else [])
    inputs, scored = df.columns, df
    for i, model in enumerate(models.values()):
        scored = model.transform(scored).select(*inputs, *[f"_p{k}" for k in range(i)],
                                                F.col("prediction").cast("double").alias(f"_p{i}"))
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("m"), F.col(f"_p{i}").alias("p"))
                               for i, name in enumerate(models)])).alias("_s")
    keys = [c for c in held if c != label]
    return scored.select(*held, each).select(*keys, F.col("_s.m").alias(MODEL), *[c for c in held if c == label],
                                             F.col("_s.p").alias("prediction"))


# -- stand-in predictors ------------------------------------------------------
#
# Three fixed rules used as "models" so that every metric and report
# operator can be checked against SQL before any model is trained. They are
# Spark ML transformers, so they plug in wherever a fitted model does.

STANDIN_NAMES = ["Midrange", "Trailing mean", "Monthly mean"]


def midrange_predictor() -> Transformer:
    return SQLTransformer(statement="SELECT *, (TMAX + TMIN) / 2 AS prediction FROM __THIS__")


def trailing_predictor() -> Transformer:
    return SQLTransformer(statement="SELECT *, TAVG_30DAY_AVG AS prediction FROM __THIS__")


def monthly_mean_table(train: DataFrame, label: str = LABEL) -> DataFrame:
    return train.groupBy("MONTH").agg(F.avg(label).alias("MONTH_MEAN"))


def standin_scores(test: DataFrame, train: DataFrame, label: str = LABEL,
                   keep=KEY_COLUMNS) -> DataFrame:
    """Scored test rows of the three stand-ins in ONE pass over the test rows:
    each row carries an array of (model, prediction) and is exploded."""
    # at most 12 rows (one per month): broadcasting is bounded
    months = F.broadcast(monthly_mean_table(train, label))
    j = test.join(months, "MONTH", "left")
    preds = F.array(
        F.struct(F.lit(STANDIN_NAMES[0]).alias("m"), ((F.col("TMAX") + F.col("TMIN")) / 2).alias("p")),
        F.struct(F.lit(STANDIN_NAMES[1]).alias("m"), F.col("TAVG_30DAY_AVG").alias("p")),
        F.struct(F.lit(STANDIN_NAMES[2]).alias("m"), F.col("MONTH_MEAN").alias("p")))
    return (j.select(*keep, label, F.explode(preds).alias("_s"))
            .select(*keep, F.col("_s.m").alias(MODEL), label,
                    F.col("_s.p").cast("double").alias("prediction")))
