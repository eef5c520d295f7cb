"""Streaming source and running roll-ups of observation files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import prepare_observations
from ..schema import RAW_SCHEMA


def observation_stream(spark: SparkSession, path: str, *, fmt: str = "csv",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Cleaned observations from files landing in ``path`` (CSV with the
    declared header, or Parquet with the raw columns)."""
    reader = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = (reader.option("header", "true").option("ignoreLeadingWhiteSpace", "true")
                  .option("ignoreTrailingWhiteSpace", "true").option("enforceSchema", "false"))
    return prepare_observations(reader.format(fmt).load(path))


def streaming_rollups(obs: DataFrame, key: str = "YEAR") -> DataFrame:
    """Running mean TAVG, max TMAX, total PRCP and row count per ``key``.

    State holds one row per key value (years, months, seasons: a bounded
    set), so complete output mode is cheap.
    """
    return obs.groupBy(key).agg(
        F.count(F.lit(1)).alias("N_ROWS"), F.avg("TAVG").alias("AVG_TAVG"),
        F.max("TMAX").alias("MAX_TMAX"), F.sum("PRCP").alias("SUM_PRCP"))


def start_rollups(rollup: DataFrame, checkpoint: str, *, sink: str, name: str = "obs_rollups",
                  path: str | None = None, trigger_seconds: int | None = None) -> StreamingQuery:
    """Start the roll-up query. ``checkpoint`` must be a shared folder on a
    cluster: the state and the source offsets live there, which is what
    lets the query resume after a lost executor or driver.

    ``parquet`` writes each complete result to a folder of its own below
    ``path`` (EPOCH=n), so a reader always finds a whole one
    (``latest_rollup``) and a repeated batch replaces only itself. ``memory``
    keeps the result on the driver, for tests and small looks."""
    if sink not in ("parquet", "memory"):
        raise ValueError(f"unknown sink {sink!r}")
    if sink == "parquet" and not path:
        raise ValueError("the parquet sink needs a path")
    w = rollup.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    if sink == "memory":
        return w.format("memory").queryName(name).start()

    def write_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/EPOCH={epoch}")
    return w.foreachBatch(write_batch).start()


def latest_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete result of the parquet sink."""
    every = spark.read.parquet(path)
    return every.where(F.col("EPOCH") == every.agg(F.max("EPOCH")).scalar()).drop("EPOCH")
