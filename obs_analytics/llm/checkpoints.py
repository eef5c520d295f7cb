"""Reliable cuts of lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir`` (or set on the context).
    Where neither is set and the master is local, as in tests, a temporary
    folder is named; on a cluster that is an error."""
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="checkpoint-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(frame: DataFrame) -> DataFrame:
    """The frame written to the shared folder; later reads start from there."""
    spark = frame.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return frame.checkpoint()


def table(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder (columns can be pruned
    and filters pushed when it is read)."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    made = spark.read.schema(frame.schema).parquet(path)
    made.stored_at = path
    return made


def drop(frame: DataFrame) -> None:
    """Delete the files of a ``table`` that no later plan reads."""
    spark = frame.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(frame.stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
