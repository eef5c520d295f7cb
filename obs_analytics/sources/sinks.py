"""S3: deliver a result. Functions return DataFrames; writing is the
caller's choice, and this is the one place that writes."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_result(df: DataFrame, path: str, *, fmt: str = "parquet",
                 mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    """Write ``df``; an existing result is left alone unless ``mode`` says otherwise."""
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)
