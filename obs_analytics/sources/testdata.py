"""The test-table adapter: lineitem x supplier reshaped into raw
station-day observations (the F7 adapter of FIXTURES.md).

One row per (supplier, ship day) plays one station-day. Only ``max`` is
used, so the values do not depend on summation order, and nulls are
planted in every column the cleaning and imputing steps act on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _unless(cond, value):
    return F.when(cond, F.lit(None)).otherwise(value)


def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw observations in the 14-column CSV layout, in tenths."""
    daily = (spark.read.parquet(f"{sf_dir}/lineitem.parquet")
             .groupBy(F.col("l_suppkey").alias("station_key"),
                      F.col("l_shipdate").cast("date").alias("obs_date"))
             .agg(F.max("l_quantity").alias("q"), F.max("l_discount").alias("disc"),
                  F.max("l_tax").alias("tax"), F.max("l_partkey").alias("pk")))
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        "s_suppkey", "s_name", "s_nationkey")
    # supplier grows with the data (10,000 rows per scale unit), so no
    # broadcast hint: AQE broadcasts it only when its measured size allows.
    j = daily.join(supplier, daily.station_key == supplier.s_suppkey)
    k, pk, q = F.col("station_key"), F.col("pk"), F.col("q")
    nation = F.col("s_nationkey")
    no_flag = F.lit(None).cast("string")
    return j.select(
        F.concat(F.lit("ST"), k.cast("string")).alias("STATION"),
        F.col("obs_date").alias("DATE"),
        _unless(k % 23 == 0, (20 + nation).cast("double")).alias("LATITUDE"),
        _unless(k % 23 == 0, (40 + nation).cast("double")).alias("LONGITUDE"),
        _unless(k % 19 == 0, (k % 500).cast("double")).alias("ELEVATION"),
        F.col("s_name").alias("NAME"),
        _unless(pk % 7 == 0, (pk % 300).cast("double")).alias("PRCP"),
        no_flag.alias("PRCP_ATTRIBUTES"),
        _unless(pk % 11 == 0, q * 10 + F.round(F.col("disc") * 1000)).alias("TMAX"),
        no_flag.alias("TMAX_ATTRIBUTES"),
        _unless(pk % 13 == 0, q * 10 - F.round(F.col("tax") * 1000)).alias("TMIN"),
        no_flag.alias("TMIN_ATTRIBUTES"),
        _unless(pk % 17 == 0, q * 10).alias("TAVG"),
        no_flag.alias("TAVG_ATTRIBUTES"),
    )
