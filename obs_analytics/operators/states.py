"""A1-A15 kept as stored partial states: what a roll-up has to know of a
station and month, written beside the landed rows.

A state row holds counts, sums, squared deviations and extremes of one
(STATION, YEAR, MONTH). States merge by adding up, so every summary by year,
month, season, decade or station is a small aggregate over them, and re-landing
a year replaces the states of that year only. The table is partitioned by
OBS_YEAR as the rows are, and also counts rows that cleaning drops, so a year
whose rows all become unusable replaces its states too.

``recent_baseline``, ``climatology``, ``lookback_by_group`` and with them
``forecast_grid`` accept states in place of observations; ``histogram`` and
``distribution_shift`` take their ranges from them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import season_name
from ..schema import SEASON_NAMES
from .cleaning import complete, prepare_observations

STATE_KEYS = ["STATION", "YEAR", "MONTH", "SEASON", "DECADE"]
SKETCH_PRECISION = 14  # 16 KB a year, standard error 0.8 per cent
MEASURES = ["LATITUDE", "LONGITUDE", "ELEVATION", "PRCP", "TAVG", "TMAX", "TMIN", "TEMP_RANGE"]


def partial_states(raw: DataFrame) -> DataFrame:
    """One row per station and month of raw observations: RAW_ROWS, N_ROWS
    (clean), per measure its sum S_ and count N_, of TAVG the squared deviations
    M2_TAVG from its mean, its extremes, and the extremes LO_, HI_ and count
    N_VALUES without NaN; MAX_TMAX."""
    rows = prepare_observations(raw.withColumn("CLEAN", complete()), keep_incomplete=True)
    clean = lambda c: F.when(F.col("CLEAN"), F.col(c))
    value = F.when(F.col("CLEAN") & ~F.isnan("TAVG"), F.col("TAVG"))
    sums = [f(clean(c)).alias(f"{p}_{c}") for c in MEASURES for f, p in ((F.sum, "S"), (F.count, "N"))]
    return rows.groupBy(*STATE_KEYS).agg(
        F.count(F.lit(1)).alias("RAW_ROWS"), F.count(F.when(F.col("CLEAN"), 1)).alias("N_ROWS"), *sums,
        (F.var_pop(clean("TAVG")) * F.count(clean("TAVG"))).alias("M2_TAVG"),
        F.min(clean("TAVG")).alias("MIN_TAVG"), F.max(clean("TAVG")).alias("MAX_TAVG"),
        F.min(value).alias("LO_TAVG"), F.max(value).alias("HI_TAVG"), F.count(value).alias("N_VALUES"),
        F.max(clean("TMAX")).alias("MAX_TMAX"))


def land_states(raw: DataFrame, path: str) -> None:
    """Write the states of ``raw``, which holds all rows of its years; the
    states of other years under ``path`` stay as they are."""
    (partial_states(raw).withColumn("OBS_YEAR", F.col("YEAR"))
     .repartition("OBS_YEAR").sortWithinPartitions("OBS_YEAR", "STATION", "MONTH")
     .write.partitionBy("OBS_YEAR").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def is_states(df: DataFrame) -> bool:
    return "M2_TAVG" in df.columns


def held(states: DataFrame) -> DataFrame:
    """The states of months with clean rows."""
    return states.where("N_ROWS > 0")


def mean(c: str):
    return F.try_divide(F.sum(f"S_{c}"), F.sum(f"N_{c}").cast("double"))


def rollup_states(states: DataFrame) -> DataFrame:
    """A15 from states: the rows of ``rollup_all``."""
    g = {c: F.grouping(c) == 0 for c in ["YEAR", "MONTH", "SEASON", "DECADE"]}
    level = (F.when(g["YEAR"] & g["SEASON"], "year_season").when(g["YEAR"], "year").when(g["MONTH"], "month")
             .when(g["SEASON"], "season").when(g["DECADE"], "decade").otherwise("all"))
    sets = [["YEAR"], ["MONTH"], ["SEASON"], ["DECADE"], ["YEAR", "SEASON"], []]
    return held(states).groupingSets(sets, "YEAR", "MONTH", "SEASON", "DECADE").agg(
        level.alias("LEVEL"), F.coalesce(F.sum("N_ROWS"), F.lit(0)).alias("N_ROWS"), mean("TAVG").alias("AVG_TAVG"),
        mean("TEMP_RANGE").alias("AVG_RANGE"), F.max("MAX_TMAX").alias("MAX_TMAX"), F.sum("S_PRCP").alias("SUM_PRCP"))


def summaries(states: DataFrame) -> dict[str, DataFrame]:
    """A1-A7 and the overview by the names that ``run_analysis`` gives them."""
    s = held(states)
    seasons = s.groupBy("SEASON").agg(mean("TEMP_RANGE").alias("AVG_RANGE"), F.sum("N_ROWS").alias("N_ROWS"))
    named = s.sparkSession.range(len(SEASON_NAMES)).select(F.col("id").cast("int").alias("SEASON"))
    return {
        "yearly_mean": s.groupBy("YEAR").agg(mean("TAVG").alias("AVG_TAVG")).orderBy("YEAR"),
        "monthly_mean": s.groupBy("MONTH").agg(mean("TAVG").alias("AVG_TAVG")).orderBy("MONTH"),
        "season_range": named.join(F.broadcast(seasons), "SEASON", "left")  # at most one row per season
        .select("SEASON", season_name("SEASON").alias("SEASON_NAME"), "AVG_RANGE", F.coalesce("N_ROWS", F.lit(0)).alias("N_ROWS")).orderBy("SEASON"),
        "decade_mean": s.groupBy("DECADE").agg(mean("TAVG").alias("AVG_TAVG")).orderBy("DECADE"),
        "season_year_mean": s.groupBy("YEAR", "SEASON").agg(mean("TAVG").alias("SEASONAL_TEMP")).orderBy("YEAR", "SEASON"),
        "yearly_extreme": s.groupBy("YEAR").agg(F.max("MAX_TMAX").alias("MAX_TEMP")).orderBy("YEAR"),
        "yearly_precip": s.groupBy("YEAR").agg(F.sum("S_PRCP").alias("ANNUAL_PRECIP")).orderBy("YEAR"),
        "dataset_overview": overview(states),
    }


def overview(states: DataFrame) -> DataFrame:
    """R1 from states: the row of ``dataset_overview``. The deviation merges the
    states' squared deviations about the mean of all."""
    s = held(states)
    centre = s.agg(mean("TAVG")).scalar()
    spread = F.sum(F.col("M2_TAVG") + F.col("N_TAVG") * F.pow(F.col("S_TAVG") / F.col("N_TAVG") - centre, 2))
    return s.agg(
        F.coalesce(F.sum("N_ROWS"), F.lit(0)).alias("TOTAL_RECORDS"), F.min("YEAR").alias("FIRST_YEAR"), F.max("YEAR").alias("LAST_YEAR"),
        F.countDistinct("STATION").alias("STATIONS"), mean("TAVG").alias("MEAN_TEMP"),
        F.sqrt(F.try_divide(spread, F.nullif(F.sum("N_TAVG") - 1, F.lit(0)).cast("double"))).alias("STD_TEMP"),
        F.min("MIN_TAVG").alias("MIN_TEMP"), F.max("MAX_TAVG").alias("MAX_TEMP"))


def value_ranges(states: DataFrame, by=()) -> DataFrame:
    """Per group the least and largest TAVG without NaN and their number, as
    ``histogram`` takes them."""
    return states.where("N_VALUES > 0").groupBy(*by).agg(
        F.min("LO_TAVG").alias("_lo"), F.max("HI_TAVG").alias("_hi"), F.sum("N_VALUES").alias("_n"))


def station_sketches(raw: DataFrame, precision: int = SKETCH_PRECISION) -> DataFrame:
    """A11 in mergeable form: per year a HyperLogLog sketch of the stations with
    clean rows (at most 2^precision bytes; null stations are not counted), and
    the number of those rows."""
    rows = prepare_observations(raw)
    return rows.groupBy("YEAR").agg(F.hll_sketch_agg("STATION", F.lit(precision)).alias("STATIONS"), F.count(F.lit(1)).alias("N_ROWS"))


def land_sketches(raw: DataFrame, path: str) -> None:
    """Write the sketches of ``raw``, which holds all rows of its years; those
    of other years under ``path`` stay. A year without clean rows keeps none."""
    years = raw.select(F.year("DATE").alias("YEAR")).distinct()
    made = station_sketches(raw)
    both = years.join(made.withColumnRenamed("YEAR", "_y"), F.col("YEAR").eqNullSafe(F.col("_y")), "left").drop("_y")
    (both.withColumn("OBS_YEAR", F.col("YEAR")).repartition("OBS_YEAR")
     .write.partitionBy("OBS_YEAR").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path))


def distinct_stations(sketches: DataFrame, by=("YEAR",)) -> DataFrame:
    """Estimated number of stations per group (of all years with ``by=[]``) by
    the union of stored sketches; no row is read. The standard error is about
    1.04 / sqrt(2^precision)."""
    merged = sketches.where("STATIONS is not null").groupBy(*by).agg(F.hll_union_agg("STATIONS").alias("_u"), F.sum("N_ROWS").alias("N_ROWS"))
    return merged.select(*by, F.coalesce(F.hll_sketch_estimate("_u"), F.lit(0)).alias("STATIONS"), F.coalesce("N_ROWS", F.lit(0)).alias("N_ROWS"))
