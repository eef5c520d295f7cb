"""Registered queries: each is a Spark plan over the test tables and, where
SQL can express it, the independent SQL that must give the same rows.

Library functions return full-precision values; here, at the edge, double
columns are rounded to 6 decimals on both sides so that a different
summation order in the two engines cannot change the comparison.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import day_of_year_mid_month, season_name
from ..functions.classes import class_label, value_class
from ..operators import cleaning, distributions, forecasting, metrics, rollups, states, trends, windows
from ..operators.modeling import STANDIN_NAMES, fit_feature_stages, midrange_predictor, standin_scores
from ..operators.sampling import hash_sample
from ..schema import (CRITICAL_COLUMNS, FEATURES, LR_PARAMS, MODEL_NAMES, PRECIP_COLUMN,
                      RECENT_TREND_START, TEMPERATURE_COLUMNS, TREND_START)
from ..session import ensure_checkpoint_dir
from ..sources.observations import land_observations, land_with_states, read_landed
from ..sources.testdata import raw_observations
from .frames import Frames
from .oracle_sql import hash_unit_sql, rounded, value_class_sql, with_ctes
from .training import TrainedModels

Builder = Callable[[SparkSession, str], DataFrame]

# Period cuts for the distribution shift on the test tables (1995-2001);
# the library defaults are the reference's 1980 / 2000.
TEST_EARLY_END, TEST_LATE_START = 1996, 2000

# Allowed gap in the linear model's optimality condition, in label deviations:
# the iterative fit stops at a relative tolerance.
OPTIMALITY_TOLERANCE = 1e-3


@dataclass
class Query:
    name: str
    build: Builder
    sql: str | None = None
    doubles: list[str] = field(default_factory=list)

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        return df.select(*[(F.round(F.col(f.name), 6) + F.lit(0.0)).alias(f.name)
                           if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
                           for f in df.schema.fields])

    def oracle(self) -> str | None:
        return rounded(self.sql, self.doubles) if self.sql else None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None, doubles: str = ""):
    def wrap(fn: Builder) -> Builder:
        REGISTRY[name] = Query(name, fn, sql, doubles.split())
        return fn
    return wrap


def frames(spark: SparkSession, sf_dir: str) -> Frames:
    return Frames(raw_observations(spark, sf_dir))


_TRAINED: dict[tuple[str, str], TrainedModels] = {}


def trained(spark: SparkSession, sf_dir: str) -> TrainedModels:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _TRAINED:
        _TRAINED[key] = TrainedModels(frames(spark, sf_dir))
    return _TRAINED[key]


def forget_trained() -> None:
    """Release the fitted models and their pinned rows; the next query that
    needs them fits again."""
    for models in _TRAINED.values():
        models.release()
    _TRAINED.clear()


RAW_DOUBLES = "LATITUDE LONGITUDE ELEVATION PRCP TMAX TMIN TAVG"
_KEY = 'STATION, "DATE"'

# -- sources, filters, projections -------------------------------------------

@register("source_observations", with_ctes("raw_obs") + "SELECT * FROM raw_obs", RAW_DOUBLES)
def _q(spark, d):
    return frames(spark, d).raw


@register("clean_filter", with_ctes("raw_obs") + "SELECT * FROM raw_obs WHERE " +
          " AND ".join(f'"{c}" IS NOT NULL' for c in CRITICAL_COLUMNS), RAW_DOUBLES)
def _q(spark, d):
    return cleaning.drop_incomplete(frames(spark, d).raw)


@register("clean_units", with_ctes("raw_obs") + f"""
SELECT {_KEY}, PRCP / 10.0 AS PRCP, TMAX / 10.0 AS TMAX, TMIN / 10.0 AS TMIN, TAVG / 10.0 AS TAVG
FROM raw_obs WHERE "DATE" IS NOT NULL AND TAVG IS NOT NULL AND LATITUDE IS NOT NULL
  AND LONGITUDE IS NOT NULL""", "PRCP TMAX TMIN TAVG")
def _q(spark, d):
    df = cleaning.rescale(cleaning.drop_incomplete(frames(spark, d).raw),
                          TEMPERATURE_COLUMNS + [PRECIP_COLUMN])
    return df.select("STATION", "DATE", "PRCP", "TMAX", "TMIN", "TAVG")


@register("filter_year_range", with_ctes("obs") + f"""
SELECT {_KEY}, "YEAR", TAVG FROM obs
WHERE "DATE" >= DATE '1997-01-01' AND "DATE" < DATE '2000-01-01'""", "TAVG")
def _q(spark, d):
    return rollups.between_years(frames(spark, d).obs, 1997, 1999).select(
        "STATION", "DATE", "YEAR", "TAVG")


_MROW_COLS = ", ".join(f'"{c}"' for c in ["STATION", "DATE", *FEATURES, "TAVG"])


@register("model_rows", with_ctes("mrows") + f"SELECT {_MROW_COLS} FROM mrows",
          "LATITUDE LONGITUDE ELEVATION PRCP TMAX TMIN TEMP_RANGE TAVG_30DAY_AVG TAVG")
def _q(spark, d):
    return frames(spark, d).model_rows


# -- scalar expressions -------------------------------------------------------

@register("feat_calendar", with_ctes("obs") +
          f'SELECT {_KEY}, "YEAR", "MONTH", DAY_OF_YEAR FROM obs')
def _q(spark, d):
    return frames(spark, d).obs.select("STATION", "DATE", "YEAR", "MONTH", "DAY_OF_YEAR")


@register("feat_season", with_ctes("obs") + f"""
SELECT {_KEY}, "MONTH", SEASON, ['Winter', 'Spring', 'Summer', 'Fall'][SEASON + 1] AS SEASON_NAME
FROM obs""")
def _q(spark, d):
    return frames(spark, d).obs.select("STATION", "DATE", "MONTH", "SEASON",
                                       season_name("SEASON").alias("SEASON_NAME"))


@register("feat_range", with_ctes("obs") + f"SELECT {_KEY}, TMAX, TMIN, TEMP_RANGE FROM obs",
          "TMAX TMIN TEMP_RANGE")
def _q(spark, d):
    return frames(spark, d).obs.select("STATION", "DATE", "TMAX", "TMIN", "TEMP_RANGE")


@register("feat_decade", with_ctes("obs") + f'SELECT {_KEY}, "YEAR", "DECADE" FROM obs')
def _q(spark, d):
    return frames(spark, d).obs.select("STATION", "DATE", "YEAR", "DECADE")


@register("impute_prcp", with_ctes("obs") + f"SELECT {_KEY}, PRCP FROM obs", "PRCP")
def _q(spark, d):
    return frames(spark, d).obs.select("STATION", "DATE", "PRCP")


@register("impute_temps", with_ctes("obs") + f"SELECT {_KEY}, TAVG, TMAX, TMIN FROM obs",
          "TAVG TMAX TMIN")
def _q(spark, d):
    return frames(spark, d).obs.select("STATION", "DATE", "TAVG", "TMAX", "TMIN")


@register("class_distribution", with_ctes("obs") + f"""
SELECT CLASS, ['Very Cold', 'Cold', 'Moderate', 'Warm', 'Hot', 'Very Hot'][CLASS + 1] AS CLASS_LABEL,
       count(*) AS N_ROWS
FROM (SELECT {value_class_sql('TAVG')} AS CLASS FROM obs) c GROUP BY CLASS""")
def _q(spark, d):
    return (frames(spark, d).obs.groupBy(value_class("TAVG").alias("CLASS"))
            .agg(F.count(F.lit(1)).alias("N_ROWS"))
            .select("CLASS", class_label("CLASS").alias("CLASS_LABEL"), "N_ROWS"))


@register("midmonth_doy", with_ctes("obs") + """
SELECT y."YEAR", cast(m.range AS integer) AS "MONTH",
       cast(dayofyear(make_date(y."YEAR", cast(m.range AS integer), 15)) AS integer) AS DAY_OF_YEAR
FROM (SELECT DISTINCT "YEAR" FROM obs) y CROSS JOIN range(1, 13) m""")
def _q(spark, d):
    years = frames(spark, d).obs.select("YEAR").distinct()
    months = spark.range(1, 13).select(F.col("id").cast("int").alias("MONTH"))
    return years.crossJoin(F.broadcast(months)).select(
        "YEAR", "MONTH", day_of_year_mid_month("YEAR", "MONTH").alias("DAY_OF_YEAR"))


# -- aggregations ---------------------------------------------------------------

def _by_sql(key: str, expr: str, out: str) -> str:
    return with_ctes("obs") + f'SELECT "{key}", {expr} AS {out} FROM obs GROUP BY "{key}"'


@register("yearly_mean", _by_sql("YEAR", "avg(TAVG)", "AVG_TAVG"), "AVG_TAVG")
def _q(spark, d):
    return rollups.yearly_mean(frames(spark, d).obs)


@register("monthly_mean", _by_sql("MONTH", "avg(TAVG)", "AVG_TAVG"), "AVG_TAVG")
def _q(spark, d):
    return rollups.monthly_mean(frames(spark, d).obs)


@register("season_range", with_ctes("obs") + """
SELECT s.SEASON, s.SEASON_NAME, a.AVG_RANGE, coalesce(a.N_ROWS, 0) AS N_ROWS
FROM (VALUES (0, 'Winter'), (1, 'Spring'), (2, 'Summer'), (3, 'Fall')) s(SEASON, SEASON_NAME)
LEFT JOIN (SELECT SEASON, avg(TEMP_RANGE) AS AVG_RANGE, count(*) AS N_ROWS
           FROM obs GROUP BY SEASON) a ON a.SEASON = s.SEASON""", "AVG_RANGE")
def _q(spark, d):
    return rollups.season_range(frames(spark, d).obs)


@register("decade_mean", _by_sql("DECADE", "avg(TAVG)", "AVG_TAVG"), "AVG_TAVG")
def _q(spark, d):
    return rollups.decade_mean(frames(spark, d).obs)


@register("season_year_mean", with_ctes("obs") + """
SELECT "YEAR", SEASON, avg(TAVG) AS SEASONAL_TEMP FROM obs GROUP BY "YEAR", SEASON""",
          "SEASONAL_TEMP")
def _q(spark, d):
    return rollups.season_year_mean(frames(spark, d).obs)


@register("yearly_extreme", _by_sql("YEAR", "max(TMAX)", "MAX_TEMP"), "MAX_TEMP")
def _q(spark, d):
    return rollups.yearly_extreme(frames(spark, d).obs)


@register("yearly_precip", _by_sql("YEAR", "sum(PRCP)", "ANNUAL_PRECIP"), "ANNUAL_PRECIP")
def _q(spark, d):
    return rollups.yearly_precip(frames(spark, d).obs)


@register("yearly_mean_since", with_ctes("yearly_since_1950") + "SELECT * FROM yearly_since_1950",
          "AVG_TEMP")
def _q(spark, d):
    return rollups.yearly_mean_since(frames(spark, d).obs, TREND_START)


@register("value_stats", with_ctes("obs") + """
SELECT avg(TAVG) AS MEAN_TEMP, stddev_samp(TAVG) AS STD_TEMP, min(TAVG) AS MIN_TEMP,
       max(TAVG) AS MAX_TEMP FROM obs""", "MEAN_TEMP STD_TEMP MIN_TEMP MAX_TEMP")
def _q(spark, d):
    return rollups.value_stats(frames(spark, d).obs)


@register("dataset_overview", with_ctes("obs") + """
SELECT count(*) AS TOTAL_RECORDS, min("YEAR") AS FIRST_YEAR, max("YEAR") AS LAST_YEAR,
       count(DISTINCT STATION) AS STATIONS, avg(TAVG) AS MEAN_TEMP,
       stddev_samp(TAVG) AS STD_TEMP, min(TAVG) AS MIN_TEMP, max(TAVG) AS MAX_TEMP
FROM obs""", "MEAN_TEMP STD_TEMP MIN_TEMP MAX_TEMP")
def _q(spark, d):
    return rollups.dataset_overview(frames(spark, d).obs)


@register("overview_report", with_ctes("obs") + """
SELECT SECTION, ITEM, VALUE
FROM (SELECT count(*) AS TOTAL_RECORDS, min("YEAR") AS FIRST_YEAR, max("YEAR") AS LAST_YEAR,
             count(DISTINCT STATION) AS STATIONS, avg(TAVG) AS MEAN_TEMP,
             stddev_samp(TAVG) AS STD_TEMP, min(TAVG) AS MIN_TEMP, max(TAVG) AS MAX_TEMP
      FROM obs) o,
LATERAL (VALUES ('dataset', 'total_records', cast(o.TOTAL_RECORDS AS double)),
                ('dataset', 'first_year', cast(o.FIRST_YEAR AS double)),
                ('dataset', 'last_year', cast(o.LAST_YEAR AS double)),
                ('dataset', 'stations', cast(o.STATIONS AS double)),
                ('temperature', 'mean', o.MEAN_TEMP), ('temperature', 'std', o.STD_TEMP),
                ('temperature', 'min', o.MIN_TEMP), ('temperature', 'max', o.MAX_TEMP))
        v(SECTION, ITEM, VALUE)""", "VALUE")
def _q(spark, d):
    return rollups.overview_report(frames(spark, d).obs)


@register("row_accounting", with_ctes("raw_obs", "split") + """
SELECT a.RAW_ROWS, a.CLEAN_ROWS, b.MODEL_ROWS, b.TRAIN_ROWS, b.MODEL_ROWS - b.TRAIN_ROWS AS TEST_ROWS
FROM (SELECT count(*) AS RAW_ROWS,
             cast(coalesce(sum(CASE WHEN "DATE" IS NOT NULL AND TAVG IS NOT NULL AND LATITUDE IS NOT NULL
                                     AND LONGITUDE IS NOT NULL THEN 1 ELSE 0 END), 0) AS bigint) AS CLEAN_ROWS
      FROM raw_obs) a
CROSS JOIN (SELECT count(*) AS MODEL_ROWS,
                   cast(coalesce(sum(CASE WHEN IS_TRAIN THEN 1 ELSE 0 END), 0) AS bigint) AS TRAIN_ROWS
            FROM split) b""")
def _q(spark, d):
    return rollups.row_accounting(frames(spark, d).raw)


@register("recent_baseline", with_ctes("baseline") + "SELECT * FROM baseline",
          "LAT LON ELEV PRCP_MEAN TAVG_BASELINE")
def _q(spark, d):
    return rollups.recent_baseline(frames(spark, d).obs)


@register("climatology", with_ctes("clim") + "SELECT * FROM clim", "AVG_TMAX AVG_TMIN AVG_TAVG")
def _q(spark, d):
    return rollups.climatology(frames(spark, d).obs)


@register("rollup_all", with_ctes("obs") + """
SELECT "YEAR", "MONTH", SEASON, "DECADE",
       CASE WHEN grouping("YEAR") = 0 AND grouping(SEASON) = 0 THEN 'year_season'
            WHEN grouping("YEAR") = 0 THEN 'year' WHEN grouping("MONTH") = 0 THEN 'month'
            WHEN grouping(SEASON) = 0 THEN 'season' WHEN grouping("DECADE") = 0 THEN 'decade'
            ELSE 'all' END AS LEVEL,
       count(*) AS N_ROWS, avg(TAVG) AS AVG_TAVG, avg(TEMP_RANGE) AS AVG_RANGE,
       max(TMAX) AS MAX_TMAX, sum(PRCP) AS SUM_PRCP
FROM obs
GROUP BY GROUPING SETS (("YEAR"), ("MONTH"), (SEASON), ("DECADE"), ("YEAR", SEASON), ())""",
          "AVG_TAVG AVG_RANGE MAX_TMAX SUM_PRCP")
def _q(spark, d):
    return rollups.rollup_all(frames(spark, d).obs)


# -- trends -----------------------------------------------------------------------

@register("linear_trend", with_ctes("yearly_since_1950") + """
SELECT regr_slope(AVG_TEMP, "YEAR") AS SLOPE, regr_intercept(AVG_TEMP, "YEAR") AS INTERCEPT,
       count(AVG_TEMP) AS N_POINTS FROM yearly_since_1950""", "SLOPE INTERCEPT")
def _q(spark, d):
    points = rollups.yearly_mean_since(frames(spark, d).obs, TREND_START)
    return trends.linear_trend(points)


@register("linear_trend_by_station", with_ctes("obs") + """
SELECT STATION, regr_slope(AVG_TEMP, "YEAR") AS SLOPE, regr_intercept(AVG_TEMP, "YEAR") AS INTERCEPT,
       count(AVG_TEMP) AS N_POINTS
FROM (SELECT STATION, "YEAR", avg(TAVG) AS AVG_TEMP FROM obs
      WHERE "DATE" >= DATE '1950-01-01' GROUP BY STATION, "YEAR") p
GROUP BY STATION""", "SLOPE INTERCEPT")
def _q(spark, d):
    points = rollups.yearly_mean_since(frames(spark, d).obs, TREND_START, by=["STATION"])
    return trends.linear_trend(points, by=["STATION"])


@register("trend_line", with_ctes("yearly_since_1950") + """
SELECT p."YEAR", p.AVG_TEMP, f.SLOPE * p."YEAR" + f.INTERCEPT AS FITTED
FROM yearly_since_1950 p CROSS JOIN (SELECT regr_slope(AVG_TEMP, "YEAR") AS SLOPE,
                                     regr_intercept(AVG_TEMP, "YEAR") AS INTERCEPT
                                     FROM yearly_since_1950) f""", "AVG_TEMP FITTED")
def _q(spark, d):
    points = rollups.yearly_mean_since(frames(spark, d).obs, TREND_START)
    return trends.trend_line(points, trends.linear_trend(points))


def _trend_sql(cte: str) -> str:
    return with_ctes(cte) + f"""
SELECT SLOPE, INTERCEPT, N_YEARS, SLOPE * 10 AS CHANGE_10Y, SLOPE * 50 AS CHANGE_50Y,
       CASE WHEN SLOPE > 0.01 THEN 'significant warming' WHEN SLOPE > 0 THEN 'moderate warming'
            ELSE 'cooling' END AS TREND
FROM (SELECT regr_slope(AVG_TEMP, "YEAR") AS SLOPE, regr_intercept(AVG_TEMP, "YEAR") AS INTERCEPT,
             count(AVG_TEMP) AS N_YEARS FROM {cte}) t
WHERE N_YEARS > 1"""


_TREND_DOUBLES = "SLOPE INTERCEPT CHANGE_10Y CHANGE_50Y"


@register("trend_assessment", _trend_sql("yearly_since_1950"), _TREND_DOUBLES)
def _q(spark, d):
    return trends.trend_assessment(frames(spark, d).obs, TREND_START)


@register("trend_assessment_recent", _trend_sql("yearly_since_2000"), _TREND_DOUBLES)
def _q(spark, d):
    return trends.trend_assessment(frames(spark, d).obs, RECENT_TREND_START)


@register("trend_projection", with_ctes("yearly_since_1950") + """
SELECT SLOPE, SLOPE * 10 AS CHANGE_10Y, SLOPE * 50 AS CHANGE_50Y
FROM (SELECT regr_slope(AVG_TEMP, "YEAR") AS SLOPE, count(AVG_TEMP) AS N FROM yearly_since_1950) t
WHERE N > 1""", "SLOPE CHANGE_10Y CHANGE_50Y")
def _q(spark, d):
    return trends.trend_assessment(frames(spark, d).obs, TREND_START).select(
        "SLOPE", "CHANGE_10Y", "CHANGE_50Y")


# -- distributions and sampling ---------------------------------------------------

def _hist_sql(source: str, bins: int, by: str | None, density: bool) -> str:
    g = f"{by}, " if by else ""
    on = f"USING ({by})" if by else "ON TRUE"
    dens = ", cast(coalesce(c.CNT, 0) AS double) / (s.n * (s.hi - s.lo) / " + f"{bins}.0) AS DENSITY" \
        if density else ""
    return f""",
v AS ({source}),
s AS (SELECT {g}count(*) AS n,
             CASE WHEN max(x) = min(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
             CASE WHEN max(x) = min(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
      FROM v GROUP BY ALL),
b AS (SELECT {g}cast(least(floor((v.x - s.lo) * ({bins}.0 / (s.hi - s.lo))), {bins - 1}) AS integer) AS BIN
      FROM v JOIN s {on}),
c AS (SELECT {g}BIN, count(*) AS CNT FROM b GROUP BY ALL)
SELECT {"s." + by + ", " if by else ""}cast(k.range AS integer) AS BIN,
       s.lo + cast(k.range AS integer) * ((s.hi - s.lo) / {bins}.0) AS BIN_LO,
       CASE WHEN k.range = {bins - 1} THEN s.hi
            ELSE s.lo + (cast(k.range AS integer) + 1) * ((s.hi - s.lo) / {bins}.0) END AS BIN_HI,
       cast(coalesce(c.CNT, 0) AS bigint) AS "COUNT"{dens}
FROM s CROSS JOIN range(0, {bins}) k
LEFT JOIN c ON c.BIN = k.range{f" AND c.{by} = s.{by}" if by else ""}"""


_HIST_SOURCE = "SELECT TAVG AS x FROM obs WHERE TAVG IS NOT NULL AND NOT isnan(TAVG)"
_PERIOD_SOURCE = f"""
  SELECT PERIOD, TAVG AS x
  FROM (SELECT CASE WHEN "YEAR" <= {TEST_EARLY_END} THEN 'early'
                    WHEN "YEAR" >= {TEST_LATE_START} THEN 'late' END AS PERIOD, TAVG FROM obs) p
  WHERE PERIOD IS NOT NULL AND TAVG IS NOT NULL AND NOT isnan(TAVG)"""


@register("value_histogram", with_ctes("obs").rstrip("\n") + _hist_sql(_HIST_SOURCE, 50, None, False),
          "BIN_LO BIN_HI")
def _q(spark, d):
    return distributions.histogram(frames(spark, d).obs, "TAVG", 50)


@register("distribution_shift",
          with_ctes("obs").rstrip("\n") + _hist_sql(_PERIOD_SOURCE, 40, "PERIOD", True),
          "BIN_LO BIN_HI DENSITY")
def _q(spark, d):
    return distributions.distribution_shift(frames(spark, d).obs, "TAVG", 40,
                                            TEST_EARLY_END, TEST_LATE_START)


@register("sample_pairs", with_ctes("obs") + f"""
SELECT {_KEY}, PRCP, TAVG FROM obs WHERE {hash_unit_sql('sample:42')} < 0.1""", "PRCP TAVG")
def _q(spark, d):
    return distributions.sample_pairs(frames(spark, d).obs)


_OBS_COLS = ["STATION", "DATE", "YEAR", "MONTH", "TAVG", "TMAX", "TMIN", "PRCP", "TEMP_RANGE"]


@register("hash_sample", with_ctes("obs") + f"""
SELECT {", ".join(f'"{c}"' for c in _OBS_COLS)} FROM obs WHERE {hash_unit_sql('sample:42')} < 0.1""",
          "TAVG TMAX TMIN PRCP TEMP_RANGE")
def _q(spark, d):
    return hash_sample(frames(spark, d).obs).select(*_OBS_COLS)


@register("train_test_split", with_ctes("split") + f"SELECT {_KEY}, IS_TRAIN FROM split")
def _q(spark, d):
    return frames(spark, d).split.select("STATION", "DATE", "IS_TRAIN")


@register("relation_summary", with_ctes("obs") + """
SELECT corr(PRCP, TAVG) AS CORRELATION,
       count(CASE WHEN PRCP IS NOT NULL AND TAVG IS NOT NULL THEN 1 END) AS N_PAIRS FROM obs""",
          "CORRELATION")
def _q(spark, d):
    return distributions.relation_summary(frames(spark, d).obs)


# -- windows ----------------------------------------------------------------------

@register("trailing_mean_by_station", with_ctes("feat") +
          f"SELECT {_KEY}, TAVG, TAVG_30DAY_AVG FROM feat", "TAVG TAVG_30DAY_AVG")
def _q(spark, d):
    return frames(spark, d).features.select("STATION", "DATE", "TAVG", "TAVG_30DAY_AVG")


@register("trailing_mean_global", with_ctes("obs") + f"""
SELECT {_KEY}, TAVG, avg(TAVG) OVER (ORDER BY "DATE", STATION
                                     ROWS BETWEEN 30 PRECEDING AND CURRENT ROW) AS TAVG_30DAY_AVG
FROM obs""", "TAVG TAVG_30DAY_AVG")
def _q(spark, d):
    return windows.trailing_mean(frames(spark, d).obs, "TAVG", "DATE", by=[],
                                 tiebreak=["STATION"]).select("STATION", "DATE", "TAVG",
                                                              "TAVG_30DAY_AVG")


@register("trailing_mean_30d", with_ctes("obs") + f"""
SELECT {_KEY}, TAVG, avg(TAVG) OVER (PARTITION BY STATION ORDER BY "DATE"
       RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS TAVG_30D_MEAN
FROM obs""", "TAVG TAVG_30D_MEAN")
def _q(spark, d):
    return windows.trailing_mean_days(frames(spark, d).obs).select(
        "STATION", "DATE", "TAVG", "TAVG_30D_MEAN")


@register("trailing_mean_30d_global", with_ctes("obs") + f"""
SELECT {_KEY}, TAVG, avg(TAVG) OVER (ORDER BY "DATE"
       RANGE BETWEEN INTERVAL 29 DAYS PRECEDING AND CURRENT ROW) AS TAVG_30D_MEAN
FROM obs""", "TAVG TAVG_30D_MEAN")
def _q(spark, d):
    return windows.trailing_mean_days(frames(spark, d).obs, by=[]).select("STATION", "DATE", "TAVG", "TAVG_30D_MEAN")


# -- forecast -----------------------------------------------------------------------

_GRID_DOUBLES = "LATITUDE LONGITUDE ELEVATION PRCP TMAX TMIN TEMP_RANGE TAVG_30DAY_AVG"


@register("forecast_grid", with_ctes("grid") + "SELECT * FROM grid", _GRID_DOUBLES)
def _q(spark, d):
    return forecasting.forecast_grid(frames(spark, d).obs)


@register("forecast_grid_by_station", with_ctes("grid_st") + "SELECT * FROM grid_st", _GRID_DOUBLES)
def _q(spark, d):
    return forecasting.forecast_grid(frames(spark, d).obs, by=["STATION"])


def _standin_forecast_yearly(spark, d):
    grid = forecasting.forecast_grid(frames(spark, d).obs)
    return forecasting.forecast_yearly(forecasting.forecast(grid, midrange_predictor()))


@register("forecast_yearly", with_ctes("forecast_yearly") + "SELECT * FROM forecast_yearly",
          "PREDICTED_TEMP")
def _q(spark, d):
    return _standin_forecast_yearly(spark, d)


@register("history_and_forecast", with_ctes("obs", "forecast_yearly") + """
SELECT "YEAR", 'historical' AS KIND, avg(TAVG) AS TEMP FROM obs GROUP BY "YEAR"
UNION ALL
SELECT "YEAR", 'predicted' AS KIND, PREDICTED_TEMP AS TEMP FROM forecast_yearly""", "TEMP")
def _q(spark, d):
    return forecasting.history_and_forecast(frames(spark, d).obs, _standin_forecast_yearly(spark, d))


@register("forecast_change", with_ctes("forecast_yearly") + """
SELECT f."YEAR", f.PREDICTED_TEMP, f.PREDICTED_TEMP - s.START_TEMP AS CHANGE,
       CASE WHEN f.PREDICTED_TEMP - s.START_TEMP >= 0 THEN 'increase' ELSE 'decrease' END AS DIRECTION
FROM forecast_yearly f
CROSS JOIN (SELECT min_by(PREDICTED_TEMP, "YEAR") AS START_TEMP FROM forecast_yearly) s""",
          "PREDICTED_TEMP CHANGE")
def _q(spark, d):
    return forecasting.forecast_change(_standin_forecast_yearly(spark, d))


# -- evaluation on stand-in predictions -----------------------------------------------

def _standin_scored(spark, d):
    f = frames(spark, d)
    return standin_scores(f.test, f.train)


_REG_DOUBLES = "RMSE MSE MAE R2 ADJ_R2 MAPE TOLERANCE_ACCURACY"
_CLS_DOUBLES = "ACCURACY PRECISION RECALL F1"


@register("regression_metrics", with_ctes("reg_metrics") + "SELECT * FROM reg_metrics", _REG_DOUBLES)
def _q(spark, d):
    return metrics.regression_metrics(_standin_scored(spark, d))


@register("confusion_counts", with_ctes("confusion") + "SELECT * FROM confusion")
def _q(spark, d):
    return metrics.confusion_counts(_standin_scored(spark, d))


@register("class_metrics_per_class", with_ctes("per_class") + "SELECT * FROM per_class",
          "PRECISION RECALL F1")
def _q(spark, d):
    return metrics.class_metrics_per_class(_standin_scored(spark, d))


@register("class_metrics", with_ctes("class_metrics") + "SELECT * FROM class_metrics", _CLS_DOUBLES)
def _q(spark, d):
    return metrics.class_metrics(_standin_scored(spark, d))


@register("model_comparison", with_ctes("comparison") + "SELECT * FROM comparison",
          "RMSE MAE R2 ADJ_R2 MAPE ACCURACY PRECISION RECALL F1 TOLERANCE_ACCURACY")
def _q(spark, d):
    return metrics.model_comparison(_standin_scored(spark, d), STANDIN_NAMES)


@register("best_model", with_ctes("comparison") + """
SELECT max_by(MODEL, (R2, -MODEL_ORDER)) AS BEST_MODEL, max(R2) AS BEST_R2 FROM comparison""",
          "BEST_R2")
def _q(spark, d):
    return metrics.best_model(metrics.model_comparison(_standin_scored(spark, d), STANDIN_NAMES))


@register("best_by_metric", with_ctes("comparison") + """
SELECT METRIC, max_by(MODEL, (VALUE, -MODEL_ORDER)) AS BEST_MODEL, max(VALUE) AS BEST_VALUE
FROM (SELECT MODEL, MODEL_ORDER, 'R2' AS METRIC, R2 AS VALUE FROM comparison
      UNION ALL SELECT MODEL, MODEL_ORDER, 'ACCURACY', ACCURACY FROM comparison
      UNION ALL SELECT MODEL, MODEL_ORDER, 'F1', F1 FROM comparison) l
GROUP BY METRIC""", "BEST_VALUE")
def _q(spark, d):
    return metrics.best_by_metric(metrics.model_comparison(_standin_scored(spark, d), STANDIN_NAMES))


@register("model_grades", with_ctes("comparison") + """
SELECT MODEL, R2, ACCURACY, F1, MAPE,
       CASE WHEN R2 > 0.95 THEN 'Excellent' WHEN R2 > 0.90 THEN 'Very good'
            WHEN R2 > 0.80 THEN 'Good' ELSE 'Moderate' END AS R2_GRADE,
       CASE WHEN ACCURACY > 0.90 THEN 'Excellent' WHEN ACCURACY > 0.80 THEN 'Good'
            ELSE 'Moderate' END AS ACCURACY_GRADE,
       CASE WHEN F1 > 0.90 THEN 'Excellent' WHEN F1 > 0.80 THEN 'Good' ELSE 'Moderate' END AS F1_GRADE,
       CASE WHEN MAPE < 5 THEN 'High' WHEN MAPE < 10 THEN 'Good' ELSE 'Acceptable' END AS MAPE_GRADE
FROM comparison""", "R2 ACCURACY F1 MAPE")
def _q(spark, d):
    return metrics.model_grades(metrics.model_comparison(_standin_scored(spark, d), STANDIN_NAMES))


_UNPIVOT_COLS = ", ".join(f'cast("{c}" AS double) AS "{c}"' for c in FEATURES)


@register("scaled_feature_stats", with_ctes("split") + f"""
SELECT FEATURE, avg(v) AS MEAN, stddev_samp(v) AS STD
FROM (UNPIVOT (SELECT {_UNPIVOT_COLS} FROM split WHERE IS_TRAIN)
      ON {", ".join(f'"{c}"' for c in FEATURES)} INTO NAME FEATURE VALUE v) u
GROUP BY FEATURE""", "MEAN STD")
def _q(spark, d):
    """M2: the standard scaler's fitted mean and sample sd of each feature."""
    scaler = fit_feature_stages(frames(spark, d).train).stages[-1]
    rows = [(f, float(m), float(s)) for f, m, s in
            zip(FEATURES, scaler.mean.toArray(), scaler.std.toArray())]
    return spark.createDataFrame(rows, "FEATURE string, MEAN double, STD double")


# -- trained models (rows-only checks) ----------------------------------------------------

def _model_query(name: str) -> Builder:
    def build(spark, d):
        return trained(spark, d).scored([name])
    return build


for _key, _name in zip(["model_linear", "model_forest", "model_boosted"], MODEL_NAMES):
    REGISTRY[_key] = Query(_key, _model_query(_name))


@register("model_comparison_trained")
def _q(spark, d):
    return metrics.model_comparison(trained(spark, d).scored(), MODEL_NAMES)


def _best_trained(spark, d):
    cmp = metrics.model_comparison(trained(spark, d).scored(), MODEL_NAMES)
    return cmp, metrics.best_model(cmp)


@register("best_model_trained")
def _q(spark, d):
    return _best_trained(spark, d)[1]


def _best_pipeline(spark, d):
    best = _best_trained(spark, d)[1].first()["BEST_MODEL"]  # one row, three candidates
    return trained(spark, d).model(best)


@register("forecast")
def _q(spark, d):
    grid = forecasting.forecast_grid(frames(spark, d).obs)
    return forecasting.forecast(grid, _best_pipeline(spark, d))


@register("forecast_yearly_trained")
def _q(spark, d):
    grid = forecasting.forecast_grid(frames(spark, d).obs)
    return forecasting.forecast_yearly(forecasting.forecast(grid, _best_pipeline(spark, d)))


@register("model_report")
def _q(spark, d):
    return metrics.model_report(metrics.model_comparison(trained(spark, d).scored(), MODEL_NAMES))


@register("model_report_standin", with_ctes("comparison") + """
SELECT MODEL, RMSE, MAE, R2, ADJ_R2, MAPE, ACCURACY, "PRECISION", RECALL, F1, TOLERANCE_ACCURACY,
       CASE WHEN R2 > 0.95 THEN 'Excellent' WHEN R2 > 0.90 THEN 'Very good'
            WHEN R2 > 0.80 THEN 'Good' ELSE 'Moderate' END AS R2_GRADE,
       CASE WHEN ACCURACY > 0.90 THEN 'Excellent' WHEN ACCURACY > 0.80 THEN 'Good'
            ELSE 'Moderate' END AS ACCURACY_GRADE,
       CASE WHEN F1 > 0.90 THEN 'Excellent' WHEN F1 > 0.80 THEN 'Good' ELSE 'Moderate' END AS F1_GRADE,
       CASE WHEN MAPE < 5 THEN 'High' WHEN MAPE < 10 THEN 'Good' ELSE 'Acceptable' END AS MAPE_GRADE
FROM comparison ORDER BY R2 DESC NULLS LAST, MODEL_ORDER LIMIT 1""",
          "RMSE MAE R2 ADJ_R2 MAPE ACCURACY PRECISION RECALL F1 TOLERANCE_ACCURACY")
def _q(spark, d):
    return metrics.model_report(metrics.model_comparison(_standin_scored(spark, d), STANDIN_NAMES))


# -- checks of the trained path that SQL can express ------------------------------------

_MODELS_SQL = "(VALUES " + ", ".join(f"('{m}')" for m in MODEL_NAMES) + ") m(MODEL)"


@register("scored_trained", with_ctes("split") + f"""
SELECT {_KEY}, MODEL, TAVG, TRUE AS HAS_PREDICTION FROM split CROSS JOIN {_MODELS_SQL}
WHERE NOT IS_TRAIN""", "TAVG")
def _q(spark, d):
    """One finite prediction per test row and model."""
    p = F.col("prediction")
    return trained(spark, d).scored().select("STATION", "DATE", "MODEL", "TAVG",
                                             (p.isNotNull() & ~F.isnan(p)).alias("HAS_PREDICTION"))


@register("forecast_inputs_trained", with_ctes("grid") + f"""
SELECT *, TRUE AS HAS_PREDICTION FROM grid
WHERE {" AND ".join(f'"{c}" IS NOT NULL' for c in FEATURES)}""", _GRID_DOUBLES)
def _q(spark, d):
    """FC2: the rows and features that the best model scored."""
    p = F.col("prediction")
    grid = forecasting.forecast_grid(frames(spark, d).obs)
    return (forecasting.forecast(grid, _best_pipeline(spark, d))
            .withColumn("HAS_PREDICTION", p.isNotNull() & ~F.isnan(p)).drop("prediction"))


@register("models_beat_mean", with_ctes("split") + f"""
SELECT MODEL, N_ROWS, BASE_RMSE, TRUE AS BEATS_MEAN
FROM (SELECT count(*) AS N_ROWS, sqrt(avg((TAVG - base) * (TAVG - base))) AS BASE_RMSE
      FROM split CROSS JOIN (SELECT avg(TAVG) AS base FROM split WHERE IS_TRAIN) b
      WHERE NOT IS_TRAIN) r CROSS JOIN {_MODELS_SQL}""", "BASE_RMSE")
def _q(spark, d):
    """M3-M6: every fitted model has a lower test RMSE than the training mean."""
    t = trained(spark, d)
    base = t.train.agg(F.avg("TAVG")).scalar()
    e, b = F.col("TAVG") - F.col("prediction"), F.col("TAVG") - F.col("base")
    sums = t.scored().withColumn("base", base).groupBy("MODEL").agg(
        F.count(F.lit(1)).alias("N_ROWS"), F.sqrt(F.avg(b * b)).alias("BASE_RMSE"), F.sqrt(F.avg(e * e)).alias("rmse"))
    return sums.select("MODEL", "N_ROWS", "BASE_RMSE", (F.col("rmse") < F.col("BASE_RMSE")).alias("BEATS_MEAN"))


@register("linear_optimality", with_ctes("split") + f"""
SELECT FEATURE, avg(v) AS MEAN, stddev_samp(v) AS STD, TRUE AS OPTIMAL
FROM (UNPIVOT (SELECT {_UNPIVOT_COLS} FROM split WHERE IS_TRAIN)
      ON {", ".join(f'"{c}"' for c in FEATURES)} INTO NAME FEATURE VALUE v) u
GROUP BY FEATURE""", "MEAN STD")
def _q(spark, d):
    """M3: the fitted weights satisfy the elastic net's optimality condition, by
    feature: mean(x r) = lambda (alpha sign(w) + (1 - alpha) w / sd(y)) for a
    non-zero weight, |mean(x r)| <= lambda alpha for a zero one."""
    t = trained(spark, d)
    model = t.model(MODEL_NAMES[0])
    lam, alpha = LR_PARAMS["regParam"], LR_PARAMS["elasticNetParam"]
    rows = model.transform(t.train).select(
        vector_to_array("scaledFeatures").alias("x"), (F.col("TAVG") - F.col("prediction")).alias("r"), "TAVG")
    found = rows.agg(F.stddev_samp("TAVG").alias("sd"),
                     *[F.avg(F.get("x", F.lit(j)) * F.col("r")).alias(f"g{j}") for j in range(len(FEATURES))]).first()
    scaler, weights = model.stages[1], model.stages[-1].coefficients
    out = []
    for j, name in enumerate(FEATURES):
        w, g = float(weights[j]), found[f"g{j}"]
        if w:
            gap = abs(g - lam * (alpha * (1 if w > 0 else -1) + (1 - alpha) * w / found.sd))
        else:
            gap = max(0.0, abs(g) - lam * alpha)
        out.append((name, float(scaler.mean[j]), float(scaler.std[j]), gap <= OPTIMALITY_TOLERANCE * found.sd))
    return spark.createDataFrame(out, "FEATURE string, MEAN double, STD double, OPTIMAL boolean")


# -- coverage and the whole job over a landed table ---------------------------------------

@register("forecast_coverage", with_ctes("obs", "max_year") + """
SELECT count(*) AS N_GROUPS, count(*) FILTER (WHERE last >= MAX_YEAR - 5) AS N_RECENT,
       count(*) FILTER (WHERE last < MAX_YEAR - 5) AS N_WITHOUT_RECENT
FROM (SELECT STATION, max("YEAR") AS last FROM obs GROUP BY STATION) s CROSS JOIN max_year""")
def _q(spark, d):
    return rollups.lookback_coverage(frames(spark, d).obs, by=["STATION"])


@register("landed_analysis", with_ctes("obs", "yearly_since_1950", "clim") + """
SELECT 'yearly_mean' AS SECTION, cast("YEAR" AS varchar) AS ITEM, avg(TAVG) AS VALUE FROM obs GROUP BY "YEAR"
UNION ALL SELECT 'decade_mean', cast("DECADE" AS varchar), avg(TAVG) FROM obs GROUP BY "DECADE"
UNION ALL SELECT 'yearly_precip', cast("YEAR" AS varchar), sum(PRCP) FROM obs GROUP BY "YEAR"
UNION ALL SELECT 'climatology', cast("MONTH" AS varchar), AVG_TAVG FROM clim
UNION ALL SELECT 'trend', 'slope', regr_slope(AVG_TEMP, "YEAR") FROM yearly_since_1950""", "VALUE")
def _q(spark, d):
    """Land the observations by year on the shared folder, then summaries
    over pruned scans of the landed table."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/observations-{uuid.uuid4().hex}"
    land_observations(raw_observations(spark, d), path)
    obs = Frames(read_landed(spark, path)).obs
    part = lambda df, section, item, value: df.select(
        F.lit(section).alias("SECTION"), item.cast("string").alias("ITEM"), F.col(value).cast("double").alias("VALUE"))
    return (part(rollups.yearly_mean(obs), "yearly_mean", F.col("YEAR"), "AVG_TAVG")
            .union(part(rollups.decade_mean(obs), "decade_mean", F.col("DECADE"), "AVG_TAVG"))
            .union(part(rollups.yearly_precip(obs), "yearly_precip", F.col("YEAR"), "ANNUAL_PRECIP"))
            .union(part(rollups.climatology(obs), "climatology", F.col("MONTH"), "AVG_TAVG"))
            .union(part(trends.trend_assessment(obs, TREND_START), "trend", F.lit("slope"), "SLOPE")))


# -- stored partial states beside the landed rows ------------------------------------------

def landed_with_states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """(landed observations, their states, the landing's counts) in the shared folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    counts = land_with_states(spark, raw_observations(spark, sf_dir), f"{path}/rows", f"{path}/states")
    return read_landed(spark, f"{path}/rows"), states.read_states(spark, f"{path}/states"), counts


def same_as(name: str) -> dict:
    return {"sql": REGISTRY[name].sql, "doubles": " ".join(REGISTRY[name].doubles)}


@register("state_rollup", **same_as("rollup_all"))
def _q(spark, d):
    return states.rollup_states(landed_with_states(spark, d)[1])


@register("state_overview", **same_as("dataset_overview"))
def _q(spark, d):
    return states.overview(landed_with_states(spark, d)[1])


@register("state_climatology", **same_as("climatology"))
def _q(spark, d):
    return rollups.climatology(landed_with_states(spark, d)[1])


@register("state_baseline", **same_as("recent_baseline"))
def _q(spark, d):
    return rollups.recent_baseline(landed_with_states(spark, d)[1])


@register("state_forecast_grid", **same_as("forecast_grid"))
def _q(spark, d):
    return forecasting.forecast_grid(landed_with_states(spark, d)[1])


@register("landed_histogram", **same_as("value_histogram"))
def _q(spark, d):
    rows, kept, _ = landed_with_states(spark, d)
    return distributions.histogram(Frames(rows).obs, "TAVG", 50, ranges=states.value_ranges(kept))


@register("landed_shift", **same_as("distribution_shift"))
def _q(spark, d):
    rows, kept, _ = landed_with_states(spark, d)
    return distributions.distribution_shift(Frames(rows).obs, "TAVG", 40, TEST_EARLY_END, TEST_LATE_START, states=kept)


@register("landing_counts", with_ctes("raw_obs") + """
SELECT count(*) AS RAW_ROWS, count(*) FILTER (WHERE "DATE" IS NOT NULL AND TAVG IS NOT NULL
       AND LATITUDE IS NOT NULL AND LONGITUDE IS NOT NULL) AS CLEAN_ROWS FROM raw_obs""")
def _q(spark, d):
    """A12 as the landing job observed it, next to no reading of rows."""
    counts = landed_with_states(spark, d)[2]
    return spark.createDataFrame([(counts["RAW_ROWS"], counts["CLEAN_ROWS"])], "RAW_ROWS long, CLEAN_ROWS long")


@register("relation_density", with_ctes("obs").rstrip("\n") + """, r AS (
  SELECT count(*) AS n, min(PRCP) AS xl, max(PRCP) AS xh, min(TAVG) AS yl, max(TAVG) AS yh FROM obs
), w AS (SELECT *, (xh - xl) / 40.0 AS xw, (yh - yl) / 40.0 AS yw FROM r)
SELECT X_BIN, Y_BIN, xl + X_BIN * xw AS X_LO, yl + Y_BIN * yw AS Y_LO, count(*) AS COUNT, count(*) / (n * xw * yw) AS DENSITY
FROM (SELECT w.*, cast(least(floor((PRCP - xl) / xw), 39) AS integer) AS X_BIN,
             cast(least(floor((TAVG - yl) / yw), 39) AS integer) AS Y_BIN FROM obs CROSS JOIN w) b
GROUP BY X_BIN, Y_BIN, xl, yl, xw, yw, n""", "X_LO Y_LO DENSITY")
def _q(spark, d):
    return distributions.relation_density(frames(spark, d).obs)


@register("station_estimates", with_ctes("obs") + """
SELECT "YEAR", count(DISTINCT STATION) AS STATIONS, count(*) AS N_ROWS, TRUE AS WITHIN_BOUND
FROM obs GROUP BY GROUPING SETS (("YEAR"), ())""")
def _q(spark, d):
    """A11 from stored sketches, by year and over all: beside the exact count,
    whether the estimate is within four standard errors (and one station) of it."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sketches-{uuid.uuid4().hex}"
    raw = raw_observations(spark, d)
    states.land_sketches(raw, path)
    kept = states.read_states(spark, path)
    every = states.distinct_stations(kept, by=[]).withColumn("YEAR", F.lit(None).cast("int"))
    found = states.distinct_stations(kept).unionByName(every).withColumnRenamed("STATIONS", "estimate")
    exact = Frames(raw).obs.groupingSets([["YEAR"], []], "YEAR").agg(F.countDistinct("STATION").alias("STATIONS")).withColumnRenamed("YEAR", "_y")
    bound = 1 + F.col("STATIONS") * (4 * 1.04 / 2 ** (states.SKETCH_PRECISION / 2))
    return (found.join(exact, F.col("YEAR").eqNullSafe(F.col("_y")))
            .select("YEAR", "STATIONS", "N_ROWS", (F.abs(F.col("estimate") - F.col("STATIONS")) <= bound).alias("WITHIN_BOUND")))
