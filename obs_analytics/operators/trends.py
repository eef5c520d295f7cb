"""Least-squares trends through yearly means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import trend_label
from ..schema import TREND_START, WARMING_THRESHOLD
from .rollups import yearly_mean_since


def linear_trend(points: DataFrame, x: str = "YEAR", y: str = "AVG_TEMP", by=()) -> DataFrame:
    """Slope and intercept of the least-squares line y = a*x + b, each
    point weighted equally (as a degree-1 polynomial fit of the points)."""
    return points.groupBy(*by).agg(
        F.regr_slope(F.col(y), F.col(x)).alias("SLOPE"),
        F.regr_intercept(F.col(y), F.col(x)).alias("INTERCEPT"),
        F.count(F.col(y)).alias("N_POINTS"))


def trend_line(points: DataFrame, fit: DataFrame, x: str = "YEAR", y: str = "AVG_TEMP",
               by=()) -> DataFrame:
    """The fitted value beside each point. With no group the fit is one
    row and is broadcast; per group it is joined on the group key and AQE
    decides from its measured size."""
    fit = fit.select(*by, "SLOPE", "INTERCEPT")
    joined = points.join(fit, list(by)) if by else points.crossJoin(F.broadcast(fit))
    return joined.select(*by, x, y, (F.col("SLOPE") * F.col(x) + F.col("INTERCEPT")).alias("FITTED"))


def trend_assessment(obs: DataFrame, start: int = TREND_START, by=(),
                     threshold: float = WARMING_THRESHOLD) -> DataFrame:
    """Slope per year since ``start``, projected change over 10 and
    50 years, and the trend label. A group with fewer than two years has no
    slope and gives no row."""
    points = yearly_mean_since(obs, start, by=by)
    fit = linear_trend(points, by=by).filter(F.col("N_POINTS") > 1)
    return fit.select(
        *by, "SLOPE", "INTERCEPT", F.col("N_POINTS").alias("N_YEARS"),
        (F.col("SLOPE") * 10).alias("CHANGE_10Y"),
        (F.col("SLOPE") * 50).alias("CHANGE_50Y"),
        trend_label("SLOPE", threshold).alias("TREND"))
