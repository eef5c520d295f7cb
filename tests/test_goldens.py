"""Golden values of FIXTURES.md F9, computed with the library functions."""

import pytest
from pyspark.sql import functions as F

from obs_analytics.operators import metrics, rollups, trends
from obs_analytics.operators.cleaning import prepare_observations
from obs_analytics.operators.windows import trailing_mean
from obs_analytics.plans.frames import Frames
from obs_analytics.sources.testdata import raw_observations

from .conftest import SF001, SF01


@pytest.fixture(scope="module")
def f001(spark):
    return Frames(raw_observations(spark, SF001))


def test_counts(f001):
    raw = f001.raw
    assert raw.count() == 5334
    assert raw.select("STATION").distinct().count() == 10
    r = raw.agg(*[F.count(c).alias(c) for c in ["TAVG", "TMAX", "TMIN", "PRCP", "LATITUDE", "ELEVATION"]]).first()
    assert (r.TAVG, r.TMAX, r.TMIN) == (5008, 4843, 4916)
    assert (r.PRCP, r.LATITUDE, r.ELEVATION) == (4541, 4832, 4832)
    assert f001.obs.count() == 4543


def test_feature_sums(f001):
    r = f001.features.agg(F.sum("TAVG_30DAY_AVG").alias("w"), F.sum("TEMP_RANGE").alias("r")).first()
    assert round(r.w, 4) == pytest.approx(120246.6411, abs=1e-4)
    assert r.r == pytest.approx(42980)


def test_trend_and_stats(f001):
    t = trends.trend_assessment(f001.obs).first()
    assert t.SLOPE == pytest.approx(0.295134, abs=1e-6)
    assert t.INTERCEPT == pytest.approx(-563.1571, abs=1e-4)
    assert t.TREND == "significant warming"
    s = rollups.value_stats(f001.obs).first()
    assert (s.MEAN_TEMP, s.STD_TEMP) == (pytest.approx(26.499009, abs=1e-6), pytest.approx(14.48908, abs=1e-5))
    assert (s.MIN_TEMP, s.MAX_TEMP) == (1, 50)
    d = {r.DECADE: r for r in f001.obs.groupBy("DECADE").agg(F.avg("TAVG").alias("m"), F.count(F.lit(1)).alias("n")).collect()}
    assert d[1990].m == pytest.approx(26.232348, abs=1e-6) and d[1990].n == 3314
    assert d[2000].m == pytest.approx(27.218063, abs=1e-6) and d[2000].n == 1229


def test_recent_baseline(f001):
    b = rollups.recent_baseline(f001.obs).first()
    assert b.LAT == pytest.approx(35.249807, abs=1e-6)
    assert b.PRCP_MEAN == pytest.approx(8.899666, abs=1e-6)
    assert b.N_ROWS == 3891


def _midrange_all(frames):
    return frames.model_rows.select(F.lit("m").alias("MODEL"), "TAVG",
                                    ((F.col("TMAX") + F.col("TMIN")) / 2).alias("prediction"))


def test_standin_metrics(f001):
    scored = _midrange_all(f001)
    r = metrics.regression_metrics(scored).first()
    assert r.N_ROWS == 4543
    assert r.RMSE == pytest.approx(1.79226, abs=1e-5)
    assert r.MAE == pytest.approx(1.449483, abs=1e-6)
    assert r.R2 == pytest.approx(0.984696, abs=1e-6)
    assert r.MAPE == pytest.approx(12.758512, abs=1e-6)
    assert r.TOLERANCE_ACCURACY == pytest.approx(78.4063, abs=1e-4)
    assert metrics.confusion_counts(scored).count() == 16


def test_class_metrics_sf001_all_rows(spark):
    # FIXTURES F9: class metrics of the stand-in over all 47,717 rows at sf0.01
    obs = prepare_observations(raw_observations(spark, SF01))
    scored = obs.select(F.lit("m").alias("MODEL"), "TAVG",
                        ((F.col("TMAX") + F.col("TMIN")) / 2).alias("prediction"))
    c = metrics.class_metrics(scored).first()
    assert c.ACCURACY == pytest.approx(0.845087, abs=1e-6)
    assert c.PRECISION == pytest.approx(0.845389, abs=1e-6)
    assert c.RECALL == pytest.approx(c.ACCURACY, abs=1e-12)
    assert c.F1 == pytest.approx(0.844889, abs=1e-6)
    pc = {r.CLASS: r for r in metrics.class_metrics_per_class(scored).collect()}
    assert pc[0].PRECISION == pytest.approx(0.971149, abs=1e-6)
    assert pc[5].RECALL == pytest.approx(0.972734, abs=1e-6)
    assert pc[3].SUPPORT == 4912


def test_slope_signs_across_scales(spark):
    obs = prepare_observations(raw_observations(spark, SF01))
    t = trends.trend_assessment(obs).first()
    assert t.SLOPE == pytest.approx(-0.092736, abs=1e-6) and t.TREND == "cooling"


def test_window_strategies_agree(f001):
    obs = f001.obs
    a = trailing_mean(obs, strategy="partition").select("STATION", "DATE", F.col("TAVG_30DAY_AVG").alias("a"))
    b = trailing_mean(obs, strategy="blocked", bucket_days=7, block_rows=45).select(
        "STATION", "DATE", F.col("TAVG_30DAY_AVG").alias("b"))
    j = a.join(b, ["STATION", "DATE"])
    assert j.count() == obs.count()
    assert j.filter(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0
