"""The whole job, sources and sinks, streaming, and model checks."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from obs_analytics.operators import metrics, rollups
from obs_analytics.operators.cleaning import prepare_observations
from obs_analytics.plans.analysis import release, run_analysis
from obs_analytics.schema import MODEL_NAMES, RAW_SCHEMA
from obs_analytics.sources import land_observations, read_landed, write_result
from obs_analytics.sources.testdata import raw_observations

from .conftest import SF001


def test_run_analysis_without_models(spark):
    res = run_analysis(raw_observations(spark, SF001), train=False, early_end=1996, late_start=2000)
    assert res["dataset_overview"].first().TOTAL_RECORDS == 4543
    assert res["trend_assessment"].first().SLOPE == pytest.approx(0.295134, abs=1e-6)
    assert res["distribution_shift"].count() == 80
    assert len(res["value_histogram"].collect()) == 50


def test_run_from_files(spark, tmp_path):
    from obs_analytics.plans.analysis import run_from_files
    raw = raw_observations(spark, SF001)
    raw.coalesce(1).write.option("header", "true").csv(str(tmp_path / "csv"))
    res = run_from_files(spark, str(tmp_path / "csv/*.csv"), str(tmp_path / "table"), train=False,
                         early_end=1996, late_start=2000)
    assert res["dataset_overview"].first().TOTAL_RECORDS == 4543
    assert res["trend_assessment"].first().SLOPE == pytest.approx(0.295134, abs=1e-6)


def test_landing_replaces_only_its_years(spark, tmp_path):
    raw, path = raw_observations(spark, SF001), str(tmp_path / "landed")
    land_observations(raw, path)
    one = raw.where(F.year("DATE") == 1999).limit(5)
    land_observations(one, path)
    years = {r.OBS_YEAR: r["count"] for r in read_landed(spark, path).groupBy("OBS_YEAR").count().collect()}
    want = {r.y: r["count"] for r in raw.groupBy(F.year("DATE").alias("y")).count().collect()}
    assert years == {**want, 1999: 5}
    land_observations(one, path, mode="overwrite")
    assert read_landed(spark, path).count() == 5


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    from obs_analytics.plans.frames import Frames
    path = str(tmp_path_factory.mktemp("landed") / "t")
    land_observations(raw_observations(spark, SF001), path)
    return Frames(read_landed(spark, path))


def _plan(spark, df):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_landed_look_back_prunes_years(spark, landed):
    from obs_analytics.operators import distributions, forecasting
    for df in (rollups.climatology(landed.obs), rollups.recent_baseline(landed.obs), forecasting.forecast_grid(landed.obs)):
        assert any("OBS_YEAR" in line.split("PartitionFilters: ")[1].split("]")[0] and "Subquery" in line
                   for line in _plan(spark, df).splitlines() if "PartitionFilters: [" in line and "PartitionFilters: []" not in line)
    plan = _plan(spark, distributions.distribution_shift(landed.obs, early_end=1996, late_start=2000))
    assert "OBS_YEAR" in plan.split("PartitionFilters: ")[1].split("]")[0] and "PushedFilters" in plan


def test_landed_plans_read_rows_once(spark, landed):
    from obs_analytics.operators.modeling import STANDIN_NAMES, midrange_predictor, score, standin_scores, trailing_predictor
    three = score({"a": midrange_predictor(), "b": trailing_predictor(), "c": midrange_predictor()}, landed.test)
    assert _plan(spark, three).count("FileScan parquet") == _plan(spark, landed.test).count("FileScan parquet")
    windows = _plan(spark, landed.test).count("Window [avg")
    comparison = metrics.model_comparison(standin_scores(landed.test, landed.train), STANDIN_NAMES)
    assert _plan(spark, comparison).count("Window [avg") <= 2 * windows  # the test rows and the month means


def test_no_plan_fires_a_job(spark, landed):
    """Building any plan of the frames runs nothing."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans", "plans")
    try:
        landed.features, landed.model_rows, landed.train, rollups.row_accounting(landed.raw)
        assert not tracker.getJobIdsForGroup("plans")
    finally:
        spark.sparkContext._jsc.sc().clearJobGroup()


def test_models_and_forecast(spark):
    res = run_analysis(raw_observations(spark, SF001), future_years=3)
    try:
        tm = res["_models"]
        cmp = {r.MODEL: r for r in res["model_comparison"].collect()}
        assert set(cmp) == set(MODEL_NAMES)
        test_n = tm.test.count()
        assert all(r.N_ROWS == test_n for r in cmp.values())
        # each model beats predicting the training mean
        mean = tm.frames.train.agg(F.avg("TAVG")).first()[0]
        const = tm.test.select(F.lit("c").alias("MODEL"), "TAVG", F.lit(mean).alias("prediction"))
        base_rmse = metrics.regression_metrics(const).first().RMSE
        assert all(r.RMSE < base_rmse for r in cmp.values())
        # our distributed RMSE / R2 equal Spark ML's evaluator
        lin = tm.scored([MODEL_NAMES[0]])
        ev = RegressionEvaluator(labelCol="TAVG", predictionCol="prediction")
        assert cmp[MODEL_NAMES[0]].RMSE == pytest.approx(ev.evaluate(lin, {ev.metricName: "rmse"}), rel=1e-9)
        assert cmp[MODEL_NAMES[0]].R2 == pytest.approx(ev.evaluate(lin, {ev.metricName: "r2"}), rel=1e-9)
        best = res["best_model"].first().BEST_MODEL
        assert cmp[best].R2 == max(r.R2 for r in cmp.values())
        assert res["forecast"].count() == 36
        assert res["forecast_yearly"].count() == 3
        assert res["model_report"].count() == 1
    finally:
        release(res)


def test_land_and_write(spark, tmp_path):
    raw = raw_observations(spark, SF001)
    land_observations(raw, str(tmp_path / "landed"))
    back = read_landed(spark, str(tmp_path / "landed"))
    assert back.count() == raw.count()
    assert back.drop("OBS_YEAR").schema == RAW_SCHEMA
    recent = rollups.between_years(prepare_observations(back), lo=2000)
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")  # untruncated filter lists
    plan = recent._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "PartitionFilters: [isnotnull(OBS_YEAR" in plan and "(OBS_YEAR" in plan
    assert "GreaterThanOrEqual(DATE" in plan
    assert recent.count() == prepare_observations(raw).filter(F.year("DATE") >= 2000).count()
    out = tmp_path / "yearly"
    write_result(rollups.yearly_mean(prepare_observations(back)), str(out))
    assert spark.read.parquet(str(out)).count() == 7


def test_streaming_rollups_match_batch(spark, tmp_path):
    from obs_analytics.sources.observations import read_observations
    from obs_analytics.streaming import observation_stream, start_rollups, streaming_rollups
    src = tmp_path / "in"
    src.mkdir()
    header = ",".join(f.name for f in RAW_SCHEMA.fields)
    for i, year in enumerate([2000, 2001]):
        lines = [header] + [f"S{s},{year}-0{m}-1{s},1,2,3,N,{m},,{100 + m},,{50 + s},,{80 + m + s}," for s in range(3)
                            for m in range(1, 8)]
        (src / f"part{i}.csv").write_text("\n".join(lines) + "\n")
    stream = observation_stream(spark, str(src))
    q = start_rollups(streaming_rollups(stream), str(tmp_path / "ckpt"), sink="memory", name="obs_rollups_test")
    try:
        q.processAllAvailable()
        got = {r.YEAR: r for r in spark.sql("SELECT * FROM obs_rollups_test").collect()}
    finally:
        q.stop()
    batch = prepare_observations(read_observations(spark, str(src)))
    want = {r.YEAR: r for r in streaming_rollups(batch).collect()}
    assert set(got) == set(want) == {2000, 2001}
    for y in want:
        assert got[y].N_ROWS == want[y].N_ROWS
        assert got[y].AVG_TAVG == pytest.approx(want[y].AVG_TAVG)


def test_linear_model_matches_normal_equations(spark):
    """Assembler + scaler + LinearRegression(regParam=0) predicts what the
    least-squares solution of the normal equations predicts."""
    import numpy as np
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import LinearRegression

    from obs_analytics.operators.modeling import feature_stages
    from obs_analytics.plans.frames import Frames
    feats = ["YEAR", "DAY_OF_YEAR", "LATITUDE", "PRCP", "TMAX"]
    rows = Frames(raw_observations(spark, SF001)).model_rows.select(*feats, "TAVG")
    model = Pipeline(stages=feature_stages(feats) + [LinearRegression(
        featuresCol="scaledFeatures", labelCol="TAVG", regParam=0.0, solver="normal")]).fit(rows)
    out = model.transform(rows).select(*feats, "TAVG", "prediction").collect()
    got = np.array([r.prediction for r in out])
    data = np.array([[float(x) for x in r[:-1]] for r in out])
    X = np.column_stack([data[:, :-1], np.ones(len(data))])
    beta, *_ = np.linalg.lstsq(X, data[:, -1], rcond=None)
    assert np.allclose(got, X @ beta, atol=1e-6)


def test_streaming_rollups_to_parquet(spark, tmp_path):
    from obs_analytics.streaming import observation_stream, start_rollups, streaming_rollups
    src = tmp_path / "in"
    src.mkdir()
    header = ",".join(f.name for f in RAW_SCHEMA.fields)
    lines = [header] + [f"S1,2001-0{m}-15,1,2,3,N,5,,300,,100,,{200 + m}," for m in range(1, 10)]
    (src / "a.csv").write_text("\n".join(lines) + "\n")
    out = tmp_path / "out"
    q = start_rollups(streaming_rollups(observation_stream(spark, str(src)), key="MONTH"),
                      str(tmp_path / "ckpt"), sink="parquet", path=str(out))
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    from obs_analytics.streaming import latest_rollup
    got = {r.MONTH: r for r in latest_rollup(spark, str(out)).collect()}
    assert len(got) == 9 and got[3].AVG_TAVG == pytest.approx(20.3) and got[3].N_ROWS == 1
