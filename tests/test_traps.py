"""Unit tests on hand-made frames: each semantic trap and corner case."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from obs_analytics.functions.calendar import day_of_year_mid_month, decade_of, season_of
from obs_analytics.functions.classes import value_class
from obs_analytics.functions.labels import trend_label
from obs_analytics.operators import cleaning, distributions, forecasting, metrics, rollups, trends
from obs_analytics.operators.cleaning import prepare_observations
from obs_analytics.operators.sampling import hash_split
from obs_analytics.operators.windows import trailing_mean, trailing_mean_days
from obs_analytics.schema import RAW_SCHEMA

D0 = dt.date(2000, 1, 1)


def _raw(spark, rows):
    """rows: (station, date, tavg_tenths, tmax, tmin, prcp, elevation)"""
    full = [(s, d, 25.0, 55.0, 100.0, "N", p, None, x, None, n, None, t, None)
            for s, d, t, x, n, p, *_ in rows]
    return spark.createDataFrame(full, RAW_SCHEMA)


def _series(spark, station, days, start=D0, value=lambda i: float(i)):
    return [(station, start + dt.timedelta(days=d), value(i) * 10, None, None, None, 1.0)
            for i, d in enumerate(days)]


# ROWS frame of 31 rows (current row included) vs a 30-day RANGE frame
def test_trailing_rows_vs_days(spark):
    days = list(range(35)) + list(range(95, 100))  # 60-day gap after day 34
    obs = prepare_observations(_raw(spark, _series(spark, "A", days)))
    rows = {r.DATE: r for r in trailing_mean_days(trailing_mean(obs), days=30).collect()}
    first = rows[D0]
    assert first.TAVG_30DAY_AVG == 0.0  # short frame at the start: just the row
    d30 = rows[D0 + dt.timedelta(days=30)]
    assert d30.TAVG_30DAY_AVG == pytest.approx(sum(range(31)) / 31)  # 31 rows
    after_gap = rows[D0 + dt.timedelta(days=95)]  # 35th row, index 35
    assert after_gap.TAVG_30DAY_AVG == pytest.approx(sum(range(5, 36)) / 31)  # reaches over the gap
    assert after_gap.TAVG_30D_MEAN == pytest.approx(35.0)  # days frame does not


def test_trailing_groups_and_global(spark):
    rows = _series(spark, "A", range(40)) + _series(spark, "B", range(40), value=lambda i: 100.0)
    obs = prepare_observations(_raw(spark, rows))
    per = {(r.STATION, r.DATE): r.TAVG_30DAY_AVG for r in trailing_mean(obs).collect()}
    assert per[("B", D0 + dt.timedelta(days=39))] == pytest.approx(100.0)
    glob = {(r.STATION, r.DATE): r.TAVG_30DAY_AVG for r in
            trailing_mean(obs, by=[], tiebreak=["STATION"], block_rows=32).collect()}
    # global order (DATE, STATION): on day 0 A then B
    assert glob[("B", D0)] == pytest.approx((0 + 100) / 2)
    for strategy in ["partition", "blocked"]:
        few = prepare_observations(_raw(spark, _series(spark, "C", range(10))))
        vals = [r.TAVG_30DAY_AVG for r in trailing_mean(few, strategy=strategy).orderBy("DATE").collect()]
        assert vals[-1] == pytest.approx(4.5)  # fewer than 31 rows


def test_blocked_matches_partition_on_hot_group(spark):
    # one station with many rows per bucket and several blocks, plus ties broken by STATION
    rows = _series(spark, "HOT", range(0, 900), value=lambda i: float((i * 37) % 101))
    rows += _series(spark, "COLD", range(0, 900, 3), value=lambda i: float(i % 7))
    obs = prepare_observations(_raw(spark, rows))
    for by, tb in [(["STATION"], []), ([], ["STATION"])]:
        a = trailing_mean(obs, by=by, tiebreak=tb, strategy="partition").select(
            "STATION", "DATE", F.col("TAVG_30DAY_AVG").alias("a"))
        b = trailing_mean(obs, by=by, tiebreak=tb, strategy="blocked", bucket_days=5,
                          block_rows=64).select("STATION", "DATE", F.col("TAVG_30DAY_AVG").alias("b"))
        j = a.join(b, ["STATION", "DATE"])
        assert j.count() == obs.count()
        assert j.filter(F.abs(F.col("a") - F.col("b")) > 1e-9).count() == 0


# A declared schema must not be applied by position
def test_csv_header_by_name(spark, tmp_path):
    p = tmp_path / "obs.csv"
    header = [f.name for f in RAW_SCHEMA.fields]
    swapped = header[:]
    swapped[8], swapped[10] = swapped[10], swapped[8]  # TMAX <-> TMIN
    line = {"STATION": "S1", "DATE": "2001-02-03", "LATITUDE": "1", "LONGITUDE": "2", "ELEVATION": "3",
            "NAME": '"Some, Place"', "PRCP": "4", "TMAX": "300", "TMIN": "100", "TAVG": "200"}
    p.write_text(" , ".join(swapped) + "\n" + ", ".join(line.get(c, "") for c in swapped) + "\n")
    from obs_analytics.sources.observations import read_observations
    r = read_observations(spark, str(p)).first()
    assert (r.TMAX, r.TMIN, r.TAVG) == (300.0, 100.0, 200.0)
    assert r.NAME == "Some, Place" and r.DATE == dt.date(2001, 2, 3)


def test_csv_dirty_rows(spark, tmp_path):
    from obs_analytics.sources.observations import read_observations
    p = tmp_path / "dirty.csv"
    header = ",".join(f.name for f in RAW_SCHEMA.fields)
    good = "S1,2001-02-03,1,2,3,X,4,,300,,100,,200,"
    bad_num = "S1,2001-02-04,1,2,3,X,4,,abc,,100,,200,"
    bad_date = "S1,2001-13-45,1,2,3,X,4,,300,,100,,200,"
    short = "S1,2001-02-05,1,2"
    p.write_text("\n".join([header, good, bad_num, bad_date, short]) + "\n")
    df = read_observations(spark, str(p), keep_bad_rows=True)
    rows = df.collect()
    assert len(rows) == 4  # nothing silently dropped
    assert sum(r._corrupt_record is not None for r in rows) >= 2
    assert [r for r in rows if r.DATE == dt.date(2001, 2, 3)][0].TMAX == 300.0
    missing = tmp_path / "missing.csv"
    missing.write_text("STATION,DATE\nS1,2001-01-01\n")
    with pytest.raises(ValueError):
        read_observations(spark, str(missing))


# Right-closed bins
def test_value_class_edges(spark):
    vals = [15.0, 15.0001, 20.0, 25.0, 30.0, 35.0, 35.0001, -5.0, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.c for r in df.select(value_class("v").alias("c")).collect()]
    assert got == [0, 1, 1, 2, 3, 4, 5, 0, None, None]


# X4 and calendar
def test_decade_season_leap(spark):
    df = spark.createDataFrame([(y,) for y in [1989, 1990, 1999, 2000]], "y int")
    assert [r.d for r in df.select(decade_of("y").alias("d")).collect()] == [1980, 1990, 1990, 2000]
    m = spark.createDataFrame([(i,) for i in range(1, 13)], "m int")
    assert [r.s for r in m.select(season_of("m").alias("s")).collect()] == [0, 0, 1, 1, 1, 2, 2, 2, 3, 3, 3, 0]
    dd = spark.createDataFrame([(2024, 3), (2023, 3), (2024, 2)], "y int, m int")
    assert [r.d for r in dd.select(day_of_year_mid_month("y", "m").alias("d")).collect()] == [75, 74, 46]
    leap = spark.createDataFrame([(dt.date(2024, 2, 29),)], "d date")
    assert leap.select(F.dayofyear("d")).first()[0] == 60


# Null checks keep NaN, dropna / fillna do not
def test_nan_semantics(spark):
    rows = [("A", D0, float("nan"), None, None, float("nan"), 1.0),
            ("A", D0 + dt.timedelta(days=1), 100.0, None, 150.0, None, 1.0)]
    raw = _raw(spark, rows)
    assert cleaning.drop_incomplete(raw).count() == 2
    obs = prepare_observations(raw)
    got = {r.DATE: r for r in obs.collect()}
    assert got[D0].PRCP == 0.0  # NaN filled like null
    assert got[D0 + dt.timedelta(days=1)].TMAX == 15.0 and got[D0 + dt.timedelta(days=1)].TMIN == 15.0
    assert cleaning.model_rows(trailing_mean(obs)).count() == 0  # NaN label / NaN window mean


def test_impute(spark):
    rows = [("A", D0, 200.0, None, None, None, 1.0), ("A", D0 + dt.timedelta(days=1), 200.0, 300.0, None, 5.0, 1.0),
            ("A", D0 + dt.timedelta(days=2), 200.0, None, 100.0, 5.0, 1.0)]
    got = sorted(prepare_observations(_raw(spark, rows)).collect(), key=lambda r: r.DATE)
    assert [(r.TMAX, r.TMIN, r.TEMP_RANGE, r.PRCP) for r in got] == [
        (25.0, 15.0, 10.0, 0.0), (30.0, 15.0, 15.0, 0.5), (25.0, 10.0, 15.0, 0.5)]


# The split does not depend on layout
def test_split_layout_independent(spark):
    rows = _series(spark, "A", range(300)) + _series(spark, "B", range(300))
    obs = prepare_observations(_raw(spark, rows))
    sets = []
    for n in [1, 4, 16]:
        s = hash_split(obs.repartition(n)).filter("IS_TRAIN").select("STATION", "DATE").collect()
        sets.append({tuple(r) for r in s})
    assert sets[0] == sets[1] == sets[2]
    assert 0.7 < len(sets[0]) / 600 < 0.9


# X7, X8, X15 and metric corner cases
def test_metric_corners(spark):
    def run(pairs, **kw):
        df = spark.createDataFrame([("m", float(y), float(p)) for y, p in pairs], "MODEL string, TAVG double, prediction double")
        return metrics.regression_metrics(df, **kw).first(), metrics.class_metrics(df).first()
    r, c = run([(10, 10), (20, 20), (30, 30)])
    assert (r.RMSE, r.R2, r.MAPE, c.ACCURACY, c.F1) == (0.0, 1.0, 0.0, 1.0, 1.0)
    assert r.ADJ_R2 is None or r.N_ROWS - 12 - 1 != 0
    r, _ = run([(0.0, 1.0), (10, 10)])  # label exactly 0: no error, a huge MAPE
    assert r.MAPE > 1e9
    r, _ = run([(5, 5), (5, 5)])
    assert r.R2 == 1.0
    r, _ = run([(5, 4), (5, 6)])
    assert r.R2 == 0.0
    r, _ = run([(1, 0), (1, 4), (1, 3)])  # errors 1, 3 and exactly 2 (inclusive)
    assert r.TOLERANCE_ACCURACY == pytest.approx(200 / 3)
    r, _ = run([(i, i + 1) for i in range(13)], n_features=12)
    assert r.ADJ_R2 is None  # n - k - 1 = 0
    # a class predicted but never true has weight 0; a class true but never predicted precision 0
    df = spark.createDataFrame([("m", 10.0, 40.0), ("m", 10.0, 10.0), ("m", 22.0, 10.0)],
                               "MODEL string, TAVG double, prediction double")
    pc = {r.CLASS: r for r in metrics.class_metrics_per_class(df).collect()}
    assert len(pc) == 6
    assert pc[5].SUPPORT == 0 and pc[5].PREDICTED == 1 and pc[5].PRECISION == 0.0
    assert pc[2].PRECISION == 0.0 and pc[2].RECALL == 0.0 and pc[2].SUPPORT == 1
    c = metrics.class_metrics(df).first()
    assert c.ACCURACY == pytest.approx(1 / 3)
    assert c.RECALL == pytest.approx(c.ACCURACY)


def test_best_model_first_wins_ties(spark):
    cmp = spark.createDataFrame([("A", 1, 0.9, 0.5, 0.5), ("B", 2, 0.9, 0.7, 0.5), ("C", 3, 0.8, 0.7, 0.6)],
                                "MODEL string, MODEL_ORDER int, R2 double, ACCURACY double, F1 double")
    assert metrics.best_model(cmp).first().BEST_MODEL == "A"
    best = {r.METRIC: r.BEST_MODEL for r in metrics.best_by_metric(cmp).collect()}
    assert best == {"R2": "A", "ACCURACY": "B", "F1": "C"}


# X10 and trend corners
def test_trend_corners(spark):
    def obs_for(years, value):
        rows = [("A", dt.date(y, 6, 1), float(value(y) * 10), None, None, None, 1.0) for y in years]
        return prepare_observations(_raw(spark, rows))
    t = trends.trend_assessment(obs_for(range(1990, 2000), lambda y: 2 * (y - 1990) + 1)).first()
    assert t.SLOPE == pytest.approx(2.0) and t.INTERCEPT == pytest.approx(-3979.0)
    assert t.CHANGE_10Y == pytest.approx(20.0) and t.TREND == "significant warming"
    assert trends.trend_assessment(obs_for([1995], lambda y: 1)).count() == 0
    flat = trends.trend_assessment(obs_for(range(1990, 1995), lambda y: 3)).first()
    assert flat.SLOPE == 0.0 and flat.TREND == "cooling"
    lab = spark.createDataFrame([(0.02,), (0.005,), (0.0,), (-1.0,)], "s double")
    assert [r.t for r in lab.select(trend_label("s").alias("t")).collect()] == [
        "significant warming", "moderate warming", "cooling", "cooling"]
    pts = spark.createDataFrame([(y, 0.5 * y + 3.0 + (1 if y % 2 else -1)) for y in range(2000, 2010)],
                                "YEAR int, AVG_TEMP double")
    fitted = trends.trend_line(pts, trends.linear_trend(pts))
    resid = fitted.select("YEAR", (F.col("AVG_TEMP") - F.col("FITTED")).alias("AVG_TEMP"))
    assert trends.linear_trend(resid).first().SLOPE == pytest.approx(0.0, abs=1e-9)


# histogram corners and properties
def test_histogram(spark):
    same = spark.createDataFrame([(7.0,)] * 5, "TAVG double")
    h = distributions.histogram(same, "TAVG", 50).collect()
    assert len(h) == 50 and h[25].COUNT == 5 and h[0].BIN_LO == 6.5 and h[-1].BIN_HI == 7.5
    vals = spark.createDataFrame([(0.0,), (10.0,), (5.0,)], "TAVG double")
    h = distributions.histogram(vals, "TAVG", 4, density=True).collect()
    assert [r.COUNT for r in h] == [1, 0, 1, 1]  # 10.0 on the max goes to the last bin
    assert sum(r.DENSITY * (r.BIN_HI - r.BIN_LO) for r in h) == pytest.approx(1.0)
    many = distributions.histogram(vals, "TAVG", 10).collect()
    assert len(many) == 10 and sum(r.COUNT for r in many) == 3


# Missing month and missing season
def test_forecast_missing_month_and_seasons(spark):
    rows = [("A", dt.date(y, m, 10), 200.0 + m, 250.0, 150.0, 1.0, 5.0)
            for y in (2000, 2001) for m in range(1, 12)]  # no December
    obs = prepare_observations(_raw(spark, rows))
    grid = forecasting.forecast_grid(obs, future_years=2)
    assert grid.count() == 24
    dec = grid.filter("MONTH = 12").collect()
    assert all(r.TMAX is None for r in dec)
    from obs_analytics.operators.modeling import midrange_predictor
    pred = forecasting.forecast(grid, midrange_predictor())
    assert pred.count() == 22
    first = grid.orderBy("YEAR", "MONTH").first()
    assert first.YEAR == 2002 and first.DAY_OF_YEAR == 15
    leap = grid.filter("YEAR = 2004 AND MONTH = 3").collect()
    assert leap == [] or leap[0].DAY_OF_YEAR == 75
    winter_only = prepare_observations(_raw(spark, [("A", dt.date(2000, 1, d), 100.0, None, None, None, 1.0)
                                                    for d in range(1, 4)]))
    sr = rollups.season_range(winter_only).collect()
    assert [r.SEASON_NAME for r in sr] == ["Winter", "Spring", "Summer", "Fall"]
    assert sr[0].AVG_RANGE == 10.0 and sr[1].AVG_RANGE is None and sr[1].N_ROWS == 0


def test_rollup_all_equals_single_rollups(spark):
    rows = _series(spark, "A", range(0, 800, 3), value=lambda i: float(i % 40))
    obs = prepare_observations(_raw(spark, rows))
    allr = rollups.rollup_all(obs)
    y = {r.YEAR: r.AVG_TAVG for r in allr.filter("LEVEL = 'year'").collect()}
    assert y == pytest.approx({r.YEAR: r.AVG_TAVG for r in rollups.yearly_mean(obs).collect()})
    tot = allr.filter("LEVEL = 'all'").first()
    assert tot.N_ROWS == obs.count()
    seasons = allr.filter("LEVEL = 'season'").agg(F.sum("N_ROWS")).first()[0]
    assert seasons == obs.count()


# X13 option: leave the current row out of the trailing frame
def test_trailing_exclude_current(spark):
    obs = prepare_observations(_raw(spark, _series(spark, "A", range(40))))
    for strategy in ["partition", "blocked"]:
        got = {r.DATE: r.TAVG_30DAY_AVG for r in trailing_mean(
            obs, strategy=strategy, exclude_current=True, block_rows=33).collect()}
        assert got[D0] is None
        assert got[D0 + dt.timedelta(days=1)] == pytest.approx(0.0)
        assert got[D0 + dt.timedelta(days=39)] == pytest.approx(sum(range(9, 39)) / 30)


# No wildcard import of the functions module anywhere in the library
def test_no_wildcard_function_imports():
    import pathlib
    root = pathlib.Path(__file__).resolve().parents[1] / "obs_analytics"
    for f in root.rglob("*.py"):
        assert "import *" not in f.read_text(), f


def test_overview_variants_and_wide_seasons(spark):
    rows = _series(spark, "A", range(0, 400, 2)) + _series(spark, "B", range(0, 400, 5))
    obs = prepare_observations(_raw(spark, rows))
    exact = rollups.dataset_overview(obs).first()
    approx = rollups.dataset_overview(obs, approximate=True).first()
    assert exact.STATIONS == approx.STATIONS == 2
    wide = {r.YEAR: r for r in rollups.season_year_mean(obs, wide=True).collect()}
    long = {(r.YEAR, r.SEASON): r.SEASONAL_TEMP for r in rollups.season_year_mean(obs).collect()}
    for (y, season), v in long.items():
        assert wide[y][str(season)] == pytest.approx(v)


def test_row_accounting_keeps_incomplete_rows(spark):
    rows = _series(spark, "A", range(50)) + [("A", None, 100.0, None, None, None, 1.0),
                                            ("B", D0, None, None, None, None, 1.0)]
    raw = _raw(spark, rows)
    r = rollups.row_accounting(raw).first()
    assert (r.RAW_ROWS, r.CLEAN_ROWS, r.MODEL_ROWS) == (52, 50, 50)
    assert r.TRAIN_ROWS + r.TEST_ROWS == 50


def test_row_accounting_with_nan_readings(spark):
    """A NaN reading spoils the trailing means of the rows that reach it."""
    rows = _series(spark, "A", range(60)) + _series(spark, "B", range(60))
    raw = _raw(spark, rows).withColumn("TAVG", F.when((F.col("STATION") == "A") & (F.col("DATE") == D0 + dt.timedelta(days=10)),
                                                     F.lit(float("nan"))).otherwise(F.col("TAVG")))
    r = rollups.row_accounting(raw).first()
    want = cleaning.model_rows(trailing_mean(prepare_observations(raw))).count()
    assert r.MODEL_ROWS == want < 120 and r.CLEAN_ROWS == 120


def _scored(spark, rows):
    return spark.createDataFrame(rows, "MODEL string, TAVG double, prediction double")


def test_metrics_over_whole_pairs_only(spark):
    pairs = [("m", float(i), i + 0.5 * (-1) ** i) for i in range(30)]
    gaps = [("m", 1000.0, None), ("m", None, 1.0), ("m", float("nan"), 2.0), ("m", 3.0, float("nan"))]
    whole, both = (metrics.regression_metrics(_scored(spark, x)).first() for x in (pairs, pairs + gaps))
    assert both.N_SKIPPED == 4 and both.N_ROWS == 30 and both.R2 == pytest.approx(whole.R2)
    assert both.ADJ_R2 == pytest.approx(whole.ADJ_R2) and both.MAPE == pytest.approx(whole.MAPE)
    one = metrics.model_comparison(_scored(spark, pairs + gaps), ["m"]).first()
    for c in ("RMSE", "MAE", "R2", "ADJ_R2", "MAPE", "TOLERANCE_ACCURACY"):
        assert one[c] == pytest.approx(whole[c])


def test_one_pass_comparison_equals_the_single_metrics(spark):
    rows = [(m, float(i % 41), float((i * k) % 43)) for k, m in enumerate("abc", 3) for i in range(200)] + [("d", 5.0, 5.0)] * 3
    scored = _scored(spark, rows)
    comparison = {r.MODEL: r for r in metrics.model_comparison(scored, list("abcd")).collect()}
    for r in metrics.regression_metrics(scored).join(metrics.class_metrics(scored), "MODEL").collect():
        for c in ("RMSE", "MAE", "R2", "ADJ_R2", "MAPE", "TOLERANCE_ACCURACY", "ACCURACY", "PRECISION", "RECALL", "F1"):
            assert comparison[r.MODEL][c] == (pytest.approx(r[c]) if r[c] is not None else None), (r.MODEL, c)


def test_nan_never_wins(spark):
    rows = [("a", 1, 0.8, 0.5, 0.4), ("b", 2, float("nan"), float("nan"), None), ("c", 3, 0.9, 0.5, 0.4)]
    table = spark.createDataFrame(rows, "MODEL string, MODEL_ORDER int, R2 double, ACCURACY double, F1 double")
    best = metrics.best_model(table).first()
    assert (best.BEST_MODEL, best.BEST_R2) == ("c", 0.9)
    assert {r.METRIC: r.BEST_MODEL for r in metrics.best_by_metric(table).collect()} == {"R2": "c", "ACCURACY": "a", "F1": "a"}
    none = table.where("MODEL = 'b'")
    assert metrics.best_model(none).first().BEST_MODEL is None


def test_csv_folder_with_three_layouts(spark, tmp_path):
    from obs_analytics.sources.observations import read_observations
    names = [f.name for f in RAW_SCHEMA.fields]
    layouts = [names, names[::-1], ["DATE", "STATION", "LATITUDE", "LONGITUDE", "TAVG", "SNOW"]]
    line = {"STATION": "S", "DATE": "2001-02-03", "LATITUDE": "1", "LONGITUDE": "2", "TAVG": "200", "TMAX": "300", "SNOW": "9"}
    for i, layout in enumerate(layouts):
        rows = [",".join(f'"{c}"' if i == 1 else c for c in layout)] + [",".join({**line, "STATION": f"S{i}"}.get(c, "") for c in layout)] * 2
        (tmp_path / f"{i}.csv").write_text("\n".join(rows) + "\n")
    got = read_observations(spark, str(tmp_path), keep_bad_rows=True)
    assert got.columns[:-1] == names and got.count() == 6
    assert {(r.STATION, r.TAVG, r.TMAX) for r in got.collect()} == {("S0", 200.0, 300.0), ("S1", 200.0, 300.0), ("S2", 200.0, None)}
    assert rollups.row_accounting(got).first().CORRUPT_ROWS == 0
    (tmp_path / "bad.csv").write_text("STATION,DATE,TAVG\nS,2001-01-01,5\n")
    with pytest.raises(ValueError, match="bad.csv"):
        read_observations(spark, str(tmp_path))


def test_global_sequence_cuts_a_busy_day(spark):
    """One day holds most rows: the rank buckets cut it by the tie-break."""
    from obs_analytics.operators.windows import row_rank
    busy = [(f"ST{i:04d}", D0, float(i), None, None, None, 1.0) for i in range(600)] + [(None, D0, 7.0, None, None, None, 1.0)]
    obs = prepare_observations(_raw(spark, busy + _series(spark, "A", range(1, 60))))
    ranked = row_rank(obs, "DATE", [], ["STATION"])
    order = [(r.DATE, r.STATION) for r in ranked.orderBy("_tm_rank").select("DATE", "STATION").collect()]
    assert order == sorted(order, key=lambda r: (r[0], r[1] is not None, r[1] or ""))
    days = obs.groupBy("DATE", F.left("STATION", F.lit(6))).count().agg(F.max("count")).first()[0]
    assert days == 1 and obs.count() == len(order)
    a, b = (trailing_mean(obs, by=[], tiebreak=["STATION"], strategy=s, block_rows=64).select("STATION", "DATE", F.round("TAVG_30DAY_AVG", 9).alias("v"))
            for s in ("partition", "blocked"))
    assert a.exceptAll(b).count() == 0


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_results_do_not_depend_on_the_layout(spark, parts):
    rows = _series(spark, "A", range(0, 800, 3), value=lambda i: float(i % 37)) + _series(spark, "B", range(0, 800, 7))
    obs = prepare_observations(_raw(spark, rows))
    moved = obs.repartition(parts)
    for build in (lambda o: trailing_mean(o).select("STATION", "DATE", "TAVG_30DAY_AVG"),
                  lambda o: trailing_mean(o, by=[], tiebreak=["STATION"]).select("STATION", "DATE", "TAVG_30DAY_AVG"),
                  lambda o: trailing_mean_days(o).select("STATION", "DATE", "TAVG_30D_MEAN"),
                  lambda o: distributions.histogram(o), lambda o: distributions.distribution_shift(o, early_end=2000, late_start=2001),
                  lambda o: forecasting.forecast_grid(o, 2), lambda o: forecasting.forecast_grid(o, 2, by=["STATION"])):
        a, b = (sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in build(o).collect()) for o in (obs, moved))
        assert a == b


def test_unscorable_months_are_counted(spark):
    obs = prepare_observations(_raw(spark, _series(spark, "A", range(60))))  # January and February only
    got = forecasting.unscorable(forecasting.forecast_grid(obs, 3)).first()
    assert (got.N_SCORABLE, got.N_UNSCORABLE) == (6, 30)


def test_training_settings_are_constants(spark):
    from obs_analytics.operators.modeling import regressor, training_frame
    from obs_analytics.schema import FEATURES, MODEL_NAMES, TRAINING_PARTITIONS, TREE_MEMORY_MB
    rows = cleaning.model_rows(trailing_mean(prepare_observations(_raw(spark, _series(spark, "A", range(90))))))
    assert training_frame(rows, FEATURES, checkpoint=False).rdd.getNumPartitions() == TRAINING_PARTITIONS
    assert all(regressor(n).getMaxMemoryInMB() == TREE_MEMORY_MB for n in MODEL_NAMES[1:])
