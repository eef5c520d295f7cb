"""Property tests on random small inputs (hypothesis)."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from obs_analytics.operators import distributions, metrics
from obs_analytics.operators.sampling import hash_split
from obs_analytics.operators.windows import trailing_mean, trailing_mean_days

D0 = dt.date(2000, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

series = st.lists(
    st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 400),
              st.one_of(st.none(), st.integers(-100, 100))),
    min_size=1, max_size=120)


def _frame(spark, rows):
    seen, out = set(), []
    for s, d, v in rows:  # one row per (station, day)
        if (s, d) not in seen:
            seen.add((s, d))
            out.append((s, D0 + dt.timedelta(days=d), None if v is None else float(v)))
    return spark.createDataFrame(out, "STATION string, DATE date, TAVG double")


def _brute_rows(rows, by_station, frame=30):
    """Trailing mean by brute force over the sorted list."""
    import collections
    groups = collections.defaultdict(list)
    for s, d, v in rows:
        groups[s if by_station else ""].append((d, s, v))
    out = {}
    for g in groups.values():
        g.sort()
        for i, (d, s, v) in enumerate(g):
            vals = [x[2] for x in g[max(0, i - frame): i + 1] if x[2] is not None]
            out[(s, d)] = sum(vals) / len(vals) if vals else None
    return out


@SETTINGS
@given(series, st.booleans())
def test_trailing_mean_matches_brute_force(spark, rows, by_station):
    df = _frame(spark, rows)
    local = [(r.STATION, r.DATE, r.TAVG) for r in df.collect()]
    want = _brute_rows(local, by_station)
    by, tb = (["STATION"], []) if by_station else ([], ["STATION"])
    for strategy in ["partition", "blocked"]:
        got = {(r.STATION, r.DATE): r.TAVG_30DAY_AVG for r in trailing_mean(
            df, by=by, tiebreak=tb, strategy=strategy, bucket_days=3, block_rows=37).collect()}
        assert got.keys() == want.keys()
        for k, v in want.items():
            assert (got[k] is None and v is None) or got[k] == pytest.approx(v)


@SETTINGS
@given(series)
def test_days_window_matches_brute_force(spark, rows):
    df = _frame(spark, rows)
    local = [(r.STATION, r.DATE, r.TAVG) for r in df.collect()]
    got = {(r.STATION, r.DATE): r.TAVG_30D_MEAN
           for r in trailing_mean_days(df, block_days=40).collect()}
    for s, d, _ in local:
        vals = [v for s2, d2, v in local if s2 == s and 0 <= (d - d2).days <= 29 and v is not None]
        want = sum(vals) / len(vals) if vals else None
        assert (got[(s, d)] is None and want is None) or got[(s, d)] == pytest.approx(want)


@SETTINGS
@given(st.lists(st.floats(-50, 60, allow_nan=False), min_size=1, max_size=80), st.integers(1, 12))
def test_histogram_counts_and_density(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "TAVG double")
    h = distributions.histogram(df, "TAVG", bins, density=True).collect()
    assert len(h) == bins
    assert sum(r.COUNT for r in h) == len(values)
    assert sum(r.DENSITY * (r.BIN_HI - r.BIN_LO) for r in h) == pytest.approx(1.0)


@SETTINGS
@given(st.lists(st.tuples(st.floats(-10, 50, allow_nan=False), st.floats(-10, 50, allow_nan=False)),
                min_size=1, max_size=60))
def test_weighted_recall_is_accuracy(spark, pairs):
    df = spark.createDataFrame([("m", y, p) for y, p in pairs], "MODEL string, TAVG double, prediction double")
    c = metrics.class_metrics(df).first()
    assert c.RECALL == pytest.approx(c.ACCURACY)
    pc = metrics.class_metrics_per_class(df).collect()
    assert sum(r.SUPPORT for r in pc) == len(pairs) == sum(r.PREDICTED for r in pc)


@SETTINGS
@given(series, st.integers(1, 16))
def test_split_is_disjoint_complete_and_layout_free(spark, rows, parts):
    df = _frame(spark, rows)
    a = {tuple(r) for r in hash_split(df).select("STATION", "DATE", "IS_TRAIN").collect()}
    b = {tuple(r) for r in hash_split(df.repartition(parts)).select("STATION", "DATE", "IS_TRAIN").collect()}
    assert a == b and len(a) == df.count()


def test_daily_sums_slide_as_rows_do(spark):
    """W3 over daily partials equals the plain window, ungrouped and by
    station: repeated days, gaps, block borders, null values, days and stations."""
    import datetime
    import random
    rnd = random.Random(7)
    rows = [(rnd.choice(["A", "B", None]), datetime.date(1999, 1, 1) + datetime.timedelta(days=rnd.choice([rnd.randrange(60), rnd.randrange(900)])) if rnd.random() > 0.02 else None,
             rnd.choice([None, float(rnd.randrange(-300, 300))]), i) for i in range(1500)]
    df = spark.createDataFrame(rows, "STATION string, DATE date, TAVG double, i int").repartition(5)
    for by in ([], ["STATION"]):
        want = {r.i: r.TAVG_30D_MEAN for r in trailing_mean_days(df, by=by, strategy="partition").collect()}
        for block in (31, 366):
            found = trailing_mean_days(df, by=by, strategy="daily", block_days=block)
            assert found.columns == [*df.columns, "TAVG_30D_MEAN"]
            got = {r.i: r.TAVG_30D_MEAN for r in found.collect()}
            assert got.keys() == want.keys()
            assert all((got[i] is None) == (want[i] is None) and (want[i] is None or abs(got[i] - want[i]) < 1e-9) for i in want)
    assert trailing_mean_days(df.limit(0), by=[]).count() == 0
