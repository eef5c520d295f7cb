"""Landing with its observed counts and stored states, and the header source."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from obs_analytics.operators import distributions, forecasting, rollups, states
from obs_analytics.plans.frames import Frames
from obs_analytics.sources import land_observations, land_with_states, raw_observations, read_landed, read_observations
from obs_analytics.sources.headers import BLOCK_BYTES, first_lines
from obs_analytics.sources.observations import file_headers

from .conftest import SF001

HEADER = "STATION,DATE,LATITUDE,LONGITUDE,ELEVATION,NAME,PRCP,PRCP_ATTRIBUTES,TMAX,TMAX_ATTRIBUTES,TMIN,TMIN_ATTRIBUTES,TAVG,TAVG_ATTRIBUTES"


def plan(spark, df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("landed")
    land_with_states(spark, raw_observations(spark, SF001), str(base / "rows"), str(base / "states"))
    return str(base / "rows"), str(base / "states")


def test_summaries_from_states(spark, paths):
    """Every summary equals the one over the rows."""
    kept, obs = states.read_states(spark, paths[1]), Frames(read_landed(spark, paths[0])).obs
    made = states.summaries(kept)
    for name, df in made.items():
        want = getattr(rollups, name)(obs)
        got = [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(want.columns).collect()]
        want = [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in want.collect()]
        assert sorted(got, key=str) == sorted(want, key=str), name


def test_look_back_over_states_reads_no_rows(spark, paths):
    kept = states.read_states(spark, paths[1])
    for df in (rollups.climatology(kept), rollups.recent_baseline(kept), forecasting.forecast_grid(kept), states.rollup_states(kept)):
        assert paths[0] not in plan(spark, df)


def test_landed_histograms_scan_rows_once(spark, paths):
    kept, obs = states.read_states(spark, paths[1]), Frames(read_landed(spark, paths[0])).obs
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        for df in (distributions.histogram(obs, ranges=states.value_ranges(kept)), distributions.distribution_shift(obs, early_end=1996, late_start=2000, states=kept)):
            assert sum(paths[0] in line for line in plan(spark, df).splitlines() if "FileScan" in line) == 1
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def test_landing_again_touches_its_year_only(spark, tmp_path):
    import os
    rows, kept = str(tmp_path / "rows"), str(tmp_path / "states")
    raw = raw_observations(spark, SF001)
    counts = land_with_states(spark, raw, rows, kept)
    assert counts["RAW_ROWS"] == raw.count() and counts["CLEAN_ROWS"] == Frames(raw).obs.count()
    files = lambda: {f"{d}/{f}" for d, _, fs in os.walk(kept) for f in fs if f.endswith(".parquet")}
    before = files()
    other = raw.where(F.year("DATE") == 1999).withColumn("TAVG", F.col("TAVG") + 10)
    land_with_states(spark, other, rows, kept)
    gone, new = before - files(), files() - before
    assert gone and new and all("OBS_YEAR=1999" in f for f in gone | new)
    want = rollups.rollup_all(Frames(read_landed(spark, rows)).obs)
    got = states.rollup_states(states.read_states(spark, kept))
    key = lambda df: sorted(str(tuple(round(x, 6) if isinstance(x, float) else x for x in r)) for r in df.collect())
    assert key(got) == key(want)
    # a year whose rows all become unusable loses its summary
    land_with_states(spark, other.withColumn("TAVG", F.lit(None).cast("double")), rows, kept)
    assert states.summaries(states.read_states(spark, kept))["yearly_mean"].where("YEAR = 1999").count() == 0


def test_landing_counts_bad_rows(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text(HEADER + "\nS1,2000-01-01,1,2,3,n,1,,10,,5,,7,\nS1,2000-01-02,oops,2,3,n,1,,10,,5,,7,\nS1,2000-01-03,1,2,3,n,1,,10,,5,,,\n")
    counts = land_observations(read_observations(spark, str(folder), keep_bad_rows=True), str(tmp_path / "t"))
    assert counts == {"RAW_ROWS": 3, "CLEAN_ROWS": 1, "CORRUPT_ROWS": 1}


def test_states_of_nothing(spark):
    empty = states.partial_states(raw_observations(spark, SF001).limit(0))
    assert states.overview(empty).first().TOTAL_RECORDS == 0 and rollups.climatology(empty).count() == 0
    assert states.rollup_states(empty).count() == rollups.rollup_all(Frames(raw_observations(spark, SF001).limit(0)).obs).count()


def test_headers_read_the_start_of_each_file(spark, tmp_path):
    """Files of several splits, one compressed: at most a block of each is read."""
    import gzip
    row = "S1,2000-01-01,1.0,2.0,3.0,name,1,,10,,5,,7,\n"
    for i in range(3):
        (tmp_path / f"f{i}.csv").write_text(HEADER + "\n" + row * 40_000)
    with gzip.open(tmp_path / "g.csv.gz", "wt") as out:
        out.write("DATE,TAVG,LATITUDE,LONGITUDE\r\n" + "2000-01-01,5,1,2\r\n" * 50_000)
    files = sorted(map(str, tmp_path.iterdir()))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        found = first_lines(spark, files)
        assert [r.file for r in found.collect()] == files and found.agg(F.max("bytes")).first()[0] <= BLOCK_BYTES
        assert found.rdd.getNumPartitions() == 1
        assert sorted(map(len, file_headers(spark, str(tmp_path)).values())) == [1, 3]
        assert read_observations(spark, str(tmp_path)).count() == 170_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_header_without_end(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x" * (BLOCK_BYTES + 1))
    with pytest.raises(Exception, match="no line end"):
        first_lines(spark, [str(tmp_path / "a.csv")]).collect()


def test_relation_density(spark):
    df = spark.createDataFrame([(float(i % 4), float(i)) for i in range(100)] + [(None, 1.0), (float("nan"), 2.0)], "PRCP double, TAVG double")
    got = distributions.relation_density(df, bins=4).collect()
    assert sum(r.COUNT for r in got) == 100 and sum(r.DENSITY * (3 / 4) * (99 / 4) for r in got) == pytest.approx(1)
    one = distributions.relation_density(df.limit(1), bins=4).first()
    assert (one.X_BIN, one.Y_BIN, one.X_LO, one.COUNT) == (2, 2, 0.0, 1)


def test_entry_without_text_operators():
    """What the text operators need is missing: the other queries stay."""
    code = ("import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; "
            "q = e.queries(); assert len(q) >= 72 and 'rollup_all' in q and not any(n.startswith('op') for n in q); assert set(e.oracle_sql()) <= set(q)")
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120, cwd=__import__("os").path.dirname(__import__("os").path.dirname(__file__)))


def test_sketches_merge_and_follow_their_year(spark, tmp_path):
    """Stored sketches give the exact number while it is small, one year at a
    time; landing a year again replaces that year's sketch only."""
    kept, raw = str(tmp_path / "kept"), raw_observations(spark, SF001)
    states.land_sketches(raw, kept)
    exact = {r.YEAR: r.n for r in Frames(raw).obs.groupBy("YEAR").agg(F.countDistinct("STATION").alias("n")).collect()}
    got = lambda: {r.YEAR: r.STATIONS for r in states.distinct_stations(states.read_states(spark, kept)).collect()}
    assert got() == exact
    other = raw.where(F.year("DATE") == 1999).withColumn("STATION", F.lit("ONE"))
    states.land_sketches(other, kept)
    assert got() == exact | {1999: 1}
    states.land_sketches(other.withColumn("TAVG", F.lit(None).cast("double")), kept)
    assert 1999 not in got()
    states.land_sketches(raw.limit(0), kept)
    assert states.distinct_stations(states.read_states(spark, kept), by=[]).first().STATIONS >= max(exact.values())
