"""Roll-ups of the observation frame.

Every roll-up is one hash aggregate with a partial (map-side) and a final
phase, so a hot key is pre-aggregated on every executor before the
shuffle and the shuffle carries one row per key per task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import season_name
from ..schema import (BASELINE_YEARS, CLIMATOLOGY_YEARS, CORRUPT_COLUMN, FEATURES, KEY_COLUMNS,
                      SEASON_NAMES, TRAILING_COLUMN)
from .cleaning import complete, model_rows_condition, prepare_observations
from .sampling import hash_split
from .states import held, is_states
from .windows import trailing_mean


def between_years(df: DataFrame, lo: int | None = None, hi: int | None = None,
                  date: str = "DATE") -> DataFrame:
    """Keep years lo..hi (inclusive) as a DATE range.

    Written on the date itself, not on ``year(date)``, so the predicate is
    pushed into the Parquet scan (row-group statistics). On data landed by
    year (``land_observations``) the same range is also put on the OBS_YEAR
    partition column, so whole year directories are never listed or read.
    """
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(date) >= F.lit(_dt.date(lo, 1, 1)))
    if hi is not None:
        cond = cond & (F.col(date) < F.lit(_dt.date(hi + 1, 1, 1)))
    if "OBS_YEAR" in df.columns:
        if lo is not None:
            cond = cond & (F.col("OBS_YEAR") >= lo)
        if hi is not None:
            cond = cond & (F.col("OBS_YEAR") <= hi)
    return df.filter(cond)


def yearly_mean(obs: DataFrame, value: str = "TAVG", out: str = "AVG_TAVG") -> DataFrame:
    """A1: mean by YEAR."""
    return obs.groupBy("YEAR").agg(F.avg(value).alias(out))


def monthly_mean(obs: DataFrame, value: str = "TAVG", out: str = "AVG_TAVG") -> DataFrame:
    """A2: mean by MONTH."""
    return obs.groupBy("MONTH").agg(F.avg(value).alias(out)).orderBy("MONTH")


def season_range(obs: DataFrame) -> DataFrame:
    """A3: mean TEMP_RANGE by season, all four seasons listed (null when a
    season has no rows)."""
    spark = obs.sparkSession
    seasons = spark.range(len(SEASON_NAMES)).select(F.col("id").cast("int").alias("SEASON"))
    agg = obs.groupBy("SEASON").agg(F.avg("TEMP_RANGE").alias("AVG_RANGE"),
                                    F.count(F.lit(1)).alias("N_ROWS"))
    # at most one aggregate row per season code: broadcasting it is bounded, and
    # the broadcast side of a left join has to be the right one
    return (seasons.join(F.broadcast(agg), "SEASON", "left")
            .select("SEASON", season_name("SEASON").alias("SEASON_NAME"), "AVG_RANGE",
                    F.coalesce("N_ROWS", F.lit(0)).alias("N_ROWS"))
            .orderBy("SEASON"))


def decade_mean(obs: DataFrame) -> DataFrame:
    """A4: mean TAVG by DECADE."""
    return obs.groupBy("DECADE").agg(F.avg("TAVG").alias("AVG_TAVG")).orderBy("DECADE")


def season_year_mean(obs: DataFrame, wide: bool = False) -> DataFrame:
    """A5: mean TAVG by YEAR x SEASON; ``wide`` pivots to one column per season."""
    if wide:
        return (obs.groupBy("YEAR").pivot("SEASON", list(range(len(SEASON_NAMES))))
                .agg(F.avg("TAVG")).orderBy("YEAR"))
    return (obs.groupBy("YEAR", "SEASON").agg(F.avg("TAVG").alias("SEASONAL_TEMP"))
            .orderBy("YEAR", "SEASON"))


def yearly_extreme(obs: DataFrame) -> DataFrame:
    """Hottest TMAX of each year."""
    return obs.groupBy("YEAR").agg(F.max("TMAX").alias("MAX_TEMP")).orderBy("YEAR")


def yearly_precip(obs: DataFrame) -> DataFrame:
    """Total PRCP of each year."""
    return obs.groupBy("YEAR").agg(F.sum("PRCP").alias("ANNUAL_PRECIP")).orderBy("YEAR")


def yearly_mean_since(obs: DataFrame, start: int, value: str = "TAVG",
                      out: str = "AVG_TEMP", by=()) -> DataFrame:
    """Yearly mean from ``start`` on (optionally per group)."""
    return (between_years(obs, lo=start).groupBy(*by, "YEAR")
            .agg(F.avg(value).alias(out)))


def value_stats(obs: DataFrame, value: str = "TAVG") -> DataFrame:
    """Mean, sample standard deviation, min and max."""
    v = F.col(value)
    return obs.agg(F.avg(v).alias("MEAN_TEMP"), F.stddev_samp(v).alias("STD_TEMP"),
                   F.min(v).alias("MIN_TEMP"), F.max(v).alias("MAX_TEMP"))


def dataset_overview(obs: DataFrame, approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Records, year range, distinct stations and TAVG stats in
    one aggregate (the single distinct column needs no Expand).

    ``approximate`` counts stations with a HyperLogLog++ sketch (relative
    error ``rsd``) instead of an exact distinct, which needs no shuffle by
    station at all."""
    v = F.col("TAVG")
    stations = (F.approx_count_distinct("STATION", rsd) if approximate
                else F.countDistinct("STATION"))
    return obs.agg(
        F.count(F.lit(1)).alias("TOTAL_RECORDS"),
        F.min("YEAR").alias("FIRST_YEAR"), F.max("YEAR").alias("LAST_YEAR"),
        stations.alias("STATIONS"),
        F.avg(v).alias("MEAN_TEMP"), F.stddev_samp(v).alias("STD_TEMP"),
        F.min(v).alias("MIN_TEMP"), F.max(v).alias("MAX_TEMP"))


_OVERVIEW_ITEMS = [
    ("dataset", "total_records", "TOTAL_RECORDS"), ("dataset", "first_year", "FIRST_YEAR"),
    ("dataset", "last_year", "LAST_YEAR"), ("dataset", "stations", "STATIONS"),
    ("temperature", "mean", "MEAN_TEMP"), ("temperature", "std", "STD_TEMP"),
    ("temperature", "min", "MIN_TEMP"), ("temperature", "max", "MAX_TEMP"),
]


def overview_report(obs: DataFrame, approximate: bool = False) -> DataFrame:
    """R1 in long form: (SECTION, ITEM, VALUE) rows of the one-row overview,
    stacked with ``stack`` (no second pass over the data)."""
    wide = dataset_overview(obs, approximate)
    pairs = ", ".join(f"'{sec}', '{item}', CAST({col} AS DOUBLE)" for sec, item, col in _OVERVIEW_ITEMS)
    return wide.selectExpr(f"stack({len(_OVERVIEW_ITEMS)}, {pairs}) AS (SECTION, ITEM, VALUE)")


def row_accounting(raw: DataFrame) -> DataFrame:
    """Rows read, kept by cleaning, usable for the model, train and test
    and, where the reader kept them, rows that failed to parse (CORRUPT_ROWS).

    Partial counts over the rows, without a window: a clean row always has a
    trailing mean, and that mean is NaN only within reach of a NaN reading.
    The rows this concerns are taken off by a second count that runs the
    window over the stations with a NaN TAVG alone, usually none.
    """
    flagged = prepare_observations(raw.withColumn("CLEAN", complete()), keep_incomplete=True)
    ready = model_rows_condition([c for c in FEATURES if c != TRAILING_COLUMN])
    usable, train = F.col("CLEAN") & ready, F.col("IS_TRAIN")
    corrupt = [F.count(CORRUPT_COLUMN).alias("CORRUPT_ROWS")] if CORRUPT_COLUMN in raw.columns else []
    counts = hash_split(flagged).agg(
        F.count(F.lit(1)).alias("RAW_ROWS"), F.count(F.when(F.col("CLEAN"), 1)).alias("CLEAN_ROWS"),
        F.count(F.when(usable, 1)).alias("_usable"), F.count(F.when(usable & train, 1)).alias("_train"), *corrupt)
    clean = prepare_observations(raw).select(*KEY_COLUMNS, *[c for c in FEATURES if c != TRAILING_COLUMN], "TAVG")
    stations = clean.filter(F.isnan("TAVG")).select(F.col("STATION").alias("_s")).distinct()
    reached = trailing_mean(clean.join(stations, clean["STATION"].eqNullSafe(stations["_s"]), "left_semi"),
                            "TAVG", "DATE", by=["STATION"])
    spoiled = hash_split(reached.filter(ready & F.isnan(TRAILING_COLUMN))).agg(
        F.count(F.lit(1)).alias("_spoiled"), F.count(F.when(train, 1)).alias("_spoiled_train"))
    model = F.col("_usable") - F.col("_spoiled")
    fit = F.col("_train") - F.col("_spoiled_train")
    # both sides are single rows
    return counts.crossJoin(F.broadcast(spoiled)).select(
        "RAW_ROWS", "CLEAN_ROWS", model.alias("MODEL_ROWS"), fit.alias("TRAIN_ROWS"),
        (model - fit).alias("TEST_ROWS"), *(["CORRUPT_ROWS"] if corrupt else []))


# -- recent baseline and climatology ----------------------------------------
#
# Both look back from the last year in the data. The reference runs one
# query for the max year and one per future month. Here the last year is a
# scalar subquery over the cleaned rows (it reads the critical columns only),
# the look-back is a DATE range on it, and on data landed by year the same
# range on OBS_YEAR, so older partitions are never read; the rows left are
# reduced once to partial sums per (group, YEAR, MONTH).

BASELINE_COLS = ["LATITUDE", "LONGITUDE", "ELEVATION", "PRCP", "TAVG"]
CLIMATE_COLS = ["TMAX", "TMIN", "TAVG"]
_MEAN_COLS = ["LATITUDE", "LONGITUDE", "ELEVATION", "PRCP", "TAVG", "TMAX", "TMIN"]


def monthly_partials(obs: DataFrame, by=(), cols=_MEAN_COLS) -> DataFrame:
    """Sum and non-null count of each column per (group, YEAR, MONTH), from
    observations or from their stored states."""
    aggs = []
    for c in cols:
        if is_states(obs):
            aggs += [F.sum(f"S_{c}").alias(f"S_{c}"), F.sum(f"N_{c}").alias(f"N_{c}")]
            continue
        aggs += [F.sum(c).alias(f"S_{c}"), F.count(c).alias(f"N_{c}")]
    return obs.groupBy(*by, "YEAR", "MONTH").agg(*aggs)


def partials_with_max_year(obs: DataFrame, by=(), cols=_MEAN_COLS,
                           years: int = CLIMATOLOGY_YEARS) -> DataFrame:
    """Monthly partials of the years MAX_YEAR - years .. MAX_YEAR, plus MAX_YEAR,
    the last year of the whole data set. Over states (``states``) no observation
    is read, neither for the last year nor for the look-back."""
    if is_states(obs):
        obs = held(obs)
        top = obs.agg(F.max("YEAR")).scalar()
        recent = obs.filter(F.col("YEAR") >= top - years)
    else:
        top = obs.agg(F.max("YEAR")).scalar()
        recent = obs.filter(F.col("DATE") >= F.make_date(top - years, F.lit(1), F.lit(1)))
    if "OBS_YEAR" in obs.columns:
        recent = recent.filter(F.col("OBS_YEAR") >= top - years)
    return monthly_partials(recent, by, cols).withColumn("MAX_YEAR", top)


def _ratio(s, n):
    return F.try_divide(s, n.cast("double"))


def _since(years: int):
    return F.col("YEAR") >= F.col("MAX_YEAR") - years


def recent_baseline(obs: DataFrame, years: int = BASELINE_YEARS, by=()) -> DataFrame:
    """Mean location, precipitation and TAVG over YEAR >= max_year - years."""
    p = partials_with_max_year(obs, by, BASELINE_COLS, years).filter(_since(years))
    return p.groupBy(*by, "MAX_YEAR").agg(
        _ratio(F.sum("S_LATITUDE"), F.sum("N_LATITUDE")).alias("LAT"),
        _ratio(F.sum("S_LONGITUDE"), F.sum("N_LONGITUDE")).alias("LON"),
        _ratio(F.sum("S_ELEVATION"), F.sum("N_ELEVATION")).alias("ELEV"),
        _ratio(F.sum("S_PRCP"), F.sum("N_PRCP")).alias("PRCP_MEAN"),
        _ratio(F.sum("S_TAVG"), F.sum("N_TAVG")).alias("TAVG_BASELINE"),
        F.sum("N_TAVG").alias("N_ROWS"))


def climatology(obs: DataFrame, years: int = CLIMATOLOGY_YEARS, by=()) -> DataFrame:
    """Per-month mean TMAX, TMIN, TAVG over YEAR >= max_year - years."""
    p = partials_with_max_year(obs, by, CLIMATE_COLS, years).filter(_since(years))
    return p.groupBy(*by, "MONTH").agg(
        _ratio(F.sum("S_TMAX"), F.sum("N_TMAX")).alias("AVG_TMAX"),
        _ratio(F.sum("S_TMIN"), F.sum("N_TMIN")).alias("AVG_TMIN"),
        _ratio(F.sum("S_TAVG"), F.sum("N_TAVG")).alias("AVG_TAVG"),
        F.sum("N_TAVG").alias("N_ROWS"))


def lookback_by_group(obs: DataFrame, by=(), baseline_years: int = BASELINE_YEARS,
                      climatology_years: int = CLIMATOLOGY_YEARS) -> DataFrame:
    """A13 and A14 together: one row per group with MAX_YEAR, the baseline
    means, N_BASELINE and MONTHS, a map month -> (AVG_TMAX, AVG_TMIN,
    AVG_TAVG) over the climatology years (at most 12 entries). Built in one
    chain from the monthly partials."""
    p = partials_with_max_year(obs, by, _MEAN_COLS, max(baseline_years, climatology_years))
    rb, rc = _since(baseline_years), _since(climatology_years)
    aggs = []
    for c in BASELINE_COLS:
        aggs += [F.sum(F.when(rb, F.col(f"S_{c}"))).alias(f"B_S_{c}"),
                 F.sum(F.when(rb, F.col(f"N_{c}"))).alias(f"B_N_{c}")]
    for c in CLIMATE_COLS:
        aggs += [F.sum(F.when(rc, F.col(f"S_{c}"))).alias(f"C_S_{c}"),
                 F.sum(F.when(rc, F.col(f"N_{c}"))).alias(f"C_N_{c}")]
    per_month = p.groupBy(*by, "MAX_YEAR", "MONTH").agg(*aggs)
    month_means = F.struct(*[_ratio(F.col(f"C_S_{c}"), F.col(f"C_N_{c}")).alias(f"AVG_{c}")
                             for c in CLIMATE_COLS])
    in_window = F.col("C_N_TAVG") > 0
    return per_month.groupBy(*by, "MAX_YEAR").agg(
        _ratio(F.sum("B_S_LATITUDE"), F.sum("B_N_LATITUDE")).alias("LAT"),
        _ratio(F.sum("B_S_LONGITUDE"), F.sum("B_N_LONGITUDE")).alias("LON"),
        _ratio(F.sum("B_S_ELEVATION"), F.sum("B_N_ELEVATION")).alias("ELEV"),
        _ratio(F.sum("B_S_PRCP"), F.sum("B_N_PRCP")).alias("PRCP_MEAN"),
        F.coalesce(F.sum("B_N_TAVG"), F.lit(0)).alias("N_BASELINE"),
        F.map_from_entries(F.filter(
            F.collect_list(F.struct("MONTH", F.when(in_window, month_means).alias("m"))),
            lambda e: e["m"].isNotNull())).alias("MONTHS"))


def lookback_coverage(obs: DataFrame, by, years: int = BASELINE_YEARS) -> DataFrame:
    """Groups in the data, with and without rows in the baseline years: a group
    without any gets no forecast (FC6), and this says how many there are."""
    by = list(by)
    top = obs.agg(F.max("YEAR")).scalar()
    last = obs.groupBy(*by).agg(F.max("YEAR").alias("_last")).withColumn("_top", top)
    recent = F.col("_last") >= F.col("_top") - years
    return last.agg(F.count(F.lit(1)).alias("N_GROUPS"), F.count(F.when(recent, 1)).alias("N_RECENT"),
                    F.count(F.when(~recent, 1)).alias("N_WITHOUT_RECENT"))


def rollup_all(obs: DataFrame) -> DataFrame:
    """A1-A7 and the grand total in one pass with GROUPING SETS.

    LEVEL names the grouping set of each row; columns outside it are null.
    """
    g = {c: F.grouping(c) == 0 for c in ["YEAR", "MONTH", "SEASON", "DECADE"]}
    level = (F.when(g["YEAR"] & g["SEASON"], "year_season")
             .when(g["YEAR"], "year").when(g["MONTH"], "month")
             .when(g["SEASON"], "season").when(g["DECADE"], "decade")
             .otherwise("all"))
    sets = [["YEAR"], ["MONTH"], ["SEASON"], ["DECADE"], ["YEAR", "SEASON"], []]
    return obs.groupingSets(sets, "YEAR", "MONTH", "SEASON", "DECADE").agg(
        level.alias("LEVEL"),
        F.count(F.lit(1)).alias("N_ROWS"),
        F.avg("TAVG").alias("AVG_TAVG"),
        F.avg("TEMP_RANGE").alias("AVG_RANGE"),
        F.max("TMAX").alias("MAX_TMAX"),
        F.sum("PRCP").alias("SUM_PRCP"))
