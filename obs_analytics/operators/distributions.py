"""H1-H4: histograms, period comparison and the sampled relation."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import (DENSITY_BINS, EARLY_PERIOD_END, HIST_BINS, KEY_COLUMNS,
                      LATE_PERIOD_START, SAMPLE_FRACTION, SEED)
from .sampling import hash_sample
from .states import value_ranges


def histogram(df: DataFrame, value: str = "TAVG", bins: int = HIST_BINS, by=(),
              density: bool = False, groups: list | None = None,
              ranges: DataFrame | None = None) -> DataFrame:
    """H1 / H2: equal-width histogram over each group's own min..max.

    Bins are [lo + i*w, lo + (i+1)*w), the last one closed on the right;
    when all values are equal the range is value -/+ 0.5. Every bin is
    listed, empty ones with count 0. ``density`` adds count / (n * w), which
    integrates to 1 per group.

    The per-group range is a small aggregate joined back to the rows: one
    row with no group key (always broadcast), one per group otherwise.
    ``groups`` names the values of a single group column when they are a fixed
    short list (as the two-valued period tag's are): other rows are left out,
    and one range per named value is broadcast. Without it the join is left to
    Spark's size check and AQE.

    ``ranges`` (group columns, _lo, _hi, _n, as ``states.value_ranges`` gives
    them for TAVG) stands in for the range pass, so the rows are scanned once.
    """
    by = list(by)
    v = F.col(value)
    if groups is not None:
        df = df.filter(F.col(by[0]).isin(groups))
    rows = df.select(*by, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    stats = ranges if ranges is not None else rows.groupBy(*by).agg(
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    if ranges is not None and groups is not None:
        stats = stats.filter(F.col(by[0]).isin(groups))
    stats = stats.filter(F.col("_n") > 0)
    same = F.col("_hi") == F.col("_lo")
    stats = stats.select(
        *by, "_n",
        F.when(same, F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(same, F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"))
    stats = stats.withColumn("_norm", F.lit(float(bins)) / (F.col("_hi") - F.col("_lo")))
    small = F.broadcast(stats) if (not by or groups is not None) else stats
    joined = rows.join(small, by) if by else rows.crossJoin(small)
    idx = F.least(F.floor((F.col("_v") - F.col("_lo")) * F.col("_norm")), F.lit(bins - 1))
    counts = joined.groupBy(*by, idx.cast("int").alias("BIN")).agg(F.count(F.lit(1)).alias("COUNT"))
    grid = stats.select(*by, "_lo", "_hi", "_n",
                        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("BIN"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    out = grid.join(counts, by + ["BIN"], "left").select(
        *by, "BIN",
        (F.col("_lo") + F.col("BIN") * width).alias("BIN_LO"),
        F.when(F.col("BIN") == bins - 1, F.col("_hi"))
         .otherwise(F.col("_lo") + (F.col("BIN") + 1) * width).alias("BIN_HI"),
        F.coalesce("COUNT", F.lit(0)).cast("long").alias("COUNT"),
        *([(F.coalesce("COUNT", F.lit(0)) / (F.col("_n") * width)).alias("DENSITY")]
          if density else []))
    return out.orderBy(*by, "BIN")


def period_tag(year="YEAR", early_end: int = EARLY_PERIOD_END,
               late_start: int = LATE_PERIOD_START):
    """H3: 'early' up to ``early_end``, 'late' from ``late_start``, else null."""
    y = F.col(year) if isinstance(year, str) else year
    return (F.when(y <= early_end, "early").when(y >= late_start, "late")
            .otherwise(F.lit(None).cast("string")))


def distribution_shift(obs: DataFrame, value: str = "TAVG", bins: int = DENSITY_BINS,
                       early_end: int = EARLY_PERIOD_END,
                       late_start: int = LATE_PERIOD_START, states: DataFrame | None = None) -> DataFrame:
    """H2: density histograms of the early and late periods, each on its own
    range, which comes from the stored ``states`` where they are given (TAVG
    only). Years between the two periods are left out: by a DATE range that
    reaches the scan, and on data landed by year by its partition column."""
    wanted = ((F.col("DATE") < F.lit(_dt.date(early_end + 1, 1, 1)))
              | (F.col("DATE") >= F.lit(_dt.date(late_start, 1, 1))))
    if "OBS_YEAR" in obs.columns:
        wanted = wanted & ((F.col("OBS_YEAR") <= early_end) | (F.col("OBS_YEAR") >= late_start))
    tagged = (obs.filter(wanted).select(period_tag("YEAR", early_end, late_start).alias("PERIOD"), value)
              .filter(F.col("PERIOD").isNotNull()))
    ranges = None
    if states is not None:
        if value != "TAVG":
            raise ValueError("states hold the range of TAVG only")
        ranges = value_ranges(states.select("*", period_tag("YEAR", early_end, late_start).alias("PERIOD")), ["PERIOD"])
    return histogram(tagged, value, bins, by=["PERIOD"], density=True, groups=["early", "late"], ranges=ranges)


def sample_pairs(obs: DataFrame, fraction: float = SAMPLE_FRACTION, seed: int = SEED,
                 x: str = "PRCP", y: str = "TAVG") -> DataFrame:
    """H4: the sampled (PRCP, TAVG) pairs behind the scatter plot."""
    return hash_sample(obs, fraction, KEY_COLUMNS, seed).select(*KEY_COLUMNS, x, y)


def relation_summary(obs: DataFrame, x: str = "PRCP", y: str = "TAVG") -> DataFrame:
    """H4 over all rows: Pearson correlation and pair count (one aggregate)."""
    return obs.agg(F.corr(x, y).alias("CORRELATION"),
                   F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("N_PAIRS"))


def relation_density(obs: DataFrame, x: str = "PRCP", y: str = "TAVG", bins: int = DENSITY_BINS) -> DataFrame:
    """H4 over all rows: the plane of (x, y) in bins x bins equal cells over
    both columns' own ranges, cells with rows only: X_BIN, Y_BIN, their lower
    edges, COUNT and DENSITY (integrates to 1). Pairs with a null or NaN are
    left out; a column of one value spans value -/+ 0.5. Two passes: the
    ranges (one row, broadcast), then one partial aggregate to bins^2 cells."""
    ok = lambda c: F.col(c).isNotNull() & ~F.isnan(c)
    rows = obs.filter(ok(x) & ok(y)).select(F.col(x).alias("_x"), F.col(y).alias("_y"))
    found = rows.agg(F.count(F.lit(1)).alias("_n"), *[f(c).alias(f"{c}_{n}") for c in ("_x", "_y") for f, n in ((F.min, "lo"), (F.max, "hi"))])
    half = lambda c: F.when(F.col(f"{c}_lo") == F.col(f"{c}_hi"), 0.5).otherwise(0.0)
    found = found.select("_n", *[e for c in ("_x", "_y") for e in ((F.col(f"{c}_lo") - half(c)).alias(f"{c}_lo"), (F.col(f"{c}_hi") + half(c)).alias(f"{c}_hi"))])
    width = lambda c: (F.col(f"{c}_hi") - F.col(f"{c}_lo")) / F.lit(float(bins))
    cell = lambda c: F.least(F.floor((F.col(c) - F.col(f"{c}_lo")) / width(c)), F.lit(bins - 1)).cast("int")
    cells = rows.crossJoin(F.broadcast(found)).groupBy(
        cell("_x").alias("X_BIN"), cell("_y").alias("Y_BIN"), "_n", "_x_lo", "_x_hi", "_y_lo", "_y_hi").agg(F.count(F.lit(1)).alias("COUNT"))
    return cells.select(
        "X_BIN", "Y_BIN", (F.col("_x_lo") + F.col("X_BIN") * width("_x")).alias("X_LO"), (F.col("_y_lo") + F.col("Y_BIN") * width("_y")).alias("Y_LO"),
        "COUNT", (F.col("COUNT") / (F.col("_n") * width("_x") * width("_y"))).alias("DENSITY"))
