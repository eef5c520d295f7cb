"""Trailing means.

W1 / W2 are a ROWS frame: the mean of the current row and the 30 rows
before it in (order, tie-break) order, shorter at the start of a series.
W3 is a RANGE frame over calendar days.

Two physical strategies give the same numbers:

* ``partition``: one window partitioned by the group key. One shuffle, but
  a whole group is sorted in one task, and with no group key (the
  reference's literal form) the whole data set is.
* ``blocked``: every row gets its exact rank in its group, the
  ranked rows are cut into blocks of ``block_rows`` and each block also
  receives the last ``rows`` rows of the block before it (the halo). The
  window then runs per (group, block) and halo rows are dropped. No task
  ever holds more than ``block_rows + rows`` rows of one group, so a
  station holding a third of the data, or the ungrouped global sequence,
  spreads over many tasks.

  It is the default, grouped or not: nothing is measured while a plan is
  built, and no plan depends on the size of the data.

  The rank needs no sort of a whole group either: rows are bucketed by
  ``bucket_days`` of the order date and, without a group key, by the first
  characters of the tie-break, so that one busy day is not one task.
  Per-(group, bucket) counts (a small partial aggregate) give each bucket's
  starting offset by a running sum, and a row_number inside the (group,
  bucket) completes the rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import TRAILING_COLUMN, TRAILING_ROWS

_TMP = ["_tm_bucket", "_tm_rank", "_tm_shift", "_tm_block"]


def _group_keys(df: DataFrame, by: list[str]) -> tuple[DataFrame, list[str]]:
    """Non-null stand-ins for the group columns: (is-null flag, value or a
    default) per column. Joins and windows on plain non-null keys keep one
    hash partitioning from the join through the rank window, where a
    null-safe join would force another shuffle."""
    cols, names = {}, []
    for i, c in enumerate(by):
        cols[f"_tm_n{i}"] = F.col(c).isNull()
        cols[f"_tm_k{i}"] = F.coalesce(F.col(c).cast("string"), F.lit(""))
        names += [f"_tm_n{i}", f"_tm_k{i}"]
    return (df.withColumns(cols) if cols else df), names


def row_rank(df: DataFrame, order: str, by=(), tiebreak=(), *, bucket_days: int | None = None,
             tie_chars: int = 6, out: str = "_tm_rank") -> DataFrame:
    """Exact 0-based rank of each row in its group by (order, tie-break),
    computed without sorting a whole group in one task (see module doc).

    ``order`` must be a date column. ``bucket_days`` defaults to 1 with no
    group key (one bucket per day) and 366 with one. Without a group key and
    with one-day buckets a day is cut further by the first ``tie_chars``
    characters of the first tie-break column (a string), which orders as the
    column does; rows without a date get one such bucket per prefix too.
    """
    by, tiebreak = list(by), list(tiebreak)
    if bucket_days is None:
        bucket_days = 366 if by else 1
    keyed, keys = _group_keys(df, by)
    # rows with no order value sort first, as in Spark's ascending order
    bucket = F.coalesce(F.floor(F.unix_date(F.col(order)) / bucket_days),
                        F.lit(-(2 ** 62)).cast("long"))
    cut = bucket_days == 1 and not by and tiebreak and dict(df.dtypes)[tiebreak[0]] == "string"
    # null sorts before every string: a leading space-free mark keeps it first
    tie = (F.when(F.col(tiebreak[0]).isNull(), F.lit("0")).otherwise(
        F.concat(F.lit("1"), F.left(F.col(tiebreak[0]), F.lit(tie_chars)))) if cut else F.lit(""))
    tagged = keyed.withColumn("_tm_bucket", bucket).withColumn("_tm_tie", tie)
    parts = ["_tm_bucket", "_tm_tie"] if cut else ["_tm_bucket"]
    counts = tagged.groupBy(*keys, *parts).agg(F.count(F.lit(1)).alias("_tm_n"))
    if cut:
        # offsets inside a day from the day's own prefixes, offsets of days from
        # one row per day: no window holds all (day, prefix) rows
        days = counts.groupBy("_tm_bucket").agg(F.sum("_tm_n").alias("_tm_n"))
        earlier = Window.partitionBy().orderBy("_tm_bucket").rowsBetween(Window.unboundedPreceding, -1)
        days = days.select("_tm_bucket", F.coalesce(F.sum("_tm_n").over(earlier), F.lit(0)).alias("_tm_day"))
        within = Window.partitionBy("_tm_bucket").orderBy("_tm_tie").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (counts.withColumn("_tm_in", F.coalesce(F.sum("_tm_n").over(within), F.lit(0)))
                   .join(days, "_tm_bucket")
                   .select(*parts, (F.col("_tm_day") + F.col("_tm_in")).alias("_tm_offset")))
    else:
        before = Window.partitionBy(*keys).orderBy("_tm_bucket").rowsBetween(Window.unboundedPreceding, -1)
        offsets = (counts.withColumn("_tm_offset", F.coalesce(F.sum("_tm_n").over(before), F.lit(0)))
                   .drop("_tm_n"))
    # offsets has one row per (group, bucket): small next to the data, and
    # left to AQE to broadcast when its measured size allows. Joined on the
    # same keys the rank window partitions by, so one shuffle serves both.
    ranked = tagged.join(offsets, keys + parts)
    inside = Window.partitionBy(*keys, *parts).orderBy(order, *tiebreak)
    ranked = ranked.withColumn(out, F.col("_tm_offset") + F.row_number().over(inside) - 1)
    return ranked.drop("_tm_offset", "_tm_bucket", "_tm_tie", *keys)


def _rows_frame_blocked(df: DataFrame, agg: Column, order: str, by, tiebreak, rows: int,
                        out: str, bucket_days, block_rows: int, last: int = 0) -> DataFrame:
    if block_rows <= rows:
        raise ValueError("block_rows must exceed the frame length")
    ranked = row_rank(df, order, by, tiebreak, bucket_days=bucket_days)
    ranked, keys = _group_keys(ranked, by)
    rank = F.col("_tm_rank")
    copies = F.when(rank % block_rows >= block_rows - rows, F.array(F.lit(0), F.lit(1))) \
        .otherwise(F.array(F.lit(0)))
    halo = (ranked.withColumn("_tm_shift", F.explode(copies))
            .withColumn("_tm_block", F.floor(rank / block_rows) + F.col("_tm_shift")))
    w = Window.partitionBy(*keys, "_tm_block").orderBy("_tm_rank").rowsBetween(-rows, last)
    return (halo.withColumn(out, agg.over(w))
            .filter(F.col("_tm_shift") == 0)
            .drop(*_TMP, *keys))


def trailing_mean(df: DataFrame, value: str = "TAVG", order: str = "DATE", by=("STATION",),
                  tiebreak=(), *, rows: int = TRAILING_ROWS, out: str = TRAILING_COLUMN,
                  strategy: str = "blocked", bucket_days: int | None = None,
                  block_rows: int = 4096, exclude_current: bool = False) -> DataFrame:
    """Mean of ``value`` over the current row and the ``rows`` rows before it.

    W1 is ``by=("STATION",)``; W2, the reference's literal ungrouped form,
    is ``by=(), tiebreak=("STATION",)`` (the reference leaves ties on DATE
    in no defined order; STATION makes it total). (by, order, tiebreak)
    must identify a row for the result to be deterministic.

    ``exclude_current`` drops the current row from the frame (rows -30..-1):
    the reference includes it, which leaks the label into this feature.

    ``partition`` (one task per group) is used only when the caller names it.
    """
    by, tiebreak = list(by), list(tiebreak)
    agg = F.avg(value)
    last = -1 if exclude_current else 0
    if strategy == "partition":
        w = Window.partitionBy(*by).orderBy(order, *tiebreak).rowsBetween(-rows, last)
        return df.withColumn(out, agg.over(w))
    if strategy != "blocked":
        raise ValueError(f"unknown strategy {strategy!r}")
    return _rows_frame_blocked(df, agg, order, by, tiebreak, rows, out, bucket_days, block_rows, last)


def trailing_mean_days(df: DataFrame, value: str = "TAVG", date: str = "DATE",
                       by=("STATION",), *, days: int = 30, out: str = "TAVG_30D_MEAN",
                       strategy: str | None = None, block_days: int = 366) -> DataFrame:
    """Mean over the calendar days [date - days + 1, date], the README's
    "30-day average". Gaps shorten the frame instead of stretching it.

    ``blocked`` (the default with a group key) cuts each group's time line into
    ``block_days`` blocks and copies the last ``days - 1`` days of each block
    into the next as halo, so one shuffle suffices and no task holds more than
    one block of one group (plus its halo).

    ``daily`` (the default without one) slides over daily partial sums and
    counts instead of rows: rows are summed up per day before the shuffle, the
    same blocks hold one row a day, and each row looks up its day's mean. No
    task holds the rows of a day, and ungrouped no row is shuffled at all.
    Rows without a date share a mean of their own in every form.
    """
    by = list(by)
    strategy = strategy or ("blocked" if by else "daily")
    day = F.unix_date(F.col(date))
    reach = days - 1
    if strategy == "partition":
        w = Window.partitionBy(*by).orderBy(day).rangeBetween(-reach, 0)
        return df.withColumn(out, F.avg(value).over(w))
    if strategy not in ("blocked", "daily"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if block_days <= reach:
        raise ValueError("block_days must exceed days - 1")
    if strategy == "daily":
        return _daily_means(df, value, day, by, reach, out, block_days)
    w = Window.partitionBy(*by, "_tm_block").orderBy("_tm_day").rangeBetween(-reach, 0)
    return (_day_blocks(df, day, reach, block_days).withColumn(out, F.avg(value).over(w))
            .filter(F.col("_tm_shift") == 0)
            .drop("_tm_shift", "_tm_block", "_tm_day"))


def _day_blocks(df: DataFrame, day: Column, reach: int, block_days: int) -> DataFrame:
    """Rows with their day and block, those of a block's last ``reach`` days
    again in the next block (shift 1)."""
    copies = F.when(F.pmod(day, F.lit(block_days)) >= block_days - reach,
                    F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (df.withColumn("_tm_shift", F.explode(copies))
            .withColumn("_tm_block", F.floor(day / block_days) + F.col("_tm_shift"))
            .withColumn("_tm_day", day))


def _daily_means(df: DataFrame, value: str, day: Column, by: list[str], reach: int, out: str,
                 block_days: int) -> DataFrame:
    keyed, keys = _group_keys(df, by)
    keyed = keyed.withColumn("_tm_d", day)
    daily = keyed.groupBy(*keys, "_tm_d").agg(F.sum(value).alias("_tm_s"), F.count(value).alias("_tm_n"))
    w = Window.partitionBy(*keys, "_tm_block").orderBy("_tm_day").rangeBetween(-reach, 0)
    mean = F.try_divide(F.sum("_tm_s").over(w), F.sum("_tm_n").over(w).cast("double"))
    means = (_day_blocks(daily, F.col("_tm_d"), reach, block_days).withColumn("_tm_mean", mean)
             .filter(F.col("_tm_shift") == 0))
    means = means.select(*[F.col(c).alias(f"{c}r") for c in keys], F.col("_tm_d").alias("_tm_dr"), "_tm_mean")
    # ungrouped there is one row per calendar day (about 3.7 million from year 1
    # to 9999, some 37,000 in a century); grouped, AQE decides by measured size
    side = means if by else F.broadcast(means)
    same = F.col("_tm_d").eqNullSafe(F.col("_tm_dr"))
    for c in keys:
        same = same & (F.col(c) == F.col(f"{c}r"))
    return keyed.join(side, same, "left").select(*[F.col(c) for c in df.columns if c != out], F.col("_tm_mean").alias(out))
