"""Clean, convert, derive calendar features, impute.

``prepare_observations`` is the reference's preprocessing in one
projection (its trailing mean is added separately by
``windows.trailing_mean`` because only model rows need it, and a frame
without the window lets every roll-up skip that shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns
from ..schema import (CRITICAL_COLUMNS, FEATURES, IMPUTE_OFFSET, KEY_COLUMNS, LABEL,
                      PRCP_FILL, PRECIP_COLUMN, TEMPERATURE_COLUMNS, UNIT_DIVISOR)


def drop_incomplete(df: DataFrame, cols=CRITICAL_COLUMNS) -> DataFrame:
    """Keep rows where every column in ``cols`` is not null.

    Like the reference this is a null test: a NaN passes. Use ``dropna``
    semantics (``model_rows``) where NaN must go too.
    """
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def rescale(df: DataFrame, cols, divisor: float = UNIT_DIVISOR) -> DataFrame:
    """Tenths -> units."""
    return df.withColumns({c: F.col(c) / F.lit(float(divisor)) for c in cols})


def fill_constant(df: DataFrame, col: str, value: float = PRCP_FILL) -> DataFrame:
    """E5: replace null (and NaN, as ``fillna`` does) with a constant."""
    return df.fillna(value, subset=[col])


def impute_offset(df: DataFrame, target: str, base: str, offset: float) -> DataFrame:
    """A null ``target`` becomes ``base + offset``."""
    return df.withColumn(target, F.coalesce(F.col(target), F.col(base) + F.lit(offset)))


def complete(cols=CRITICAL_COLUMNS):
    """The P1 condition as a column: every column in ``cols`` is not null."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def prepare_observations(raw: DataFrame, *, divisor: float = UNIT_DIVISOR,
                         impute: float = IMPUTE_OFFSET, prcp_fill: float = PRCP_FILL,
                         keep_incomplete: bool = False) -> DataFrame:
    """Raw observations -> cleaned, converted, featured and imputed rows.

    Same order of steps as the reference: drop rows missing a critical
    column, convert units, add calendar features, fill PRCP, impute TMAX /
    TMIN from TAVG, then TEMP_RANGE from the imputed values. Every step
    after the drop is per row, so ``keep_incomplete`` can keep all rows
    (for counting them in the same pass) and leave the drop to the caller.
    """
    df = raw if keep_incomplete else drop_incomplete(raw, CRITICAL_COLUMNS)
    df = rescale(df, TEMPERATURE_COLUMNS + [PRECIP_COLUMN], divisor)
    df = df.withColumns(calendar_columns("DATE"))
    df = fill_constant(df, PRECIP_COLUMN, prcp_fill)
    df = impute_offset(df, "TMAX", "TAVG", impute)
    df = impute_offset(df, "TMIN", "TAVG", -impute)
    return df.withColumn("TEMP_RANGE", F.col("TMAX") - F.col("TMIN"))


def model_rows_condition(features=FEATURES, label: str = LABEL):
    """The P6 condition as a column: no null and no NaN in the features and
    the label (what ``dropna`` tests)."""
    cond = F.lit(True)
    for c in list(features) + [label]:
        cond = cond & F.col(c).isNotNull() & ~F.isnan(F.col(c))
    return cond


def model_rows(df: DataFrame, features=FEATURES, label: str = LABEL,
               keys=KEY_COLUMNS) -> DataFrame:
    """Keys, features and label; drop rows with a null or NaN in any
    feature or the label. The keys ride along for the keyed split."""
    cols = list(features) + [label]
    return df.select(*keys, *cols).dropna(subset=cols)
