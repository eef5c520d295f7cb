"""Calendar features of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MIDMONTH_DAY, SEASON_MONTHS, SEASON_NAMES


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def season_of(month) -> Column:
    """0 winter (Dec-Feb), 1 spring (Mar-May), 2 summer, 3 fall.

    December stays in its own calendar year (no season-year shift). One
    definition serves both history and the forecast grid.
    """
    m, code = _c(month), F.lit(0)
    for k, (first, last) in enumerate(SEASON_MONTHS, 1):
        code = F.when(m.between(first, last), k).otherwise(code)
    return code


def season_name(season) -> Column:
    names = F.array(*[F.lit(n) for n in SEASON_NAMES])
    return F.element_at(names, _c(season) + 1)


def decade_of(year) -> Column:
    """Start year of the decade: the year divided by 10, truncated, times 10."""
    return (_c(year) / 10).cast("int") * 10


def day_of_year_mid_month(year, month, day: int = MIDMONTH_DAY) -> Column:
    """Day of year of the 15th of a month; leap years shift March on by one."""
    return F.dayofyear(F.make_date(_c(year), _c(month), F.lit(day)))


def calendar_columns(date="DATE") -> dict[str, Column]:
    """YEAR, MONTH, DAY_OF_YEAR, SEASON, DECADE of a date column."""
    d = _c(date)
    return {
        "YEAR": F.year(d),
        "MONTH": F.month(d),
        "DAY_OF_YEAR": F.dayofyear(d),
        "SEASON": season_of(F.month(d)),
        "DECADE": decade_of(F.year(d)),
    }
