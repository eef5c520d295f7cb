"""Column expressions: calendar parts, classes, labels and grades.

Each function takes and returns ``Column`` objects, so it compiles into
the surrounding whole-stage-codegen span; nothing here runs Python per row.
"""

from .calendar import (calendar_columns, day_of_year_mid_month, decade_of,
                       season_name, season_of)
from .classes import class_label, value_class
from .labels import change_sign, grade, trend_label

__all__ = ["calendar_columns", "day_of_year_mid_month", "decade_of", "season_of",
           "season_name", "value_class", "class_label", "trend_label", "grade",
           "change_sign"]
