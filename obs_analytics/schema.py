"""Schemas and the fixed values of the observation pipeline.

Everything here is a plain constant; functions take them as default
parameters so a caller can override any of them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# Raw daily-observation columns, in file order, with their Spark types.
RAW_FIELDS = [
    ("STATION", T.StringType()),
    ("DATE", T.DateType()),
    ("LATITUDE", T.DoubleType()),
    ("LONGITUDE", T.DoubleType()),
    ("ELEVATION", T.DoubleType()),
    ("NAME", T.StringType()),
    ("PRCP", T.DoubleType()),
    ("PRCP_ATTRIBUTES", T.StringType()),
    ("TMAX", T.DoubleType()),
    ("TMAX_ATTRIBUTES", T.StringType()),
    ("TMIN", T.DoubleType()),
    ("TMIN_ATTRIBUTES", T.StringType()),
    ("TAVG", T.DoubleType()),
    ("TAVG_ATTRIBUTES", T.StringType()),
]
CRITICAL_COLUMNS = ["DATE", "TAVG", "LATITUDE", "LONGITUDE"]
TEMPERATURE_COLUMNS = ["TMAX", "TMIN", "TAVG"]
PRECIP_COLUMN = "PRCP"
UNIT_DIVISOR = 10.0  # tenths of a degree / tenths of a mm -> units
PRCP_FILL = 0.0
IMPUTE_OFFSET = 5.0  # TMAX = TAVG + 5, TMIN = TAVG - 5
TRAILING_ROWS = 30  # ROWS BETWEEN 30 PRECEDING AND CURRENT ROW (31 rows)
SEASON_NAMES = ["Winter", "Spring", "Summer", "Fall"]  # codes 0, 1, 2, 3
SEASON_MONTHS = [(3, 5), (6, 8), (9, 11)]  # codes 1, 2, 3: first and last month; others are 0
FEATURES = [
    "YEAR", "MONTH", "DAY_OF_YEAR", "LATITUDE", "LONGITUDE", "ELEVATION",
    "PRCP", "TMAX", "TMIN", "TEMP_RANGE", "SEASON", "TAVG_30DAY_AVG",
]
LABEL = "TAVG"
SEED = 42
SAMPLE_FRACTION = 0.1
TRAIN_FRACTION = 0.8
CLASS_CUTS = [15.0, 20.0, 25.0, 30.0, 35.0]  # right-closed bins
CLASS_LABELS = ["Very Cold", "Cold", "Moderate", "Warm", "Hot", "Very Hot"]
TOLERANCE = 2.0  # degrees, inclusive
MAPE_EPSILON = 1e-10
HIST_BINS = 50
DENSITY_BINS = 40
TREND_START = 1950
RECENT_TREND_START = 2000
EARLY_PERIOD_END = 1980
LATE_PERIOD_START = 2000
WARMING_THRESHOLD = 0.01
FUTURE_YEARS = 10
BASELINE_YEARS = 5  # YEAR >= max_year - 5
CLIMATOLOGY_YEARS = 10  # YEAR >= max_year - 10
MIDMONTH_DAY = 15
MODEL_NAMES = ["Linear Regression", "Random Forest", "Gradient Boosted Trees"]
LR_PARAMS = {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 0.5}
RF_PARAMS = {"numTrees": 100, "maxDepth": 10, "seed": 42}
GBT_PARAMS = {"maxIter": 50, "maxDepth": 5, "seed": 42}
# Grade thresholds (strictly greater / strictly less).
R2_GRADES = [(0.95, "Excellent"), (0.90, "Very good"), (0.80, "Good")]
ACCURACY_GRADES = [(0.90, "Excellent"), (0.80, "Good")]
F1_GRADES = [(0.90, "Excellent"), (0.80, "Good")]
MAPE_GRADES = [(5.0, "High"), (10.0, "Good")]
# ---------------------------------------------------------------------------

RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])
KEY_COLUMNS = ["STATION", "DATE"]
CORRUPT_COLUMN = "_corrupt_record"
TRAILING_COLUMN = "TAVG_30DAY_AVG"

# Model parameters of our own: the layout of the training rows and the tree
# learners' budget per task. Both influence the fitted trees, so they are
# constants and do not follow the cluster's cores or memory.
TRAINING_PARTITIONS = 32
TREE_MEMORY_MB = 64
