"""obs_analytics: daily station-observation analytics on Spark.

Read raw readings, clean and convert them, derive calendar, season,
decade, range and trailing-mean features, roll them up, fit trends,
compare distributions, train and score Spark ML regressors, and project
future years. Every function takes and returns DataFrames.
"""

__version__ = "0.1.0"
