"""The whole job, load -> summaries -> model rows -> train -> forecast
-> impact -> report, returned as named DataFrames.

The reference runs seven steps and about 150 driver round trips, none of
them cached. Here the raw files are landed once as Parquet by year on shared
storage, every summary is a lazy DataFrame over a pruned scan of that table,
and the only actions are the landing, the ones Spark ML takes inside ``fit``
and a three-row read of the winner. Nothing is pinned on executors: the split
and the training frame are checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import distributions, forecasting, metrics, rollups, trends
from ..schema import (DENSITY_BINS, EARLY_PERIOD_END, FUTURE_YEARS, HIST_BINS, LATE_PERIOD_START,
                      MODEL_NAMES, RECENT_TREND_START, TREND_START)
from ..sources.observations import land_observations, read_landed, read_observations
from .frames import Frames
from .training import TrainedModels


def exploratory(f: Frames) -> dict[str, DataFrame]:
    """EDA section: yearly / monthly / season / decade roll-ups, the value
    histogram, the sampled pairs and the overview."""
    obs = f.obs
    return {
        "yearly_mean": rollups.yearly_mean(obs).orderBy("YEAR"),
        "monthly_mean": rollups.monthly_mean(obs),
        "season_range": rollups.season_range(obs),
        "decade_mean": rollups.decade_mean(obs),
        "value_histogram": distributions.histogram(obs, "TAVG", HIST_BINS),
        "sample_pairs": distributions.sample_pairs(obs),
        "relation_summary": distributions.relation_summary(obs),
        "dataset_overview": rollups.dataset_overview(obs),
        "overview_report": rollups.overview_report(obs),
    }


def impact(f: Frames, early_end: int = EARLY_PERIOD_END,
           late_start: int = LATE_PERIOD_START) -> dict[str, DataFrame]:
    """Impact section: trend since 1950 with its line, seasons by year, the
    distribution shift, yearly extremes and precipitation."""
    obs = f.obs
    points = rollups.yearly_mean_since(obs, TREND_START)
    return {
        "trend_assessment": trends.trend_assessment(obs, TREND_START),
        "trend_line": trends.trend_line(points, trends.linear_trend(points)),
        "season_year_mean": rollups.season_year_mean(obs),
        "distribution_shift": distributions.distribution_shift(obs, "TAVG", DENSITY_BINS,
                                                               early_end, late_start),
        "yearly_extreme": rollups.yearly_extreme(obs),
        "yearly_precip": rollups.yearly_precip(obs),
        "trend_assessment_recent": trends.trend_assessment(obs, RECENT_TREND_START),
    }


def modelling(f: Frames, future_years: int = FUTURE_YEARS, names=MODEL_NAMES,
              **training) -> tuple[dict[str, DataFrame], TrainedModels]:
    """Train, evaluate, pick the winner and forecast with it. ``training`` goes
    to ``TrainedModels``: partitions, memory_mb, checkpoint, store."""
    tm = TrainedModels(f, **training)
    scored = tm.scored(names)
    comparison = metrics.model_comparison(scored, names)
    best = metrics.best_model(comparison)
    winner = best.first()["BEST_MODEL"]  # one row out of len(names)
    grid = forecasting.forecast_grid(f.obs, future_years)
    predictions = forecasting.forecast(grid, tm.model(winner))
    yearly = forecasting.forecast_yearly(predictions)
    out = {
        "row_accounting": rollups.row_accounting(f.raw),
        "model_comparison": comparison,
        "class_metrics_per_class": metrics.class_metrics_per_class(scored),
        "best_model": best,
        "best_by_metric": metrics.best_by_metric(comparison),
        "model_report": metrics.model_report(comparison),
        "unscorable": forecasting.unscorable(grid),
        "forecast_grid": grid,
        "forecast": predictions,
        "forecast_yearly": yearly,
        "history_and_forecast": forecasting.history_and_forecast(f.obs, yearly),
        "forecast_change": forecasting.forecast_change(yearly),
    }
    return out, tm


def run_analysis(raw: DataFrame, *, future_years: int = FUTURE_YEARS, train: bool = True,
                 early_end: int = EARLY_PERIOD_END, late_start: int = LATE_PERIOD_START,
                 names=MODEL_NAMES, **training) -> dict[str, DataFrame]:
    """Every result of the reference's complete run, by name, over raw
    observations. Each result reads ``raw`` again, so it should be a landed
    table (``run_from_files``); call ``release(results)`` after training.

    ``names`` are the models to compare. ``training`` holds the settings of
    ``TrainedModels``: ``partitions`` (about 100 MB of training rows each),
    ``memory_mb``, ``checkpoint`` and ``store``, a folder of finished models."""
    f = Frames(raw)
    results: dict[str, DataFrame] = {}
    results.update(exploratory(f))
    results.update(impact(f, early_end, late_start))
    if train:
        model_results, tm = modelling(f, future_years, names, **training)
        results.update(model_results)
        results["_models"] = tm  # type: ignore[assignment]
    return results


def run_from_files(spark: SparkSession, csv_path: str, table_path: str, **options) -> dict[str, DataFrame]:
    """R4 from a path: read the observation files, land them as Parquet by year
    under ``table_path`` (years present there are replaced), analyse the table.
    ``options`` are those of ``run_analysis``; with ``store`` a second run over
    the same observations fits nothing, and one that was cut off goes on with
    the models that are not finished."""
    land_observations(read_observations(spark, csv_path), table_path)
    return run_analysis(read_landed(spark, table_path), **options)


def release(results: dict) -> None:
    tm = results.get("_models")
    if tm is not None:
        tm.release()
