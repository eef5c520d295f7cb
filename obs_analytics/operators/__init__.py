"""DataFrame -> DataFrame operators of the observation pipeline."""

from .cleaning import (drop_incomplete, fill_constant, impute_offset, model_rows,
                       prepare_observations, rescale)
from .distributions import distribution_shift, histogram, period_tag, relation_density, relation_summary, sample_pairs
from .forecasting import forecast, forecast_change, forecast_grid, forecast_yearly, history_and_forecast
from .metrics import (best_by_metric, best_model, class_metrics, class_metrics_per_class,
                      confusion_counts, model_comparison, model_grades, regression_metrics)
from .modeling import feature_stages, regressor, score, standin_scores
from .rollups import (between_years, climatology, dataset_overview, decade_mean, monthly_mean,
                      recent_baseline, rollup_all, row_accounting, season_range, season_year_mean,
                      value_stats, yearly_extreme, yearly_mean, yearly_mean_since, yearly_precip)
from .sampling import hash_sample, hash_split
from .states import land_states, partial_states, read_states, rollup_states
from .trends import linear_trend, trend_assessment, trend_line
from .windows import row_rank, trailing_mean, trailing_mean_days

__all__ = [n for n in dir() if not n.startswith("_")]
