"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion into Spark's no-op sink (every row is
computed, nothing is collected to the driver) after one untimed warm-up.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from obs_analytics.plans import registry  # noqa: E402
from obs_analytics.plans.analysis import run_analysis  # noqa: E402
from obs_analytics.plans.registry import REGISTRY  # noqa: E402
from obs_analytics.session import ensure_checkpoint_dir, local_session  # noqa: E402
from obs_analytics.sources import land_observations, read_landed  # noqa: E402
from obs_analytics.sources.testdata import raw_observations  # noqa: E402

HEADLINE = [
    "source_observations", "model_rows", "dataset_overview", "rollup_all", "yearly_mean",
    "season_range", "recent_baseline", "climatology", "trend_assessment", "linear_trend_by_station",
    "trailing_mean_by_station", "trailing_mean_global", "trailing_mean_30d", "value_histogram",
    "distribution_shift", "train_test_split", "forecast_grid", "forecast_grid_by_station",
    "regression_metrics", "class_metrics_per_class", "model_comparison",
    "model_linear", "model_forest", "model_boosted", "forecast",
]


def analysis_summaries(spark, sf_dir: str) -> None:
    """The reference's job without model training: land the observations by
    year, then every EDA and impact result over the landed table."""
    path = f"{ensure_checkpoint_dir(spark)}/bench-{uuid.uuid4().hex}"
    land_observations(raw_observations(spark, sf_dir), path)
    for df in run_analysis(read_landed(spark, path), train=False).values():
        df.write.format("noop").mode("overwrite").save()


JOBS = {"analysis_summaries": analysis_summaries}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE + list(JOBS)
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, driver_memory="16g")
    REGISTRY["yearly_mean"].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        registry.forget_trained()  # cold: fits are not shared between queries
        t = time.perf_counter()
        if name in JOBS:
            JOBS[name](spark, sf_dir)
        else:
            REGISTRY[name].spark(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
