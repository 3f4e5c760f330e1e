"""Headline queries, timed: prints one JSON line.

``$BENCH_SF_DIR`` (default sf0.1) and ``$BENCH_CPUS`` (default 8) set the input and the cores.
Each query is run to the end of its result without fetching it (the ``noop`` sink). A time
covers building the plan, all jobs the query starts on the way, and the result. Each query is
run once unmeasured, so that class loading and code generation are not part of its time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from reedbed.plans import QUERIES  # noqa: E402
from reedbed.session import build_session  # noqa: E402

HEADLINE = [
    "cleaned_recordings",
    "filter_funnel",
    "dashboard_frame",
    "anchor_most_frequent",
    "occurrence_distribution",
    "target_by_state",
    "records_by_month",
    "species_pairs",
    "dataset_summary",
    "grouped_distribution_total",
    "describe_by_species",
    "sample_target_downsample",
    "sample_target_upsample",
    "sample_other_stratified",
    "sample_modelling_dataset",
    "split_by_id",
    "embedding_coverage",
    "incremental_features",
    "frame_sliding",
    "pool_segments_mean",
    "pool_mean",
    "pool_voting",
    "pool_topk",
    "confusion_counts",
    "classification_report",
    "roc_auc_per_class",
    "average_precision_per_class",
    "daily_metric",
    "metric_violation",
    "feature_table_range",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(cpus, int(cpus) if cpus.isdigit() else None)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in HEADLINE:
        run(name)
    times = {name: run(name) for name in HEADLINE}
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
