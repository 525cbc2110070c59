"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm the session and $BENCH_RUNS times (1 by default) for the clock;
its time is the median. Results are written to the no-op sink, so every output column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import PurePosixPath

import catalog
from claimlens.session import local_session

HEADLINE = [
    "q1_benefit_classification",
    "q2_detail_rows",
    "q3_requests",
    "out3_detail_extract",
    "q5_holder_windows",
    "q6_holder_history",
    "q7_person_diagnoses",
    "q8_provider_profiles",
    "q9_insured_extract",
    "jn3_claim_document_detail",
    "ag7_several_count_distincts",
    "ag16_mode_of_every_column",
    "ag17_missing_values",
    "ag19_duplicate_report",
    "ag22_correlation_matrix",
    "ps1_anomalous_policies_with_series",
    "ps2_series_from_first_activity",
    "wn3_padded_row_id",
    "fe7_feature_set",
    "ml5_anomaly_scores_of_lines",
    "ml8_estimate_by_regression",
]


def seconds(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, memory="16g")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(runs)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": PurePosixPath(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
