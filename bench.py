"""Time the headline queries; prints one JSON line.

Reads ``BENCH_SF_DIR`` (tables) and ``BENCH_CPUS`` (local cores). Every query runs whole,
with its result written to the no-op sink; the time is the better of two runs.
"""

import contextlib
import json
import os
import sys
import time

from quotelens.plans.queries import QUERIES
from quotelens.session import local_session

HEADLINE = (
    "quote_grounding_by_source",
    "quote_overlap",
    "in_row_grounding",
    "request_grounding",
    "document_trigrams",
    "curated_documents",
    "document_metrics",
    "dataset_metrics",
    "response_status",
    "chat_sections",
    "vocabulary",
    "token_ids",
    "training_arrays",
    "padded_batches",
    "load_summary_by_endpoint",
    "request_gaps",
    "early_stops",
    "text_lengths",
    "metric_points",
    "label_drift",
    "five_minute_means",
    "alarm_states_by_adapter",
    "live_five_minute_means",
    "latest_version",
)


def run(spark, name, folder):
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names):
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    with contextlib.redirect_stdout(sys.stderr):
        spark = local_session(os.environ.get("BENCH_CPUS", "8"))
        run(spark, names[0], folder)  # starts the JVM code paths
        times = {n: round(min(run(spark, n, folder) for _ in range(2)), 3) for n in names}
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(os.path.basename(os.path.normpath(folder)).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:] or HEADLINE)
