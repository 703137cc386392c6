"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterwise import plans  # noqa: E402
from meterwise.session import get_session  # noqa: E402

HEADLINE = [
    "hourly_holiday_profile",
    "enrichment_chain",
    "vacation_interval_join",
    "weather_join",
    "polygon_join",
    "missing_profile",
    "duplicate_groups",
    "describe_numeric",
    "exact_quantiles",
    "box_statistics",
    "correlation_matrix",
    "cross_distributions",
    "resample_hours",
    "decomposition",
    "autocorrelation_672",
    "supervised_table",
    "anderson_darling",
    "kruskal_wallis",
    "factor_variance",
    "modality_association",
    "population_scaler",
    "linear_regression",
    "knn_euclidean",
    "similar_items",
    "predict_from_users",
    "roc_curve",
    "smote",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = get_session(
        "meterwise-bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
        spark__checkpoint__dir=os.environ.get("BENCH_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="bench-checkpoint-"),
    )
    spark.sparkContext.setLogLevel("OFF")
    plans.QUERIES["hourly_holiday_profile"](spark, folder).write.format("noop").mode("overwrite").save()  # warm the JVM
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        plans.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
