"""Headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Each query runs once on the smallest tables to warm up, then three times; the median counts. A query whose first run takes
more than ``LONG`` seconds is not repeated.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from scenequarry.plans import load_all
from scenequarry.session import build_session

LONG = 20
WARM = "/root/testdata/sf0.001"
HEADLINE = (
    "object_summary",
    "majority_vote",
    "outlier_filter",
    "bounds_trimmed",
    "crop_box",
    "morton_order",
    "histogram",
    "weighted_draw",
    "coverage_scores",
    "track_values",
    "asset_upsert",
    "vertex_normals",
    "tsdf_fusion",
    "knn",
    "near_duplicates",
    "face_components",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus, 2 * int(cpus) if cpus.isdigit() else 16)
    spark.sparkContext.setLogLevel("ERROR")
    queries = load_all().QUERIES

    def run(name: str, where: str) -> float:
        start = time.time()
        queries[name](spark, where).write.format("noop").mode("overwrite").save()
        return time.time() - start

    times = {}
    for name in HEADLINE:
        run(name, WARM)
        took = [run(name, sf_dir)]
        while took[0] < LONG and len(took) < 3:
            took.append(run(name, sf_dir))
        times[name] = round(median(took), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
