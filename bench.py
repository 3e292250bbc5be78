"""Time headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "parcel_rollup",
    "primary_largest",
    "primary_optimal",
    "link_instances_to_roofs",
    "component_overlaps",
    "score_resolution",
    "combine_grid",
    "split_into_grid",
    "parse_features",
    "roof_component_numbers",
    "damage_rollup",
    "latest_survey_per_point",
    "footprint_union_area",
    "latency_stats",
    "rollup_diff",
    "column_profile",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)

    from parcelweave.plans import registry
    from parcelweave.session import drop_scratch, local_session

    registry.load()
    spark = local_session(cpus, "bench")
    # Small runs first, so that the timings leave out JVM and worker start-up.
    for name in ("link_instances_to_roofs", "parcel_rollup"):
        registry.QUERIES[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": float(sf)}))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
