"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = ("flagship", "robust_threshold", "classify_cells", "k_sweep", "region_readout", "gate_table", "reference_stats",
            "point_in_region", "cells_in_shape", "knn_unlabelled", "knn_self", "nearest_within", "local_chance", "k_vs_chance",
            "intensity_histogram", "span_threshold", "area_intensity", "robust_pixel_cut", "feathered_blend", "connected_blobs")


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("cytolattice-bench")
             .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
             .config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from cytolattice.plans import load_all
    from cytolattice.session import clear_settled
    queries, _ = load_all()
    only = sys.argv[1:] or HEADLINE
    queries["reference_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()      # warm the JVM
    times = {}
    for name in only:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        clear_settled(spark)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
