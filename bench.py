"""Benchmark: the published pipeline stages on the driver tables.

Setup (not timed): the driver tables are landed once as raw JSON snapshot
files in the published record shape.  Timed: JSON read, clean + pivot,
features + anomalies, the partitioned detailed write, the eight marts (from
the re-read detailed table), partition-pruned reads of one region / one
department, a full scan, and headline registered queries.

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pyspark.sql import functions as F

    from pricelens.operators import clean
    from pricelens.plans import bindings as B
    from pricelens.plans import pipeline
    from pricelens.plans.catalog import load_all
    from pricelens.session import build_session, scratch_path
    from pricelens.sources import files, landing

    spark = build_session("pricelens-bench", master=f"local[{cpus}]",
                          shuffle_partitions=2 * cpus,
                          conf={"spark.driver.memory": "16g",
                                "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    base = scratch_path(spark, f"bench-{uuid.uuid4().hex}")

    # ---- setup: land the raw snapshot files (not timed)
    raw_path = f"{base}/raw"
    landing.write_json_array(B.raw_snapshot(spark, sf_dir).repartition(2 * cpus), raw_path)

    times = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    raw = files.scan_json(spark, raw_path, glob="part-*")
    timed("json_read", lambda: run(raw))          # every field parsed
    n_raw = raw.count()

    # E1 as run_detailed runs it, one timed stage per published step
    long_df = clean.clean_observations(raw, low=0.0, high=50000.0)
    wide = timed("clean_pivot", lambda: pipeline.build_wide(long_df, raw_products=B.RAW_PRODUCTS))
    n_wide = wide.count()
    detailed_path = f"{base}/out/detailed"

    def features_anomalies_write():
        det = pipeline.detailed_from_wide(wide, products=B.PRODUCTS, flagged=B.FLAGGED,
                                          run_ts="2025-06-30T08:00:00")
        files.write_table(det, detailed_path, partition_by=list(pipeline.DETAILED_PARTITIONS))
    timed("features_anomalies_write", features_anomalies_write)

    # The eight marts from the re-read detailed table
    timed("aggregations_x8", lambda: pipeline.run_marts(spark, detailed_path, f"{base}/out",
                                                       products=B.PRODUCTS))

    det = files.scan_parquet(spark, detailed_path,
                             string_partitions=pipeline.DETAILED_PARTITIONS)
    timed("filter_one_region", lambda: det.filter(F.col("region_code") == "84").count())
    timed("filter_one_department", lambda: det.filter(F.col("departement") == "01").count())
    timed("full_scan", lambda: run(det.agg(*[F.count(c) for c in det.columns])))

    # operator-level timings on the materialised wide table (not in the total)
    from pricelens.operators import anomaly, features
    timed("op_features", lambda: run(features.add_features(
        wide, B.PRODUCTS, flagged=B.FLAGGED,
        tiebreak=[c for c in wide.columns if c not in B.PRODUCTS and c not in
                  ("id", "prix_maj_date")])))
    timed("op_iqr_exact", lambda: run(anomaly.iqr_bounds(wide, B.PRODUCTS)))
    timed("op_iqr_sketch", lambda: run(anomaly.iqr_bounds(wide, B.PRODUCTS, method="approx")))

    cat = load_all()
    for name in ("agg_by_region", "agg_by_department_date", "top_n_per_group",
                 "iqr_bounds", "pipeline_detailed", "pipeline_map", "bounded_sample"):
        timed(f"q_{name}", lambda n=name: run(cat[n].spark(spark, sf_dir)))

    stages = ["json_read", "clean_pivot", "features_anomalies_write", "aggregations_x8",
              "filter_one_region", "filter_one_department", "full_scan"]
    total = round(sum(times[s] for s in stages), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "pipeline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "rows_raw": n_raw, "rows_wide": n_wide,
                      "cpus": cpus}))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
