"""Benchmark: run every registered query over the whole tables of $BENCH_SF_DIR.

Each query is forced end to end with the ``noop`` sink (full computation, nothing
collected to the driver) and timed separately. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from candor.plans.registry import load_all  # noqa: E402
from candor.session import local_session  # noqa: E402

HEADLINE = (
    "engagement_cells", "hot_video_rank", "hot_img_rank", "topn_index", "community_review_index", "pool_clean",
    "review_board", "post_counters", "knn_exact", "i2i_neighbours", "i2i_quality_index", "boot_candidates",
    "boot_transition", "stream_counters", "recall_partition_share", "quota_merge",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or (list(load_all()) if os.environ.get("BENCH_ALL", "1") == "1" else list(HEADLINE))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")), app="candor-bench")
    reg = load_all()
    # JVM/JIT warm-up on a tiny input (not timed): the first query should not carry it.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        reg["engagement_cells"].run(spark, warm).write.format("noop").mode("overwrite").save()
        spark.catalog.clearCache()
    times: dict[str, float | None] = {}
    errors: dict[str, str] = {}
    for n in names:
        t0 = time.perf_counter()
        try:
            reg[n].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # keep measuring the others; report the failure
            times[n] = None
            errors[n] = f"{type(e).__name__}: {str(e)[:200]}"
        spark.catalog.clearCache()
    sf = sf_dir.rsplit("sf", 1)[-1]
    try:
        sf_val: float | str = float(sf)
    except ValueError:
        sf_val = sf
    out = {"metric": "total_query_seconds", "value": round(sum(t for t in times.values() if t is not None), 3),
           "unit": "sec", "queries": times, "sf": sf_val, "cpus": int(cpus)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
