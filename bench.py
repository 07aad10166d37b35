"""Time the headline queries; prints one line of JSON.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the threads. Each query runs once to warm up and
is then timed, with all its rows produced and thrown away.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vialume.plans import all_queries  # noqa: E402
from vialume.session import build_session  # noqa: E402

HEADLINE = (
    "history_range", "day_stats", "range_kpis", "by_hour", "hourly_congestion", "latest_status", "last_state",
    "adaptive_thresholds", "sliding_windows", "sliding_windows_5min", "window_stats", "forecast_each_window",
    "forecast_state", "recent_windows", "drop_unchanged", "collapse_starts", "collapse_episodes",
    "boxes_in_mask", "boxes_in_zones", "zone_counts", "assign_best_zone", "count_overlapping", "suppress_overlaps",
    "count_vehicles", "detection_report", "enrich_counts", "build_catalog", "dedup_content", "dedup_report",
    "class_weights", "classification_metrics", "score_without_model", "pixel_stats", "stream_classified",
    "stream_collapse_starts", "stream_windows",
)
#: Timed beside the headline, not part of its total: files, pictures, fits and the newer streams.
OTHERS = (
    "labels_from_csv", "relabel_in_place", "suppress_crowded", "uniform_pictures", "forest_facts", "stream_windows_5min", "stream_late_rows",
    "stream_latest_status",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [*HEADLINE, *OTHERS]
    spark = build_session("vialume-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "16g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    took: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            started = time.perf_counter()
            queries[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - started, 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    total = sum(seconds for name, seconds in took.items() if name not in OTHERS)
    print(json.dumps({"metric": "headline queries, total", "value": round(total, 3), "unit": "sec", "queries": took, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
