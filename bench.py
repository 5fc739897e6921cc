"""Headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR; prints one JSON line with seconds per query."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from refloom.catalog import load  # noqa: E402
from refloom.session import Tables, clear_scratch, get_session  # noqa: E402

HEADLINE = (
    "group_concat_master", "nested_master", "cogroup_unify", "first_non_null", "union_lists", "dataset_stats",
    "dedup_first", "upsert_latest", "left_join_master", "left_join_lookup", "pending_anti", "resolve_reference",
    "search_joined", "id_union", "page_slices", "limit_per_partition", "clean_text", "synonyms", "rebuild_text",
    "extract_ids", "flat_profile", "lines_to_records", "normalize_1_to_3", "explode_outer_flatten", "star_split",
    "page_links", "article_text", "dedup_either", "latest_state", "similarity_threshold",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = load()
    if names == ["all"]:
        names = list(registry)

    def once(name: str) -> float:
        start = time.perf_counter()
        registry[name].run(Tables(spark, root)).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    # The first queries pay for the JVM; their time is not the operators'.
    for name in ("status_counts", "dedup_first", "left_join_lookup"):
        once(name)
    seconds = {}
    for name in names:
        # The median of some runs; a query of over ten seconds runs once, as its time says enough.
        runs = [once(name)]
        while len(runs) < repeat and sum(runs) < 10:
            runs.append(once(name))
        seconds[name] = round(statistics.median(runs), 3)
        clear_scratch()
        if os.environ.get("BENCH_VERBOSE"):
            print(f"{name:28s} {seconds[name]:8.2f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(root.rstrip("/")), "cpus": int(cpus), "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
