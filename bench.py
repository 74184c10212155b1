"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the local cores. Every query writes all its rows to
the no-op sink, so no column is pruned away; the time includes building and planning the query.
"""

from __future__ import annotations

import importlib
import json
import os
import time

HEADLINE = (
    "scd2_versions", "scd2_merge", "scd2_stats", "detect_changes", "history_as_of", "current_state", "snapshot_diff",
    "cdc_envelope", "cdc_extract_record", "parse_events", "validate_cdc", "error_types", "dq_alerts",
    "validate_batch", "validate_schema", "rules_opportunity", "rules_case", "dedup_event_id", "duplicate_ids",
    "fk_orphans", "query_topk", "query_in_list", "quality_percent", "tumbling_hour", "extract_all_objects", "account_360",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    from crmflow.session import build_session

    spark = build_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    queries = importlib.import_module("__spark_entry__").queries()
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()  # start-up
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    print(json.dumps({
        "metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": cpus,
        "events_per_second": {
            "history": round(events / times["scd2_versions"]), "validation": round(events / times["validate_cdc"]),
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
