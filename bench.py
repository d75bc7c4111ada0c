"""Time the headline queries; prints one JSON line.

The stand-in records are cut from the document texts once (``store_records``, counted) and read by
the queries that work on records.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores, ``BENCH_QUERIES`` a
comma-separated list of queries. Every query runs over its whole tables and all
its rows are computed.
"""

from __future__ import annotations

import json
import os
import time

from tidings.plans import tables
from tidings.plans.queries import QUERIES
from tidings.session import build_session, new_path

HEADLINE = [
    "cooc_weighted", "cooc_counts", "cooc_total", "cooc_top_k", "cooc_pairs",
    "cooc_sql_function", "cooc_sql_pairs", "entity_rank", "event_mentions", "split_items", "entity_names", "top_themes", "top_persons",
    "top_organizations", "top_values_raw", "rank_values", "master_projection", "day_slice",
    "record_times", "daily_report", "url_extract", "manifest_fields", "latest_files",
    "route_dataset", "new_files", "typed_records", "typed_events", "typed_mentions", "flat_files", "unzipped_lines",
    "stream_ingest", "ingest_late_files", "preview_transpose", "scene_search", "scene_bands", "band_composite",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str, folder: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    def store(folder: str) -> float:
        start = time.perf_counter()
        tables.store_records(spark, folder, new_path(spark, "records"))
        return time.perf_counter() - start

    # Starts the JVM's compiler and the Python workers; not counted.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        store(small)
        for name in names:
            run(name, small)

    seconds = {"store_records": round(store(sf_dir), 3)}
    seconds |= {name: round(run(name, sf_dir), 3) for name in names}
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
