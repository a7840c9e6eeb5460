"""Wall time of the headline queries: median of warm runs, one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tallymark.plans import catalog
from tallymark.session import session

HEADLINE = (
    "validate_updates",
    "rejects_by_code",
    "batch_atomic",
    "fold_state",
    "fold_state_wide",
    "state_upsert",
    "state_upsert_wide",
    "list_state",
    "list_state_wide",
    "lookup_many",
    "src_update_uri",
    "src_update_json",
    "src_updates_batch",
    "snapshot_save",
    "snapshot_load",
    "collect_samples",
    "report_cumulative",
    "report_overcount",
    "report_payload",
    "stream_fold",
    "stream_upsert",
)


def run(spark, key: str, sf_dir: str) -> float:
    started = time.perf_counter()
    catalog.queries()[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    keys = sys.argv[1:] or HEADLINE
    spark = session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for key in keys:
        run(spark, key, sf_dir)
        seconds[key] = round(statistics.median(run(spark, key, sf_dir) for _ in range(runs)), 3)
        print(key, seconds[key], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of the medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
