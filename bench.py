"""Time the headline queries: one JSON line with seconds per query (median of the warm runs)."""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerloom.catalog import collect
from ledgerloom.session import local_session

HEADLINE = (
    "fin_q01", "fin_q03", "fin_q07", "fin_q09", "variance_bridge", "budget_variance", "metric_query",
    "scm_q01", "scm_q02", "scm_q06", "scm_q08", "com_q01", "com_q06", "com_q07", "com_q09", "com_q10",
    "rls_filter", "chargeback_group", "guardrail_eval", "state_replay", "execute_outcomes", "product_match",
    "detect_breach", "gate_and_route", "doc_classify", "doc_chunk", "doc_parse", "text_mask", "vec_topk", "mem_search",
    "forecast", "eval_facts", "thread_append", "upsert_latest", "stream_detect",
)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="bench")
    spark.sparkContext.setLogLevel("OFF")
    queries, _ = collect()

    def once(key: str) -> float:
        t0 = time.perf_counter()
        queries[key](spark, root).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    seconds = {}
    for key in HEADLINE:
        once(key)
        seconds[key] = round(statistics.median(once(key) for _ in range(runs)), 3)
    found = re.search(r"sf([0-9.]+)", root)
    print(json.dumps({
        "metric": "total_warm_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(found.group(1)) if found else None,
        "cpus": cpus, "spark": spark.version, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
