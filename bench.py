"""Wall seconds of the headline queries, as one JSON line.

Each query is run to completion into a sink that discards rows; the first run warms
up, the median of the following runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from textmill.checks.queries import all_queries  # noqa: E402
from textmill.session import build_session  # noqa: E402

HEADLINE = (
    "f05_normalize", "p11_pii_kinds", "d01_drop_duplicates", "c01_classify", "c02_clean", "a01_cleaning_stats",
    "s04_manifest", "k02_split", "a04_dataset_fingerprint", "n08_noisy_corpus", "e03_token_f1", "e05_rouge1",
    "e07_rouge_l", "e11_eval_result", "g11_moderated_exchanges", "g12_request_status", "w01_rate_limit",
    "w02_rate_limit_stream", "w03_guard_stream", "t02_best_checkpoint",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in wanted:
        run, times = all_queries()[name], []
        for _ in range(runs + 1):
            start = time.perf_counter()
            run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_wall_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
