"""Times the headline queries, warm, and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time

from pagelode.plans import fixtures as fx
from pagelode.plans.queries import REGISTERED
from pagelode.session import build_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
HEADLINE = [
    "search",
    "search_batch",
    "suggest",
    "term_frequency",
    "index_build",
    "detect_language",
    "out_links",
    "match_by_ngrams",
    "reachable_pages",
    "recrawl_throttle",
    "postings_by_word",
    "stream_index",
]


def timed(function) -> float:
    start = time.perf_counter()
    function()
    return time.perf_counter() - start


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "pagelode-bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    fx.index(spark, FOLDER)
    seconds = {
        "store_build": statistics.median(timed(lambda: fx.build_index(spark, FOLDER)) for _ in range(RUNS))
    }
    for name in HEADLINE:
        run = lambda: drain(REGISTERED[name](spark, FOLDER))  # noqa: B023, E731
        run()
        seconds[name] = statistics.median(timed(run) for _ in range(RUNS))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, warm median",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {name: round(s, 3) for name, s in seconds.items()},
                "sf": os.path.basename(FOLDER.rstrip("/")),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
