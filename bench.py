"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. The tables are written anew in as
many files as there are cores, before any clock runs: each of them is one row group, which
one task would read. Every query runs once to warm up and then three times; the median
counts. The result is written to Spark's no-op sink, so that all rows and columns are
computed.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time
from pathlib import Path

from content_signals.catalog import QUERIES
from content_signals.session import local_session

HEADLINE = [
    "token_counts",
    "frequency_score",
    "multi_source_score",
    "run_trend_scoring",
    "dedup_sources",
    "dedup_video_ids",
    "top_n_per_query",
    "query_stats",
    "id_batches",
    "extract_page_links",
    "run_link_collection",
    "run_video_collection",
    "render_prompt",
    "ready_and_prompts",
    "trend_validation",
]
RUNS = 3


def in_files(spark, sf_dir: str, files: int) -> str:
    """The tables in a new folder, each in so many files."""
    folder = tempfile.mkdtemp(prefix="bench-")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        spark.read.parquet(str(path)).repartition(files).write.parquet(f"{folder}/{path.name}")
    return folder


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    name, sf_dir = os.path.basename(sf_dir.rstrip("/")), in_files(spark, sf_dir, int(cpus))
    timings = {}
    for query in HEADLINE:
        seconds(spark, query, sf_dir)
        timings[query] = round(statistics.median(seconds(spark, query, sf_dir) for _ in range(RUNS)), 3)
    version, heap = spark.version, spark.conf.get("spark.driver.memory")
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": name.removeprefix("sf"),
                "cpus": int(cpus),
                "heap": heap,
                "spark": version,
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
