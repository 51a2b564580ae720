"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores, BENCH_QUERIES (optional) the
queries to run. Every query is read to its last row and column.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from hubcat.queries import queries  # noqa: E402
from hubcat.queries.papers import word_vectors  # noqa: E402
from hubcat.session import tune  # noqa: E402

HEADLINE = (
    "m1_models_table", "m2_datasets_table", "f6_tags", "f8_text_flags", "a3_flag_counts",
    "a6_top_tags", "a7_value_stats", "e1_taxonomy", "e2_term_vectors", "x1_vector_match",
    "e4_best_match", "e6_multilabel", "e8_labelled_papers", "a13_summary", "j2_merge", "j3_freshness",
    "j4_resolve", "c1_citation_run", "r3_batches", "j5_weekly_asof",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    chosen = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = (
        tune(SparkSession.builder.master(f"local[{cpus}]").appName("hubcat-bench"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    # A long-running session is measured: compile each plan once on the smallest tables.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in chosen:
            known[name](spark, small).write.format("noop").mode("overwrite").save()
    word_vectors(spark, sf_dir)  # an input table of e8, not a part of it
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
