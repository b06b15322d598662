"""Time headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to the end into the no-op sink, twice; the faster run counts, so
start-up and code generation do not hide the query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

HEADLINE = [
    "star_lookup", "surrogate_key", "url_host", "date_arith", "join_or_rewrite", "join_range_date", "join_full_outer",
    "union_relations", "sym_diff", "deduplicate", "first_last_event", "lag_sequence", "running_sum", "scd2_intervals",
    "global_row_number", "moving_zscore", "agg_summary", "pivot", "unpivot", "percentile_median", "mart_summary",
    "mart_retention", "mart_dashboard", "compare_queries", "compare_all_columns", "date_dimension", "dq_runner",
    "dq_ranges", "exp_column_values_to_be_increasing", "exp_column_quantile_values_to_be_between",
    "exp_column_values_to_be_within_n_moving_stdevs", "merge_upsert", "scd2_snapshot", "csv_load_quarantine",
    "model_emails", "model_event_enrich", "model_identity", "model_golden_record", "model_dim_date",
    "model_fact_enrollment",
]


def main() -> None:
    from siltworks.bindings import QUERIES

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "12g")
             .config("spark.sql.adaptive.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").count()
    times = {}
    for name in wanted:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": folder.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
