"""Time every query: one JSON line.

BENCH_SF_DIR  table folder          (default /root/testdata/sf0.1)
BENCH_CPUS    local cores           (default 8)
BENCH_ONLY    comma-separated names (default: the headline queries)
BENCH_DUCKDB  1 also times each query's SQL in DuckDB on as many threads
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from assayloom import build_session  # noqa: E402
from suite import QUERIES, SQL  # noqa: E402

HEADLINE = [
    "enrich_training_rows", "enrich_training_rows_by_position", "enrich_prediction_rows", "compound_dimension",
    "model_frame", "table_profile", "observation_stats", "group_stats", "metadata_join", "two_key_join",
    "donor_fan_out", "property_join", "salted_join", "salted_donor_fan_out", "concat_by_position", "row_index",
    "clean_names", "cut_at_semicolon", "value_shares", "first_seen_values", "first_match_per_key",
    "difference_of_ids", "column_completeness", "exact_size_sample", "three_way_holdout", "ordinal_encoding",
    "affine_many_outputs", "squared_error_vectors", "undirected_edges", "graph_sizes", "fingerprint_positions",
    "provider_lookup", "two_stage_regression", "multi_output_ridge", "multi_output_scoring", "csv_round_trip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = os.environ.get("BENCH_ONLY")
    names = only.split(",") if only else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
                          spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    out = {
        "metric": "headline queries, total wall-clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": re.sub(r".*sf", "", sf_dir.rstrip("/")),
    }
    if os.environ.get("BENCH_DUCKDB"):
        from tests.check import duck

        con = duck(sf_dir)
        con.execute(f"SET threads = {cpus}")
        peer = {}
        for name in names:
            if name in SQL:
                start = time.perf_counter()
                con.execute(f"CREATE OR REPLACE TEMP TABLE _out AS {SQL[name]}")
                peer[name] = round(time.perf_counter() - start, 3)
        out["duckdb"] = peer
    print(json.dumps(out))


if __name__ == "__main__":
    main()
