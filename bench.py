"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose
the data and the cores; BENCH_QUERIES names queries to run, comma-separated.
Each query runs once, to completion, without collecting its rows; two untimed
queries warm the session up.
"""

from __future__ import annotations

import json
import os
import time

from tabloom.plans.catalog import QUERIES
from tabloom.session import local_session

HEADLINE = [
    "feature_table",
    "person_scores_director",
    "entity_scores_writer",
    "number_rows",
    "bridge_clean",
    "impute_median",
    "title_features",
    "upsert",
    "insert_ignore",
    "fk_orphans",
    "pk_violations",
    "dq_report",
    "duplicate_rows",
    "keep_first",
    "fanout_person_stats",
    "fanout_median",
    "list_scores",
    "degree_distribution",
    "correlation",
    "histogram",
    "class_quantiles",
    "hash_split",
    "csv_roundtrip",
    "json_lines",
    "stream_ingest",
    "stream_upsert",
    "predictions_csv",
    "etl_movies",
    "assemble",
    "score_rf",
    "auc",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    spark = local_session(cpus)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for name in ("value_counts", "entity_scores_director"):
        run(name)
    times = {name: run(name) for name in (names.split(",") if names else HEADLINE)}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
