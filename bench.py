"""Headline queries, timed on one machine; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "bronze_types", "silver_motion", "gold_sessions", "gold_joins", "online_session",
    "online_features", "window_30s", "dwell_segments", "funnel", "history_session",
    "session_rows", "validate_events", "dedup_events", "state_upsert", "buffer_flush",
    "cart_value", "history_last150", "warmup_gate", "replay_features", "retention_decision",
    "describe_features", "dataset_summary", "stratified_split", "auc_roc", "average_precision",
    "threshold_tuning", "oversample", "offer_lifecycle", "stream_answers", "stream_ingest",
]


def stream_latency(spark, sf_dir: str, batches: int = 10) -> dict[str, float]:
    """Events per second and percentiles of the seconds that a micro-batch takes to answer."""
    from cartwake.queries import Tables
    from cartwake.queries.serve import linear_score, offer_clicks, shipped
    from cartwake.queries.stream import _as_lines
    from cartwake.sources import files
    from cartwake.streaming import jobs

    folder = files.shared_folder(spark, "bench")
    _as_lines(shipped(offer_clicks(Tables(spark, sf_dir)))).repartition(batches).write.text(f"{folder}/in")
    lines = jobs.read_lines(spark, f"{folder}/in", files_per_batch=1)
    job = jobs.start_answers(jobs.typed_events(lines), linear_score, f"{folder}/out", f"{folder}/checkpoint")
    job.awaitTermination()
    done = [p for p in job.recentProgress if p.numInputRows]
    took = sorted(p.batchDuration / 1000 for p in done)
    rank = lambda q: took[min(len(took) - 1, int(q * len(took)))]
    rows = sum(p.numInputRows for p in done)
    return {"events_per_s": round(rows / sum(took), 1), "p50_s": rank(0.5), "p95_s": rank(0.95), "p99_s": rank(0.99)}


def main() -> None:
    from pyspark.sql import SparkSession

    from cartwake.queries import QUERIES, Tables

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cartwake-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Call-site capture doubles the time Python takes to build a large plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    tables = Tables(spark, sf_dir)
    tables.clicks.write.format("noop").mode("overwrite").save()
    times = {}
    # Layouts are profiled once per table folder, as statistics are, and that counts.
    start = time.perf_counter()
    tables.layout, tables.arrival, tables.long_layout  # noqa: B018
    times["profile_layouts"] = round(time.perf_counter() - start, 3)
    for name in sys.argv[1:] or HEADLINE:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](Tables(spark, sf_dir)).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stream": {} if sys.argv[1:] else stream_latency(spark, sf_dir),
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
