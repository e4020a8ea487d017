"""Streaming jobs run to the end of the click view, then read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwake.operators import ingest as I
from cartwake.queries.base import CLICK, ORACLES, Tables, query
from cartwake.queries.ingest import MESSY, messy_json
from cartwake.queries.serve import linear_score, offer_clicks, shipped
from cartwake.sources import files
from cartwake.streaming import jobs


def _as_lines(events: DataFrame) -> DataFrame:
    """Events as JSON text with an ISO time, as the ingest side receives them."""
    stamp = F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    rows = events.withColumn("timestamp", stamp).drop("event_timestamp", "ts_us", "qty")
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


@query("stream_answers", ORACLES["offer_lifecycle"])
def _stream_answers(t: Tables) -> DataFrame:
    folder = files.shared_folder(t.spark, "answers")
    _as_lines(shipped(offer_clicks(t))).write.text(f"{folder}/in")
    lines = jobs.read_lines(t.spark, f"{folder}/in")
    events = I.bronze(I.parse_events(lines))
    job = jobs.start_answers(events, linear_score, f"{folder}/out", f"{folder}/checkpoint")
    job.awaitTermination()
    return t.spark.read.parquet(f"{folder}/out/answers").drop("batch", "position", "ts_us")


@query(
    "stream_ingest",
    f"""with {MESSY} select event_type, null as error, count(*) as event_count from checked where error is null group by event_type
    union all select null, error, count(*) from checked where error is not null group by error""",
)
def _stream_ingest(t: Tables) -> DataFrame:
    folder = files.shared_folder(t.spark, "ingest")
    messy_json(t).write.text(f"{folder}/in")
    job = jobs.start_ingest(
        jobs.read_lines(t.spark, f"{folder}/in"), f"{folder}/raw", f"{folder}/rejects",
        f"{folder}/checkpoint",
    )
    job.awaitTermination()
    raw = t.spark.read.schema("event_type string, batch bigint, year string, month string, day string")
    stored = raw.json(f"{folder}/raw").select("event_type", F.lit(None).cast("string").alias("error"))
    refused = t.spark.read.schema("error string, batch bigint").json(f"{folder}/rejects").select(
        F.lit(None).cast("string").alias("event_type"), "error"
    )
    return stored.unionByName(refused).groupBy("event_type", "error").agg(
        F.count(F.lit(1)).alias("event_count")
    )


@query(
    "stream_dedup",
    f"with {CLICK} select event_type, count(*) as event_count, sum(ts_us)::bigint as sum_us from click group by event_type",
)
def _stream_dedup(t: Tables) -> DataFrame:
    """Each event once, though the files of the stream repeat every third event in another file."""
    folder = files.shared_folder(t.spark, "dedup")
    lines = _as_lines(t.clicks)
    lines.write.text(f"{folder}/in")
    _as_lines(t.clicks.filter(F.col("event_id") % 3 == 0)).write.mode("append").text(f"{folder}/in")
    events = I.bronze(I.parse_events(jobs.read_lines(t.spark, f"{folder}/in", files_per_batch=4)))
    jobs.start_deduplicated(events, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    kept = t.spark.read.schema("event_type string, ts_us bigint, batch bigint").parquet(f"{folder}/out")
    return kept.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        # Counted from the start of the view, as everywhere in it.
        F.sum(F.col("ts_us") - F.unix_micros(F.lit("2024-01-01").cast("timestamp"))).alias("sum_us"),
    )
