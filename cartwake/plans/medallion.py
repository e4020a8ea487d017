"""Batch job: raw text to bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cartwake.layout import SessionLayout, profile_sessions
from cartwake.operators import ingest, motion, sessions
from cartwake.sources import files


def build_layers(
    spark: SparkSession,
    raw_path: str,
    out: str,
    layout: SessionLayout | None = None,
    whole_seconds: bool = True,
    gold_by_date: bool = False,
) -> dict[str, int]:
    """Write ``bronze``, ``silver``, ``gold`` and ``rejects`` below ``out``.

    Returns the rows of each.  Days that the raw text has events of are replaced, others
    stay.  Silver and gold read the typed bronze files, so
    each scans only the columns it needs; gold needs no silver.
    """
    raw = files.read_raw(spark, raw_path)
    typed = ingest.bronze(raw)
    rows = {
        "bronze_rows": files.write_days(typed, f"{out}/bronze"),
        "rejected_rows": files.write_layer(ingest.bad_timestamps(raw), f"{out}/rejects"),
    }
    bronze = files.read_layer(spark, f"{out}/bronze", typed.schema)
    layout = layout or profile_sessions(bronze)
    rows["silver_rows"] = files.write_layer(
        motion.silver(bronze, layout, whole_seconds), f"{out}/silver"
    )
    gold = sessions.gold(bronze, layout, whole_seconds)
    if gold_by_date:
        day = F.coalesce("session_start", F.lit(None).cast("timestamp_ntz"))
        rows["gold_rows"] = files.write_days(
            files.date_columns(gold.withColumn("_day", day), "_day").drop("_day"), f"{out}/gold"
        )
    else:
        rows["gold_rows"] = files.write_layer(gold, f"{out}/gold")
    return rows
