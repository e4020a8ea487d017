"""Readers and writers for raw text, layers, keyed records and reports."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cartwake import schema as S
from cartwake.functions import scalar as X
from cartwake.operators.ingest import parse_events


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder every executor can reach.

    It lies under ``spark.checkpoint.dir``.  Only in local mode, as in tests, may the
    session name none; then a temporary folder of this machine is used.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cartwake-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage, and survives the loss of executors.
    """
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# -- raw --------------------------------------------------------------------
def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Newline-delimited JSON with the fixed superset schema, text kept."""
    return parse_events(spark.read.text(path))


def write_ndjson(df: DataFrame, path: str) -> None:
    """One JSON object per line, times to the microsecond."""
    whole = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    times = {"timestampNTZFormat": whole, "timestampFormat": f"{whole}XXX"}
    df.write.mode("overwrite").options(**times).json(path)


def read_layer(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A Parquet layer; ``schema`` keeps the types of its partition columns.

    Spark guesses those from folder names otherwise, and takes ``01`` for a number.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_layer(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Overwrite a Parquet layer; returns the rows written.

    The count reads the footers of the files just written, no data pages.  (An
    ``Observation`` would ride on the write, but once used it leaves the session
    unable to serialise plans over cached tables.)
    """
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return read_layer(df.sparkSession, path).count()


def write_days(df: DataFrame, path: str, by: tuple[str, ...] = ("year", "month", "day")) -> int:
    """Replace the days that ``df`` has rows of, leave others; returns the rows of the layer.

    Rows are first brought together by day: a day is a few files whatever the number of
    tasks, and one with very many rows is spread over tasks by size.
    """
    together = df.hint("rebalance", *by)
    together.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    return read_layer(df.sparkSession, path).count()


def last_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch that a stream with this checkpoint finished, -1 before the first."""
    try:
        done = spark.read.format("binaryFile").load(f"{checkpoint.rstrip('/')}/commits").select("path")
    except AnalysisException:
        return -1
    number = F.regexp_extract("path", r"/commits/(\d+)$", 1)
    last = done.filter(number != "").agg(F.max(number.cast("bigint"))).first()[0]
    return -1 if last is None else last


def short_id(*parts: Column) -> Column:
    """Eight hex digits that are the same on every run of a task."""
    return F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8)


def _identity() -> list[Column]:
    return [
        F.col("session_id"),
        F.col("event_type"),
        F.col("ts_us").cast("string"),
        F.col("event_id").cast("string"),
    ]


def raw_key(prefix: str = "raw") -> Column:
    return F.concat(
        F.lit(f"{prefix}/"), X.date_path(F.col("event_timestamp")), F.lit("/"),
        F.col("event_type"), F.lit("_"), F.col("session_id"), F.lit("_"),
        short_id(*_identity()), F.lit(".json"),
    )


def enriched_key(prefix: str = "enriched") -> Column:
    return F.concat(
        F.lit(f"{prefix}/"), X.date_path(F.col("event_timestamp")), F.lit("/"),
        F.col("session_id"), F.lit("_"), F.col("event_type"), F.lit("_"),
        short_id(*_identity()), F.lit(".json"),
    )


def date_columns(df: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    return df.withColumns(
        {n: F.date_format(ts, f) for n, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))}
    )


def write_bodies(df: DataFrame, path: str, mode: str = "append") -> None:
    """The text of each accepted event as it was posted, under its event date.

    ``raw_key`` of the typed event names the object, so it is not stored again.
    """
    rows = date_columns(df).select("value", "year", "month", "day")
    rows.write.mode(mode).partitionBy("year", "month", "day").text(path)


def write_raw(df: DataFrame, path: str, mode: str = "append") -> None:
    """Typed events as JSON text under their event date, each with its key."""
    rows = date_columns(df.withColumn("raw_key", raw_key()))
    rows.write.mode(mode).partitionBy("year", "month", "day").json(path)


def enriched_records(
    df: DataFrame, features: list[str], raw: list[str], processed_at: Column
) -> DataFrame:
    """One JSON record per event: the event, its key, features and answer.

    Events that were not scored have null features and a count of zero.
    """
    known = F.col("velocity_trend").isNotNull()
    record = F.struct(
        F.struct(*raw).alias("raw_event"),
        raw_key().alias("raw_key"),
        F.when(known, F.struct(*features)).alias("features"),
        F.struct("abandon_probability", "trigger_retention", "retention_type").alias("inference"),
        F.when(F.col("status") == "scored", F.col("history_beats")).otherwise(0).alias(
            "heartbeat_count"
        ),
        processed_at.alias("processed_at"),
    )
    return date_columns(
        df.select(
            "event_id", "event_timestamp", enriched_key().alias("enriched_key"),
            F.to_json(record).alias("record"),
        )
    )


def write_enriched(records: DataFrame, path: str, mode: str = "append") -> None:
    records.drop("event_timestamp", "event_id").write.mode(mode).partitionBy(
        "year", "month", "day"
    ).json(path)


def compact(
    spark: SparkSession, source: str, target: str, files: int | None = None,
    consolidated: str = "all_events.ndjson", pattern: str = "*.json", checkpoint: str | None = None,
) -> None:
    """Gather small text files below ``source`` into few large text files.

    ``checkpoint`` is that of the stream that writes ``source``, one folder a batch: then only
    batches that it finished are read, so a batch that is being written or is written again
    adds nothing.

    A consolidated file there is taken as it is.  Otherwise Spark packs the small
    files into read tasks of ``spark.sql.files.maxPartitionBytes`` and each task
    writes one file, with no shuffle; ``files`` asks for an exact number.
    """
    try:
        lines = spark.read.text(f"{source.rstrip('/')}/{consolidated}")
    except AnalysisException:
        lines = None
    if lines is None and checkpoint is not None:
        last = last_batch(spark, checkpoint)
        # The folder names are columns, so unfinished ones are not even listed for reading.
        lines = spark.read.text(source).filter(F.col("batch") <= last)
    elif lines is None:
        lines = (
            spark.read.option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")
            .text(source)
        )
    if files is not None:
        lines = lines.repartition(files)
    lines.select("value").write.mode("overwrite").text(target)


# -- session state ----------------------------------------------------------
def state_items(df: DataFrame, written_at: Column, ttl_s: int = S.STATE_TTL_S) -> DataFrame:
    """Key, expiry and whitelisted fields of each event's state item.

    Doubles become decimals, and fields an event does not have are left out.
    """
    fields = [c for c in S.STATE_FIELDS if c in df.columns]
    kinds = dict(df.dtypes)

    def stored(c: str) -> Column:
        return F.col(c).cast("decimal(18,4)").alias(c) if kinds[c] == "double" else F.col(c)

    return df.select(
        "session_id",
        (F.col("ts_us") / F.lit(X.MICROS)).cast("decimal(18,6)").alias("timestamp"),
        raw_key().alias("raw_key"),
        (F.floor(F.unix_micros(written_at) / X.MICROS) + ttl_s).alias("ttl"),
        F.to_json(
            F.struct(*[stored(c) for c in fields]), {"ignoreNullFields": "true"}
        ).alias("item"),
        "event_id",
    )


# -- reports ----------------------------------------------------------------
def write_report(df: DataFrame, path: str) -> None:
    """A small result as JSON lines in one file."""
    df.coalesce(1).write.mode("overwrite").json(path)
