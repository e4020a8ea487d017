"""Streaming jobs: ingest raw events, and answer them.

Batches are written under their own number and overwrite it, so a batch that is
run again after a lost executor or driver leaves the same files.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartwake import schema as S
from cartwake.functions.history import add_history_features
from cartwake.operators import ingest, replay
from cartwake.operators.decision import model_row, payload
from cartwake.sources import files
from cartwake.streaming.sessions import ROCKSDB, batch_history, with_session_items

_LOG = logging.getLogger(__name__)


def read_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of raw JSON lines from a folder; any text source will do."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def typed_events(lines: DataFrame, accept_selected_method: bool = False) -> DataFrame:
    """Accepted and typed events of a stream of lines, with times of any offset."""
    checked = ingest.validate(ingest.parse_events(lines), accept_selected_method)
    return ingest.bronze(ingest.accepted(checked), online=True)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings that a query takes with it when it starts; the session has its own again after."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def without_repeats(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drop events repeated within ``delay``, and state older than it."""
    timed = events.withColumn("_time", F.timestamp_micros("ts_us"))
    return (
        timed.withWatermark("_time", delay)
        .dropDuplicatesWithinWatermark(["session_id", "event_id", "ts_us"])
        .drop("_time")
    )


def start_deduplicated(
    events: DataFrame, path: str, checkpoint: str, delay: str = "1 hour", **trigger
) -> StreamingQuery:
    """Store each typed event once, under the number of its batch.

    A repeat within ``delay`` of the newest event time is dropped; state older than that is
    too, so state follows the events of ``delay`` and not the age of the stream.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(path, batch_id))

    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    with _settings(events.sparkSession, settings):
        return (
            without_repeats(events, delay).writeStream.foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


_OFFER = "session_id string, position bigint, shown_at timestamp"


def _batch_folder(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch={batch_id}"


def start_ingest(
    lines: DataFrame, raw_path: str, reject_path: str, checkpoint: str,
    accept_selected_method: bool = False, **trigger,
) -> StreamingQuery:
    """Store accepted events as posted, by date, and refused lines with their error.

    A time may be ISO text with any offset or epoch seconds; a line whose time cannot be read
    is refused like any other, so accepted and refused lines are all lines.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            checked = ingest.validate(ingest.parse_events(batch), accept_selected_method)
            good = ingest.accepted(checked)
            events = ingest.bronze(good, online=True, keep=("value",))
            files.write_bodies(events, _batch_folder(raw_path, batch_id), "overwrite")
            refused = ingest.rejected(checked).unionByName(ingest.bad_timestamps(good, online=True))
            refused.write.mode("overwrite").json(_batch_folder(reject_path, batch_id))
        finally:
            batch.unpersist()

    return (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


#: Batches after which the offers still alive are gathered in one folder.
OFFER_BATCHES = 32


def _earlier_offers(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Last offer of each session up to the batch before, while it is alive.

    A batch writes its own offers; every ``OFFER_BATCHES`` batches those still alive are
    written together, so the folders read are that one and the few after it.  A folder that
    should be there and is not ends the query: without it offers would be made again.
    """
    if batch_id == 0:
        return None
    base = (batch_id - 1) // OFFER_BATCHES * OFFER_BATCHES
    folders = [f"{path}/alive={base}"] if base else []
    folders += [_batch_folder(path, b) for b in range(base, batch_id)]
    shown = spark.read.schema(_OFFER).parquet(*folders)
    limit = F.current_timestamp() - F.make_dt_interval(secs=F.lit(S.STATE_TTL_S))
    return _last_offers(shown.filter(F.col("shown_at") > limit))


def _last_offers(offers: DataFrame) -> DataFrame:
    return offers.groupBy("session_id").agg(F.max("position").alias("position"), F.max("shown_at").alias("shown_at"))


Scorer = Callable[[DataFrame], DataFrame]

#: Parts of a batch that are scored again to find the rows that cannot be.
SCORE_TRIES = 48


def _scores(rows: DataFrame, score: Scorer) -> bool:
    try:
        score(rows).select(*replay.SCORED).write.format("noop").mode("overwrite").save()
    except Exception:
        return False
    return True


def unscorable(rows: DataFrame, score: Scorer, tries: int = SCORE_TRIES) -> Column:
    """Which rows of a batch that cannot be scored whole are to blame.

    Parts by a hash of session and time are halved while they fail, down to single rows or
    until ``tries`` parts were scored; what fails then counts as unscorable.
    """
    place, bad, failing = F.xxhash64("session_id", "ts_us"), F.lit(False), [(1, 0)]
    while failing:
        parts, rest = failing.pop(0)
        inside = F.pmod(place, F.lit(parts)) == rest
        if tries <= 0 or len(rows.filter(inside).select("ts_us").head(2)) < 2:
            bad = bad | inside
            continue
        for half in (rest, rest + parts):
            tries -= 1
            if not _scores(rows.filter(F.pmod(place, F.lit(2 * parts)) == half), score):
                failing.append((2 * parts, half))
    return bad


def score_or_neutral(rows: DataFrame, score: Scorer, use: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``use`` of the scored rows; rows that cannot be scored have no probability.

    Only failures to score are forgiven: if the rows can be scored, what failed was ``use``,
    and its error ends the query.
    """
    neutral = lambda r: r.withColumn("probability", F.lit(None).cast("double")).select(*replay.SCORED)
    try:
        scored = score(rows).select(*replay.SCORED)
    except Exception:
        _LOG.exception("no scorer, so all answers are neutral")
        return use(neutral(rows))
    try:
        return use(scored)
    except Exception:
        if _scores(rows, score):
            raise
        _LOG.exception("some rows cannot be scored")
    bad = unscorable(rows, score)
    return use(score(rows.filter(~bad)).select(*replay.SCORED).unionByName(neutral(rows.filter(bad))))


def start_answers(
    events: DataFrame,
    score: Scorer,
    out: str,
    checkpoint: str,
    threshold: float = S.RETENTION_THRESHOLD,
    items: int = S.HISTORY_ITEMS,
    warmup: int = S.WARMUP_HEARTBEATS,
    **trigger,
) -> StreamingQuery:
    """Answer every event: history, features, score, offer, enriched record.

    ``score`` takes a frame with the model columns and adds ``probability``; a row that it
    cannot score gets the neutral answer.  Offers are also kept in a table; the next batches
    read from it how long each session stays without another offer.
    """
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if not trigger or trigger.get("availableNow"):
        # State timeouts ask for batches without data for ever; a run that should
        # end must not make them.  Expired items are skipped on reading anyway.
        settings["spark.sql.streaming.noDataMicroBatches.enabled"] = "false"
    stored = with_session_items(events, items=items)
    keep = ("event_id", "ts_us", "status", "position")

    def answer(batch: DataFrame, batch_id: int) -> None:
        # State output cannot be made again freely, so the features are stored
        # once and everything below reads the stored rows.
        features_at = _batch_folder(f"{out}/features", batch_id)
        featured = add_history_features(batch_history(batch, items, warmup)).drop("history")
        featured.write.mode("overwrite").parquet(features_at)
        session = batch.sparkSession
        ready = session.read.schema(featured.schema).parquet(features_at)
        asked = payload(ready.filter(F.col("velocity_trend").isNotNull()), keep)
        rows = model_row(asked, (*keep, "session_id", "shipping_type"))
        earlier = _earlier_offers(session, f"{out}/offers", batch_id)
        answers_at = _batch_folder(f"{out}/answers", batch_id)

        def decide(scored: DataFrame) -> DataFrame:
            made = replay.answers(scored, items=items, threshold=threshold, last_shown=earlier)
            made.write.mode("overwrite").parquet(answers_at)
            return made

        decided = score_or_neutral(rows, score, decide)
        decided = session.read.schema(decided.schema).parquet(answers_at)
        offers = decided.filter("trigger_retention").select(
            "session_id", "position", F.current_timestamp().alias("shown_at")
        )
        offers.write.mode("overwrite").parquet(_batch_folder(f"{out}/offers", batch_id))
        if batch_id and batch_id % OFFER_BATCHES == 0:
            # Before this batch; the folders from here on are read beside it.
            earlier.write.mode("overwrite").parquet(f"{out}/offers/alive={batch_id}")

        # One event of an instant is left in a session, so its time names it.
        told = decided.drop("event_id", "position").withColumnsRenamed({"session_id": "_s", "ts_us": "_t"})
        same = F.col("session_id").eqNullSafe(F.col("_s")) & (F.col("ts_us") == F.col("_t"))
        full = ready.join(told, same, "left").drop("_s", "_t").withColumns(
            {
                "abandon_probability": F.coalesce("abandon_probability", F.lit(0.0)),
                "trigger_retention": F.coalesce("trigger_retention", F.lit(False)),
                "event_timestamp": F.timestamp_micros("ts_us"),
            }
        )
        records = files.enriched_records(
            full,
            ["velocity_avg", "velocity_max", "velocity_std", "acceleration_avg",
             "acceleration_max", "idle_total_ms", "distance_total", "velocity_trend",
             "exit_intent_count", "dwell_total_ms", "dwell_segments", "click_frequency",
             "cart_delta", "product_removals", "product_additions", "shipping_switches",
             "page_regression_count", "payment_hesitation_ms", "payment_method_switches",
             "window_5s", "window_10s", "window_30s"],
            ["event_id", "session_id", "user_id", "event_type", "ts_us", "page", "cart_value"],
            F.current_timestamp(),
        )
        files.write_enriched(records, _batch_folder(f"{out}/enriched", batch_id), "overwrite")

    with _settings(events.sparkSession, settings):
        return (
            stored.writeStream.foreachBatch(answer)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
