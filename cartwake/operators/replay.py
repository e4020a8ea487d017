"""Replay of the online path over a stored event table.

Every event sees the newest 150 items of its session, itself included.  The
history frame ends at the event, which assumes events arrived in time order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.functions.history import add_history_features, change_between, item, pair_between
from cartwake.functions.scalar import MICROS
from cartwake.layout import HALO, PLAIN, SEG, SessionLayout
from cartwake.operators.ingest import last_per_key
from cartwake.operators.decision import decide, model_row, payload
from cartwake.sources.files import stored


def newest_items(df: DataFrame, items: int = S.HISTORY_ITEMS) -> DataFrame:
    """The newest ``items`` events of each session.

    A rank filter like this one keeps ``items`` rows per session and task before
    the shuffle, so a hot session sends little.
    """
    newest = Window.partitionBy("session_id").orderBy(
        F.col("ts_us").desc(), F.col("event_id").desc()
    )
    return (
        df.withColumn("recency", F.row_number().over(newest))
        .filter(F.col("recency") <= items)
    )


def upserted(df: DataFrame) -> DataFrame:
    """One event per session and instant: a later write replaces the item before it."""
    return last_per_key(df, ["session_id", "ts_us"], ["event_id"])


def explicit_offer() -> Column:
    """State set by the visitor's answer to an offer."""
    kind = F.col("event_type")
    return F.when(kind == "accept_offer", "accepted").when(kind == "reject_offer", "rejected")


def with_history(
    df: DataFrame,
    layout: SessionLayout = PLAIN,
    items: int = S.HISTORY_ITEMS,
    window_s: int | None = None,
    arrays: bool = True,
    where: Column | None = None,
    position: str | None = None,
    measured: bool = False,
) -> DataFrame:
    """Add ``history_beats``, ``offer_state`` and (with ``arrays``) ``history``.

    ``window_s`` also limits history to that many seconds before the event.  Only rows that
    satisfy ``where`` (which may use the other two) get an array, the rest null.
    Counts are differences of running counts, so an event costs the same at any ``items``.
    The arrays are made and used inside one stage; they are never shuffled.
    ``measured`` adds ``_pairs`` and ``_changes`` beside history: what lies between a
    heartbeat and the one before it is found once, not in every history that holds it.
    """
    rows = layout.blocks(df, items - 1, position)
    w = layout.window()
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    beat = F.col("event_type") == "heartbeat"
    state = explicit_offer()
    if "offer_state" in df.columns:
        state = F.coalesce(state, F.col("offer_state"))
    rows = rows.withColumns({"_n": F.row_number().over(w), "_beats": F.count_if(beat).over(so_far)})
    answer = F.when(state.isNotNull(), F.struct(F.col("_n").alias("n"), state.alias("state")))
    rows = rows.withColumns(
        {
            "_gone": F.lag("_beats", items, 0).over(w),
            "_answer": F.last(answer, ignorenulls=True).over(so_far),
        }
    )
    if window_s is not None:
        back = -window_s * MICROS - 1
        older = Window.partitionBy(*layout.by()).orderBy("ts_us").rangeBetween(Window.unboundedPreceding, back)
        rows = rows.withColumn("_older", F.max("_beats").over(older))
        rows = rows.withColumn("_gone", F.greatest("_gone", "_older"))
        # An event without a time is in no window.
        rows = rows.withColumn("_gone", F.when(F.col("ts_us").isNull(), F.col("_beats")).otherwise(F.col("_gone")))
    recent = F.col("_answer")["n"] > F.col("_n") - items
    rows = rows.withColumns(
        {
            "history_beats": F.col("_beats") - F.col("_gone"),
            "offer_state": F.when(recent, F.col("_answer")["state"]),
        }
    ).drop("_beats", "_gone", "_answer")
    if not arrays:
        return layout.settle(rows).drop(SEG, "_n")
    where = F.lit(True) if where is None else where
    return _with_arrays(rows, layout, items, window_s, where, measured)


def _with_arrays(
    rows: DataFrame, layout: SessionLayout, items: int, window_s: int | None, where: Column, measured: bool
) -> DataFrame:
    """Add ``history`` where asked for; ``_n`` counts the rows of each window.

    Runs of ``items`` rows are gathered once, each with the heartbeats of the run before it,
    where a sliding frame would gather ``items`` rows for every event.  The exchange of the
    windows serves this grouping, too.
    """
    out = [c for c in rows.columns if c not in (SEG, HALO, "_n")]
    run = F.call_function("div", F.col("_n"), F.lit(items))
    beat = F.col("event_type") == "heartbeat"
    own = ~F.col(HALO) if HALO in rows.columns else F.lit(True)
    key = [F.col(c).alias(f"_k_{c}") for c in layout.by()]
    kept = [F.col("_n").alias("n"), item().alias("item")]
    if measured:
        before = layout.window().rowsBetween(Window.unboundedPreceding, -1)
        last = lambda c: F.last(F.when(beat, c), ignorenulls=True).over(before)
        rows = rows.withColumn("_at", F.when(beat, item()))
        rows = rows.withColumn("_older", last(F.col("_at")))
        older, here = F.col("_older"), F.col("_at")
        rows = rows.withColumn("_pair", F.when(older.isNotNull(), pair_between(older, here)))
        rows = rows.withColumn("_older", last(F.col("_pair")))
        older, here = F.col("_older"), F.col("_pair")
        rows = rows.withColumn("_change", F.when(older.isNotNull(), change_between(older, here)))
        kept = [F.col("_n").alias("n"), F.col("_at").alias("item"), here.alias("pair"), F.col("_change").alias("change")]
    noted = rows.select(
        *key,
        F.explode(F.when(beat, F.array(run, run + 1)).otherwise(F.array(run))).alias("_run"),
        run.alias("_own"),
        F.when(own, F.struct("_n", where.alias("_wanted"), *out)).alias("_row"),
        F.when(beat, F.struct(*kept)).alias("_item"),
    )
    gathered = noted.groupBy(*[f"_k_{c}" for c in layout.by()], "_run").agg(
        F.collect_list(F.when(F.col("_run") == F.col("_own"), F.col("_row"))).alias("_rows"),
        F.array_sort(F.collect_list("_item"), lambda a, b: a["n"] - b["n"]).alias("_items"),
    )
    each = gathered.select("_items", F.explode("_rows").alias("_row")).select("_items", "_row.*")
    seen = lambda e: (e["n"] <= F.col("_n")) & (e["n"] > F.col("_n") - items)
    if window_s is not None:
        edge = F.col("ts_us") - window_s * MICROS
        near = lambda e: seen(e) & (e["item"]["us"] >= edge)
    else:
        near = seen
    each = each.withColumn("_found", F.when(F.col("_wanted"), F.filter("_items", near)))
    found = F.col("_found")
    added = {"history": found["item"]}
    if measured:
        added |= {"_pairs": found["pair"], "_changes": found["change"]}
    return each.withColumns(added).select(*out, *added)


def gate(warmup: int = S.WARMUP_HEARTBEATS) -> Column:
    """What happens to an event: ``offer``, ``warmup``, ``suppressed`` or ``scored``."""
    return (
        F.when(F.col("event_type").isin("accept_offer", "reject_offer"), "offer")
        .when(F.col("history_beats") < warmup, "warmup")
        .when(F.col("offer_state").isNotNull(), "suppressed")
        .otherwise("scored")
    )


def enrich(
    df: DataFrame,
    layout: SessionLayout = PLAIN,
    warmup: int = S.WARMUP_HEARTBEATS,
    newest_first_funnel: bool = True,
    window_s: int | None = None,
    items: int = S.HISTORY_ITEMS,
    position: str | None = None,
) -> DataFrame:
    """Online features of every event that reaches scoring, null for the rest."""
    scored = gate(warmup) == "scored"
    rows = with_history(df, layout, items, window_s, where=scored, position=position, measured=True)
    rows = rows.withColumn("status", gate(warmup))
    return add_history_features(rows, newest_first_funnel=newest_first_funnel, measured=True).withColumn(
        "heartbeat_count", F.when(F.col("history").isNotNull(), F.col("history_beats"))
    )


# -- offers -----------------------------------------------------------------
_NEVER = -(1 << 62)


def offers_shown(
    candidates: DataFrame,
    layout: SessionLayout = PLAIN,
    items: int = S.HISTORY_ITEMS,
    last_shown: DataFrame | None = None,
) -> DataFrame:
    """Which candidate events show an offer: ``session_id, event_id, ts_us``.

    ``candidates`` has ``session_id, event_id, ts_us, position`` (1, 2, .. in the
    session) for events whose score asks for an offer.  A shown offer blocks the
    session while its item is among the newest ``items``, so each choice depends
    on the one before.  Inside one segment the choice is a walk over sorted
    positions.  A segment can be entered in ``items`` ways at most, so hot
    sessions first tabulate the exit for each way, chain those small tables, and
    then walk every segment with its own entry; no task sees a whole hot session.
    """
    rows = candidates.select("session_id", "event_id", "ts_us", "position", F.lit(0).alias(SEG))
    schema = "session_id string, event_id bigint, ts_us bigint"
    if layout.hot:
        rows = layout.split(candidates).select("session_id", "event_id", "ts_us", "position", SEG)
    never = F.lit(_NEVER).cast("bigint")
    rows = rows.withColumn("_entry", never)
    if last_shown is not None:
        before = last_shown.select("session_id", (F.col("position") + items).alias("_free"))
        rows = rows.join(before, "session_id", "left").withColumn("_entry", F.coalesce("_free", never))
        rows = rows.drop("_free")
    if layout.hot:
        rows = _with_entries(rows, items)

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("position", ignore_index=True)
        pos = pdf["position"].to_numpy(dtype=np.int64)
        chosen = []
        i = int(np.searchsorted(pos, int(pdf["_entry"].iloc[0])))
        while i < len(pos):
            chosen.append(i)
            i = int(np.searchsorted(pos, int(pos[i]) + items))
        return pdf.loc[chosen, ["session_id", "event_id", "ts_us"]]

    return _spread(rows).groupBy("session_id", SEG).applyInPandas(walk, schema)


def _spread(rows: DataFrame) -> DataFrame:
    """Segments over all shuffle partitions: a walk is long for its few bytes, by which
    Spark would put them into one task."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return rows.repartition(parts, "session_id", SEG)


def _with_entries(rows: DataFrame, items: int) -> DataFrame:
    """Put into ``_entry`` the first free position when each hot segment begins.

    Before, it holds the first free position of the session.
    """
    span, seg, never = items, SEG, _NEVER

    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        pos = np.sort(pdf["position"].to_numpy(dtype=np.int64))
        low = int(pos[0])
        # exits[k]: first free position after the segment when entered with
        # everything before `low + k` blocked.
        after = np.empty(len(pos) + 1, dtype=np.int64)
        after[-1] = never
        jump = np.searchsorted(pos, pos + span)
        for i in range(len(pos) - 1, -1, -1):
            nxt = int(jump[i])
            after[i] = after[nxt] if nxt < len(pos) else int(pos[i]) + span
        starts = np.searchsorted(pos, low + np.arange(span))
        exits = [int(v) for v in after[starts]]
        return pd.DataFrame(
            {
                "session_id": [pdf["session_id"].iloc[0]],
                seg: [int(pdf[seg].iloc[0])],
                "low": [low],
                "exits": [exits],
                "enter": [int(pdf["_entry"].iloc[0])],
            }
        )

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(seg, ignore_index=True)
        free, entries = int(pdf["enter"].iloc[0]), []
        for low, exits in zip(pdf["low"], pdf["exits"]):
            entries.append(free)
            k = min(max(free - int(low), 0), span - 1) if free > never else 0
            out = int(exits[k]) if free - int(low) < span else never
            free = free if out == never else out
        return pd.DataFrame(
            {"_ek": pdf["session_id"], "_es": pdf[seg], "_from": entries}
        )

    hot = _spread(rows.filter(F.col(SEG) > 0))
    tables = hot.groupBy("session_id", SEG).applyInPandas(
        table, f"session_id string, {SEG} int, low bigint, exits array<bigint>, enter bigint"
    )
    entries = tables.groupBy("session_id").applyInPandas(
        chain, "_ek string, _es int, _from bigint"
    )
    on = F.col("session_id").eqNullSafe(F.col("_ek")) & (F.col(SEG) == F.col("_es"))
    return (
        rows.join(entries, on, "left")
        .withColumn("_entry", F.coalesce("_from", F.col("_entry")))
        .drop("_ek", "_es", "_from")
    )


SCORED = ("session_id", "event_id", "ts_us", "position", "shipping_type", "probability")


def decisions(
    df: DataFrame,
    score,
    layout: SessionLayout = PLAIN,
    items: int = S.HISTORY_ITEMS,
    warmup: int = S.WARMUP_HEARTBEATS,
    threshold: float = S.RETENTION_THRESHOLD,
) -> DataFrame:
    """Answer to every event, with offers suppressing later offers.

    ``score`` takes a frame with the model columns and adds ``probability``.  The
    scores are written once to the shared folder: three steps read them, and the
    features behind them should not be made three times.
    """
    keep = ("event_id", "ts_us", "status", "position")
    rows = with_positions(upserted(df), layout)
    rows = enrich(rows, layout, warmup=warmup, items=items, position="position")
    asked = payload(rows.filter(F.col("velocity_trend").isNotNull()), keep)
    scored = score(model_row(asked, (*keep, "session_id", "shipping_type")))
    return answers(stored(scored.select(*SCORED), "scores"), layout, items, threshold)


def answers(
    scored: DataFrame,
    layout: SessionLayout = PLAIN,
    items: int = S.HISTORY_ITEMS,
    threshold: float = S.RETENTION_THRESHOLD,
    last_shown: DataFrame | None = None,
) -> DataFrame:
    """Decisions for scored events, one offer per ``items`` items of a session."""
    wanted = scored.filter(F.col("probability") >= threshold).select(
        "session_id", "event_id", "ts_us", "position"
    )
    shown = offers_shown(wanted, layout, items, last_shown).select(
        F.col("session_id").alias("_ss"), F.col("ts_us").alias("_sp"),
        F.lit(True).alias("_shown"),
    )
    decided = decide(
        scored.select(*SCORED),
        threshold=threshold,
    )
    kept = decided.join(
        shown,
        F.col("session_id").eqNullSafe(F.col("_ss")) & (F.col("ts_us") == F.col("_sp")),
        "left",
    )
    blocked = F.col("trigger_retention") & F.col("_shown").isNull()
    return kept.select(
        "session_id",
        "event_id",
        "ts_us",
        "position",
        F.when(blocked, 0.0).otherwise(F.col("abandon_probability")).alias("abandon_probability"),
        (F.col("trigger_retention") & ~blocked).alias("trigger_retention"),
        F.when(~blocked, F.col("retention_type")).alias("retention_type"),
    )


def with_positions(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    return layout.running_sum(df, position=F.lit(1).cast("bigint")).drop(SEG)
