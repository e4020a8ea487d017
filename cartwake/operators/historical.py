"""Historical session rows: a third feature set, used for the session table.

Gaps above ten seconds count as one heartbeat interval, only finished still
runs count as dwell, distance, duration and clicks run over all events, and
the trend is a fitted slope when there are enough pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.functions import maps as M
from cartwake.functions import scalar as X
from cartwake.layout import PLAIN, SessionLayout
from cartwake.operators import online as O

_LABELS = ("purchase", "abandon")


def _rows(df: DataFrame, layout: SessionLayout, funnel: bool = False) -> DataFrame:
    """Every event with its heartbeat pair and its distance to the event before.

    With ``funnel`` also its page and payment changes, from the same shuffle.
    """
    rows = layout.together(df).withColumn("_beat", F.col("event_type") == "heartbeat")
    if funnel:
        rows = O.funnel_flags(rows, ignore_nulls=True)
        rows = layout.look_back(rows, 2, "_beat", "_paged", "_pay")
        rows = O.funnel_marks(rows, layout)
    else:
        rows = layout.look_back(rows, 2, "_beat")
    w = layout.window("_beat")
    every = layout.window()
    rows = O.pair_columns(rows, w, S.MAX_GAP_S)
    zero = F.lit(0.0)
    x, y = F.coalesce("mouse_x", zero), F.coalesce("mouse_y", zero)
    rows = rows.withColumns(
        {
            "step": X.distance(F.lag(x).over(every), F.lag(y).over(every), x, y),
            "p_value": F.lag("cart_value").over(w),
        }
    )
    rows = layout.settle(rows)
    measured = ["p_us", "v", "acc", "vote", "is_static", "was_static", "dt_ms", "ship_changed"]
    rows = rows.withColumns({c: F.when(F.col("_beat"), F.col(c)) for c in measured})
    rows = layout.running_last(rows, run=O._run_start("p_us"))
    return layout.running_sum(rows, pair_no=F.col("v").isNotNull().cast("bigint"))


def _session_aggregates() -> dict[str, Column]:
    zero = F.lit(0.0)
    duration = X.exact_seconds(F.min("ts_us"), F.max("ts_us"))
    pairs = F.count("v")
    slope = F.regr_slope(F.col("v"), F.col("pair_no").cast("double"))
    ended = F.col("was_static") & ~F.col("is_static")
    r2 = lambda c: F.round(F.coalesce(c, zero), 2)
    exit_y = F.coalesce("mouse_y", F.lit(500.0))
    return {
        "velocity_avg": r2(F.avg("v")),
        "velocity_max": r2(F.max("v")),
        "velocity_std": r2(F.stddev_samp("v")),
        "acceleration_avg": r2(F.avg("acc")),
        "acceleration_max": r2(F.max("acc")),
        "idle_total_ms": F.coalesce(
            F.sum(F.when(F.col("v") < S.IDLE_VELOCITY, F.col("dt_ms"))), F.lit(0)
        ),
        "distance_total": r2(F.sum("step")),
        "velocity_trend": F.when(pairs >= S.SLOPE_MIN_PAIRS, X.slope_name(slope)).otherwise(
            X.trend_name(F.coalesce(F.sum("vote"), F.lit(0)))
        ),
        "exit_intent_count": F.count_if(X.exit_intent(exit_y, F.col("v"))),
        "dwell_total_ms": F.coalesce(F.sum(O.closed_run_ms()), F.lit(0)),
        "dwell_segments": F.count_if(ended),
        "click_frequency": F.round(
            F.coalesce(F.sum("mouse_click_count"), F.lit(0)) / F.greatest(duration, F.lit(1.0)), 4
        ),
        "heartbeat_count": F.count_if("_beat"),
        "session_duration_s": F.round(duration, 2),
    }


FEATURES = [
    "velocity_avg", "velocity_max", "velocity_std", "acceleration_avg", "acceleration_max",
    "idle_total_ms", "distance_total", "velocity_trend", "exit_intent_count", "dwell_total_ms",
    "dwell_segments", "click_frequency", "session_duration_s",
]


def _named(aggs: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in aggs.items()]


def session_features(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    return (
        _rows(df, layout)
        .groupBy("session_id")
        .agg(*_named(_session_aggregates()))
        .filter(F.col("heartbeat_count") >= 2)
    )


def product_tallies(df: DataFrame) -> DataFrame:
    """Products added and removed per session, as JSON maps with sorted keys.

    Counts are per (session, product) first, so the map holds one entry for each
    distinct product.  Sessions with fewer than two heartbeats get empty maps.
    """
    kind = F.col("event_type")
    per_product = df.groupBy(
        "session_id", F.coalesce("product_id", F.lit("unknown")).alias("pid")
    ).agg(
        F.count_if(kind == "add_to_cart").alias("adds"),
        F.count_if(kind == "remove_from_cart").alias("removes"),
        F.count_if(kind == "heartbeat").alias("beats"),
    )

    def tally(count: str) -> Column:
        entries = F.collect_list(F.when(F.col(count) > 0, F.struct("pid", count)))
        return F.when(
            F.sum("beats") >= 2, M.sorted_json(F.map_from_entries(entries))
        ).otherwise(F.lit("{}"))

    return per_product.groupBy("session_id").agg(
        tally("removes").alias("product_removals"), tally("adds").alias("product_additions")
    )


def _with_tallies(rows: DataFrame, layout: SessionLayout) -> DataFrame:
    """Mark one row per product and session (or piece of one) with what was added and removed.

    The window over (session, product) needs no exchange after one over the session.
    """
    kind = F.col("event_type")
    rows = rows.withColumn("_pid", F.coalesce("product_id", F.lit("unknown")))
    same = Window.partitionBy(*layout.by("_pid"))
    tally = F.struct(
        F.col("_pid").alias("pid"),
        F.count_if(kind == "add_to_cart").over(same).alias("adds"),
        F.count_if(kind == "remove_from_cart").over(same).alias("removes"),
    )
    first = F.row_number().over(same.orderBy(*layout.order)) == 1
    return rows.withColumns({"_tally": tally, "_first": first}).withColumn(
        "_tally", F.when(F.col("_first") & (F.col("_tally")["adds"] + F.col("_tally")["removes"] > 0), F.col("_tally"))
    )


def _tally_aggregates() -> dict[str, Column]:
    return {"_tallies": F.collect_list("_tally"), "_beats": F.count_if("_beat")}


def _tally_maps(sessions: DataFrame, layout: SessionLayout) -> DataFrame:
    """Product maps from the collected tallies; pieces of one session are added up."""

    def total(count: str) -> Column:
        found = F.filter("_tallies", lambda e: e[count] > 0)
        entry = lambda e: F.struct(e["pid"], e[count])
        if layout.hot:
            pids = F.array_distinct(F.transform(found, lambda e: e["pid"]))
            part = lambda p: F.filter(found, lambda e: e["pid"] == p)
            summed = lambda p: F.aggregate(part(p), F.lit(0).cast("bigint"), lambda n, e: n + e[count])
            entries = F.transform(pids, lambda p: F.struct(p, summed(p)))
        else:
            entries = F.transform(found, entry)
        return F.when(
            F.col("_beats") >= 2, M.sorted_json(F.map_from_entries(entries))
        ).otherwise(F.lit("{}"))

    maps = {"product_removals": total("removes"), "product_additions": total("adds")}
    return sessions.withColumns(maps).drop("_tallies", "_beats")


def _cart_aggregates() -> dict[str, Column]:
    last = F.max_by(F.struct("cart_value", "p_value", "p_us"), O._beat_at())
    zero = F.lit(0.0)
    return {
        "cart_delta": F.round(
            F.when(
                last["p_us"].isNotNull(),
                F.coalesce(last["cart_value"], zero) - F.coalesce(last["p_value"], zero),
            ).otherwise(zero),
            2,
        ),
        "shipping_switches": F.count_if("ship_changed"),
    }


def cart_features(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    found = (
        _with_tallies(_rows(df, layout), layout)
        .groupBy("session_id")
        .agg(*_named(_cart_aggregates()), *_named(_tally_aggregates()))
    )
    return _tally_maps(found, layout)


def funnel_features(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    """Funnel measures in which a missing payment method is not a value."""
    return O.funnel_features(df, layout, ignore_nulls=True)


def _first_terminal() -> Column:
    kind = F.col("event_type")
    return F.min_by(kind, F.when(kind.isin(*_LABELS), O.at()))


def terminal_labels(df: DataFrame) -> DataFrame:
    """Type of the first purchase or abandon of each session, null without one."""
    return df.groupBy("session_id").agg(_first_terminal().alias("terminal"))


def session_rows(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    """Identity, label and features of each session, from one scan and one aggregate.

    Motion features are null for sessions with fewer than two heartbeats.
    """
    latest = lambda c: F.coalesce(
        F.max_by(c, F.when(F.col(c).isNotNull(), O.at())), F.lit("")
    )
    base = (
        _with_tallies(_rows(df, layout, funnel=True), layout)
        .groupBy("session_id")
        .agg(
            F.min_by("user_id", O.at()).alias("user_id"),
            F.min_by("device", O.at()).alias("device"),
            F.count(F.lit(1)).alias("event_count"),
            F.coalesce((_first_terminal() == "abandon").cast("bigint"), F.lit(0)).alias("abandoned"),
            latest("abandon_reason").alias("abandon_reason"),
            latest("payment_method").alias("payment_method"),
            F.coalesce(F.bool_or(F.col("page") == "checkout"), F.lit(False))
            .cast("bigint").alias("has_checkout"),
            *_named(_session_aggregates()),
            *_named(_cart_aggregates()),
            *_named(O.funnel_aggregates()),
            *_named(_tally_aggregates()),
        )
    )
    enough = F.col("heartbeat_count") >= 2
    base = base.withColumns({c: F.when(enough, F.col(c)) for c in FEATURES}).drop(
        "heartbeat_count"
    )
    return _tally_maps(base, layout)
