"""Gold layer: one labelled feature row per session.

Heartbeats are a subset of all events, so the heartbeat, all-event and checkout
aggregates are conditional aggregates of one ``groupBy`` and need no join.  The
two orderings (heartbeats only, all events) share the shuffle on the session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.functions import scalar as X
from cartwake.layout import PLAIN, SessionLayout
from cartwake.operators.motion import motion_columns, silver

def _at() -> Column:
    return F.struct("ts_us", "event_id")


def heartbeat_aggregates(where: Column | None = None) -> dict[str, Column]:
    """Aggregates over heartbeat rows carrying silver columns."""

    def on(c) -> Column:
        c = F.col(c) if isinstance(c, str) else c
        return c if where is None else F.when(where, c)

    at = on(_at())
    return {
        "session_start": F.min_by("event_timestamp", at),
        "session_end": F.max_by("event_timestamp", at),
        "first_us": F.min(on("ts_us")),
        "last_us": F.max(on("ts_us")),
        "heartbeat_count": F.count(on("ts_us")),
        "velocity_avg": F.avg(on("velocity_px_s")),
        "velocity_max": F.max(on("velocity_px_s")),
        "velocity_std": F.stddev_samp(on("velocity_px_s")),
        "acceleration_avg": F.avg(on("acceleration_px_s2")),
        "acceleration_max": F.max(on("acceleration_px_s2")),
        "total_idle_ms": F.sum(on("idle_ms_segment")),
        "total_distance_px": F.sum(on("mouse_distance")),
        "exit_intent_count": F.count_if(on("is_exit_intent")),
        "total_dwell_ms": F.sum(on("dwell_ms_segment")),
        "dwell_event_count": F.count_if(on("is_dwell")),
        "last_click_count": F.max_by("mouse_click_count", at),
        "first_click_count": F.min_by("mouse_click_count", at),
        "cart_value_max": F.max(on("cart_value")),
        "cart_value_avg": F.avg(on("cart_value")),
        "cart_delta_total": F.sum(on("cart_delta")),
        "shipping_switches": F.sum(on("shipping_changed")),
    }


def heartbeat_derived() -> dict[str, Column]:
    seconds = X.whole_seconds(F.col("first_us"), F.col("last_us"))
    clicks = F.greatest(F.col("last_click_count") - F.col("first_click_count"), F.lit(0))
    return {
        "session_duration_s": seconds,
        "total_clicks": clicks,
        "click_frequency": X.ratio(clicks, seconds),
        "idle_ratio": X.ratio(F.col("total_idle_ms"), seconds * 1000),
    }


def event_aggregates() -> dict[str, Column]:
    """Aggregates over all events carrying ``ship_switch`` and ``page_regression``."""
    kind = F.col("event_type")
    return {
        "total_events": F.count(F.lit(1)),
        "device": F.min_by("device", _at()),
        "user_id": F.min_by("user_id", _at()),
        "product_count_max": F.max("product_count"),
        "add_to_cart_count": F.count_if(kind == "add_to_cart"),
        "remove_from_cart_count": F.count_if(kind == "remove_from_cart"),
        "checkout_count": F.count_if(kind == "start_checkout"),
        "view_product_count": F.count_if(kind == "view_product"),
        "has_purchase": F.bool_or(kind == "purchase"),
        "has_abandon": F.bool_or(kind == "abandon"),
        "shipping_switches_all": F.sum("ship_switch"),
        "page_regression_count": F.sum("page_regression"),
    }


def checkout_aggregates() -> dict[str, Column]:
    on = F.when(F.col("page") == "checkout", F.col("ts_us"))
    return {"checkout_first_us": F.min(on), "checkout_last_us": F.max(on)}


def _named(aggs: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in aggs.items()]


def switch_columns(df: DataFrame, w) -> DataFrame:
    page, ship = F.col("page"), F.col("shipping_option_selected")
    regress = (page == "cart") & (F.lag("page").over(w) == "checkout")
    return df.withColumns(
        {
            "ship_switch": F.coalesce(
                ship != F.lag("shipping_option_selected").over(w), F.lit(False)
            ).cast("bigint"),
            "page_regression": F.coalesce(regress, F.lit(False)).cast("bigint"),
        }
    )


def session_events(bronze: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    """All events with neighbour switches along the session."""
    return layout.settle(switch_columns(layout.look_back(bronze, 1), layout.window()))


def heartbeat_table(silver_df: DataFrame) -> DataFrame:
    """Heartbeat aggregates and derived metrics, one row per session."""
    return (
        silver_df.groupBy("session_id")
        .agg(*_named(heartbeat_aggregates()))
        .withColumns(heartbeat_derived())
    )


def event_table(bronze: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    return session_events(bronze, layout).groupBy("session_id").agg(*_named(event_aggregates()))


def checkout_table(bronze: DataFrame) -> DataFrame:
    return (
        bronze.filter(F.col("page") == "checkout")
        .groupBy("session_id")
        .agg(*_named(checkout_aggregates()))
    )


# What a session without such events has.
_ZEROS = {
    **{n: 0.0 for n in (
        "velocity_avg", "velocity_max", "velocity_std", "acceleration_avg", "acceleration_max",
        "total_idle_ms", "total_distance_px", "total_dwell_ms", "click_frequency", "idle_ratio",
        "cart_value_max", "cart_value_avg", "cart_delta_total",
    )},
    **{n: 0 for n in (
        "heartbeat_count", "total_events", "session_duration_s", "page_regression_count",
        "shipping_switches_all", "product_count_max", "add_to_cart_count",
        "remove_from_cart_count", "checkout_count", "view_product_count", "exit_intent_count",
        "dwell_event_count", "shipping_switches", "total_clicks",
    )},
    "device": S.DEFAULT_DEVICE,
    "user_id": "",
    "has_purchase": False,
    "has_abandon": False,
}


def finish(table: DataFrame) -> DataFrame:
    """Fill, label, keep sessions that ended in a purchase or an abandon."""
    filled = table.na.fill(_ZEROS)
    bought, left = F.col("has_purchase"), F.col("has_abandon")
    hesitation = X.whole_seconds(F.col("checkout_first_us"), F.col("checkout_last_us")) * 1000
    return (
        filled.filter(bought | left)
        .withColumns(
            {
                "abandoned": (left & ~bought).cast("bigint"),
                "payment_hesitation_ms": F.coalesce(hesitation, F.lit(0)).cast("bigint"),
                "events_per_minute": X.ratio(
                    F.col("total_events"), F.col("session_duration_s")
                )
                * 60,
            }
        )
        .withColumns({c: F.col(c).cast("bigint") for c in ("has_purchase", "has_abandon")})
        .drop("first_us", "last_us")
    )


def gold(
    bronze: DataFrame, layout: SessionLayout = PLAIN, whole_seconds: bool = True
) -> DataFrame:
    """One row per finished session, in one aggregation."""
    is_beat = F.col("event_type") == "heartbeat"
    rows = layout.look_back(bronze.withColumn("_beat", is_beat), 2, "_beat")
    rows = switch_columns(rows, layout.window())
    rows = layout.settle(motion_columns(rows, layout.window("_beat"), whole_seconds))
    grouped = rows.groupBy("session_id").agg(
        *_named(
            {
                **heartbeat_aggregates(F.col("_beat")),
                **event_aggregates(),
                **checkout_aggregates(),
            }
        )
    )
    return finish(grouped.withColumns(heartbeat_derived()))


def gold_by_joins(
    bronze: DataFrame, layout: SessionLayout = PLAIN, whole_seconds: bool = True
) -> DataFrame:
    """The same rows from three aggregates and two joins.

    The full join keeps one session key, so a session without heartbeats still
    finds its checkout times.
    """
    beats = heartbeat_table(silver(bronze, layout, whole_seconds))
    joined = beats.join(event_table(bronze, layout), "session_id", "full").join(
        checkout_table(bronze), "session_id", "left"
    )
    return finish(joined)
