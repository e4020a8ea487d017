"""Bronze, silver and gold queries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartwake.operators import ingest, motion, sessions
from cartwake.queries.base import (
    BEATS, CLICK, EVENTS, GOLD, SILVER, Tables, query, round_sql, rounded,
)
from cartwake.sources.click_view import raw_json

GOLD_DOUBLES = [
    "velocity_avg", "velocity_max", "velocity_std", "acceleration_avg", "acceleration_max",
    "total_idle_ms", "total_distance_px", "total_dwell_ms", "click_frequency", "idle_ratio",
    "cart_value_max", "cart_value_avg", "cart_delta_total", "events_per_minute",
]
GOLD_WHOLE = [
    "heartbeat_count", "exit_intent_count", "dwell_event_count", "session_duration_s",
    "shipping_switches", "page_regression_count", "shipping_switches_all", "total_events",
    "product_count_max", "add_to_cart_count", "remove_from_cart_count", "checkout_count",
    "view_product_count", "payment_hesitation_ms", "total_clicks", "has_purchase",
    "has_abandon", "abandoned",
]
GOLD_OUT = ["session_id", "user_id", "device", *GOLD_WHOLE, *GOLD_DOUBLES]
GOLD_SELECT = (
    "select session_id, user_id, device, " + ", ".join(GOLD_WHOLE) + ", " + round_sql(GOLD_DOUBLES)
)


def _gold_out(df: DataFrame) -> DataFrame:
    return rounded(df.select(*GOLD_OUT))


@query("click_view", f"with {CLICK} select * from click")
def _click_view(t: Tables) -> DataFrame:
    return t.clicks


@query(
    "bronze_types",
    f"""with {CLICK}
    select event_id, event_type, session_id, user_id, event_timestamp,
      case when event_type = 'heartbeat' then mouse_x else 0.0 end as mouse_x,
      case when event_type = 'heartbeat' then mouse_y else 0.0 end as mouse_y,
      cart_value, product_count, mouse_click_count, device, page, shipping_option_selected,
      '{{"' || product_id || '":' || qty || '}}' as product_quantities,
      strftime(event_timestamp, '%Y') as year, strftime(event_timestamp, '%m') as month,
      strftime(event_timestamp, '%d') as day
    from click""",
)
def _bronze_types(t: Tables) -> DataFrame:
    return ingest.bronze(ingest.parse_events(raw_json(t.clicks))).select(
        "event_id", "event_type", "session_id", "user_id", "event_timestamp", "mouse_x",
        "mouse_y", "cart_value", "product_count", "mouse_click_count", "device", "page",
        "shipping_option_selected", "product_quantities", "year", "month", "day",
    )


@query(
    "silver_motion",
    f"""with {SILVER}
    select event_id, session_id, {round_sql(["dx", "dy", "delta_time_s", "mouse_distance", "velocity_px_s", "acceleration_px_s2", "cart_delta"])},
      shipping_changed from silver""",
)
def _silver_motion(t: Tables) -> DataFrame:
    return rounded(
        motion.silver(t.clicks, t.layout).select(
            "event_id", "session_id", "dx", "dy", "delta_time_s", "mouse_distance",
            "velocity_px_s", "acceleration_px_s2", "cart_delta", "shipping_changed",
        )
    )


@query(
    "silver_flags",
    f"""with {SILVER}
    select event_id, is_idle, is_exit_intent, is_dwell, idle_ms_segment, dwell_ms_segment from silver""",
)
def _silver_flags(t: Tables) -> DataFrame:
    return motion.silver(t.clicks, t.layout).select(
        "event_id", "is_idle", "is_exit_intent", "is_dwell", "idle_ms_segment", "dwell_ms_segment"
    )


@query(
    "silver_exact_seconds",
    f"""with {SILVER.replace("case when (ts_us - pt) // 1000000 > 0 then ((ts_us - pt) // 1000000)::double else 0.25::double end",
                             "case when ts_us > pt then (ts_us - pt) / 1000000.0 else 0.25::double end")}
    select event_id, {round_sql(["delta_time_s", "velocity_px_s", "acceleration_px_s2", "idle_ms_segment", "dwell_ms_segment"], 6)} from silver""",
)
def _silver_exact(t: Tables) -> DataFrame:
    return rounded(
        motion.silver(t.clicks, t.layout, whole_seconds=False).select(
            "event_id", "delta_time_s", "velocity_px_s", "acceleration_px_s2",
            "idle_ms_segment", "dwell_ms_segment",
        ),
        6,
    )


_BEAT_WHOLE = [
    "session_id", "first_us", "last_us", "heartbeat_count", "exit_intent_count",
    "dwell_event_count", "last_click_count", "first_click_count", "shipping_switches",
    "session_duration_s", "total_clicks",
]
_BEAT_DOUBLES = [c for c in GOLD_DOUBLES if c != "events_per_minute"]


@query(
    "gold_heartbeat_agg",
    f"""with {SILVER}, {BEATS}
    select {", ".join(_BEAT_WHOLE)}, {round_sql(_BEAT_DOUBLES)} from beats3""",
)
def _gold_heartbeat_agg(t: Tables) -> DataFrame:
    return rounded(
        sessions.heartbeat_table(motion.silver(t.clicks, t.layout)).select(
            *_BEAT_WHOLE, *_BEAT_DOUBLES
        )
    )


@query("gold_event_agg", f"with {CLICK}, {EVENTS} select * from evs")
def _gold_event_agg(t: Tables) -> DataFrame:
    return sessions.event_table(t.clicks, t.layout)


@query("gold_checkout", f"with {CLICK}, {EVENTS} select * from pay")
def _gold_checkout(t: Tables) -> DataFrame:
    return sessions.checkout_table(t.clicks)


@query("gold_sessions", f"with {GOLD} {GOLD_SELECT} from gold")
def _gold_sessions(t: Tables) -> DataFrame:
    return _gold_out(sessions.gold(t.clicks, t.layout))


@query("gold_joins", f"with {GOLD} {GOLD_SELECT} from gold")
def _gold_joins(t: Tables) -> DataFrame:
    return _gold_out(sessions.gold_by_joins(t.clicks, t.layout))


@query(
    "gold_labels",
    f"with {GOLD} select session_id, has_purchase, has_abandon, abandoned from gold",
)
def _gold_labels(t: Tables) -> DataFrame:
    return sessions.gold(t.clicks, t.layout).select(
        "session_id", "has_purchase", "has_abandon", "abandoned"
    )
