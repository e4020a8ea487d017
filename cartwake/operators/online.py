"""Online feature set: exact gaps, no gap cap, trailing windows, funnel.

These definitions differ from the gold layer on purpose (acceleration is per
second, dwell is measured inside runs, the first heartbeat has no pair).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwake import schema as S
from cartwake.functions import maps as M
from cartwake.functions import scalar as X
from cartwake.layout import PLAIN, SessionLayout

MICROS = X.MICROS


def at() -> Column:
    """Position of a row in its session."""
    return F.struct("ts_us", "event_id")


def beats_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("event_type") == "heartbeat")


def pair_columns(df: DataFrame, w, longest: float | None = None) -> DataFrame:
    """Measures of each heartbeat against the one before it in ``w``.

    All are null on the first heartbeat, which has no pair.
    """
    zero = F.lit(0.0)
    x, y = F.coalesce("mouse_x", zero), F.coalesce("mouse_y", zero)
    with_prev = df.withColumns(
        {
            "p_us": F.lag("ts_us").over(w),
            "_px": F.lag(x).over(w),
            "_py": F.lag(y).over(w),
            "_ship": F.lag("shipping_option_selected").over(w),
        }
    )
    raw = X.exact_seconds(F.col("p_us"), F.col("ts_us"))
    usable = raw > 0 if longest is None else (raw > 0) & (raw <= longest)
    paired = F.col("p_us").isNotNull()
    with_gap = with_prev.withColumns(
        {
            "dt_s": F.when(paired, F.when(usable, raw).otherwise(S.HEARTBEAT_S)),
            "dt_ms": F.when(
                paired,
                F.when(usable, X.truncated_ms(raw)).otherwise(F.lit(int(S.HEARTBEAT_S * 1000))),
            ),
            "dist": X.distance(F.col("_px"), F.col("_py"), x, y),
            "is_static": (x == F.col("_px")) & (y == F.col("_py")),
            "ship_changed": paired
            & X.changed(F.col("shipping_option_selected"), F.col("_ship")),
        }
    ).withColumn("v", F.col("dist") / F.col("dt_s"))
    prev_v = F.lag("v").over(w)
    return with_gap.withColumns(
        {
            "acc": (F.col("v") - prev_v) / F.col("dt_s"),
            "vote": X.trend_vote(F.col("v"), prev_v),
            "was_static": F.coalesce(F.lag("is_static").over(w), F.lit(False)),
        }
    ).drop("_px", "_py", "_ship")


def _run_start(start_us: str) -> Column:
    fresh = F.col("is_static") & ~F.col("was_static")
    return F.when(fresh, F.struct(F.col(start_us).alias("us"), F.col("event_id").alias("id")))


def pairs(
    df: DataFrame,
    layout: SessionLayout = PLAIN,
    longest: float | None = None,
    run_from: str = "ts_us",
) -> DataFrame:
    """Heartbeat pairs with the start of the current still run (``run``).

    ``run_from`` is ``ts_us`` to start a run at its second still heartbeat, or
    ``p_us`` to start it at the first.
    """
    rows = layout.look_back(beats_only(df), 2)
    rows = layout.settle(pair_columns(rows, layout.window(), longest))
    return layout.running_last(rows, run=_run_start(run_from))


def closed_run_ms() -> Column:
    """Length of the still run that ended just before this row."""
    ends = F.col("was_static") & ~F.col("is_static")
    return F.when(ends, X.truncated_ms(X.exact_seconds(F.col("run.us"), F.col("p_us"))))


def open_run_ms() -> Column:
    """Length so far of the still run this row is part of."""
    return F.when(
        F.col("is_static"), X.truncated_ms(X.exact_seconds(F.col("run.us"), F.col("ts_us")))
    ).otherwise(F.lit(0))


def dwell_segments(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    """Runs without movement: start, end and number of still pairs."""
    return (
        pairs(df, layout)
        .filter("is_static")
        .groupBy("session_id", "run")
        .agg(F.max("ts_us").alias("end_us"), F.count(F.lit(1)).alias("still_count"))
        .select("session_id", F.col("run.us").alias("start_us"), "end_us", "still_count")
    )


def motion_aggregates() -> dict[str, Column]:
    zero = F.lit(0.0)
    return {
        "velocity_avg": F.coalesce(F.avg("v"), zero),
        "velocity_max": F.coalesce(F.max("v"), zero),
        "velocity_std": F.coalesce(F.stddev_samp("v"), zero),
        "acceleration_avg": F.coalesce(F.avg("acc"), zero),
        "acceleration_max": F.coalesce(F.max("acc"), zero),
        "idle_total_ms": F.coalesce(
            F.sum(F.when(F.col("v") < S.IDLE_VELOCITY, F.col("dt_ms"))), F.lit(0)
        ),
        "distance_total": F.coalesce(F.sum("dist"), zero),
        "velocity_trend": X.trend_name(F.coalesce(F.sum("vote"), F.lit(0))),
        "exit_intent_count": F.count_if(
            X.exit_intent(F.coalesce("mouse_y", zero), F.col("v"))
        ),
        "dwell_total_ms": F.coalesce(F.sum(closed_run_ms()), F.lit(0))
        + F.coalesce(F.max_by(open_run_ms(), _beat_at()), F.lit(0)),
        "dwell_segments": F.count_if("is_static"),
        "click_frequency": X.click_frequency(
            F.max_by("mouse_click_count", _beat_at()),
            F.min_by("mouse_click_count", _beat_at()),
            X.exact_seconds(F.min(_on_beat("ts_us")), F.max(_on_beat("ts_us"))),
        ),
        "heartbeat_count": F.count_if(F.col("event_type") == "heartbeat"),
    }


def _on_beat(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.col("event_type") == "heartbeat", c)


def _beat_at() -> Column:
    return _on_beat(at())


def _named(aggs: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in aggs.items()]


def session_features(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    """Thirteen motion measures per session with two heartbeats or more."""
    return (
        pairs(df, layout)
        .groupBy("session_id")
        .agg(*_named(motion_aggregates()))
        .filter(F.col("heartbeat_count") >= 2)
    )


# -- trailing windows -------------------------------------------------------
def with_session_end(rows: DataFrame, layout: SessionLayout) -> DataFrame:
    return layout.totals(rows, last_us=F.max(_on_beat("ts_us")))


def window_struct(seconds: float) -> Column:
    """Measures of the last ``seconds`` before the newest heartbeat.

    A pair counts only when both its heartbeats are inside.  Null with fewer
    than two heartbeats inside.
    """
    edge = F.col("last_us") - int(seconds * MICROS)
    inside = (F.col("event_type") == "heartbeat") & (F.col("ts_us") >= edge)
    v = F.when(F.col("p_us") >= edge, F.col("v"))
    where = F.when(inside, at())
    n = F.count_if(inside)
    zero = F.lit(0.0)
    return F.when(
        n >= 2,
        F.struct(
            F.coalesce(F.avg(v), zero).alias("velocity_avg"),
            F.coalesce(F.max(v), zero).alias("velocity_max"),
            F.coalesce(F.stddev_samp(v), zero).alias("velocity_std"),
            F.greatest(
                F.max_by("mouse_click_count", where) - F.min_by("mouse_click_count", where),
                F.lit(0),
            ).alias("total_clicks"),
            (F.count_if((F.col("p_us") >= edge) & F.col("is_static")) / n).alias("idle_ratio"),
            n.alias("heartbeat_count"),
        ),
    )


def window_columns() -> dict[str, Column]:
    return {f"window_{s}s": window_struct(s) for s in S.WINDOWS_S}


def window_features(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    """The 5, 10 and 30 second windows of each session."""
    rows = layout.look_back(beats_only(df), 2)
    rows = layout.settle(pair_columns(rows, layout.window()))
    return (
        with_session_end(rows, layout)
        .groupBy("session_id")
        .agg(*_named(window_columns()))
    )


# -- cart -------------------------------------------------------------------
def cart_pair_columns(rows: DataFrame, w) -> DataFrame:
    return rows.withColumns(
        {
            "p_value": F.lag("cart_value").over(w),
            "p_quantities": F.lag("product_quantities").over(w),
        }
    )


def cart_aggregates() -> dict[str, Column]:
    zero = F.lit(0.0)
    last = F.max_by(
        F.struct("cart_value", "p_value", "product_quantities", "p_quantities", "p_us"), _beat_at()
    )
    paired = last["p_us"].isNotNull()
    none = F.from_json(F.lit("{}"), S.QUANTITIES)
    cur, prev = last["product_quantities"], last["p_quantities"]
    return {
        "cart_delta": F.when(
            paired, F.coalesce(last["cart_value"], zero) - F.coalesce(last["p_value"], zero)
        ).otherwise(zero),
        "product_removals": F.when(paired, M.quantity_drop(prev, cur)).otherwise(none),
        "product_additions": F.when(paired, M.quantity_rise(prev, cur)).otherwise(none),
        "shipping_switches": F.count_if("ship_changed"),
    }


def cart_features(df: DataFrame, layout: SessionLayout = PLAIN) -> DataFrame:
    """Change between the last two heartbeats, and shipping switches over all."""
    w = layout.window()
    rows = layout.look_back(beats_only(df), 1)
    rows = layout.settle(cart_pair_columns(pair_columns(rows, w), w))
    return rows.groupBy("session_id").agg(*_named(cart_aggregates()))


# -- funnel -----------------------------------------------------------------
def funnel_flags(df: DataFrame, ignore_nulls: bool = False) -> DataFrame:
    """Mark the events that funnel measures compare: those with a page, and those
    on checkout (with a payment method, when nulls are to be ignored)."""
    has_page = F.coalesce(F.col("page") != "", F.lit(False))
    on_checkout = F.coalesce(F.col("page") == "checkout", F.lit(False))
    if ignore_nulls:
        on_checkout = on_checkout & F.coalesce(
            F.col("payment_method_selected") != "", F.lit(False)
        )
    return df.withColumns({"_paged": has_page, "_pay": on_checkout})


def funnel_marks(rows: DataFrame, layout: SessionLayout) -> DataFrame:
    """Mark page regressions and payment switches on flagged rows."""
    page_w, pay_w = layout.window("_paged"), layout.window("_pay")
    method = F.col("payment_method_selected")
    return rows.withColumns(
        {
            "regressed": F.coalesce(
                F.col("_paged")
                & (F.col("page") == "cart")
                & (F.lag("page").over(page_w) == "checkout"),
                F.lit(False),
            ),
            "method_changed": F.col("_pay")
            & F.lag("ts_us").over(pay_w).isNotNull()
            & X.changed(method, F.lag(method).over(pay_w)),
        }
    )


def funnel_rows(
    df: DataFrame, layout: SessionLayout = PLAIN, ignore_nulls: bool = False
) -> DataFrame:
    """Page regressions and payment switches along the session.

    Regressions compare events that have a page; switches compare checkout
    events, where a missing method counts as a value unless ``ignore_nulls``.
    """
    rows = layout.look_back(funnel_flags(df, ignore_nulls), 1, "_paged", "_pay")
    return layout.settle(funnel_marks(rows, layout)).drop("_paged", "_pay")


def funnel_aggregates() -> dict[str, Column]:
    checkout = F.when(F.col("page") == "checkout", F.col("ts_us"))
    seconds = X.exact_seconds(F.min(checkout), F.max(checkout))
    return {
        "page_regression_count": F.count_if("regressed"),
        "payment_hesitation_ms": F.coalesce(X.truncated_ms(seconds), F.lit(0)),
        "payment_method_switches": F.count_if("method_changed"),
    }


def funnel_features(
    df: DataFrame, layout: SessionLayout = PLAIN, ignore_nulls: bool = False
) -> DataFrame:
    return (
        funnel_rows(layout.together(df), layout, ignore_nulls)
        .groupBy("session_id")
        .agg(*_named(funnel_aggregates()))
    )


def value_changes(
    df: DataFrame, column: str, layout: SessionLayout = PLAIN
) -> DataFrame:
    """Number of adjacent rows of a session that differ in ``column``."""
    w = layout.window()
    rows = layout.look_back(df, 1).withColumn(
        "_changed",
        F.lag("ts_us").over(w).isNotNull() & X.changed(F.col(column), F.lag(column).over(w)),
    )
    return layout.settle(rows).groupBy("session_id").agg(
        F.count_if("_changed").alias("change_count")
    )


# -- everything -------------------------------------------------------------
def all_features(
    df: DataFrame, layout: SessionLayout = PLAIN, with_current: bool = True
) -> DataFrame:
    """Motion, cart, funnel and window features of each session in one shuffle.

    The funnel part sees the heartbeats, whose payment method is not kept in
    history, and after them the session's newest event of any type when
    ``with_current``.  Sessions with fewer than two heartbeats give no row.
    """
    rows = layout.together(df).withColumn("_beat", F.col("event_type") == "heartbeat")
    rows = layout.look_back(rows, 2, "_beat")
    w = layout.window("_beat")
    rows = cart_pair_columns(pair_columns(rows, w), w)
    rows = rows.withColumn("_p_page", F.lag("page").over(w))
    rows = layout.settle(rows)
    # Only heartbeats take part in the motion measures.
    measured = ["p_us", "v", "acc", "vote", "is_static", "was_static", "dist", "dt_s", "dt_ms",
                "ship_changed"]
    rows = rows.withColumns({c: F.when(F.col("_beat"), F.col(c)) for c in measured})
    rows = layout.running_last(rows, run=_run_start("ts_us"))
    rows = with_session_end(rows, layout)

    beat = F.col("_beat")
    on_checkout = F.when(beat & (F.col("page") == "checkout"), F.col("ts_us"))
    grouped = rows.groupBy("session_id").agg(
        *_named(motion_aggregates()),
        *_named(cart_aggregates()),
        *_named(window_columns()),
        F.count_if(
            beat & (F.col("page") == "cart") & (F.col("_p_page") == "checkout")
        ).alias("_regressions"),
        F.min(on_checkout).alias("_first_co"),
        F.max(on_checkout).alias("_last_co"),
        F.max_by("page", _beat_at()).alias("_last_page"),
        F.max_by(F.struct("page", "ts_us", "payment_method_selected"), at()).alias("_cur"),
    )
    grouped = grouped.filter(F.col("heartbeat_count") >= 2)
    if with_current:
        cur = F.col("_cur")
        cur_us = F.when(cur["page"] == "checkout", cur["ts_us"])
        back = (cur["page"] == "cart") & (F.col("_last_page") == "checkout")
        switched = (
            cur_us.isNotNull()
            & F.col("_first_co").isNotNull()
            & cur["payment_method_selected"].isNotNull()
        )
    else:
        cur_us, back, switched = F.lit(None).cast("bigint"), F.lit(False), F.lit(False)
    seconds = X.exact_seconds(
        F.least(F.col("_first_co"), cur_us), F.greatest(F.col("_last_co"), cur_us)
    )
    return grouped.withColumns(
        {
            "page_regression_count": F.col("_regressions")
            + F.coalesce(back, F.lit(False)).cast("bigint"),
            "payment_hesitation_ms": F.coalesce(X.truncated_ms(seconds), F.lit(0)),
            "payment_method_switches": F.coalesce(switched, F.lit(False)).cast("bigint"),
        }
    ).drop("_regressions", "_first_co", "_last_co", "_last_page", "_cur")
